"""Market-style time series on Spark: ingest, lake tables, features, serving."""
