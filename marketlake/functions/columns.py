"""Column helpers shared by the layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def millis_to_timestamp(column: str) -> Column:
    return F.timestamp_millis(F.col(column))


def millis_to_text(column: str) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss`` in the session zone (UTC)."""
    return F.date_format(millis_to_timestamp(column), SECONDS_FORMAT)


def text_to_timestamp(column: str) -> Column:
    """Null for text that is not a timestamp."""
    return F.try_to_timestamp(F.col(column), F.lit(SECONDS_FORMAT))
