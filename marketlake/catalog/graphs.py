"""Graph measures on the trade graph: customers, suppliers and parts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.catalog.entry import Book, rounded, sql6
from marketlake.operators import graph
from marketlake.sources.tables import driver_table

book = Book()

# Suppliers get negative ids and parts ids shifted far up, so that all kinds of
# vertices share one id space.
PART_SHIFT = 10**12


def _trades(spark, sf):
    lines = driver_table(spark, sf, "lineitem")
    orders = driver_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("customer"),
        (-1 - F.col("l_suppkey")).alias("supplier"),
        (F.col("l_partkey") + PART_SHIFT).alias("part"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )


_TRADES = f"""trades AS MATERIALIZED (
  SELECT o_custkey AS customer, -1 - l_suppkey AS supplier, l_partkey + {PART_SHIFT} AS part,
         CAST(l_quantity AS BIGINT) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_PAIRS = """pairs AS MATERIALIZED (SELECT DISTINCT customer, supplier FROM trades),
edges AS MATERIALIZED (SELECT customer AS src, supplier AS dst FROM pairs
  UNION ALL SELECT supplier, customer FROM pairs)"""


def _trade_edges(spark, sf):
    pairs = _trades(spark, sf).select(F.col("customer").alias("src"), F.col("supplier").alias("dst"))
    return graph.both_ways(pairs)


_STEPS = """steps AS MATERIALIZED (SELECT src, dst FROM (
  SELECT event_id AS src, lead(event_id) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS dst
  FROM events) WHERE dst IS NOT NULL)"""


def _steps(spark, sf):
    """Each event of a user's day leads to the next one: many chains, each bounded by what
    a user does in a day."""
    events = driver_table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    later = F.lead("event_id").over(Window.partitionBy("user_id", "day").orderBy("ts", "event_id"))
    return events.select(F.col("event_id").alias("src"), later.alias("dst")).filter("dst IS NOT NULL")


@book.add(
    "graph_transitive_closure",
    f"""WITH RECURSIVE {_STEPS},
closure AS (SELECT src, dst FROM steps UNION
  SELECT c.src, e.dst FROM closure c JOIN steps e ON c.dst = e.src)
SELECT src, dst FROM closure""",
)
def graph_transitive_closure(spark, sf):
    """All later events of the same day, for every event."""
    return graph.transitive_closure(_steps(spark, sf))


def _rank_sql(rounds, edges="edges"):
    steps = [
        f"""links AS MATERIALIZED (SELECT src, dst, 1.0 / count(*) OVER (PARTITION BY src) AS share FROM {edges}),
ids AS MATERIALIZED (SELECT DISTINCT src AS id FROM {edges} UNION SELECT dst FROM {edges}),
r0 AS (SELECT id, CAST(1 AS DOUBLE) AS rank FROM ids)"""
    ]
    for k in range(1, rounds + 1):
        steps.append(
            f"""r{k} AS (SELECT ids.id, 0.15 + 0.85 * coalesce(sum(rank * share), 0) AS rank
  FROM ids LEFT JOIN (links JOIN r{k - 1} ON links.src = r{k - 1}.id) ON ids.id = dst GROUP BY ids.id)"""
        )
    return ",\n".join(steps)


@book.add(
    "graph_pagerank",
    f"WITH {_TRADES}, {_PAIRS}, {_rank_sql(10)} SELECT id, {sql6('rank')} AS rank FROM r10",
)
def graph_pagerank(spark, sf):
    return rounded(graph.pagerank(_trade_edges(spark, sf), 10), "rank")


@book.add(
    "graph_pagerank_converged",
    f"WITH {_STEPS}, {_rank_sql(30, 'steps')} SELECT id, round(rank, 4) AS rank FROM r30",
)
def graph_pagerank_converged(spark, sf):
    ranks = graph.pagerank(_steps(spark, sf), 200, tolerance=1e-7)
    return ranks.select("id", F.round("rank", 4).alias("rank"))


def _label_sql(rounds):
    """Labels after so many rounds, each with a jump to the label's own label."""
    steps = ["""links AS MATERIALIZED (SELECT DISTINCT customer AS src, part AS dst FROM trades
  UNION SELECT DISTINCT part, customer FROM trades),
l0 AS MATERIALIZED (SELECT DISTINCT src AS id, src AS label FROM links)"""]
    for k in range(1, rounds + 1):
        steps.append(
            f"""m{k} AS MATERIALIZED (SELECT id, min(label) AS label FROM (
  SELECT * FROM l{k - 1} UNION ALL SELECT dst, label FROM l{k - 1} JOIN links ON id = src) GROUP BY id),
l{k} AS MATERIALIZED (SELECT m.id, j.label FROM m{k} m JOIN m{k} j ON m.label = j.id)"""
        )
    return ",\n".join(steps)


@book.add(
    "graph_components",
    f"WITH {_TRADES}, {_label_sql(12)} SELECT id, label AS component FROM l12",
)
def graph_components(spark, sf):
    """Customers and the parts they buy."""
    trades = _trades(spark, sf)
    return graph.connected_components(
        trades.select(F.col("customer").alias("src"), F.col("part").alias("dst"))
    )


@book.add(
    "graph_triangles",
    f"""WITH {_TRADES},
e AS MATERIALIZED (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM (
  SELECT customer AS a, supplier AS b FROM trades UNION SELECT supplier, part FROM trades
  UNION SELECT customer, part FROM trades)),
t AS (SELECT x.a, x.b, y.b AS c FROM e x JOIN e y ON x.b = y.a JOIN e z ON z.a = x.a AND z.b = y.b),
n AS (SELECT id, count(*) AS triangles FROM (
  SELECT a AS id FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t) GROUP BY id),
ids AS (SELECT a AS id FROM e UNION SELECT b FROM e)
SELECT id, coalesce(triangles, 0) AS triangles FROM ids LEFT JOIN n USING (id)""",
)
def graph_triangles(spark, sf):
    """Every sale ties a customer, a supplier and a part to each other."""
    ends = [("customer", "supplier"), ("supplier", "part"), ("customer", "part")]
    sides = F.explode(F.array(*[F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in ends]))
    edges = _trades(spark, sf).select(sides.alias("e")).select("e.*")
    return graph.triangle_counts(edges)


def _path_sql(rounds):
    steps = [
        """weights AS MATERIALIZED (SELECT customer AS a, supplier AS b, min(quantity) AS w FROM trades GROUP BY ALL),
links AS MATERIALIZED (SELECT a AS src, b AS dst, w FROM weights UNION ALL SELECT b, a, w FROM weights),
d0 AS MATERIALIZED (SELECT CAST(1 AS BIGINT) AS id, CAST(0 AS BIGINT) AS distance)"""
    ]
    for k in range(1, rounds + 1):
        steps.append(
            f"""d{k} AS MATERIALIZED (SELECT id, min(distance) AS distance FROM (
  SELECT * FROM d{k - 1} UNION ALL
  SELECT dst, distance + w FROM d{k - 1} JOIN links ON id = src) GROUP BY id)"""
        )
    return ",\n".join(steps)


@book.add(
    "graph_shortest_paths",
    f"WITH {_TRADES}, {_path_sql(25)} SELECT id, distance FROM d25",
)
def graph_shortest_paths(spark, sf):
    weighted = _trades(spark, sf).select(
        F.col("customer").alias("src"), F.col("supplier").alias("dst"), F.col("quantity").alias("weight")
    )
    back = weighted.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return graph.shortest_paths(weighted.union(back), 1)


def _balances(spark, sf):
    buyers = driver_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value")
    )
    sellers = driver_table(spark, sf, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("id"), F.col("s_acctbal").alias("value")
    )
    return buyers.union(sellers)


_BALANCES = """balances AS MATERIALIZED (SELECT c_custkey AS id, c_acctbal AS value FROM customer
  UNION ALL SELECT -1 - s_suppkey, s_acctbal FROM supplier)"""


@book.add(
    "graph_neighbours_above",
    f"""WITH {_TRADES}, {_PAIRS}, {_BALANCES}
SELECT o.id, count(*) AS higher, {sql6("avg(t.value)")} AS mean_higher
FROM edges JOIN balances t ON t.id = src JOIN balances o ON o.id = dst WHERE t.value > o.value GROUP BY o.id""",
)
def graph_neighbours_above(spark, sf):
    found = graph.neighbours_above(_trade_edges(spark, sf), _balances(spark, sf))
    return rounded(found, "mean_higher")


@book.add(
    "graph_ranked_members",
    f"""WITH {_TRADES}, {_PAIRS}, {_BALANCES},
members AS MATERIALIZED (SELECT id FROM balances WHERE value > 0),
inner_edges AS MATERIALIZED (SELECT * FROM edges WHERE src IN (SELECT id FROM members) AND dst IN (SELECT id FROM members)),
{_rank_sql(10, "inner_edges")}
SELECT id, {sql6("rank")} AS rank, value FROM r10 LEFT JOIN balances USING (id) ORDER BY r10.rank DESC, id LIMIT 5""",
)
def graph_ranked_members(spark, sf):
    found = graph.ranked_members(
        _trade_edges(spark, sf), _balances(spark, sf), F.col("value") > 0
    )
    return rounded(found, "rank")
