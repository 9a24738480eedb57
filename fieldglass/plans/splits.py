"""Park factors and splits on the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import splits
from ..registry import Tables, query


@query(
    "a14_park_factor",
    """
    WITH g AS (SELECT coalesce(n_name, 'UNKNOWN') AS park, CAST(o_totalprice AS DECIMAL(18,2)) AS r
        FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice IS NOT NULL),
    b AS (SELECT park, count(*) AS games, sum(r) AS runs FROM g GROUP BY 1),
    l AS (SELECT CAST(sum(runs) AS DOUBLE) / sum(games) AS league FROM b),
    f AS (SELECT park, CAST(games AS BIGINT) AS games, CAST(runs AS DOUBLE) / games AS rate, CAST(runs AS DOUBLE) / games / league AS factor FROM b, l)
    SELECT park, games, round(rate, 4) AS rate, round(factor, 4) AS factor,
        CASE WHEN factor > 1.10 THEN 'extreme hitter' WHEN factor > 1.04 THEN 'hitter' WHEN factor > 0.96 THEN 'neutral'
             WHEN factor > 0.90 THEN 'pitcher' ELSE 'extreme pitcher' END AS label
    FROM f""",
)
def park_factor(t: Tables):
    games = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return splits.park_factor(games, "n_name", "o_totalprice")
