"""Metric columns, sessions and cross checks on the standard tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import batting
from ..functions.ratios import ratio
from ..operators.retrieval import rrf
from ..registry import Tables, query


@query("r01_rates", "SELECT l_suppkey, CASE WHEN n > 0 THEN CAST(h AS DOUBLE) / n ELSE 0 END AS avg, CASE WHEN q > 0 THEN CAST(h AS DOUBLE) / q ELSE 0 END AS slg FROM (SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS h, count(*) FILTER (WHERE l_quantity > 10) AS n, sum(l_quantity)::BIGINT AS q FROM lineitem GROUP BY 1)")
def r01(t: Tables):
    counts = t.lineitem.groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("h"), F.count_if(F.col("l_quantity") > 10).alias("n"), F.sum("l_quantity").cast("long").alias("q"))
    return counts.select("l_suppkey", ratio(F.col("h"), F.col("n")).alias("avg"), ratio(F.col("h"), F.col("q")).alias("slg"))


@query("r09_games_behind", "WITH k AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS w, count(*) FILTER (WHERE o_orderstatus = 'O') AS l FROM orders GROUP BY 1), t AS (SELECT w AS tw, l AS tl FROM k ORDER BY CASE WHEN w + l > 0 THEN w / (w + l) ELSE 0.0 END DESC, w DESC, o_custkey LIMIT 1) SELECT o_custkey, greatest(((tw - w) + (l - tl)) / 2.0, 0)::DOUBLE AS behind FROM k, t")
def r09(t: Tables):
    """The leader, by share of wins and then wins, is one row of two figures."""
    own = t.orders.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("w"), F.count_if(F.col("o_orderstatus") == "O").alias("l"))
    share = F.when(F.col("w") + F.col("l") > 0, F.col("w") / (F.col("w") + F.col("l"))).otherwise(0.0)
    top = own.agg(F.min_by(F.struct(F.col("w").alias("tw"), F.col("l").alias("tl")), F.struct(-share, -F.col("w"), "o_custkey")).alias("x")).select("x.*")
    return own.join(F.broadcast(top)).select("o_custkey", batting.games_behind("w", "l", "tw", "tl").alias("behind"))


@query("r13_aging", "SELECT p_partkey, CASE WHEN p_size <= 0 THEN 1 WHEN p_size <= 29 THEN round(1 + (29 - p_size) * 0.006, 4) ELSE round(1 - (p_size - 29) * 0.003, 4) END::DOUBLE AS factor FROM part")
def r13(t: Tables):
    return t.part.select("p_partkey", batting.aging(F.col("p_size")).alias("factor"))


@query(
    "w20_sessions",
    "WITH f AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER w OR turn % 4 = 0 THEN 1 ELSE 0 END AS f FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text)) SELECT conv_id, turn, role, (sum(f) OVER (PARTITION BY conv_id ORDER BY turn, text ROWS UNBOUNDED PRECEDING))::BIGINT AS session FROM f",
)
def w20(t: Tables):
    """A session begins where the speaker changes or a marked turn comes; ids are a running sum of the begins."""
    w = W.partitionBy("conv_id").orderBy("turn", "text")
    begins = F.when(~F.col("role").eqNullSafe(F.lag("role").over(w)) | (F.col("turn") % 4 == 0), 1).otherwise(0)
    rows = t.conversations.withColumn("f", begins)
    return rows.select("conv_id", "turn", "role", F.sum("f").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("session"))


@query(
    "v08_team_against_players",
    "SELECT a.k AS team, a.f AS field, a.v - b.v AS off FROM (SELECT c_nationkey AS k, unnest(['n', 'keys']) AS f, unnest([count(*), sum(c_custkey)::BIGINT]) AS v FROM customer GROUP BY 1) a JOIN (SELECT s_nationkey AS k, unnest(['n', 'keys']) AS f, unnest([count(*), sum(s_suppkey)::BIGINT]) AS v FROM supplier GROUP BY 1) b ON a.k = b.k AND a.f = b.f WHERE a.v <> b.v",
)
def v08(t: Tables):
    """Field by field, totals of two sources that differ."""

    def long(df, team, key):
        sums = df.groupBy(F.col(team).alias("team")).agg(F.count("*").alias("n"), F.sum(key).alias("keys"))
        return sums.unpivot("team", ["n", "keys"], "field", "v")

    b = long(t.supplier, "s_nationkey", "s_suppkey").withColumnRenamed("v", "b")
    return long(t.customer, "c_nationkey", "c_custkey").join(b, ["team", "field"]).where("v <> b").select("team", "field", (F.col("v") - F.col("b")).alias("off"))


@query("v15_field_sources", "SELECT o_orderkey, CASE WHEN l_orderkey IS NULL THEN 'fallback' WHEN c = n THEN 'agreed' WHEN c > n THEN 'conflict' ELSE 'secondary' END AS status, CASE WHEN l_orderkey IS NULL THEN 60 WHEN c = n THEN 100 WHEN c > n THEN 50 ELSE 80 END AS confidence FROM (SELECT *, o_custkey % 5 AS n FROM orders) LEFT JOIN (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def v15(t: Tables):
    """Two sources of a field, which of them counts and how far it is trusted (in hundredths)."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("c"))
    n, c = F.col("o_custkey") % 5, F.col("c")
    pick = lambda *v: F.when(c.isNull(), v[0]).when(c == n, v[1]).when(c > n, v[2]).otherwise(v[3])
    return t.orders.join(lines, "o_orderkey", "left").select("o_orderkey", pick("fallback", "agreed", "conflict", "secondary").alias("status"), pick(60, 100, 50, 80).alias("confidence"))


@query(
    "k05_fused_ranks",
    "WITH s AS (SELECT lang AS q, doc_id AS d, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS r FROM documents), d AS (SELECT lang AS q, doc_id AS d, row_number() OVER (PARTITION BY lang ORDER BY doc_id DESC) AS r FROM documents) SELECT coalesce(s.q, d.q) AS query_id, coalesce(s.d, d.d) AS item_id, round(coalesce(CAST(1 AS DOUBLE) / (2 + s.r), 0) + coalesce(CAST(2 AS DOUBLE) / (2 + d.r), 0), 6) AS score FROM (FROM s WHERE r <= 30) s FULL JOIN (FROM d WHERE r <= 30) d ON s.q = d.q AND s.d = d.d",
)
def k05(t: Tables):
    """Two ranked lists of 30 a query, joined by reciprocal ranks; the list length is the feature."""
    ranked = lambda *by: t.documents.select(F.col("lang").alias("query_id"), F.col("doc_id").alias("item_id"), F.row_number().over(W.partitionBy("lang").orderBy(*by)).alias("rank")).where("rank <= 30")
    return rrf(ranked(F.desc("n_chars"), F.col("doc_id")), ranked(F.desc("doc_id")))
