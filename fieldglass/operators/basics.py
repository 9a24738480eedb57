"""Joins, dedup, set and top-k building blocks that recur in league data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (end it with a unique column)."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def priority_dedup(df: DataFrame, keys: list[str], source: str, ranking: list[str], tiebreak: str) -> DataFrame:
    """One row per key: the best-ranked source, then the largest ``tiebreak``; unranked sources last."""
    rank = F.lit(len(ranking))
    for i, name in reversed(list(enumerate(ranking))):
        rank = F.when(F.col(source) == name, i).otherwise(rank)
    return first_by(df, keys, [rank.asc(), F.col(tiebreak).desc()])


def competition_rank(df: DataFrame, metric: str, key: str, descending: bool = True, within: list[str] | None = None) -> DataFrame:
    """Adds rank (1, 2, 2, 4) and is_tie (true from the second of equal values on).

    Without ``within`` the whole table is one ranking: rows are counted by value and
    the counts are added up, so the one window over everything sees values, not rows.
    """
    order = F.col(metric).desc() if descending else F.col(metric).asc()
    if within:
        by = W.partitionBy(*within)
        return df.withColumn("rank", F.rank().over(by.orderBy(order)).cast("int")).withColumn("is_tie", F.coalesce(F.lag(metric).over(by.orderBy(order, F.col(key).asc())) == F.col(metric), F.lit(False)))
    counts = df.groupBy(F.col(metric).alias("_value")).agg(F.count("*").alias("_n"))
    value = F.col("_value").desc() if descending else F.col("_value").asc()
    ranks = counts.select("_value", (F.sum("_n").over(W.orderBy(value).rowsBetween(W.unboundedPreceding, 0)) - F.col("_n") + 1).cast("int").alias("rank"))
    x = df.join(ranks, F.col(metric).eqNullSafe(F.col("_value"))).drop("_value")
    return x.withColumn("is_tie", F.col(metric).isNotNull() & (F.row_number().over(W.partitionBy(metric).orderBy(F.col(key).asc())) > 1))


def two_sided(games: DataFrame, home: str, away: str, home_score: str, away_score: str) -> DataFrame:
    """Two rows per game, one from each side: team, opponent, scored, allowed, is_home."""
    side = lambda t, o, s, a, h: F.struct(F.col(t).alias("team"), F.col(o).alias("opponent"), F.col(s).alias("scored"), F.col(a).alias("allowed"), F.lit(h).alias("is_home"))
    rest = [c for c in games.columns if c not in (home, away, home_score, away_score)]
    return games.select(*rest, F.explode(F.array(side(home, away, home_score, away_score, True), side(away, home, away_score, home_score, False))).alias("_s")).select(*rest, "_s.*")


def outcome() -> Column:
    """W, L or D of a two-sided row."""
    return F.when(F.col("scored") > F.col("allowed"), "W").when(F.col("scored") < F.col("allowed"), "L").otherwise("D")


def reconcile(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Full outer comparison of two sources: key, status (missing_right, missing_left, mismatch, match)."""
    a = left.select(F.col(key).alias("k"), F.col(value).alias("a"), F.lit(True).alias("ha"))
    b = right.select(F.col(key).alias("k"), F.col(value).alias("b"), F.lit(True).alias("hb"))
    status = F.when(F.col("hb").isNull(), "missing_right").when(F.col("ha").isNull(), "missing_left").when(~F.col("a").eqNullSafe(F.col("b")), "mismatch").otherwise("match")
    return a.join(b, "k", "full").select(F.col("k").alias(key), status.alias("status"))
