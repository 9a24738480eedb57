"""Groupings of games and stat lines by place, opponent and situation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bands of a park factor: labels by the least factor, exclusive.
PARK_BANDS = ((1.10, "extreme hitter"), (1.04, "hitter"), (0.96, "neutral"), (0.90, "pitcher"))


def park_factor(games: DataFrame, park: str, runs: str, default_rate: float = 10.0) -> DataFrame:
    """Per park: games, runs, runs a game, its ratio to the league's, and a label.

    A NULL park is 'UNKNOWN'; games without runs are left out; a league without
    runs has the rate ``default_rate``.  Runs are summed as decimals, so the
    result does not depend on the order of rows.
    """
    known = games.where(F.col(runs).isNotNull()).select(F.coalesce(F.col(park), F.lit("UNKNOWN")).alias("park"), F.col(runs).cast("decimal(18,2)").alias("r"))
    by = known.groupBy("park").agg(F.count("*").cast("long").alias("games"), F.sum("r").alias("runs"))
    total = by.agg(F.sum("games").alias("g"), F.sum("runs").alias("t"))
    league = F.when(F.col("g") > 0, F.col("t").cast("double") / F.col("g")).otherwise(F.lit(default_rate))
    rate = F.col("runs").cast("double") / F.col("games")
    factor = F.when(league > 0, rate / league).otherwise(F.lit(1.0))
    label = F.lit("extreme pitcher")
    for bound, name in reversed(PARK_BANDS):
        label = F.when(factor > bound, name).otherwise(label)
    return by.crossJoin(F.broadcast(total)).select("park", "games", F.round(rate, 4).alias("rate"), F.round(factor, 4).alias("factor"), label.alias("label"))


def park_table(games: DataFrame, park: str, home: str, away: str, default_rate: float = 10.0) -> DataFrame:
    """Per park: games, runs of both sides, rates of park and league and the factor, to three places, and its label.

    Runs are whole numbers; games without either score are left out; a NULL park is
    'UNKNOWN'.
    """
    known = games.where(F.col(home).isNotNull() & F.col(away).isNotNull()).select(F.coalesce(F.col(park), F.lit("UNKNOWN")).alias("park"), F.col(home).cast("long").alias("h"), F.col(away).cast("long").alias("a"))
    by = known.groupBy("park").agg(F.count("*").alias("games"), F.sum("h").alias("home_runs"), F.sum("a").alias("away_runs"))
    total = by.agg(F.sum("games").alias("g"), F.sum(F.col("home_runs") + F.col("away_runs")).alias("t"))
    x = by.crossJoin(F.broadcast(total)).withColumn("total_runs", F.col("home_runs") + F.col("away_runs"))
    third = lambda a, b: F.expr(f"CAST((2000 * ({a}) + ({b})) div (2 * ({b})) AS DOUBLE) / 1000")
    factor = F.col("total_runs").cast("double") * F.col("g") / (F.col("games") * F.col("t"))
    label = F.lit("extreme pitcher")
    for bound, name in reversed(PARK_BANDS):
        label = F.when(factor > bound, name).otherwise(label)
    return x.select(
        "park", "games", "home_runs", "away_runs", "total_runs", third("total_runs", "games").alias("runs_per_game"), F.coalesce(F.when(F.col("g") > 0, third("t", "g")), F.lit(default_rate)).alias("league_rate"),
        F.when(F.col("t") > 0, third("total_runs * g", "games * t")).otherwise(1.0).alias("factor"), F.when(F.col("t") > 0, label).otherwise("neutral").alias("label"),
    )
