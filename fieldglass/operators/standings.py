"""Day-by-day standings: running records, streaks that draws leave alone, recent form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .basics import outcome, two_sided


def form(games: DataFrame, r: dict[str, str]) -> DataFrame:
    """Two rows per game with running wins, losses, draws, the last ten, and the streak.

    ``r`` maps game, date, home, away, home_score, away_score to columns; NULL
    scores count as 0.  Order within a team is date, then game.  The streak is
    +n after n wins, -n after n losses; a draw neither extends nor ends it.
    """
    g = games.select(*[F.col(c).alias(k) for k, c in r.items()]).na.fill(0, ["home_score", "away_score"])
    s = two_sided(g, "home", "away", "home_score", "away_score").withColumn("res", outcome())
    by = W.partitionBy("team").orderBy("date", "game", "is_home")
    run, ten = by.rowsBetween(W.unboundedPreceding, 0), by.rowsBetween(-9, 0)
    is_ = lambda x: F.when(F.col("res") == x, 1).otherwise(0)
    s = s.withColumn("decided", F.when(F.col("res") != "D", F.col("res")))
    before = F.last("decided", ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, -1))
    s = s.withColumn("turn", F.when(F.col("decided").isNotNull() & ~F.col("decided").eqNullSafe(before), 1).otherwise(0))
    s = s.withColumn("island", F.sum("turn").over(run)).withColumn("held", F.last("decided", ignorenulls=True).over(run))
    length = F.sum(F.when(F.col("decided").isNotNull(), 1).otherwise(0)).over(W.partitionBy("team", "island").orderBy("date", "game", "is_home").rowsBetween(W.unboundedPreceding, 0))
    streak = F.when(F.col("held") == "W", length).when(F.col("held") == "L", -length).otherwise(F.lit(0))
    return s.select(
        "team", "game", "date", "opponent", "is_home", "res",
        *[F.sum(is_(x)).over(run).cast("long").alias(n) for x, n in (("W", "wins"), ("L", "losses"), ("D", "draws"))],
        F.sum("scored").over(run).cast("long").alias("runs_scored"), F.sum("allowed").over(run).cast("long").alias("runs_allowed"),
        *[F.sum(is_(x)).over(ten).cast("long").alias(f"last10_{n}") for x, n in (("W", "wins"), ("L", "losses"), ("D", "draws"))],
        streak.cast("long").alias("streak"),
    )


def held(last: DataFrame) -> DataFrame:
    """``last`` (a row by date and team at most) with each row held until the day before its team's next one.

    A row becomes the days of its own interval, and those that are a date of any team
    stay by an equality join; dates are never compared with teams.  The last row of a
    team holds until the last date of all.
    """
    follows = F.lead("date").over(W.partitionBy("team").orderBy("date"))
    end = last.agg(F.max("date").alias("_end"))
    x = last.withColumn("_next", follows).crossJoin(F.broadcast(end))  # one row
    x = x.withColumn("_day", F.explode(F.sequence("date", F.coalesce(F.date_sub("_next", 1), F.col("_end")))))
    x = x.join(last.select(F.col("date").alias("_day")).distinct(), "_day")
    return x.select(F.col("_day").alias("date"), *[c for c in last.columns if c != "date"])


def table(games: DataFrame, r: dict[str, str]) -> DataFrame:
    """The dense standings: one row per date and team seen so far, ranked, with games behind the leader.

    Idle teams carry their last figures.  Rank goes by win percentage, wins, then team.
    """
    f = form(games, r)
    last = f.groupBy("date", "team").agg(*[F.max_by(c, F.struct("game", "is_home")).alias(c) for c in ("wins", "losses", "draws", "streak")])
    dense = held(last)
    played = F.col("wins") + F.col("losses")
    dense = dense.withColumn("pct", F.when(played > 0, F.col("wins") / played).otherwise(F.lit(0.0)))
    day = W.partitionBy("date").orderBy(F.desc("pct"), F.desc("wins"), F.asc("team"))
    behind = ((F.first("wins").over(day) - F.col("wins")) + (F.col("losses") - F.first("losses").over(day))) / 2
    return dense.select("date", "team", "wins", "losses", "draws", "streak", F.round("pct", 4).alias("win_pct"), F.row_number().over(day).cast("int").alias("rank"), F.greatest(behind, F.lit(0.0)).cast("double").alias("games_behind"))


#: What a full snapshot carries besides the record.
CARRIED = ("wins", "losses", "draws", "streak", "runs_scored", "runs_allowed", "last10_wins", "last10_losses", "last10_draws", "home_wins", "home_losses", "away_wins", "away_losses")


def snapshot(games: DataFrame, r: dict[str, str], top: int = 5) -> DataFrame:
    """The dense standings with runs, home and away records, the last ten and a flag for the ``top`` ranks.

    One row per date and team seen so far.
    """
    f = form(games, r)
    run = W.partitionBy("team").orderBy("date", "game", "is_home").rowsBetween(W.unboundedPreceding, 0)
    count = lambda home, res: F.count_if((F.col("is_home") == F.lit(home)) & (F.col("res") == res)).over(run)
    f = f.withColumns({"home_wins": count(True, "W"), "home_losses": count(True, "L"), "away_wins": count(False, "W"), "away_losses": count(False, "L")})
    last = f.groupBy("date", "team").agg(*[F.max_by(c, F.struct("game", "is_home")).alias(c) for c in CARRIED])
    dense = held(last)
    played = F.col("wins") + F.col("losses")
    dense = dense.withColumn("pct", F.when(played > 0, F.col("wins") / played).otherwise(F.lit(0.0)))
    day = W.partitionBy("date").orderBy(F.desc("pct"), F.desc("wins"), F.asc("team"))
    dense = dense.withColumn("rank", F.row_number().over(day).cast("int"))
    behind = ((F.first("wins").over(day) - F.col("wins")) + (F.col("losses") - F.first("losses").over(day))) / 2
    return dense.select("date", "team", *CARRIED, F.expr("runs_scored - runs_allowed").alias("run_differential"), F.round("pct", 4).alias("win_pct"), "rank", F.greatest(behind, F.lit(0.0)).cast("double").alias("games_behind"), (F.col("rank") <= top).alias("top_5"))


def weekly(games: DataFrame, r: dict[str, str]) -> DataFrame:
    """(team, weekly): a map of ISO weeks to the share of wins, NULL for a week of draws alone."""
    f = form(games, r)
    iso = F.format_string("%d-W%02d", F.expr("extract(YEAROFWEEK FROM date)"), F.expr("extract(WEEK FROM date)"))
    w = f.groupBy("team", iso.alias("week")).agg(F.count_if(F.col("res") == "W").alias("w"), F.count_if(F.col("res") == "L").alias("l"))
    share = F.expr("CASE WHEN w + l > 0 THEN CAST((2000 * w + w + l) div (2 * (w + l)) AS DOUBLE) / 1000 END")
    return w.groupBy("team").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("week", share.alias("share"))))).alias("weekly"))


def recent_form(games: DataFrame, r: dict[str, str], n: int = 10) -> DataFrame:
    """By team, its last ``n`` games: wins, losses, draws, and the run of equal results up to now (draws count as one kind)."""
    s = two_sided(games.select(*[F.col(c).alias(k) for k, c in r.items()]), "home", "away", "home_score", "away_score").withColumn("res", outcome())
    back = W.partitionBy("team").orderBy(F.desc("date"), F.desc("game"), F.desc("is_home"))
    x = s.withColumn("rn", F.row_number().over(back)).where(F.col("rn") <= n)
    x = x.withColumn("last", F.first("res").over(W.partitionBy("team").orderBy("rn")))
    x = x.groupBy("team").agg(*[F.count_if(F.col("res") == k).alias(name) for k, name in (("W", "wins"), ("L", "losses"), ("D", "draws"))], F.min("last").alias("last"), F.min(F.when(F.col("res") != F.col("last"), F.col("rn"))).alias("other"), F.count("*").alias("n"))
    return x.select("team", "wins", "losses", "draws", F.col("last").alias("streak_type"), F.coalesce(F.col("other") - 1, F.col("n")).cast("long").alias("streak"))


def head_to_head(games: DataFrame, r: dict[str, str], by: list[str] = ()) -> DataFrame:
    """By unordered pair of teams (and ``by``): a, b, wins of each, draws and who is ahead ('even' if neither); games without a score are left out."""
    g = games.select(*by, *[F.col(c).alias(k) for k, c in r.items() if k not in by]).where("home_score is not null and away_score is not null")
    a = F.least("home", "away")
    mine = F.when(F.col("home") == a, F.col("home_score") - F.col("away_score")).otherwise(F.col("away_score") - F.col("home_score"))
    x = g.groupBy(*by, a.alias("a"), F.greatest("home", "away").alias("b")).agg(F.count_if(mine > 0).alias("a_wins"), F.count_if(mine < 0).alias("b_wins"), F.count_if(mine == 0).alias("draws"))
    return x.withColumn("ahead", F.when(F.col("a_wins") > F.col("b_wins"), F.col("a").cast("string")).when(F.col("b_wins") > F.col("a_wins"), F.col("b").cast("string")).otherwise("even"))


def opponents(games: DataFrame, r: dict[str, str]) -> DataFrame:
    """By team and opponent: record, share of decided games won, and the place among the toughest (least share, then most losses)."""
    s = two_sided(games.select(*[F.col(c).alias(k) for k, c in r.items()]).where("home_score is not null and away_score is not null"), "home", "away", "home_score", "away_score").withColumn("res", outcome())
    x = s.groupBy("team", "opponent").agg(*[F.count_if(F.col("res") == k).alias(name) for k, name in (("W", "wins"), ("L", "losses"), ("D", "draws"))])
    x = x.withColumn("win_rate", F.expr("CASE WHEN wins + losses > 0 THEN CAST((2000 * wins + wins + losses) div (2 * (wins + losses)) AS DOUBLE) / 1000 ELSE 0.0D END"))
    return x.withColumn("place", F.row_number().over(W.partitionBy("team").orderBy("win_rate", F.desc("losses"), "opponent")))
