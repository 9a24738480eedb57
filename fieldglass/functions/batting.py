"""Projections and record metrics as columns.

Rounding is Spark's ``bround`` (half to even on the decimal form of a double),
which can differ by one in the last place from rounding the binary value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rates per plate appearance a projection is drawn to, and how strongly.
LEAGUE = {"hits": 0.230, "home_runs": 0.025, "walks": 0.085, "strikeouts": 0.180, "total_bases": 0.350, "at_bats": 0.880}
REGRESSION, SEASON_WEIGHTS = 1200.0, (5.0, 4.0, 3.0)
# The age of the peak, growth a year before it, decline a year after it.
PEAK, GROWTH, DECLINE = 29, 0.006, 0.003


def aging(age: Column) -> Column:
    """1 at the peak, more before, less after; 1 where age is missing or not positive."""
    off = F.lit(PEAK) - age
    return F.when(age.isNull() | (age <= 0), 1.0).when(off >= 0, F.bround(1.0 + off * F.lit(GROWTH), 4)).otherwise(F.bround(1.0 + off * F.lit(DECLINE), 4))


def games_behind(wins: str, losses: str, top_wins: str, top_losses: str) -> Column:
    """Half the difference of wins and losses to the leader, 0 at least."""
    return F.greatest(((F.col(top_wins) - F.col(wins)) + (F.col(losses) - F.col(top_losses))) / 2.0, F.lit(0.0))


def hitter_projection(seasons: str, age: Column, park: Column) -> dict[str, Column]:
    """Projected columns from ``seasons``, an array of up to three structs, the latest first.

    Structs hold pa, at_bats, hits, home_runs, walks, strikeouts and total_bases.
    All are null where the weighted plate appearances are 0.
    """
    s = F.slice(seasons, 1, 3)
    weighted = lambda c: F.aggregate(F.zip_with(s, F.array(*map(F.lit, SEASON_WEIGHTS)), lambda x, w: F.coalesce(x[c], F.lit(0.0)) * w), F.lit(0.0), lambda a, x: a + x)
    pa, size = weighted("pa"), weighted("pa") + REGRESSION
    rate = {c: (weighted(c) + REGRESSION * league) / size for c, league in LEAGUE.items()}
    grown = aging(age)
    h, hr, tb = (rate[c] * grown * park for c in ("hits", "home_runs", "total_bases"))
    bb = rate["walks"] * grown
    year = lambda i, default: F.when(F.size(seasons) > i, F.coalesce(F.get(seasons, F.lit(i))["pa"], F.lit(0.0))).otherwise(F.lit(default))
    plays = F.bround(0.5 * year(0, 400.0) + 0.1 * year(1, 300.0) + 200.0, 1)
    slash = {"avg": h / rate["at_bats"], "obp": h + bb, "slg": tb / rate["at_bats"], "ops": h + bb + tb / rate["at_bats"], "woba": 0.69 * bb + 0.89 * (h - hr) + 2.10 * hr}
    counts = {"ab": rate["at_bats"], "hits": h, "home_runs": hr, "walks": bb, "strikeouts": rate["strikeouts"]}
    out = {"projected_pa": plays} | {f"projected_{k}": F.bround(plays * v, 1) for k, v in counts.items()} | {f"projected_{k}": F.bround(v, 3) for k, v in slash.items()}
    return {k: F.when(pa != 0, v) for k, v in out.items()}


# Rates per out a pitcher's projection is drawn to, over how many outs, and the constant of its fip.
PITCHER_LEAGUE = {"earned_runs": 0.150, "strikeouts": 0.220, "walks": 0.090, "hits": 0.280, "home_runs": 0.028}
PITCHER_REGRESSION, PITCHER_FIP = 1350.0, 3.20
#: Fields of a pitcher's season, by the column each is taken from.
PITCHER_COUNTS = {"innings_outs": "outs", "earned_runs": "earned_runs", "strikeouts": "strikeouts", "walks_allowed": "walks", "hits_allowed": "hits", "home_runs_allowed": "home_runs"}


def pitcher_projection(seasons: str, age: Column, park: Column) -> dict[str, Column]:
    """Projected columns from ``seasons``, an array of up to three structs of PITCHER_COUNTS, the latest first.

    Age turns the other way round than for batters: what makes them better makes
    runs fewer.  All are null where the weighted outs are 0.
    """
    s = F.slice(seasons, 1, 3)
    weighted = lambda c: F.aggregate(F.zip_with(s, F.array(*map(F.lit, SEASON_WEIGHTS)), lambda x, w: F.coalesce(x[c], F.lit(0.0)) * w), F.lit(0.0), lambda a, x: a + x)
    outs = weighted("outs")
    rate = {c: (weighted(c) + PITCHER_REGRESSION * league) / (outs + PITCHER_REGRESSION) for c, league in PITCHER_LEAGUE.items()}
    grown = F.lit(2.0) - aging(age)
    year = lambda i, default: F.when(F.size(seasons) > i, F.coalesce(F.get(seasons, F.lit(i))["outs"], F.lit(0.0))).otherwise(F.lit(default))
    thrown = 0.5 * year(0, 300.0) + 0.1 * year(1, 200.0) + 180.0
    out = {
        "projected_ip": F.bround(thrown / 3.0, 1),
        "projected_era": F.bround(rate["earned_runs"] * 27.0 * grown * park, 2),
        "projected_whip": F.bround((rate["hits"] + rate["walks"]) * 3.0 * park, 2),
        "projected_fip": F.bround(39.0 * rate["home_runs"] + 9.0 * rate["walks"] - 6.0 * rate["strikeouts"] + PITCHER_FIP, 2),
    } | {f"projected_{n}": F.bround(thrown * rate[c], 1) for n, c in (("strikeouts", "strikeouts"), ("walks", "walks"), ("hits_allowed", "hits"), ("home_runs_allowed", "home_runs"))}
    return {k: F.when(outs != 0, v) for k, v in out.items()}
