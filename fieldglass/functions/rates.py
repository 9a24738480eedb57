"""Rates of whole counts, rounded exactly.

A rate is a quotient of whole numbers, so it is rounded in whole numbers too: half
up, without a binary fraction in between.  NULL counts as 0.  ``above`` and
``below`` are SQL expressions over the columns at hand.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the extrapolated-runs formula in thousandths, by column.
XR = {"singles": 500, "doubles": 720, "triples": 1040, "home_runs": 1440, "unintentional": 340, "intentional_walks": 250, "stolen_bases": 180, "caught_stealing": -320, "outs_in_play": -90, "strikeouts": -98, "gdp": -370, "sacrifice_flies": 370, "sacrifice_hits": 40}
# Weights of on-base events in hundredths.
WOBA = {"unintentional": 69, "hbp": 72, "singles": 89, "doubles": 127, "triples": 162, "home_runs": 210}


def zero(sql: str) -> str:
    """``sql`` with every column (a lower-case name that calls nothing) read as 0 where it is NULL."""
    return re.sub(r"\b([a-z_][a-z_0-9]*)\b(?!\s*\()", r"coalesce(\1, 0)", sql)


def whole(above: str, below: str, places: int) -> Column:
    """``above / below`` in units of the last place, half up; NULL where ``below`` is not above 0."""
    top, bottom = (f"CAST({zero(x)} AS BIGINT)" for x in (above, below))
    x = f"({2 * 10**places} * ({top}) + ({bottom}))"
    floor = f"(({x} div (2 * ({bottom}))) - CASE WHEN {x} % (2 * ({bottom})) < 0 THEN 1 ELSE 0 END)"
    return F.expr(f"CASE WHEN ({bottom}) > 0 THEN {floor} END")


def rate(above: str, below: str, places: int, default: float | None = 0.0) -> Column:
    """``above / below`` rounded to ``places``; ``default`` where ``below`` is not above 0."""
    x = whole(above, below, places).cast("double") / float(10**places)
    return x if default is None else F.coalesce(x, F.lit(float(default)))


def batting(matchup: bool = False, slugging: bool = True) -> dict[str, Column]:
    """avg, obp, slg, ops, iso, babip and xr from the columns of a stat line.

    ops and iso come from the rounded parts.  ``matchup`` divides times on base by
    plate appearances; without ``slugging`` slg is 0 and ops is obp.
    """
    chances = "plate_appearances" if matchup else "at_bats + walks + hbp + sacrifice_flies"
    nothing = F.lit(0).cast("long")
    avg = F.coalesce(whole("hits", "at_bats", 3), nothing)
    obp = F.coalesce(whole("hits + walks + hbp", chances, 3), nothing)
    slg = F.coalesce(whole("hits + doubles + 2 * triples + 3 * home_runs", "at_bats", 3), nothing) if slugging else nothing
    terms = {"singles": "(hits - doubles - triples - home_runs)", "unintentional": "(hbp + walks - intentional_walks)", "outs_in_play": "(at_bats - hits - strikeouts)"}
    runs = " + ".join(f"({w}) * {terms.get(c, c)}" for c, w in XR.items())
    return {
        "avg": avg / 1000.0,
        "obp": obp / 1000.0,
        "slg": slg / 1000.0,
        "ops": (obp + slg) / 1000.0,
        "iso": (slg - avg) / 1000.0,
        "babip": rate("hits - home_runs", "at_bats - strikeouts - home_runs + sacrifice_flies", 3),
        "xr": F.floor(F.expr(f"(({zero(runs)}) + 5) / 10.0")).cast("double") / 100.0,
    }


def pitching(constant: str = "310") -> dict[str, Column]:
    """era, whip, k_per_nine, bb_per_nine, kbb and fip; ``constant`` is that of fip in hundredths."""
    outs = "innings_outs"
    return {
        "era": rate("27 * earned_runs", outs, 2),
        "whip": rate("3 * (walks_allowed + hits_allowed)", outs, 2),
        "k_per_nine": rate("27 * strikeouts", outs, 2),
        "bb_per_nine": rate("27 * walks_allowed", outs, 2),
        "kbb": F.coalesce(rate("strikeouts", "walks_allowed", 2, None), F.expr("CAST(coalesce(strikeouts, 0) AS DOUBLE)")),
        "fip": rate(f"100 * 3 * (13 * home_runs_allowed + 3 * (walks_allowed + hit_batters) - 2 * strikeouts) + ({constant}) * {outs}", f"100 * {outs}", 2),
    }


def innings(outs: str) -> Column:
    """Outs as innings with one decimal place, half up."""
    return rate(outs, "3", 1)
