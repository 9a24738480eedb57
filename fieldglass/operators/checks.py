"""Rules over stat lines, seasons, games and schedules; each gives the rows that fail.

A rule is a name, a severity and the condition under which a row fails it.  All rules of
a table run in one scan: every row carries the array of those it fails.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rates


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the columns of a row; ``severity`` SQL too, so it may depend on the row."""

    rule_id: str
    fails: str
    severity: str = "'ERROR'"


_N = lambda c: f"coalesce({c}, 0)"
_TB = "hits + doubles + 2 * triples + 3 * home_runs"
_PARTS = " + ".join(_N(c) for c in ("at_bats", "walks", "hbp", "sacrifice_hits", "sacrifice_flies", "other_pa"))
_OFF = f"({_N('plate_appearances')} - ({_PARTS}))"
BATTING = (
    Rule("BAT-001", f"{_N('hits')} > {_N('at_bats')}"),
    Rule("BAT-002", f"{_N('doubles')} + {_N('triples')} + {_N('home_runs')} > {_N('hits')}"),
    Rule("BAT-003", f"total_bases IS NOT NULL AND {_N('hits')} >= {_N('doubles')} + {_N('triples')} + {_N('home_runs')} AND total_bases <> {_TB}"),
    Rule("BAT-004", f"plate_appearances > 0 AND {_OFF} <> 0", f"CASE WHEN abs({_OFF}) > 2 THEN 'ERROR' ELSE 'WARNING' END"),
    Rule("BAT-005", "avg IS NOT NULL AND at_bats > 0 AND abs(avg - CAST(hits AS DOUBLE) / at_bats) > 0.006", "'WARNING'"),
    Rule("BAT-006", "avg IS NOT NULL AND obp IS NOT NULL AND at_bats >= 10 AND obp < avg - 0.015", "'WARNING'"),
)
PITCHING = (
    Rule("PIT-001", f"{_N('earned_runs')} > {_N('runs_allowed')}"),
    Rule("PIT-002", f"tbf > 0 AND {_N('hits_allowed')} > tbf"),
    Rule("PIT-003", f"tbf > 0 AND {_N('walks_allowed')} > tbf"),
    Rule("PIT-004", f"{_N('home_runs_allowed')} > {_N('hits_allowed')}"),
    Rule("PIT-005", "innings_outs IS NOT NULL AND notation_outs IS NOT NULL AND innings_outs <> notation_outs", "'WARNING'"),
)
#: What can be asked for by name.
RULES: dict[str, tuple[Rule, ...]] = {"batting": BATTING, "pitching": PITCHING}


def register(table: str, *rules: Rule) -> None:
    """Add rules to those of a table; a name twice is an error."""
    old = RULES.get(table, ())
    names = {r.rule_id for r in old}
    for r in rules:
        if r.rule_id in names:
            raise ValueError(f"rule {r.rule_id} exists")
        names.add(r.rule_id)
    RULES[table] = (*old, *rules)


def violations(rows: DataFrame, rules: tuple[Rule, ...], keys: list[str]) -> DataFrame:
    """(keys, rule_id, severity) for every rule a row fails; an unknown condition does not fail."""
    failed = F.array_compact(F.array(*[F.when(F.expr(r.fails), F.struct(F.lit(r.rule_id).alias("rule_id"), F.expr(r.severity).alias("severity"))) for r in rules]))
    return rows.select(*keys, F.explode(failed).alias("x")).select(*keys, "x.*")


def quarantine(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows that fail a blocking rule, with the rules and status PENDING; warnings alone do not block."""
    blocking = F.array_compact(F.array(*[F.when(F.expr(r.fails) & (F.expr(r.severity) == "ERROR"), F.lit(r.rule_id)) for r in rules]))
    return rows.withColumn("rules", blocking).where(F.size("rules") > 0).withColumn("rules", F.array_join("rules", ",")).withColumn("status", F.lit("PENDING"))


def notation_outs(text: Column) -> Column:
    """Outs of innings as text: '5.1', '5.33', '5.667', '1/3', '5 1/3'; NULL where it is none of these."""
    t = F.trim(text)
    whole = F.regexp_extract(t, r"^([0-9]+)", 1).try_cast("int")
    part = F.regexp_extract(t, r"^[0-9]+\.([0-9]+)$", 1)
    third = F.when(F.regexp_like(part, F.lit(r"^0*$")), 0).when(part.isin("1", "33", "333"), 1).when(part.isin("2", "67", "667"), 2)
    mixed = F.regexp_extract(t, r"^(?:([0-9]+) )?([12])/3$", 1)
    thirds = F.regexp_extract(t, r"^(?:[0-9]+ )?([12])/3$", 1).try_cast("int")
    return F.when(F.regexp_like(t, F.lit(r"^(?:[0-9]+ )?[12]/3$")), F.coalesce(mixed.try_cast("int"), F.lit(0)) * 3 + thirds).when(F.regexp_like(t, F.lit(r"^[0-9]+(\.[0-9]+)?$")), whole * 3 + third)


def outs_of(column: Column, extra: Column, text: Column) -> Column:
    """Cumulative outs: the column, else the extra field, else the notation (hundredths of thirds, else whole innings)."""
    t = F.trim(text)
    part = F.regexp_extract(t, r"\.([0-9]+)$", 1)
    loose = F.regexp_extract(t, r"^([0-9]+)", 1).try_cast("int") * 3
    third = F.when(part.isin("1", "33"), 1).when(part.isin("2", "67"), 2).otherwise(0)
    return F.coalesce(column, extra, loose + third)


def regression_pack(tables: dict[str, DataFrame], checks: list[tuple[str, str, str, str]], samples: int = 5) -> DataFrame:
    """One row a check: check_id, status, violations and the ``samples`` least different keys in order.

    A check is (id, table, key, SQL of what is wrong).  The checks of a table are
    counted in one scan; of the different keys, each task hands on its least only.
    """
    out = None
    for name, df in tables.items():
        own = [c for c in checks if c[1] == name]
        if not own:
            continue
        wrong = F.array_compact(F.array(*[F.when(F.expr(sql), F.struct(F.lit(i).alias("check_id"), F.col(key).cast("string").alias("key"))) for i, _, key, sql in own]))
        bad = df.select(F.explode(wrong).alias("x")).select("x.*")
        counts = bad.groupBy("check_id").agg(F.count("*").alias("violations"))
        place = F.row_number().over(W.partitionBy("check_id").orderBy("key"))
        least = bad.where("key is not null").distinct().withColumn("place", place).where(F.col("place") <= samples)
        first = least.groupBy("check_id").agg(F.array_join(F.array_sort(F.collect_list("key")), ",").alias("samples"))
        names = df.sparkSession.createDataFrame([(c[0],) for c in own], "check_id string")
        mine = names.join(counts, "check_id", "left").join(first, "check_id", "left").select("check_id", F.coalesce("violations", F.lit(0)).alias("violations"), F.coalesce("samples", F.lit("")).alias("samples"))
        out = mine if out is None else out.unionByName(mine)
    return out.select("check_id", F.when(F.col("violations") > 0, "FAIL").otherwise("PASS").alias("status"), "violations", "samples")


def totals_above(parts: DataFrame, totals: DataFrame, key: str, field: str, least: int, share: float) -> DataFrame:
    """Keys whose sum of parts is above the total by more than ``least`` and more than ``share`` of it; a key without total is an issue."""
    p = parts.where(F.col(key).isNotNull()).groupBy(key).agg(F.coalesce(F.sum(field), F.lit(0)).cast("long").alias("parts"))
    both = p.join(totals.select(key, F.coalesce(field, F.lit(0)).cast("long").alias("total"), F.lit(True).alias("_has")), key, "left")
    off = F.col("parts") - F.col("total")
    issue = F.when(F.col("_has").isNull(), "missing").when((off > least) & (off / F.greatest(F.col("total"), F.lit(1)) > share), "above")
    return both.select(key, "parts", "total", issue.alias("issue")).where("issue is not null")


def team_against_players(teams: DataFrame, players: DataFrame, key: str, fields: list[str], tolerance: int = 5, exempt=()) -> DataFrame:
    """Fields of a team row that differ from its players' sum by more than ``tolerance``.

    A player sum without a value is unavailable, not zero, and a team without
    players is an issue.  Exempt fields are shown and do not block.
    """
    sums = players.groupBy(key).agg(F.lit(True).alias("_has"), *[F.sum(c).cast("long").alias(c) for c in fields])
    a = teams.select(key, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in fields]).unpivot(key, fields, "field", "team_value")
    b = sums.unpivot([key, "_has"], fields, "field", "player_sum")
    both = a.join(b, [key, "field"], "left")
    issue = F.when(F.col("_has").isNull(), "no_players").when(F.abs(F.col("team_value") - F.col("player_sum")) > tolerance, F.when(F.col("field").isin(*exempt), "exempt").otherwise("mismatch"))
    return both.select(key, "field", "team_value", "player_sum", issue.alias("issue")).where("issue is not null")


def second_league_batting(rows: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """player_id, issue: the first impossible count, else rates that differ from the counts."""
    n = _N
    first = (
        F.when(F.expr(f"{n('at_bats')} > {n('plate_appearances')}"), "ab_above_pa")
        .when(F.expr(f"{n('hits')} > {n('at_bats')}"), "hits_above_ab")
        .when(F.expr(f"{n('doubles')} + {n('triples')} + {n('home_runs')} > {n('hits')}"), "extra_base_hits_above_hits")
        .when(F.expr(f"{n('strikeouts')} > {n('plate_appearances')}"), "strikeouts_above_pa")
        .when(F.expr(f"{n('walks')} > {n('plate_appearances')}"), "walks_above_pa")
    )
    slug = f"{n('hits')} + {n('doubles')} + 2 * {n('triples')} + 3 * {n('home_runs')}"
    want = {
        "avg": (rates.rate(n("hits"), n("at_bats"), 3, None), F.lit(True)),
        "obp": (rates.rate(f"{n('hits')} + {n('walks')} + {n('hbp')}", f"{n('at_bats')} + {n('walks')} + {n('hbp')} + {n('sacrifice_flies')}", 3, None), F.col("sacrifice_flies").isNotNull()),
        "slg": (rates.rate(slug, n("at_bats"), 3, None), F.lit(True)),
    }
    off = [F.when(ok & (F.abs(F.col(c) - x) > tolerance + 1e-9), f"{c}_mismatch") for c, (x, ok) in want.items()]
    issues = F.when(first.isNotNull(), F.array(first)).otherwise(F.array_compact(F.array(*off)))
    return rows.select("player_id", F.explode(issues).alias("issue"))


def second_league_pitching(rows: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """The same for pitchers: impossible counts, else era and whip."""
    n = _N
    first = (
        F.when(F.expr(f"{n('earned_runs')} > {n('runs_allowed')}"), "earned_runs_above_runs")
        .when(F.expr(f"{n('wins')} + {n('losses')} + {n('saves')} + {n('holds')} > {n('games')}"), "decisions_above_games")
        .when(F.expr(f"{n('innings_outs')} < 0 OR {n('walks_allowed')} < 0 OR {n('strikeouts')} < 0"), "negative")
    )
    want = {"era": rates.rate(f"27 * {n('earned_runs')}", n("innings_outs"), 2, None), "whip": rates.rate(f"3 * ({n('walks_allowed')} + {n('hits_allowed')})", n("innings_outs"), 2, None)}
    off = [F.when(F.abs(F.col(c) - x) > tolerance + 1e-9, f"{c}_mismatch") for c, x in want.items()]
    issues = F.when(first.isNotNull(), F.array(first)).otherwise(F.array_compact(F.array(*off)))
    return rows.select("player_id", F.explode(issues).alias("issue"))


def standings_integrity(snapshot: DataFrame, games: DataFrame, fields: list[str]) -> DataFrame:
    """A stored table against one recomputed: (date, team, field) missing, extra or mismatch."""
    a = snapshot.select("date", "team", F.struct(*fields).alias("a"))
    b = games.select("date", "team", F.struct(*fields).alias("b"))
    both = a.join(b, ["date", "team"], "full")
    issue = F.when(F.col("a").isNull(), F.array(F.lit("missing"))).when(F.col("b").isNull(), F.array(F.lit("extra"))).otherwise(F.array_compact(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(f"mismatch:{c}")) for c in fields])))
    return both.select("date", "team", F.explode(issue).alias("issue"))


def boxscore_totals(batting: DataFrame, pitching: DataFrame, scoreboard: DataFrame) -> DataFrame:
    """REC-001 strikeouts of both sides, REC-002 and REC-003 runs against the scoreboard, by game."""
    b = batting.groupBy("game_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"b_{c}") for c in ("strikeouts", "runs")])
    p = pitching.groupBy("game_id").agg(F.coalesce(F.sum("strikeouts"), F.lit(0)).cast("long").alias("p_strikeouts"), F.coalesce(F.sum("runs_allowed"), F.lit(0)).cast("long").alias("p_runs"))
    x = b.join(p, "game_id", "full").join(scoreboard, "game_id", "full").na.fill(0, ["b_strikeouts", "b_runs", "p_strikeouts", "p_runs"])
    total = F.col("away_runs") + F.col("home_runs")
    found = F.array_compact(F.array(F.when(F.col("b_strikeouts") != F.col("p_strikeouts"), "REC-001"), F.when(F.col("b_runs") != total, "REC-002"), F.when(F.col("p_runs") != total, "REC-003")))
    return x.select("game_id", F.explode(found).alias("rule_id"))


def coverage_status(observed: DataFrame, contracts: DataFrame, threshold: float = 0.05, least: int = 1) -> DataFrame:
    """table_name, year, status by contract.

    ``observed`` has row_count and null_rate (the highest of the mandatory fields);
    ``contracts`` available_from, available_to and limitations.
    """
    x = observed.join(F.broadcast(contracts.withColumn("_known", F.lit(True))), "table_name", "left")
    status = (
        F.when(F.col("_known").isNull(), F.when(F.col("row_count") > 0, "PASS").otherwise("WARN"))
        .when(F.col("year") < F.col("available_from"), F.when(F.coalesce("limitations", F.lit("")) != "", "KNOWN_LIMITATION").otherwise("NOT_APPLICABLE"))
        .when(F.col("year") > F.col("available_to"), "NOT_APPLICABLE")
        .when(F.col("row_count") < least, "DEFECT")
        .when(F.col("null_rate") > threshold, "DEFECT")
        .otherwise("PASS")
    )
    return x.select("table_name", "year", "row_count", status.alias("status"))


def golden_games(parsed: DataFrame, golden: DataFrame) -> DataFrame:
    """GOL-001 to GOL-004: score, outs, lineup and batting totals against what is known of a game."""
    x = parsed.alias("p").join(golden.alias("g"), "game_id")
    differs = lambda c: F.col(f"p.{c}").isNotNull() & (F.col(f"p.{c}") != F.col(f"g.{c}"))
    score = ((F.col("p.away_score") != F.col("g.away_score")) | (F.col("p.home_score") != F.col("g.home_score"))) & ~((F.col("p.away_score") == -1) & (F.col("p.home_score") == -1))
    lineup = (F.col("p.lineup") > 0) & (F.col("p.lineup") < F.col("g.lineup"))
    found = F.array_compact(F.array(F.when(score, "GOL-001"), F.when(differs("total_outs"), "GOL-002"), F.when(lineup, "GOL-003"), F.when(differs("hits"), "GOL-004")))
    return x.select("game_id", F.explode(found).alias("rule_id"))


# Positions by kind of appearance.
APPEARANCES = {"PH": ("대타", "PH", "PINCH_HITTER"), "PR": ("대주자", "PR", "PINCH_RUNNER"), "DEF_SUB": ("대수비", "DEF", "DEF_SUB", "DEFENSIVE_SUB")}


def appearance_type() -> Column:
    """PITCHER, STARTER, PH, PR, DEF_SUB or OTHER of a lineup row."""
    pos = F.upper(F.trim(F.coalesce("position", F.lit(""))))
    pitcher = pos.isin("P", "투수", "PITCHER") | F.coalesce("batting_order", F.lit(0)).isin(0)
    starter = F.coalesce("is_starter", F.lit(False)) | (F.col("is_starter").isNull() & F.col("batting_order").between(1, 9) & (F.coalesce("appearance_seq", F.lit(1)) == 1))
    kind = F.when(pitcher, "PITCHER").when(starter, "STARTER")
    for name, words in APPEARANCES.items():
        kind = kind.when(pos.isin(*words), name)
    return kind.otherwise("OTHER")


def lineup_violations(lineups: DataFrame, batting: DataFrame, pitching: DataFrame) -> DataFrame:
    """LIN-001 to LIN-003: who should have batted or pitched and did not, by id or by name, in the game."""
    x = lineups.withColumn("type", appearance_type())
    for rows, name in ((batting, "bat"), (pitching, "pit")):
        ids = rows.where("player_id is not null").select("game_id", "player_id", F.lit(True).alias(f"{name}_id")).distinct()
        names = rows.where("coalesce(player_name, '') <> ''").select("game_id", "player_name", F.lit(True).alias(f"{name}_name")).distinct()
        x = x.join(ids, ["game_id", "player_id"], "left").join(names, ["game_id", "player_name"], "left")
        x = x.withColumn(f"has_{name}", F.coalesce(f"{name}_id", f"{name}_name", F.lit(False)))
    rule = (
        F.when(F.col("type").isin("STARTER", "PH"), F.when(~F.col("has_bat"), "LIN-001"))
        .when(F.col("type") == "PITCHER", F.when(~F.col("has_pit"), "LIN-002"))
        .when(~F.col("type").isin("PR", "DEF_SUB") & ~F.col("has_bat") & ~F.col("has_pit"), "LIN-003")
    )
    return x.select("game_id", "player_id", "player_name", "type", rule.alias("rule_id")).where("rule_id is not null")


def reconciled(primary: Column, secondary: Column, third: Column) -> Column:
    """What of a field's three sources counts, how far it is trusted (in tenths) and its status."""
    pick = lambda v, c, s: F.struct(v.cast("string").alias("value"), F.lit(c).alias("confidence"), F.lit(s).alias("status"))
    both = primary.isNotNull() & secondary.isNotNull()
    return (
        F.when(both & (primary == secondary), pick(primary, 10, "RESOLVED"))
        .when(both & third.eqNullSafe(secondary), pick(secondary, 9, "RESOLVED"))
        .when(both & third.eqNullSafe(primary), pick(primary, 9, "RESOLVED"))
        .when(both, pick(primary, 5, "CONFLICT"))
        .when(secondary.isNotNull(), pick(secondary, 8, "RESOLVED"))
        .otherwise(pick(primary, 6, "NO_SECONDARY_DATA"))
    )


def schedule_reason(year: int | None = None, month: int | None = None) -> Column:
    """Why a schedule row is not taken, the first reason only; NULL for a good one.

    Looks at game_id, game_date, away_team_code, home_team_code, game_status and
    stadium; an id is eight digits, letters and one digit.
    """
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    d, i = F.col("game_date"), F.upper(F.trim("game_id"))
    reason = F.when(blank("game_id"), "missing_game_id").when(d.isNull(), "invalid_game_date")
    if year is not None:
        reason = reason.when(F.year(d) != year, "schedule_date_mismatch")
    if month is not None:
        reason = reason.when(F.month(d) != month, "schedule_date_mismatch")
    return (
        reason.when(~i.rlike(r"^[0-9]{8}[A-Z]+[0-9]$"), "invalid_game_id")
        .when(F.substring(i, 1, 8) != F.date_format(d, "yyyyMMdd"), "game_id_date_mismatch")
        .when(blank("away_team_code"), "missing_away_team_code")
        .when(blank("home_team_code"), "missing_home_team_code")
        .when(F.coalesce(~F.upper(F.trim("game_status")).isin("SCHEDULED", "LIVE", "COMPLETED", "DRAW", "CANCELLED", "POSTPONED", "UNRESOLVED_MISSING"), F.lit(True)), "invalid_game_status")
        .when(F.col("stadium").isNull(), "missing_stadium")
    )


def season_payload_reason() -> Column:
    """Why a season row is not taken, in order: identity, season, team, core counts, numbers, consistency."""
    number = lambda c: F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()
    fields = ("plate_appearances", "at_bats", "hits")
    broken = F.lit(False)
    for c in fields:
        broken = broken | number(c)
    value = lambda c: F.coalesce(F.col(c).try_cast("long"), F.lit(0))
    season = F.col("season").try_cast("int")
    return (
        F.when(F.coalesce(F.col("player_id").try_cast("long"), F.lit(0)) <= 0, "invalid_player_id")
        .when(season.isNull() | ~season.between(1982, 2100), "invalid_season")
        .when(F.coalesce(F.trim("team_code"), F.lit("")).isin("", "합계", "TOTAL", "ALL", "-"), "invalid_team_code")
        .when(F.coalesce(*[F.col(c) for c in fields]).isNull(), "empty_core_stats")
        .when(broken, "invalid_numeric_field")
        .when(value("hits") > value("at_bats"), "hits_exceed_at_bats")
        .when(value("at_bats") > value("plate_appearances"), "at_bats_exceed_plate_appearances")
    )


def result_faults(games: DataFrame, children: DataFrame) -> DataFrame:
    """Games whose winner, status or children do not fit: game_id, issue.

    A winner is checked on primary completed or drawn games with a decided score; a
    past game needs a terminal or unresolved status; a completed one a child row.
    """
    has = children.select("game_id", F.lit(True).alias("_child")).distinct()
    x = games.join(has, "game_id", "left")
    done = F.col("status").isin("COMPLETED", "DRAW")
    better = F.when(F.col("home_score") > F.col("away_score"), F.col("home")).otherwise(F.col("away"))
    wrong = F.col("is_primary") & done & (F.coalesce(F.trim("winner"), F.lit("")) != "") & (F.col("home_score") != F.col("away_score")) & (F.col("winner") != better)
    open_ = F.col("is_past") & ~F.coalesce(F.col("status").isin("COMPLETED", "DRAW", "CANCELLED", "POSTPONED", "UNRESOLVED_MISSING"), F.lit(False))
    found = F.array_compact(F.array(F.when(wrong, "winner_mismatch"), F.when(open_, "not_terminal"), F.when(done & F.col("_child").isNull(), "no_children")))
    return x.select("game_id", F.explode(found).alias("issue"))
