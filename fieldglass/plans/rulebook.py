"""Rule packs on stat lines, seasons, games and schedules made of the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rates
from ..operators import checks, season
from ..registry import Tables, query
from .core import _GAMES, _ROLES, _games
from .league import BAT, DEC, PIT, RATE, SUMS, bat, pit

_OFF = "(plate_appearances - (at_bats + walks + hbp + sacrifice_hits + sacrifice_flies + other_pa))"
_BX = "x AS (SELECT *, CASE WHEN game_id % 4 = 0 THEN NULL ELSE hits + doubles + 2 * triples + 3 * home_runs + CASE WHEN game_id % 60 = 1 THEN 1 ELSE 0 END END AS total_bases, CASE WHEN game_id % 100 = 7 THEN 2 WHEN game_id % 100 = 8 THEN 1 ELSE 0 END AS other_pa, ((hits * 100 + player_id % 5) // (at_bats + 1))::DOUBLE / 100 AS avg, (game_id % 40)::DOUBLE / 100 AS obp FROM bat)"
_BRULES = [
    ("BAT-001", "hits > at_bats", "'ERROR'"),
    ("BAT-002", "doubles + triples + home_runs > hits", "'ERROR'"),
    ("BAT-003", "hits >= doubles + triples + home_runs AND total_bases <> hits + doubles + 2 * triples + 3 * home_runs", "'ERROR'"),
    ("BAT-004", f"plate_appearances > 0 AND {_OFF} <> 0", f"CASE WHEN {_OFF} BETWEEN -2 AND 2 THEN 'WARNING' ELSE 'ERROR' END"),
    ("BAT-005", "at_bats > 0 AND abs(avg - hits::DOUBLE / at_bats) > 0.006", "'WARNING'"),
    ("BAT-006", "at_bats >= 10 AND obp < avg - 0.015", "'WARNING'"),
]


def _all(rules, keys: str, table: str = "x") -> str:
    return " UNION ALL ".join(f"SELECT {keys}, '{n}' AS rule_id, {s} AS severity FROM {table} WHERE {c}" for n, c, s in rules)


def _batting(t: Tables):
    g = F.col("game_id") % 100
    tb = F.expr("hits + doubles + 2 * triples + 3 * home_runs + CASE WHEN game_id % 60 = 1 THEN 1 ELSE 0 END")
    x = bat(t).withColumn("total_bases", F.when(F.col("game_id") % 4 != 0, tb)).withColumn("other_pa", F.when(g == 7, 2).when(g == 8, 1).otherwise(0))
    return x.withColumn("avg", F.expr("CAST((hits * 100 + player_id % 5) div (at_bats + 1) AS DOUBLE) / 100")).withColumn("obp", F.expr("CAST(game_id % 40 AS DOUBLE) / 100"))


@query("v02_batting_rules", f"WITH {BAT}, {_BX} {_all(_BRULES, 'game_id, player_id')}")
def v02(t: Tables):
    return checks.violations(_batting(t), checks.BATTING, ["game_id", "player_id"])


_NOTE = "CASE WHEN game_id % 9 = 0 THEN NULL WHEN game_id % 9 = 1 THEN (innings_outs // 3)::VARCHAR || ' ' || (innings_outs % 3)::VARCHAR || '/3' WHEN game_id % 9 = 2 THEN (innings_outs // 3)::VARCHAR || CASE innings_outs % 3 WHEN 0 THEN '' WHEN 1 THEN '.33' ELSE '.67' END WHEN game_id % 9 = 3 THEN 'x' ELSE (innings_outs // 3)::VARCHAR || '.' || (innings_outs % 3 + CASE WHEN game_id % 30 = 4 THEN 1 ELSE 0 END)::VARCHAR END"
_PARSED = r"CASE WHEN regexp_matches(ip, '^(?:[0-9]+ )?[12]/3$') THEN coalesce(TRY_CAST(regexp_extract(ip, '^([0-9]+) ', 1) AS INT), 0) * 3 + TRY_CAST(regexp_extract(ip, '([12])/3$', 1) AS INT) WHEN regexp_matches(ip, '^[0-9]+(\.[0-9]+)?$') THEN TRY_CAST(regexp_extract(ip, '^([0-9]+)', 1) AS INT) * 3 + CASE WHEN regexp_matches(regexp_extract(ip, '\.([0-9]+)$', 1), '^0*$') THEN 0 WHEN regexp_extract(ip, '\.([0-9]+)$', 1) IN ('1', '33', '333') THEN 1 WHEN regexp_extract(ip, '\.([0-9]+)$', 1) IN ('2', '67', '667') THEN 2 END END"
_PX = f"y AS (SELECT *, {_NOTE} AS ip FROM pit), x AS (SELECT *, {_PARSED} AS outs2 FROM y)"
_PRULES = [
    ("PIT-001", "earned_runs > runs_allowed", "'ERROR'"),
    ("PIT-002", "tbf > 0 AND hits_allowed > tbf", "'ERROR'"),
    ("PIT-003", "tbf > 0 AND coalesce(walks_allowed, 0) > tbf", "'ERROR'"),
    ("PIT-004", "home_runs_allowed > hits_allowed", "'ERROR'"),
    ("PIT-005", "innings_outs <> outs2", "'WARNING'"),
]


def _pitching(t: Tables):
    third = "CAST(innings_outs % 3 AS STRING)"
    whole = "CAST(innings_outs div 3 AS STRING)"
    ip = F.expr(f"CASE WHEN game_id % 9 = 0 THEN NULL WHEN game_id % 9 = 1 THEN concat({whole}, ' ', {third}, '/3') WHEN game_id % 9 = 2 THEN concat({whole}, CASE innings_outs % 3 WHEN 0 THEN '' WHEN 1 THEN '.33' ELSE '.67' END) WHEN game_id % 9 = 3 THEN 'x' ELSE concat({whole}, '.', CAST(innings_outs % 3 + CASE WHEN game_id % 30 = 4 THEN 1 ELSE 0 END AS STRING)) END")
    return pit(t).withColumn("ip", ip).withColumn("notation_outs", checks.notation_outs(F.col("ip")))


@query("v03_pitching_rules", f"WITH {PIT}, {_PX} {_all(_PRULES, 'game_id, player_id')}")
def v03(t: Tables):
    return checks.violations(_pitching(t), checks.PITCHING, ["game_id", "player_id"])


@query("r08_notation_outs", f"WITH {PIT}, {_PX} SELECT game_id, player_id, ip, outs2 AS outs FROM x")
def r08(t: Tables):
    """Outs of innings in any of their notations."""
    return _pitching(t).select("game_id", "player_id", "ip", F.col("notation_outs").alias("outs"))


@query("v04_rules_by_name", f"WITH {BAT}, {_BX}, {PIT}, {_PX.replace('x AS', 'z AS').replace('y AS', 'y AS')} SELECT 'batting' AS tab, rule_id, count(*) AS n FROM ({_all(_BRULES, 'game_id')}) GROUP BY 2 UNION ALL SELECT 'pitching', rule_id, count(*) FROM ({_all(_PRULES, 'game_id', 'z')}) GROUP BY 2")
def v04(t: Tables):
    """Rules looked up in the registry by table."""
    out = None
    for name, rows in (("batting", _batting(t)), ("pitching", _pitching(t))):
        one = checks.violations(rows, checks.RULES[name], ["game_id"]).groupBy(F.lit(name).alias("tab"), "rule_id").agg(F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("v16_quarantined_lines", f"WITH {BAT}, {_BX}, f AS ({_all(_BRULES, 'game_id, player_id, other_pa, at_bats, hits, plate_appearances')}), k AS (SELECT game_id, player_id, at_bats, hits, plate_appearances, ({' , '.join(f'CASE WHEN {c} AND {s} = {chr(39)}ERROR{chr(39)} THEN {chr(39)}{n}{chr(39)} END' for n, c, s in _BRULES)}) AS r FROM x) SELECT game_id, player_id, at_bats, hits, plate_appearances, concat_ws(',', {', '.join(f'r[{i + 1}]' for i in range(len(_BRULES)))}) AS rules, 'PENDING' AS status FROM k WHERE concat_ws(',', {', '.join(f'r[{i + 1}]' for i in range(len(_BRULES)))}) <> ''")
def v16(t: Tables):
    """Rows that fail a rule that blocks; warnings do not."""
    return checks.quarantine(_batting(t), checks.BATTING).select("game_id", "player_id", "at_bats", "hits", "plate_appearances", "rules", "status")


_CHECKS = [
    ("pa_formula", "bat", "player_id", "plate_appearances <> at_bats + walks + hbp + sacrifice_hits + sacrifice_flies"),
    ("hits_above_ab", "bat", "player_id", "hits > at_bats"),
    ("batter_missing", "bat", "game_id", "player_id IS NULL"),
    ("hits_above_pa", "bat", "player_id", "hits > plate_appearances"),
    ("walks_above_pa", "bat", "player_id", "walks > plate_appearances"),
    ("er_above_runs", "pit", "player_id", "earned_runs > runs_allowed"),
    ("pitcher_missing", "pit", "game_id", "player_id IS NULL"),
    ("outs_above_27", "pit", "game_id", "innings_outs > 20"),
    ("era_range", "pit", "player_id", "innings_outs > 0 AND 27 * earned_runs > 99 * innings_outs"),
    ("game_missing", "pit", "player_id", "game_id IS NULL"),
]


@query(
    "v01_invariants",
    f"WITH {BAT}, {PIT} "
    + " UNION ALL ".join(f"SELECT '{i}' AS check_id, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status, count(*) AS violations, coalesce(array_to_string(list_sort(list(DISTINCT k))[1:5], ','), '') AS samples FROM (SELECT {k}::VARCHAR AS k FROM {tab} WHERE {c})" for i, tab, k, c in _CHECKS),
)
def v01(t: Tables):
    """Ten invariants, each with its status, count and least keys in order of their text."""
    return checks.regression_pack({"bat": bat(t), "pit": pit(t)}, _CHECKS)


@query("v05_appearances_above_season", f"WITH {BAT}, p AS (SELECT player_id, sum(plate_appearances)::BIGINT AS parts FROM bat WHERE player_id IS NOT NULL GROUP BY 1), s AS (SELECT player_id, parts - CASE WHEN player_id % 5 = 0 THEN 3 WHEN player_id % 5 = 1 THEN 2 WHEN player_id % 5 = 2 THEN -9 ELSE 0 END AS total FROM p WHERE player_id % 7 <> 0) SELECT player_id, parts, total, CASE WHEN s.player_id IS NULL THEN 'missing' ELSE 'above' END AS issue FROM p LEFT JOIN s USING (player_id) WHERE s.player_id IS NULL OR (parts - total > 2 AND (parts - total)::DOUBLE / greatest(total, 1) > 0.005)")
def v05(t: Tables):
    """Only games above the season count, beyond two tolerances; a season that is missing is an issue of its own."""
    own = bat(t)
    off = F.when(F.col("player_id") % 5 == 0, 3).when(F.col("player_id") % 5 == 1, 2).when(F.col("player_id") % 5 == 2, -9).otherwise(0)
    totals = own.where("player_id is not null and player_id % 7 <> 0").groupBy("player_id").agg(F.sum("plate_appearances").alias("s")).select("player_id", (F.col("s") - off).alias("plate_appearances"))
    return checks.totals_above(own, totals, "player_id", "plate_appearances", 2, 0.005)


@query(
    "v06_outs_above_season",
    f"WITH {PIT}, p AS (SELECT player_id, sum(innings_outs)::BIGINT AS parts FROM pit WHERE player_id IS NOT NULL GROUP BY 1), s AS (SELECT player_id, CASE player_id % 3 WHEN 0 THEN parts - 40 WHEN 1 THEN parts - 1 ELSE parts - parts // 20 END AS total FROM p) SELECT player_id, parts, total, 'above' AS issue FROM p JOIN s USING (player_id) WHERE parts - total > 3 AND (parts - total)::DOUBLE / greatest(total, 1) > 0.01",
)
def v06(t: Tables):
    """Season outs from the column, else the extra field, else the notation."""
    own = pit(t)
    s = own.where("player_id is not null").groupBy("player_id").agg(F.sum("innings_outs").alias("s"))
    k, n = F.col("player_id") % 3, F.expr("s - s div 20")
    text = F.concat((F.expr("(s - s div 20) div 3")).cast("string"), F.lit("."), (n % 3).cast("string"))
    outs = checks.outs_of(F.when(k == 0, F.col("s") - 40), F.when(k == 1, F.col("s") - 1), text)
    return checks.totals_above(own, s.select("player_id", outs.alias("innings_outs")), "player_id", "innings_outs", 3, 0.01)


@query("v07_pa_formula", f"WITH {BAT}, s AS (SELECT player_id, sum(plate_appearances)::BIGINT AS actual_pa, sum(at_bats + walks + hbp + sacrifice_hits + sacrifice_flies)::BIGINT AS expected_pa FROM bat WHERE player_id IS NOT NULL GROUP BY 1) SELECT *, actual_pa - expected_pa AS difference FROM s WHERE actual_pa <> expected_pa")
def v07(t: Tables):
    parts = ("at_bats", "walks", "hbp", "sacrifice_hits", "sacrifice_flies")
    s = bat(t).where("player_id is not null").groupBy("player_id").agg(F.coalesce(F.sum("plate_appearances"), F.lit(0)).alias("actual_pa"), *season.sums(parts))
    return s.select("player_id", "actual_pa", F.expr(" + ".join(parts)).alias("expected_pa")).where("actual_pa <> expected_pa").withColumn("difference", F.col("actual_pa") - F.col("expected_pa"))


_TEAM = [c for c in season.BATTING]


@query(
    "v08_team_fields",
    f"WITH {BAT}, p AS (SELECT team_code, {', '.join(f'sum({c})::BIGINT AS {c}' for c in _TEAM)} FROM bat WHERE team_code <> 'T9' GROUP BY 1), q AS (SELECT team_code, {SUMS(_TEAM)} FROM bat GROUP BY 1), k AS (SELECT * REPLACE (hits + CASE team_code WHEN 'T1' THEN 5 WHEN 'T2' THEN 6 ELSE 0 END AS hits, stolen_bases + CASE team_code WHEN 'T3' THEN 9 ELSE 0 END AS stolen_bases) FROM q), "
    f"a AS (UNPIVOT k ON {', '.join(_TEAM)} INTO NAME field VALUE team_value), b AS (UNPIVOT p ON {', '.join(_TEAM)} INTO NAME field VALUE player_sum) SELECT team_code, field, team_value, player_sum, CASE WHEN team_code = 'T9' THEN 'no_players' WHEN field IN ('stolen_bases', 'caught_stealing') THEN 'exempt' ELSE 'mismatch' END AS issue FROM a LEFT JOIN b USING (team_code, field) WHERE team_code = 'T9' OR abs(team_value - player_sum) > 5",
)
def v08(t: Tables):
    """All 17 fields; stolen bases and runners caught are shown and do not block."""
    own = bat(t)
    teams = own.groupBy("team_code").agg(*season.sums(_TEAM))
    c = F.col("team_code")
    teams = teams.withColumn("hits", F.col("hits") + F.when(c == "T1", 5).when(c == "T2", 6).otherwise(0)).withColumn("stolen_bases", F.col("stolen_bases") + F.when(c == "T3", 9).otherwise(0))
    return checks.team_against_players(teams, own.where("team_code <> 'T9'"), "team_code", _TEAM, exempt=("stolen_bases", "caught_stealing"))


_V9 = [("avg", RATE("hits", "at_bats", 3, "NULL"), "TRUE"), ("obp", RATE("hits + walks + hbp", "at_bats + walks + hbp + coalesce(sf, 0)", 3, "NULL"), "sf IS NOT NULL"), ("slg", RATE("hits + doubles + 2 * triples + 3 * home_runs", "at_bats", 3, "NULL"), "TRUE")]
_V9FIRST = "CASE WHEN at_bats > plate_appearances THEN 'ab_above_pa' WHEN hits > at_bats THEN 'hits_above_ab' WHEN doubles + triples + home_runs > hits THEN 'extra_base_hits_above_hits' WHEN so > plate_appearances THEN 'strikeouts_above_pa' WHEN walks > plate_appearances THEN 'walks_above_pa' END"


@query(
    "v09_second_league_batting",
    f"WITH {BAT}, x AS (SELECT *, CASE WHEN game_id % 6 = 0 THEN NULL ELSE sacrifice_flies END AS sf, strikeouts * 4 AS so, (game_id % 11)::DOUBLE / 20 AS avg0, (game_id % 9)::DOUBLE / 10 AS obp0, (game_id % 13)::DOUBLE / 4 AS slg0 FROM bat), f AS (SELECT *, {_V9FIRST} AS first FROM x) SELECT game_id, player_id, first AS issue FROM f WHERE first IS NOT NULL"
    + "".join(f" UNION ALL SELECT game_id, player_id, '{c}_mismatch' FROM f WHERE first IS NULL AND {ok} AND abs({c}0 - {x}) > 0.005 + 1e-9" for c, x, ok in _V9),
)
def v09(t: Tables):
    """The first impossible count ends the check of a row; without one, rates are held against counts."""
    g = F.col("game_id")
    x = bat(t).withColumn("sacrifice_flies", F.when(g % 6 != 0, F.col("sacrifice_flies"))).withColumn("strikeouts", F.col("strikeouts") * 4)
    x = x.withColumn("avg", (g % 11).cast("double") / 20).withColumn("obp", (g % 9).cast("double") / 10).withColumn("slg", (g % 13).cast("double") / 4).withColumn("pair", F.struct("game_id", "player_id"))
    return checks.second_league_batting(x.drop("player_id").withColumnRenamed("pair", "player_id")).select("player_id.game_id", "player_id.player_id", "issue")


@query(
    "v09_second_league_pitching",
    f"WITH {PIT}, s AS (SELECT season, player_id, count(*) AS games, {DEC}, {SUMS(season.PITCHING)} FROM pit WHERE player_id IS NOT NULL GROUP BY ALL), x AS (SELECT *, {RATE('27 * earned_runs', 'innings_outs', 2, 'NULL')} AS e, {RATE('3 * (walks_allowed + hits_allowed)', 'innings_outs', 2, 'NULL')} AS w, {RATE('27 * earned_runs', 'innings_outs', 2, 'NULL')} + (player_id % 4) / 100.0::DOUBLE AS era, {RATE('3 * (walks_allowed + hits_allowed)', 'innings_outs', 2, 'NULL')} - (season % 4) / 100.0::DOUBLE AS whip, CASE WHEN player_id % 10 = 0 THEN -1 ELSE strikeouts END AS so FROM s), f AS (SELECT *, CASE WHEN earned_runs > runs_allowed THEN 'earned_runs_above_runs' WHEN wins + losses + saves + holds > games - player_id % 3 * 1000 THEN 'decisions_above_games' WHEN so < 0 THEN 'negative' END AS first FROM x) SELECT season, player_id, first AS issue FROM f WHERE first IS NOT NULL UNION ALL SELECT season, player_id, 'era_mismatch' FROM f WHERE first IS NULL AND abs(era - e) > 0.01 + 1e-9 UNION ALL SELECT season, player_id, 'whip_mismatch' FROM f WHERE first IS NULL AND abs(whip - w) > 0.01 + 1e-9",
)
def v09_pitching(t: Tables):
    s = season.pitching(pit(t), ["season", "player_id"])
    p = F.col("player_id")
    x = s.withColumn("era", F.when(F.col("innings_outs") > 0, F.col("era") + (p % 4) / F.lit(100.0))).withColumn("whip", F.when(F.col("innings_outs") > 0, F.col("whip") - (F.col("season") % 4) / F.lit(100.0)))
    x = x.withColumn("strikeouts", F.when(p % 10 == 0, -1).otherwise(F.col("strikeouts"))).withColumn("games", F.col("games") - p % 3 * 1000).withColumn("pair", F.struct("season", "player_id"))
    return checks.second_league_pitching(x.drop("player_id").withColumnRenamed("pair", "player_id")).select("player_id.season", "player_id.player_id", "issue")


_FIELDS = ["wins", "losses", "draws"]


@query(
    "v10_standings_integrity",
    _GAMES
    + ", l AS (SELECT date, team, wins, losses, draws FROM (SELECT *, row_number() OVER (PARTITION BY date, team ORDER BY game DESC, is_home DESC) AS rn FROM f) WHERE rn = 1), st AS (SELECT date, team, wins + CASE WHEN team = 3 THEN 1 ELSE 0 END AS wins, losses, draws - CASE WHEN team = 4 THEN 1 ELSE 0 END AS draws FROM l WHERE team <> 5 UNION ALL SELECT date, team + 100, wins, losses, draws FROM l WHERE team = 6) "
    "SELECT date, team, CASE WHEN st.wins IS NULL THEN 'missing' WHEN l.wins IS NULL THEN 'extra' WHEN st.wins <> l.wins THEN 'mismatch:wins' ELSE 'mismatch:draws' END AS issue FROM st FULL JOIN l USING (date, team) WHERE st.wins IS NULL OR l.wins IS NULL OR st.wins <> l.wins OR st.draws <> l.draws",
)
def v10(t: Tables):
    """A stored table against the games; teams left out, added and changed."""
    from ..operators import standings

    f = standings.form(_games(t), _ROLES)
    own = f.groupBy("date", "team").agg(*[F.max_by(c, F.struct("game", "is_home")).alias(c) for c in _FIELDS])
    team = F.col("team")
    stored = own.where(team != 5).select("date", "team", (F.col("wins") + F.when(team == 3, 1).otherwise(0)).alias("wins"), "losses", (F.col("draws") - F.when(team == 4, 1).otherwise(0)).alias("draws"))
    stored = stored.unionByName(own.where(team == 6).withColumn("team", team + 100))
    return checks.standings_integrity(stored, own, _FIELDS)


@query("v11_boxscore_totals", f"WITH {BAT}, {PIT}, b AS (SELECT game_id, sum(strikeouts)::BIGINT AS so, sum(runs)::BIGINT AS r FROM bat GROUP BY 1), p AS (SELECT game_id, sum(strikeouts)::BIGINT AS so, sum(runs_allowed)::BIGINT AS r FROM pit GROUP BY 1), s AS (SELECT o_orderkey AS game_id, o_orderkey % 3 + o_custkey % 4 AS total FROM orders), x AS (SELECT game_id, coalesce(b.so, 0) AS bs, coalesce(p.so, 0) AS ps, coalesce(b.r, 0) AS br, coalesce(p.r, 0) AS pr, total FROM b FULL JOIN p USING (game_id) FULL JOIN s USING (game_id)) SELECT game_id, 'REC-001' AS rule_id FROM x WHERE bs <> ps UNION ALL SELECT game_id, 'REC-002' FROM x WHERE br <> total UNION ALL SELECT game_id, 'REC-003' FROM x WHERE pr <> total")
def v11(t: Tables):
    board = t.orders.select(F.col("o_orderkey").alias("game_id"), (F.col("o_orderkey") % 3).alias("away_runs"), (F.col("o_custkey") % 4).alias("home_runs"))
    return checks.boxscore_totals(bat(t), pit(t), board)


_CON = [("game_batting", 1994, 1997, None), ("game_events", 1996, None, "no relay before"), ("game_pitching", None, 1996, None)]


@query(
    "v12_coverage_contracts",
    "WITH o AS (SELECT CASE o_custkey % 4 WHEN 0 THEN 'game_batting' WHEN 1 THEN 'game_events' WHEN 2 THEN 'game_pitching' ELSE 'other' END AS table_name, year(o_orderdate)::BIGINT AS year, count(*) FILTER (o_orderpriority <> '5-LOW') AS row_count, (count(*) FILTER (o_orderstatus = 'P'))::DOUBLE / count(*) AS null_rate FROM orders GROUP BY 1, 2), "
    "c AS (SELECT * FROM (VALUES ('game_batting', 1994, 1997, NULL), ('game_events', 1996, NULL, 'no relay before'), ('game_pitching', NULL, 1996, NULL)) v(table_name, lo, hi, lim)) "
    "SELECT table_name, year, row_count, CASE WHEN c.table_name IS NULL THEN CASE WHEN row_count > 0 THEN 'PASS' ELSE 'WARN' END WHEN year < lo THEN CASE WHEN coalesce(lim, '') <> '' THEN 'KNOWN_LIMITATION' ELSE 'NOT_APPLICABLE' END WHEN year > hi THEN 'NOT_APPLICABLE' WHEN row_count < 20 THEN 'DEFECT' WHEN null_rate > 0.05 THEN 'DEFECT' ELSE 'PASS' END AS status FROM o LEFT JOIN c USING (table_name)",
)
def v12(t: Tables):
    k = F.col("o_custkey") % 4
    name = F.when(k == 0, "game_batting").when(k == 1, "game_events").when(k == 2, "game_pitching").otherwise("other")
    seen = t.orders.groupBy(name.alias("table_name"), F.year("o_orderdate").cast("long").alias("year")).agg(F.count_if(F.col("o_orderpriority") != "5-LOW").alias("row_count"), (F.count_if(F.col("o_orderstatus") == "P").cast("double") / F.count("*")).alias("null_rate"))
    contracts = t.spark.createDataFrame(_CON, "table_name string, available_from int, available_to int, limitations string")
    return checks.coverage_status(seen, contracts, least=20)


@query(
    "v13_golden_games",
    f"WITH {BAT}, {PIT}, b AS (SELECT game_id, sum(hits)::BIGINT AS hits, count(*) AS lineup FROM bat GROUP BY 1), p AS (SELECT game_id, sum(innings_outs)::BIGINT AS outs FROM pit GROUP BY 1), g AS (SELECT o_orderkey AS game_id, o_custkey % 5 AS a, o_custkey % 3 AS h FROM orders WHERE o_orderkey % 10 = 1), x AS (SELECT game_id, a + CASE WHEN game_id % 20 = 1 THEN 1 ELSE 0 END AS pa, CASE WHEN game_id % 30 = 1 THEN -1 ELSE 0 END AS m, a, h, outs, CASE WHEN game_id % 40 = 1 THEN NULL ELSE outs END AS po, lineup, hits FROM g JOIN b USING (game_id) JOIN p USING (game_id)) SELECT game_id, 'GOL-001' AS rule_id FROM x WHERE m = 0 AND pa <> a UNION ALL SELECT game_id, 'GOL-002' FROM x WHERE po <> outs + game_id % 4 UNION ALL SELECT game_id, 'GOL-003' FROM x WHERE lineup < 3 UNION ALL SELECT game_id, 'GOL-004' FROM x WHERE hits <> hits + game_id % 5",
)
def v13(t: Tables):
    """Known games against what was parsed of them; an unknown score of -1 to -1 is not compared."""
    g = F.col("game_id")
    games = t.orders.where("o_orderkey % 10 = 1").select(F.col("o_orderkey").alias("game_id"), (F.col("o_custkey") % 5).alias("away_score"), (F.col("o_custkey") % 3).alias("home_score"))
    b = bat(t).groupBy("game_id").agg(F.sum("hits").alias("hits"), F.count("*").alias("lineup"))
    p = pit(t).groupBy("game_id").agg(F.sum("innings_outs").alias("total_outs"))
    own = games.join(b, "game_id").join(p, "game_id")
    golden = own.select("game_id", "away_score", "home_score", (F.col("total_outs") + g % 4).alias("total_outs"), F.lit(3).alias("lineup"), (F.col("hits") + g % 5).alias("hits"))
    none = g % 30 == 1
    parsed = own.select("game_id", F.when(none, -1).otherwise(F.col("away_score") + F.when(g % 20 == 1, 1).otherwise(0)).alias("away_score"), F.when(none, -1).otherwise(F.col("home_score")).alias("home_score"), F.when(g % 40 != 1, F.col("total_outs")).alias("total_outs"), "lineup", "hits")
    return checks.golden_games(parsed, golden)


_LU = "SELECT l_orderkey AS game_id, CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE l_partkey END AS player_id, 'P' || (l_partkey % 50)::VARCHAR AS player_name, CASE l_suppkey % 8 WHEN 0 THEN 'P' WHEN 1 THEN 'ph' WHEN 2 THEN '대주자' WHEN 3 THEN 'DEF' WHEN 4 THEN NULL ELSE 'SS' END AS position, CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 7 THEN 0 ELSE l_linenumber END AS batting_order, CASE l_suppkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_starter, (1 + l_suppkey % 2)::INT AS seq FROM lineitem"


@query(
    "v14_lineup_rules",
    f"WITH l AS ({_LU}), b AS (SELECT l_orderkey AS game_id, l_partkey AS player_id, 'P' || ((l_partkey + 1) % 50)::VARCHAR AS player_name FROM lineitem WHERE l_returnflag = 'A'), p AS (SELECT l_orderkey AS game_id, l_partkey AS player_id, 'P' || (l_partkey % 50)::VARCHAR AS player_name FROM lineitem WHERE l_returnflag = 'R'), "
    "y AS (SELECT *, CASE WHEN upper(coalesce(position, '')) IN ('P', '투수', 'PITCHER') OR coalesce(batting_order, 0) = 0 THEN 'PITCHER' WHEN coalesce(is_starter, false) OR (is_starter IS NULL AND batting_order BETWEEN 1 AND 9 AND seq = 1) THEN 'STARTER' WHEN upper(position) = 'PH' THEN 'PH' WHEN position = '대주자' THEN 'PR' WHEN upper(position) = 'DEF' THEN 'DEF_SUB' ELSE 'OTHER' END AS type, EXISTS (SELECT 1 FROM b WHERE b.game_id = l.game_id AND b.player_id = l.player_id) OR EXISTS (SELECT 1 FROM b WHERE b.game_id = l.game_id AND b.player_name = l.player_name) AS hb, EXISTS (SELECT 1 FROM p WHERE p.game_id = l.game_id AND p.player_id = l.player_id) OR EXISTS (SELECT 1 FROM p WHERE p.game_id = l.game_id AND p.player_name = l.player_name) AS hp FROM l), "
    "z AS (SELECT *, CASE WHEN type IN ('STARTER', 'PH') THEN CASE WHEN NOT hb THEN 'LIN-001' END WHEN type = 'PITCHER' THEN CASE WHEN NOT hp THEN 'LIN-002' END WHEN type = 'OTHER' AND NOT hb AND NOT hp THEN 'LIN-003' END AS rule_id FROM y) SELECT game_id, player_id, player_name, type, rule_id FROM z WHERE rule_id IS NOT NULL",
)
def v14(t: Tables):
    l = t.lineitem.selectExpr(  # noqa: E741
        "l_orderkey AS game_id", "CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE l_partkey END AS player_id", "concat('P', l_partkey % 50) AS player_name",
        "CASE l_suppkey % 8 WHEN 0 THEN 'P' WHEN 1 THEN 'ph' WHEN 2 THEN '대주자' WHEN 3 THEN 'DEF' WHEN 4 THEN NULL ELSE 'SS' END AS position",
        "CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 7 THEN 0 ELSE l_linenumber END AS batting_order", "CASE l_suppkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_starter", "1 + l_suppkey % 2 AS appearance_seq",
    )
    who = lambda flag, k: t.lineitem.where(F.col("l_returnflag") == flag).selectExpr("l_orderkey AS game_id", "l_partkey AS player_id", f"concat('P', (l_partkey + {k}) % 50) AS player_name")
    return checks.lineup_violations(l, who("A", 1), who("R", 0))


_3 = "SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 4 END AS a, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 3 END AS b, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 2 END AS c FROM events"


@query("v15_three_sources", f"WITH s AS ({_3}) SELECT event_id, (CASE WHEN a = b THEN a WHEN a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND c = b THEN b WHEN a IS NULL AND b IS NOT NULL THEN b ELSE a END)::VARCHAR AS value, (CASE WHEN a = b THEN 10 WHEN a IS NOT NULL AND b IS NOT NULL THEN CASE WHEN c = b OR c = a THEN 9 ELSE 5 END WHEN b IS NOT NULL THEN 8 ELSE 6 END)::INT AS confidence, CASE WHEN a <> b AND coalesce(c NOT IN (a, b), true) THEN 'CONFLICT' WHEN b IS NULL THEN 'NO_SECONDARY_DATA' ELSE 'RESOLVED' END AS status FROM s")
def v15(t: Tables):
    """Agreement, arbitration by the third source, one source alone, conflict."""
    s = t.events.selectExpr("event_id", "CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 4 END AS a", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 3 END AS b", "CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 2 END AS c")
    return s.select("event_id", checks.reconciled(F.col("a"), F.col("b"), F.col("c")).alias("x")).select("event_id", "x.*")


_SCH = {
    "game_id": "CASE WHEN o_orderkey % 23 = 0 THEN ' ' WHEN o_orderkey % 23 = 1 THEN concat('19960101', 'LGOB', '00') ELSE concat({d}, 'LGOB', CAST(o_orderkey % 2 AS STRING)) END",
    "game_date": "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END",
    "away_team_code": "CASE WHEN o_custkey % 31 = 0 THEN '' ELSE 'LG' END",
    "home_team_code": "CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE 'OB' END",
    "game_status": "CASE o_custkey % 5 WHEN 0 THEN 'scheduled' WHEN 1 THEN 'COMPLETED' WHEN 2 THEN 'Draw' WHEN 3 THEN 'LIVE' ELSE CASE WHEN o_custkey % 2 = 0 THEN 'unknown' ELSE NULL END END",
    "stadium": "CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE 'S' END",
}


def _schedule(day: str) -> str:
    return ", ".join(f"{e.format(d=day)} AS {c}" for c, e in _SCH.items())


@query(
    "v17_schedule_rows",
    f"WITH s AS (SELECT o_orderkey, {_schedule(chr(115) + chr(116) + chr(114) + 'ftime(o_orderdate + to_days((CASE WHEN o_orderkey % 41 = 0 THEN 1 ELSE 0 END)), ' + chr(39) + '%Y%m%d' + chr(39) + ')')} FROM orders) SELECT o_orderkey, CASE WHEN trim(game_id) = '' THEN 'missing_game_id' WHEN game_date IS NULL THEN 'invalid_game_date' WHEN year(game_date) <> 1996 THEN 'schedule_date_mismatch' WHEN NOT regexp_matches(upper(trim(game_id)), '^[0-9]{{8}}[A-Z]+[0-9]$') THEN 'invalid_game_id' WHEN substr(trim(game_id), 1, 8) <> strftime(game_date, '%Y%m%d') THEN 'game_id_date_mismatch' WHEN away_team_code = '' THEN 'missing_away_team_code' WHEN home_team_code IS NULL THEN 'missing_home_team_code' WHEN game_status IS NULL OR game_status = 'unknown' THEN 'invalid_game_status' WHEN stadium IS NULL THEN 'missing_stadium' END AS reason FROM s",
)
def v17(t: Tables):
    """The first reason only, in order."""
    day = "date_format(o_orderdate + make_dt_interval(CASE WHEN o_orderkey % 41 = 0 THEN 1 ELSE 0 END), 'yyyyMMdd')"
    s = t.orders.selectExpr("o_orderkey", *[f"{e.format(d=day)} AS {c}" for c, e in _SCH.items()])
    return s.select("o_orderkey", checks.schedule_reason(year=1996).alias("reason"))


_PAY = {
    "player_id": "CASE WHEN l_partkey % 43 = 0 THEN 'x' WHEN l_partkey % 43 = 1 THEN NULL ELSE CAST(l_partkey AS STRING) END",
    "season": "CASE WHEN l_orderkey % 19 = 0 THEN '19x' WHEN l_orderkey % 19 = 1 THEN '1900' ELSE '1995' END",
    "team_code": "CASE WHEN l_suppkey % 17 = 0 THEN 'TOTAL' WHEN l_suppkey % 17 = 1 THEN NULL ELSE 'LG' END",
    "plate_appearances": "CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_suppkey % 9 AS STRING) END",
    "at_bats": "CASE WHEN l_linenumber = 1 THEN NULL WHEN l_orderkey % 21 = 0 THEN 'n/a' ELSE CAST(l_suppkey % 7 AS STRING) END",
    "hits": "CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_partkey % 5 AS STRING) END",
}


@query(
    "v18_season_rows",
    f"WITH p AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _PAY.items())} FROM lineitem), r AS (SELECT CASE WHEN coalesce(TRY_CAST(player_id AS BIGINT), 0) <= 0 THEN 'invalid_player_id' WHEN TRY_CAST(season AS INT) IS NULL OR TRY_CAST(season AS INT) NOT BETWEEN 1982 AND 2100 THEN 'invalid_season' WHEN coalesce(team_code, '') IN ('', 'TOTAL') THEN 'invalid_team_code' WHEN coalesce(plate_appearances, at_bats, hits) IS NULL THEN 'empty_core_stats' WHEN at_bats IS NOT NULL AND TRY_CAST(at_bats AS DOUBLE) IS NULL THEN 'invalid_numeric_field' WHEN hits::BIGINT > TRY_CAST(at_bats AS BIGINT) THEN 'hits_exceed_at_bats' WHEN TRY_CAST(at_bats AS BIGINT) > plate_appearances::BIGINT THEN 'at_bats_exceed_plate_appearances' ELSE 'valid' END AS reason FROM p) SELECT reason, count(*) AS n FROM r GROUP BY 1",
)
def v18(t: Tables):
    """Rows by the first reason that keeps them out."""
    p = t.lineitem.selectExpr(*[f"{e} AS {c}" for c, e in _PAY.items()])
    return p.groupBy(F.coalesce(checks.season_payload_reason(), F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


@query(
    "v19_results",
    "WITH g AS (SELECT o_orderkey AS game_id, 'H' AS home, 'A' AS away, o_custkey % 5 AS hs, o_custkey % 4 AS vs, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'SCHEDULED' WHEN 2 THEN 'DRAW' ELSE 'COMPLETED' END AS status, o_orderkey % 2 = 0 AS prim, o_orderdate < TIMESTAMP '1997-01-01' AS past, CASE o_custkey % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'A' ELSE ' ' END AS winner FROM orders), c AS (SELECT DISTINCT l_orderkey AS game_id FROM lineitem WHERE l_returnflag = 'A') "
    "SELECT game_id, 'winner_mismatch' AS issue FROM g WHERE prim AND status IN ('DRAW', 'COMPLETED') AND trim(winner) <> '' AND hs <> vs AND winner <> CASE WHEN hs > vs THEN 'H' ELSE 'A' END UNION ALL SELECT game_id, 'not_terminal' FROM g WHERE past AND coalesce(status NOT IN ('DRAW', 'COMPLETED'), true) UNION ALL SELECT game_id, 'no_children' FROM g ANTI JOIN c USING (game_id) WHERE status IN ('DRAW', 'COMPLETED')",
)
def v19(t: Tables):
    g = t.orders.selectExpr(
        "o_orderkey AS game_id", "'H' AS home", "'A' AS away", "o_custkey % 5 AS home_score", "o_custkey % 4 AS away_score", "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'SCHEDULED' WHEN 2 THEN 'DRAW' ELSE 'COMPLETED' END AS status",
        "o_orderkey % 2 = 0 AS is_primary", "o_orderdate < timestamp_ntz '1997-01-01' AS is_past", "CASE o_custkey % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'A' ELSE ' ' END AS winner",
    )
    return checks.result_faults(g, t.lineitem.where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("game_id")))


@query("v21_line_constraints", f"WITH {BAT} SELECT count(*) FILTER (hits > at_bats) AS hits_above_ab, count(*) FILTER (at_bats > plate_appearances) AS ab_above_pa, count(*) FILTER (least(plate_appearances, at_bats, hits, walks, strikeouts) < 0) AS negative FROM bat")
def v21(t: Tables):
    return bat(t).agg(F.count_if(F.expr("hits > at_bats")).alias("hits_above_ab"), F.count_if(F.expr("at_bats > plate_appearances")).alias("ab_above_pa"), F.count_if(F.expr("least(plate_appearances, at_bats, hits, walks, strikeouts) < 0")).alias("negative"))
