"""Season operators on stat lines made of the standard tables.

Batting and pitching lines are line items with counts derived from their keys, so
every field of the operators is used, with NULLs, stubs and repeated names in it.
The derivations are SQL that both engines read; the rules are stated on each side.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import batting as projection
from ..functions import rates
from ..operators import basics, patterns, season
from ..registry import Tables, query

_Q = "CAST(l_quantity AS BIGINT)"
KEYS = {
    "game_id": "l_orderkey",
    "player_id": "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_partkey + 9990 END",
    "player_name": "concat('P', CAST(l_partkey % 300 AS STRING))",
    "team_code": "concat('T', CAST(l_partkey % 10 AS STRING))",
    "opponent": "concat('T', CAST((l_partkey + 1 + l_suppkey % 9) % 10 AS STRING))",
    "location": "CASE WHEN l_linestatus = 'O' THEN 'HOME' ELSE 'AWAY' END",
    "season": "CAST(year(o_orderdate) AS BIGINT)",
    "season_id": "year(o_orderdate) * 10 + o_custkey % 3",
    "stadium": "CASE WHEN o_custkey % 10 = 9 THEN NULL ELSE concat('S', CAST(o_custkey % 10 AS STRING)) END",
    "starter": "CASE WHEN o_custkey % 12 = 0 THEN '' WHEN o_custkey % 12 = 1 THEN NULL ELSE concat('H', CAST(o_custkey % 40 AS STRING)) END",
    "source": "CASE l_returnflag WHEN 'N' THEN 'FALLBACK' WHEN 'A' THEN 'PROFILE' ELSE 'RECORD' END",
}
BATTING = {
    "at_bats": f"{_Q} % 4 + l_suppkey % 3",
    "hits": f"{_Q} % 4",
    "doubles": f"CASE WHEN {_Q} % 4 >= 2 THEN 1 ELSE 0 END",
    "triples": f"CASE WHEN {_Q} % 4 = 3 AND l_partkey % 3 = 0 THEN 1 ELSE 0 END",
    "home_runs": f"CASE WHEN {_Q} % 4 = 3 AND l_partkey % 3 = 1 THEN 1 ELSE 0 END",
    "runs": "l_partkey % 2",
    "rbi": "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_suppkey % 3 END",
    "walks": "l_partkey % 2",
    "intentional_walks": "CASE WHEN l_partkey % 10 = 1 THEN 1 ELSE 0 END",
    "hbp": "CASE WHEN l_suppkey % 9 = 0 THEN 1 ELSE 0 END",
    "strikeouts": "l_orderkey % 2",
    "stolen_bases": "CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE 0 END",
    "caught_stealing": "CASE WHEN l_partkey % 13 = 0 THEN 1 ELSE 0 END",
    "sacrifice_hits": "CASE WHEN l_suppkey % 11 = 0 THEN 1 ELSE 0 END",
    "sacrifice_flies": "CASE WHEN l_orderkey % 8 = 0 THEN 1 ELSE 0 END",
    "gdp": "CASE WHEN l_orderkey % 9 = 0 THEN 1 ELSE 0 END",
}
BATTING["plate_appearances"] = " + ".join(f"({BATTING[c]})" for c in ("at_bats", "walks", "hbp", "sacrifice_hits", "sacrifice_flies")) + " + CASE WHEN l_orderkey % 50 = 0 THEN 1 ELSE 0 END"
PITCHING = {
    "innings_outs": f"{_Q} % 22",
    "hits_allowed": f"{_Q} % 6",
    "runs_allowed": f"{_Q} % 5",
    "earned_runs": f"CASE WHEN {_Q} % 5 > 1 AND l_orderkey % 3 = 0 THEN {_Q} % 5 - 1 ELSE {_Q} % 5 END",
    "home_runs_allowed": f"CASE WHEN {_Q} % 6 > 3 THEN 1 ELSE 0 END",
    "walks_allowed": "CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE l_orderkey % 3 END",
    "hit_batters": "CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END",
    "strikeouts": "l_suppkey % 5",
    "wild_pitches": "l_linenumber % 2",
    "balks": "CASE WHEN l_orderkey % 19 = 0 THEN 1 ELSE 0 END",
    "tbf": f"{_Q} % 22 + {_Q} % 6 + 2",
    "np": f"{_Q} * 3",
    "sacrifices_allowed": "CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END",
    "sacrifice_flies_allowed": "CASE WHEN l_orderkey % 8 = 0 THEN 1 ELSE 0 END",
    "is_starting": "l_linenumber = 1",
    "decision": "CASE l_linenumber WHEN 1 THEN 'W' WHEN 2 THEN 'L' WHEN 3 THEN 'S' WHEN 4 THEN 'H' END",
}
_FROM = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def _sql(columns: dict[str, str]) -> str:
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in (KEYS | columns).items())} {_FROM}"


BAT, PIT = f"bat AS ({_sql(BATTING)})", f"pit AS ({_sql(PITCHING).replace('l_partkey + 9990', 'l_suppkey + 9990')})"


def bat(t: Tables):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.selectExpr(*[f"{e} AS {c}" for c, e in (KEYS | BATTING).items()])


def pit(t: Tables):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    keys = KEYS | {"player_id": KEYS["player_id"].replace("l_partkey + 9990", "l_suppkey + 9990")}
    return j.selectExpr(*[f"{e} AS {c}" for c, e in (keys | PITCHING).items()])


def SUMS(columns) -> str:
    return ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in columns)


def RATE(a: str, b: str, p: int, default: str = "0.0") -> str:
    """Half up, by exact decimals of the whole parts and the rest."""
    return f"CASE WHEN ({b}) > 0 THEN CAST(floor((CAST(({a}) AS DECIMAL(38,0)) * {2 * 10**p} + ({b})) // CAST((2 * ({b})) AS DECIMAL(38,0))) AS DOUBLE) / {10**p} ELSE {default} END"


_AVG, _SLG = RATE("hits", "at_bats", 3), RATE("hits + doubles + 2 * triples + 3 * home_runs", "at_bats", 3)
_OBP = RATE("hits + walks + hbp", "at_bats + walks + hbp + sacrifice_flies", 3)
_OBP_PA = RATE("hits + walks + hbp", "plate_appearances", 3)
_M = lambda x: f"CAST(round(({x}) * 1000) AS BIGINT)"
SLASH = f"{_AVG} AS avg, {_OBP} AS obp, {_SLG} AS slg, ({_M(_OBP)} + {_M(_SLG)}) / 1000.0::DOUBLE AS ops"
_XR = "500 * (hits - doubles - triples - home_runs) + 720 * doubles + 1040 * triples + 1440 * home_runs + 340 * (hbp + walks - intentional_walks) + 250 * intentional_walks + 180 * stolen_bases - 320 * caught_stealing - 90 * (at_bats - hits - strikeouts) - 98 * strikeouts - 370 * gdp + 370 * sacrifice_flies + 40 * sacrifice_hits"
RATES = f"{SLASH}, ({_M(_SLG)} - {_M(_AVG)}) / 1000.0::DOUBLE AS iso, {RATE('hits - home_runs', 'at_bats - strikeouts - home_runs + sacrifice_flies', 3)} AS babip, floor(({_XR} + 5) / 10.0::DOUBLE) / 100.0::DOUBLE AS xr"
PRATES = (
    f"{RATE('27 * earned_runs', 'innings_outs', 2)} AS era, {RATE('3 * (walks_allowed + hits_allowed)', 'innings_outs', 2)} AS whip, {RATE('27 * strikeouts', 'innings_outs', 2)} AS k_per_nine, {RATE('27 * walks_allowed', 'innings_outs', 2)} AS bb_per_nine, "
    f"CASE WHEN walks_allowed > 0 THEN {RATE('strikeouts', 'walks_allowed', 2)} ELSE strikeouts END::DOUBLE AS kbb, "
    "CASE WHEN innings_outs > 0 THEN floor(((3 * (13 * home_runs_allowed + 3 * (walks_allowed + hit_batters) - 2 * strikeouts) * 100 + 310 * innings_outs) * 2 + innings_outs) / (2.0::DOUBLE * innings_outs)) / 100 ELSE 0.0 END AS fip"
)
DEC = ", ".join(f"count(*) FILTER (decision = '{d}') AS {n}" for d, n in season.DECISIONS.items())

_SEASON_BAT = f"SELECT season, player_id, max(player_name) AS player_name, max(team_code) AS team_code, count(*) AS games, {SUMS(season.BATTING)} FROM bat WHERE player_id IS NOT NULL GROUP BY ALL"
_SEASON_PIT = f"SELECT season, player_id, max(player_name) AS player_name, max(team_code) AS team_code, count(*) AS games, count(*) FILTER (is_starting) AS games_started, {DEC}, {SUMS(season.PITCHING)} FROM pit WHERE player_id IS NOT NULL GROUP BY ALL"


@query("a01_season_batting", f"WITH {BAT}, s AS ({_SEASON_BAT}) SELECT *, {RATES} FROM s")
def a01(t: Tables):
    """All players of all seasons: 17 sums and every rate."""
    return season.batting(bat(t), ["season", "player_id"])


_SERIES = "SELECT * FROM (VALUES (0, '정규시즌'), (1, '준플레이오프'), (2, '플레이오프')) v(k, league_name)"


@query("f03_series_of_seasons", f"WITH {BAT} SELECT game_id, season_id, count(*) AS n FROM bat JOIN ({_SERIES}) ON season_id % 10 = k WHERE contains(league_name, '플레이오프') GROUP BY ALL")
def f03(t: Tables):
    """Series by pattern: the playoff pattern also finds the semi-playoff."""
    names = t.spark.createDataFrame([(0, "정규시즌"), (1, "준플레이오프"), (2, "플레이오프")], "k int, league_name string")
    years = t.orders.select(F.year("o_orderdate").alias("y")).distinct()
    seasons = years.join(F.broadcast(names)).select((F.col("y") * 10 + F.col("k")).alias("season_id"), "league_name")
    return season.of_series(bat(t), seasons, "playoff").groupBy("game_id", "season_id").agg(F.count("*").alias("n"))


@query("a02_player_season", f"WITH {BAT}, s AS ({_SEASON_BAT}) SELECT *, {RATES} FROM s WHERE player_id = 10000 AND season = 1995")
def a02(t: Tables):
    """One player: no row where there is no game."""
    return season.batting(bat(t).where("player_id = 10000 and season = 1995"), ["season", "player_id"])


_IP = RATE("innings_outs", "3", 1)


@query("a03_season_pitching", f"WITH {PIT}, s AS ({_SEASON_PIT}) SELECT *, {_IP} AS innings_pitched, {PRATES} FROM s")
def a03(t: Tables):
    return season.pitching(pit(t), ["season", "player_id"])


@query("a04_pitcher_season", f"WITH {PIT}, s AS ({_SEASON_PIT}) SELECT *, {_IP} AS innings_pitched, {PRATES} FROM s WHERE player_id = 9997 AND season = 1995")
def a04(t: Tables):
    return season.pitching(pit(t).where("player_id = 9997 and season = 1995"), ["season", "player_id"])


_SRC = "row_number() OVER (PARTITION BY season, player_id, team_code ORDER BY CASE source WHEN 'RECORD' THEN 0 WHEN 'PROFILE' THEN 1 ELSE 2 END, game_id DESC, games DESC) AS rn"
PRIORITY = ["RECORD", "PROFILE"]


def _one_source(rows):
    """One row for a player, season and team: of the best source, then the latest."""
    rank = F.when(F.col("source") == PRIORITY[0], 0).when(F.col("source") == PRIORITY[1], 1).otherwise(2)
    return basics.first_by(rows, ["season", "player_id", "team_code"], [rank, F.desc("game_id"), F.desc("games")])


def _by_source(lines, columns):
    return lines.where("player_id is not null").groupBy("season", "player_id", "team_code", "source").agg(F.count("*").alias("games"), F.max("game_id").alias("game_id"), *season.sums(columns))


_TEAM_BAT = f"r AS (SELECT season, player_id, team_code, source, count(*) AS games, max(game_id) AS game_id, {SUMS(season.BATTING)} FROM bat WHERE player_id IS NOT NULL GROUP BY ALL), o AS (SELECT * FROM (SELECT *, {_SRC} FROM r) WHERE rn = 1), s AS (SELECT season, team_code, max(games)::BIGINT AS games, {SUMS(season.BATTING)} FROM o GROUP BY 1, 2)"


@query("a07_team_batting", f"WITH {BAT}, {_TEAM_BAT} SELECT *, {RATES} FROM s")
def a07(t: Tables):
    """Season rows of one source each, added up by team."""
    return season.team_batting(_one_source(_by_source(bat(t), season.BATTING)))


_MORE = [*season.DECISIONS.values(), *season.PITCHING, "sacrifices_allowed", "sacrifice_flies_allowed"]
_FLAGS = ", ".join(f"CASE WHEN decision = '{d}' THEN 1 ELSE 0 END AS {n}" for d, n in season.DECISIONS.items())


@query(
    "a08_team_pitching",
    f"WITH {PIT}, q AS (SELECT *, {_FLAGS} FROM pit), r AS (SELECT season, player_id, team_code, source, count(*) AS games, max(game_id) AS game_id, {SUMS(_MORE)} FROM q WHERE player_id IS NOT NULL GROUP BY ALL), o AS (SELECT * FROM (SELECT *, {_SRC} FROM r) WHERE rn = 1), s AS (SELECT season, team_code, max(games)::BIGINT AS games, {SUMS(_MORE)} FROM o GROUP BY 1, 2) SELECT *, {PRATES}, {RATE('hits_allowed', 'tbf - walks_allowed - hit_batters - sacrifices_allowed - sacrifice_flies_allowed', 3)} AS avg_against FROM s",
)
def a08(t: Tables):
    lines = pit(t)
    for d, n in season.DECISIONS.items():
        lines = lines.withColumn(n, F.when(F.col("decision") == d, 1).otherwise(0))
    return season.team_pitching(_one_source(_by_source(lines, _MORE)))


@query("a09_team_batting_of_rows", f"WITH {BAT}, s AS (SELECT season, team_code, max(1)::BIGINT AS games, {SUMS(season.BATTING)} FROM bat GROUP BY 1, 2) SELECT *, {RATES} FROM s")
def a09(t: Tables):
    """The same rollup of rows at hand, here of single games."""
    return season.team_batting(bat(t).withColumn("games", F.lit(1)))


_FIELD = {"errors": "l_linenumber % 2", "double_plays": "l_orderkey % 2", "putouts": f"{_Q} % 9", "assists": "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_suppkey % 4 END", "outs": f"{_Q} % 28"}


@query(
    "a11_team_fielding",
    f"WITH f AS (SELECT year(o_orderdate)::BIGINT AS season, concat('T', (l_partkey % 997)::VARCHAR) AS team_code, {', '.join(f'{e} AS {c}' for c, e in _FIELD.items())} {_FROM}), s AS (SELECT season, team_code, {SUMS(_FIELD)} FROM f GROUP BY 1, 2) SELECT *, putouts + assists + errors AS total_chances, nullif({RATE('putouts + assists', 'putouts + assists + errors', 4, 'NULL')}, 0) AS fielding_pct, nullif({RATE('27 * (putouts + assists)', 'outs', 3, 'NULL')}, 0) AS range_factor_per_game FROM s",
)
def a11(t: Tables):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return season.team_fielding(j.selectExpr("CAST(year(o_orderdate) AS BIGINT) AS season", "concat('T', CAST(l_partkey % 997 AS STRING)) AS team_code", *[f"{e} AS {c}" for c, e in _FIELD.items()]))


@query("a12_team_running", f"WITH {BAT}, s AS (SELECT season, team_code, {SUMS(['stolen_bases', 'caught_stealing'])} FROM bat GROUP BY 1, 2) SELECT *, stolen_bases + caught_stealing AS attempts, nullif({RATE('100 * stolen_bases', 'stolen_bases + caught_stealing', 1, 'NULL')}, 0) AS success_rate FROM s")
def a12(t: Tables):
    """A rate of 0 is given as NULL."""
    s = bat(t).groupBy("season", "team_code").agg(*season.sums(["stolen_bases", "caught_stealing"]))
    made = rates.rate("100 * stolen_bases", "stolen_bases + caught_stealing", 1, None)
    return s.select("*", F.expr("stolen_bases + caught_stealing").alias("attempts"), F.when(made != 0, made).alias("success_rate"))


_HA = [c for c in season.BATTING if c not in ("intentional_walks", "sacrifice_hits", "gdp")]


@query("a13_home_and_away", f"WITH {BAT}, g AS (SELECT player_id, location, count(*) AS games, {SUMS(_HA)} FROM bat WHERE player_id IS NOT NULL GROUP BY 1, 2), k AS (SELECT DISTINCT player_id, unnest(['HOME', 'AWAY']) AS location FROM g), s AS (SELECT player_id, location, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ['games', *_HA])} FROM k LEFT JOIN g USING (player_id, location)) SELECT *, {SLASH} FROM s")
def a13(t: Tables):
    return season.home_away(bat(t))


_SP = [c for c in season.BATTING if c not in ("intentional_walks", "gdp")]
_MSLASH = f"{_AVG} AS avg, {_OBP_PA} AS obp, {_SLG} AS slg, ({_M(_OBP_PA)} + {_M(_SLG)}) / 1000.0::DOUBLE AS ops"


def _split_sql(key: str, rates_sql: str, columns=_SP, where: str = "") -> str:
    return f"WITH {BAT}, s AS (SELECT player_id, {key}, max(player_name) AS player_name, count(*) AS games, {SUMS(columns)} FROM bat WHERE player_id IS NOT NULL AND {key} IS NOT NULL{where} GROUP BY 1, 2) SELECT *, {rates_sql} FROM s"


@query("a16_batter_by_opponent", _split_sql("opponent", _MSLASH))
def a16(t: Tables):
    return season.split(bat(t), ["player_id", "opponent"])


@query("a17_pitcher_by_opponent", f"WITH {PIT}, s AS (SELECT player_id, opponent, count(*) AS games, {DEC}, {SUMS(season.PITCHING)} FROM pit WHERE player_id IS NOT NULL GROUP BY 1, 2) SELECT *, {RATE('27 * earned_runs', 'innings_outs', 2)} AS era, {RATE('3 * (walks_allowed + hits_allowed)', 'innings_outs', 2)} AS whip FROM s")
def a17(t: Tables):
    return season.pitcher_split(pit(t), ["player_id", "opponent"])


_NOHBP = _MSLASH.replace("hits + walks + hbp", "hits + walks")


@query("a18_batter_by_stadium", _split_sql("stadium", _NOHBP, [c for c in _SP if c != "hbp"]))
def a18(t: Tables):
    """Hit batters count nothing here."""
    return season.split(bat(t), ["player_id", "stadium"], hbp=False)


@query("a19_batter_by_starter", _split_sql("starter", f"{_AVG} AS avg, {_OBP_PA} AS obp, 0.0::DOUBLE AS slg, {_OBP_PA} AS ops", where=" AND starter <> ''"))
def a19(t: Tables):
    """Starters without a name are left out; slg is 0 and ops is obp."""
    return season.split(bat(t), ["player_id", "starter"], slugging=False)


_OLD = "SELECT batter, pitcher, count(*) AS pa, sum(h)::BIGINT AS h FROM (SELECT l_partkey AS batter, l_suppkey % 20 AS pitcher, l_linenumber % 2 AS h FROM lineitem WHERE l_returnflag {}) GROUP BY 1, 2"


def _matchups(t: Tables):
    m = lambda w: t.lineitem.where(w).groupBy(F.col("l_partkey").alias("batter"), (F.col("l_suppkey") % 20).alias("pitcher")).agg(F.count("*").alias("pa"), F.sum((F.col("l_linenumber") % 2).cast("long")).alias("h"))
    return m("l_returnflag <> 'N'"), m("l_returnflag <> 'A'")


@query("a21_matchups_accumulated", f"SELECT batter, pitcher, (coalesce(o.pa, 0) + coalesce(n.pa, 0))::BIGINT AS pa, (coalesce(o.h, 0) + coalesce(n.h, 0))::BIGINT AS h FROM ({_OLD.format(chr(60) + '> ' + chr(39) + 'N' + chr(39))}) o FULL JOIN ({_OLD.format(chr(60) + '> ' + chr(39) + 'A' + chr(39))}) n USING (batter, pitcher)")
def a21(t: Tables):
    old, new = _matchups(t)
    return season.merge_matchups(old, new, ["batter", "pitcher"], ["pa", "h"], accumulate=True)


@query("a21_matchups_replaced", f"SELECT batter, pitcher, coalesce(n.pa, o.pa) AS pa, coalesce(n.h, o.h) AS h FROM ({_OLD.format(chr(60) + '> ' + chr(39) + 'N' + chr(39))}) o FULL JOIN ({_OLD.format(chr(60) + '> ' + chr(39) + 'A' + chr(39))}) n USING (batter, pitcher)")
def a21_replaced(t: Tables):
    old, new = _matchups(t)
    return season.merge_matchups(old, new, ["batter", "pitcher"], ["pa", "h"])


_FR = "t AS (SELECT (100 * (69 * (b.walks - b.intentional_walks) + 72 * b.hbp + 89 * (b.hits - b.doubles - b.triples - b.home_runs) + 127 * b.doubles + 162 * b.triples + 210 * b.home_runs) / 100)::DOUBLE AS top, (b.at_bats + b.walks - b.intentional_walks + b.hbp + b.sacrifice_flies)::DOUBLE AS chances, (b.hits + b.walks - b.intentional_walks + b.hbp)::DOUBLE AS reached, b.*, p.innings_outs AS o, p.earned_runs AS er, 13 * p.home_runs_allowed + 3 * (p.walks_allowed + p.hit_batters) - 2 * p.strikeouts AS f FROM b, p)"
LEAGUE = (
    f"sb AS ({_SEASON_BAT}), sp AS ({_SEASON_PIT}), "
    f"b AS (SELECT {SUMS(season.BATTING)} FROM sb WHERE season = 1995 AND player_id >= 10000 AND (plate_appearances > 10 OR home_runs > 0 OR walks > 0)), "
    f"p AS (SELECT {SUMS(season.PITCHING)} FROM sp WHERE season = 1995 AND player_id >= 10000 AND (innings_outs <= 10 OR strikeouts > 0 OR walks_allowed > 0)), {_FR}, "
    "u AS (SELECT CASE WHEN chances > 0 THEN top / (100 * chances) ELSE 0.32 END AS lg_woba, CASE WHEN chances > 0 THEN reached / chances ELSE 0.33 END AS lg_obp, CASE WHEN o > 0 THEN (27 * er)::DOUBLE / o ELSE 4.5 END AS lg_era, CASE WHEN o > 0 THEN (3 * f)::DOUBLE / o ELSE 0 END AS raw, CASE WHEN o > 0 THEN (54 * runs)::DOUBLE / o ELSE 10 END AS rpg, * FROM t), "
    "lg AS (SELECT lg_woba, CASE WHEN lg_woba > 0 THEN lg_obp / lg_woba ELSE 1.2 END AS woba_scale, runs::DOUBLE / (CASE WHEN plate_appearances <> 0 THEN plate_appearances ELSE 1 END) AS lg_r_per_pa, lg_era - raw AS fip_constant, round(10 * sqrt(rpg / 9), 2) AS rpw, lg_era, lg_obp, (hits + doubles + 2 * triples + 3 * home_runs)::DOUBLE / (CASE WHEN at_bats <> 0 THEN at_bats ELSE 1 END) AS lg_slg FROM u)"
)


def _league(t: Tables):
    of = lambda df: df.where("season = 1995")
    return of(season.batting(bat(t), ["season", "player_id"])), of(season.pitching(pit(t), ["season", "player_id"]))


@query("a31_league_constants", f"WITH {BAT}, {PIT}, {LEAGUE} SELECT lg_woba, woba_scale, lg_r_per_pa, fip_constant, rpw, lg_era, lg_obp, lg_slg FROM lg")
def a31(t: Tables):
    """One season's constants; stub rows and low ids do not count."""
    return season.league_constants(*_league(t))


_WOBA = RATE("69 * (walks - intentional_walks) + 72 * hbp + 89 * (hits - doubles - triples - home_runs) + 127 * doubles + 162 * triples + 210 * home_runs", "100 * (at_bats + walks - intentional_walks + hbp + sacrifice_flies)", 3)


@query(
    "r03_advanced_batting",
    f"WITH {BAT}, {PIT}, {LEAGUE}, s AS (SELECT *, {_OBP} AS obp, {_SLG} AS slg, {_WOBA} AS woba FROM sb WHERE season = 1995), x AS (SELECT *, (woba - lg_woba) / woba_scale AS above FROM s, lg) SELECT player_id, woba, round(above * plate_appearances, 1) AS wraa, CAST(round(CASE WHEN lg_r_per_pa > 0 THEN (above + lg_r_per_pa) / lg_r_per_pa * 100 ELSE 100 END) AS BIGINT) AS wrc_plus, CAST(round(CASE WHEN lg_obp > 0 AND lg_slg > 0 THEN (obp / lg_obp + slg / lg_slg - 1) * 100 ELSE 100 END) AS BIGINT) AS ops_plus, round(round(above * plate_appearances, 1) / rpw, 2) AS war FROM x",
)
def r03(t: Tables):
    b, p = _league(t)
    return season.advanced_batting(b, season.league_constants(b, p)).select("player_id", "woba", "wraa", "wrc_plus", "ops_plus", "war")


@query(
    "r04_advanced_pitching",
    f"WITH {BAT}, {PIT}, {LEAGUE}, x AS (SELECT *, round(CASE WHEN innings_outs > 0 THEN (3 * (13 * home_runs_allowed + 3 * (walks_allowed + hit_batters) - 2 * strikeouts))::DOUBLE / innings_outs + fip_constant ELSE 0 END, 2) AS fip_adj FROM sp, lg WHERE season = 1995) SELECT player_id, fip_adj, CASE WHEN 10 * (hits_allowed + walks_allowed + hit_batters) - 14 * home_runs_allowed > 0 THEN floor((2000.0::DOUBLE * 10 * (hits_allowed + walks_allowed + hit_batters - runs_allowed) + (10 * (hits_allowed + walks_allowed + hit_batters) - 14 * home_runs_allowed)) / (2.0::DOUBLE * (10 * (hits_allowed + walks_allowed + hit_batters) - 14 * home_runs_allowed))) / 1000 END AS lob_pct, round(CASE WHEN rpw > 0 THEN (lg_era - fip_adj) * (innings_outs / 27.0::DOUBLE) / rpw ELSE 0 END, 2) AS war FROM x",
)
def r04(t: Tables):
    b, p = _league(t)
    return season.advanced_pitching(p, season.league_constants(b, p)).select("player_id", "fip_adj", "lob_pct", "war")


@query("r05_simple_pitching", f"WITH {PIT} SELECT game_id, player_id, {RATE('27 * earned_runs', 'innings_outs', 2)} AS era, CASE WHEN innings_outs > 0 THEN floor((2 * (300 * (13 * home_runs_allowed + 3 * (coalesce(walks_allowed, 0) + hit_batters) - 2 * strikeouts) + 320 * innings_outs) + innings_outs) / (2.0::DOUBLE * innings_outs)) / 100 ELSE 0 END AS fip FROM pit")
def r05(t: Tables):
    """A line's era, and fip with a constant of its own."""
    x = pit(t).na.fill(0, ["walks_allowed"])
    r = rates.pitching("320")
    return x.select("game_id", "player_id", r["era"].alias("era"), r["fip"].alias("fip"))


@query("r01_batting_rates", f"WITH {BAT}, s AS (SELECT game_id, player_id, {', '.join(f'coalesce({c}, 0) AS {c}' for c in season.BATTING)} FROM bat) SELECT game_id, player_id, {RATES} FROM s")
def r01(t: Tables):
    x = bat(t).na.fill(0, list(season.BATTING))
    return x.select("game_id", "player_id", *[c.alias(n) for n, c in rates.batting().items()])


@query("r02_all_pitching_rates", f"WITH {PIT}, s AS (SELECT game_id, player_id, {', '.join(f'coalesce({c}, 0) AS {c}' for c in season.PITCHING)} FROM pit) SELECT game_id, player_id, {PRATES} FROM s")
def r02(t: Tables):
    x = pit(t).na.fill(0, list(season.PITCHING))
    return x.select("game_id", "player_id", *[c.alias(n) for n, c in rates.pitching().items()])


@query("r06_matchup_rates", f"WITH {BAT} SELECT game_id, player_id, {_MSLASH} FROM bat")
def r06(t: Tables):
    """Times on base are divided by all plate appearances."""
    r = rates.batting(matchup=True)
    return bat(t).select("game_id", "player_id", *[r[n].alias(n) for n in ("avg", "obp", "slg", "ops")])


@query("r07_recalculated_rates", f"WITH {BAT}, s AS ({_SEASON_BAT}) SELECT season, player_id, hits + doubles + 2 * triples + 3 * home_runs AS total_bases, {SLASH} FROM s")
def r07(t: Tables):
    s = season.batting(bat(t), ["season", "player_id"])
    return s.select("season", "player_id", F.expr("hits + doubles + 2 * triples + 3 * home_runs").alias("total_bases"), "avg", "obp", "slg", "ops")


@query("a34_recalculated_view", f"WITH {BAT}, s AS (SELECT player_id, player_name, season, team_code, count(DISTINCT game_id) AS games, {SUMS(('plate_appearances', 'at_bats', 'runs', 'hits', 'doubles', 'triples', 'home_runs', 'rbi', 'walks', 'strikeouts'))} FROM bat WHERE player_id IS NOT NULL GROUP BY 1, 2, 3, 4) SELECT *, {_AVG} AS avg FROM s")
def a34(t: Tables):
    return season.recalculated(bat(t))


@query(
    "a06_fielding",
    """WITH l AS (SELECT l_orderkey AS game_id, l_orderkey * 10 + l_linenumber AS lineup_id, CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE l_partkey END AS player_id, CASE WHEN l_linenumber = 7 THEN NULL ELSE 'pos' || l_linenumber::VARCHAR END AS position FROM lineitem),
    n AS (SELECT p_partkey AS player_id, CASE WHEN p_partkey % 29 = 0 THEN '' ELSE 'N' || (p_partkey % 90)::VARCHAR || '.' END AS name FROM part WHERE p_partkey % 31 <> 0),
    e AS (SELECT o_orderkey AS game_id, o_orderkey AS event_id, 'error by N' || (o_custkey % 90)::VARCHAR || '. near pos' || (o_custkey % 8)::VARCHAR AS d FROM orders WHERE o_orderstatus <> 'O'),
    h AS (SELECT e.event_id, l.player_id, l.position, row_number() OVER (PARTITION BY e.event_id ORDER BY lineup_id, l.player_id) AS rn FROM e JOIN l USING (game_id) LEFT JOIN n USING (player_id) WHERE l.player_id IS NOT NULL AND position IS NOT NULL AND ((coalesce(name, '') <> '' AND contains(d, name)) OR contains(d, position))),
    c AS (SELECT player_id, position, count(*) AS errors FROM h WHERE rn = 1 GROUP BY 1, 2)
    SELECT g.player_id, g.position, g.games, coalesce(errors, 0) AS errors FROM (SELECT player_id, position, count(DISTINCT game_id) AS games FROM l WHERE player_id IS NOT NULL AND position IS NOT NULL GROUP BY 1, 2) g LEFT JOIN c USING (player_id, position)""",
)
def a06(t: Tables):
    lineups = t.lineitem.select(F.col("l_orderkey").alias("game_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("lineup_id"), F.expr("CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE l_partkey END").alias("player_id"), F.expr("CASE WHEN l_linenumber = 7 THEN NULL ELSE 'pos' || l_linenumber END").alias("position"))
    names = t.part.where("p_partkey % 31 <> 0").select(F.col("p_partkey").alias("player_id"), F.expr("CASE WHEN p_partkey % 29 = 0 THEN '' ELSE 'N' || (p_partkey % 90) || '.' END").alias("player_name"))
    errors = t.orders.where("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("game_id"), F.col("o_orderkey").alias("event_id"), F.expr("'error by N' || (o_custkey % 90) || '. near pos' || (o_custkey % 8)").alias("description"))
    return season.fielding(lineups, errors, names)


@query(
    "j19_first_match",
    "SELECT event_id, CASE WHEN contains(d, 'a') THEN 'first' WHEN contains(d, 'e') THEN 'second' END AS found FROM (SELECT event_id, event_type AS d FROM events) WHERE contains(d, 'a') OR contains(d, 'e')",
)
def j19(t: Tables):
    """The first entry, by place, that an event's text contains; the list is small and stated."""
    entries = t.spark.createDataFrame([(1, "a", "first"), (2, "e", "second")], "place int, word string, found string")
    hit = t.events.select("event_id", "event_type").join(F.broadcast(entries), F.col("event_type").contains(F.col("word")))
    return hit.groupBy("event_id").agg(F.min_by("found", "place").alias("found"))


@query(
    "j19_names_of_the_game",
    "WITH n AS (SELECT l_orderkey AS game, l_linenumber AS place, 'N' || (l_partkey % 90)::VARCHAR || '.' AS name FROM lineitem), e AS (SELECT o_orderkey AS game, 'error by N' || (o_custkey % 90)::VARCHAR || '. near N' || (o_orderkey % 90)::VARCHAR || '. and N' || (o_custkey % 7)::VARCHAR || '.' AS text FROM orders) SELECT game AS event_id, min(place)::BIGINT AS place FROM e JOIN n USING (game) WHERE contains(text, name) GROUP BY 1",
)
def j19_game(t: Tables):
    """Each event's first lineup row, of its own game, whose name its text contains."""
    names = t.lineitem.select(F.col("l_orderkey").alias("game"), F.col("l_linenumber").alias("place"), F.expr("'N' || (l_partkey % 90) || '.'").alias("name"))
    events = t.orders.select(F.col("o_orderkey").alias("game"), F.col("o_orderkey").alias("event_id"), F.expr("'error by N' || (o_custkey % 90) || '. near N' || (o_orderkey % 90) || '. and N' || (o_custkey % 7) || '.'").alias("text"))
    return patterns.first_in_group(events, "event_id", "text", names, "place", "name", "game")


@query("j19_passages", "SELECT doc_id, min(item_id)::BIGINT AS place FROM documents, (SELECT item_id, substr(text, 1, 24) AS p FROM benchmark UNION ALL SELECT 1000 + p_partkey, 'item ' || p_partkey::VARCHAR FROM part UNION ALL SELECT 100000 + n_nationkey, substr(n_name, 1, 1) || 'n' FROM nation) WHERE contains(text, p) GROUP BY 1")
def j19_passages(t: Tables):
    """The first of many passages, numbers and short marks that a document contains."""
    p = t.benchmark.selectExpr("item_id", "substr(text, 1, 24) AS p").unionByName(t.part.selectExpr("1000 + p_partkey AS item_id", "concat('item ', p_partkey) AS p")).unionByName(t.nation.selectExpr("CAST(100000 + n_nationkey AS BIGINT) AS item_id", "concat(substr(n_name, 1, 1), 'n') AS p"))
    return patterns.first_of_all(t.documents, "doc_id", "text", p, "item_id", "p")


_HIST = "pa, at_bats, hits, home_runs, walks, strikeouts, total_bases"


@query("r12_hitter_projection")
def r12(t: Tables):
    """Marcel: the last three seasons of each player, 5-4-3."""
    s = season.batting(bat(t), ["season", "player_id"]).select("player_id", "season", F.struct(*[F.col(c).cast("double").alias(n) for c, n in (("plate_appearances", "pa"), ("at_bats", "at_bats"), ("hits", "hits"), ("home_runs", "home_runs"), ("walks", "walks"), ("strikeouts", "strikeouts"))], F.expr("CAST(hits + doubles + 2 * triples + 3 * home_runs AS DOUBLE)").alias("total_bases")).alias("x"))
    last = s.groupBy("player_id").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("season", "x")))), 1, 3).alias("h"))
    h = last.select("player_id", F.transform("h", lambda v: v["x"]).alias("h"))
    age = (20 + F.col("player_id") % 20).cast("int")
    return h.select("player_id", *[c.alias(n) for n, c in projection.hitter_projection("h", age, F.lit(1.0)).items()])


@query("r12_pitcher_projection")
def r12_pitcher(t: Tables):
    """The same for pitchers, drawn to the league over 1350 outs."""
    s = season.pitching(pit(t), ["season", "player_id"]).select("player_id", "season", F.struct(*[F.col(c).cast("double").alias(n) for c, n in projection.PITCHER_COUNTS.items()]).alias("x"))
    last = s.groupBy("player_id").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("season", "x")))), 1, 3).alias("h"))
    h = last.select("player_id", F.transform("h", lambda v: v["x"]).alias("h"))
    age = (20 + F.col("player_id") % 20).cast("int")
    return h.select("player_id", *[c.alias(n) for n, c in projection.pitcher_projection("h", age, F.lit(1.0)).items()])
