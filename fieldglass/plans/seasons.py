"""Standings, records between teams, forms, parks and coverage on games made of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import basics, season, splits, standings
from ..registry import Tables, query
from .core import _GAMES, _ROLES, _games
from .league import _AVG, _M, _OBP, _SEASON_BAT, _SLG, BAT, PIT, RATE, SUMS, bat, pit

_C = ", ".join(standings.CARRIED)
_HOME = "h AS (SELECT f.*, count(*) FILTER (is_home AND res = 'W') OVER w AS home_wins, count(*) FILTER (is_home AND res = 'L') OVER w AS home_losses, count(*) FILTER (NOT is_home AND res = 'W') OVER w AS away_wins, count(*) FILTER (NOT is_home AND res = 'L') OVER w AS away_losses FROM f WINDOW w AS (PARTITION BY team ORDER BY date, game, is_home ROWS UNBOUNDED PRECEDING))"


@query(
    "w05_full_standings",
    _GAMES
    + f""", {_HOME}, l AS (SELECT date, team, {_C} FROM (SELECT *, row_number() OVER (PARTITION BY date, team ORDER BY game DESC, is_home DESC) AS rn FROM h) WHERE rn = 1),
    spine AS (SELECT d.date, k.team FROM (SELECT DISTINCT date FROM l) d JOIN (SELECT team, min(date) AS since FROM l GROUP BY 1) k ON d.date >= k.since),
    dense AS (SELECT date, team, {', '.join(f'last_value({c} IGNORE NULLS) OVER w AS {c}' for c in standings.CARRIED)} FROM spine LEFT JOIN l USING (date, team) WINDOW w AS (PARTITION BY team ORDER BY date ROWS UNBOUNDED PRECEDING)),
    p AS (SELECT *, CASE WHEN wins + losses > 0 THEN wins / (wins + losses) ELSE 0.0 END AS pct FROM dense), o AS (SELECT *, row_number() OVER d AS r, first_value(wins) OVER d AS lw, first_value(losses) OVER d AS ll FROM p WINDOW d AS (PARTITION BY date ORDER BY pct DESC, wins DESC, team))
    SELECT date, team, {_C}, runs_scored - runs_allowed AS run_differential, round(pct, 4) AS win_pct, r::INT AS rank, greatest(((lw - wins) + (losses - ll)) / 2, 0.0)::DOUBLE AS games_behind, r <= 5 AS top_5 FROM o""",
)
def w05(t: Tables):
    return standings.snapshot(_games(t), _ROLES)


@query("w10_weekly_map", _GAMES + ", w AS (SELECT team, strftime(date, '%G-W%V') AS week, count(*) FILTER (res = 'W') AS w, count(*) FILTER (res = 'L') AS l FROM r GROUP BY 1, 2) SELECT team, string_agg(week || '=' || coalesce((CASE WHEN w + l > 0 THEN (2000 * w + w + l) // (2 * (w + l)) END)::VARCHAR, 'null'), ',' ORDER BY week) AS weekly FROM w GROUP BY 1")
def w10(t: Tables):
    """Weeks in order, shares in thousandths."""
    entry = lambda e: F.concat(e["key"], F.lit("="), F.coalesce(F.round(e["value"] * 1000).cast("long").cast("string"), F.lit("null")))
    return standings.weekly(_games(t), _ROLES).select("team", F.array_join(F.transform(F.array_sort(F.map_entries("weekly")), entry), ",").alias("weekly"))


@query("w11_form_and_streak", _GAMES + ", b AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY date DESC, game DESC, is_home DESC) AS rn FROM r), k AS (SELECT *, first_value(res) OVER (PARTITION BY team ORDER BY rn) AS last FROM b WHERE rn <= 10) SELECT team, count(*) FILTER (res = 'W') AS wins, count(*) FILTER (res = 'L') AS losses, count(*) FILTER (res = 'D') AS draws, any_value(last) AS streak_type, coalesce(min(rn) FILTER (res <> last) - 1, count(*))::BIGINT AS streak FROM k GROUP BY 1")
def w11(t: Tables):
    return standings.recent_form(_games(t), _ROLES)


_PAIR = "SELECT {by}least(home, away) AS a, greatest(home, away) AS b, count(*) FILTER (CASE WHEN home <= away THEN hs > vs ELSE vs > hs END) AS a_wins, count(*) FILTER (CASE WHEN home <= away THEN hs < vs ELSE vs < hs END) AS b_wins, count(*) FILTER (hs = vs) AS draws FROM {src} GROUP BY ALL"


@query("a26_head_to_head_full", _GAMES + f", k AS ({_PAIR.format(by='', src='g')}) SELECT *, CASE WHEN a_wins > b_wins THEN a::VARCHAR WHEN b_wins > a_wins THEN b::VARCHAR ELSE 'even' END AS ahead FROM k")
def a26(t: Tables):
    return standings.head_to_head(_games(t), _ROLES)


@query("a27_series_record", _GAMES + f", z AS (SELECT *, year(date)::BIGINT * 10 + game % 3 AS series FROM g WHERE game % 3 > 0), k AS ({_PAIR.format(by='series, ', src='z')}) SELECT *, CASE WHEN a_wins > b_wins THEN a::VARCHAR WHEN b_wins > a_wins THEN b::VARCHAR ELSE 'even' END AS ahead FROM k")
def a27(t: Tables):
    """Records within each series other than the regular season."""
    games = _games(t).where("game % 3 > 0").withColumn("series", F.year("date").cast("long") * 10 + F.col("game") % 3)
    return standings.head_to_head(games, _ROLES, ["series"])


@query("a28_toughest_in_order", _GAMES + ", k AS (SELECT team, opponent, count(*) FILTER (res = 'W') AS wins, count(*) FILTER (res = 'L') AS losses, count(*) FILTER (res = 'D') AS draws FROM r GROUP BY 1, 2), z AS (SELECT *, (CASE WHEN wins + losses > 0 THEN (2000 * wins + wins + losses) // (2 * (wins + losses)) ELSE 0 END)::DOUBLE / 1000 AS win_rate FROM k) SELECT *, row_number() OVER (PARTITION BY team ORDER BY win_rate, losses DESC, opponent)::INT AS place FROM z")
def a28(t: Tables):
    return standings.opponents(_games(t), _ROLES)


@query("r09_behind_leader", _GAMES + ", k AS (SELECT team, count(*) FILTER (res = 'W') AS w, count(*) FILTER (res = 'L') AS l FROM r GROUP BY 1), o AS (SELECT *, first_value(w) OVER d AS lw, first_value(l) OVER d AS ll FROM k WINDOW d AS (ORDER BY CASE WHEN w + l > 0 THEN w / (w + l) ELSE 0.0 END DESC, w DESC, team)) SELECT team, greatest(((lw - w) + (l - ll)) / 2.0, 0)::DOUBLE AS behind FROM o")
def r09(t: Tables):
    """Wins and losses of one leader, by share of wins, then wins."""
    s = basics.two_sided(_games(t), "home", "away", "hs", "vs").withColumn("res", basics.outcome())
    own = s.groupBy("team").agg(F.count_if(F.col("res") == "W").alias("w"), F.count_if(F.col("res") == "L").alias("l"))
    pct = F.when(F.col("w") + F.col("l") > 0, F.col("w") / (F.col("w") + F.col("l"))).otherwise(0.0)
    lead = own.agg(F.min_by(F.struct("w", "l"), F.struct(-pct, -F.col("w"), "team")).alias("x")).select(F.col("x.w").alias("lw"), F.col("x.l").alias("ll"))
    behind = ((F.col("lw") - F.col("w")) + (F.col("l") - F.col("ll"))) / 2.0
    return own.crossJoin(F.broadcast(lead)).select("team", F.greatest(behind, F.lit(0.0)).alias("behind"))


_LAB = "CASE WHEN f > 1.10 THEN 'extreme hitter' WHEN f > 1.04 THEN 'hitter' WHEN f > 0.96 THEN 'neutral' WHEN f > 0.90 THEN 'pitcher' ELSE 'extreme pitcher' END"


@query(
    "a14_park_table",
    "WITH g AS (SELECT CASE WHEN o_custkey % 9 = 0 THEN 'UNKNOWN' ELSE 'S' || (o_custkey % 9)::VARCHAR END AS park, o_orderkey % 9 AS h, o_custkey % 6 AS a FROM orders WHERE o_orderkey % 13 > 0), b AS (SELECT park, count(*) AS games, sum(h)::BIGINT AS home_runs, sum(a)::BIGINT AS away_runs, sum(h + a)::BIGINT AS total_runs FROM g GROUP BY 1), x AS (SELECT *, sum(games) OVER ()::BIGINT AS g, sum(total_runs) OVER ()::BIGINT AS t, total_runs::DOUBLE * (sum(games) OVER ())::DOUBLE / (games * sum(total_runs) OVER ())::DOUBLE AS f FROM b) "
    f"SELECT park, games, home_runs, away_runs, total_runs, ((2000 * total_runs + games) // (2 * games))::DOUBLE / 1000 AS runs_per_game, ((2000 * t + g) // (2 * g))::DOUBLE / 1000 AS league_rate, ((2000 * total_runs * g + games * t) // (2 * games * t))::DOUBLE / 1000 AS factor, {_LAB} AS label FROM x",
)
def a14(t: Tables):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    games = t.orders.select(F.when(c % 9 > 0, F.concat(F.lit("S"), (c % 9).cast("string"))).alias("park"), F.when(k % 13 > 0, k % 9).alias("h"), (c % 6).alias("a"))
    return splits.park_table(games, "park", "h", "a")


_PM = season.PEER_METRICS
_MILLI = {c: (f"CAST(round({c} * 1000) AS BIGINT)" if c in _PM[:4] else c) for c in _PM}


@query(
    "a29_seven_metrics",
    f"WITH {BAT}, s AS ({_SEASON_BAT}), z AS (SELECT player_id, 'pos' || (player_id % 9)::VARCHAR AS position, plate_appearances, {_AVG} AS avg, {_OBP} AS obp, {_SLG} AS slg, ({_M(_OBP)} + {_M(_SLG)}) / 1000.0::DOUBLE AS ops, home_runs, rbi, hits FROM s WHERE season = 1995), m AS (SELECT player_id, position, plate_appearances, {', '.join(f'{e} AS {c}' for c, e in _MILLI.items())} FROM z), p AS (SELECT position, count(*) AS n, {', '.join(f'sum({c})::BIGINT AS p_{c}' for c in _PM)} FROM m WHERE plate_appearances >= 10 GROUP BY 1) SELECT player_id, position, {', '.join(f'CASE WHEN n > 0 THEN floor((2.0::DOUBLE * {1 if c in _PM[:4] else 10} * ({c} * n - p_{c}) + n) / (2.0::DOUBLE * n)) / {1000 if c in _PM[:4] else 10}::DOUBLE END AS {c}_off' for c in _PM)} FROM m LEFT JOIN p USING (position)",
)
def a29(t: Tables):
    """Players of a position with enough plate appearances make the mean."""
    s = season.batting(bat(t), ["season", "player_id"]).where("season = 1995").withColumn("position", F.concat(F.lit("pos"), (F.col("player_id") % 9).cast("string")))
    return season.against_peers(s, "position")


@query(
    "a30_recent_team_rates",
    f"WITH {BAT}, {PIT}, g AS (SELECT DISTINCT team_code, game_id, date FROM (SELECT bat.team_code, bat.game_id, o_orderdate AS date FROM bat JOIN orders ON o_orderkey = game_id)), l AS (SELECT team_code, game_id FROM (SELECT *, row_number() OVER (PARTITION BY team_code ORDER BY date DESC, game_id DESC) AS rn FROM g) WHERE rn <= 5), u AS (SELECT team_code, count(*) AS sample_games FROM l GROUP BY 1), b AS (SELECT team_code, sum(hits)::BIGINT AS hits, sum(at_bats)::BIGINT AS at_bats FROM bat SEMI JOIN l USING (team_code, game_id) GROUP BY 1), "
    f"p AS (SELECT team_code, {SUMS(['earned_runs', 'innings_outs'])}, coalesce(sum(earned_runs) FILTER (NOT is_starting), 0)::BIGINT AS er, coalesce(sum(hits_allowed) FILTER (NOT is_starting), 0)::BIGINT AS h, coalesce(sum(walks_allowed) FILTER (NOT is_starting), 0)::BIGINT AS w, coalesce(sum(innings_outs) FILTER (NOT is_starting), 0)::BIGINT AS o FROM pit SEMI JOIN l USING (team_code, game_id) GROUP BY 1) "
    f"SELECT team_code, sample_games, {RATE('hits', 'at_bats', 3)} AS avg, {RATE('27 * earned_runs', 'innings_outs', 2)} AS era, {RATE('27 * er', 'o', 2, 'NULL')} AS bullpen_era, {RATE('3 * (h + w)', 'o', 2, 'NULL')} AS bullpen_whip, {RATE('o', '3', 1)} AS bullpen_ip FROM u LEFT JOIN b USING (team_code) LEFT JOIN p USING (team_code)",
)
def a30(t: Tables):
    games = bat(t).select("team_code", "game_id").distinct().join(t.orders.select(F.col("o_orderkey").alias("game_id"), F.col("o_orderdate").alias("date")), "game_id")
    return season.recent_teams(games, bat(t), pit(t))


@query(
    "a38_daily_coverage",
    "WITH x AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus <> 'P' AS c, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS m, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A') AS l, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 2) AS b, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 3) AS p FROM orders), d AS (SELECT date, count(*) AS total, count(*) FILTER (c) AS done, count(*) FILTER (c AND m AND l AND b AND p) AS full_, count(*) FILTER (c AND m) AS with_meta, count(*) FILTER (c AND l) AS with_lineup, count(*) FILTER (c AND b) AS with_batting, count(*) FILTER (c AND p) AS with_pitching FROM x GROUP BY 1) "
    f"SELECT date, total, done, full_ AS full, with_meta, with_lineup, with_batting, with_pitching, {RATE('full_', 'done', 3)} AS detail_coverage, {RATE('done', 'total', 3)} AS completion_rate FROM d",
)
def a38(t: Tables):
    """Completed games with all four parts, by day."""
    games = t.orders.select(F.col("o_orderkey").alias("game_id"), F.to_date("o_orderdate").alias("date"), (F.col("o_orderstatus") != "P").alias("completed"))
    part = lambda cond: t.lineitem.where(cond).select(F.col("l_orderkey").alias("game_id"))
    return season.coverage(games, {"meta": part("l_returnflag = 'R'"), "lineup": part("l_returnflag = 'A'"), "batting": part("l_linenumber = 2"), "pitching": part("l_linenumber = 3")})


@query("a42_both_qualifiers", "WITH g AS (SELECT year(o_orderdate)::BIGINT * 100 + o_custkey % 20 AS season, count(DISTINCT CAST(o_orderdate AS DATE)) AS games FROM orders GROUP BY 1) SELECT season, games, (CASE WHEN games >= 144 THEN 446 ELSE greatest(games * 31 // 10, 30) END)::BIGINT AS min_pa, (CASE WHEN games >= 144 THEN 432 ELSE greatest(games * 3, 90) END)::BIGINT AS min_outs FROM g")
def a42(t: Tables):
    return season.qualifiers(t.orders.select((F.year("o_orderdate").cast("long") * 100 + F.col("o_custkey") % 20).alias("season"), F.to_date("o_orderdate").alias("date")))


@query("w26_degradation", "WITH k AS (SELECT user_id, arg_min(CAST(round(value * 100) AS BIGINT), event_id) AS f, arg_max(CAST(round(value * 100) AS BIGINT), event_id) AS l, count(*) AS n FROM events GROUP BY 1) SELECT user_id, f AS first, l AS last, round((l - f)::DOUBLE / greatest(abs(f), 1) * 100, 1) AS pct_change FROM k WHERE n >= 2 AND (l - f)::DOUBLE / greatest(abs(f), 1) * 100 > 20")
def w26(t: Tables):
    """First against last beyond a threshold; a first value below 1 counts as 1."""
    c = F.round(F.col("value") * 100).cast("long")
    k = t.events.groupBy("user_id").agg(F.min_by(c, "event_id").alias("first"), F.max_by(c, "event_id").alias("last"), F.count("*").alias("n")).where("n >= 2")
    pct = (F.col("last") - F.col("first")).cast("double") / F.greatest(F.abs("first"), F.lit(1)) * 100
    return k.withColumn("p", pct).where("p > 20").select("user_id", "first", "last", F.round("p", 1).alias("pct_change"))


@query("w03_rank_by_metric", f"WITH {BAT}, s AS ({_SEASON_BAT}), z AS (SELECT season, player_id, plate_appearances, home_runs, hits FROM s), v AS (SELECT season, player_id, metric || CASE WHEN least = 1 THEN '_all' ELSE '' END AS category, CASE metric WHEN 'home_runs' THEN home_runs ELSE hits END AS value, plate_appearances >= 9 AS qualified FROM z, (SELECT unnest(['home_runs', 'hits']) AS metric), (SELECT unnest([9, 1]) AS least) WHERE plate_appearances >= least) SELECT season, category, player_id, value, qualified, rank() OVER (PARTITION BY season, category ORDER BY value DESC)::INT AS rank, coalesce(lag(value) OVER (PARTITION BY season, category ORDER BY value DESC, player_id) = value, false) AS is_tie FROM v")
def w03(t: Tables):
    """Ranks of the qualified and of all, by season and metric, from one pass over players."""
    s = season.batting(bat(t), ["season", "player_id"]).select("season", "player_id", "plate_appearances", "home_runs", "hits")
    variants = F.array(*[F.struct(F.lit(m + ("" if least > 1 else "_all")).alias("category"), F.col(m).alias("value"), F.lit(least).alias("least")) for m in ("home_runs", "hits") for least in (9, 1)])
    x = s.select("season", "player_id", "plate_appearances", F.explode(variants).alias("v")).where("plate_appearances >= v.least")
    x = x.select("season", "v.category", "player_id", "v.value", (F.col("plate_appearances") >= 9).alias("qualified"))
    return basics.competition_rank(x, "value", "player_id", within=["season", "category"])
