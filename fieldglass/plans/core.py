"""Filters, joins, aggregations, windows, sets, scalars and checks on the standard tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ratios import num, ratio
from ..operators import basics, postings, retrieval, standings
from ..operators.stored import built_once
from ..registry import Tables, query

DEC = "decimal(18,4)"


@query("f01_conjunctive_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('F','O') AND o_totalprice IS NOT NULL AND o_orderpriority <> '5-LOW'")
def f01(t: Tables):
    return t.orders.where(F.col("o_orderstatus").isin("F", "O") & F.col("o_totalprice").isNotNull() & (F.col("o_orderpriority") != "5-LOW")).select("o_orderkey", "o_totalprice")


@query("f02_season_filter", "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01'")
def f02(t: Tables):
    return t.orders.where("o_orderdate >= timestamp_ntz '1996-01-01' and o_orderdate < timestamp_ntz '1997-01-01'").select("o_orderkey")


@query("f03_contains_filter", "SELECT p_partkey, p_type FROM part WHERE contains(p_type, 'A')")
def f03(t: Tables):
    return t.part.where(F.col("p_type").contains("A")).select("p_partkey", "p_type")


@query("f04_negated_in", "SELECT event_id FROM events WHERE lower(event_type) NOT IN ('view', 'click')")
def f04(t: Tables):
    return t.events.where(~F.lower("event_type").isin("view", "click")).select("event_id")


@query("f05_stub_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 45 OR l_discount > 0.09 OR l_tax > 0.07")
def f05(t: Tables):
    return t.lineitem.where((F.col("l_quantity") > 45) | (F.col("l_discount") > 0.09) | (F.col("l_tax") > 0.07)).select("l_orderkey", "l_linenumber")


@query("f06_bitmask", "SELECT event_id, CAST(event_id % 8 AS BIGINT) AS base_state FROM events WHERE (event_id % 8) & 6 > 0")
def f06(t: Tables):
    s = (F.col("event_id") % 8).cast("long")
    return t.events.where(s.bitwiseAND(6) > 0).select("event_id", s.alias("base_state"))


@query("f07_unordered_pair", "SELECT least(l_suppkey % 10, l_partkey % 10) AS a, greatest(l_suppkey % 10, l_partkey % 10) AS b, count(*) AS n FROM lineitem GROUP BY 1, 2")
def f07(t: Tables):
    x, y = F.col("l_suppkey") % 10, F.col("l_partkey") % 10
    return t.lineitem.groupBy(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).agg(F.count("*").alias("n"))


@query("f08_keyword_or", "SELECT doc_id FROM documents WHERE contains(lower(text), 'license') OR contains(lower(text), 'token') OR contains(lower(source), 'src7')")
def f08(t: Tables):
    return t.documents.where(F.lower("text").contains("license") | F.lower("text").contains("token") | F.lower("source").contains("src7")).select("doc_id")


@query("f09_date_window", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-06-30' - 10 AND DATE '1995-06-30'")
def f09(t: Tables):
    end = F.lit("1995-06-30").cast("date")
    return t.orders.where(F.to_date("o_orderdate").between(F.date_sub(end, 10), end)).select("o_orderkey")


@query("f10_json_predicate", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) > 50")
def f10(t: Tables):
    k = F.get_json_object("props", "$.k").try_cast("long")
    return t.events.where(k > 50).select("event_id", k.alias("k"))


@query("f14_case_column", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN l_suppkey ELSE l_partkey END AS opponent FROM lineitem")
def f14(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_linestatus") == "O", F.col("l_suppkey")).otherwise(F.col("l_partkey")).alias("opponent"))


@query("j01_star_join", "SELECT o_orderkey, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'")
def j01(t: Tables):
    dim = t.nation.join(t.region.where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(dim, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "n_name", "r_name")


@query("j03_left_dim", "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)")
def j03(t: Tables):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select("doc_id", "quality")


@query("j04_anti_join", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def j04(t: Tables):
    return t.customer.join(t.orders.where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j05_anti_extra", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def j05(t: Tables):
    return t.customer.join(t.orders.where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j08_semi_join", "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def j08(t: Tables):
    return t.part.join(t.lineitem.where("l_quantity > 49"), F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey")


@query("j10_latest_row", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def j10(t: Tables):
    return t.events.groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type"))


@query("j13_scalar_count", "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer")
def j13(t: Tables):
    n = t.orders.groupBy("o_custkey").agg(F.count("*").alias("k"))
    return t.customer.join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("k", F.lit(0)).alias("n"))


@query(
    "j16_reconcile",
    """SELECT doc_id, CASE WHEN q IS NULL THEN 'missing_right' WHEN d IS NULL THEN 'missing_left' WHEN d <> q THEN 'mismatch' ELSE 'match' END AS status
    FROM (SELECT doc_id, CAST(doc_id % 2 AS INT) AS d FROM documents) FULL JOIN (SELECT doc_id, CAST(quality AS INT) AS q FROM labels) USING (doc_id)""",
)
def j16(t: Tables):
    return basics.reconcile(t.documents.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("v")), t.labels.select("doc_id", F.col("quality").cast("int").alias("v")), "doc_id", "v")


@query(
    "a01_batting_season_bulk",
    """SELECT l_partkey AS player_id, year(o_orderdate) AS season, count(*) AS games, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS at_bats,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS hits,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS avg
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def a01(t: Tables):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    g = j.groupBy(F.col("l_partkey").alias("player_id"), F.year("o_orderdate").alias("season")).agg(F.count("*").alias("games"), F.sum(num("l_quantity").cast(DEC)).cast("double").alias("at_bats"), F.sum(num("l_extendedprice").cast(DEC)).cast("double").alias("hits"))
    return g.withColumn("avg", ratio(F.col("hits"), F.col("at_bats")))


@query(
    "a03_conditional_sums",
    """SELECT l_suppkey AS player_id, count(*) FILTER (l_returnflag = 'R') AS wins, count(*) FILTER (l_returnflag = 'A') AS losses, count(*) FILTER (l_returnflag = 'N') AS saves,
        CAST(sum(CAST(l_linestatus = 'O' AS INT)) AS BIGINT) AS starts FROM lineitem GROUP BY 1""",
)
def a03(t: Tables):
    n = lambda x: F.count_if(F.col("l_returnflag") == x)
    return t.lineitem.groupBy(F.col("l_suppkey").alias("player_id")).agg(n("R").alias("wins"), n("A").alias("losses"), n("N").alias("saves"), F.sum((F.col("l_linestatus") == "O").cast("int")).alias("starts"))


@query(
    "a13_home_away_split",
    """WITH k AS (SELECT s_suppkey, side FROM supplier, (VALUES ('HOME'), ('AWAY')) v(side)),
    g AS (SELECT l_suppkey, CASE WHEN l_linestatus = 'O' THEN 'HOME' ELSE 'AWAY' END AS side, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS q FROM lineitem GROUP BY 1, 2)
    SELECT k.s_suppkey AS player_id, k.side AS location, coalesce(n, 0) AS games, coalesce(q, 0.0) AS total FROM k LEFT JOIN g ON g.l_suppkey = k.s_suppkey AND g.side = k.side""",
)
def a13(t: Tables):
    keys = t.supplier.select(F.col("s_suppkey").alias("player_id"), F.explode(F.array(F.lit("HOME"), F.lit("AWAY"))).alias("location"))
    side = F.when(F.col("l_linestatus") == "O", "HOME").otherwise("AWAY")
    g = t.lineitem.groupBy(F.col("l_suppkey").alias("player_id"), side.alias("location")).agg(F.count("*").alias("games"), F.sum(F.col("l_quantity").cast(DEC)).cast("double").alias("total"))
    return keys.join(g, ["player_id", "location"], "left").na.fill(0, ["games"]).na.fill(0.0, ["total"])


@query(
    "a15_clutch",
    """SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total,
        count(*) FILTER (abs(CAST(value AS DECIMAL(18,4)) - 245) <= 73.5) AS high_n FROM events GROUP BY 1""",
)
def a15(t: Tables):
    v = F.col("value").cast(DEC)
    return t.events.groupBy("user_id").agg(F.count("*").alias("n"), F.sum(v).cast("double").alias("total"), F.count_if(F.abs(v - 245) <= F.lit("73.5").cast(DEC)).alias("high_n"))


@query("a32_distinct_games", "SELECT l_suppkey, count(DISTINCT l_orderkey) AS games, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem GROUP BY 1")
def a32(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("games"), F.sum("l_linenumber").alias("total"))


@query("a33_mode", "SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn FROM events GROUP BY 1, 2) WHERE rn = 1")
def a33(t: Tables):
    g = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return basics.first_by(g, ["user_id"], [F.desc("n"), F.asc("event_type")]).select("user_id", "event_type")


@query("a35_duplicate_groups", "SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def a35(t: Tables):
    return t.documents.groupBy(F.sha2("text", 256).alias("h")).agg(F.count("*").alias("n")).where("n > 1")


@query("a39_monthly_trend", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS bad FROM orders GROUP BY 1")
def a39(t: Tables):
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("bad"))


@query("a40_max_pivot", "SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_partkey END) AS away, max(CASE WHEN l_linenumber = 2 THEN l_partkey END) AS home FROM lineitem GROUP BY 1")
def a40(t: Tables):
    at = lambda n: F.max(F.when(F.col("l_linenumber") == n, F.col("l_partkey")))
    return t.lineitem.groupBy("l_orderkey").agg(at(1).alias("away"), at(2).alias("home"))


@query("a42_qualifiers", "SELECT year(o_orderdate) AS season, count(DISTINCT CAST(o_orderdate AS DATE)) AS games, greatest(CAST(floor(least(count(DISTINCT CAST(o_orderdate AS DATE)), 144) * 31 / 10) AS BIGINT), 30) AS min_pa FROM orders GROUP BY 1")
def a42(t: Tables):
    g = t.orders.groupBy(F.year("o_orderdate").alias("season")).agg(F.count_distinct(F.to_date("o_orderdate")).alias("games"))
    return g.withColumn("min_pa", F.greatest(F.floor(F.least("games", F.lit(144)) * 31 / 10), F.lit(30)).cast("long"))


@query("a45_json_group", "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1")
def a45(t: Tables):
    return t.events.groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n"))


@query("a48_list_text", "SELECT conv_id, string_agg(role || ':' || CAST(turn AS VARCHAR), ' ' ORDER BY turn, role) AS line FROM conversations GROUP BY 1")
def a48(t: Tables):
    x = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda s: F.concat(s["role"], F.lit(":"), s["turn"].cast("string")))
    return t.conversations.groupBy("conv_id").agg(F.array_join(x, " ").alias("line"))


@query(
    "w01_source_priority",
    """SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY
        CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def w01(t: Tables):
    return basics.priority_dedup(t.events, ["user_id"], "event_type", ["purchase", "signup"], "event_id").select("user_id", "event_id")


@query(
    "w02_competition_rank",
    """SELECT p_partkey, p_brand, p_size, CAST(rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS INT) AS rank,
        coalesce(lag(p_size) OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) = p_size, false) AS is_tie FROM part""",
)
def w02(t: Tables):
    return basics.competition_rank(t.part.select("p_partkey", "p_brand", "p_size"), "p_size", "p_partkey", within=["p_brand"])


_GAMES = """WITH first AS (SELECT l_orderkey, min(s_nationkey) AS away FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
    g AS (SELECT o_orderkey AS game, CAST(o_orderdate AS DATE) AS date, c_nationkey AS home, away, CAST(o_orderkey % 7 AS BIGINT) AS hs, CAST(o_custkey % 7 AS BIGINT) AS vs
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN first ON l_orderkey = o_orderkey),
    s AS (SELECT game, date, home AS team, away AS opponent, hs AS scored, vs AS allowed, true AS is_home FROM g
        UNION ALL SELECT game, date, away, home, vs, hs, false FROM g),
    r AS (SELECT *, CASE WHEN scored > allowed THEN 'W' WHEN scored < allowed THEN 'L' ELSE 'D' END AS res FROM s),
    f1 AS (SELECT *, last_value(CASE WHEN res <> 'D' THEN res END IGNORE NULLS) OVER (PARTITION BY team ORDER BY date, game, is_home ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM r),
    f2 AS (SELECT *, sum(CASE WHEN res <> 'D' AND res IS DISTINCT FROM prev THEN 1 ELSE 0 END) OVER w AS island,
        last_value(CASE WHEN res <> 'D' THEN res END IGNORE NULLS) OVER w AS held FROM f1 WINDOW w AS (PARTITION BY team ORDER BY date, game, is_home ROWS UNBOUNDED PRECEDING)),
    f AS (SELECT team, game, date, opponent, is_home, res,
        CAST(count(*) FILTER (res = 'W') OVER w AS BIGINT) AS wins, CAST(count(*) FILTER (res = 'L') OVER w AS BIGINT) AS losses, CAST(count(*) FILTER (res = 'D') OVER w AS BIGINT) AS draws,
        CAST(sum(scored) OVER w AS BIGINT) AS runs_scored, CAST(sum(allowed) OVER w AS BIGINT) AS runs_allowed,
        CAST(count(*) FILTER (res = 'W') OVER t AS BIGINT) AS last10_wins, CAST(count(*) FILTER (res = 'L') OVER t AS BIGINT) AS last10_losses, CAST(count(*) FILTER (res = 'D') OVER t AS BIGINT) AS last10_draws,
        CAST(CASE held WHEN 'W' THEN 1 WHEN 'L' THEN -1 ELSE 0 END * count(*) FILTER (res <> 'D') OVER i AS BIGINT) AS streak
        FROM f2 WINDOW w AS (PARTITION BY team ORDER BY date, game, is_home ROWS UNBOUNDED PRECEDING), t AS (PARTITION BY team ORDER BY date, game, is_home ROWS 9 PRECEDING),
            i AS (PARTITION BY team, island ORDER BY date, game, is_home ROWS UNBOUNDED PRECEDING))
    """


def _games(t: Tables):
    first = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_orderkey").agg(F.min("s_nationkey").alias("away"))
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(first, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(F.col("o_orderkey").alias("game"), F.to_date("o_orderdate").alias("date"), F.col("c_nationkey").alias("home"), "away", (F.col("o_orderkey") % 7).cast("long").alias("hs"), (F.col("o_custkey") % 7).cast("long").alias("vs"))


_ROLES = {"game": "game", "date": "date", "home": "home", "away": "away", "home_score": "hs", "away_score": "vs"}


@query("w06_streak_form", _GAMES + "SELECT * FROM f")
def w06(t: Tables):
    return standings.form(_games(t), _ROLES)


@query(
    "w05_standings",
    _GAMES
    + """, l AS (SELECT date, team, wins, losses, draws, streak FROM (SELECT *, row_number() OVER (PARTITION BY date, team ORDER BY game DESC, is_home DESC) AS rn FROM f) WHERE rn = 1),
    spine AS (SELECT d.date, k.team FROM (SELECT DISTINCT date FROM l) d JOIN (SELECT team, min(date) AS since FROM l GROUP BY 1) k ON d.date >= k.since),
    dense AS (SELECT date, team, last_value(wins IGNORE NULLS) OVER w AS wins, last_value(losses IGNORE NULLS) OVER w AS losses, last_value(draws IGNORE NULLS) OVER w AS draws,
        last_value(streak IGNORE NULLS) OVER w AS streak FROM spine LEFT JOIN l USING (date, team) WINDOW w AS (PARTITION BY team ORDER BY date ROWS UNBOUNDED PRECEDING)),
    p AS (SELECT *, CASE WHEN wins + losses > 0 THEN wins / (wins + losses) ELSE 0.0 END AS pct FROM dense)
    SELECT date, team, wins, losses, draws, streak, round(pct, 4) AS win_pct, CAST(row_number() OVER d AS INT) AS rank,
        CAST(greatest(((first_value(wins) OVER d - wins) + (losses - first_value(losses) OVER d)) / 2, 0.0) AS DOUBLE) AS games_behind
    FROM p WINDOW d AS (PARTITION BY date ORDER BY pct DESC, wins DESC, team)""",
)
def w05(t: Tables):
    return standings.table(_games(t), _ROLES)


@query("a10_team_record", _GAMES + "SELECT team, count(*) FILTER (res = 'W') AS wins, count(*) FILTER (res = 'L') AS losses, count(*) FILTER (res = 'D') AS draws FROM r GROUP BY 1")
def a10(t: Tables):
    s = basics.two_sided(_games(t), "home", "away", "hs", "vs").withColumn("res", basics.outcome())
    return s.groupBy("team").agg(*[F.count_if(F.col("res") == x).alias(n) for x, n in (("W", "wins"), ("L", "losses"), ("D", "draws"))])


@query("a28_toughest_opponents", _GAMES + "SELECT team, opponent, count(*) FILTER (res = 'W') AS wins, count(*) FILTER (res = 'L') AS losses, round(count(*) FILTER (res = 'W') / count(*), 4) AS rate FROM r GROUP BY 1, 2")
def a28(t: Tables):
    s = basics.two_sided(_games(t), "home", "away", "hs", "vs").withColumn("res", basics.outcome())
    w = F.count_if(F.col("res") == "W")
    return s.groupBy("team", "opponent").agg(w.alias("wins"), F.count_if(F.col("res") == "L").alias("losses"), F.round(w / F.count("*"), 4).alias("rate"))


@query("a26_head_to_head", _GAMES + "SELECT least(home, away) AS a, greatest(home, away) AS b, count(*) AS games, count(*) FILTER (hs = vs) AS draws FROM g GROUP BY 1, 2")
def a26(t: Tables):
    return _games(t).groupBy(F.least("home", "away").alias("a"), F.greatest("home", "away").alias("b")).agg(F.count("*").alias("games"), F.count_if(F.col("hs") == F.col("vs")).alias("draws"))


@query(
    "w13_score_changes",
    """SELECT event_id, user_id, sign(d) AS side, CASE WHEN p IS NULL THEN false ELSE sign(d) <> sign(p) END AS lead_change FROM
    (SELECT event_id, user_id, d, lag(d) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM (SELECT event_id, user_id, CAST(sum(CASE WHEN event_type IN ('view','click') THEN 1 ELSE -1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS d FROM events))""",
)
def w13(t: Tables):
    w = W.partitionBy("user_id").orderBy("event_id")
    d = F.sum(F.when(F.col("event_type").isin("view", "click"), 1).otherwise(-1)).over(w.rowsBetween(W.unboundedPreceding, 0))
    x = t.events.select("event_id", "user_id", d.alias("d")).withColumn("p", F.lag("d").over(w))
    return x.select("event_id", "user_id", F.signum("d").cast("int").alias("side"), F.coalesce(F.signum("d") != F.signum("p"), F.lit(False)).alias("lead_change"))


@query("w16_turning_points", "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY abs(value) DESC, event_id) AS rn FROM events) WHERE rn <= 3")
def w16(t: Tables):
    w = W.partitionBy("user_id").orderBy(F.abs("value").desc(), "event_id")
    return t.events.withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("user_id", "event_id", "value")


@query(
    "w22_running_max_regress",
    """SELECT event_id, user_id, 'PBP-SCORE' AS rule FROM (SELECT event_id, user_id, value, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM events) WHERE value < top""",
)
def w22(t: Tables):
    w = W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, -1)
    return t.events.withColumn("top", F.max("value").over(w)).where("value < top").select("event_id", "user_id", F.lit("PBP-SCORE").alias("rule"))


@query("w23_previous_regress", "SELECT event_id, user_id FROM (SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) WHERE value < p")
def w23(t: Tables):
    w = W.partitionBy("user_id").orderBy("event_id")
    return t.events.withColumn("p", F.lag("value").over(w)).where("value < p").select("event_id", "user_id")


@query("t01_mixed_order", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50")
def t01(t: Tables):
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(50)


@query("t02_page", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 100")
def t02(t: Tables):
    return t.orders.select("o_orderkey").orderBy("o_orderkey").offset(100).limit(25)


@query("t04_top_per_group", "SELECT p_brand, p_partkey FROM (SELECT p_brand, p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r <= 5")
def t04(t: Tables):
    w = W.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return t.part.withColumn("r", F.rank().over(w)).where("r <= 5").select("p_brand", "p_partkey")


@query("u02_union_ids", "SELECT c_custkey AS id FROM customer UNION SELECT s_suppkey FROM supplier")
def u02(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("id")).union(t.supplier.select("s_suppkey")).distinct()


@query("u03_intersect", "SELECT o_custkey AS id FROM orders INTERSECT SELECT s_suppkey FROM supplier")
def u03(t: Tables):
    return t.orders.select(F.col("o_custkey").alias("id")).intersect(t.supplier.select("s_suppkey"))


@query("u04_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def u04(t: Tables):
    return t.documents.select("doc_id").subtract(t.labels.select("doc_id"))


@query("u06_keep_min", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def u06(t: Tables):
    return t.documents.groupBy(F.sha2("text", 256)).agg(F.min("doc_id").alias("doc_id")).select("doc_id")


@query("u08_normal_hash", r"SELECT doc_id, sha256(trim(regexp_replace(text, '[ \t\r\n\f\v]+', ' ', 'g'))) AS h FROM documents")
def u08(t: Tables):
    return t.documents.select("doc_id", F.sha2(F.trim(F.regexp_replace("text", r"[ \t\r\n\f\x0B]+", " ")), 256).alias("h"))


@query("x11_term_count", "SELECT doc_id, CAST((length(text) - length(replace(text, 'the', ''))) / 3 AS BIGINT) AS n FROM documents")
def x11(t: Tables):
    return t.documents.select("doc_id", retrieval.term_count(F.col("text"), "the").alias("n"))


@query("x15_iso_week", "SELECT o_orderkey, strftime(o_orderdate, '%G-W%V') AS week FROM orders")
def x15(t: Tables):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"), F.lpad(F.extract(F.lit("WEEK"), d).cast("string"), 2, "0")).alias("week"))


@query("x21_dot_product", "SELECT vec_id, round(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 4) AS norm2 FROM embeddings")
def x21(t: Tables):
    e = F.transform("embedding", lambda v: v.cast("double"))
    return t.embeddings.select("vec_id", F.round(F.aggregate(F.zip_with(e, e, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v), 4).alias("norm2"))


_HEAD = "CASE WHEN doc_id % 10 = 0 THEN 'License and token' WHEN doc_id % 10 = 1 THEN NULL WHEN doc_id % 10 = 2 THEN 'A token' ELSE source END"
_TF = lambda w: f"(length(t) - length(replace(t, '{w}', ''))) // {len(w)}"
_BM25 = f"""d AS (SELECT doc_id AS key, {_HEAD} AS title, coalesce(text, '') AS body FROM documents), p AS (SELECT *, lower(coalesce(title, '') || ' ' || body) AS u, lower(coalesce(title, 'None') || ' ' || body) AS t, lower(coalesce(title, '')) AS head FROM d),
    c AS (SELECT key, head, {_TF('license')} AS tf0, {_TF('token')} AS tf1, contains(u, 'license') AS i0, contains(u, 'token') AS i1, len(regexp_extract_all(u, '[^ \\t\\n\\r\\f\\x0B]+')) AS l0, len(regexp_extract_all(t, '[^ \\t\\n\\r\\f\\x0B]+')) AS len FROM p WHERE contains(lower(body), 'license') OR contains(lower(body), 'token') OR contains(head, 'license') OR contains(head, 'token')),
    s AS (SELECT count(*) AS n, greatest(avg(l0), 1) AS a, count(*) FILTER (i0) AS d0, count(*) FILTER (i1) AS d1 FROM c),
    x AS (SELECT *, CASE WHEN tf0 > 0 THEN greatest(0.0, ln((n - d0 + 0.5) / (d0 + 0.5) + 1)) * (tf0 * 2.5) / (tf0 + 1.5 * (0.25 + 0.75 * len / a)) * CASE WHEN contains(head, 'license') THEN 1.2 ELSE 1 END ELSE 0.0 END AS s0 FROM c, s)"""


@query(
    "k01_bm25",
    f"""WITH {_BM25} SELECT key, round(CASE WHEN tf1 > 0 THEN (s0 + greatest(0.0, ln((n - d1 + 0.5) / (d1 + 0.5) + 1)) * (tf1 * 2.5) / (tf1 + 1.5 * (0.25 + 0.75 * len / a))) * CASE WHEN contains(head, 'token') THEN 1.2 ELSE 1 END ELSE s0 END, 6) AS score FROM x ORDER BY score DESC, key LIMIT 20""",
)
def k01(t: Tables):
    """One question is answered by a scan; many are by the index, see ``keyword_index``."""
    return retrieval.bm25(t.documents.withColumn("title", F.expr(_HEAD)), "doc_id", "text", "title", ["license", "token"], 20)


def keyword_index(t: Tables, candidates: bool = False):
    """The keyword index of the documents, with what they may be filtered by and, if asked for, the tables for candidates; built at the first question."""
    k = F.col("doc_id")
    status = F.when(k % 5 == 1, "STALE").when(k % 5 == 2, "INDEXED").when(k % 5 > 2, "ACTIVE")
    category = F.when(k % 4 == 0, "notice").when(k % 4 == 1, "press_release").when(k % 4 == 2, "split")
    docs = t.documents.select("doc_id", "text", F.expr(_HEAD).alias("title"), status.alias("index_status"), category.alias("category"), "lang", F.sha2("text", 256).alias("content_hash"))
    meta = ["index_status", "category", "lang", "content_hash"]
    return built_once(t.spark, "candidates" if candidates else "keywords", [f"{t.folder}/documents.parquet"], lambda: postings.build(docs, "doc_id", "text", "title", meta, candidates))


@query(
    "k04_cosine_topk",
    """SELECT query_id, item_id, score, CAST(rank AS INT) AS rank FROM (SELECT q.vec_id AS query_id, e.vec_id AS item_id, s.score, row_number() OVER (PARTITION BY q.vec_id ORDER BY s.score DESC, e.vec_id) AS rank
        FROM embeddings e, embeddings q, LATERAL (SELECT round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS score) s WHERE q.vec_id % 50 = 0) WHERE rank <= 5""",
)
def k04(t: Tables):
    """Queries are the ids divisible by 50, against all rows."""
    return retrieval.cosine_topk(t.embeddings, t.embeddings.where("vec_id % 50 = 0"), "vec_id", "embedding", "vec_id", "embedding", 5)


@query(
    "v01_regression_pack",
    """SELECT 'price_negative' AS check_id, count(*) FILTER (l_extendedprice < 0) AS violations FROM lineitem
    UNION ALL SELECT 'discount_range', count(*) FILTER (l_discount < 0 OR l_discount > 0.08) FROM lineitem
    UNION ALL SELECT 'customer_missing', count(*) FROM orders ANTI JOIN customer ON o_custkey = c_custkey
    UNION ALL SELECT 'text_blank', count(*) FILTER (coalesce(trim(text), '') = '') FROM documents""",
)
def v01(t: Tables):
    one = lambda name, df, bad: df.agg(F.count_if(bad).alias("violations")).select(F.lit(name).alias("check_id"), "violations")
    orphans = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    checks = [
        one("price_negative", t.lineitem, F.col("l_extendedprice") < 0),
        one("discount_range", t.lineitem, (F.col("l_discount") < 0) | (F.col("l_discount") > 0.08)),
        one("customer_missing", orphans, F.lit(True)),
        one("text_blank", t.documents, F.coalesce(F.trim("text"), F.lit("")) == ""),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
