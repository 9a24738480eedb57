"""Splits, forms, fusion, evaluation and rule packs on the standard tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import basics
from ..registry import Tables, query



def cents(column: str):
    """Money as whole cents, so that sums do not depend on order."""
    return F.round(F.col(column) * 100).cast("long")


@query("s01_filtered_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 30")
def s01(t: Tables):
    return t.lineitem.where("l_returnflag = 'A' and l_quantity > 30").select("l_orderkey", "l_linenumber", "l_quantity")


@query("s19_keep_last", "SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY 1, 2")
def s19(t: Tables):
    """Of rows with one key the last stays."""
    return basics.first_by(t.events, ["user_id", "event_type"], [F.col("event_id").desc()]).select("user_id", "event_type", "event_id")


@query("s20_page", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 20 OFFSET 10")
def s20(t: Tables):
    return t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name").orderBy("c_custkey").offset(10).limit(20)


@query("s18_since_mark", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01'")
def s18(t: Tables):
    """Rows changed since the high-water mark; the filter reaches the scan."""
    return t.orders.where("o_orderdate >= timestamp_ntz '1997-06-01'").select("o_orderkey")


@query("j14_pivot_join", "SELECT c_custkey, coalesce(f, 0) AS n_f, coalesce(o, 0) AS n_o FROM customer LEFT JOIN (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def j14(t: Tables):
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(*[F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in ("F", "O")])
    return t.customer.select("c_custkey").join(counts, "c_custkey", "left").na.fill(0, ["n_f", "n_o"])


@query("j17_two_sides", "SELECT l_orderkey, l_linenumber, l_partkey AS team, l_suppkey AS opponent, true AS is_home FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, false FROM lineitem")
def j17(t: Tables):
    """Two rows a line, one from each side, from one scan."""
    return basics.two_sided(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount"), "l_partkey", "l_suppkey", "l_quantity", "l_discount").select("l_orderkey", "l_linenumber", "team", "opponent", "is_home")


@query("j18_semi_list", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def j18(t: Tables):
    return t.orders.join(t.customer.where("c_acctbal > 5000"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")


TOTALS = "count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS qty, sum(CAST(round(l_extendedprice * 100) AS BIGINT))::BIGINT AS cents"


def totals():
    return F.count("*").alias("n_lines"), F.sum("l_quantity").cast("long").alias("qty"), F.sum(cents("l_extendedprice")).alias("cents")


@query("a02_one_supplier", f"SELECT l_suppkey, {TOTALS} FROM lineitem WHERE l_suppkey = 7 GROUP BY 1 HAVING count(*) > 0")
def a02(t: Tables):
    """One player's season; no row where there is no game."""
    return t.lineitem.where("l_suppkey = 7").groupBy("l_suppkey").agg(*totals())


@query("a07_team_rollup", f"SELECT s_nationkey AS team, {TOTALS}, max(l_linenumber)::BIGINT AS games FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1")
def a07(t: Tables):
    """Player totals come before the join, so lines are not shuffled twice."""
    own = t.lineitem.groupBy("l_suppkey").agg(*totals(), F.max("l_linenumber").alias("games"))
    out = own.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_nationkey").alias("team"))
    return out.agg(*[F.sum(c).alias(c) for c in ("n_lines", "qty", "cents")], F.max("games").cast("long").alias("games"))


def pair_split(name: str, keys: tuple[str, str], doc: str):
    @query(name, f"SELECT {', '.join(keys)}, {TOTALS} FROM lineitem GROUP BY ALL")
    def split(t: Tables):
        return t.lineitem.groupBy(*keys).agg(*totals())

    split.__doc__ = doc
    return split


a16 = pair_split("a16_split_opponent", ("l_partkey", "l_returnflag"), "Batter by opponent.")
a17 = pair_split("a17_split_pitcher_opponent", ("l_suppkey", "l_returnflag"), "Pitcher by opponent.")
a18 = pair_split("a18_split_stadium", ("l_partkey", "l_linestatus"), "Batter by stadium.")


@query(
    "a20_first_match_counts",
    "SELECT user_id, count(*) FILTER (WHERE k = 'hit') AS hit, count(*) FILTER (WHERE k = 'walk') AS walk, count(*) FILTER (WHERE k = 'out') AS outs FROM (SELECT user_id, CASE WHEN event_type = 'purchase' THEN 'hit' WHEN event_type = 'signup' OR value > 400 THEN 'walk' ELSE 'out' END AS k FROM events) GROUP BY 1",
)
def a20(t: Tables):
    """Classes exclude each other: the first that matches counts."""
    kind = F.when(F.col("event_type") == "purchase", "hit").when((F.col("event_type") == "signup") | (F.col("value") > 400), "walk").otherwise("out")
    return t.events.select("user_id", kind.alias("k")).groupBy("user_id").agg(*[F.count_if(F.col("k") == k).alias(n) for k, n in (("hit", "hit"), ("walk", "walk"), ("out", "outs"))])


@query(
    "a22_situations",
    "SELECT user_id, s AS situation, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS hits FROM (SELECT *, unnest(list_filter([CASE WHEN event_id % 8 >= 2 THEN 'RISP' END, CASE WHEN event_id % 2 = 0 THEN 'vsL' ELSE 'vsR' END], lambda x: x IS NOT NULL)) AS s FROM events) GROUP BY ALL",
)
def a22(t: Tables):
    """Flags are independent: a row counts in each situation it is in."""
    labels = F.array_compact(F.array(F.when(F.col("event_id") % 8 >= 2, "RISP"), F.when(F.col("event_id") % 2 == 0, "vsL").otherwise("vsR")))
    return t.events.select("user_id", "event_type", F.explode(labels).alias("situation")).groupBy("user_id", "situation").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("hits"))


@query("a23_risp", "SELECT user_id, count(*) FILTER (WHERE event_type IN ('purchase', 'signup')) AS hits, count(*) AS n FROM events WHERE (event_id % 8) & 6 > 0 GROUP BY 1")
def a23(t: Tables):
    return t.events.where((F.col("event_id") % 8).bitwiseAND(6) > 0).groupBy("user_id").agg(F.count_if(F.col("event_type").isin("purchase", "signup")).alias("hits"), F.count("*").alias("n"))


@query("a25_two_out", "SELECT user_id, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents FROM events WHERE event_id % 3 = 2 GROUP BY 1")
def a25(t: Tables):
    return t.events.where("event_id % 3 = 2").groupBy("user_id").agg(F.count("*").alias("n"), F.sum(cents("value")).alias("cents"))


@query("a29_against_peers", "SELECT p_partkey, CAST(p_size AS BIGINT) * n - s AS above_times_n FROM part JOIN (SELECT p_brand, count(*) AS n, sum(p_size)::BIGINT AS s FROM part GROUP BY 1) USING (p_brand)")
def a29(t: Tables):
    """A row against the mean of its peers, times their number to stay whole; one row a peer group is joined."""
    peers = t.part.groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("p_size").alias("s"))
    return t.part.join(peers, "p_brand").select("p_partkey", (F.col("p_size").cast("long") * F.col("n") - F.col("s")).alias("above_times_n"))


@query("a30_recent_games", f"WITH g AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) SELECT o_custkey, {TOTALS} FROM g JOIN lineitem ON l_orderkey = o_orderkey WHERE rn <= 5 GROUP BY 1")
def a30(t: Tables):
    """The last five games of each team, then their lines."""
    w = W.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    games = t.orders.withColumn("rn", F.row_number().over(w)).where("rn <= 5").select("o_orderkey", "o_custkey")
    return t.lineitem.join(games, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(*totals())


@query("a38_coverage", "SELECT count(*) AS n, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')) AS covered FROM orders")
def a38(t: Tables):
    has = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("has", F.lit(True))
    return t.orders.select("o_orderkey").join(has, "o_orderkey", "left").agg(F.count("*").alias("n"), F.count("has").alias("covered"))


@query("w03_rank_variants", "SELECT s_suppkey, v AS variant, v = 'qualified' AS qualified, rank() OVER (PARTITION BY v ORDER BY q DESC)::INT AS rank FROM (SELECT l_suppkey AS s_suppkey, sum(l_quantity)::BIGINT AS q, count(*) AS n FROM lineitem GROUP BY 1), (VALUES ('qualified', 600), ('all', 1)) AS x(v, least) WHERE n >= least")
def w03(t: Tables):
    own = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum("l_quantity").cast("long").alias("q"), F.count("*").alias("n"))
    variants = F.array(*[F.struct(F.lit(v).alias("variant"), F.lit(least).alias("least")) for v, least in (("qualified", 600), ("all", 1))])
    rows = own.select("*", F.explode(variants).alias("x")).select("s_suppkey", "q", "n", "x.*").where("n >= least")
    return rows.select("s_suppkey", "variant", (F.col("variant") == "qualified").alias("qualified"), F.rank().over(W.partitionBy("variant").orderBy(F.desc("q"))).cast("int").alias("rank"))


@query("w04_resolved_metric", "SELECT event_id, coalesce(CASE WHEN value > 250 THEN CAST(round(value * 100) AS BIGINT) END, CAST(props ->> '$.k' AS BIGINT), CAST(props ->> '$.K' AS BIGINT)) AS metric FROM events")
def w04(t: Tables):
    """The column, else the extra field under either spelling."""
    extra = lambda k: F.get_json_object("props", f"$.{k}").cast("long")
    return t.events.select("event_id", F.coalesce(F.when(F.col("value") > 250, cents("value")), extra("k"), extra("K")).alias("metric"))


@query("w07_last_ten", "SELECT event_id, (sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w)::BIGINT AS wins, (sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w)::BIGINT AS losses FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)")
def w07(t: Tables):
    w = W.partitionBy("user_id").orderBy("event_id").rowsBetween(-9, 0)
    return t.events.select("event_id", *[F.sum(F.when(F.col("event_type") == x, 1).otherwise(0)).over(w).alias(n) for x, n in (("purchase", "wins"), ("error", "losses"))])


@query("w08_row_rank", "SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey)::INT AS rank FROM supplier")
def w08(t: Tables):
    return t.supplier.select("s_suppkey", F.row_number().over(W.partitionBy("s_nationkey").orderBy(F.desc("s_acctbal"), "s_suppkey")).cast("int").alias("rank"))


@query("w10_weekly", "SELECT o_custkey, strftime(o_orderdate, '%G-W%V') AS week, count(*) FILTER (WHERE o_orderstatus = 'F') AS wins, count(*) FILTER (WHERE o_orderstatus = 'O') AS losses FROM orders GROUP BY 1, 2")
def w10(t: Tables):
    week = F.format_string("%d-W%02d", F.expr("extract(YEAROFWEEK FROM o_orderdate)"), F.expr("extract(WEEK FROM o_orderdate)"))
    return t.orders.groupBy("o_custkey", week.alias("week")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("wins"), F.count_if(F.col("o_orderstatus") == "O").alias("losses"))


@query(
    "w11_current_streak",
    "WITH r AS (SELECT o_custkey, o_orderstatus AS s, row_number() OVER w AS rn, first_value(o_orderstatus) OVER w AS f FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)) SELECT o_custkey, any_value(f) AS result, coalesce(min(rn) FILTER (WHERE s <> f) - 1, count(*)) AS streak FROM r WHERE rn <= 10 GROUP BY 1",
)
def w11(t: Tables):
    """The run of equal results, counted from the last of ten games back."""
    w = W.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    r = t.orders.select("o_custkey", F.col("o_orderstatus").alias("s"), F.row_number().over(w).alias("rn"), F.first("o_orderstatus").over(w).alias("f")).where("rn <= 10")
    return r.groupBy("o_custkey").agg(F.min("f").alias("result"), F.coalesce(F.min(F.when(F.col("s") != F.col("f"), F.col("rn"))).cast("long") - 1, F.count("*")).alias("streak"))


@query("w18_half_totals", "SELECT user_id, sum(CASE WHEN event_id % 2 = 0 THEN c ELSE 0 END)::BIGINT AS top_cents, sum(CASE WHEN event_id % 2 = 1 THEN c ELSE 0 END)::BIGINT AS bottom_cents FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events) GROUP BY 1")
def w18(t: Tables):
    half = lambda h: F.sum(F.when(F.col("event_id") % 2 == h, cents("value")).otherwise(0))
    return t.events.groupBy("user_id").agg(half(0).alias("top_cents"), half(1).alias("bottom_cents"))


@query("w19_crucial", "SELECT event_id, value FROM (SELECT * FROM events ORDER BY abs(value - 245) DESC, event_id LIMIT 50) WHERE event_type <> 'view' ORDER BY abs(value - 245) DESC, event_id LIMIT 5")
def w19(t: Tables):
    """Sort, cut to ten times k, filter, cut to k: this order is the feature."""
    by = [F.abs(F.col("value") - 245).desc(), F.col("event_id")]
    return t.events.orderBy(*by).limit(50).where("event_type <> 'view'").orderBy(*by).limit(5).select("event_id", "value")


@query("w26_first_last_drop", "SELECT user_id, CAST(round(arg_min(value, event_id) * 100) AS BIGINT) AS first_cents, CAST(round(arg_max(value, event_id) * 100) AS BIGINT) AS last_cents FROM events GROUP BY 1")
def w26(t: Tables):
    return t.events.groupBy("user_id").agg(F.round(F.min_by("value", "event_id") * 100).cast("long").alias("first_cents"), F.round(F.max_by("value", "event_id") * 100).cast("long").alias("last_cents"))


@query("t03_latest_equals", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type = 'view'")
def t03(t: Tables):
    """The latest row first, the filter after."""
    last = t.events.groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), "event_id").alias("x"))
    return last.where("x.event_type = 'view'").select("user_id", "x.event_id")


@query("t05_top_scored", "SELECT doc_id, len(regexp_extract_all(lower(text), 'data')) AS score FROM documents ORDER BY score DESC, doc_id LIMIT 10")
def t05(t: Tables):
    return t.documents.select("doc_id", F.size(F.regexp_extract_all(F.lower("text"), F.lit("data"), 0)).cast("long").alias("score")).orderBy(F.desc("score"), "doc_id").limit(10)


@query("t07_milestones", "SELECT user_id, 100 - n % 100 AS remaining FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) WHERE 100 - n % 100 <= 30")
def t07(t: Tables):
    return t.events.groupBy("user_id").agg(F.count("*").alias("n")).select("user_id", (100 - F.col("n") % 100).alias("remaining")).where("remaining <= 30")


@query("u01_union_all", "SELECT 'c' AS side, c_nationkey AS k FROM customer UNION ALL SELECT 's', s_nationkey FROM supplier")
def u01(t: Tables):
    return t.customer.select(F.lit("c").alias("side"), F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.lit("s").alias("side"), F.col("s_nationkey").alias("k")))


@query("u05_distinct", "SELECT DISTINCT lang, source FROM documents")
def u05(t: Tables):
    return t.documents.select("lang", "source").distinct()


@query("u07_same_content", "SELECT min(doc_id) AS first_id, count(*) AS n, sha256(text) AS digest FROM documents WHERE text IS NOT NULL GROUP BY sha256(text) HAVING count(*) > 1")
def u07(t: Tables):
    """The digest is shuffled, not the text."""
    return t.documents.where("text is not null").groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")


@query("x02_clean_text", "SELECT p_partkey, upper(trim(replace(p_name, '-', ' '))) AS name, CAST(p_size AS VARCHAR) AS size FROM part")
def x02(t: Tables):
    return t.part.select("p_partkey", F.upper(F.trim(F.replace("p_name", F.lit("-"), F.lit(" ")))).alias("name"), F.col("p_size").cast("string").alias("size"))


@query("x10_query_words", "SELECT item_id, CASE WHEN len(w) > 0 THEN array_to_string(w, '|') ELSE text END AS words FROM (SELECT *, list_filter(regexp_extract_all(text, '[^ \\t\\n\\r]+'), lambda x: length(x) > 1) AS w FROM benchmark)")
def x10(t: Tables):
    """Words of two characters or more; the whole query where there are none."""
    words = F.filter(F.regexp_extract_all("text", F.lit(r"[^ \t\n\r]+"), 0), lambda x: F.length(x) > 1)
    return t.benchmark.select("item_id", F.when(F.size(words) > 0, F.array_join(words, "|")).otherwise(F.col("text")).alias("words"))


@query("x16_json_path", "SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
def x16(t: Tables):
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("x17_row_digest", "SELECT o_orderkey, sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)) AS digest FROM orders")
def x17(t: Tables):
    return t.orders.select("o_orderkey", F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus", "o_orderpriority"), 256).alias("digest"))


@query("k09_retrieval_eval", "WITH h AS (SELECT o_custkey AS q, o_orderkey % 7 AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) SELECT q, count(DISTINCT d) FILTER (WHERE d < 3) AS found, min(rn) FILTER (WHERE d < 3) AS first_rank FROM h WHERE rn <= 5 GROUP BY 1")
def k09(t: Tables):
    """Relevant hits among the first five and the rank of the first, from which recall and reciprocal rank follow."""
    w = W.partitionBy("q").orderBy("o_orderdate", "o_orderkey")
    h = t.orders.select(F.col("o_custkey").alias("q"), (F.col("o_orderkey") % 7).alias("d"), "o_orderdate", "o_orderkey").withColumn("rn", F.row_number().over(w).cast("long")).where("rn <= 5")
    good = F.col("d") < 3
    return h.groupBy("q").agg(F.count_distinct(F.when(good, F.col("d"))).alias("found"), F.min(F.when(good, F.col("rn"))).alias("first_rank"))


@query("k12_cache_misses", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)")
def k12(t: Tables):
    return t.documents.join(t.embeddings, F.col("doc_id") == F.col("vec_id"), "left_anti").select("doc_id")


RULES = {"LIN-001": "l_quantity > 45", "LIN-002": "l_discount > 0.09", "LIN-003": "l_tax > 0.07", "LIN-004": "l_extendedprice < l_quantity"}


@query("v02_rule_pack", " UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, '{n}' AS rule_id FROM lineitem WHERE {c}" for n, c in RULES.items()))
def v02(t: Tables):
    """All rules in one scan; a row for each rule that fails."""
    failing = F.array_compact(F.array(*[F.when(F.expr(c), F.lit(n)) for n, c in RULES.items()]))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.explode(failing).alias("rule_id"))


@query("v05_total_above_parts", "SELECT o_orderkey FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS c FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE coalesce(c, 0) > CAST(round(o_totalprice * 100) AS BIGINT) + 100")
def v05(t: Tables):
    """Only parts above the total count, beyond a tolerance."""
    parts = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(cents("l_extendedprice")).alias("c"))
    return t.orders.join(parts, "o_orderkey", "left").where(F.coalesce("c", F.lit(0)) > cents("o_totalprice") + 100).select("o_orderkey")


@query("v16_quarantine", "SELECT event_id, CASE WHEN value > 450 OR event_type = 'error' THEN 'quarantine' ELSE 'pass' END AS verdict FROM events")
def v16(t: Tables):
    bad = (F.col("value") > 450) | (F.col("event_type") == "error")
    return t.events.select("event_id", F.when(bad, "quarantine").otherwise("pass").alias("verdict"))


@query("v21_constraints", "SELECT count(*) FILTER (WHERE l_quantity < 0) AS n_negative, count(*) FILTER (WHERE l_discount > 1) AS n_above_one, count(*) FILTER (WHERE l_orderkey IS NULL) AS n_no_key FROM lineitem")
def v21(t: Tables):
    return t.lineitem.agg(F.count_if(F.expr("l_quantity < 0")).alias("n_negative"), F.count_if(F.expr("l_discount > 1")).alias("n_above_one"), F.count_if(F.expr("l_orderkey is null")).alias("n_no_key"))


@query("e02_unique_name", "SELECT s_suppkey, CASE WHEN n = 1 THEN k END AS c_custkey, coalesce(n, 0) AS n_candidates FROM supplier LEFT JOIN (SELECT c_nationkey, count(*) AS n, min(c_custkey) AS k FROM customer WHERE c_acctbal > 9500 GROUP BY 1) ON c_nationkey = s_nationkey")
def e02(t: Tables):
    """An id only where there is one candidate; several stay unresolved."""
    names = t.customer.where("c_acctbal > 9500").groupBy(F.col("c_nationkey").alias("s_nationkey")).agg(F.count("*").alias("n"), F.min("c_custkey").alias("k"))
    return t.supplier.join(names, "s_nationkey", "left").select("s_suppkey", F.when(F.col("n") == 1, F.col("k")).alias("c_custkey"), F.coalesce("n", F.lit(0)).alias("n_candidates"))
