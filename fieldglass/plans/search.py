"""Retrieval, routing, entities, identity and record scalars on the standard tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import records
from ..operators import entities, postings, retrieval, season, standings, vectors
from ..operators.stored import built_once, settled, state_of
from ..registry import ORACLES, Tables, query
from .core import _HEAD, _ROLES, _games, keyword_index
from .league import _SEASON_BAT, _SEASON_PIT, BAT, PIT, PRATES, RATES, bat, pit
from .plays import ANY, MATCH

QUERIES = [
    "2023년 LG 홈런 순위 알려줘", "김도영의 타율은 왜 낮은가", "투구 규정 설명", "한국시리즈 결과", "왜 취소됐나", "이정후 프로필", "옛날 이야기", "2024 두산 방어율", "잠실 주차 안내", "박병호 2019 홈런", "12024 도루", "류현진은 누구", "KIA가 이긴 경기", "OPS 분석", "세이브 1위 1999년",
]
_TEXT = f"CASE event_id % {len(QUERIES) + 1} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(QUERIES)) + " ELSE '' END"
_QRY = f"q AS (SELECT event_id, {_TEXT} AS s, lower({_TEXT}) AS l FROM events)"


def _queries(t: Tables):
    return t.events.selectExpr("event_id", f"{_TEXT} AS s")


_STAT = MATCH(entities.STAT_TYPES, "l")
_INTENT = f"CASE WHEN ({_STAT} IS NOT NULL OR {ANY(entities.STAT_TERMS, 'l')}) AND {ANY(entities.EXPLANATION_TERMS, 'l')} THEN 'MIXED_QUERY' WHEN {_STAT} IS NOT NULL OR {ANY(entities.STAT_TERMS, 'l')} THEN 'STAT_QUERY' WHEN {ANY(entities.RULE_TERMS, 'l')} THEN 'RULE_QUERY' WHEN {ANY(entities.GAME_TERMS, 'l')} THEN 'GAME_QUERY' WHEN {ANY(entities.EXPLANATION_TERMS, 'l')} THEN 'EXPLANATION_QUERY' WHEN {ANY(entities.PROFILE_TERMS, 'l')} THEN 'ENTITY_LOOKUP' ELSE 'HISTORICAL_QUERY' END"
_YEAR = "TRY_CAST(nullif(regexp_extract(s, '(?:^|[^0-9])(198[0-9]|199[0-9]|20[0-2][0-9]|2030)(?:[^0-9]|$)', 1), '') AS INT)"
_ROUTED = f"r AS (SELECT *, {_INTENT} AS intent, {_STAT} AS stat, {_YEAR} AS y FROM q), p AS (SELECT *, CASE WHEN y IS NOT NULL OR event_id % 2 = 0 THEN CASE WHEN intent IN ('STAT_QUERY', 'ENTITY_LOOKUP') THEN 'STRUCTURED' WHEN intent = 'MIXED_QUERY' THEN 'MIXED' ELSE 'DOCUMENT' END ELSE 'DOCUMENT' END AS route FROM r)"


@query("k06_query_intent", f"WITH {_QRY}, {_ROUTED} SELECT event_id, intent, stat, route FROM p")
def k06(t: Tables):
    s = F.col("s")
    known = entities.year_of(s).isNotNull() | (F.col("event_id") % 2 == 0)
    return _queries(t).select("event_id", entities.intent(s).alias("intent"), entities.stat_type(s).alias("stat"), entities.route(s, known).alias("route"))


_KNOWN = "intent IN ('STAT_QUERY', 'ENTITY_LOOKUP', 'MIXED_QUERY') AND event_id % 3 > 0"
_WHICH = f"CASE WHEN stat = 'rank' AND y IS NOT NULL THEN 'standings' WHEN {_KNOWN} AND stat IN ('era', 'wins', 'saves', 'holds', 'innings_pitched') THEN 'pitching' WHEN {_KNOWN} AND intent = 'ENTITY_LOOKUP' AND stat IS NULL THEN 'profile' WHEN {_KNOWN} THEN 'batting' ELSE 'none' END"


@query(
    "k07_structured_rows",
    f"WITH {_QRY}, {_ROUTED}, w AS (SELECT *, {_WHICH} AS which FROM p), x AS (SELECT event_id, which, event_id % 100 + 1 AS player FROM w WHERE which <> 'none'), d AS (SELECT l_suppkey AS player, 'batting' AS which, sum(l_linenumber)::BIGINT AS v FROM lineitem GROUP BY 1 UNION ALL SELECT l_suppkey, 'pitching', count(*) FROM lineitem GROUP BY 1 UNION ALL SELECT s_suppkey, 'profile', s_nationkey::BIGINT FROM supplier) SELECT event_id, which, CASE which WHEN 'standings' THEN (SELECT count(*) FROM nation) ELSE v END AS v FROM x LEFT JOIN d USING (player, which)",
)
def k07(t: Tables):
    """Each query goes to the table that answers it; unresolved ones find nothing."""
    s = F.col("s")
    x = _queries(t).withColumn("player", F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 100 + 1))
    x = x.withColumn("which", entities.retriever(s, entities.year_of(s), F.col("player"))).where("which <> 'none'")
    lines = t.lineitem.groupBy(F.col("l_suppkey").alias("player")).agg(F.sum("l_linenumber").alias("batting"), F.count("*").alias("pitching"))
    stored = lines.join(t.supplier.select(F.col("s_suppkey").alias("player"), F.col("s_nationkey").cast("long").alias("profile")), "player", "full").unpivot("player", ["batting", "pitching", "profile"], "which", "v")
    table = t.nation.agg(F.count("*").alias("n"))
    x = x.select("event_id", "which", (F.col("event_id") % 100 + 1).alias("player")).join(stored, ["player", "which"], "left").crossJoin(F.broadcast(table))
    return x.select("event_id", "which", F.when(F.col("which") == "standings", F.col("n")).otherwise(F.col("v")).alias("v"))


_YEARED = "CASE WHEN event_id % 9 > 0 THEN (1992 + event_id % 7)::VARCHAR || '년 ' ELSE '' END"
_BATTING_METRICS = ("avg", "obp", "slg", "ops", "home_runs", "hits", "rbi", "stolen_bases")
_PITCHING_METRICS = {"era": "era", "wins": "wins", "saves": "saves", "holds": "holds", "innings_pitched": "innings_outs"}
_PICK = lambda names: "CASE stat " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in names) + " END"


@query(
    "k07_season_answers",
    f"WITH q AS (SELECT event_id, {_YEARED} || {_TEXT} AS s, lower({_YEARED} || {_TEXT}) AS l FROM events), {_ROUTED}, w AS (SELECT *, {_WHICH} AS which, 9990 + event_id % 150 AS player FROM p WHERE {_WHICH} <> 'none'), {BAT}, {PIT}, "
    f"bs AS (SELECT *, {RATES} FROM ({_SEASON_BAT})), ps AS (SELECT *, {PRATES} FROM ({_SEASON_PIT})), "
    f"b AS (SELECT event_id, which, 1 AS place, player_id::VARCHAR AS subject, coalesce({_PICK([(m, m) for m in _BATTING_METRICS])}, ops) AS value, games::DOUBLE AS support FROM w JOIN bs ON player_id = player AND season = y WHERE which = 'batting'), "
    f"t AS (SELECT event_id, which, 1 AS place, player_id::VARCHAR AS subject, coalesce({_PICK(_PITCHING_METRICS.items())}, era) AS value, strikeouts::DOUBLE AS support FROM w JOIN ps ON player_id = player AND season = y WHERE which = 'pitching'), "
    "d AS (SELECT s_suppkey + 9990 AS player, s_nationkey FROM supplier), f AS (SELECT event_id, which, 1 AS place, player::VARCHAR AS subject, s_nationkey::DOUBLE AS value, NULL::DOUBLE AS support FROM w JOIN d USING (player) WHERE which = 'profile'), "
    f"z AS ({ORACLES['w05_standings']}), last AS (SELECT year(date) AS yr, max(date) AS date FROM z GROUP BY 1), o AS (SELECT event_id, which, rank::INT AS place, team::VARCHAR AS subject, win_pct AS value, wins::DOUBLE AS support FROM w JOIN last ON yr = y JOIN z USING (date) WHERE which = 'standings' AND rank <= 5) "
    "SELECT * FROM b UNION ALL SELECT * FROM t UNION ALL SELECT * FROM f UNION ALL SELECT * FROM o",
)
def k07_seasons(t: Tables):
    """Each question is answered from the season's batting or pitching, the last standings of its year or the profile: the metric asked for and a figure beside it."""
    year = F.expr("CASE WHEN event_id % 9 > 0 THEN concat(1992 + event_id % 7, '년 ') ELSE '' END")
    asked, s = t.events.select("event_id", F.concat(year, F.expr(_TEXT)).alias("s")), F.col("s")
    said = asked.select("event_id", entities.year_of(s).alias("y"), entities.stat_type(s).alias("stat"), entities.intent(s).alias("intent"))
    said = settled(said)  # a few short columns; else each branch works them out of the text again, in a filter of 400,000 characters
    player = F.when(F.col("event_id") % 3 > 0, 9990 + F.col("event_id") % 150)
    asked = said.select("event_id", "y", "stat", player.alias("player"), entities.retriever_of(F.col("intent"), F.col("stat"), F.col("y"), player).alias("which"))
    pick = lambda names, default: F.coalesce(*[F.when(F.col("stat") == k, F.col(v).cast("double")) for k, v in names], F.col(default).cast("double"))
    by = lambda which, table: asked.where(F.col("which") == which).join(table, (F.col("player") == F.col("player_id")) & (F.col("y") == F.col("season")))
    answer = lambda df, place, subject, value, support: df.select("event_id", "which", place.cast("int").alias("place"), subject.cast("string").alias("subject"), value.alias("value"), support.cast("double").alias("support"))
    one = F.lit(1)
    batting = answer(by("batting", season.batting(bat(t), ["season", "player_id"])), one, F.col("player_id"), pick([(m, m) for m in _BATTING_METRICS], "ops"), F.col("games"))
    pitching = answer(by("pitching", season.pitching(pit(t), ["season", "player_id"])), one, F.col("player_id"), pick(_PITCHING_METRICS.items(), "era"), F.col("strikeouts"))
    profiles = t.supplier.select((F.col("s_suppkey") + 9990).alias("player"), "s_nationkey")
    profile = answer(asked.where("which = 'profile'").join(profiles, "player"), one, F.col("player"), F.col("s_nationkey").cast("double"), F.lit(None))
    table = standings.table(_games(t), _ROLES)
    latest = table.withColumn("yr", F.year("date")).withColumn("at", F.max("date").over(W.partitionBy("yr"))).where("date = at and rank <= 5")
    places = answer(asked.where("which = 'standings'").join(latest, F.col("y") == F.col("yr")), F.col("rank"), F.col("team"), F.col("win_pct"), F.col("wins"))
    return batting.unionByName(pitching).unionByName(profile).unionByName(places)


@query("k10_routing_accuracy", f"WITH {_QRY}, {_ROUTED} SELECT count(*) AS n, count(*) FILTER (intent = CASE event_id % 3 WHEN 0 THEN 'STAT_QUERY' WHEN 1 THEN 'MIXED_QUERY' ELSE 'GAME_QUERY' END) AS intent_right, count(*) FILTER (route = CASE event_id % 2 WHEN 0 THEN 'STRUCTURED' ELSE 'DOCUMENT' END) AS route_right FROM p")
def k10(t: Tables):
    """How often intent and route are as expected."""
    k = F.col("event_id") % 3
    want = F.when(k == 0, "STAT_QUERY").when(k == 1, "MIXED_QUERY").otherwise("GAME_QUERY")
    path = F.when(F.col("event_id") % 2 == 0, "STRUCTURED").otherwise("DOCUMENT")
    return k06(t).agg(F.count("*").alias("n"), F.count_if(F.col("intent") == want).alias("intent_right"), F.count_if(F.col("route") == path).alias("route_right"))


TEAMS = {"lg": "LG", "엘지": "LG", "두산": "DB", "kia": "KIA"}
STADIUMS = [("잠실", "JAMSIL"), ("문학", "MUNHAK")]
SUBJECTS = [("주차", "parking"), ("순위", "rank"), ("기록", "record")]
STOP = ["알려줘", "알려", "순위", "홈런", "타율", "왜", "낮은가", "결과", "프로필", "투구", "규정", "설명", "안내", "주차", "두산", "잠실", "방어율", "도루", "누구", "경기", "분석", "세이브", "년", "위", "이긴", "이야기", "옛날", "취소됐나", "한국시리즈"]
_TEAM = "CASE " + " ".join(f"WHEN regexp_matches(l, '(?:^|\\s){k}(?:$|\\s|의|는|은|이|가|와|과|도)') THEN '{v}'" for k, v in TEAMS.items()) + " END"
_STOPS = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"
_NAME = f"list_filter(list_transform(list_transform(string_split_regex(trim(s), '\\s+'), lambda w: regexp_replace(regexp_replace(w, '[^가-힣]', '', 'g'), '(해줘|알려줘|으로|에서|에게|께서)$', '')), lambda w: CASE WHEN length(w) >= 4 OR list_contains({_STOPS}, regexp_replace(w, '(의|은|는|이|가|을|를|와|과|도|에)$', '')) THEN regexp_replace(w, '(의|은|는|이|가|을|를|와|과|도|에)$', '') ELSE w END), lambda w: length(w) BETWEEN 2 AND 4 AND NOT list_contains({_STOPS}, w))[1]"


@query("x12_query_entities", f"WITH {_QRY} SELECT event_id, {_YEAR} AS year, {_TEAM} AS team, {MATCH(STADIUMS, 'l')} AS stadium, {MATCH(SUBJECTS, 'l')} AS subject, {_NAME} AS name FROM q")
def x12(t: Tables):
    s = F.col("s")
    low = F.lower(s)
    from ..functions.play_text import first_match

    return _queries(t).select("event_id", entities.year_of(s).alias("year"), entities.team_of(s, TEAMS).alias("team"), first_match(low, STADIUMS).alias("stadium"), first_match(low, SUBJECTS).alias("subject"), entities.name_candidate(s, STOP).alias("name"))


@query(
    "k08_resolved_names",
    "WITH p AS (SELECT c_custkey AS player_id, 'N' || (c_custkey % 700)::VARCHAR AS name, 'T' || (c_nationkey % 10)::VARCHAR AS team FROM customer), q AS (SELECT event_id AS query_id, 'N' || (event_id % 900)::VARCHAR AS name, CASE WHEN event_id % 2 = 0 THEN 'T' || (event_id % 10)::VARCHAR END AS team FROM events), j AS (SELECT query_id, count(player_id) AS n, min(player_id) AS p FROM q LEFT JOIN p ON p.name = q.name AND (q.team IS NULL OR p.team = q.team) GROUP BY 1) SELECT query_id, CASE WHEN n = 1 THEN p END AS player_id, n > 1 AS ambiguous FROM j",
)
def k08(t: Tables):
    players = t.customer.selectExpr("c_custkey AS player_id", "concat('N', c_custkey % 700) AS name", "concat('T', c_nationkey % 10) AS team")
    asked = t.events.selectExpr("event_id AS query_id", "concat('N', event_id % 900) AS name", "CASE WHEN event_id % 2 = 0 THEN concat('T', event_id % 10) END AS team")
    return entities.resolve_names(asked, players)


_CH = "SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'License and token' WHEN doc_id % 10 = 1 THEN NULL ELSE source END AS title, coalesce(text, '') AS content, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'STALE' WHEN 2 THEN 'INDEXED' ELSE 'ACTIVE' END AS index_status, CASE doc_id % 4 WHEN 0 THEN 'notice' WHEN 1 THEN 'press_release' WHEN 2 THEN 'split' END AS category, lang FROM documents"


def _chunks(t: Tables):
    k = F.col("doc_id")
    title = F.when(k % 10 == 0, "License and token").when(k % 10 != 1, F.col("source"))
    return t.documents.select("doc_id", title.alias("title"), F.coalesce("text", F.lit("")).alias("content"), F.when(k % 5 == 1, "STALE").when(k % 5 == 2, "INDEXED").when(k % 5 > 2, "ACTIVE").alias("index_status"), F.when(k % 4 == 0, "notice").when(k % 4 == 1, "press_release").when(k % 4 == 2, "split").alias("category"), "lang")


@query("k02_filtered_chunks", f"SELECT doc_id FROM ({_CH}) WHERE coalesce(index_status, 'ACTIVE') IN ('ACTIVE', 'INDEXED') AND category IN ('press_release', 'notice') AND lang = 'en' AND contains(lower(coalesce(title, '') || ' ' || content), 'the')")
def k02(t: Tables):
    """Status, category with what it stands for, exact values and words; a missing value does not match."""
    return _chunks(t).where(retrieval.chunk_filter("press_release", {"player_name": "The"}, lang="en")).select("doc_id")


@query("k03_candidates", f"SELECT doc_id FROM ({_CH}) WHERE contains(lower(coalesce(title, '')), 'token') OR contains(lower(content), 'token') OR contains(lower(coalesce(title, '')), 'license') OR contains(lower(content), 'license') ORDER BY doc_id LIMIT 1000")
def k03(t: Tables):
    """Candidates that hold any word, 1,000 or a hundred times k at most; the limit is the feature."""
    both = lambda w: F.lower("content").contains(w) | F.lower(F.coalesce("title", F.lit(""))).contains(w)
    return _chunks(t).where(both("token") | both("license")).select("doc_id").orderBy("doc_id").limit(1000)


_W = "len(regexp_extract_all({}, '[^ \\t\\n\\r\\f\\x0B]+'))"


@query(
    "k01_bm25_filtered",
    f"WITH c0 AS (SELECT doc_id AS key, lower(coalesce(title, '')) AS head, lower(coalesce(title, '') || ' ' || content) AS u, lower(coalesce(title, 'None') || ' ' || content) AS t FROM ({_CH}) WHERE coalesce(index_status, 'ACTIVE') IN ('ACTIVE', 'INDEXED') AND lang = 'en' AND (contains(lower(content), 'none') OR contains(lower(coalesce(title, '')), 'none'))), c AS (SELECT key, head, (length(t) - length(replace(t, 'none', ''))) // 4 AS tf, contains(u, 'none') AS i, {_W.format('u')} AS l0, {_W.format('t')} AS len FROM c0), s AS (SELECT count(*) AS n, greatest(avg(l0), 1) AS a, count(*) FILTER (i) AS df FROM c) SELECT key, round(CASE WHEN tf > 0 THEN greatest(0.0, ln((n - df + 0.5) / (df + 0.5) + 1)) * (tf * 2.5) / (tf + 1.5 * (0.25 + 0.75 * len / a)) * CASE WHEN contains(head, 'none') THEN 1.2 ELSE 1 END ELSE 0.0 END, 6) AS score FROM c, s ORDER BY score DESC, key LIMIT 15",
)
def k01_filtered(t: Tables):
    """Filters come before the statistics; a missing title reads as a word."""
    return retrieval.bm25(_chunks(t), "doc_id", "content", "title", ["none"], 15, where=retrieval.chunk_filter(lang="en"))


_EV = "SELECT vec_id, embedding, CASE vec_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'INDEXED' ELSE 'STALE' END AS index_status, 'T' || (vec_id % 3)::VARCHAR AS team_id, (2020 + vec_id % 2)::INT AS season_year FROM embeddings"


@query("k04_filtered_topk", f"WITH v AS ({_EV}), s AS (SELECT q.vec_id AS query_id, e.vec_id AS item_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 4) AS score FROM v e, embeddings q WHERE q.vec_id % 50 = 0 AND coalesce(e.index_status, 'ACTIVE') IN ('ACTIVE', 'INDEXED') AND team_id = 'T1' AND season_year = 2020) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id)::INT AS rank FROM s) WHERE rank <= 5")
def k04(t: Tables):
    """Filters by team, season and status, score to four places."""
    k = F.col("vec_id")
    v = t.embeddings.select("vec_id", "embedding", F.when(k % 4 == 1, "ACTIVE").when(k % 4 == 2, "INDEXED").when(k % 4 == 3, "STALE").alias("index_status"), F.concat(F.lit("T"), (k % 3).cast("string")).alias("team_id"), (2020 + k % 2).cast("int").alias("season_year"), F.lit("").alias("title"), F.lit("").alias("content"))
    return retrieval.cosine_topk(v.where(retrieval.chunk_filter(team_id="T1", season_year=2020)), t.embeddings.where("vec_id % 50 = 0"), "vec_id", "embedding", "vec_id", "embedding", 5, digits=4)


@query("k04_index_recall", "SELECT count(*) AS questions, TRUE AS enough FROM embeddings WHERE vec_id % 50 = 0")
def k04_index(t: Tables):
    """Every fiftieth vector asked of the index of all, held against exact search: nine tenths of the five nearest are found."""
    book, index = vector_index(t)
    asked = t.embeddings.where("vec_id % 50 = 0")
    found = vectors.search(index, book, asked, "vec_id", "embedding")
    return vectors.recall(found, t.embeddings, asked, "vec_id", "embedding", "vec_id", "embedding").select("questions", (F.col("recall") >= 0.9).alias("enough"))


_BOOKS: dict = {}


def vector_index(t: Tables):
    """(codebook, tables) of the embeddings, fitted and built at the first question."""
    path = f"{t.folder}/embeddings.parquet"
    key = (t.spark.sparkContext.applicationId, *state_of(t.spark, path))
    if key not in _BOOKS:
        _BOOKS[key] = vectors.fit(t.embeddings, "embedding")
    book = _BOOKS[key]
    index = built_once(t.spark, "vectors", [path], lambda: vectors.build(t.embeddings, "vec_id", "embedding", book))
    if book.probes is None:
        vectors.calibrate(index, book, t.embeddings, "vec_id", "embedding")
    return book, index


@query("t06_nearest", "SELECT e.vec_id, round(1 - list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS distance FROM embeddings e, embeddings q WHERE q.vec_id = 0 ORDER BY distance, e.vec_id LIMIT 10")
def t06(t: Tables):
    """The ten items nearest to one."""
    x = retrieval.cosine_topk(t.embeddings, t.embeddings.where("vec_id = 0"), "vec_id", "embedding", "vec_id", "embedding", 10)
    return x.select(F.col("item_id").alias("vec_id"), F.round(1 - F.col("score"), 6).alias("distance"))


_DN = "dn AS (SELECT q.vec_id AS query_id, e.vec_id AS item_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) DESC, e.vec_id) AS rd FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0 QUALIFY rd <= 15)"


#: Two words of a text as a question: the beginning of its first word of three letters or more, and the second.
_ASKED = "(SELECT {k} AS query_id, lower(substr(w[1], 1, 4)) AS a, lower(w[2]) AS b FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z]{{3,}}') AS w FROM documents WHERE {which}) WHERE len(w) > 1)"


def _asked(t: Tables, which: str):
    w = t.documents.where(which).select(F.col("doc_id").alias("query_id"), F.regexp_extract_all("text", F.lit("([A-Za-z]{3,})"), 1).alias("w")).where(F.size("w") > 1)
    return w.select("query_id", F.array(F.lower(F.substring(F.col("w")[0], 1, 4)), F.lower(F.col("w")[1])).alias("words"))


_RANKED = """q AS {asked}, d AS (SELECT doc_id AS item_id, lower(coalesce(title, '')) AS head, lower(coalesce(title, '') || ' ' || body) AS u, lower(coalesce(title, 'None') || ' ' || body) AS t FROM (SELECT doc_id, {head} AS title, coalesce(text, '') AS body FROM documents) {where}),
    l AS (SELECT *, len(regexp_extract_all(u, '[^ \\t\\n\\r\\f\\x0B]+')) AS l0, len(regexp_extract_all(t, '[^ \\t\\n\\r\\f\\x0B]+')) AS n FROM d),
    c AS (SELECT query_id, item_id, contains(head, a) AS ha, contains(head, b) AS hb, (length(t) - length(replace(t, a, ''))) // length(a) AS fa, (length(t) - length(replace(t, b, ''))) // length(b) AS fb, contains(u, a) AS ia, contains(u, b) AS ib, l0, n FROM l, q WHERE contains(u, a) OR contains(u, b)),
    z AS (SELECT query_id, count(*) AS m, greatest(avg(l0), 1) AS av, count(*) FILTER (ia) AS da, count(*) FILTER (ib) AS db FROM c GROUP BY 1),
    x AS (SELECT *, CASE WHEN fa > 0 THEN greatest(0.0, ln((m - da + 0.5) / (da + 0.5) + 1)) * (fa * 2.5) / (fa + 1.5 * (0.25 + 0.75 * n / av)) * CASE WHEN ha THEN 1.2 ELSE 1 END ELSE 0.0 END AS s0 FROM c JOIN z USING (query_id)),
    y AS (SELECT query_id, item_id, round(CASE WHEN fb > 0 THEN (s0 + greatest(0.0, ln((m - db + 0.5) / (db + 0.5) + 1)) * (fb * 2.5) / (fb + 1.5 * (0.25 + 0.75 * n / av))) * CASE WHEN hb THEN 1.2 ELSE 1 END ELSE s0 END, 6) AS score FROM x),
    sp AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id))::INT AS rs FROM y)"""


@query("k01_many_questions", "WITH " + _RANKED.format(asked=_ASKED.format(k="doc_id", which="doc_id % 10 = 0"), head=_HEAD, where="WHERE CASE doc_id % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE TRUE END") + " SELECT query_id, item_id AS key, score, rs AS rank FROM sp WHERE rs <= 5")
def k01_many(t: Tables):
    """A question for every tenth document in one plan, over what may be retrieved; no text but the questions' own is read."""
    open_ = F.coalesce("index_status", F.lit("ACTIVE")).isin("ACTIVE", "INDEXED")
    return postings.search(keyword_index(t), _asked(t, "doc_id % 10 = 0"), 5, where=open_)


@query("k03_index_candidates", f"WITH d AS (SELECT doc_id, lower(coalesce({_HEAD}, '') || ' ' || coalesce(text, '')) AS u FROM documents) SELECT doc_id FROM d WHERE contains(u, 'token') OR contains(u, 'license') ORDER BY doc_id LIMIT 1000")
def k03_index(t: Tables):
    """The same limit, candidates from postings."""
    asked = t.spark.createDataFrame([(0, ["token", "license"])], "query_id int, words array<string>")
    return postings.candidates(keyword_index(t, candidates=True), asked).select(F.col("key").alias("doc_id"))


_STALE = "sha256(text || CASE WHEN {k} % 3 = 0 THEN ' before' ELSE '' END)"


@query("k05_hybrid_search", "WITH " + _RANKED.format(asked=_ASKED.format(k="doc_id", which="doc_id % 50 = 0 AND doc_id IN (SELECT vec_id FROM embeddings)"), head=_HEAD, where="") + f""", {_DN},
    f AS (SELECT query_id, item_id, rs, rd, h, g FROM (SELECT query_id, item_id, rs, sha256(text) AS h FROM sp JOIN documents ON doc_id = item_id WHERE rs <= 15) FULL JOIN (SELECT query_id, item_id, rd, {_STALE.format(k='item_id')} AS g FROM dn LEFT JOIN documents ON doc_id = item_id WHERE query_id IN (SELECT query_id FROM q)) USING (query_id, item_id)),
    v AS (SELECT query_id, item_id, rs, CASE WHEN rs IS NULL OR h IS NOT DISTINCT FROM g THEN rd END AS rd FROM f),
    k AS (SELECT *, round(coalesce(1.0::DOUBLE / (2 + rs), 0) + coalesce(2.0::DOUBLE / (2 + rd), 0), 6) AS score FROM v)
    SELECT query_id, item_id, rank, rs AS bm25_rank, rd AS vector_rank, score FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, rs NULLS LAST, rd NULLS LAST))::INT AS rank FROM k) WHERE rank <= 5""")
def k05(t: Tables):
    """Keywords and vectors of the same question over the same chunks, 15 hits of each, 5 returned.

    A chunk's vector is the embedding of its id; of every third chunk the vector
    index still has the hash of an older text.
    """
    with_vector = t.embeddings.where("vec_id % 50 = 0").select("vec_id", "embedding")
    asked = _asked(t, "doc_id % 50 = 0").join(with_vector, F.col("query_id") == F.col("vec_id"))
    index = keyword_index(t)
    sparse = postings.search(index, asked, 15).join(index["docs"].select("key", "content_hash"), "key").select("query_id", F.col("key").alias("item_id"), "rank", "content_hash")
    dense = retrieval.cosine_topk(t.embeddings, asked, "vec_id", "embedding", "query_id", "embedding", 15)
    held = t.documents.select(F.col("doc_id").alias("item_id"), F.sha2(F.concat("text", F.when(F.col("doc_id") % 3 == 0, " before").otherwise("")), 256).alias("content_hash"))
    return retrieval.hybrid(sparse, dense.join(held, "item_id", "left"), 5)


@query(
    "k09_retrieval_metrics",
    f"WITH {_DN}, h AS (SELECT query_id, rd, label = ql AS good FROM dn JOIN embeddings ON vec_id = item_id JOIN (SELECT vec_id AS q, label AS ql FROM embeddings) ON q = query_id WHERE rd <= 5), g AS (SELECT vec_id AS query_id, (SELECT count(*) FROM embeddings x WHERE x.label = e.label) AS relevant FROM embeddings e WHERE vec_id % 50 = 0), m AS (SELECT query_id, relevant, count(*) FILTER (good) AS found, min(rd) FILTER (good) AS first FROM g LEFT JOIN h USING (query_id) GROUP BY 1, 2) SELECT query_id, found, round(found::DOUBLE / relevant, 6) AS recall, found::DOUBLE / 5 AS precision, coalesce(1.0::DOUBLE / first, 0) AS reciprocal, found > 0 AS hit FROM m",
)
def k09(t: Tables):
    """Recall, precision, reciprocal rank and hit of each query; items with its label are relevant."""
    top = retrieval.cosine_topk(t.embeddings, t.embeddings.where("vec_id % 50 = 0"), "vec_id", "embedding", "vec_id", "embedding", 5)
    labels = t.embeddings.select(F.col("vec_id").alias("item_id"), "label")
    asked = t.embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "label")
    sizes = labels.groupBy("label").agg(F.count("*").alias("relevant"))
    return retrieval.evaluate(top, asked.join(sizes, "label").select("query_id", "relevant"), asked.join(labels, "label").select("query_id", "item_id"), 5)


@query("k09_latency", "WITH s AS (SELECT (l_quantity * 10)::BIGINT AS ms, row_number() OVER (ORDER BY l_quantity) AS rn, count(*) OVER () AS n FROM lineitem) SELECT min(ms) FILTER (rn >= ceil(n * 0.5)) AS p50, min(ms) FILTER (rn >= ceil(n * 0.95)) AS p95, min(ms) FILTER (rn >= ceil(n * 0.99)) AS p99 FROM s")
def k09_latency(t: Tables):
    """Nearest-rank percentiles, from counts by value."""
    return retrieval.nearest_rank(t.lineitem.select((F.col("l_quantity") * 10).cast("long").alias("ms")), "ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@query("k09_selected_ranks", "WITH s AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) AS rn, count(*) OVER () AS n FROM lineitem WHERE l_extendedprice IS NOT NULL) SELECT min(v) FILTER (rn >= ceil(n * 0.5)) AS p50, min(v) FILTER (rn >= ceil(n * 0.95)) AS p95, min(v) FILTER (rn >= ceil(n * 0.999)) AS p999 FROM s")
def k09_selected(t: Tables):
    """Nearest ranks of fractional values, from the ranges that hold them."""
    return retrieval.selected_ranks(t.lineitem, "l_extendedprice", {"p50": 0.5, "p95": 0.95, "p999": 0.999})


_HASH = "CASE WHEN {k} % 11 = 0 THEN NULL ELSE 'h' || ({k} % {m})::VARCHAR END"


@query(
    "k11_index_findings",
    f"WITH p AS (SELECT doc_id AS key, {_HASH.format(k='doc_id', m=50)} AS h, CASE WHEN doc_id % 17 = 0 THEN '' ELSE 'v1' END AS ver, CASE WHEN doc_id % 6 = 0 THEN 'STALE' END AS st FROM documents WHERE doc_id % 9 <> 0), v AS (SELECT vec_id AS key, {_HASH.format(k='vec_id', m=25)} AS h, CASE WHEN vec_id % 8 = 0 THEN 'v0' ELSE 'v1' END AS ver, 'ACTIVE' AS st, vec_id % 13 <> 0 AS e FROM embeddings), x AS (SELECT coalesce(p.key, v.key) AS key, p.key AS pk, v.key AS vk, p.h AS ph, v.h AS vh, p.ver AS pv, v.ver AS vv, coalesce(p.st, 'ACTIVE') AS ps, v.st AS vs, e FROM p FULL JOIN v ON p.key = v.key) "
    "SELECT key, 'MISSING_IN_PRIMARY' AS issue FROM x WHERE pk IS NULL UNION ALL SELECT key, 'MISSING_IN_VECTOR' FROM x WHERE vk IS NULL UNION ALL SELECT key, CASE WHEN ph IS NULL OR vh IS NULL THEN 'CONTENT_HASH_MISSING' ELSE 'CONTENT_HASH_MISMATCH' END FROM x WHERE pk IS NOT NULL AND vk IS NOT NULL AND (ph IS NULL OR vh IS NULL OR ph <> vh) UNION ALL SELECT key, CASE WHEN pv = '' OR vv = '' THEN 'INDEX_VERSION_MISSING' ELSE 'INDEX_VERSION_MISMATCH' END FROM x WHERE pk IS NOT NULL AND vk IS NOT NULL AND (pv = '' OR vv = '' OR pv <> vv) UNION ALL SELECT key, 'VECTOR_EMBEDDING_MISSING' FROM x WHERE pk IS NOT NULL AND vk IS NOT NULL AND NOT e UNION ALL SELECT key, 'INDEX_STATUS_MISMATCH' FROM x WHERE pk IS NOT NULL AND vk IS NOT NULL AND ps <> vs",
)
def k11(t: Tables):
    h = lambda k, m: f"CASE WHEN {k} % 11 = 0 THEN NULL ELSE concat('h', {k} % {m}) END AS content_hash"
    p = t.documents.where("doc_id % 9 <> 0").selectExpr("doc_id AS key", h("doc_id", 50), "CASE WHEN doc_id % 17 = 0 THEN '' ELSE 'v1' END AS index_version", "CASE WHEN doc_id % 6 = 0 THEN 'STALE' END AS index_status")
    v = t.embeddings.selectExpr("vec_id AS key", h("vec_id", 25), "CASE WHEN vec_id % 8 = 0 THEN 'v0' ELSE 'v1' END AS index_version", "'ACTIVE' AS index_status", "vec_id % 13 <> 0 AS has_embedding")
    return entities.index_findings(p, v)


@query("k12_cache_by_hash", "WITH c AS (SELECT DISTINCT sha256(text) AS h FROM documents WHERE doc_id % 3 = 0 AND doc_id % 9 <> 0) SELECT doc_id, h IS NOT NULL AS hit FROM (SELECT doc_id, text FROM documents) d LEFT JOIN c ON h = sha256(d.text)")
def k12(t: Tables):
    """Texts whose hash is stored are hits; hashes whose vector is zero are not stored."""
    store = t.documents.where("doc_id % 3 = 0").select(F.sha2("text", 256).alias("h"), F.when(F.col("doc_id") % 9 == 0, F.array(F.lit(0.0))).otherwise(F.array(F.lit(1.0))).alias("v"))
    return retrieval.cache_hits(t.documents, "doc_id", "text", store.where(F.exists("v", lambda x: x != 0)).select("h").distinct())


# --- identity -----------------------------------------------------------------

_TH = ", ".join(f"({i}, {f}, '{c}', {a}, {b or 'NULL'})" for i, (f, c, a, b) in enumerate(entities.TEAM_HISTORY))
_CODES = [*dict.fromkeys(c for _, c, _, _ in entities.TEAM_HISTORY), "HD", "XX"]


@query(
    "e03_team_by_season",
    f"WITH th AS (SELECT * FROM (VALUES {_TH}) v(place, f, c, a, b)), s AS (SELECT o_orderkey, [{', '.join(chr(39) + c + chr(39) for c in _CODES)}][o_orderkey % {len(_CODES)} + 1] AS code, (1980 + o_custkey % 47)::INT AS y FROM orders), r AS (SELECT *, CASE WHEN code = 'HD' THEN 'HU' WHEN code = 'SSG' AND y BETWEEN 1991 AND 1999 THEN 'SL' ELSE code END AS raw FROM s), o AS (SELECT r.*, f, a, b FROM r LEFT JOIN th ON c = raw), z AS (SELECT o.*, t2.c AS other FROM o LEFT JOIN th t2 ON t2.f = o.f AND t2.a <= y AND coalesce(t2.b, y) >= y) SELECT o_orderkey, code, y, CASE WHEN team IS NOT NULL THEN f END AS franchise_id, team FROM (SELECT *, CASE WHEN a <= y AND coalesce(b, y) >= y THEN raw ELSE other END AS team FROM z)",
)
def e03(t: Tables):
    """The code a franchise had in a season."""
    codes = F.array(*map(F.lit, _CODES))
    x = t.orders.select("o_orderkey", F.get(codes, (F.col("o_orderkey") % len(_CODES)).cast("int")).alias("code"), (1980 + F.col("o_custkey") % 47).cast("int").alias("y"))
    return entities.team_by_season(x, "code", "y")


_ROWS = "q AS (SELECT event_id AS row_id, 'N' || (event_id % 260)::VARCHAR AS name, (1993 + event_id % 5)::BIGINT AS season, 'T' || (event_id % 7)::VARCHAR AS team, event_id % 11 AS uniform FROM events)"
_FACTS = "ov AS (SELECT 'N' || k::VARCHAR AS name, (1993 + k % 5)::BIGINT AS season, 900000 + k AS player_id FROM range(0, 260, 26) r(k)), se AS (SELECT DISTINCT o_custkey % 500 AS player_id, 'N' || (o_custkey % 250)::VARCHAR AS name, year(o_orderdate)::BIGINT AS season, 'T' || (o_orderkey % 7)::VARCHAR AS team FROM orders), pr AS (SELECT c_custkey % 500 AS player_id, 'N' || (c_custkey % 240)::VARCHAR AS name, 'T' || (c_custkey % 7)::VARCHAR AS team, c_custkey % 11 AS uniform FROM customer)"


def _one(on: str, facts: str) -> str:
    return f"(SELECT CASE WHEN min(player_id) = max(player_id) THEN min(player_id) WHEN count(*) > 0 THEN -1 END FROM {facts} f WHERE {' AND '.join(f'f.{c} = q.{c}' for c in on.split())})"


def _cascade(strict: bool) -> str:
    steps = [("override", _one("name season", "ov")), ("season", _one("name season team", "se")), ("profile_team", _one("name team", "pr")), ("profile_uniform", _one("name uniform", "pr"))]
    steps += [] if strict else [("unique_name", _one("name", "se")), ("relaxed", _one("name season", "se"))]
    cols = ", ".join(f"{s} AS s{i}" for i, (_, s) in enumerate(steps))
    first = "coalesce(" + ", ".join(f"s{i}" for i in range(len(steps))) + ")"
    step = "CASE " + " ".join(f"WHEN s{i} IS NOT NULL THEN CASE WHEN s{i} = -1 THEN 'ambiguous' ELSE '{n}' END" for i, (n, _) in enumerate(steps)) + " ELSE 'unknown' END"
    return f"WITH {_ROWS}, {_FACTS}, c AS (SELECT row_id, {cols} FROM q) SELECT row_id, nullif({first}, -1) AS player_id, {step} AS step FROM c"


def _resolve(t: Tables, strict: bool):
    rows = t.events.selectExpr("event_id AS row_id", "concat('N', event_id % 260) AS name", "1993 + event_id % 5 AS season", "concat('T', event_id % 7) AS team", "event_id % 11 AS uniform")
    over = t.spark.range(0, 260, 26).selectExpr("concat('N', id) AS name", "1993 + id % 5 AS season", "900000 + id AS player_id")
    seasons = t.orders.selectExpr("o_custkey % 500 AS player_id", "concat('N', o_custkey % 250) AS name", "CAST(year(o_orderdate) AS BIGINT) AS season", "concat('T', o_orderkey % 7) AS team").distinct()
    profiles = t.customer.selectExpr("c_custkey % 500 AS player_id", "concat('N', c_custkey % 240) AS name", "concat('T', c_custkey % 7) AS team", "c_custkey % 11 AS uniform")
    return entities.resolve_players(rows, over, seasons, profiles, strict)


@query("e01_player_cascade", _cascade(True))
def e01(t: Tables):
    """Steps in order; several candidates end the search."""
    return _resolve(t, True)


@query("e04_relaxed_resolution", _cascade(False))
def e04(t: Tables):
    """With the two lenient steps at the end."""
    return _resolve(t, False)


# --- scalars --------------------------------------------------------------------

_IDS = "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'bad' WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') || 'LGQQ0' ELSE strftime(o_orderdate + INTERVAL 29 YEAR, '%Y%m%d') || ['SSG', 'KIA', 'LG', 'KT'][o_custkey % 4 + 1] || ['NC', 'KH', 'DB'][o_custkey % 3 + 1] || (o_custkey % 3)::VARCHAR END AS id FROM orders"
_LEG = "CASE {c} WHEN 'SSG' THEN 'SK' WHEN 'KH' THEN 'WO' WHEN 'DB' THEN 'OB' WHEN 'KIA' THEN 'HT' ELSE {c} END"
_FIRST = "['SSG', 'KIA', 'LG', 'KT'][o_custkey % 4 + 1]"


@query(
    "x14_game_ids",
    f"WITH i AS ({_IDS.replace('SELECT o_orderkey,', 'SELECT o_orderkey, o_custkey,')}), p AS (SELECT o_orderkey, id, CASE WHEN o_orderkey % 6 > 1 THEN {_FIRST} END AS away, CASE WHEN o_orderkey % 6 > 1 THEN ['NC', 'KH', 'DB'][o_custkey % 3 + 1] END AS home FROM i) SELECT o_orderkey, id, away, home, CASE WHEN away IS NOT NULL AND substr(id, 1, 4)::INT >= 2024 THEN substr(id, 1, 8) || {_LEG.format(c='away')} || {_LEG.format(c='home')} || right(id, 1) ELSE id END AS legacy FROM p",
)
def x14(t: Tables):
    """Ids built, taken apart and given their legacy codes from 2024 on."""
    pick = lambda v, k: F.get(F.array(*map(F.lit, v)), (F.col("o_custkey") % k).cast("int"))
    built = entities.game_id(F.add_months(F.to_date("o_orderdate"), 29 * 12), pick(["SSG", "KIA", "LG", "KT"], 4), pick(["NC", "KH", "DB"], 3), F.col("o_custkey") % 3)
    k = F.col("o_orderkey") % 6
    x = t.orders.select("o_orderkey", F.when(k == 0, "bad").when(k == 1, F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("LGQQ0"))).otherwise(built).alias("id"))
    p = entities.game_id_parts(F.col("id"))
    return x.select("o_orderkey", "id", p["away"].alias("away"), p["home"].alias("home"), entities.legacy_game_id(F.col("id")).alias("legacy"))


@query("x13_snippets", "WITH d AS (SELECT doc_id, instr(lower(text), 'the') AS pos, text FROM documents WHERE lang = 'en') SELECT doc_id, regexp_replace(CASE WHEN pos > 0 THEN substr(text, greatest(1, pos - 40), 83) ELSE substr(text, 1, 80) END, '(?i)the', '**the**', 'g') AS snippet FROM d")
def x13(t: Tables):
    return t.documents.where("lang = 'en'").select("doc_id", records.snippet(F.col("text"), "the").alias("snippet"))


_DOT = "'{{\"a\": {{\"n\": ' || CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN '\"x\"' WHEN 2 THEN '-1.5' ELSE (event_id % 100)::VARCHAR END || '}}}}'"


@query("x16_dotted_path", f"SELECT event_id, CASE event_id % 4 WHEN 2 THEN -1.5 WHEN 3 THEN event_id % 100 END::DOUBLE AS n FROM events WHERE {_DOT.format()} IS NOT NULL")
def x16(t: Tables):
    """Numbers at a path of two steps; anything else is NULL."""
    value = F.expr("concat('{\"a\": {\"n\": ', CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN '\"x\"' WHEN 2 THEN '-1.5' ELSE CAST(event_id % 100 AS STRING) END, '}}')")
    return t.events.select("event_id", records.path_number(value, "a.n").alias("n"))


@query("x17_json_digest", "SELECT event_id, sha256('{\"a\":[1,2],\"k\":' || (props ->> '$.k') || ',\"t\":\"' || event_type || '\"}') AS digest, CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN '$.a[1]:2:3' ELSE '$.k:' || (props ->> '$.k') || ':<missing>' END AS diff FROM events")
def x17(t: Tables):
    """Digest of sorted JSON, and where two texts differ."""
    k = F.get_json_object("props", "$.k")
    value = F.concat(F.lit('{"t": "'), F.col("event_type"), F.lit('", "k": '), k, F.lit(', "a": [1, 2]}'))
    other = F.when(F.col("event_id") % 3 == 0, value).when(F.col("event_id") % 3 == 1, F.replace(value, F.lit("[1, 2]"), F.lit("[1, 3]"))).otherwise(F.concat(F.lit('{"a": [1, 2], "t": "'), F.col("event_type"), F.lit('"}')))
    diff = F.transform(records.json_differences(value, other), lambda d: F.concat_ws(":", d["path"], d["expected"], d["actual"]))
    return t.events.select("event_id", records.json_digest(value).alias("digest"), F.array_join(diff, ",").alias("diff"))


@query("x18_merged_maps", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'old' END AS a, 'old' AS b, CASE WHEN event_id % 2 = 0 THEN 'new' END AS c FROM events")
def x18(t: Tables):
    old = F.create_map(F.lit("a"), F.lit("old"), F.lit("b"), F.lit("old"))
    new = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("a"), F.col("event_type"), F.lit("c"), F.lit("new")))
    m = records.merge_maps(old, new)
    return t.events.select("event_id", *[F.try_element_at(m, F.lit(k)).alias(k) for k in "abc"])


@query("x19_unit_vectors", "WITH v AS (SELECT vec_id, list_resize(CAST(embedding[1:20] AS DOUBLE[]), 24, 0.0) AS v FROM embeddings) SELECT vec_id, round(v[1] / sqrt(list_inner_product(v, v)), 6) AS first, v[24] AS last, len(v)::INT AS size FROM v")
def x19(t: Tables):
    u = records.unit_vector(F.slice("embedding", 1, 20), 24)
    return t.embeddings.select("vec_id", F.round(F.element_at(u, 1), 6).alias("first"), F.element_at(u, 24).alias("last"), F.size(u).alias("size"))


@query("x22_all_numbers", "SELECT p_partkey, round(exp(p_size / 50.0), 6) AS e, round(ln(p_size + 1), 6) AS l, pow(p_size, 2)::DOUBLE AS p, bit_count(p_size)::INT AS bits FROM part")
def x22(t: Tables):
    n = F.col("p_size")
    return t.part.select("p_partkey", F.round(F.exp(n / 50.0), 6).alias("e"), F.round(F.log(n + 1), 6).alias("l"), F.pow(n, F.lit(2)).alias("p"), F.bit_count(n).alias("bits"))


_PROFILE = {
    "size": "CASE WHEN c_custkey % 7 = 0 THEN '-' ELSE concat(CAST(160 + c_custkey % 40 AS STRING), 'cm / ', CAST(60 + c_custkey % 50 AS STRING), 'KG') END",
    "hand": "CASE c_custkey % 5 WHEN 0 THEN '투수' WHEN 1 THEN '포수(우투우타)' WHEN 2 THEN '내야수(좌투 좌타)' WHEN 3 THEN '외야수(우투양타)' ELSE '투수(언투우타)' END",
    "born": "CASE c_custkey % 4 WHEN 0 THEN concat('19', CAST(70 + c_custkey % 30 AS STRING), '년 ', CAST(1 + c_custkey % 12 AS STRING), '월 0', CAST(1 + c_custkey % 9 AS STRING), '일') WHEN 1 THEN '1990.7.5' WHEN 2 THEN 'none' ELSE '1988-12-31' END",
    "pay": "CASE c_custkey % 6 WHEN 0 THEN '200,000달러' WHEN 1 THEN concat(CAST(c_custkey AS STRING), '만원') WHEN 2 THEN '-' WHEN 3 THEN '5000원' WHEN 4 THEN '$70' ELSE 'n/a' END",
}


@query(
    "x25_profile_texts",
    f"WITH p AS (SELECT c_custkey, {', '.join(f'{e} AS {c}' for c, e in _PROFILE.items())} FROM customer) SELECT c_custkey, (CASE WHEN c_custkey % 7 > 0 THEN 160 + c_custkey % 40 END)::INT AS height_cm, (CASE WHEN c_custkey % 7 > 0 THEN 60 + c_custkey % 50 END)::INT AS weight_kg, CASE c_custkey % 5 WHEN 1 THEN 'R' WHEN 3 THEN 'R' END AS throws, CASE c_custkey % 5 WHEN 1 THEN 'R' WHEN 3 THEN 'S' WHEN 4 THEN 'R' END AS bats, CASE c_custkey % 4 WHEN 0 THEN '19' || (70 + c_custkey % 30)::VARCHAR || '-' || lpad((1 + c_custkey % 12)::VARCHAR, 2, '0') || '-0' || (1 + c_custkey % 9)::VARCHAR WHEN 1 THEN '1990-07-05' WHEN 3 THEN '1988-12-31' END AS born, CASE c_custkey % 6 WHEN 0 THEN 200000 WHEN 1 THEN c_custkey * 10000 WHEN 3 THEN 5000 WHEN 4 THEN 70 END::BIGINT AS amount, CASE c_custkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'KRW' WHEN 3 THEN 'KRW' WHEN 4 THEN 'USD' END AS currency FROM p",
)
def x25(t: Tables):
    p = t.customer.selectExpr("c_custkey", *[f"{e} AS {c}" for c, e in _PROFILE.items()])
    return p.select("c_custkey", records.height_weight(F.col("size")).alias("a"), records.hands(F.col("hand")).alias("b"), records.birth_date(F.col("born")).alias("born"), records.money(F.col("pay")).alias("m")).select("c_custkey", "a.*", "b.*", "born", "m.*")


_ST = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, [NULL, 'completed', 'SCHEDULED', 'Cancel', 'x'][o_orderkey % 5 + 1] AS cur, [NULL, 'LIVE', 'postponed', 'scheduled'][o_custkey % 4 + 1] AS new, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_orderkey % 3 END AS h, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_orderkey % 2 END AS a, o_orderkey % 2 = 0 AS pg FROM orders"
_NORM = "CASE upper({c}) WHEN 'CANCEL' THEN 'CANCELLED' WHEN 'X' THEN NULL ELSE upper({c}) END"


@query(
    "x26_stable_status",
    f"WITH s AS ({_ST}), n AS (SELECT *, {_NORM.format(c='cur')} AS c, {_NORM.format(c='new')} AS w FROM s), e AS (SELECT *, coalesce(c IN ('COMPLETED', 'DRAW', 'CANCELLED', 'POSTPONED'), false) AS ce, coalesce(w IN ('COMPLETED', 'DRAW', 'CANCELLED', 'POSTPONED'), false) AS we FROM n) SELECT o_orderkey, CASE WHEN d > DATE '1996-06-15' THEN 'SCHEDULED' WHEN h IS NOT NULL AND a IS NOT NULL THEN CASE WHEN ce AND w IS NOT NULL AND NOT we THEN c WHEN h = a THEN 'DRAW' ELSE 'COMPLETED' END WHEN d = DATE '1996-06-15' THEN CASE WHEN pg THEN coalesce(w, 'LIVE') ELSE 'SCHEDULED' END WHEN we THEN w WHEN ce THEN c ELSE 'UNRESOLVED_MISSING' END AS status FROM e",
)
def x26(t: Tables):
    pick = lambda v, k: F.get(F.array(*map(F.lit, v)), k.cast("int"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    today = F.lit("1996-06-15").cast("date")
    status = entities.stable_status(F.to_date("o_orderdate"), today, pick([None, "completed", "SCHEDULED", "Cancel", "x"], k % 5), pick([None, "LIVE", "postponed", "scheduled"], c % 4), F.when(c % 3 != 0, k % 3), F.when(c % 5 != 0, k % 2), k % 2 == 0)
    return t.orders.select("o_orderkey", status.alias("status"))


@query(
    "x27_player_category",
    "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN CASE c_custkey % 3 WHEN 0 THEN 'MANAGER' WHEN 1 THEN 'COACH' ELSE 'STAFF' END ELSE CASE c_custkey % 4 WHEN 0 THEN 'MANAGER' WHEN 1 THEN 'COACH' ELSE CASE c_custkey % 5 WHEN 0 THEN 'RETIRED' WHEN 1 THEN 'RETIRED' WHEN 2 THEN 'RETIRED' ELSE 'ACTIVE' END END END AS category FROM customer",
)
def x27(t: Tables):
    pick = lambda v, k: F.get(F.array(*map(F.lit, v)), (F.col("c_custkey") % k).cast("int"))
    category = entities.player_category(F.col("c_custkey") % 10 == 0, pick(["manager", "coach", "other"], 3), pick(["감독", "타격코치", "투수", None], 4), pick([None, " - ", "은퇴", "LG", "두산"], 5))
    return t.customer.select("c_custkey", category.alias("category"))


@query("c06_row_sentences", "SELECT o_orderkey, concat('P', (o_custkey % 50)::VARCHAR, ' ', year(o_orderdate)::VARCHAR, ': status=', o_orderstatus, CASE WHEN o_custkey % 3 > 0 THEN ', priority=' || o_orderpriority ELSE '' END) AS sentence FROM orders")
def c06(t: Tables):
    """A row as a sentence; missing values are left out."""
    from ..operators.chunking import row_sentence

    x = t.orders.select("o_orderkey", F.concat(F.lit("P"), (F.col("o_custkey") % 50).cast("string")).alias("name"), F.year("o_orderdate").alias("season"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderpriority")).alias("priority"))
    return x.select("o_orderkey", row_sentence("name", "season", ["status", "priority"]).alias("sentence"))
