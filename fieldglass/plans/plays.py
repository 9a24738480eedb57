"""Play-by-play operators on events made of the ``events`` table.

Users are games, event ids their order; innings, scores, runners and texts follow from
the ids by SQL that both engines read.  Scores and innings jump about, so every rule
of order has rows that break it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import play_text as text
from ..functions import rates
from ..operators import plays
from ..registry import ORACLES, Tables, query

TEXTS = [
    "양의지 : 좌중간 1루타", "김 : 우익수 뒤 홈런 (홈런거리:120M)", "이 : 3루타", "박 : 중견수 앞 2루타 1점 득점", "최 : 내야안타", "정 : 삼진 아웃", "강 : 볼넷", "조 : 고의4구", "윤 : 몸에 맞는 볼",
    "장 : 희생번트 아웃", "임 : 희생플라이 아웃", "한 : 실책으로 출루", "오 : 유격수 병살타", "서 : 좌익수 플라이 아웃", "신 : 2루수 땅볼 아웃", "권 : 도루 실패 아웃", "황 : 도루", "안 : 폭투로 진루", "송 : 주루사",
    "1구 볼", "2구 스트라이크", "3구 파울", "4구 헛스윙", "경기 시작", "6회초 LG 공격", " ", "1루주자 : 견제사", "2사 1,2루 2점 홈런", "무사 만루 쓰리런 홈런", "교체 : 투수 교체", "유 :  야수선택", "구 : 알 수 없음", "노아웃 끝내기 사구", "하 : 솔로 홈런",
]
EVENTS = {
    "game_id": "user_id",
    "event_seq": "event_id",
    "inning": "CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(1 + event_id % 12 AS INT) END",
    "inning_half": "CASE WHEN event_id % 2 = 0 THEN 'top' ELSE 'bottom' END",
    "outs": "CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(event_id % 5 AS INT) END",
    "runners": "CAST(CAST(floor(event_id / 3) AS BIGINT) % 8 AS INT)",
    "home_score": "CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(event_id % 7 AS INT) END",
    "away_score": "CAST(event_id % 11 % 6 AS INT)",
    "wpa": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id * 37 % 801 - 400 AS DOUBLE) / 1000 END",
    "description": f"CASE event_id % {len(TEXTS) + 1} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(TEXTS)) + " END",
    "event_type": "CASE event_type WHEN 'purchase' THEN 'batting' WHEN 'signup' THEN 'walk' WHEN 'error' THEN 'substitution' ELSE event_type END",
    "batter_name": "CASE WHEN event_id % 5 < 2 THEN NULL WHEN event_id % 5 = 2 THEN '' ELSE concat('B', CAST(event_id % 3 AS STRING)) END",
    "batter_id": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 40 END",
    "pitcher_id": "event_id % 15",
    "rbi": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_id % 4 END",
    "bases_before": "CASE WHEN event_id % 8 = 7 THEN '123' ELSE '1--' END",
    "balls": "CAST(NULL AS INT)",
    "strikes": "CAST(NULL AS INT)",
}
_REST = "trim(regexp_replace(trim({}), '^[^:]*:', ''))"


def MATCH(pairs, column: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({column}, '{w}') THEN '{v}'" for w, v in pairs) + " END"


def ANY(words, column: str) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


_CODE = MATCH(text.RESULT_CODES, "rest")
EV = f"e0 AS (SELECT {', '.join(f'{e} AS {c}' for c, e in EVENTS.items())} FROM events), e1 AS (SELECT *, {_REST.format('description')} AS rest FROM e0), e AS (SELECT *, {_CODE} AS result_code FROM e1)"


def events(t: Tables):
    x = t.events.selectExpr(*[f"{e} AS {c}" for c, e in EVENTS.items()])
    return x.withColumn("result_code", text.result_code(F.col("description")))


@query("x03_result_codes", f"WITH {EV} SELECT event_seq, result_code, CASE WHEN contains(description, ':') AND rest <> '' THEN coalesce(result_code, rest) END AS label FROM e")
def x03(t: Tables):
    d = F.col("description")
    return events(t).select("event_seq", "result_code", text.result_or_text(d).alias("label"))


_PLAY = "CASE WHEN rest NOT IN ('', 'empty') THEN rest END"
_OUTCOME = f"CASE WHEN contains(p, '도루') THEN CASE WHEN contains(p, '실패') THEN 'caught_stealing' ELSE 'stolen_base' END ELSE {MATCH(text.OUTCOMES, 'p')} END"


@query("x04_play_details", f"WITH {EV}, p AS (SELECT event_seq, {_PLAY} AS p FROM e), o AS (SELECT *, {_OUTCOME} AS outcome FROM p) SELECT event_seq, outcome, {MATCH(text.DIRECTIONS, 'p')} AS direction, CASE outcome {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in text.HIT_TYPES.items())} END AS hit_type FROM o")
def x04(t: Tables):
    d = F.col("description")
    return events(t).select("event_seq", text.outcome(d).alias("outcome"), text.direction(d).alias("direction"), text.hit_type(d).alias("hit_type"))


@query(
    "x05_situation_text",
    f"WITH {EV}, n AS (SELECT *, replace(replace(description, ',', '루 '), '루루', '루') AS t FROM e) SELECT event_seq, CASE WHEN contains(description, '만루') THEN 7 ELSE CASE WHEN contains(t, '1루') THEN 1 ELSE 0 END + CASE WHEN contains(t, '2루') THEN 2 ELSE 0 END + CASE WHEN contains(t, '3루') THEN 4 ELSE 0 END END AS runners, CASE WHEN {ANY(['2사', '투아웃'], 'description')} THEN 2 WHEN {ANY(['1사', '원아웃'], 'description')} THEN 1 ELSE 0 END AS outs, coalesce(TRY_CAST(regexp_extract(description, '([0-9]+)점\\s*(?:홈런|득점)', 1) AS INT), CASE WHEN contains(description, '솔로 홈런') THEN 1 WHEN contains(description, '투런 홈런') THEN 2 WHEN contains(description, '쓰리런 홈런') THEN 3 WHEN contains(description, '만루 홈런') THEN 4 ELSE 0 END) AS runs FROM n",
)
def x05(t: Tables):
    d = F.col("description")
    return events(t).select("event_seq", text.runners(d).alias("runners"), text.outs(d).alias("outs"), text.runs(d).alias("runs"))


_NOISE = "(t = '' OR " + " OR ".join(f"regexp_matches(t, '{p}')" for p in text.NOISE_PATTERNS) + f" OR {ANY(text.NOISE_WORDS, 't')})"
_KIND = f"CASE WHEN NOT noise AND contains(t, ':') AND NOT contains(r, '교체') AND {ANY(text.RESULT_WORDS, 'r')} THEN CASE WHEN contains(r, '도루') THEN 'steal' WHEN {ANY(text.ADVANCES, 'r')} THEN 'runner_advance' WHEN {ANY(text.RUNNER_OUTS, 'r')} THEN 'runner_out' ELSE 'batting' END ELSE 'unknown' END"
NOISY = f"c0 AS (SELECT *, trim(regexp_replace(coalesce(description, ''), '\\s+', ' ', 'g')) AS t FROM e), c AS (SELECT *, {_REST.format('t')} AS r, {_NOISE} AS noise FROM c0)"


@query("x06_event_kinds", f"WITH {EV}, {NOISY} SELECT event_seq, noise, {_KIND} AS kind FROM c")
def x06(t: Tables):
    d = F.col("description")
    return events(t).select("event_seq", text.is_noise(d).alias("noise"), text.event_kind(d).alias("kind"))


_PITCH = "nullif(regexp_extract(coalesce(description, ''), '^([0-9]+)구\\s+(볼|스트라이크|파울|헛스윙|폭투|포일)', 2), '')"


@query("x07_pitch_text", f"WITH {EV}, k AS (SELECT event_seq, {_PITCH} AS k FROM e) SELECT event_seq, CASE WHEN k IN ('볼', '폭투') THEN 1 WHEN k IN ('스트라이크', '헛스윙', '파울') THEN 0 END AS balls, CASE WHEN k IN ('볼', '폭투') THEN 0 WHEN k IN ('스트라이크', '헛스윙', '파울') THEN 1 END AS strikes FROM k")
def x07(t: Tables):
    d = F.col("description")
    return events(t).select("event_seq", text.pitch_balls(d).alias("balls"), text.pitch_strikes(d).alias("strikes"))


_IN = lambda codes: "(" + ", ".join(f"'{c}'" for c in codes) + ")"


@query("x08_code_predicates", f"WITH {EV} SELECT event_seq, coalesce(result_code IN {_IN(text.HITS)}, false) AS is_hit, coalesce(result_code IN {_IN(text.OUTS)}, false) AS is_out, coalesce(result_code IN {_IN(text.ON_BASE)}, false) AS is_on_base, coalesce(result_code NOT IN {_IN(text.NO_APPEARANCE)}, false) AS is_pa FROM e")
def x08(t: Tables):
    c = F.col("result_code")
    kinds = [text.is_code(c, k).alias(n) for k, n in ((text.HITS, "is_hit"), (text.OUTS, "is_out"), (text.ON_BASE, "is_on_base"))]
    return events(t).select("event_seq", *kinds, text.is_plate_appearance(c).alias("is_pa"))


# --- counts by batter, pitcher and situation --------------------------------

_BVP = f"CASE WHEN {ANY(['안타', '2루타', '3루타', '홈런'], 'd')} THEN 'hit' WHEN contains(d, '볼넷') THEN 'walk' WHEN contains(d, '사구') THEN 'hbp' WHEN contains(d, '희생플라이') THEN 'sf' WHEN contains(d, '희생번트') THEN 'sh' ELSE 'out' END"


def _f(cond: str, name: str) -> str:
    return f"count(*) FILTER ({cond}) AS {name}"


@query(
    "a20_batter_against_pitcher",
    f"WITH {EV}, k AS (SELECT *, coalesce(description, '') AS d, {_BVP.replace('(d,', '(coalesce(description, {}),'.format(chr(39) * 2))} AS k FROM e WHERE batter_id IS NOT NULL AND pitcher_id IS NOT NULL) SELECT batter_id, pitcher_id, count(*) AS pa, {', '.join(_f(c, n) for c, n in (('k IN (' + chr(39) + 'hit' + chr(39) + ', ' + chr(39) + 'out' + chr(39) + ')', 'ab'), ('k = ' + chr(39) + 'hit' + chr(39), 'h')))}, count(*) FILTER (k = 'hit' AND contains(d, '2루타')) AS d2, count(*) FILTER (k = 'hit' AND contains(d, '3루타') AND NOT contains(d, '2루타')) AS d3, count(*) FILTER (k = 'hit' AND contains(d, '홈런') AND NOT contains(d, '2루타') AND NOT contains(d, '3루타')) AS hr, count(*) FILTER (k = 'walk') AS bb, count(*) FILTER (k = 'hbp') AS hbp, count(*) FILTER (k = 'out' AND contains(d, '삼진')) AS so, count(*) FILTER (k = 'sf') AS sf, coalesce(sum(rbi), 0)::BIGINT AS rbi FROM k GROUP BY 1, 2",
)
def a20(t: Tables):
    """Each event is of one class, the first that fits; walks by other words are at-bats here."""
    d = F.coalesce("description", F.lit(""))
    k = F.when(text.any_of(d, ("안타", "2루타", "3루타", "홈런")), "hit").when(d.contains("볼넷"), "walk").when(d.contains("사구"), "hbp").when(d.contains("희생플라이"), "sf").when(d.contains("희생번트"), "sh").otherwise("out")
    base = F.when(d.contains("2루타"), "d2").when(d.contains("3루타"), "d3").when(d.contains("홈런"), "hr")
    x = events(t).where("batter_id is not null and pitcher_id is not null").withColumn("k", k).withColumn("base", F.when(F.col("k") == "hit", base)).withColumn("so", (F.col("k") == "out") & d.contains("삼진"))
    n = lambda c, v: F.count_if(F.col(c) == v)
    return x.groupBy("batter_id", "pitcher_id").agg(
        F.count("*").alias("pa"), F.count_if(F.col("k").isin("hit", "out")).alias("ab"), n("k", "hit").alias("h"), *[n("base", b).alias(b) for b in ("d2", "d3", "hr")],
        n("k", "walk").alias("bb"), n("k", "hbp").alias("hbp"), F.count_if("so").alias("so"), n("k", "sf").alias("sf"), F.coalesce(F.sum("rbi"), F.lit(0)).alias("rbi"),
    )


@query(
    "a22_situation_splits",
    f"WITH {EV}, h AS (SELECT k, CASE WHEN k % 7 = 0 THEN NULL WHEN k % 2 = 0 THEN 'L' ELSE 'R' END AS throws FROM range(0, 12) r(k)), s AS (SELECT e.*, coalesce(description, '') AS d, unnest(list_filter([CASE WHEN runners & 6 > 0 THEN 'RISP' END, 'vs' || coalesce(throws, 'R')], lambda v: v IS NOT NULL)) AS situation FROM e LEFT JOIN h ON pitcher_id = k WHERE batter_id IS NOT NULL), f AS (SELECT *, {ANY(['안타', '2루타', '3루타', '홈런'], 'd')} AS hit, {ANY(['볼넷', '사구'], 'd')} AS walk, {ANY(['희생플라이', '희생번트'], 'd')} AS sac FROM s) SELECT batter_id, situation, count(*) AS pa, count(*) FILTER (NOT walk AND NOT sac) AS ab, count(*) FILTER (hit) AS h, count(*) FILTER (walk) AS bb, count(*) FILTER (contains(d, '삼진')) AS so FROM f GROUP BY 1, 2",
)
def a22(t: Tables):
    """Runners in scoring position and the pitcher's hand (right where unknown); flags do not exclude each other."""
    hands = t.spark.range(12).select(F.col("id").alias("pitcher_id"), F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 2 == 0, "L").otherwise("R").alias("throws"))
    d = F.coalesce("description", F.lit(""))
    x = events(t).where("batter_id is not null").join(F.broadcast(hands), "pitcher_id", "left")
    labels = F.array_compact(F.array(F.when(F.col("runners").bitwiseAND(6) > 0, "RISP"), F.concat(F.lit("vs"), F.coalesce("throws", F.lit("R")))))
    x = x.select("batter_id", F.explode(labels).alias("situation"), text.any_of(d, ("안타", "2루타", "3루타", "홈런")).alias("hit"), text.any_of(d, ("볼넷", "사구")).alias("walk"), text.any_of(d, ("희생플라이", "희생번트")).alias("sac"), d.contains("삼진").alias("k"))
    return x.groupBy("batter_id", "situation").agg(F.count("*").alias("pa"), F.count_if(~F.col("walk") & ~F.col("sac")).alias("ab"), F.count_if("hit").alias("h"), F.count_if("walk").alias("bb"), F.count_if("k").alias("so"))


_NOAB, _H = "('BB', 'HBP', 'SH', 'SF')", "('H1', 'H2', 'H3', 'HR')"
_AB = f"count(*) FILTER (result_code NOT IN {_NOAB}) AS ab, count(*) FILTER (result_code IN {_H}) AS hits"


def _rate(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN floor((2000 * {a} + {b}) / (2.0 * {b})) / 1000 END"


def _ab():
    return F.count_if(~F.col("result_code").isin("BB", "HBP", "SH", "SF")).alias("ab"), F.count_if(F.col("result_code").isin("H1", "H2", "H3", "HR")).alias("hits")


@query("a23_scoring_position", f"WITH {EV}, g AS (SELECT batter_id, count(*) AS pa, {_AB} FROM e WHERE runners & 6 > 0 AND batter_id IS NOT NULL GROUP BY 1) SELECT *, {_rate('hits', 'ab')}::DOUBLE AS avg FROM g")
def a23(t: Tables):
    """Infield hits are not hits here."""
    g = events(t).where(F.col("batter_id").isNotNull() & (F.col("runners").bitwiseAND(6) > 0)).groupBy("batter_id").agg(F.count("*").alias("pa"), *_ab())
    return g.withColumn("avg", rates.rate("hits", "ab", 3, None))


@query(
    "a24_hand_splits",
    f"WITH {EV}, p AS (SELECT DISTINCT l_orderkey AS game, l_suppkey % 15 AS pitcher FROM lineitem WHERE l_orderkey <= 400), b AS (SELECT k, CASE WHEN k % 5 = 0 THEN 'S' WHEN k % 2 = 0 THEN 'L' ELSE 'R' END AS throws FROM range(0, 15) r(k)), g AS (SELECT batter_name, throws, {_AB}, count(*) FILTER (result_code IN ('BB', 'HBP')) AS reached, count(*) FILTER (result_code IN ('H1', 'H2', 'H3', 'HR', 'BB', 'HBP')) AS obp_events FROM e JOIN p ON game = game_id AND pitcher = pitcher_id JOIN b ON k = pitcher WHERE throws IN ('L', 'R') GROUP BY 1, 2) SELECT batter_name, throws, ab, hits, {_rate('hits', 'ab')}::DOUBLE AS avg, {_rate('obp_events', '(ab + reached)')}::DOUBLE AS obp FROM g",
)
def a24(t: Tables):
    """Events by the hand of the pitcher, who must have pitched in the game."""
    pitched = t.lineitem.where("l_orderkey <= 400").select(F.col("l_orderkey").alias("game_id"), (F.col("l_suppkey") % 15).alias("pitcher_id")).distinct()
    hands = t.spark.range(15).select(F.col("id").alias("pitcher_id"), F.when(F.col("id") % 5 == 0, "S").when(F.col("id") % 2 == 0, "L").otherwise("R").alias("throws")).where("throws in ('L', 'R')")
    c = F.col("result_code")
    g = events(t).join(pitched, ["game_id", "pitcher_id"]).join(F.broadcast(hands), "pitcher_id").groupBy("batter_name", "throws")
    g = g.agg(*_ab(), F.count_if(c.isin("BB", "HBP")).alias("reached"), F.count_if(c.isin("H1", "H2", "H3", "HR", "BB", "HBP")).alias("obp_events"))
    return g.select("batter_name", "throws", "ab", "hits", rates.rate("hits", "ab", 3, None).alias("avg"), rates.rate("obp_events", "ab + reached", 3, None).alias("obp"))


@query("a25_two_outs", f"WITH {EV}, g AS (SELECT batter_id, count(*) AS pa, {_AB}, coalesce(sum(rbi), 0)::BIGINT AS rbi FROM e WHERE outs = 2 AND batter_id IS NOT NULL GROUP BY 1) SELECT *, {_rate('hits', 'ab')}::DOUBLE AS avg FROM g")
def a25(t: Tables):
    g = events(t).where("outs = 2 and batter_id is not null").groupBy("batter_id").agg(F.count("*").alias("pa"), *_ab(), F.coalesce(F.sum("rbi"), F.lit(0)).alias("rbi"))
    return g.withColumn("avg", rates.rate("hits", "ab", 3, None))


@query("a15_clutch_totals", f"WITH {EV}, w AS (SELECT batter_id, CAST(round(coalesce(wpa, 0) * 1000) AS BIGINT) AS m, abs(CASE WHEN outs = 0 THEN 50 ELSE (event_seq % 101) END - 50) <= 15 AS high FROM e WHERE batter_id IS NOT NULL) SELECT batter_id, count(*) AS n, sum(m)::BIGINT AS wpa_milli, sum(abs(m))::BIGINT AS abs_milli, coalesce(sum(m) FILTER (high), 0)::BIGINT AS high_milli, count(*) FILTER (high) AS high_n, sum(m)::DOUBLE / count(*) AS mean_milli FROM w GROUP BY 1")
def a15(t: Tables):
    """Sums of changes, their sizes and those in close states; a win probability of 0 counts as one half."""
    we = F.when(F.col("outs") == 0, 50).otherwise(F.col("event_seq") % 101)
    x = events(t).where("batter_id is not null").select("batter_id", F.round(F.coalesce("wpa", F.lit(0.0)) * 1000).cast("long").alias("m"), (F.abs(we - 50) <= 15).alias("high"))
    return x.groupBy("batter_id").agg(F.count("*").alias("n"), F.sum("m").alias("wpa_milli"), F.sum(F.abs("m")).alias("abs_milli"), F.coalesce(F.sum(F.when(F.col("high"), F.col("m"))), F.lit(0)).alias("high_milli"), F.count_if("high").alias("high_n"), (F.sum("m").cast("double") / F.count("*")).alias("mean_milli"))


@query(
    "a44_sacrifices",
    f"WITH {EV}, n AS (SELECT game, name, min(id) AS id FROM (SELECT l_orderkey AS game, 'B' || (l_partkey % 3)::VARCHAR AS name, l_partkey % 12 AS id FROM lineitem WHERE l_orderkey <= 400) GROUP BY 1, 2 HAVING count(DISTINCT id) = 1), s AS (SELECT game_id, CASE WHEN batter_id IS NOT NULL THEN batter_id::VARCHAR WHEN coalesce(trim(batter_name), '') <> '' THEN coalesce(n.id::VARCHAR, trim(batter_name)) END AS player, contains(description, '희생번트') AS sh, contains(description, '희생플라이') AS sf FROM e LEFT JOIN n ON game = game_id AND name = trim(batter_name) WHERE contains(description, '희생번트') OR (contains(description, '희생플라이') AND (outs IS NULL OR outs < 2))) SELECT game_id, player, count(*) FILTER (sh) AS sh, count(*) FILTER (sf) AS sf FROM s WHERE player IS NOT NULL GROUP BY 1, 2",
)
def a44(t: Tables):
    """Sacrifices by batter id, else by a name that is one player's in the game, else by the name."""
    own = t.lineitem.where("l_orderkey <= 400").select(F.col("l_orderkey").alias("game_id"), F.concat(F.lit("B"), (F.col("l_partkey") % 3).cast("string")).alias("name"), (F.col("l_partkey") % 12).alias("id"))
    names = own.groupBy("game_id", "name").agg(F.min("id").alias("id"), F.count_distinct("id").alias("n")).where("n = 1").drop("n")
    d = F.col("description")
    x = events(t).where(d.contains("희생번트") | (d.contains("희생플라이") & (F.col("outs").isNull() | (F.col("outs") < 2)))).withColumn("name", F.trim("batter_name")).join(names, ["game_id", "name"], "left")
    player = F.coalesce(F.col("batter_id").cast("string"), F.when(F.coalesce("name", F.lit("")) != "", F.coalesce(F.col("id").cast("string"), F.col("name"))))
    return x.withColumn("player", player).where("player is not null").groupBy("game_id", "player").agg(F.count_if(d.contains("희생번트")).alias("sh"), F.count_if(d.contains("희생플라이")).alias("sf"))


# --- win probability ---------------------------------------------------------

_CELL = "round(0.5 + 0.07 * score_diff * (0.6 + 0.05 * inning) - 0.013 * outs + 0.005 * runners + CASE half WHEN 'top' THEN 0 ELSE 0.031 END, 4)"
MATRIX = f"m AS (SELECT *, ({_CELL})::DOUBLE AS win_prob FROM (SELECT inning, half, outs, runners, score_diff FROM (SELECT unnest([1, 5, 9]) AS inning), (SELECT unnest(['top', 'bottom']) AS half), (SELECT unnest([0, 1, 2]) AS outs), (SELECT unnest([0, 3]) AS runners), (SELECT unnest(range(-5, 6)) AS score_diff)))"


def matrix(t: Tables):
    """A stand-in table of win probabilities for three innings."""
    each = lambda name, *v: F.explode(F.array(*map(F.lit, v))).alias(name)
    x = t.spark.range(1).select(each("inning", 1, 5, 9)).select("*", each("half", "top", "bottom")).select("*", each("outs", 0, 1, 2)).select("*", each("runners", 0, 3)).select("*", each("score_diff", *range(-5, 6)))
    return x.withColumn("win_prob", F.expr(_CELL).cast("double"))


_RE = ", ".join(str(x) for row in plays.RUN_EXPECTANCY for x in row)


def PROB(inning: str, bottom: str, outs: str, runners: str, diff: str) -> str:
    """One state's win probability by scalar subqueries."""
    i, d = f"greatest(1, least(9, {inning}))", f"greatest(-5, least(5, {diff}))"
    half = f"CASE WHEN {bottom} THEN 'bottom' ELSE 'top' END"
    at = f"m.inning = {i} AND m.half = {half} AND m.outs = {outs} AND m.score_diff = {d}"
    bonus = f"0.02::DOUBLE * bit_count({runners}::INT)"
    runs = f"CASE WHEN {outs} BETWEEN 0 AND 2 AND {runners} BETWEEN 0 AND 7 THEN [{_RE}][{outs} * 8 + {runners} + 1]::DOUBLE ELSE 0 END"
    ahead = f"CASE WHEN {bottom} THEN {diff} + {runs} ELSE {diff} - {runs} END"
    left = f"greatest(0.5::DOUBLE, 9 - {i} + CASE WHEN {bottom} THEN 0 ELSE 0.5 END)"
    over = f"CASE WHEN {i} >= 9 AND {diff} > 0 AND ({bottom} OR {outs} = 3) THEN 1.0 WHEN {i} >= 9 AND {bottom} AND {diff} < 0 AND {outs} = 3 THEN 0.0 END"
    empty = f"(SELECT win_prob FROM m WHERE {at} AND m.runners = 0)"
    return f"coalesce((SELECT win_prob FROM m WHERE {at} AND m.runners = {runners}), CASE WHEN {bottom} THEN least(1.0::DOUBLE, {empty} + {bonus}) ELSE greatest(0.0::DOUBLE, {empty} - {bonus}) END, {over}, round(1 / (1 + exp(-(0.75 * ({ahead})) / sqrt({left}))), 4))::DOUBLE"


_STATES = "SELECT event_id, (1 + event_id % 12)::INT AS inning, event_id % 2 = 1 AS b, (event_id % 4)::INT AS outs, (event_id // 3 % 8)::INT AS runners, (event_id // 5 % 17 - 8)::INT AS diff FROM events"


@query("r10_win_probability", f"WITH {MATRIX}, s AS ({_STATES}) SELECT event_id, round({PROB('s.inning', 's.b', 's.outs', 's.runners', 's.diff')}, 4) AS p FROM s")
def r10(t: Tables):
    """Exact entry, empty bases with a bonus, or the closed form."""
    s = t.events.selectExpr("event_id", "CAST(1 + event_id % 12 AS INT) AS inning", "event_id % 2 = 1 AS b", "CAST(event_id % 4 AS INT) AS outs", "CAST(event_id div 3 % 8 AS INT) AS runners", "CAST(event_id div 5 % 17 - 8 AS INT) AS diff")
    return plays.win_probability(s, matrix(t), "p", "inning", "b", "outs", "runners", "diff").select("event_id", F.round("p", 4).alias("p"))


_VALID = "v AS (SELECT *, home_score - away_score AS diff, inning_half = 'bottom' AS b FROM e WHERE inning IS NOT NULL AND outs IS NOT NULL AND trim(coalesce(description, '')) <> '' AND home_score IS NOT NULL AND away_score IS NOT NULL AND runners IS NOT NULL), l AS (SELECT *, coalesce(CASE WHEN lag(inning) OVER w = inning AND lag(inning_half) OVER w = inning_half THEN lag(outs) OVER w END, 0) AS o0, coalesce(CASE WHEN lag(inning) OVER w = inning AND lag(inning_half) OVER w = inning_half THEN lag(runners) OVER w END, 0) AS r0, coalesce(lag(diff) OVER w, 0) AS d0 FROM v WINDOW w AS (PARTITION BY game_id ORDER BY event_seq))"
_TRANS = f"x AS (SELECT *, {PROB('l.inning', 'l.b', 'l.o0', 'l.r0', 'l.d0')} AS p0, {PROB('l.inning', 'l.b', 'l.outs', 'l.runners', 'l.diff')} AS p1 FROM l)"
_BASES = lambda c: " || ".join(f"CASE WHEN {c} & {b} > 0 THEN '{n}' ELSE '-' END" for b, n in ((1, 1), (2, 2), (4, 3)))


@query("w12_transitions", f"WITH {MATRIX}, {EV}, {_VALID}, {_TRANS} SELECT game_id, event_seq, {_BASES('r0')} AS bases_before, {_BASES('runners')} AS bases_after, diff AS score_diff, round(p0, 4) AS we_before, round(p1, 4) AS we_after, round(CASE WHEN b THEN p1 - p0 ELSE p0 - p1 END, 4) AS wpa FROM x")
def w12(t: Tables):
    """The state before is that of the valid event before it."""
    x = plays.transitions(events(t), matrix(t))
    return x.withColumn("we_before", F.round("we_before", 4)).withColumn("we_after", F.round("we_after", 4))


@query("r11_wpa", f"WITH {MATRIX}, {EV}, {_VALID}, {_TRANS} SELECT batter_id, count(*) AS n, CAST(sum(round((CASE WHEN b THEN p1 - p0 ELSE p0 - p1 END) * 10000)) AS BIGINT) AS wpa_parts FROM x GROUP BY 1")
def r11(t: Tables):
    """Changes of each batter, in ten-thousandths."""
    x = plays.transitions(events(t), matrix(t)).join(events(t).select("game_id", "event_seq", "batter_id"), ["game_id", "event_seq"])
    return x.groupBy("batter_id").agg(F.count("*").alias("n"), F.sum(F.round(F.col("wpa") * 10000).cast("long")).alias("wpa_parts"))


@query("w17_timeline", f"WITH {MATRIX}, {EV}, g AS (SELECT game_id, event_seq, coalesce(inning, 1) AS inning, inning_half = 'bottom' AS b FROM e), p AS (SELECT *, {PROB('g.inning', 'g.b', '1', '0', '0')} AS p FROM g) SELECT game_id, event_seq, row_number() OVER w::INT AS place, round(p, 4) AS home_win_prob, round(CASE WHEN b THEN p - coalesce(lag(p) OVER w, 0.5) ELSE coalesce(lag(p) OVER w, 0.5) - p END, 4) AS wpa FROM p WINDOW w AS (PARTITION BY game_id ORDER BY event_seq)")
def w17(t: Tables):
    """The score never advances here: one out, nobody on, all even."""
    x = plays.timeline(events(t).withColumn("inning", F.coalesce("inning", F.lit(1))).select("game_id", "event_seq", "inning", "inning_half"), matrix(t))
    return x.withColumn("home_win_prob", F.round("home_win_prob", 4))


# --- highlights and stories ---------------------------------------------------

_DIFFS = "b0 AS (SELECT *, coalesce(home_score, 0) - coalesce(away_score, 0) AS aft, coalesce(description, '') AS d, abs(coalesce(wpa, 0)) AS size, coalesce(inning, 1) AS inn FROM e), b AS (SELECT *, coalesce(lag(aft) OVER (PARTITION BY game_id ORDER BY event_seq), 0) AS bef FROM b0)"
_FLAG = "f AS (SELECT *, (inn >= 9 AND inning_half = 'bottom' AND bef <= 0 AND aft > 0) OR contains(d, '끝내기') AS wo, bef * aft < 0 AS lc, bef <> 0 AND aft = 0 AS ti, bef = 0 AND aft <> 0 AS ga, contains(d, '홈런') AS hr, bases_before = '123' AS fu FROM b)"


@query(
    "w13_highlights",
    f"WITH {EV}, {_DIFFS}, {_FLAG}, k AS (SELECT *, CASE WHEN wo THEN 'WALK_OFF' WHEN lc THEN 'LEAD_CHANGE' WHEN ti THEN 'GAME_TYING' WHEN ga THEN 'GO_AHEAD' WHEN size >= 0.05 THEN 'BIG_PLAY' ELSE 'OTHER' END AS highlight_type, concat_ws(',', CASE WHEN wo THEN '끝내기' END, CASE WHEN lc THEN '역전' END, CASE WHEN ti THEN '동점' END, CASE WHEN ga THEN '동점 균열' END, CASE WHEN fu THEN '만루' END, CASE WHEN contains(d, '병살') THEN '병살' END, CASE WHEN hr THEN '홈런' END, CASE WHEN hr AND fu THEN '만루홈런' END) AS tg FROM f) SELECT game_id, event_seq, highlight_type, round(size + CASE WHEN wo THEN 0.5 ELSE 0 END + CASE WHEN lc THEN 0.25 ELSE 0 END + CASE WHEN ti THEN 0.15 ELSE 0 END + CASE WHEN ga THEN 0.1 ELSE 0 END + CASE WHEN hr THEN 0.05 ELSE 0 END + 0.01 * inn, 4) AS importance, CASE WHEN tg = '' THEN '빅플레이' ELSE tg END AS tags FROM k WHERE highlight_type <> 'OTHER' OR hr",
)
def w13(t: Tables):
    return plays.highlights(events(t))


@query("w14_importance", f"WITH {EV}, {_DIFFS}, {_FLAG} SELECT game_id, CAST(sum(CASE WHEN wo THEN 50 ELSE 0 END + CASE WHEN lc THEN 25 ELSE 0 END + CASE WHEN ti THEN 15 ELSE 0 END + CASE WHEN ga THEN 10 ELSE 0 END + CASE WHEN hr THEN 5 ELSE 0 END + inn) AS BIGINT) AS bonus FROM f WHERE wo OR lc OR ti OR ga OR hr OR size >= 0.05 GROUP BY 1")
def w14(t: Tables):
    """What tags and innings add to the importance of a game's highlights, in hundredths."""
    x = plays.highlights(events(t)).join(events(t).select("game_id", "event_seq", "wpa"), ["game_id", "event_seq"])
    return x.groupBy("game_id").agg(F.sum(F.round((F.col("importance") - F.abs(F.coalesce("wpa", F.lit(0.0)))) * 100).cast("long")).alias("bonus"))


@query("w16_turning_bands", f"WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY abs(coalesce(wpa, 0)) DESC, event_seq) AS rn FROM e) SELECT game_id, event_seq, row_number() OVER (PARTITION BY game_id ORDER BY event_seq)::INT AS place, wpa, CASE WHEN abs(coalesce(wpa, 0)) >= 0.25 THEN 'GAME_CHANGER' WHEN abs(coalesce(wpa, 0)) >= 0.15 THEN 'CLUTCH' WHEN abs(coalesce(wpa, 0)) >= 0.08 THEN 'BIG_PLAY' ELSE 'MOMENTUM' END AS impact FROM r WHERE rn <= 5")
def w16(t: Tables):
    return plays.turning_points(events(t))


_STORY_TAGS = {
    "walk_off": "inning_half = 'bottom' AND inn >= 9 AND bef <= 0 AND aft > 0 AND runs > 0", "decisive_score": "dec", "lead_change": "bef * aft < 0", "go_ahead": "bef = 0 AND aft <> 0", "game_tying": "bef <> 0 AND aft = 0",
    "home_run": "result_code = 'HR' OR contains(t, '홈런')", "critical_error": "(contains(t, '실책') OR result_code IN ('E', 'ROE')) AND (runs > 0 OR size >= 0.2 OR inn >= 7)", "late_high_wpa": "inn >= 7 AND size >= 0.15", "high_wpa": "size >= 0.25",
    "scoring_play": "runs > 0 OR rb > 0 OR contains(t, '홈인')", "rbi": "rb > 0",
}


@query(
    "w15_story",
    f"WITH {EV}, {NOISY}, h AS (SELECT *, coalesce(last_value(home_score IGNORE NULLS) OVER w, 0) AS hs, coalesce(last_value(away_score IGNORE NULLS) OVER w, 0) AS aw FROM c WINDOW w AS (PARTITION BY game_id ORDER BY event_seq ROWS UNBOUNDED PRECEDING)), g AS (SELECT *, hs - aw AS aft, coalesce(lag(hs - aw) OVER w, 0) AS bef, greatest(0, hs + aw - coalesce(lag(hs + aw) OVER w, 0)) AS runs, abs(coalesce(wpa, 0)) AS size, coalesce(inning, 0) AS inn, coalesce(rbi, 0) AS rb, game_id % 3 - 1 AS fd FROM h WINDOW w AS (PARTITION BY game_id ORDER BY event_seq)), "
    f"p AS (SELECT * FROM g WHERE NOT noise AND event_type <> 'substitution'), d AS (SELECT *, coalesce(event_seq = max(CASE WHEN runs > 0 AND sign(aft) = sign(fd) AND sign(bef) <> sign(fd) AND fd <> 0 THEN event_seq END) OVER (PARTITION BY game_id), false) AS dec FROM p), k AS (SELECT *, list_filter([{', '.join(f'CASE WHEN {c} THEN {chr(39)}{n}{chr(39)} END' for n, c in _STORY_TAGS.items())}], lambda v: v IS NOT NULL) AS tg FROM d), "
    f"q AS (SELECT *, list_has_any(tg, [{', '.join(chr(39) + x + chr(39) for x in plays.PRIMARY)}]) AS pr FROM k), z AS (SELECT *, count(*) FILTER (pr) OVER (PARTITION BY game_id) AS n, row_number() OVER (PARTITION BY game_id, pr ORDER BY size DESC, event_seq) AS ex FROM q), y AS (SELECT * REPLACE (CASE WHEN pr THEN tg ELSE list_append(tg, 'wpa_supplement') END AS tg) FROM z WHERE pr OR ex <= 5 - n), "
    f"i AS (SELECT *, round(size * 100 + {' + '.join(f'CASE WHEN list_contains(tg, {chr(39)}{n}{chr(39)}) THEN {w} ELSE 0 END' for n, w in plays.STORY.items())}, 4) AS importance FROM y), o AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY importance DESC, size DESC, event_seq) AS rn FROM i) SELECT game_id, event_seq, importance, array_to_string(list_sort(tg), ',') AS tags FROM o WHERE rn <= 8",
)
def w15(t: Tables):
    finals = t.events.select(F.col("user_id").alias("game_id")).distinct().withColumn("final_diff", F.col("game_id") % 3 - 1)
    return plays.story(events(t), finals)


# --- at-bats, state rules, linescores -------------------------------------------

_T = "event_type IN ('batting', 'walk', 'strikeout', 'hit_by_pitch')"


@query(
    "w20_at_bats",
    f"WITH {EV}, a AS (SELECT *, coalesce(batter_name, '') <> '' AS nm FROM e), b AS (SELECT *, last_value(CASE WHEN nm THEN coalesce(inning, -1) END IGNORE NULLS) OVER w AS li, last_value(CASE WHEN nm THEN inning_half END IGNORE NULLS) OVER w AS lh, last_value(CASE WHEN nm THEN batter_name END IGNORE NULLS) OVER w AS lb FROM a WINDOW w AS (PARTITION BY game_id ORDER BY event_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
    f"c AS (SELECT *, CASE WHEN (lb IS NOT NULL AND (li <> coalesce(inning, -1) OR lh <> inning_half)) OR (nm AND lb IS NOT NULL AND lb <> batter_name) OR (nm AND lb IS NULL) THEN 1 ELSE 0 END AS cut FROM b), d AS (SELECT *, sum(cut) OVER (PARTITION BY game_id ORDER BY event_seq) AS part FROM c), f AS (SELECT *, greatest(cut, CASE WHEN {_T} AND coalesce(sum(CASE WHEN {_T} THEN 1 ELSE 0 END) OVER (PARTITION BY game_id, part ORDER BY event_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 THEN 1 ELSE 0 END) AS beg FROM d) SELECT game_id, event_seq, (sum(beg) OVER (PARTITION BY game_id ORDER BY event_seq))::BIGINT AS at_bat FROM f",
)
def w20(t: Tables):
    return plays.at_bats(events(t)).select("game_id", "event_seq", "at_bat")


_W21 = (
    f"WITH {EV}, ab AS (" + ORACLES["w20_at_bats"] + f"), p AS (SELECT e.game_id, e.event_seq, at_bat, coalesce({_PITCH}, '') AS kind, coalesce(balls, 0)::INT AS b, coalesce(strikes, 0)::INT AS s FROM e JOIN ab USING (game_id, event_seq) WHERE at_bat IS NOT NULL), "
    "l AS (SELECT game_id, at_bat, list({'seq': event_seq, 'kind': kind, 'b': b, 's': s, 'out': []::STRUCT(seq BIGINT, b INT, s INT)[]} ORDER BY event_seq) AS l FROM p GROUP BY ALL), "
    "f AS (SELECT game_id, at_bat, list_reduce([{'seq': 0::BIGINT, 'kind': '', 'b': 0, 's': 0, 'out': []::STRUCT(seq BIGINT, b INT, s INT)[]}] || l, lambda a, x: {'seq': x.seq, 'kind': '', "
    "'b': CASE WHEN x.kind IN ('볼', '폭투') THEN least(4, greatest(a.b, x.b) + 1) ELSE greatest(a.b, x.b) END, 's': CASE WHEN x.kind IN ('스트라이크', '헛스윙') THEN least(3, greatest(a.s, x.s) + 1) WHEN x.kind = '파울' THEN least(2, greatest(a.s, x.s) + 1) ELSE greatest(a.s, x.s) END, "
    "'out': list_append(a.out, {'seq': x.seq, 'b': CASE WHEN x.kind IN ('볼', '폭투') THEN least(4, greatest(a.b, x.b) + 1) ELSE greatest(a.b, x.b) END, 's': CASE WHEN x.kind IN ('스트라이크', '헛스윙') THEN least(3, greatest(a.s, x.s) + 1) WHEN x.kind = '파울' THEN least(2, greatest(a.s, x.s) + 1) ELSE greatest(a.s, x.s) END})}).out AS out FROM l) "
    "SELECT game_id, at_bat, o.seq AS event_seq, o.b AS balls, o.s AS strikes FROM (SELECT game_id, at_bat, unnest(out) AS o FROM f)"
)


@query("w21_pitch_counts", _W21)
def w21(t: Tables):
    """Balls and strikes within each at-bat, by a fold in the order of events."""
    return plays.pitch_counts(plays.at_bats(events(t)))


_RULES = {
    "PBP-001": "row_number() OVER (PARTITION BY game_id, event_seq ORDER BY place) > 1", "PBP-002": "inn < li", "PBP-003": "(inn <> li OR half <> lh) AND rn > 1 AND o > 2",
    "PBP-004": "o < 0 OR o > 3", "PBP-005": "a < coalesce(max(a) OVER p, 0)", "PBP-006": "h < coalesce(max(h) OVER p, 0)",
}


@query(
    "w22_state_rules",
    f"WITH {EV}, s AS (SELECT game_id, event_seq // 2 AS event_seq, event_seq AS place, coalesce(inning, 0) AS inn, upper(inning_half) AS half, coalesce(outs, 0) AS o, coalesce(away_score, 0) AS a, coalesce(home_score, 0) AS h FROM e), l AS (SELECT *, coalesce(lag(inn) OVER w, 1) AS li, coalesce(lag(half) OVER w, 'TOP') AS lh, row_number() OVER w AS rn FROM s WINDOW w AS (PARTITION BY game_id ORDER BY place)), "
    f"r AS (SELECT game_id, event_seq, {', '.join(f'{c} AS r{i}' for i, c in enumerate(_RULES.values()))} FROM l WINDOW p AS (PARTITION BY game_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), f AS ({' UNION ALL '.join(f'SELECT game_id, event_seq, {chr(39)}{n}{chr(39)} AS rule_id FROM r WHERE r{i}' for i, n in enumerate(_RULES))}), "
    "n AS (SELECT DISTINCT c_custkey AS game_id FROM customer WHERE c_custkey <= 400), g AS (SELECT game_id, max(a) AS a, max(h) AS h FROM s GROUP BY 1), z AS (SELECT n.game_id, NULL::BIGINT AS event_seq, CASE WHEN g.game_id IS NULL THEN 'PBP-000' WHEN a <> 5 OR h <> 6 - n.game_id % 2 THEN 'PBP-007' END AS rule_id FROM n LEFT JOIN g USING (game_id)) SELECT *, CASE rule_id WHEN 'PBP-003' THEN 'WARNING' ELSE 'ERROR' END AS severity FROM (SELECT * FROM f UNION ALL SELECT * FROM z WHERE rule_id IS NOT NULL)",
)
def w22(t: Tables):
    """All eight rules; games that should have events come from another table."""
    x = events(t).withColumn("place", F.col("event_seq")).withColumn("event_seq", F.expr("event_seq div 2"))
    finals = t.customer.where("c_custkey <= 400").select(F.col("c_custkey").alias("game_id"), F.lit(5).alias("final_away"), (6 - F.col("c_custkey") % 2).alias("final_home"))
    return plays.state_violations(x, finals)


_WARN = {
    "home_score_decreased": "home_score < coalesce(lag(home_score) OVER w, 0)", "away_score_decreased": "away_score < coalesce(lag(away_score) OVER w, 0)", "inning_regressed": "inning < lag(inning) OVER w",
    "half_regressed": "NOT coalesce(inning < lag(inning) OVER w, false) AND inning = lag(inning) OVER w AND CASE inning_half WHEN 'top' THEN 0 ELSE 1 END < CASE lag(inning_half) OVER w WHEN 'top' THEN 0 ELSE 1 END",
    "outs_out_of_range": "(outs < 0 OR outs > 3) AND (row_number() OVER w = 1 OR lag(outs) OVER w IS NOT NULL)",
    "outs_decreased": "outs BETWEEN 0 AND 3 AND inning = lag(inning) OVER w AND inning_half = lag(inning_half) OVER w AND outs < lag(outs) OVER w", "event_seq_reversed": "event_seq <= lag(event_seq) OVER w",
}


@query("w23_live_warnings", f"WITH {EV}, s AS (SELECT * REPLACE (event_seq // 12 AS inning, event_seq // 2 AS event_seq), event_seq AS place FROM e), r AS (SELECT game_id, place, {', '.join(f'{c} AS r{i}' for i, c in enumerate(_WARN.values()))} FROM s WINDOW w AS (PARTITION BY game_id ORDER BY place)) {' UNION ALL '.join(f'SELECT game_id, place, {chr(39)}{n}{chr(39)} AS warning FROM r WHERE r{i}' for i, n in enumerate(_WARN))}")
def w23(t: Tables):
    """Against the row just before, whatever came earlier."""
    x = events(t).withColumn("place", F.col("event_seq")).withColumn("inning", F.expr("event_seq div 12")).withColumn("event_seq", F.expr("event_seq div 2"))
    return plays.live_warnings(x)


@query(
    "w24_linescore",
    f"WITH {EV}, a AS (SELECT *, coalesce(last_value(home_score IGNORE NULLS) OVER w, 0) AS h, coalesce(last_value(away_score IGNORE NULLS) OVER w, 0) AS v FROM e WHERE inning IS NOT NULL WINDOW w AS (PARTITION BY game_id ORDER BY event_seq ROWS UNBOUNDED PRECEDING)), u AS (SELECT *, greatest(0, h - coalesce(lag(h) OVER w, 0)) AS uh, greatest(0, v - coalesce(lag(v) OVER w, 0)) AS uv FROM a WINDOW w AS (PARTITION BY game_id ORDER BY event_seq)), i AS (SELECT game_id, CASE inning_half WHEN 'top' THEN 'away' ELSE 'home' END AS side, inning, sum(CASE inning_half WHEN 'top' THEN uv ELSE uh END)::BIGINT AS r FROM u GROUP BY 1, 2, 3), b AS (SELECT c_custkey AS game_id, s AS side, k::INT AS inning, (c_custkey * k % 5)::BIGINT AS runs FROM customer, (SELECT unnest(['away', 'home']) AS s), (SELECT unnest(range(1, 10)) AS k) WHERE c_custkey <= 150) SELECT game_id, side, inning, runs AS box_runs, coalesce(r, 0) AS pbp_runs FROM b LEFT JOIN i USING (game_id, side, inning) WHERE runs <> coalesce(r, 0)",
)
def w24(t: Tables):
    box = t.customer.where("c_custkey <= 150").select(F.col("c_custkey").alias("game_id"), F.explode(F.array(F.lit("away"), F.lit("home"))).alias("side")).select("*", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("inning"))
    return plays.linescore_mismatches(events(t), box.withColumn("runs", F.col("game_id") * F.col("inning") % 5))
