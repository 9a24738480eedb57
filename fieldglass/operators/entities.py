"""Names to ids: players, teams by season, games, and what a query speaks of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.play_text import any_of, first_match

# Fixed values: (franchise, code, first season, last season or None), in order.
TEAM_HISTORY = [
    (1, "SS", 1982, None), (2, "LT", 1982, None), (3, "MBC", 1982, 1989), (3, "LG", 1990, None), (4, "OB", 1982, 1998), (4, "DB", 1999, None), (5, "HT", 1982, 2000), (5, "KIA", 2001, None),
    (6, "SM", 1982, 1984), (6, "CB", 1985, 1987), (6, "TP", 1988, 1995), (6, "HU", 1996, 2007), (11, "WO", 2008, 2009), (11, "NX", 2010, 2018), (11, "KH", 2019, None),
    (7, "BE", 1986, 1993), (7, "HH", 1994, None), (12, "SL", 1991, 1999), (8, "SK", 2000, 2020), (8, "SSG", 2021, None), (9, "NC", 2011, None), (10, "KT", 2013, None),
]
#: Codes that stand for another: always, or from a first to a last season.
TEAM_ALIASES = [("HD", "HU", None, None), ("SSG", "SL", 1991, 1999)]
# Legacy codes that game ids use from 2024 on.
LEGACY_CODES = {"SSG": "SK", "KH": "WO", "DB": "OB", "KIA": "HT"}
GAME_CODES = ["KIA", "SSG", "DB", "HH", "HT", "KH", "KT", "LG", "LT", "NC", "NX", "OB", "OT", "SK", "SS", "WO"]
# Words of a query by intent and statistic, in the order they are tried.
STAT_TERMS = ["타율", "출루율", "장타율", "ops", "홈런", "안타", "타점", "득점", "도루", "삼진", "볼넷", "방어율", "평자", "승수", "세이브", "홀드", "이닝", "순위", "승률"]
RULE_TERMS = ["규정", "규칙", "abs", "판정", "허용", "금지", "스트라이크존", "주자", "베이스", "투구", "떠나", "되나요", "되나"]
EXPLANATION_TERMS = ["왜", "이유", "설명", "분석", "원인"]
PROFILE_TERMS = ["프로필", "누구", "정보", "선수"]
GAME_TERMS = ["경기", "스코어", "결과", "승부", "대진", "한국시리즈"]
STAT_TYPES = [("순위", "rank"), ("승률", "win_pct"), ("홈런", "home_runs"), ("안타", "hits"), ("타점", "rbi"), ("도루", "stolen_bases"), ("타율", "avg"), ("출루율", "obp"), ("장타율", "slg"), ("ops", "ops"), ("방어율", "era"), ("평자", "era"), ("승수", "wins"), ("세이브", "saves"), ("홀드", "holds"), ("이닝", "innings_pitched")]
PITCHING_STATS = ["era", "wins", "saves", "holds", "innings_pitched"]


def team_by_season(rows: DataFrame, code: str, season: str) -> DataFrame:
    """Adds franchise_id and team_code: the code of the franchise in that season; NULL where it is unknown.

    The first club with the code gives the franchise; the history is a stated list of
    some twenty rows and so is sent to the tasks.
    """
    spark = rows.sparkSession
    history = spark.createDataFrame([(i, *x) for i, x in enumerate(TEAM_HISTORY)], "place int, franchise_id int, code string, start int, end int")
    raw = F.upper(F.col(code))
    for a, b, since, until in TEAM_ALIASES:
        hit = raw == a if since is None else (raw == a) & F.col(season).between(since, until)
        raw = F.when(hit, b).otherwise(raw)
    named = history.groupBy(F.col("code").alias("_raw")).agg(F.min_by("franchise_id", "place").alias("_franchise"), F.min_by("start", "place").alias("_start"), F.min_by("end", "place").alias("_end"))
    x = rows.withColumn("_code", raw).join(F.broadcast(named), F.col("_code") == F.col("_raw"), "left")
    spans = history.select(F.col("franchise_id").alias("_f"), F.col("code").alias("_other"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    x = x.join(F.broadcast(spans), (F.col("_franchise") == F.col("_f")) & (F.col("_s") <= F.col(season)) & (F.coalesce("_e", season) >= F.col(season)), "left")
    own = (F.col("_start") <= F.col(season)) & (F.coalesce("_end", season) >= F.col(season))
    team = F.when(F.col(season).isNull() | own, F.col("_raw")).otherwise(F.col("_other"))
    return x.select(*rows.columns, F.when(team.isNotNull(), F.col("_franchise")).alias("franchise_id"), team.alias("team"))


def unique_candidate(rows: DataFrame, key: str, facts: DataFrame, on: list[str], name: str) -> DataFrame:
    """Adds ``name``: the one player_id that ``facts`` has for a row's columns ``on``, NULL for none, -1 for several."""
    one = facts.where(F.col("player_id").isNotNull()).groupBy(*on).agg(F.min("player_id").alias("_lo"), F.max("player_id").alias("_hi"))
    x = rows.join(one, on, "left")
    return x.withColumn(name, F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).when(F.col("_lo").isNotNull(), F.lit(-1))).drop("_lo", "_hi")


def resolve_players(rows: DataFrame, overrides: DataFrame, seasons: DataFrame, profiles: DataFrame, strict: bool = False) -> DataFrame:
    """Adds player_id and step for rows with row_id, name, season, team and uniform.

    Steps in order: override; season rows by name, season and team; profiles by name
    and team; profiles by name and uniform.  Several candidates end the search
    (step ``ambiguous``).  Unless ``strict``, a name that is one player's in all
    seasons and then the relaxed rule (name and season, any team) follow; what is
    left is ``unknown``.  ``seasons`` (player_id, name, season, team) and
    ``profiles`` (player_id, name, team, uniform) are joined by equal keys, counted
    before, so nothing fans out.
    """
    x = rows.join(overrides.select("name", "season", F.col("player_id").alias("s0")), ["name", "season"], "left")
    steps = [("season", seasons, ["name", "season", "team"]), ("profile_team", profiles, ["name", "team"]), ("profile_uniform", profiles, ["name", "uniform"])]
    if not strict:
        steps += [("unique_name", seasons, ["name"]), ("relaxed", seasons, ["name", "season"])]
    for i, (_, facts, on) in enumerate(steps, 1):
        x = unique_candidate(x, "row_id", facts, on, f"s{i}")
    names = ["override", *[s[0] for s in steps]]
    first = F.coalesce(*[F.col(f"s{i}") for i in range(len(names))])
    step = F.lit(None).cast("string")
    for i in reversed(range(len(names))):
        step = F.when(F.col(f"s{i}").isNotNull(), F.when(F.col(f"s{i}") == -1, "ambiguous").otherwise(names[i])).otherwise(step)
    return x.select("row_id", F.when(first != -1, first).alias("player_id"), F.coalesce(step, F.lit("unknown")).alias("step"))


def stat_type(query: Column) -> Column:
    return first_match(F.lower(query), STAT_TYPES)


def intent(query: Column) -> Column:
    """What kind of question it is, by ordered rules."""
    q = F.lower(query)
    has = lambda words: any_of(q, words)
    stat = stat_type(query).isNotNull() | has(STAT_TERMS)
    return (
        F.when(stat & has(EXPLANATION_TERMS), "MIXED_QUERY").when(stat, "STAT_QUERY").when(has(RULE_TERMS), "RULE_QUERY").when(has(GAME_TERMS), "GAME_QUERY")
        .when(has(EXPLANATION_TERMS), "EXPLANATION_QUERY").when(has(PROFILE_TERMS), "ENTITY_LOOKUP").otherwise("HISTORICAL_QUERY")
    )


def route(query: Column, entity: Column) -> Column:
    """Numbers, documents or both; without a player, team or year (``entity`` false) always documents."""
    i = intent(query)
    return F.when(entity & i.isin("STAT_QUERY", "ENTITY_LOOKUP"), "STRUCTURED").when(entity & (i == "MIXED_QUERY"), "MIXED").otherwise("DOCUMENT")


def retriever(query: Column, year: Column, player: Column) -> Column:
    """Which table answers: standings, pitching, profile, batting or none."""
    return retriever_of(intent(query), stat_type(query), year, player)


def retriever_of(i: Column, stat: Column, year: Column, player: Column) -> Column:
    """The same, from the intent and the kind of figure."""
    s = F.coalesce(stat, F.lit(""))
    known = player.isNotNull() & i.isin("STAT_QUERY", "ENTITY_LOOKUP", "MIXED_QUERY")
    return F.when((s == "rank") & year.isNotNull(), "standings").when(known & s.isin(PITCHING_STATS), "pitching").when(known & (i == "ENTITY_LOOKUP") & (s == ""), "profile").when(known, "batting").otherwise("none")


def year_of(query: Column) -> Column:
    """The first year from 1980 to 2030 that stands alone."""
    return F.regexp_extract(query, r"(?:^|[^0-9])(198[0-9]|199[0-9]|20[0-2][0-9]|2030)(?:[^0-9]|$)", 1).try_cast("int")


def team_of(query: Column, synonyms: dict[str, str]) -> Column:
    """The team of the first synonym that stands as a word, particles allowed after it."""
    out, q = F.lit(None).cast("string"), F.lower(query)
    for word, team in reversed(synonyms.items()):
        out = F.when(q.rlike(rf"(?:^|\s){word.lower()}(?:$|\s|의|는|은|이|가|와|과|도)"), team).otherwise(out)
    return out


def name_candidate(query: Column, stopwords: list[str], least: int = 2, most: int = 4, strip_from: int = 4) -> Column:
    """The first word that may be a name: Hangul only, endings taken off, no stop word."""
    stop = F.array(*map(F.lit, stopwords))
    clean = F.transform(F.split(F.trim(query), r"\s+"), lambda w: F.regexp_replace(F.regexp_replace(w, "[^가-힣]", ""), "(해줘|알려줘|으로|에서|에게|께서)$", ""))

    def name(w):
        short = F.regexp_replace(w, "(의|은|는|이|가|을|를|와|과|도|에)$", "")
        return F.when((F.length(w) >= strip_from) | F.array_contains(stop, short), short).otherwise(w)

    fits = lambda w: F.length(w).between(least, most) & ~F.array_contains(stop, w)
    return F.get(F.filter(F.transform(clean, name), fits), F.lit(0))


def resolve_names(queries: DataFrame, players: DataFrame) -> DataFrame:
    """Adds player_id and ambiguous for (query_id, name, team): the one player of that name, of the team if one is named."""
    by_name = players.groupBy("name").agg(F.count("*").alias("n"), F.min("player_id").alias("p"))
    by_team = players.groupBy("name", "team").agg(F.count("*").alias("nt"), F.min("player_id").alias("pt"))
    x = queries.join(by_name, "name", "left").join(by_team, ["name", "team"], "left")
    n, p = F.when(F.col("team").isNotNull(), F.coalesce("nt", F.lit(0))).otherwise(F.coalesce("n", F.lit(0))), F.when(F.col("team").isNotNull(), F.col("pt")).otherwise(F.col("p"))
    return x.select("query_id", F.when(n == 1, p).alias("player_id"), (n > 1).alias("ambiguous"))


def index_findings(primary: DataFrame, vector: DataFrame) -> DataFrame:
    """(key, issue) where two indexes differ: missing rows, hashes, versions, vectors, status.

    Both have key, content_hash, index_version and index_status; ``vector`` also
    has_embedding.  A row that is missing has no other finding.
    """
    side = lambda df, p: df.select("key", *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c != "key"], F.lit(True).alias(f"{p}_here"))
    x = side(primary, "p").join(side(vector, "v"), "key", "full")
    filled = lambda c: (F.coalesce(F.col(f"p_{c}"), F.lit("")) != "") & (F.coalesce(F.col(f"v_{c}"), F.lit("")) != "")
    pair = lambda c, name: F.when(~filled(c), f"{name}_MISSING").when(F.col(f"p_{c}") != F.col(f"v_{c}"), f"{name}_MISMATCH")
    status = F.coalesce("p_index_status", F.lit("ACTIVE")) != F.coalesce("v_index_status", F.lit("ACTIVE"))
    rest = F.array(pair("content_hash", "CONTENT_HASH"), pair("index_version", "INDEX_VERSION"), F.when(~F.coalesce("v_has_embedding", F.lit(False)), "VECTOR_EMBEDDING_MISSING"), F.when(status, "INDEX_STATUS_MISMATCH"))
    found = F.when(F.col("p_here").isNull(), F.array(F.lit("MISSING_IN_PRIMARY"))).when(F.col("v_here").isNull(), F.array(F.lit("MISSING_IN_VECTOR"))).otherwise(F.array_compact(rest))
    return x.select("key", F.explode(found).alias("issue"))


def game_id(day: Column, away: Column, home: Column, number: Column) -> Column:
    """yyyymmdd, both codes and the number of the game that day; NULL where a part is missing."""
    return F.concat(F.date_format(day, "yyyyMMdd"), F.upper(away), F.upper(home), F.coalesce(number, F.lit(0)).cast("string"))


def game_id_parts(value: Column) -> Column:
    """struct(day, away, home, number); teams are split at the first known code that leaves a known one."""
    v = F.upper(F.trim(value))
    teams = F.regexp_extract(v, r"^[0-9]{8}([A-Z]+)[0-9]$", 1)
    away = F.lit(None).cast("string")
    for code in reversed(sorted(GAME_CODES, key=lambda c: (-len(c), c))):
        away = F.when(F.startswith(teams, F.lit(code)) & F.substring(teams, len(code) + 1, 9).isin(GAME_CODES), code).otherwise(away)
    home = F.when(away.isNotNull(), F.substr(teams, F.length(away) + 1))
    return F.when(teams != "", F.struct(F.substring(v, 1, 8).alias("day"), away.alias("away"), home.alias("home"), F.right(v, F.lit(1)).alias("number")))


def legacy_game_id(value: Column, since: int = 2024) -> Column:
    """The id with legacy codes, from the season ``since`` on; other values as they are."""
    p = game_id_parts(value)

    def old(c):
        out = c
        for new, code in LEGACY_CODES.items():
            out = F.when(c == new, code).otherwise(out)
        return out

    return F.when(p["away"].isNotNull() & (F.substring(p["day"], 1, 4).cast("int") >= since), F.concat(p["day"], old(p["away"]), old(p["home"]), p["number"])).otherwise(value)


TERMINAL = ["COMPLETED", "DRAW", "CANCELLED", "POSTPONED"]


def normal_status(status: Column) -> Column:
    """A known status in upper case; NULL for anything else."""
    s = F.upper(F.trim(status))
    s = F.when(s.isin("CANCELED", "CANCEL", "CANCELLED_GAME"), "CANCELLED").otherwise(s)
    return F.when(s.isin(*TERMINAL, "SCHEDULED", "LIVE", "DELAYED", "SUSPENDED", "UNRESOLVED_MISSING"), s)


def stable_status(day: Column, today: Column, current: Column, new: Column, home: Column, away: Column, progress: Column) -> Column:
    """The status of a game by date, scores and what is said of it.

    A coming game is SCHEDULED.  With both scores it is DRAW or COMPLETED, unless a
    terminal status would be undone by one that is not.  Today it is LIVE (or what is
    said) with evidence of play.  A past game keeps a terminal status, else it is
    UNRESOLVED_MISSING.
    """
    c, n = normal_status(current), normal_status(new)
    is_end = lambda s: F.coalesce(s.isin(*TERMINAL), F.lit(False))
    scored = F.when(is_end(c) & n.isNotNull() & ~is_end(n), c).when(home == away, "DRAW").otherwise("COMPLETED")
    now = F.when(progress, F.coalesce(n, F.lit("LIVE"))).otherwise("SCHEDULED")
    past = F.when(is_end(n), n).when(is_end(c), c).otherwise("UNRESOLVED_MISSING")
    return F.when(day > today, "SCHEDULED").when(home.isNotNull() & away.isNotNull(), scored).when(day == today, now).otherwise(past)


# Positions of staff.
STAFF = ["코치", "감독대행", "매니저", "트레이너", "재활", "전력분석", "불펜포수", "불펜", "컨디셔닝", "수비코디", "인스트럭터"]


def player_category(registered: Column, role: Column, position: Column, team: Column) -> Column:
    """MANAGER, COACH, STAFF, RETIRED or ACTIVE: a registered role first, then the position, then the team."""
    p, t = F.coalesce(F.trim(position), F.lit("")), F.coalesce(F.trim(team), F.lit(""))
    own = F.when(role == "manager", "MANAGER").when(role == "coach", "COACH").otherwise("STAFF")
    return F.when(registered, own).when(p.contains("감독"), "MANAGER").when(any_of(p, STAFF), "COACH").when(F.lower(t).isin("", "-", "없음") | t.contains("은퇴") | F.lower(t).contains("retired"), "RETIRED").otherwise("ACTIVE")
