import datetime as dt

from pyspark.sql import functions as F

from fieldglass import sources
from fieldglass.operators import basics, retrieval, splits, standings


def test_streak_survives_a_draw(spark):
    day = lambda n: dt.date(2024, 1, n)
    games = spark.createDataFrame([(i, day(i), 1, 2, a, b) for i, (a, b) in enumerate([(2, 1), (1, 1), (3, 0), (0, 4), (None, None)], 1)], "game int, date date, home int, away int, hs int, vs int")
    roles = {"game": "game", "date": "date", "home": "home", "away": "away", "home_score": "hs", "away_score": "vs"}
    got = [r.streak for r in standings.form(games, roles).where("team = 1").orderBy("date").collect()]
    assert got == [1, 1, 2, -1, -1]


def test_idle_team_carries_its_figures(spark):
    games = spark.createDataFrame([(1, dt.date(2024, 1, 1), 1, 2, 2, 1), (2, dt.date(2024, 1, 2), 3, 1, 0, 5)], "game int, date date, home int, away int, hs int, vs int")
    roles = {"game": "game", "date": "date", "home": "home", "away": "away", "home_score": "hs", "away_score": "vs"}
    got = {(r.date.day, r.team): (r.wins, r.losses, r["rank"], r.games_behind) for r in standings.table(games, roles).collect()}
    assert got == {(1, 1): (1, 0, 1, 0.0), (1, 2): (0, 1, 2, 1.0), (2, 1): (2, 0, 1, 0.0), (2, 2): (0, 1, 2, 1.5), (2, 3): (0, 1, 3, 1.5)}


def test_competition_rank_flags_later_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 5), (4, 1)], "k int, v int")
    assert [(r.k, r["rank"], r.is_tie) for r in basics.competition_rank(df, "v", "k").orderBy("rank", "k").collect()] == [(2, 1, False), (1, 2, False), (3, 2, True), (4, 4, False)]


def test_null_never_overwrites(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    new = spark.createDataFrame([(1, None, 9), (3, "c", 3)], "k int, x string, y int")
    assert sorted(map(tuple, sources.upsert(old, new, ["k"]).collect())) == [(1, "a", 9), (2, "b", 2), (3, "c", 3)]


def test_park_of_null_is_unknown(spark):
    df = spark.createDataFrame([("A", 10.0), ("A", 14.0), (None, 6.0), ("B", None)], "p string, r double")
    got = {r.park: (r.games, r.factor, r.label) for r in splits.park_factor(df, "p", "r").collect()}
    assert got == {"A": (2, 1.2, "extreme hitter"), "UNKNOWN": (1, 0.6, "extreme pitcher")}


def test_rrf_keeps_rank_gaps(spark):
    s = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id int, item_id int, rank int")
    d = spark.createDataFrame([(1, 11, 3)], "query_id int, item_id int, rank int")
    assert {r.item_id: r.score for r in retrieval.rrf(s, d).collect()} == {10: 0.333333, 11: 0.65}


def test_anti_join_is_planned_as_such(spark):
    from fieldglass import catalog

    plan = catalog.queries()["j04_anti_join"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and "CartesianProduct" not in plan


def test_term_count_does_not_overlap(spark):
    assert spark.range(1).select(retrieval.term_count(F.lit("aaaa"), "aa").alias("n")).first().n == 2
