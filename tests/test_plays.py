"""Play-by-play, rules, rates and retrieval against plain Python."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from fieldglass.functions import play_text, rates, records
from fieldglass.operators import checks, entities, plays, retrieval, season


def test_pitch_counts(spark):
    r, lines = random.Random(6), ["1구 볼", "2구 스트라이크", "3구 파울", "4구 헛스윙", "5구 폭투", "6구 포일", "text", None]
    rows = [(g, i, r.randint(0, 3), r.choice(lines), r.choice([None, None, None, 1, 2]), r.choice([None, None, None, 1, 3])) for g in range(3) for i in range(60)]
    rows = [(g, i, None if n == 3 else i // 12, d, b, s) for g, i, n, d, b, s in rows]
    want = {}
    for g in range(3):
        at, balls, strikes = None, 0, 0
        for _, i, n, d, b, s in (x for x in rows if x[0] == g):
            if n is None:
                continue
            if n != at:
                at, balls, strikes = n, 0, 0
            balls, strikes = max(balls, b or 0), max(strikes, s or 0)
            kind = (d or "")[3:]
            if kind in ("볼", "폭투"):
                balls = min(4, balls + 1)
            elif kind in ("스트라이크", "헛스윙"):
                strikes = min(3, strikes + 1)
            elif kind == "파울":
                strikes = min(2, strikes + 1)
            want[g, i] = n, balls, strikes
    df = spark.createDataFrame(rows, "game_id int, event_seq int, at_bat int, description string, balls int, strikes int").repartition(3)
    assert {(x.game_id, x.event_seq): (x.at_bat, x.balls, x.strikes) for x in plays.pitch_counts(df).collect()} == want


def test_only_missing_changes_nothing_else(spark):
    rows = [("g", i, 1, "top", 0, 0, i % 2, 0, "x", 0.5 if i == 1 else None, 0.6 if i == 1 else None, 0.1 if i == 1 else None) for i in range(3)]
    df = spark.createDataFrame(rows, "game_id string, event_seq int, inning int, inning_half string, outs int, runners int, home_score int, away_score int, description string, we_before double, we_after double, wpa double")
    none = spark.createDataFrame([], "inning int, half string, outs int, runners int, score_diff int, win_prob double")
    got = {r.event_seq: (r.we_before, r.wpa) for r in plays.transitions(df, none, only_missing=True).collect()}
    assert got[1] == (0.5, 0.1) and got[0][0] == got[2][0] or got[2][0] is not None


def test_rates_are_rounded_exactly(spark):
    pairs = [(a, b) for a in range(-5, 40) for b in range(0, 33)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", rates.rate("a", "b", 3, None).alias("x"))
    for r in df.collect():
        want = None if r.b == 0 else int((Fraction(r.a, r.b) * 1000 + Fraction(1, 2)).__floor__()) / 1000
        assert r.x == want, r


def test_rules_by_name(spark):
    checks.register("own", checks.Rule("OWN-1", "n > 2"), checks.Rule("OWN-2", "n IS NULL", "'WARNING'"))
    with pytest.raises(ValueError):
        checks.register("own", checks.Rule("OWN-1", "true"))
    df = spark.createDataFrame([(1, 3), (2, None), (3, 1)], "k int, n int")
    assert sorted(map(tuple, checks.violations(df, checks.RULES["own"], ["k"]).collect())) == [(1, "OWN-1", "ERROR"), (2, "OWN-2", "WARNING")]
    assert [r.k for r in checks.quarantine(df, checks.RULES["own"]).collect()] == [1]


def test_notation(spark):
    said = {"5.1": 16, "5": 15, "5.33": 16, "5.667": 17, "1/3": 1, "5 2/3": 17, "5.5": None, "x": None, "": None}
    df = spark.createDataFrame([(k,) for k in said], "t string").select("t", checks.notation_outs(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == said


def test_empty_league(spark):
    b = spark.createDataFrame([], ", ".join(f"{c} long" for c in ("player_id", *season.BATTING)))
    p = spark.createDataFrame([], ", ".join(f"{c} long" for c in ("player_id", *season.PITCHING)))
    r = season.league_constants(b, p).first()
    assert (r.lg_woba, r.lg_era, r.lg_obp, r.lg_r_per_pa, r.lg_slg) == (0.32, 4.5, 0.33, 0.0, 0.0) and abs(r.rpw - 10.54) < 0.01


def test_vector_blocks_and_odd_vectors(spark):
    rows = [(i, [float(i % 5), 1.0, float(i % 3)]) for i in range(40)] + [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0]), (103, [1.0, None, 2.0])]
    v = spark.createDataFrame(rows, "k long, v array<double>").repartition(3)
    q = v.where("k % 10 = 0")
    one, many = (sorted(map(tuple, retrieval.cosine_topk(v, q, "k", "v", "k", "v", 4, block=b).collect())) for b in (4096, 2))
    assert one == many and {x[0] for x in one} == {0, 10, 20, 30} and len(one) == 16 and not {x[1] for x in one} & {100, 101, 102, 103}


def test_json_and_names(spark):
    df = spark.createDataFrame([('{"b":[1,{"c":2}],"a":null}', '{"a":1,"b":[1,{"c":3},4]}'), (None, "1"), ("[]", "[]")], "x string, y string")
    got = [[tuple(d) for d in r.d] for r in df.select(records.json_differences(F.col("x"), F.col("y")).alias("d")).collect()]
    assert got == [[("$.a", "null", "1"), ("$.b[1].c", "2", "3"), ("$.b[2]", "<missing>", "4")], [("$", "null", "1")], []]
    assert df.select(records.canonical_json(F.col("x")).alias("j")).first().j == '{"a":null,"b":[1,{"c":2}]}'
    teams = entities.team_by_season(spark.createDataFrame([("SSG", 1995), ("hd", 2000), ("MBC", 1995), ("KT", 2000), (None, 2000)], "c string, y int"), "c", "y")
    assert {(r.c, r.team) for r in teams.collect()} == {("SSG", "SL"), ("hd", "HU"), ("MBC", "LG"), ("KT", None), (None, None)}


def test_first_match_is_in_order(spark):
    df = spark.createDataFrame([("김 : 2루타 홈런",), ("낫 아웃 삼진",), (None,), ("",)], "t string")
    assert [r.c for r in df.select(play_text.result_code(F.col("t")).alias("c")).collect()] == ["HR", "K", None, None]
