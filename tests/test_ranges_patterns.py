"""Range joins, patterns, held days and ranks against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldglass.operators import intervals, patterns, retrieval, standings


@pytest.mark.parametrize("kind", ["long", "date"])
def test_range_join(spark, kind):
    r = random.Random(3)
    value = (lambda n: None if n is None else n) if kind == "long" else (lambda n: None if n is None else dt.date(2020, 1, 1) + dt.timedelta(n))
    rows = [(i, None if i % 9 == 0 else r.randrange(-40, 400), None if i % 13 == 0 else "ab"[i % 2]) for i in range(200)]
    ranges = [(i, None if i % 8 == 0 else (a := r.randrange(-100, 450)), None if i % 7 == 0 else (a if i % 8 else 0) + r.randrange(-3, 200), None if i % 11 == 0 else "ab"[i % 2]) for i in range(120)]
    left = spark.createDataFrame([(i, value(a), k) for i, a, k in rows], f"id long, at {kind}, k string")
    right = spark.createDataFrame([(i, value(a), value(b), k) for i, a, b, k in ranges], f"version long, first {kind}, last {kind}, k string")
    holds = lambda x, a, b: x is not None and (a is None or x >= a) and (b is None or x <= b)
    for keys in ([], ["k"]):
        out = intervals.range_join(left, "at", right if keys else right.drop("k"), "first", "last", keys)
        want = sorted((i, v) for i, x, k in rows for v, a, b, c in ranges if holds(x, a, b) and (not keys or (k is not None and k == c)))
        assert sorted((x.id, x.version) for x in out.collect()) == want and len(want) > 500
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.range_join(left.where("false"), "at", right, "first", "last", ["k"]).count() == 0


def test_automaton_is_the_first_contained():
    r = random.Random(5)
    for _ in range(300):
        words = [(i, "".join(r.choice("abé") for _ in range(r.randrange(0 if r.random() < 0.05 else 1, 5)))) for i in r.sample(range(99), r.randrange(1, 9))]
        machine = patterns.Automaton(words)
        for _ in range(8):
            text = "".join(r.choice("abéc") for _ in range(r.randrange(0, 12)))
            assert machine.first(text) == min((i for i, w in words if w in text), default=None)


def test_patterns_by_group_and_in_pieces(spark):
    r = random.Random(6)
    names = [(r.randrange(5) if i % 10 else None, i, None if i % 17 == 0 else f"N{r.randrange(30)}.") for i in range(150)]
    texts = [(i, r.randrange(6) if i % 12 else None, None if i % 14 == 0 else " ".join(f"N{r.randrange(60)}." for _ in range(4))) for i in range(120)]
    p = spark.createDataFrame(names, "game int, place int, name string")
    t = spark.createDataFrame(texts, "id long, game int, text string")
    first = lambda text, own: min((at for at, n in own if n is not None and n in text), default=None)
    want = {i: x for i, g, text in texts if text is not None and g is not None and (x := first(text, [(a, n) for h, a, n in names if h == g])) is not None}
    assert {x.id: x.place for x in patterns.first_in_group(t, "id", "text", p, "place", "name", "game").collect()} == want
    want = {i: x for i, _, text in texts if text is not None and (x := first(text, [(a, n) for _, a, n in names])) is not None}
    for most in (100_000, 7):
        assert {x.id: x.place for x in patterns.first_of_all(t, "id", "text", p, "place", "name", most=most).collect()} == want


def test_a_large_dictionary(spark):
    names = spark.range(100_000).selectExpr("id AS place", "concat('name', id, ';') AS name")
    texts = spark.range(2000).selectExpr("id", "concat('seen name', id * 37, '; and name', id * 11, ';') AS text")
    got = patterns.first_of_all(texts, "id", "text", names, "place", "name").agg(F.count("*").alias("n"), F.count_if(F.expr("place <> id * 11")).alias("wrong")).first()
    assert tuple(got) == (2000, 0)


def test_days_are_held(spark):
    day = lambda n: dt.date(2024, 2, 27) + dt.timedelta(n)
    last = spark.createDataFrame([(day(0), "a", 1), (day(4), "a", 2), (day(1), "b", 5), (day(9), "c", None)], "date date, team string, wins int")
    got = sorted(map(tuple, standings.held(last).select("team", "date", "wins").collect()))
    assert got == [("a", day(0), 1), ("a", day(1), 1), ("a", day(4), 2), ("a", day(9), 2), ("b", day(1), 5), ("b", day(4), 5), ("b", day(9), 5), ("c", day(9), None)]


def test_ranks_are_exact(spark):
    r = random.Random(9)
    values = [r.random() for _ in range(700)] + [0.25] * 400 + [None] * 9
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    shares = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    known = sorted(v for v in values if v is not None)
    import math

    got = retrieval.selected_ranks(df, "v", shares)
    assert got.first().asDict() == {n: known[max(1, math.ceil(len(known) * s)) - 1] for n, s in shares.items()}
    assert "SinglePartition" not in got.select("p50")._jdf.queryExecution().executedPlan().toString().split("Aggregate")[-1]
    assert retrieval.selected_ranks(df.where("false"), "v", shares).first().p50 is None
