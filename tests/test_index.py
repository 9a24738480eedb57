"""Keyword index and hybrid lists against plain Python."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from fieldglass.operators import postings, retrieval, vectors
from fieldglass.operators.stored import built_once

WORDS = ["none", "no", "on", "nonet", "Run", "runs", "éta", "ét", "a", "aa", "aaaa", "x" * 40, "o.o", "%", "안타", "안타를"]


def corpus():
    r = random.Random(1)
    line = lambda n: " ".join(r.choice(WORDS) + r.choice(["", ",", "s"]) for _ in range(n)) + r.choice(["", "\n", "\t x"])
    return [(i, None if i % 7 == 0 else line(r.randrange(12)), None if i % 3 == 0 else "" if i % 11 == 0 else line(2), None if i % 5 == 0 else "AB"[i % 2]) for i in range(80)]


def plain(rows, words, k):
    """The scan by its definition."""
    split = lambda t: re.findall(r"[^ \t\n\r\f\x0B]+", t)
    words = [w.lower() for w in words]
    own = [(i, t or "", h) for i, t, h, _ in rows if any(w in (t or "").lower() or w in (h or "").lower() for w in words)]
    u = {i: f"{h or ''} {t}".lower() for i, t, h in own}
    avg, df = sum(len(split(x)) for x in u.values()) / max(1, len(u)), {w: sum(w in x for x in u.values()) for w in words}
    out = []
    for i, t, h in own:
        text, score = f"{h} {t}".lower(), 0.0
        for w in words:
            tf = text.count(w)
            if tf:
                idf = max(0.0, math.log((len(own) - df[w] + 0.5) / (df[w] + 0.5) + 1))
                score += idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(split(text)) / max(avg, 1)))
                score *= 1.2 if w in (h or "").lower() else 1
        out.append((-round(score, 6), i))
    return [(i, -s) for s, i in sorted(out)[:k]]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    df = spark.createDataFrame(corpus(), "id long, text string, title string, kind string").repartition(3)
    df.write.parquet(path)
    docs = spark.read.parquet(path)
    build = lambda: postings.build(docs, "id", "text", "title", ["kind"])
    tables = built_once(spark, "test", [path], build)
    assert built_once(spark, "test", [path], lambda: 1 / 0).keys() == tables.keys()  # not built again
    return docs, tables


def test_every_question_is_answered_like_the_scan(spark, index):
    docs, tables = index
    r = random.Random(2)
    asked = [(i, [r.choice([*WORDS, "one", "uns", "타", "xxx", "zz", "."]) for _ in range(r.randrange(1, 4))]) for i in range(60)] + [(99, ["on", "on"]), (100, [])]
    got: dict = {}
    for x in postings.search(tables, spark.createDataFrame(asked, "query_id long, words array<string>"), 10).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.key, x.score))
    for q, words in asked:
        assert [(i, pytest.approx(s, abs=2e-6)) for _, i, s in sorted(got.get(q, []))] == plain(corpus(), words, 10), words
    scan = retrieval.bm25(docs, "id", "text", "title", ["none", "a"], 10).collect()
    both = postings.search(tables, spark.createDataFrame([(1, ["none", "a"])], "query_id long, words array<string>"), 10).orderBy("rank").collect()
    assert [(x.key, x.score) for x in both] == [(x.key, x.score) for x in scan]


def test_filters_come_before_statistics_and_texts_stay_unread(spark, index):
    _, tables = index
    asked = spark.createDataFrame([(1, ["run", "none"])], "query_id long, words array<string>")
    got = postings.search(tables, asked, 10, where=F.col("kind") == "A")
    want = plain([x for x in corpus() if x[3] == "A"], ["run", "none"], 10)
    assert [(x.key, pytest.approx(x.score, abs=2e-6)) for x in got.orderBy("rank").collect()] == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_candidates_and_a_word_with_white_space(spark, index):
    _, tables = index
    asked = spark.createDataFrame([(1, ["RUN", "éta"]), (2, ["a b", ""])], "query_id long, words array<string>")
    want = sorted(i for i, t, h, _ in corpus() if any(w in f"{h or ''} {t or ''}".lower() for w in ("run", "éta")))
    assert [(x.query_id, x.key) for x in postings.candidates(tables, asked, 5).orderBy("key").collect()] == [(1, i) for i in want[:5]]
    assert postings.search(tables, asked.where("query_id = 2")).count() == 0


def test_an_index_is_built_again_when_its_input_changes(spark, tmp_path):
    path = str(tmp_path / "d")
    build = lambda: postings.build(spark.read.parquet(path), "id", "text", "title")
    for text, found in (("old words", 0), ("new words", 1)):
        spark.createDataFrame([(1, text, None)], "id long, text string, title string").write.mode("overwrite").parquet(path)
        tables = built_once(spark, "changing", [path], build)
        assert postings.search(tables, spark.createDataFrame([(1, ["new"])], "query_id long, words array<string>")).count() == found


def test_hybrid_drops_stale_hits_and_keeps_gaps(spark):
    schema = "query_id long, item_id long, rank int, content_hash string"
    sparse = spark.createDataFrame([(1, 10, 1, "a"), (1, 11, 2, "b"), (1, 12, 3, None), (1, 13, 4, None)], schema)
    dense = spark.createDataFrame([(1, 10, 1, "other"), (1, 11, 2, "b"), (1, 20, 3, "c"), (1, 12, 4, None), (1, 13, 5, "d"), (2, 20, 1, "c")], schema)
    got = [tuple(x) for x in retrieval.hybrid(sparse, dense, 4).orderBy("query_id", "rank").collect()]
    score = lambda s, d: round((1 / (2 + s) if s else 0) + (2 / (2 + d) if d else 0), 6)
    assert got == [(1, 11, 1, 2, 2, score(2, 2)), (1, 12, 2, 3, 4, score(3, 4)), (1, 20, 3, None, 3, score(0, 3)), (1, 10, 4, 1, None, score(1, 0)), (2, 20, 1, None, 1, score(0, 1))]


def test_vector_index_finds_nine_tenths(spark, tmp_path):
    import numpy as np

    r = np.random.default_rng(3)
    x = r.normal(size=(30, 24))[r.integers(30, size=3000)] + 0.6 * r.normal(size=(3000, 24))
    x[500:1500] = x[3]  # a third are copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5001, [0.0] * 24), (5002, [1.0]), (5003, [None] * 24), (None, x[0].tolist())]
    path = str(tmp_path / "v")
    spark.createDataFrame(rows, "id long, v array<double>").repartition(4).write.parquet(path)
    items = spark.read.parquet(path)
    book = vectors.fit(items, "v", sample=2000)
    index = built_once(spark, "v", [path], lambda: vectors.build(items, "id", "v", book))
    assert index["codes"].count() == 3000 and len(book.coarse) <= 55
    asked = items.where("id % 50 = 0")
    assert 1 <= vectors.calibrate(index, book, items, "id", "v") <= len(book.coarse)
    found = vectors.search(index, book, asked, "id", "v")
    said = vectors.recall(found, items.where("id is not null"), asked, "id", "v", "id", "v").first()
    assert said.questions == 60 and said.recall >= 0.9
    u = x / np.linalg.norm(x, axis=1)[:, None]
    got: dict = {}
    for q in found.collect():
        got.setdefault(q.query_id, []).append((q["rank"], q.item_id))
        assert abs(q.score - u[q.item_id] @ u[q.query_id]) < 1e-6
    assert got.keys() == {i for i in range(0, 3000, 50)} and all([a for a, _ in sorted(v)] == [1, 2, 3, 4, 5] for v in got.values())
    whole = vectors.search(index, book, asked.where("id < 500"), "id", "v", probes=len(book.coarse), again=600)
    exact = retrieval.cosine_topk(items.where("id is not null"), asked.where("id < 500"), "id", "v", "id", "v")
    assert {(a.query_id, a.item_id) for a in whole.collect()} == {(a.query_id, a.item_id) for a in exact.collect()}
    assert vectors.fit(items.where("id >= 5000 and id <> 5002"), "v") is None
