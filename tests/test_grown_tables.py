"""What goes wrong only on tables larger than the smallest ones."""

import random

import numpy as np
from pyspark.sql import functions as F

from fieldglass import catalog
from fieldglass.llm import kmeans_tree
from fieldglass.operators import checks, intervals, patterns, postings

FOLDER = "/root/testdata/sf0.001"


def test_samples_are_the_least_keys(spark):
    rules = [(f"c{i}", "t", "id", f"id % 30 = {i}") for i in range(30)]
    rows = spark.range(3000).withColumn("id", F.when(F.col("id") % 100 > 0, F.col("id"))).repartition(3)
    rows = rows.unionByName(rows)
    got = {r.check_id: (r.violations, r.samples) for r in checks.regression_pack({"t": rows}, rules).collect()}
    own = {f"c{i}": [k for k in range(i, 3000, 30) if k % 100] for i in range(30)}
    assert got == {c: (2 * len(k), ",".join(sorted(map(str, k))[:5])) for c, k in own.items()}


def test_season_answers_have_a_small_plan(spark):
    plan = catalog.queries()["k07_season_answers"](spark, FOLDER)._jdf.queryExecution().optimizedPlan()
    longest = lambda node: max([len(x.toString()) for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(node.expressions())] + [longest(c) for c in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(node.children())] + [0])
    assert longest(plan) < 20_000


def test_a_query_goes_to_a_shelf_once(spark, monkeypatch):
    x = np.random.default_rng(1).normal(size=(1200, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    counts, write = {}, kmeans_tree.Workspace.write

    def counted(self, df, tag):
        out = write(self, df, tag)
        counts[tag] = out.count()
        return out

    monkeypatch.setattr(kmeans_tree.Workspace, "write", counted)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got: dict = {}
    for r in kmeans_tree.nearest(df, F.col("vec_id") % 3 == 0, recall=1.1, leaf_rows=10, block=100).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == kmeans_tree.brute_force(rows, lambda i: i % 3 == 0)
    assert counts["visits"] <= 400 * 24  # every query visits some 120 leaves, on shelves of 100 vectors


def test_shelves_hold_what_they_may():
    rows = {0: 5, 1: 5, 2: 1, 4: 30, 5: 9, 6: 2}
    assert kmeans_tree._shelves(rows, 10) == [([0, 1], 1), ([2], 1), ([4], 3), ([5], 1), ([6], 1)]


def test_range_totals(spark):
    r = random.Random(4)
    rows = [(i, None if i % 9 == 0 else r.randrange(-40, 400), None if i % 13 == 0 else "ab"[i % 2]) for i in range(300)]
    ranges = [(None if i % 10 == 0 else i, None if i % 8 == 0 else (a := r.randrange(-100, 450)), None if i % 7 == 0 else (a if i % 8 else 0) + r.randrange(-3, 200), None if i % 11 == 0 else "ab"[i % 2]) for i in range(120)]
    left = spark.createDataFrame(rows, "id long, at long, k string")
    right = spark.createDataFrame(ranges, "version long, first long, last long, k string")
    holds = lambda x, a, b: x is not None and (a is None or x >= a) and (b is None or x <= b)
    for keys in ([], ["k"]):
        want = {}
        for i, x, k in rows:
            own = [v for v, a, b, c in ranges if holds(x, a, b) and (a is None or b is None or a <= b) and (not keys or (k is not None and k == c))]
            if own:
                known = [v for v in own if v is not None]
                want[i] = (len(own), min(known), max(known), sum(known))
        out = intervals.range_totals(left, "at", right if keys else right.drop("k"), "first", "last", "version", keys)
        assert {x.id: (x.n, x.least, x.most, x.total) for x in out.collect()} == want and len(want) > 200
    assert intervals.range_totals(left.where("false"), "at", right, "first", "last", "version", ["k"]).count() == 0


def test_a_wide_range_of_places(spark):
    left = spark.createDataFrame([(1, 0), (2, 1 << 40), (3, (1 << 40) - 5)], "id long, at long")
    right = spark.createDataFrame([(7, None, None), (8, 3, None), (9, None, 1 << 39)], "version long, first long, last long")
    want = {(1, 7), (1, 9), (2, 7), (2, 8), (3, 7), (3, 8)}
    assert {(x.id, x.version) for x in intervals.range_join(left, "at", right, "first", "last").collect()} == want


def test_versions_are_not_paired_with_orders(spark):
    """A million rows in a thousand ranges each would be a thousand million pairs."""
    rows = spark.range(1_000_000).select("id", (F.col("id") % 500).alias("at"))
    ranges = spark.range(1000).select(F.col("id").alias("version"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
    out = intervals.range_totals(rows, "at", ranges, "first", "last", "version")
    assert tuple(out.agg(F.count("*"), F.min("n"), F.max("n"), F.max("least"), F.min("most"), F.min("total")).first()) == (1_000_000, 1000, 1000, 0, 999, 499_500)


def test_no_row_for_question_term_and_document(spark, tmp_path):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abc") for _ in range(r.randrange(1, 6)))
    rows = [(i % 250, None if i % 9 == 0 else " ".join(word() for _ in range(r.randrange(30))), None if i % 4 == 0 else word()) for i in range(250)]
    rows += [(1000 + i, "abc abc ca", "ab") for i in range(40)]  # equal scores: the first keys count
    asked = [(i, [w if i % 3 else w.upper() for w in (word(), word(), "abc")[: r.randrange(4)]]) for i in range(120)] + [(500, [None, "b"]), (501, None), (502, ["", " ", "ab"]), (503, ["abc"])]
    docs, path = spark.createDataFrame(rows, "id long, text string, title string").repartition(3), str(tmp_path / "i")
    index = {}
    for name, (frame, _) in postings.build(docs, "id", "text", "title").items():
        frame.write.parquet(f"{path}/{name}")
        index[name] = spark.read.parquet(f"{path}/{name}")
    questions = spark.createDataFrame(asked, "query_id long, words array<string>")
    found = lambda df: sorted(map(tuple, df.select("query_id", "rank", "key", "score").collect()))
    plan = postings.search(index, questions, 5)._jdf.queryExecution().executedPlan().toString()
    assert "gram#" not in plan and "MapInArrow" in plan
    got = found(postings.search(index, questions, 5))
    assert got == found(postings.search(index, questions, 5, block=11))
    for q, words in asked:
        own = [(k, s) for i, _, k, s in got if i == q]
        if words and all(words) and " " not in words:
            from fieldglass.operators import retrieval

            if q % 40 == 0 or q > 502:
                assert own == [(x.key, x.score) for x in retrieval.bm25(docs, "id", "text", "title", words, 5).collect()]
    assert [k for q, _, k, _ in got if q == 503] and not [1 for q, *_ in got if q == 501]


def test_batches_are_cut_by_words(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(postings, "_AT_ONCE", 10)
    sizes = [4, 6, 1, 30, 0, 0, 10, 2, 9]
    cut = [x.column("len0").to_pylist() for x in postings._slices([pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32())], ["len0"])])]
    assert cut == [[4, 6], [1], [30], [0, 0, 10], [2], [9]]


def test_texts_are_read_once_whatever_the_patterns(spark):
    r = random.Random(8)
    word = lambda least: "".join(r.choice("abé") for _ in range(r.randrange(least, 24)))
    own = [(i, word(1) if i % 3 else word(1)[:2]) for i in range(300)] + [(400, None), (None, "a"), (500, "abab")]
    texts = [(i, None if i % 17 == 0 else r.choice(own[:300])[1] * (i % 2) + word(0) + "c" + word(0)[:9]) for i in range(150)] + [(900, ""), (901, "c")]
    t = spark.createDataFrame(texts, "id long, text string").repartition(3)
    for more in ([], [(700, "")]):
        p = spark.createDataFrame(own + more, "place long, name string")
        known = [(a, n) for a, n in own + more if a is not None and n is not None]
        want = {i: x for i, text in texts if text is not None and (x := min((a for a, n in known if n in text), default=None)) is not None}
        for most in (100_000, 120, 20, 3):
            out = patterns.first_of_all(t, "id", "text", p, "place", "name", most=most)
            assert {x.id: x.place for x in out.collect()} == want
            assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= 1
