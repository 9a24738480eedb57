"""Merkle manifest, turn repair and the k-means tree against brute force on small tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldglass.llm import kmeans_tree, merkle_manifest, turn_repair
from fieldglass.llm.common import written

DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path int"


def documents(n, sources):
    r = random.Random(n)
    rows = [(i, None if i % 13 == 0 else "hot" if i % 3 == 0 else f"s{r.randrange(sources)}é", None if i % 7 == 0 else "en", None if i % 5 == 0 else i, None if i % 17 == 0 else "" if i % 19 == 0 else f"Text {i} ÀB", "x", 1) for i in range(n)]
    return rows + ([rows[3], rows[3], (None, "hot", None, None, None, None, None)] if n > 3 else [])


def lowered(r):
    text = r[4]
    return text.translate(str.maketrans(merkle_manifest._UPPER, merkle_manifest._LOWER)) if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else text


@pytest.mark.parametrize("n,sources,height", [(0, 1, 1), (1, 1, 3), (40, 2, 1), (600, 3, 1), (600, 300, 2), (700, 1, 3)])
def test_manifest(spark, n, sources, height):
    rows = documents(n, sources)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    lower = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", merkle_manifest._UPPER, merkle_manifest._LOWER))
    got = merkle_manifest.manifest(docs, lower, height)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == Counter(merkle_manifest.brute_force([r[:5] for r in rows], lowered))


def test_a_proof_of_one_source_and_one_leaf(spark):
    row = spark.createDataFrame([(7, "a", None, 3, "Abc")], "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle_manifest.manifest(row, F.lit("abc")).first()
    leaf = merkle_manifest.digest("1:71:a-1:33:Abc")
    assert (got.leaf, got.subroot, got.root, got.proof_sha256) == (leaf, leaf, leaf, merkle_manifest.digest(""))
    assert got.folded_root == merkle_manifest.digest("1:71:a-1:33:abc") and not got.verified


def turns(r, n):
    roles = ["user", "assistant", "system", "tool", "", "aside", None]
    texts = ["Yes.", "No!", "cut off", " \t", "", None, "Why? ", "one two.\n"]
    return [(None if r.random() < 0.1 else r.randrange(8), r.choices(roles, [5, 5, 1, 1, 1, 1, 1])[0], r.choices(texts, [6, 4, 3, 1, 1, 1, 3, 3])[0]) for _ in range(n)]


def in_order(rows):
    import hashlib

    full = [(t, " " if role is None else role, " " if text is None else text) for t, role, text in rows]
    return sorted(full, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest()))


def after_damage(conv, rows):
    out = []
    for t, role, text in in_order(rows):
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if t is None else t}".encode()) % 20
        text = "" if code == 1 else text.translate(str.maketrans("", "", ".!?")) if code == 2 else text
        out += [(t, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def test_settle_is_the_cheapest_edit():
    r = random.Random(4)
    for _ in range(400):
        rows = in_order(turns(r, r.randrange(6)))
        assert turn_repair.settle(rows) == turn_repair.brute_force(rows), rows


@pytest.mark.parametrize("stretch", [1, 3, 4096])
def test_repair(spark, stretch):
    r = random.Random(stretch)
    made = {i if i else None: turns(r, r.randrange(1, 7)) for i in range(60)}
    rows = [(c, *x, 9, "seg") for c, x in made.items() for x in made[c]]
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int, copy string").repartition(3)
    got = {x[0]: tuple(x)[1:] for x in turn_repair.repair(convs, stretch=stretch).collect()}
    assert got == {c: turn_repair.brute_force(after_damage(c, x)) for c, x in made.items()}
    assert turn_repair.repair(convs.where("false")).count() == 0


def test_a_conversation_of_many_stretches(spark):
    r = random.Random(8)
    rows = [(5, i // 2, r.choice(["user", "assistant", "system"]), r.choice(["Yes.", f"{i}!", f"cut {i % 40}", ""])) for i in range(3000)]
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = tuple(turn_repair.repair(convs, stretch=64).first())[1:]
    assert got == turn_repair.settle(after_damage(5, [x[1:] for x in rows]))
    whole = tuple(turn_repair.repair(convs, damage=None).first())[1:]
    assert whole == turn_repair.settle(in_order([x[1:] for x in rows]))


def test_no_rows_after_damage(spark):
    turn = next(i for i in range(1000) if zlib.crc32(f"1:{i}".encode()) % 20 == 0)
    got = turn_repair.repair(spark.createDataFrame([(1, turn, "user", "x.")], "conv_id long, turn long, role string, text string")).first()
    import hashlib

    assert tuple(got) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def vectors(n, dim, seed, groups=12):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(groups, dim))
    return (centre[r.integers(groups, size=n)] + 0.5 * r.normal(size=(n, dim))).astype(np.float32)


def found(rows):
    out: dict = {}
    for x in sorted(rows, key=lambda x: (x.query_id, x["rank"])):
        out.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    return out


def test_recall_and_scores(spark):
    x = vectors(4000, 16, 1)
    x[1000:2300] = x[7]  # a third are copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = written(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5), "vectors")
    got = found(kmeans_tree.nearest(df, F.col("vec_id") % 20 == 0, leaf_rows=40, block=64).collect())
    want = kmeans_tree.brute_force(rows, lambda i: i % 20 == 0)
    assert got.keys() == want.keys()
    hits = 0
    for q, top in got.items():
        assert [r for r, _, _ in top] == list(range(1, 21))
        assert [(-s, i) for _, i, s in top] == sorted((-s, i) for _, i, s in top) and q not in [i for _, i, _ in top]
        assert all(s == float((x[i].astype(float) * x[q].astype(float)).sum()) for _, i, s in top)
        hits += len({i for _, i, _ in top} & {i for i, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9
    for q in range(1000, 2300, 20):  # its copies are all as near, so the least ids come first
        assert [i for _, i, _ in got[q]] == [i for i, _ in want[q]]


def test_whole_tree_is_exact(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(300, 4, 2).astype(float))] + [(5000 + i, v) for i, v in enumerate([None, [0.0] * 4, [1.0, None, 0.0, 2.0], [float("nan")] * 4, [1.0, float("inf"), 0.0, 0.0], [], [1.0], [2.0, 1.0]])] + [(None, [1.0] * 4), (0, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "leaf") for i, v in rows], "vec_id long, embedding array<double>, v int, ids string").repartition(3)
    got = kmeans_tree.nearest(df.where("vec_id is null or vec_id > 0"), F.col("vec_id") % 20 == 0, recall=1.1, leaf_rows=20).collect()
    want = kmeans_tree.brute_force([x for x in rows if x[0] != 0], lambda i: i % 20 == 0)
    assert {q: [(i, s) for _, i, s in x] for q, x in found(got).items()} == want
    few = kmeans_tree.nearest(df.where("vec_id between 1 and 21"), F.col("vec_id") % 20 == 0, leaf_rows=2)
    assert {q: [(i, s) for _, i, s in x] for q, x in found(few.collect()).items()} == kmeans_tree.brute_force([x for x in rows if x[0] and x[0] < 22], lambda i: i % 20 == 0)
    assert kmeans_tree.nearest(df.where("false"), F.lit(True)).count() == 0
    assert kmeans_tree.nearest(df.where("vec_id = 5001"), F.lit(True)).count() == 0
    assert kmeans_tree.nearest(df, F.lit(False)).count() == 0


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_turn_repair"])
def test_queries_are_their_sql(spark, name):
    import duckdb

    from fieldglass.llm.queries import ORACLES, QUERIES

    folder, c = "/root/testdata/sf0.001", duckdb.connect()
    for x in ("documents", "conversations"):
        c.sql(f"create view {x} as select * from '{folder}/{x}.parquet'")
    got, want = QUERIES[name](spark, folder), c.sql(ORACLES[name])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_query_of_neighbours_finds_nine_tenths(spark):
    from fieldglass.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = found(QUERIES["op13_kmeans_tree"](spark, folder).collect()), kmeans_tree.brute_force(rows, lambda i: i % 20 == 0)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    assert sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / (20 * len(want)) >= 0.9
