"""Published tables, keyed sinks that count a batch once, and the replay of live games."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from fieldglass.sources import published
from fieldglass.streaming import games

SCHEMA = "k long, season int, v string"


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_only_what_a_manifest_names_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, 2020 + i % 3, f"a{i}") for i in range(30)], SCHEMA).repartition(4)
    assert rows_of(published.read(spark, path, SCHEMA), "k") == []
    published.write(df, path, by="season", zones=["k"], replace=[])
    published.write(df, path, by="season", zones=["k"], replace=[])  # again: the same rows
    assert rows_of(published.read(spark, path, SCHEMA), "k") == rows_of(df, "k")
    bad = df.withColumn("v", F.when(F.col("k") == 7, F.expr("raise_error('no')")).otherwise(F.lit("b")))
    with pytest.raises(Exception, match="no"):
        published.write(bad.coalesce(1), path, by="season", zones=["k"], replace=[])
    (tmp_path / "t" / "data" / "stray.parquet").write_bytes(b"left by a task that died")
    assert rows_of(published.read(spark, path, SCHEMA), "k") == rows_of(df, "k") and published.versions(path) == [1, 2]
    published.write(df.where("season = 2021").withColumn("v", F.lit("new")), path, by="season", zones=["k"], replace=[2020])
    assert {(r.season, r.v == "new") for r in published.read(spark, path, SCHEMA).collect()} == {(2021, True), (2022, False)}
    assert published.read(spark, path, SCHEMA, version=1).count() == 30
    published.write(df.limit(3), path, zones=["k"])
    assert published.read(spark, path, SCHEMA).count() == 23
    published.write(df.limit(2), path, zones=["k"], overwrite=True)
    assert published.read(spark, path, SCHEMA).count() == 2


def test_one_writer_publishes_a_version(tmp_path):
    path = str(tmp_path / "t")
    assert published.publish(path, 0, [], {}) == 1
    with pytest.raises(FileExistsError):
        published.publish(path, 0, [{"file": "x"}], {})
    assert published.manifest(path)["files"] == [] and published.versions(path) == [1]


def test_pages_open_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id * 3 AS k", "1 AS season", "concat('v', id) AS v").repartitionByRange(10, "k")
    published.write(df, path, zones=["k"])
    files = published.manifest(path)["files"]
    assert len(files) == 10 and sum(f["rows"] for f in files) == 1000
    after, seen = None, []
    while True:
        opened = published.files_above(files, "k", after, 70)
        got = [r.k for r in published.page(spark, path, SCHEMA, "k", after, 70).collect()]
        if not got:
            break
        assert len(opened) <= 3
        seen, after = seen + got, got[-1]
    assert seen == [i * 3 for i in range(1000)]
    late = published.since(spark, path, SCHEMA, "k", 2700)
    assert late.count() == 100 and len(late.inputFiles()) <= 2
    r = random.Random(1)
    for _ in range(200):  # files that overlap, by brute force
        rows = [sorted(r.sample(range(60), r.randrange(1, 9))) for _ in range(6)]
        files = [{"file": i, "rows": len(x), "zones": {"k": [x[0], x[-1]]}} for i, x in enumerate(rows)]
        after, n = r.choice([None, *range(-1, 60)]), r.randrange(1, 12)
        above = sorted(k for x in rows for k in x if after is None or k > after)
        some = sorted(k for f in published.files_above(files, "k", after, n) for k in rows[f["file"]] if after is None or k > after)
        assert some[:n] == above[:n]


@pytest.mark.parametrize("merge", [False, True])
def test_a_batch_counts_once(spark, tmp_path, merge):
    path = str(tmp_path / "t")
    table = published.KeyedTable(path, SCHEMA, ["k"], order="season", buckets=4, merge=merge)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first = [(i, 1, f"a{i}") for i in range(20)] + [(3, 2, "later"), (None, 1, "no key")]
    assert table.apply(frame(first), 0) and table.batches() == 0
    want = {i: (1, f"a{i}") for i in range(20)} | {3: (2, "later")}
    read = lambda: {r.k: (r.season, r.v) for r in table.read(spark).collect()}
    assert read() == want and table.read(spark).count() == 20
    second = frame([(3, 5, None), (50, 6, "new")])
    killed = published._Writer({"path": path, "by": "_bucket", "replace": "[0, 1, 2, 3]", "notes": '{"batch": 1, "replace": true}'}, False)
    staged = killed.write(iter(second.withColumn("_bucket", F.lit(1)).toArrow().to_batches()))  # all tasks are done, and then nothing
    assert sum(f["rows"] for f in staged.files) == 2 and read() == want and table.batches() == 0
    assert table.apply(second, 1)
    want |= {3: (5, None if merge else "later"), 50: (6, "new")}
    assert read() == want and not table.apply(second, 1) and not table.apply(frame([(3, 9, "old batch")]), 0) and read() == want
    files = {f["part"]: f["file"] for f in published.manifest(path)["files"]}
    table.apply(frame([(50, 7, "again")]), 2)
    now = {f["part"]: f["file"] for f in published.manifest(path)["files"]}
    assert sum(files[b] != now[b] for b in files) == 1  # the other buckets' files stay


def test_following_a_stream_with_restarts(spark, tmp_path):
    src, path, check = (str(tmp_path / x) for x in ("src", "t", "check"))
    table = published.KeyedTable(path, SCHEMA, ["k"], order="season", buckets=4)
    for season in (1, 2, 3):
        spark.createDataFrame([(k, season, None if k % 2 else f"s{season}") for k in range(season * 2)], SCHEMA).coalesce(1).write.mode("append").parquet(src)
        published.follow(spark.readStream.schema(SCHEMA).parquet(src), table, check).awaitTermination(120)
    assert rows_of(table.read(spark), "k") == [(0, 3, "s3"), (1, 3, None), (2, 3, "s3"), (3, 3, None), (4, 3, "s3"), (5, 3, None)]
    assert table.batches() == 2
    q = published.follow(spark.readStream.schema(SCHEMA).parquet(src), table, check, every="1 second")
    spark.createDataFrame([(0, 9, "live")], SCHEMA).coalesce(1).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    assert rows_of(table.read(spark), "k")[0] == (0, 9, "live") and json.dumps(published.manifest(path)["notes"]) == '{"batch": 3}'


def test_live_replay(spark, tmp_path):
    src, check, out = str(tmp_path / "src"), str(tmp_path / "check"), []
    games.use_state_store(spark)
    schema = "game string, seq long, what string, at timestamp, final boolean"
    t0 = dt.datetime(2024, 5, 1, 12)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    batches = [
        [("g", 2, "b", at(2), False), ("g", 1, "a", at(1), False), ("h", 1, "x", at(1), None)],
        [("g", 4, "d", at(5), False), ("g", 3, "late", at(4), False), ("h", 2, "end", at(3), True), (None, 1, "no game", at(3), False)],
        [("h", 3, "after the end", at(6), False), ("g", 5, "e", at(7), False)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = games.live_replay(spark.readStream.schema(schema).parquet(src), "game", "seq", "what", "at", "final", last=3)
        q = stream.writeStream.outputMode("update").foreachBatch(lambda b, n: out.extend(tuple(r) for r in b.orderBy("game").collect())).option("checkpointLocation", check).trigger(availableNow=True).start()
        q.awaitTermination(120)  # each round starts anew from the checkpoint
        assert q.exception() is None
    out = [x for x in out if x[0]]
    assert out == [("g", 2, ["a", "b"], False), ("h", 1, ["x"], False), ("g", 3, ["b", "late", "d"], False), ("h", 2, ["x", "end"], True), ("g", 3, ["late", "d", "e"], False)]
