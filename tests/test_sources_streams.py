"""Readers, writers, streams, chunks and the step runner on small inputs."""

import json
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldglass import sources, streaming
from fieldglass.operators import chunking, dag


def got(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()]


def test_csv_and_json(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None), (3, 'q"')], "k int, s string")
    sources.csv_report(df, str(tmp_path / "c"))
    assert got(sources.csv_table(spark, str(tmp_path / "c"), "k int, s string"), "k")[:2] == [(1, "a,b"), (2, None)]
    sources.json_report(df, str(tmp_path / "j"))
    assert got(sources.json_table(spark, str(tmp_path / "j"), "k int, s string", lines=True), "k") == [(1, "a,b"), (2, None), (3, 'q"')]
    (tmp_path / "g.json").write_text(json.dumps([{"id": "1", "query": "x", "relevantChunkIds": ["a"]}, {"id": None}]))
    assert sources.golden_queries(spark, str(tmp_path / "g.json")).count() == 1


def test_html_and_markdown(spark, tmp_path):
    page = "<table><tr><th>n</th><th> r </th></tr><tr><td><b>1</b></td><td>2\n3</td></tr></table><p class=x>one</p><pre>no</pre><P>two</P>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "k int, html string")
    assert got(sources.html_tables(df, "k", "html"), "row") == [(1, 0, 0, ["n", "r"]), (1, 0, 1, ["1", "2 3"])]
    assert [r[2] for r in got(sources.html_text(df, "k", "html", "p"), "n")] == ["one", "two"]
    texts = {"a_first file.md": "\n \n## Title here\nmore", "bylaws/b.md": "text\n# not first", "kbo_rulebook/baseball_rules/x/scoring_rules/glossary/c.md": "#C#", "other/d.md": " ", "glossary/kbo_rulebook/e.md": "# E"}
    for name, text in texts.items():
        (tmp_path / "docs" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "docs" / name).write_text(text)
    got_docs = {r.path.rsplit("/", 1)[-1][:1]: (r.category, r.subcategory, r.title) for r in sources.markdown_documents(spark, str(tmp_path / "docs")).collect()}
    assert got_docs == {"a": ("rulebook", None, "Title here"), "b": ("bylaws", None, "B"), "c": ("game_rules", "glossary", "C#"), "d": ("rulebook", None, "D"), "e": ("glossary", "rulebook", "E")}


def test_keyed_writes(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    new = spark.createDataFrame([(2, None, 9), (3, "c", 3)], "k int, s string, n int")
    assert got(sources.upsert(old, new, ["k"]), "k") == [(1, "a", 1), (2, "b", 9), (3, "c", 3)]
    assert got(sources.merge(old, new, ["k"]), "k") == [(1, "a", 1), (2, None, 9), (3, "c", 3)]
    path = str(tmp_path / "p")
    for df in (old, new, new):
        sources.replace_partitions(df, path, ["k"])
    assert got(spark.read.parquet(path).select("k", "s", "n"), "k") == [(1, "a", 1), (2, None, 9), (3, "c", 3)]
    assert sources.since(old, "n", 2).count() == 1 and sources.since(old, "n", None).count() == 2


def test_stream_dedup_and_incremental(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    batches = [["a", "b", "a"], ["b", "c"], ["d"], ["a"]]
    for i, b in enumerate(batches):
        spark.createDataFrame([("g", k) for k in b], "game string, id string").coalesce(1).write.mode("append").parquet(src)
        streaming.run_incremental(streaming.exact_new(spark.readStream.schema("game string, id string").parquet(src), "game", "id", last=3), out, check).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "a", "b", "c", "d"]


def test_watermarked_dedup(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.sql("select * from values ('a', timestamp '2024-01-01 00:00:00'), ('a', timestamp '2024-01-01 00:01:00'), ('b', timestamp '2024-01-01 00:02:00') as t(id, at)").write.parquet(src)
    s = streaming.new_events(spark.readStream.schema("id string, at timestamp").parquet(src), "id", "at")
    streaming.run_incremental(s, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_replay_changes_broker_key(spark):
    df = spark.createDataFrame([("g", i, f"p{i // 2}") for i in range(6)] + [("h", 0, None)], "g string, n int, p string")
    assert got(streaming.replay(df, "g", "n", "p", 3), "g") == [("g", ["p1", "p2", "p2"]), ("h", [None])]
    assert [r.n for r in streaming.changed_only(df, "g", "n", "p").orderBy("g", "n").collect()] == [0, 2, 4, 0]
    seen, b = [], streaming.Broker("g")
    b.subscribe(lambda x: seen.append(x.count()))
    b.subscribe(lambda x: 1 / 0)
    b.subscribe(lambda x: seen.append(x.count()), "h")
    assert b.publish(df) == 2 and seen == [7, 1]
    keys = spark.createDataFrame([("x", 1, 2, "d"), (" ", 1, 2, "d"), (None, 1, 2, "d")], "k string, i int, s int, d string").select(streaming.live.event_key("k", "i", "s", "d").alias("k"))
    a, blank, none = [r.k for r in keys.collect()]
    assert a == "x" and blank == " " and len(none) == 16


def plain_overlap(text, limit, overlap):
    """By the rules, in plain Python."""
    blocks = [p.strip() for p in (text or "").split("\n\n") if p.strip()] or [p.strip() for p in (text or "").split("\n") if p.strip()]
    done, now = [], ""
    for p in blocks:
        for piece, sep in [(x, " ") for x in re.split(r"(?<=[.!?])\s+", p)] if len(p) > limit else [(p, "\n\n")]:
            if not now:
                now = piece
            elif len(now) + len(piece) <= limit:
                now = (now + sep + piece).strip() if sep == " " else now + sep + piece
            else:
                done.append(now)
                now = (now[-overlap:] if overlap else "") + sep + piece
    return done + [now] * bool(now)


def test_chunks(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 9))) + r.choice(["", "", "", ".", "!"])
    texts = ["", None, "x" * 2000, "one line\nanother line\n\n \n"] + ["".join(word() + r.choice([" ", " ", " ", "\n", "\n\n"]) for _ in range(r.randint(1, 400))) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, t string").repartition(3)
    for limit, overlap in ((400, 50), (90, 0)):
        rows = {}
        for x in chunking.chunk_overlap(docs, "k", "t", limit, overlap).orderBy("k", "n").collect():
            rows.setdefault(x.k, []).append(x.chunk)
        assert rows == {k: c for k, t in enumerate(texts) if (c := plain_overlap(t, limit, overlap))}
    family = chunking.chunk_family(docs, "k", "t", 300, 80).collect()
    assert {(x.k, x.parent_n, x.parent) for x in family} == {(k, i, c) for k, t in enumerate(texts) for i, c in enumerate(plain_overlap(t, 300, 100))}
    s = spark.createDataFrame([(1, 0, "a", [1.0, 0.0]), (1, 1, "b", [1.0, 0.1]), (1, 2, "c", [0.0, 1.0])], "k int, o int, t string, v array<double>")
    assert got(chunking.chunk_semantic(s, "k", "o", "t", "v"), "n") == [(1, 0, "a b"), (1, 1, "c")]
    assert [x.sentence for x in chunking.sentence_rows(spark.createDataFrame([(1, "One. Two!  Three")], "k int, t string"), "k", "t").orderBy("place").collect()] == ["One.", "Two!", "Three"]


def test_headings(spark):
    text = "Intro of more than thirty characters.\n## 키워드\n- a, b\n- c\n## First part\nwith a text of more than thirty characters\n## Stub\nx\n제 3 조 rule\nthe rule has a long enough text here\n#### deep\n1. 가나 a point with a long enough text"
    docs = spark.createDataFrame([(1, text, "rules"), (2, None, "rules"), (3, "plain", None)], "k int, t string, c string")
    parts = got(chunking.chunk_headings(docs.where("k = 1"), "k", "t"), "n")
    assert [p[2].split("\n")[0] for p in parts] == ["Intro of more than thirty characters.", "## First part", "제 3 조 rule", "1. 가나 a point with a long enough text"]
    assert parts[1][2].endswith("\n## Stub\nx") and {p[3] for p in parts} == {"a,b,c"}
    assert Counter((x.k, x.way) for x in chunking.chunk_by_category(docs, "k", "t", "c").collect()) == {(1, "headings"): 4, (3, "overlap"): 1}


def test_upload_and_rows_in_order(spark, tmp_path):
    (tmp_path / "r.csv").write_text("game_id,event_seq,inning,inning_half,description,home_score,away_score\ng,1,1,top,old,0,0\n,2,1,top,no game,0,0\ng,2,1,top,x,0,0\ng,1,1,top,new,0,1\ng,bad,1,top,y,0,0\n")
    assert [tuple(r)[:5] for r in sources.relay_upload(spark, str(tmp_path / "r.csv")).orderBy("event_seq").collect()] == [("g", 1, 1, "top", "new"), ("g", 2, 1, "top", "x")]
    assert sum(1 for _ in sources.stream_rows(spark.range(10).repartition(3))) == 10


def test_finished_games_leave_no_state(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    for batch in ([("a", False), ("b", True)], [("a", False)]):
        spark.createDataFrame([("g", k, f) for k, f in batch], "game string, id string, f boolean").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("game string, id string, f boolean").parquet(src)
        streaming.run_incremental(streaming.exact_new(stream, "game", "id", final="f"), out, check).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "a", "b"]
    events = spark.createDataFrame([("g", 1), ("h", 2)], "game string, n int")
    assert [r.game for r in streaming.purged(events, spark.createDataFrame([("g",), ("g",)], "game string"), "game").collect()] == ["h"]


def test_nested_tables_and_references(spark):
    page = "<table><tr><td colspan=2>a &amp; b<br>c</td><td><table><tr><td>in</td></tr></table></td></tr><tr><td>d</table><p>x &lt; y</p><P>z<p>w</p>"
    df = spark.createDataFrame([(1, page), (2, None)], "k int, html string")
    assert got(sources.html_tables(df, "k", "html"), "table", "row") == [(1, 0, 0, ["a & b c", "a & b c", ""]), (1, 0, 1, ["d"]), (1, 1, 0, ["in"])]
    assert [r.text for r in sources.html_text(df, "k", "html", "p").orderBy("n").collect()][0] == "x < y"


def test_steps():
    S = dag.Step
    out = dag.run_steps({"c": S(lambda r: r["a"] + 1, ["a"]), "a": S(lambda r: 1), "b": S(lambda r: 1 / 0), "d": S(lambda r: 2, ["b"]), "e": S(lambda r: 1 / 0, allow_failure=True), "f": S(lambda r: 3, ["e"])})
    assert [out[x][0] for x in "abcdef"] == ["done", "failed", "done", "skipped", "failed", "done"] and out["c"][1] == 2
    for bad in ({"a": S(print, ["z"])}, {"a": S(print, ["b"]), "b": S(print, ["a"])}):
        with pytest.raises(ValueError):
            dag.run_steps(bad)
