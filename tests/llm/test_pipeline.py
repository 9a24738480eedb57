"""The stages of the pipeline against plain Python."""

from collections import Counter

import corpus_pipeline
from fieldglass.llm import mixing
from fieldglass.llm.common import written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_mixing_writes_shards_in_order_and_spreads_copies(spark):
    rows = [(i, f"word{i} " * (9 if i % 2 else 1), "en", "a" if i % 2 else "b", 1) for i in range(400)] + [(None, f"loose {i}", "en", "b", 1) for i in range(20)]
    docs = written(spark.createDataFrame(rows, SCHEMA).repartition(3), "docs")
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    got = [tuple(r) for r in mixed.collect()]
    drawn = mixing.draws(docs).collect()
    want = [tuple(r)[:5] for r in sorted(drawn, key=lambda r: (r.mix_shard, r.mix_order))]
    assert mixed.columns == docs.columns and got == want
    often = Counter(got)
    side_by_side = sum(a == b for a, b in zip(got, got[1:]))
    assert max(often.values()) > 1 and side_by_side < sum(often.values()) / 50


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    text = lambda word: " ".join(f"{word}{i}" for i in range(30))
    rows = [(1, text("a")), (1, text("b")), (1, text("b")), (1, None), (2, text("c")), (3, text("c")), (3, text("d")), (3, text("d")), (None, text("c")), (4, None)]
    docs = written(spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], SCHEMA).repartition(2), "docs")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect())
    assert got == Counter(set(rows) - {(3, text("c"))})


def test_run_and_stages_against_plain_python(spark, tmp_path):
    from fieldglass.llm import packing, pii
    from fieldglass.llm.queries import tokenizer_file

    text = lambda word, n=60: " ".join(f"{word}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(n))
    rows = [(i, text(chr(97 + i) * 2), "en", "s" if i % 2 else None, None, i) for i in range(6)] + [(9, text("mail a@b.co "), None, "s", 1, 9), (10, text("aa"), "en", "s", 1, 10), (5, text("ff"), "en", "s", None, 5), (11, "short", "en", "s", 1, 11), (12, None, "en", "s", 1, 12), (None, text("zz"), "en", "s", 1, 13)]
    frame = spark.createDataFrame(rows, SCHEMA + ", extra int")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    rule = [r for r in rows if r[1] and len(r[1].split()) >= 50]
    good = written(corpus_pipeline.quality_rules(spark, docs, ""), "good")
    assert Counter((r.doc_id, r.text, r.extra) for r in good.collect()) == Counter((r[0], r[1], r[5]) for r in rule)
    once = [r for r in dict.fromkeys((r[0], r[1], r[5]) for r in rule) if r[0] != 10]
    near = written(corpus_pipeline.near_dedup_stage(spark, good, ""), "near")
    assert Counter((r.doc_id, r.text, r.extra) for r in near.collect()) == Counter(once)
    masked = written(corpus_pipeline.mask_pii(spark, near, ""), "masked")
    want = {i: pii.masked(t, pii.spans(t)) for i, t, _ in once}
    assert {r.doc_id: r.text for r in masked.collect()} == want and "[EMAIL]" in want[9]
    assert all(r.n_chars == len(r.text) for r in masked.collect())
    copies = Counter()
    for r in mixing.mix(masked).collect():
        copies[r.doc_id] += len([x for x in r.shards.split(",") if x])
    mixed = corpus_pipeline.mix_sources(spark, masked, "")
    assert Counter(r.doc_id for r in mixed.collect()) == +copies
    pieces = packing.pack(mixed, tokenizer_file("byte_bpe_50k.json")).select("doc_id", "length").collect()
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "length").collect()) == Counter(map(tuple, pieces))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), "").count() == 0


def test_stages_keep_columns_of_any_name(spark):
    names = ["shards", "spans", "masked", "key", "_key", "doc", "id", "digest", "mix_shard", "mix_order", "_copy", "kept_key", "odd name"]
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(60)) + f" mail u{i}@b.co"
    rows = [(i, text(i), "en", "s", 1, *[f"{n}{i}" for n in names]) for i in range(4)]
    docs = written(spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names]), "docs")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, ""), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
    assert {tuple(r)[5:] for r in docs.collect()} == {r[5:] for r in rows}
