"""The corpus operators on small tables with nulls, empties, repeats and clashing columns, against brute force."""

import gzip
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldglass.llm import html_paths, line_quality, media_archive, mixing, near_dedup, packing, pii, span_dedup, token_records, tokens, warc_fixity
from fieldglass.llm.common import scratch, written
from fieldglass.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, target double"


def corpus():
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 5))) for _ in range(300)]
    line = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    texts: list = [line(r.randint(1, 120)) for _ in range(30)]
    passage = line(40)
    texts += [texts[3], texts[3], texts[5] + " tail", passage + "\n" + line(30), line(20) + " " + passage, "a " * 60, "", None, "one", line(3000), "a <|endoftext|> b", "hello<|startoftext|>x"]
    rows = [(i, t, None if i % 9 == 0 else "en", None if i % 11 == 0 else f"s{i % 4}", None, 1, 0.5) for i, t in enumerate(texts)]
    return rows + [rows[7], (None, line(60), "en", "s1", 3, 1, 0.5)]


@pytest.fixture(scope="module")
def docs(spark):
    return written(spark.createDataFrame(corpus(), SCHEMA).repartition(3), "docs")


def empty(docs):
    return docs.where("false")


def test_spans(docs):
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in span_dedup.remove_repeats(docs).collect()}
    want = span_dedup.brute_force([(r[0], r[1]) for r in corpus()])
    assert got == set(want[["doc_id", "n_words", "n_removed", "kept_sha256"]].astype(object).where(want.notna(), None).itertuples(index=False, name=None))
    assert span_dedup.remove_repeats(empty(docs)).count() == 0


def test_spans_are_glued_and_verified(spark):
    r = random.Random(3)
    words = [f"w{r.randrange(10**6)}" for _ in range(400)]
    rows = [(1, " ".join(words)), (2, "x y z " + " ".join(words[50:350]) + " q"), (3, " ".join(words[:200]) + " cut " + " ".join(words[200:]))]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "docs")
    pieces = span_dedup.repeated_paths(docs, chunk_bytes=1)
    got = {tuple(x) for x in span_dedup.glued(pieces).collect()}
    assert got == {(2, 3, 288, 1, 50), (3, 0, 188, 1, 0), (3, 201, 188, 1, 200)} and pieces.count() > 3
    texts, paths = docs.withColumn("text", F.when(F.col("doc_id") > 1, F.col("text")).otherwise("other words")), written(span_dedup.glued(pieces), "paths")
    said = {(x.source_id, x.source_start, x.n): x.digest for x in span_dedup.source_digests(texts, paths, 13).collect()}
    run = {"start": 3, "n": 288, "digest": said[1, 50, 288]}
    assert span_dedup._cut(rows[1][1], [run], 13)[1] == 0  # the source does not hold these words
    true = {(x.source_id, x.source_start, x.n): x.digest for x in span_dedup.source_digests(docs, paths, 13).collect()}
    assert span_dedup._cut(rows[1][1], [run | {"digest": true[1, 50, 288]}], 13)[1] == 300


def test_near(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect() if r.doc_id is not None}
    assert got == near_dedup.brute_force([(r[0], r[1]) for r in corpus() if r[0] is not None])
    assert near_dedup.near_duplicates(docs).count() == len(corpus())
    assert near_dedup.near_duplicates(empty(docs)).count() == 0


def test_members_of_buckets_meet_their_components_once(docs, monkeypatch):
    from fieldglass.llm.common import Workspace

    joins, write = [], Workspace.write
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(Workspace, "write", lambda self, df, tag: joins.append((tag, plan(df).count("Join LeftOuter"))) or write(self, df, tag))
    near_dedup.near_duplicates(docs)
    assert max(n for _, n in joins) == 1 and {t for t, n in joins if n} == {"rooted"}


def test_settled_buckets_go(spark):
    from fieldglass.llm.common import Workspace

    members = spark.createDataFrame([(1, 0, 1), (1, 0, 2), (2, 0, 1), (2, 0, 2), (2, 0, 3), (3, 0, 4), (3, 0, 5)], "key long, hub long, rep long")
    parts = spark.createDataFrame([(1, 1), (2, 1)], "node long, root long")
    left = near_dedup._split(members, parts, Workspace(spark))
    assert sorted(map(tuple, left.collect())) == [(2, 1, 1), (2, 2, 1), (2, 3, 3), (3, 4, 4), (3, 5, 5)]



def test_chain_of_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 103), (103, 101)], "a long, b long")
    got = {r.node: r.root for r in near_dedup.components(links).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 103: 100}


@pytest.mark.parametrize("text,size", [("a b c a b c", 6), ("a a a a", 4), ("a b c d", 0), ("", 0), ("x y", 0), ("a b a b a", 5)])
def test_repeat_words(spark, text, size):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(text,)], "t string").select(line_quality.repeat_words(line_quality.words_of(F.col("t"))).alias("n")).first().n == size


def test_quality(docs):
    got = {r.doc_id: r for r in line_quality.quality(docs, min_docs=2, share=0.0).collect()}
    assert len(got) == len({r[0] for r in corpus()}) and got[37].n_words == 0 and got[37].base_failed
    assert got[35].n_repeat_words == 60 and not got[35].kept
    assert {r.doc_id for r in line_quality.filtered(docs, min_docs=2, share=0.0).collect()} == {i for i, r in got.items() if r.kept}
    assert line_quality.quality(empty(docs)).count() == 0


def test_frequent_lines_leave_one_copy(spark):
    rows = [(i, f"Shared  Line {i} here\n" + " ".join(chr(97 + i) * n for n in range(1, 61)), "h") for i in range(6)]
    out = {r.doc_id: r.text for r in line_quality.filtered(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_docs=3, share=0.0).collect()}
    assert [i for i, t in out.items() if t.startswith("Shared")] == [0] and len(out) == 6


def test_a_line_in_many_documents_goes_whatever_the_host(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(60)).translate(str.maketrans("0123456789", "abcdefghij"))
    rows = [(i, ("in five of forty\n" if i < 5 else "") + own(i), "h") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for most, gone in ((5, set()), (4, {1, 2, 3, 4})):
        assert {r.doc_id for r in line_quality.quality(df, min_docs=2, share=0.5, most_docs=most).where("n_removed_words > 0").collect()} == gone


def unaltered(path):
    """The library's own encoder for a file, as it is loaded."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_packing(docs):
    path = tokenizer_file("byte_bpe_50k.json")
    got = packing.pack(docs, path, window=64).toPandas()
    library = unaltered(path)
    plain = lambda t: library.encode(t or "", add_special_tokens=False).ids
    want = {(r[0], len(plain(r[1])) + 1) for r in corpus() if r[0] is not None}
    assert {(int(i), int(g.doc_tokens.iloc[0])) for i, g in got[got.doc_id.notna() & (got.doc_id != 7)].groupby("doc_id")} == {x for x in want if x[0] != 7}
    for i, g in got[got.doc_id.notna() & (got.doc_id != 7)].groupby("doc_id"):
        ids = np.array([*plain(corpus()[int(i)][1]), 0], "<u4")
        g = g.sort_values("start")
        assert list(g.start) == [0, *g.length.cumsum()[:-1]] and g.length.sum() == len(ids)
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for a, n, c in zip(g.start, g.length, g.ids_crc32))
    s = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert all(list(g.offset) == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 64 for _, g in s)
    assert packing.pack(empty(docs), path).count() == 0


def test_levels_choose_the_least_sum_of_squares():
    levels = packing.Levels(10)
    for size in [6, 6, 4, 3, 3, 7, 5, 2]:
        before = levels.counts.copy()

        def cost(h, size=size, before=before):
            c = before.copy()
            if h:
                c[h] -= 1
            if h + size < 10:
                c[h + size] += 1
            return int((c**2).sum())

        h = levels.place(size)
        options = [0] + [x for x in range(1, 11 - size) if before[x]]
        assert cost(h) == min(map(cost, options))


@pytest.mark.parametrize("sizes", [[600] * 500, list(range(1, 64)) * 9, [1] * 300, [63, 33, 33, 33, 33], [64, 128, 65] * 40])
@pytest.mark.parametrize("most", [4 * 64 * 64, 1 << 20])
def test_open_windows_are_bounded_and_nothing_is_lost(sizes, most):
    packer = packing.Packer(64, most, 0)
    for i, n in enumerate(sizes):
        packer.add(i, np.arange(n).astype("<u4"))
        held = sum(len(p[2]) for level in packer.open for window in level for p in window)
        assert packer.held == held <= most // 4 and [len(x) for x in packer.open] == packer.levels.counts.tolist()
    packer.flush()
    by, whole = {}, {}
    for doc, start, n, crc, total, sequence, offset in packer.rows:
        assert total == sizes[doc] and crc == zlib.crc32(np.arange(start, start + n).astype("<u4").tobytes())
        by.setdefault(sequence, []).append((offset, n))
        whole.setdefault(doc, []).append((start, n))
    for pieces, size in [(p, None) for p in by.values()] + [(whole[i], n) for i, n in enumerate(sizes)]:
        at = 0
        for a, n in sorted(pieces):
            assert a == at and n > 0
            at += n
        assert at <= 64 if size is None else at == size
    assert len(by) == -(-sum(sizes) // 64)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_library(name):
    enc, library, r = tokens.encoder(tokenizer_file(name)), unaltered(tokenizer_file(name)), random.Random(1)
    bits = [" ", "a", "\n", "B's", "é", "12", "q", ".", "ñ́", "\t", "  ", "\x01", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "Σ", "\x1f"]
    for _ in range(500):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 12)))
        assert np.frombuffer(enc.ids([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_letters_and_signs_by_blanks(name):
    enc, library = tokens.Encoder(tokenizer_file(name), 300), unaltered(tokenizer_file(name))
    letters = [chr(c) for c in range(33, 0x260) if chr(c).isalpha()]
    words = letters + [f"{a}{b}x" for a, b in zip(letters, letters[7:])] + [f"Ab{a}{x}" for a in letters[::9] for x in tokens._SIGNS + "'"]
    words += ["don't", "it's.", "a's", "x,'s", "e\u0301t\u00e9", "\u0130x", "\u212bb", "\u212a", "\u03a3\u03a3.", "ab12,", "((", "=\u0338", "a=\u0338", "\u00aa\u00ba", "x\u00ad", "a\u0378b", "_a_", "a__"]
    r = random.Random(2)
    texts = ["\n".join(" ".join(r.choices(words, k=9)) for _ in range(6)) for _ in range(150)] + ["\n".join(words), " ".join(words), "one", None, "", "two\tthree", "four  five", "six\u00a0seven"]
    for _ in range(2):
        for i in range(0, len(texts), 20):
            part = texts[i : i + 20]
            assert [np.frombuffer(x, "<u4").tolist() for x in enc.ids(part)] == [library.encode(t or "", add_special_tokens=False).ids for t in part]
    enc = tokens.Encoder(tokenizer_file(name))
    sent, whole = [], enc._whole
    enc._whole = lambda texts: sent.extend(texts) or whole(texts)
    enc.ids(["so ganteru gantera, \u00e9gantero.*** ganteru,"])
    assert enc.fast and not any("ganter" in x for x in sent)


def test_another_tokenizer_encodes_whole_texts(tmp_path):
    from tokenizers import pre_tokenizers

    assert all(tokens.encoder(tokenizer_file(n)).fast for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    other = tokens.Encoder(tokenizer_file("byte_bpe_50k.json")).library
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    other.save(str(tmp_path / "other.json"))
    enc, text = tokens.Encoder(str(tmp_path / "other.json")), "in the middle of the night\nand of the day"
    assert not enc.fast and np.frombuffer(enc.ids([text])[0], "<u4").tolist() == other.encode(text, add_special_tokens=False).ids


def test_records(docs, spark):
    path, folder = tokenizer_file("word_bpe_49k.json"), scratch(spark, "rec")
    shards = token_records.write_records(docs, folder, path, 2)
    got = token_records.read_records(shards, folder).orderBy("start").collect()
    library, start = unaltered(path), 0
    rows = sorted(corpus(), key=lambda r: (r[0] is None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    for r, q in zip(rows, got):
        ids = np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (q.start, q.n_tokens, q.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    one = shards.first()
    assert {d for d, _ in token_records.read_shuffled(one.path, folder, 3)} <= {r[0] for r in rows}
    bad = bytearray(token_records.frame(1, np.arange(5)))
    bad[20] ^= 1
    with pytest.raises(ValueError):
        token_records.unframe(bytes(bad))
    assert token_records.read_records(token_records.write_records(empty(docs), scratch(spark, "rec"), path, 2), folder).count() == 0


def test_mixing(docs):
    got = mixing.mix(docs).toPandas()
    assert len(got) == len(corpus()) and (got.taken <= 3 * got["size"]).all()
    sizes = {}
    for r in corpus():
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    order = sorted((x for x in sizes if x is not None)) + [None]
    weight, aim, free, left = {x: 1 + i % 3 for i, x in enumerate(order)}, {}, list(order), sum(sizes.values())
    while free:  # by definition, one source that is over at a time
        over = next((x for x in free if left * weight[x] / sum(weight[y] for y in free) > 3 * sizes[x]), free)
        for x in free if over is free else [over]:
            aim[x] = 3 * sizes[x] if over is not free else left * weight[x] / sum(weight[y] for y in free)
        left -= aim[over] if over is not free else 0
        free = [] if over is free else [x for x in free if x != over]
    source = {(r[0], len((r[1] or "").split())): r[3] for r in corpus()}
    got["source"] = [source[(None if np.isnan(i) else int(i), n)] for i, n in zip(got.doc_id, got["size"])]
    for x, part in got.groupby("source", dropna=False):
        x = None if x != x else x
        longest = max(len((r[1] or "").split()) for r in corpus() if r[3] == x)
        assert set(part.source_size) == {sizes[x]} and np.allclose(part.target, aim[x]) and abs(part.taken.sum() - aim[x]) <= longest
    again = mixing.mix(docs.repartition(5), most_sent=0).toPandas()
    key = lambda t: sorted(zip(t.doc_id.fillna(-1), t["size"], t.taken, t.shards))
    assert key(got) == key(again)
    assert mixing.mix(empty(docs)).count() == 0
    assert mixing.targets({"b": 10, "a": 1, None: 10}) == {"a": 3.0, "b": 7.2, None: 10.8}
    table = mixing.split(np.array([5, 0, 17]), 4, 9)
    assert table.sum(0).tolist() == [5, 0, 17] and (table >= 0).all()


def test_personal_data():
    r = random.Random(2)
    bits = ["@", "a", ".", "1", "25", "+", " ", "-", "(", "4111 1111 1111 1111", "b.c", "é", "192.168.1.1", "tel:", "://", "iban"]
    for _ in range(5000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert pii.listed(pii.brute_force(t)) == pii.listed([x for x in pii.spans(t) if x[0] in pii.BASE]), t
    assert [x[0] for x in pii.spans("IBAN: DE89 3704 0044 0532 0130 00 ok")] == ["iban"]
    assert pii.masked("mail a@b.co now", pii.spans("mail a@b.co now")) == "mail [EMAIL] now"


def test_long_runs_of_digits(spark):
    texts = ["1.2.3." + "0" * 5000, "1.2.3." + "9" * 5000 + " 9.8.7.06", "0" * 6000 + "1.2.3.4", "+" + "1" * 6000, "x@" + "y." * 3000 + "z", "iban " + "DE89" * 2000]
    for t in texts:
        assert pii.listed(pii.brute_force(t)) == pii.listed([x for x in pii.spans(t) if x[0] in pii.BASE])
    assert ("ip", 0, 5006) in pii.spans(texts[0]) and [x[0] for x in pii.spans(texts[1])] == ["ip"]
    rows = pii.find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for r, t in zip(rows, texts):
        base = pii.listed(pii.brute_force(t))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x.startswith(k) for x in base.split(",")) for k in pii.BASE)


def test_personal_data_rows(docs):
    assert pii.find_personal_data(docs.withColumnRenamed("size", "spans"), mask=True).count() == len(corpus())
    assert pii.find_personal_data(empty(docs)).count() == 0


def test_media(docs, spark):
    got = media_archive.media_column(docs, scratch(spark, "media")).collect()
    want = []
    for r in corpus():
        raw = (r[1] or "").encode()
        whole = raw + bytes(64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)
        want.append((r[0], len(raw), len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-64:])))
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    by = {}
    for r in got:  # equal texts, equal values; the features from the samples by plain loops
        assert by.setdefault(r.payload_sha256, tuple(r)[5:]) == tuple(r)[5:]
    texts = {hashlib.sha256(media_archive.pad((r[1] or "").encode())).hexdigest(): media_archive.pad((r[1] or "").encode()) for r in corpus()}
    for digest, (size, media, feature) in by.items():
        stored = media_archive.encode_image(texts[digest], len(texts[digest].rstrip(b"\0")))
        assert (len(stored), hashlib.sha256(stored).hexdigest()) == (size, media)
        rows = [texts[digest][i : i + 64] for i in range(0, len(texts[digest]), 64)]
        total, bits = sum(map(sum, rows)), ""
        for y in range(8):
            part = rows[y * len(rows) // 8 : max((y + 1) * len(rows) // 8, y * len(rows) // 8 + 1)]
            bits += "".join("1" if sum(sum(x[8 * c : 8 * c + 8]) for x in part) * 64 * len(rows) > total * 8 * len(part) else "0" for c in range(8))
        assert feature == f"64x{len(rows)}:{total * 1000 // (64 * len(rows))}:{int(bits, 2):016x}"
    assert media_archive.media_column(empty(docs), scratch(spark, "media")).count() == 0
    damaged = bytearray(media_archive.encode_image(bytes(64), 0))
    damaged[60] ^= 1
    with pytest.raises(ValueError):
        media_archive.decode_image(bytes(damaged))


def test_member_is_retried_alone(docs, spark):
    folder = scratch(spark, "media")
    path = media_archive.write_archives(docs, folder).collect()[0].path
    with open(path, "r+b") as f:
        f.seek(60)
        f.write(b"\xff\xff")
    rows = media_archive.read_archives(spark, folder, rangeBytes="2000").collect()
    assert len(rows) == len(corpus()) and sum(r.error is not None for r in rows) == 1


def test_audit(spark):
    pages = spark.createDataFrame([(i, f"u{i}", None if i == 3 else f"<p>{i}</p>") for i in range(50)], "page_id long, url string, html string").repartition(2)
    a, b = scratch(spark, "a"), scratch(spark, "b")
    index = written(warc_fixity.write_warc(pages, a), "index")
    warc_fixity.copy_replica(index, a, b, lambda k: k in (4, 30)).collect()
    assert {r.key for r in warc_fixity.audit(index, a, b, fanout=4).where("status <> 'ok'").collect()} == {4, 30}
    assert warc_fixity.audit(index.where("false"), a, b).count() == 0


def test_bytes_after_the_last_record(spark):
    rows = [(None, "u\r\nX: y", "<p>1</p>"), (None, "u\r\nX: y", "<p>1</p>"), (2, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("shard", F.lit("own")).repartition(2)
    a, b = scratch(spark, "a"), scratch(spark, "b")
    index = written(warc_fixity.write_warc(pages, a), "index")
    warc_fixity.copy_replica(index, a, b).collect()
    assert {(r.key, r.status) for r in warc_fixity.audit(index, a, b).collect()} == {(None, "ok"), (2, "ok")}
    heads = [gzip.decompress(open(f"{a}/{r.shard:06d}.warc.gz", "rb").read()[r.offset : r.offset + r.length]) for r in index.collect()]
    assert len({h.split(b"\r\n")[2] for h in heads}) == 3 and not any(b"\r\nX: y" in h for h in heads)
    shard = index.first().shard
    for folder in (a, b):
        with open(f"{folder}/{shard:06d}.warc.gz", "ab") as f:
            f.write(b"junk!")
    got = [r for r in warc_fixity.audit(index, a, b).collect() if r.status != "ok"]
    assert [(r.shard, r.key, r.n_bytes) for r in got] == [(shard, None, 5)]


def test_audit_of_what_neither_replica_gives(spark):
    import os

    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>") for i in range(40)], "page_id long, url string, html string").repartition(2)
    a, b = scratch(spark, "a"), scratch(spark, "b")
    index = written(warc_fixity.write_warc(pages, a), "index")
    warc_fixity.copy_replica(index, a, b, lambda k: k == 4).collect()
    rows = index.collect()
    shard = next(r.shard for r in rows if r.key == 4)
    cut = min((r for r in rows if r.shard != shard and r.seq == 9), key=lambda r: r.shard)
    for folder in (a, b):
        os.truncate(f"{folder}/{cut.shard:06d}.warc.gz", cut.offset)
    wrong = next(r for r in rows if r.shard == shard and r.key != 4)
    from pyspark.sql import functions as F

    said = index.withColumn("payload_sha256", F.when(F.col("key") == wrong.key, "0").otherwise(F.col("payload_sha256")))
    got = {r.key: r for r in warc_fixity.audit(said, a, b, fanout=4).collect()}
    lost = {r.key for r in rows if r.shard == cut.shard and r.seq >= 9}
    assert len(got) == 40 and lost and {k for k, r in got.items() if r.status != "ok"} == {4, wrong.key} | lost
    assert all((got[r.key].n_bytes, got[r.key].payload_sha256) == ((None, None) if r.key in lost else (r.n_bytes, r.payload_sha256)) for r in rows)
    for folder in (a, b):
        os.remove(f"{folder}/{cut.shard:06d}.warc.gz")
    assert {r.key for r in warc_fixity.audit(index, a, b).where("status <> 'ok'").collect()} == {4} | {r.key for r in rows if r.shard == cut.shard}


def test_main_text():
    page = "<html><head><title>t</title></head><body><nav><a>x</a></nav><div class='ad'>Buy now, please.</div><article><h1>H &amp; I</h1><p>One,\n two.<p>Three<br>four<script>no</script></article><div id=comments><p>me too, really.</p></div><footer>f</footer></body>"
    assert html_paths.main_text(page) == "H & I\n\nOne, two.\n\nThree four"
    assert html_paths.main_text(None) == html_paths.main_text("") == ""
    bare = "<body><ul><li>a<li>b</ul><div><p>" + "A long sentence, with marks. " * 5 + "</p><p>" + "Another one, here. " * 5 + "</p></div>"
    assert html_paths.main_text(bare).startswith("A long sentence") and "a\n" not in html_paths.main_text(bare)


def test_columns_of_any_name_stay(spark):
    names = ["shards", "_name", "_block", "_size", "_key", "_words", "_n", "_gone", "_kept", "_removed", "_copy", "doc", "spans", "n_email", "masked", "odd name.x"]
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text + f" x{i}", "s", *[f"{n}{i}" for n in names]) for i in range(3)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    want = sorted(r[3:] for r in rows)
    for out in (line_quality.filtered(docs), mixing.draws(docs)):
        quoted = [f"`{n}`" for n in names]
        assert sorted(tuple(r) for r in out.select(*quoted).distinct().collect()) == want
    assert line_quality.filtered(docs).columns == docs.columns


def test_pages(spark):
    rows = [(1, "u", "<p>x, y.</p>"), (1, "u", "<p>x, y.</p>"), (None, None, None)]
    got = html_paths.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted((r.page_id is None, r.text, r.n_chars) for r in got.collect()) == [(False, "x, y.", 5), (False, "x, y.", 5), (True, "", 0)]
    assert html_paths.extract(got.where("false").withColumnRenamed("text", "html")).count() == 0


STORY = ["A long sentence, with marks. " * n for n in (9, 6, 11)]
TALE = "\n\n".join(p.strip() for p in STORY)


def test_main_text_of_a_page_without_marks():
    links = "".join(f"<li><a href=/{i}>Link number {i}</a>" for i in range(9))
    page = f"<body><div><a href=/>Home</a> <a href=/a>About</a></div><div><div><h1>Head</h1>{''.join(f'<p>{p}</p>' for p in STORY)}<ul><li>One point.<li>Another</ul></div></div><div><ul>{links}</ul></div><div>All rights reserved.</div></body>"
    assert html_paths.main_text(page) == f"Head\n\n{TALE}\n\nOne point.\n\nAnother"


def test_story_beside_teaser_articles():
    cards = "".join(f"<article class=card><h2>Teaser {i}</h2><p>Read this too, now.</p></article>" for i in range(6))
    story = "".join(f"<div>{p}</div>" for p in STORY)
    assert html_paths.main_text(f"<body><div class=text>{story}</div><div>{cards}</div></body>") == TALE
    assert html_paths.main_text(f"<body><main><div class=text>{story}</div><div>{cards}</div></main></body>") == TALE


@pytest.mark.parametrize("mark", ["main", "article"])
def test_unclassed_boilerplate_in_the_article(mark):
    links = "".join(f"<li><a href=/{i}>A link, number {i}</a>" for i in range(12))
    page = f"<body><{mark}><h1>Head</h1><div>Share this: <a>Mail</a> <a>Print</a> <a>Message</a></div><p>{STORY[0]}<h2>Part</h2><p>{STORY[1]}<ul><li>A point</ul><div>Buy now, please.</div><p>{STORY[2]}<h2>More</h2><ul>{links}</ul></{mark}></body>"
    a, b, c = TALE.split("\n\n")
    assert html_paths.main_text(page) == "\n\n".join(["Head", a, "Part", b, "A point", c])


def test_articles_of_one_kind_share_a_page():
    page = "<body><main>" + "".join(f"<article class=post><h2>Post</h2><p>{p}</p></article>" for p in STORY) + "</main></body>"
    assert html_paths.main_text(page) == "\n\n".join(f"Post\n\n{p}" for p in TALE.split("\n\n"))


@pytest.mark.parametrize(
    "around",
    ["style='overflow:hidden'", "aria-hidden=false", "title='The hidden valley'", "data-id=ad", "data-class='x' title='a class=ad b'", "class=no-sidebar", "class='page has-sidebar'", "id=content-with-menu", "class='sidebar left'", "class=promo"],
)
def test_what_does_not_put_an_article_out(around):
    page = f"<body><div {around}><article><h1>Head</h1>{''.join(f'<p>{p}' for p in STORY)}</article></div><div class=sidebar><p>Read this too, now.</div></body>"
    assert html_paths.main_text(page) == f"Head\n\n{TALE}"


@pytest.mark.parametrize("around", ["hidden", "HIDDEN=''", "class='x sidebar'", "id=comments", "class=no-border-ad", "data-id=x id='ad'"])
def test_what_puts_a_part_out(around):
    page = f"<body><article>{''.join(f'<p>{p}' for p in STORY)}<div {around}><p>{STORY[1]}</div></article></body>"
    assert html_paths.main_text(page) == TALE


def test_damaged_markup_loses_no_text():
    assert html_paths.main_text(f"<head><title>Never closed<body><article><h1>Head</h1><p>{STORY[0]}</article>") == f"Head\n\n{STORY[0].strip()}"
    assert html_paths.main_text(f"<article><p title=it's>{STORY[0]}</p><p>we don't stop, we go on.</p><p>{STORY[1]}</p></article>") == f"{STORY[0].strip()}\n\nwe don't stop, we go on.\n\n{STORY[1].strip()}"
    assert html_paths.main_text(f"<article><svg><p>{STORY[0]}</article>") == STORY[0].strip()
    assert html_paths.main_text(f"<article><p a=\"x>y\" b='>' c=\">{STORY[0]}</article>") == STORY[0].strip()


def test_form_round_the_page_and_form_in_it():
    page = f"<body><form action=/x><article>{''.join(f'<p>{p}' for p in STORY)}</article></form><form><p>Your name, please: <input></form></body>"
    assert html_paths.main_text(page) == TALE


def test_an_anchor_that_is_never_closed():
    assert html_paths.main_text('<article><a name="x"><h1>T</h1><p>Some words, here.</p></article>') == "T\n\nSome words, here."
    assert html_paths.main_text(f'<article><h1><a href="/x">T</h1><p>{STORY[0]}</p><p><a href=/y>one<a href=/z>two</a> {STORY[1]}</p></article>') == f"T\n\n{STORY[0].strip()}\n\nonetwo {STORY[1].strip()}"
    assert html_paths.main_text(f"<article><p>Read <a href=/a>this</a> first. {STORY[0]}</p></article>") == f"Read this first. {STORY[0].strip()}"


def test_comments_under_a_heading_without_a_class():
    story = "".join(f"<p>{p}</p>" for p in STORY) + f"<p>{STORY[0]}</p><p>{STORY[1]}</p>"
    talk = f"<h2>3 Comments</h2><p>{'I do not agree, at all, with any of it. ' * 60}</p>"
    want = f"{TALE}\n\n{STORY[0].strip()}\n\n{STORY[1].strip()}"
    assert html_paths.main_text(f"<body><article>{story}</article><section>{talk}</section></body>") == want
    assert html_paths.main_text(f"<body><article>{story}<section>{talk}</section></article></body>") == want
    assert html_paths.main_text(f"<body><article>{story}{talk}<h2>After</h2><p>{STORY[2]}</p></article></body>") == f"{want}\n\nAfter\n\n{STORY[2].strip()}"
    assert html_paths.main_text(f"<body><div>{story}</div><section>{talk}</section></body>") == want


def test_a_small_article_beside_a_long_notice():
    notice = "This site needs your consent, for a number of reasons, before it goes on. " * 20
    assert html_paths.main_text(f"<body><div>{notice}</div><article><h1>T</h1><p>Tiny.</p></article><div>{notice}</div></body>") == "T\n\nTiny."
    assert html_paths.main_text(f"<body><div><p>{STORY[0]}</p><p>{STORY[1]}</p></div><article><h2><a href=/n>Next one</a></h2><p>Read on.</p></article></body>") == f"{STORY[0].strip()}\n\n{STORY[1].strip()}"


@pytest.mark.parametrize("name", ["div", "article", "section class=sidebar", "b", "li", "main", "form"])
def test_deep_nesting_takes_little(name):
    import time
    import tracemalloc

    n, tag = 20_000, name.split()[0]
    page = f"<{name}>x. " * n + f"<p>{STORY[0]}" + f"</{tag}>" * n
    began = time.process_time()
    html_paths.main_text(f"<body>{page}</body>")
    assert time.process_time() - began < 4
    tracemalloc.start()
    html_paths.main_text(page[: len(page) // 4])
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_comments_longer_than_the_article():
    page = f"<body><div class=sidebar-page><article><p>{STORY[0]}</article></div><div class=comments>{''.join(f'<p>{p}' for p in STORY * 2)}</div></body>"
    assert html_paths.main_text(page) == STORY[0].strip()


def test_quality_equals_its_sql_where_lines_go(spark, tmp_path):
    import duckdb

    own = lambda i: " ".join(f"w{i}x{k}" for k in range(60)).translate(str.maketrans("0123456789", "abcdefghij"))
    rows = [(i, ("Shared  Line 1 of all\n" if i < 30 else "") + ("one line of few\n" if i < 20 else "") + own(i), "h") for i in range(50)]
    rows += [(100 + i, ("seen in two of a hundred\n" if i < 21 else "") + own(i), "big") for i in range(1100)] + [(2000 + i, "in every text\n" + own(i), "small") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "d"))
    got = line_quality.quality(spark.read.parquet(str(tmp_path / "d")))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    want = c.execute(line_quality.ORACLE)
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    assert {r.doc_id for r in got.where("n_removed_words > 0").collect()} == set(range(1, 30))
