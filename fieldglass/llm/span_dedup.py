"""Substring dedup: a de Bruijn graph of word windows, compacted in minimizer buckets.

Every ``k`` consecutive words of one document are an edge between the ``k - 1``
words it begins and ends with.  Equal edges of several documents are one edge of the
graph; its source is the least document that has it.  A document walks along
edges, and a stretch of its walk on which the source and the place in it go on
without a branch is a path.

1. Edges are dealt out by their minimizer, the least hash among the
   ``anchor``-word grams inside them: a function of the edge's words alone, so
   equal edges meet in one bucket, and neighbouring edges mostly share a bucket.
   In a bucket, edges that more than one document carries are found by sorting,
   and neighbours on one path are compacted.
2. Paths that were cut where the bucket changes are glued by Spark: pieces of one
   document and source that go on in both become one path.
3. Each distinct span of a source is read at its source coordinates by a join with
   the texts and digested (BLAKE2b, 128 bits of the words themselves).  A path
   whose own words have another digest is not a repeat and is dropped.
4. The paths left mark the words to remove from their document.

In step 1 equal edges are told by 112 bits: the 64-bit hash of the minimizer and 48
bits of a hash of all k words; step 3 does not rest on these.

Volume: one row of some binary columns per chunk of texts and bucket leaves the
scan, about 8 bytes an edge.  Of an edge found often in a chunk, only the
smallest document goes on and the others are settled at once, so a passage in a
third of all documents reaches its bucket once per chunk and not once per
document.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Workspace, maybe_in, partitions, ship
from .grams import U, Words, mix, slices, strings

_INDEX = "bucket int, size long, anchor binary, doc binary, at binary, count binary, back binary, tail binary"
_PATHS = "doc_id long, start int, n int, source_id long, source_start int"


def edges(words: Words, k: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, hash, start of the minimizer) of every k-word window inside one text."""
    at = np.flatnonzero(words.whole(k))
    if not len(at):
        return at, np.zeros(0, U), at
    small = words.grams(anchor, 101)
    span = k - anchor + 1
    n = len(small) - span + 1
    least = small[:n].copy()
    where = np.zeros(n, np.int16)
    for i in range(1, span):
        new = small[i : n + i]
        less = new < least
        where[less] = i
        np.minimum(least, new, out=least)
    return at, words.grams(k, 202)[at], at + where[at]


def _index(batches, k: int, anchor: int, buckets: int, chunk_bytes: int):
    """By chunk of texts and bucket, a row of edges; buckets from ``buckets`` on carry settled paths."""
    turn = 0
    for batch in batches:
        for i, j in slices(batch.column("text"), chunk_bytes):
            part = batch.slice(i, j - i)
            ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            words = Words(*strings(part.column("text")))
            at, key, low = edges(words, k, anchor)
            if not len(at):
                continue
            text = words.text_of()[at]
            doc, place = ids[text], at - words.first[text]
            head = words.grams(anchor, 101)[low]
            order = np.lexsort((place, doc, key))
            new = np.ones(len(order), bool)
            new[1:] = (key[order][1:] != key[order][:-1]) | (head[order][1:] != head[order][:-1])
            lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]  # of each edge: its smallest document here
            late = doc[order] > doc[lead]
            own = np.sort(order[new])
            if late.any():
                turn += 1
                o, s = order[late], lead[late]
                yield _settled(buckets + (int(doc[o[0]]) + turn) % buckets, _compact(doc[o], place[o], doc[s], place[s]))
            bucket = (head[own] % U(buckets)).astype(np.int32)
            own = own[np.argsort(bucket, kind="stable")]
            bucket = np.sort(bucket)
            cut = np.flatnonzero(np.diff(bucket)) + 1
            for b in np.split(own, cut):
                yield _packed(int(head[b[0]] % U(buckets)), head[b], doc[b], low[b] - words.first[text[b]], low[b] - at[b], key[b])


def _packed(bucket, head, doc, low, back, key):
    """Edges in the order of their document and place; consecutive ones with one minimizer share its hash and place."""
    first = np.ones(len(head), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (low[1:] != low[:-1])
    f = np.flatnonzero(first)
    count = np.diff(np.append(f, len(head))).astype(np.uint16)
    small = lambda x: zlib.compress(x.tobytes(), 1)
    step = lambda x: np.diff(x.astype(np.int64), prepend=0)
    tail = np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
    return bucket, len(f), head[f].astype("<u8").tobytes(), small(step(doc[f])), small(step(low[f])), small(count), small(back.astype(np.uint8)), tail.tobytes()


def _settled(bucket, runs):
    doc, start, n, source, source_start = runs
    return bucket, len(doc), b"", doc.astype("<i8").tobytes(), start.astype("<i4").tobytes(), n.astype("<i4").tobytes(), source.astype("<i8").tobytes(), source_start.astype("<i4").tobytes()


def _compact(doc, place, source, source_place):
    """Neighbouring edges that repeat neighbouring edges of one source become one path."""
    order = np.lexsort((place, doc))
    doc, place, source, source_place = doc[order], place[order], source[order], source_place[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1) | (source[1:] != source[:-1]) | (source_place[1:] != source_place[:-1] + 1)
    f = np.flatnonzero(new)
    return doc[f], place[f], np.diff(np.append(f, len(doc))), source[f], source_place[f]


def _paths(rows: pa.Table, buckets: int):
    """The paths of one bucket."""
    none = (np.zeros(0, np.int64),) * 5
    if not rows.num_rows:
        return none
    get = lambda name: [x or b"" for x in rows.column(name).to_pylist()]
    if rows.column("bucket")[0].as_py() >= buckets:
        kinds = {"doc": "<i8", "at": "<i4", "count": "<i4", "back": "<i8", "tail": "<i4"}
        return tuple(np.concatenate([np.frombuffer(x, kind) for x in get(name)]).astype(np.int64) for name, kind in kinds.items())
    back_to = lambda name, kind: [np.frombuffer(zlib.decompress(x), kind) for x in get(name)]
    count = np.concatenate(back_to("count", np.uint16)).astype(np.int64)
    head = np.repeat(np.concatenate([np.frombuffer(x, "<u8") for x in get("anchor")]), count)
    doc = np.repeat(np.concatenate([np.cumsum(x) for x in back_to("doc", np.int64)]), count)
    place = np.repeat(np.concatenate([np.cumsum(x) for x in back_to("at", np.int64)]), count) - np.concatenate(back_to("back", np.uint8))
    raw = np.zeros((len(head), 8), np.uint8)
    raw[:, :6] = np.frombuffer(b"".join(get("tail")), np.uint8).reshape(-1, 6)
    tail = raw.view("<u8").ravel()
    with np.errstate(over="ignore"):
        key = mix(head + tail * U(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return none
    if ((head[order][1:] != head[order][:-1]) | (tail[order][1:] != tail[order][:-1]))[same].any():
        order = np.lexsort((tail, head))
    h, t = head[order], tail[order]
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc[order], np.flatnonzero(new))[group]
    is_lead = doc[order] == least
    lead = np.zeros(len(new), np.int64)
    lead[group[is_lead][::-1]] = order[is_lead][::-1]
    late = ~is_lead
    o, s = order[late], lead[group[late]]
    return _compact(doc[o], place[o], doc[s], place[s])


def repeated_paths(docs: DataFrame, k: int = 13, anchor: int = 5, chunk_bytes: int = 3 << 20) -> DataFrame:
    """Paths compacted by bucket: words start..start+n+k-2 of doc_id repeat those of source_id from source_start.

    ``source_id`` is a smaller doc_id that has the same words.  Of an edge that a
    document holds several times one place at least is given.  Rows without
    doc_id are not indexed.
    """
    if not 0 < anchor <= k:
        raise ValueError("anchor must be from 1 to k")
    spark = docs.sparkSession
    ship(spark)
    buckets = 4 * partitions(spark)

    def index(batches):
        names = [x.split()[0] for x in _INDEX.split(", ")]
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
        held, size = [], 0
        for row in _index(batches, k, anchor, buckets, chunk_bytes):
            held.append(row)
            size += sum(len(x) for x in row[2:])
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)

    def paths(rows: pa.Table) -> pa.Table:
        doc, start, n, source, source_start = _paths(rows, buckets)
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "start": pa.array(start.astype(np.int32)), "n": pa.array(n.astype(np.int32)), "source_id": pa.array(source, pa.int64()), "source_start": pa.array(source_start.astype(np.int32))})

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = source.where("doc_id is not null and text is not null").mapInArrow(index, _INDEX)
    return packed.groupBy("bucket").applyInArrow(paths, _PATHS)


def glued(paths: DataFrame) -> DataFrame:
    """Paths whose pieces come from several buckets, as one row each.

    One shuffle by doc_id serves the windows and the sums; a document has at most
    as many pieces as words.
    """
    along = W.partitionBy("doc_id", "source_id", "shift").orderBy("start")
    pieces = paths.repartition("doc_id").withColumn("shift", F.col("source_start") - F.col("start"))
    begins = (~F.lag(F.col("start") + F.col("n")).over(along).eqNullSafe(F.col("start"))).cast("int")
    pieces = pieces.withColumn("begins", begins).withColumn("path", F.sum("begins").over(along.rowsBetween(W.unboundedPreceding, 0)))
    whole = pieces.groupBy("doc_id", "source_id", "shift", "path").agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n"), F.min("source_start").alias("source_start"))
    return whole.select("doc_id", "start", "n", "source_id", "source_start")


def _digest(words: list[bytes], start: int, n: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[start : start + n]), digest_size=16).digest()


def source_digests(texts: DataFrame, paths: DataFrame, k: int) -> DataFrame:
    """source_id, source_start, n and the digest of the words there, for every distinct span of a source."""
    asked = paths.groupBy("source_id").agg(F.collect_set(F.struct("source_start", "n")).alias("spans"))

    def read(batches):
        for batch in batches:
            out = []
            for i, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                words = (text or "").encode().split()
                out += [(i, s["source_start"], s["n"], _digest(words, s["source_start"], s["n"] + k - 1)) for s in spans]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], ["source_id", "source_start", "n", "digest"])

    both = maybe_in(texts, paths.select(F.col("source_id").alias("doc_id"))).join(asked, F.col("doc_id") == F.col("source_id")).select("doc_id", "text", "spans")
    return both.mapInArrow(read, "source_id long, source_start int, n int, digest binary")


def _cut(text: str | None, runs, k: int):
    """(words, removed, kept words) of one text."""
    raw = (text or "").encode()
    words = raw.split()
    runs = [r for r in runs or () if _digest(words, r["start"], r["n"] + k - 1) == r["digest"]]
    if not runs:
        return len(words), 0, words
    w = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    n = len(words)
    hit = np.zeros(max(1, n - k + 1), bool)
    for r in runs:
        hit[r["start"] : r["start"] + r["n"]] = True
    key = w.grams(k, 202)
    if len(key):
        hit = np.isin(key, key[hit[: len(key)]])
    gone = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(hit)
    np.add.at(gone, at, 1)
    np.add.at(gone, np.minimum(at + k, n), -1)
    gone = np.cumsum(gone)[:n] > 0
    return n, int(gone.sum()), [x for x, out in zip(words, gone) if not out]


def remove_repeats(docs: DataFrame, k: int = 13, anchor: int = 5) -> DataFrame:
    """Each document without the words of k-word windows that a smaller doc_id has too.

    Returns doc_id, n_words, n_removed, kept (the words left, joined by one
    space) and kept_sha256.  Windows are judged on the input.  A null or empty
    text has no words; a document of fewer than k words keeps all of them; a row
    without doc_id is neither source nor target and keeps all; rows that repeat
    a doc_id (with the same text) get the same result each.  Other columns of
    the input are not looked at.

    The paths are written to the shared folder; the shuffle that built them is
    then freed.  All texts are shuffled once, those of sources once more.
    """
    space = Workspace(docs.sparkSession)
    paths = space.write(glued(repeated_paths(docs, k, anchor)), "paths")
    space.free()
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = own.where("doc_id is not null")
    runs = paths.join(source_digests(texts, paths, k), ["source_id", "source_start", "n"])
    runs = runs.groupBy(F.col("doc_id").alias("_path_doc")).agg(F.collect_list(F.struct("start", "n", "digest")).alias("runs"))
    both = texts.join(runs, F.col("doc_id") == F.col("_path_doc"), "left").select("doc_id", "text", "runs")
    both = both.unionByName(own.where("doc_id is null").withColumn("runs", F.lit(None).cast(both.schema["runs"].dataType)))

    def cut(batches):
        for batch in batches:
            for i, j in slices(batch.column("text"), 4 << 20):
                part = batch.slice(i, j - i)
                out = [_cut(t, r, k) for t, r in zip(part.column("text").to_pylist(), part.column("runs").to_pylist())]
                kept = [b" ".join(x[2]) for x in out]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x.decode() for x in kept], pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
                )

    return both.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def brute_force(rows, k: int = 13) -> pd.DataFrame:
    """The same by definition, for tests: rows of (doc_id, text)."""
    first: dict[tuple, int] = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for a in range(len(w) - k + 1):
                g = tuple(w[a : a + k])
                first[g] = min(i, first.get(g, i))
    out = []
    for i, w in split:
        gone = set()
        for a in range(len(w) - k + 1):
            if i is not None and first[tuple(w[a : a + k])] < i:
                gone.update(range(a, a + k))
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for a, x in enumerate(w) if a not in gone)).hexdigest()))
    return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])
