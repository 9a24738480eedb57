"""Near-duplicate groups: MinHash, banding, verification, connected components.

1. Per document, the set of distinct hashed shingles, many universal hash minima
   over it, the band keys made of the first minima, and one byte of each minimum
   as a signature.  Documents with equal sets become one class, whose least
   doc_id stands for it from then on.
2. Classes that share a band key are candidates.  In a bucket only stars are
   formed: every member with the bucket's least member, so a bucket of n gives
   n - 1 pairs.  Pairs pass a size bound and the signature, and are then
   confirmed on the full sets, recomputed from the whole texts.
3. Connected components of confirmed links by alternating large-star and
   small-star, each step a group minimum and a join, every round a written table.
4. Stars may miss a link between two members of a bucket that both fail against
   the least one.  Buckets that still hold several components form stars around
   members drawn by hash, a few rounds long, which joins what is left of large
   groups of copies.  Buckets that even then hold several components go through
   a last round: their members are compared signature by signature
   inside tasks (large buckets in pairs of blocks of bounded size, one task
   each); pairs that lie in different components and pass the signature are
   confirmed on the full sets, and components are formed once more.

A pair of similarity 0.75 misses all 32 bands of 4 with probability 5e-6; the
signature lets it pass unless its estimate is 4 standard deviations low.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, maybe_in, ship
from .grams import U, Words, _stream, mix, slices, strings

_FEATURES = "doc_id long, n long, set binary, keys array<long>, signature binary"
_MINIMA, _BANDS, _ROWS = 192, 32, 4
_BLOCK = 1024
#: Rounds of stars around drawn members before members are compared one by one.
_TURNS = 2


@lru_cache(1)
def _hashes() -> tuple[np.ndarray, np.ndarray]:
    return _stream(303, _MINIMA) | U(1), _stream(404, _MINIMA)


def shingles(column, size: int) -> list[np.ndarray]:
    """By text, its sorted distinct shingle hashes; a text of fewer words is one shingle, one without words none."""
    words = Words(*strings(column), lower=True)
    grams, whole, first = words.grams(size, 505), words.whole(size), words.first
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                c = _stream(606 + int(b - a), int(b - a)) | U(1)
                out.append(mix(np.array([(words.hash[a:b] * c).sum()], U)))
        else:
            out.append(np.zeros(0, U))
    assert len(whole) == len(grams)
    return out


def minima(items: np.ndarray) -> np.ndarray:
    """The least value of each hash function (a * x + b) mod 2**64 over the items."""
    a, b = _hashes()
    out = np.full(_MINIMA, ~U(0))
    with np.errstate(over="ignore"):
        for i in range(0, len(items), 2048):
            part = items[i : i + 2048]
            np.minimum(out, (a[:, None] * part[None, :] + b[:, None]).min(1), out=out)
    return out


def features(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, n (shingles), set (a digest of them), keys (a band key each), signature (a byte by minimum)."""
    ship(docs.sparkSession)

    def run(batches):
        band = _stream(707, _BANDS)
        c = _stream(808, _ROWS) | U(1)
        for b in batches:
            for i, j in slices(b.column("text"), 2 << 20):
                part = b.slice(i, j - i)
                sets = shingles(part.column("text"), size)
                low = np.array([minima(s) for s in sets], U).reshape(len(sets), _MINIMA)
                with np.errstate(over="ignore"):
                    keys = mix((low[:, : _BANDS * _ROWS].reshape(-1, _BANDS, _ROWS) * c).sum(2, dtype=U) + band).view(np.int64)
                some = [bool(len(s)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([k if x else [] for k, x in zip(keys, some)], pa.list_(pa.int64())),
                        pa.array([(m >> U(32)).astype(np.uint8).tobytes() for m in low], pa.binary()),
                    ],
                    ["doc_id", "n", "set", "keys", "signature"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _FEATURES)


def _estimate_floor(threshold: float) -> float:
    """The least share of equal signature bytes that may still belong to a linked pair."""
    least = threshold - 4 * (threshold * (1 - threshold) / _MINIMA) ** 0.5
    return least * _MINIMA


def _fits(a: str, b: str, percent: int):
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def _passing(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose sizes and signatures allow a link."""
    floor = _estimate_floor(percent / 100)
    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").where(_fits("n_a", "n_b", percent))

    def run(batches):
        for x in batches:
            if x.num_rows:
                s = [np.frombuffer(b"".join(x.column(c).to_pylist()), np.uint8).reshape(-1, _MINIMA) for c in ("s_a", "s_b")]
                yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b")], ["a", "b"]).filter(pa.array((s[0] == s[1]).sum(1) >= floor))

    return both.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int, size: int, space: Workspace) -> DataFrame:
    """Of pairs (a, b) those linked on the full sets of their whole texts; written, and only ``pairs`` is left beside it."""
    ids = space.write(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    some = maybe_in(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), ids)
    texts = space.write(some.join(ids.hint("shuffle_hash"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")), "texts")
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")

    def run(batches):
        last, kept = None, None
        for x in batches:
            for i, j in slices(x.column("t_b"), 2 << 20):
                part = x.slice(i, j - i)
                firsts, seconds, ok = part.column("t_a").to_pylist(), shingles(part.column("t_b"), size), []
                for t, s in zip(firsts, seconds):
                    if t is not last and t != last:
                        last, kept = t, shingles(pa.array([t]), size)[0]
                    both = len(np.intersect1d(kept, s, assume_unique=True))
                    ok.append(100 * both >= percent * (len(kept) + len(s) - both))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    out = space.write(both.select("a", "b", "t_a", "t_b").mapInArrow(run, "a long, b long"), "links")
    space.drop(ids, texts)
    return out


def components(links: DataFrame, space: Workspace | None = None) -> DataFrame:
    """(node, root): for nodes of links (a, b), the least node of their component.

    Large-star joins each larger neighbour of a node to the node's least
    neighbour, small-star each smaller one; both only need a group minimum, so no
    node's neighbours are gathered in one place.  Every round is written to the
    shared folder in place of the one before.  Ends when the links are stars.
    """
    space = space or Workspace(links.sparkSession)
    now = space.write(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _only_stars(now):
        ways = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ways.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        last, now = now, space.write(small, "edges")
        space.drop(last)
    out = space.write(now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), "components")
    space.drop(now)
    return out


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node is either the centre of its edges or the end of just one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("end"), F.lit(0).alias("centre")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("end"), F.lit(1).alias("centre")))
    return ends.groupBy("node").agg(F.sum("end").alias("n"), F.max("centre").alias("c")).where("n + c > 1").isEmpty()


def _joined(parts: DataFrame, pairs: DataFrame, docs: DataFrame, percent: int, size: int, space: Workspace) -> tuple[DataFrame, bool]:
    """(components after the links among ``pairs`` are added to ``parts``, whether there were any)."""
    if pairs.isEmpty():
        return parts, False
    links = _confirmed(pairs, docs, percent, size, space)
    if links.isEmpty():
        space.drop(links)
        return parts, False
    out = components(links.unionByName(parts.select(F.col("node").alias("a"), F.col("root").alias("b"))), space)
    space.drop(links, parts)
    return out, True


def _split(members: DataFrame, parts: DataFrame, space: Workspace) -> DataFrame:
    """(key, rep, root): the members of buckets that hold several components; written.

    The join with the components is evaluated once, into a table that goes again.
    Components only grow together, so a bucket that lies in one never comes back.
    """
    at = space.write(members.select("key", "rep").join(parts.select(F.col("node").alias("rep"), "root"), "rep", "left").select("key", "rep", F.coalesce("root", "rep").alias("root")), "rooted")
    keys = at.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    out = space.write(at.join(keys, "key", "left_semi"), "split")
    space.drop(at)
    return out


def _more_stars(split: DataFrame, turn: int) -> DataFrame:
    """In each bucket that holds several components: its members with one of them drawn by hash, across components."""
    hubs = split.groupBy("key").agg(F.min_by(F.struct("rep", "root"), F.xxhash64("key", "rep", F.lit(turn))).alias("h"))
    out = split.join(hubs.select("key", F.col("h.rep").alias("hub"), F.col("h.root").alias("hub_root")), "key").where("root <> hub_root")
    return out.select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()


def _short_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(rep, short): the low 32 bits of each shingle hash of the documents named."""
    some = maybe_in(docs, ids.select(F.col("rep").alias("doc_id"))).join(ids.select(F.col("rep").alias("doc_id")).hint("shuffle_hash"), "doc_id", "left_semi")

    def run(batches):
        for b in batches:
            for i, j in slices(b.column("text"), 2 << 20):
                part = b.slice(i, j - i)
                sets = [np.unique((x & U(0xFFFFFFFF)).astype("<u4")).tobytes() for x in shingles(part.column("text"), size)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], ["rep", "short"])

    return some.select("doc_id", "text").mapInArrow(run, "rep long, short binary").groupBy("rep").agg(F.first("short").alias("short"))


def _crossing(split: DataFrame, reps: DataFrame, docs: DataFrame, percent: int, size: int, space: Workspace) -> DataFrame:
    """Pairs of members of one of the ``split`` buckets that lie in different components and may be linked; written.

    Sizes, signatures and then the low bits of all shingle hashes are compared in
    the task, which lets through every link and next to nothing else; only such
    pairs become rows.
    """
    floor = _estimate_floor(percent / 100)
    blocks = split.groupBy("key").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    unresolved = space.write(split.join(blocks, "key").withColumn("block", own), "unresolved")
    ids = space.write(unresolved.select("rep").distinct(), "ids")
    short = _short_sets(docs, ids, size)
    rows = unresolved.join(reps.select("rep", "n", "signature"), "rep").join(short, "rep")
    rows = rows.select("key", "rep", "root", "n", "signature", "short", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).select("key", "i", "j", "block", "rep", "root", "n", "signature", "short")

    def compare(t: pa.Table) -> pa.Table:
        rep, root, n, block = (t.column(c).to_numpy() for c in ("rep", "root", "n", "block"))
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        s = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint8).reshape(-1, _MINIMA)
        short = [np.frombuffer(x, "<u4") for x in t.column("short").to_pylist()]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        a, b = [], []
        for x in left:
            to = right[(root[right] != root[x]) & (100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x]))]
            if i == j:
                to = to[rep[to] > rep[x]]
            if len(to):
                to = to[(s[to] == s[x]).sum(1) >= floor]
                both = np.array([len(np.intersect1d(short[x], short[y], assume_unique=True)) for y in to], np.int64)
                both += n[x] - len(short[x])  # what the low bits cannot tell apart counts as common
                to = to[100 * both >= percent * (n[to] + n[x] - both)]
                a.append(np.minimum(rep[to], rep[x]))
                b.append(np.maximum(rep[to], rep[x]))
        none = np.zeros(0, np.int64)
        return pa.table({"a": pa.array(np.concatenate([none, *a])), "b": pa.array(np.concatenate([none, *b]))})

    out = space.write(rows.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long").distinct(), "crossing")
    space.drop(unresolved, ids)
    return out


def near_duplicates(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row per row of ``docs``.

    Words are lower-cased in A-Z; a document's set is its distinct ``size``-word
    shingles, the whole sequence where it has fewer words, and empty without
    words or with a null text, which links it with nothing: component_id is then
    its own doc_id.  Links need 100 * intersection >= percent * union.  A row
    without doc_id takes no part and has a null component_id and kept = true.
    Rows that repeat a doc_id (with the same text) get the same result each.
    Other columns are not looked at; an empty table gives an empty result.
    """
    space = Workspace(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    whole = space.write(features(own, size), "features")
    known = whole.where("doc_id is not null and n > 0")
    classes = space.write(known.groupBy("set").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("signature").alias("signature")), "classes")
    feats = space.write(whole.select("doc_id", "n", "set"), "sets")
    space.drop(whole)
    dealt = classes.select("rep", F.explode("keys").alias("key"))
    hubs = dealt.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).where("hub <> top").select("key", "hub")
    members = space.write(dealt.join(hubs, "key").select("key", "hub", "rep"), "buckets")
    reps = space.write(classes.drop("keys"), "reps")
    space.drop(classes)
    stars = members.where("hub <> rep").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    tried = [space.write(_passing(stars, reps, percent), "stars")]
    links = _confirmed(tried[0], own, percent, size, space)
    parts = components(links, space)
    space.drop(links)
    split = _split(members, parts, space)
    space.drop(members)
    for turn in range(_TURNS):
        before = tried[0]
        for x in tried[1:]:
            before = before.unionByName(x)
        new = space.write(_passing(_more_stars(split, turn).join(before, ["a", "b"], "left_anti"), reps, percent), "stars")
        tried.append(new)
        parts, grown = _joined(parts, new, own, percent, size, space)
        if not grown:
            break
        last, split = split, _split(split, parts, space)
        space.drop(last)
    left = pairs = _crossing(split, reps, own, percent, size, space)
    for x in tried:
        left = left.join(x, ["a", "b"], "left_anti")
    crossing = space.write(left, "crossing")
    parts, _ = _joined(parts, crossing, own, percent, size, space)
    space.drop(split, pairs, crossing, *tried)
    roots = reps.select("set", "rep").join(parts.select(F.col("node").alias("rep"), "root"), "rep", "left").select(F.col("set").alias("_set"), F.coalesce("root", "rep").alias("_root"))
    out = feats.join(roots, F.when(F.col("n") > 0, F.col("set")) == F.col("_set"), "left")
    part = F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), part.alias("component_id"), F.coalesce(part == F.col("doc_id"), F.lit(True)).alias("kept"))


def brute_force(rows, percent: int = 75, size: int = 5) -> dict:
    """{doc_id: (n_shingles, component_id)} by definition, for tests."""
    sets = {}
    for i, t in rows:
        w = bytes((t or ""), "utf-8").lower().split() if t else []
        sets[i] = {tuple(w[a : a + size]) for a in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by: dict = {}
    for i, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(i)
    for i in sets:
        near: dict = {}
        for g in sets[i]:
            for j in by[g]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, both in near.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}
