"""A vector index by lists and residual codes, for many questions at once.

Vectors are scaled to length one and belong to the list of their nearest coarse
centroid.  What is left (the residual) is coded by product quantisation: ``parts``
stretches of components, each by the number of its nearest codeword, one byte.  A
question looks into its nearest lists, estimates inner products from tables of its
own products with all codewords, and the best of these are ranked again by their
exact cosine.  Centroids and codewords are fitted on a bounded sample; every row is
in a list.  Exact search (``retrieval.cosine_topk``) stays the default; an index
trades a little recall, which ``recall`` measures.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import ship
from .retrieval import cosine, cosine_topk

_BLOCK = 8192


def centres(x: np.ndarray, k: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """k-means from k different rows (fewer if there are no more), the same each time."""
    start = np.unique(x, axis=0)
    c = start[np.random.default_rng(seed).permutation(len(start))[:k]].copy()
    for _ in range(rounds):
        to = nearest(x, c)
        n = np.bincount(to, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, to, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = 0.5 * (c**2).sum(1)
    return np.concatenate([(x[i : i + 4096] @ c.T - half).argmax(1) for i in range(0, max(1, len(x)), 4096)])


def units(column, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of length one, which rows have one): none for null, other dimensions, holes or no length."""
    rows = column.to_pylist()
    good = np.array([r is not None and len(r) == dim and None not in r for r in rows], bool)
    x = np.zeros((len(rows), dim))
    if good.any():
        x[good] = np.array([r for r, g in zip(rows, good) if g], float)
    size = np.sqrt((x * x).sum(1))
    good &= np.isfinite(size) & (size > 0)
    x[~good] = 0
    return x / np.where(good, size, 1)[:, None], good


class Codebook:
    """Coarse centroids, and codewords of residuals by stretch of components."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int):
        self.coarse = centres(sample, lists)
        self.probes: int | None = None  # see ``calibrate``
        residual = sample - self.coarse[nearest(sample, self.coarse)]
        self.cuts = [int(i) for i in np.linspace(0, sample.shape[1], parts + 1)]
        self.words = [centres(residual[:, a:b], 256, seed=2 + a) for a, b in zip(self.cuts, self.cuts[1:])]

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(list, codes) by row."""
        to = nearest(x, self.coarse)
        residual = x - self.coarse[to]
        return to, np.stack([nearest(residual[:, a:b], w) for a, b, w in zip(self.cuts, self.cuts[1:], self.words)], 1).astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """A question's products with all codewords, by part."""
        out = np.zeros((len(self.words), 256))
        for i, (a, b, w) in enumerate(zip(self.cuts, self.cuts[1:], self.words)):
            out[i, : len(w)] = w @ q[a:b]
        return out


def fit(items: DataFrame, vector: str, lists: int | None = None, parts: int = 16, sample: int = 20_000) -> Codebook | None:
    """A codebook from at most ``sample`` vectors, drawn by hash; None if no row has a vector.

    Without ``lists`` there are as many as the square root of the rows, 1,024 at most.
    """
    own = items.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).select(F.transform(F.col(vector), lambda v: v.cast("double")).alias("v"))
    total = own.count()
    if not total:
        return None
    share = 0.9 * sample / total
    some = own if total <= sample else own.where(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    column = some.toArrow().column("v")
    sizes = [len(x) for x in column.to_pylist()]
    dim = max(set(sizes), key=sizes.count)
    x, good = units(column, dim)
    if not good.any():
        return None
    return Codebook(x[good], min(1024, lists or max(1, round(total**0.5))), min(parts, dim))


def build(items: DataFrame, key: str, vector: str, book: Codebook) -> dict[str, tuple[DataFrame, list[str]]]:
    """Tables for ``stored.built_once``: ``codes`` (list, key, code) and ``vectors`` (key, v)."""
    spark = items.sparkSession
    ship(spark)
    sent, kind = spark.sparkContext.broadcast(book), items.schema[key].dataType.simpleString()
    own = items.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.transform(F.col(vector), lambda v: v.cast("double")).alias("v"))

    def run(batches):
        b = sent.value
        for x in batches:
            unit, good = units(x.column("v"), b.coarse.shape[1])
            x, unit = x.filter(pa.array(good)), unit[good]
            to, codes = b.code(unit) if len(unit) else (np.zeros(0, int), np.zeros((0, 1), np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), x.column("key"), pa.array([c.tobytes() for c in codes], pa.binary())], ["list", "key", "code"])

    codes = own.mapInArrow(run, f"list int, key {kind}, code binary")
    return {"codes": (codes.repartition("list", F.pmod(F.xxhash64("key"), F.lit(4))).sortWithinPartitions("list"), []), "vectors": (own, [])}


def search(index: dict[str, DataFrame], book: Codebook, asked: DataFrame, query_key: str, query_vector: str, k: int = 5, probes: int | None = None, again: int = 10, digits: int = 6) -> DataFrame:
    """(query_id, item_id, score, rank): the k best found by cosine for each question.

    A question looks into ``probes`` lists (what calibration says, else a quarter of them) and ranks
    the ``again`` * k best estimates exactly.  A list is searched in blocks of rows and
    of questions, so a crowded one is not one task.  Ties go to the smaller item.
    """
    spark = asked.sparkSession
    ship(spark)
    lists = len(book.coarse)
    probes = min(lists, probes or book.probes or max(1, -(-lists // 4)))
    sent, most = spark.sparkContext.broadcast(book), again * k
    own = asked.where(F.col(query_vector).isNotNull()).select(F.col(query_key).alias("q"), F.transform(F.col(query_vector), lambda v: v.cast("double")).alias("v"))
    q_kind, i_kind = own.schema["q"].dataType.simpleString(), index["codes"].schema["key"].dataType.simpleString()

    def route(batches):
        b = sent.value
        for x in batches:
            unit, good = units(x.column("v"), b.coarse.shape[1])
            rows = np.repeat(np.flatnonzero(good), probes)
            to = np.argsort(-(unit[good] @ b.coarse.T), axis=1, kind="stable")[:, :probes].ravel()
            yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), x.column("q").take(pa.array(rows)), pa.array([unit[i].tobytes() for i in rows], pa.binary())], ["list", "q", "unit"])

    asks = own.mapInArrow(route, f"list int, q {q_kind}, unit binary")
    sizes = index["codes"].groupBy("list").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("rows"))
    counts = asks.groupBy("list").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("asks"))
    cut = F.broadcast(sizes.join(counts, "list"))  # a line a list, 1,024 at most
    at = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index["codes"].join(cut, "list").select("list", at("key", "rows").alias("i"), every("asks").alias("j"), "key", "code")
    right = asks.join(cut, "list").select("list", every("rows").alias("i"), at("q", "asks").alias("j"), "q", "unit")

    def estimate(rows: pa.Table, ask: pa.Table) -> pa.Table:
        b, out_q, out_i, out_s = sent.value, [], [], []
        if rows.num_rows and ask.num_rows:
            codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(rows.num_rows, -1)
            keys = rows.column("key").to_numpy()
            base, part = b.coarse[rows.column("list")[0].as_py()], np.arange(codes.shape[1])
            for n, unit in enumerate(ask.column("unit").to_pylist()):
                q = np.frombuffer(unit)
                s = b.tables(q)[part, codes].sum(1) + base @ q
                best = np.lexsort((keys, -s))[:most]
                out_q.append(np.full(len(best), n))
                out_i.append(best)
                out_s.append(s[best])
        flat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        return pa.table({"query_id": ask.column("q").take(pa.array(flat(out_q, int))), "item_id": rows.column("key").take(pa.array(flat(out_i, int))), "estimate": pa.array(flat(out_s, float))})

    by = ("list", "i", "j")
    guessed = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(estimate, f"query_id {q_kind}, item_id {i_kind}, estimate double")
    some = guessed.withColumn("_rn", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("estimate"), "item_id"))).where(F.col("_rn") <= most)
    exact = some.select("query_id", "item_id").join(index["vectors"].select(F.col("key").alias("item_id"), "v"), "item_id").join(own.select(F.col("q").alias("query_id"), F.col("v").alias("w")), "query_id")
    scored = exact.select("query_id", "item_id", F.round(cosine(F.col("v"), F.col("w")), digits).alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "item_id"))
    return scored.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def calibrate(index: dict[str, DataFrame], book: Codebook, items: DataFrame, key: str, vector: str, target: float = 0.95, k: int = 5, sample: int = 200) -> int:
    """Sets and returns the number of lists that hold the share ``target`` of the exact neighbours of ``sample`` items, drawn by hash."""
    some = items.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).orderBy(F.xxhash64(key), key).limit(sample).select(F.col(key).alias("asked"), F.col(vector).alias("w"))
    near = cosine_topk(items, some, key, vector, "asked", "w", k + 1).where("query_id <> item_id")
    lists = near.join(index["codes"].select(F.col("key").alias("item_id"), "list"), "item_id").select("query_id", "list").toArrow()  # k lines a sampled item
    q = some.select("asked", F.transform("w", lambda v: v.cast("double")).alias("w")).toArrow()
    unit, _ = units(q.column("w"), book.coarse.shape[1])
    order = np.argsort(np.argsort(-(unit @ book.coarse.T), axis=1, kind="stable"), axis=1)
    row = {a: i for i, a in enumerate(q.column("asked").to_pylist())}
    ranks = np.sort([order[row[a], b] for a, b in zip(lists.column("query_id").to_pylist(), lists.column("list").to_pylist())])
    book.probes = int(ranks[min(len(ranks) - 1, int(np.ceil(target * len(ranks))) - 1)]) + 1 if len(ranks) else 1
    return book.probes


def recall(found: DataFrame, items: DataFrame, asked: DataFrame, key: str, vector: str, query_key: str, query_vector: str, k: int = 5) -> DataFrame:
    """(questions, recall): the share of the exact k nearest that ``found`` has."""
    exact = cosine_topk(items, asked, key, vector, query_key, query_vector, k)
    hit = found.select("query_id", "item_id", F.lit(1).alias("_hit"))
    both = exact.join(hit, ["query_id", "item_id"], "left")
    return both.agg(F.count_distinct("query_id").alias("questions"), (F.count("_hit") / F.count("*")).alias("recall"))
