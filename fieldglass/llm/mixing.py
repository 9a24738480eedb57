"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents fall into blocks by a hash of their id, at most ``most_blocks`` per
source, so every table below the documents has a bounded number of rows a source
and a source with a third of all documents is dealt out as finely as its size
asks.  Per source, whole passes over all blocks and then blocks in a permuted
order that still fit reach the target.  That fixes how many block draws each
source gives in all.  A binary tree over the output shards splits these counts
exactly: at each node a multivariate hypergeometric draw says how many draws of
each source go left.  Every shard then takes its own stretch of each source's
permuted draws, so shards are disjoint, and orders its documents by a hash.

Everything follows from ``seed``; reruns and retried tasks give the same rows.
The driver holds one line per source (totals, counts by shard), never documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, ship


def targets(sizes: dict[str | None, int], most: int = 3, weights=(1, 2, 3)) -> dict[str | None, float]:
    """Target words by source: shares by weight, none above ``most`` times its own size.

    Sources in code point order, null last, take the weights in turn; what a cap
    frees is shared by weight among the rest until no target is above its cap.
    """
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    left, free = float(sum(sizes.values())), names
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        free = [s for s in free if s not in out]
    return out


def split(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Draws by (shard, source): a tree of multivariate hypergeometric draws whose columns sum to ``quotas``."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def node(first: int, n: int, have: np.ndarray) -> None:
        if n == 1:
            out[first] = have
            return
        half = n // 2
        rng = np.random.default_rng([seed, first, n])
        left = rng.multivariate_hypergeometric(have, int(have.sum()) * half // n, method="marginals") if have.sum() else have
        node(first, half, left)
        node(first + half, n - half, have - left)

    node(0, shards, np.asarray(quotas, np.int64))
    return out


def word_count(text: Column) -> Column:
    """The words of a text (null: 0), without building them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _name(source: Column) -> Column:
    """A source as a key without nulls."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def plan(docs: DataFrame, seed: int = 17, shards: int = 16, most: int = 3, most_blocks: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(documents as one column ``doc`` with _name, _block and _size; blocks with what is drawn from them).

    Blocks: _name, _block, source_size, target, copies and shards (one by copy).
    They are written once, so that Spark knows their size.
    """
    ship(docs.sparkSession)
    space = Workspace(docs.sparkSession)
    block = F.pmod(F.xxhash64(F.lit(seed), F.col("doc.doc_id").cast("long")), F.lit(most_blocks)).cast("int")
    own = docs.select(F.struct("*").alias("doc")).select("doc", _name(F.col("doc.source")).alias("_name"), block.alias("_block"), word_count(F.col("doc.text").cast("string")).alias("_size"))
    blocks = own.groupBy("_name", "_block").agg(F.sum("_size").alias("size")).withColumn("order", F.xxhash64(F.lit(seed + 1), "_name", "_block"))
    blocks = space.write(blocks, "blocks")
    sizes = {r[0]: r[1] for r in blocks.groupBy("_name").agg(F.sum("size")).collect()}
    real = {None if k == "n" else k[1:]: v for k, v in sizes.items()}
    aims = targets(real, most)
    goal = {k: aims[None if k == "n" else k[1:]] for k in sizes}

    def choose(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["order", "_block"])
        name = t["_name"].iloc[0]
        whole, aim = sizes[name], goal[name]
        passes = min(most, int(aim // whole)) if whole else 1
        rest = aim - passes * whole if passes < most and whole else 0
        size, extra, sum_ = t["size"].to_numpy(), np.zeros(len(t), np.int32), 0
        for i, s in enumerate(size):
            if rest and sum_ + s <= rest:
                extra[i] = 1
                sum_ += s
        free = [(s, i) for i, s in enumerate(size) if rest and not extra[i]]
        if free and abs(sum_ + min(free)[0] - rest) < rest - sum_:
            extra[min(free)[1]] = 1
        return t.assign(copies=passes + extra)[["_name", "_block", "order", "copies"]]

    drawn = space.write(blocks.groupBy("_name").applyInPandas(choose, "_name string, _block int, order long, copies int"), "drawn")
    space.drop(blocks)
    quota = {r[0]: r[1] for r in drawn.groupBy("_name").agg(F.sum("copies")).collect()}
    names = sorted(quota)
    table = split(np.array([quota[k] for k in names], np.int64), shards, seed) if names else np.zeros((shards, 0), np.int64)
    ends = {k: np.cumsum(table[:, i]) for i, k in enumerate(names)}

    def deal(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["order", "_block"]).reset_index(drop=True)
        name = t["_name"].iloc[0]
        to = [[] for _ in range(len(t))]
        rank = 0
        for c in range(int(t["copies"].max())):
            for i in np.flatnonzero(t["copies"].to_numpy() > c):
                to[i].append(int(np.searchsorted(ends[name], rank, "right")))
                rank += 1
        return pd.DataFrame({"_name": name, "_block": t["_block"], "source_size": sizes[name], "target": goal[name], "copies": t["copies"], "shards": to})

    dealt = space.write(drawn.groupBy("_name").applyInPandas(deal, "_name string, _block int, source_size long, target double, copies int, shards array<int>"), "dealt")
    space.drop(drawn)
    return own, dealt


def _sized(blocks: DataFrame, most_sent: int) -> DataFrame:
    """Block rows to be joined: counted, sent to the tasks up to ``most_sent`` of them (some 20 MB), else joined by a shuffle.

    Said outright, since files of such rows pack so well that their size on disk misleads.
    """
    return F.broadcast(blocks) if blocks.count() <= most_sent else blocks.hint("merge")


def draws(docs: DataFrame, seed: int = 17, shards: int = 16, most: int = 3, most_sent: int = 1 << 17) -> DataFrame:
    """The mix: the rows of ``docs`` as often as drawn, with mix_shard and mix_order (position key in the shard).

    Rows not drawn are absent.  Columns of ``docs`` of these two names are replaced.
    The order goes by doc_id, text and copy; only rows that agree in all three, and
    so are the same text in the same shard, have one place.  Texts are not shuffled to
    meet their blocks while these are few, see ``_sized``.
    """
    own, blocks = plan(docs, seed, shards, most)
    out = own.join(_sized(blocks.select("_name", "_block", "shards"), most_sent), ["_name", "_block"]).select("doc", F.posexplode("shards").alias("_copy", "mix_shard"))
    order = F.xxhash64(F.lit(seed + 2), F.col("doc.doc_id"), F.col("doc.text"), "_copy")
    return out.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c not in ("mix_shard", "mix_order")], "mix_shard", order.alias("mix_order"))


def mix(docs: DataFrame, seed: int = 17, shards: int = 16, most: int = 3, most_sent: int = 1 << 17) -> DataFrame:
    """By row of ``docs``: doc_id, size, source_size, target, taken, shards.

    size counts words, null texts 0; taken is size times the copies drawn;
    shards lists the shard of each copy.  A null source is a source of its own,
    last in order; rows without doc_id share one block of their source; rows that
    repeat a doc_id are documents of their own and taken alike.  Other columns are
    not looked at; an empty table gives an empty result.
    """
    own, blocks = plan(docs.select("doc_id", "source", "text"), seed, shards, most)
    out = own.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "_name", "_block", F.col("_size").alias("size")).join(_sized(blocks, most_sent), ["_name", "_block"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).cast("long").alias("taken"), F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards"))
