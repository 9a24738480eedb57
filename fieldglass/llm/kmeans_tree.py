"""Nearest neighbours by inner product with a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``sample`` vectors, 64 MB at most): k-means
splits a node into up to ``branches`` children until a leaf stands for ``leaf_rows``
vectors of the table (``leaves`` leaves at most).  Every vector is then sent down the
tree to one leaf.  A query walks the tree with a priority queue of nodes by their
centroid's inner product, and each leaf that comes out of the queue is a visit.

How many visits are needed is calibrated: for up to ``asked_sample`` queries the exact
neighbours are found by a scan of the whole table, and visits widen one leaf at a time
until the leaves visited hold the share ``recall`` of them.  A query goes on visiting
where its leaves have too few candidates for a full answer.

Vectors that are equal are one row of the index with their least k + 1 ids, gathered
batch by batch before anything is shuffled, and queries that are equal are asked once;
so copies, however many, make no bin large.  Leaves that follow one another stand
together as a shelf, and a query goes to a shelf once, with a bit for each leaf that it
visits there; a shelf's queries are dealt out in blocks, and so are the vectors of a
leaf too large for one shelf, each pair of blocks a task's work.  So what a query moves
and leaves behind follows the shelves and not its visits, of which vectors without
clusters take most leaves.
"""

from __future__ import annotations

import heapq
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, partitions, ship

_SAMPLE_BYTES = 64 << 20
#: Vectors of a shelf, as doubles.
_SHELF_BYTES = 32 << 20
#: Queries whose ways, or products with a shelf, are held at a time.
_AT_ONCE = 64


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors with zeros where components are missing, which rows are vectors at all)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_list(pa.float64()))
    n = len(column)
    size = np.asarray(column.value_lengths().fill_null(0), np.int64)
    flat = column.flatten()
    hole = np.zeros(len(flat), bool) if not flat.null_count else np.asarray(flat.is_null())
    value = np.asarray(flat.fill_null(0.0), np.float64)
    row = np.repeat(np.arange(n), size)
    out = np.zeros((n, dim))
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = np.where(np.isfinite(value), value, 0.0) + 0.0
    bad = np.zeros(n, bool)
    bad[row[hole | ~np.isfinite(value)]] = True
    return out, ~bad & out.any(1)


class Tree:
    """Nodes as rows of ``centre``; ``kids`` by node, ``leaf`` its number or -1."""

    def __init__(self, points: np.ndarray, leaves: int, branches: int = 16, rounds: int = 8):
        self.centre, self.kids, self.leaf, self.leaves = [points.mean(0) if len(points) else np.zeros(points.shape[1])], [[]], [-1], 0
        self.small = max(1, -(-len(points) // max(1, leaves)))
        self.branches, self.rounds = branches, rounds
        todo = [(0, points)]
        while todo:
            node, x = todo.pop()
            parts = self._split(x, node) if len(x) > self.small else []
            if len(parts) < 2:
                self.leaf[node], self.leaves = self.leaves, self.leaves + 1
                continue
            for c, part in parts:
                self.kids[node].append(len(self.centre))
                todo.append((len(self.centre), part))
                self.centre.append(c)
                self.kids.append([])
                self.leaf.append(-1)
        self.centre = np.array(self.centre)
        self.half = 0.5 * (self.centre**2).sum(1)

    def _split(self, x: np.ndarray, seed: int) -> list[tuple]:
        k = min(self.branches, -(-len(x) // self.small))
        r = np.random.default_rng(seed)
        first = [int(r.integers(len(x)))]
        far = ((x - x[first[0]]) ** 2).sum(1)
        while len(first) < k and far.max() > 0:  # k-means++
            i = int(np.searchsorted(np.cumsum(far), r.random() * far.sum()).clip(0, len(x) - 1))
            first.append(i)
            far = np.minimum(far, ((x - x[i]) ** 2).sum(1))
        c = x[first]
        for _ in range(self.rounds):
            to = (x @ c.T - 0.5 * (c**2).sum(1)).argmax(1)
            n = np.bincount(to, minlength=len(c))
            total = np.zeros_like(c)
            np.add.at(total, to, x)
            c = total[n > 0] / n[n > 0, None]
        to = (x @ c.T - 0.5 * (c**2).sum(1)).argmax(1)
        return [(c[i], x[to == i]) for i in range(len(c)) if (to == i).any()]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child at every node."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            kids = np.array(self.kids[node])
            to = (x[rows] @ self.centre[kids].T - self.half[kids]).argmax(1)
            todo += [(int(kid), rows[to == i]) for i, kid in enumerate(kids) if (to == i).any()]
        return out

    def best_first(self, scores):
        """Leaves for one query in the order of a priority queue, given its inner products with all centres."""
        queue = [(-scores[0], 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
            for kid in self.kids[node]:
                heapq.heappush(queue, (-scores[kid], kid))


def _table(column: pa.Array, kind: str) -> np.ndarray:
    data = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(data.to_pylist()), kind).astype(np.float64).reshape(len(data), -1)


def _best(scores: np.ndarray, rows: np.ndarray, query: np.ndarray, first: np.ndarray, k: int, seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, exact scores) of the k best rows for a query, ties to the smaller first id.

    Of rows that are not ``seen`` the score must be -inf; they are left out.

    The product of matrices only chooses some more than k; what counts is each
    row's own sum of products, which is the same wherever the row lies.
    """
    some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k - 11)[len(scores) - k - 11]) if len(scores) > k + 11 else np.arange(len(scores))
    some = some if seen is None else some[seen[some]]
    exact = (rows[some] * query).sum(1)
    order = np.lexsort((first[some], -exact))[:k]
    return some[order], exact[order]


def _expanded(ids: list, chosen: np.ndarray, exact: np.ndarray, k: int) -> tuple[list, list]:
    pairs = sorted((-s, i) for r, s in zip(chosen.tolist(), exact.tolist()) for i in ids[r])[:k]
    return [i for _, i in pairs], [-s for s, _ in pairs]


def nearest(vectors: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = 0.97, sample: int = 32_768, leaf_rows: int = 256, leaves: int = 4096, branches: int = 16, asked_sample: int = 256, block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row of ``vectors`` where ``asked`` is true, among all other rows.

    Rows with a null key, or whose vector is null, zero or holds a null or a
    non-finite component, take no part.  A shorter vector counts as filled up with
    zeros.  Rows with one key are one vector if they repeat it, and vectors of
    their own, none a candidate of the other, if not.  Ties go to the smaller key;
    fewer candidates than k are all found; other columns are not looked at; a table
    without vectors or queries gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    space = Workspace(spark)
    kind = "<f4" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    own = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked")).where("id is not null and v is not null")
    dim = own.agg(F.max(F.size("v"))).first()[0] or 0
    result = "query_id long, rank int, vec_id long, score double"
    if dim < 1:
        return spark.createDataFrame([], result)
    n_parts = partitions(spark)

    def gather(batches):
        """Equal vectors of a batch as one row with their least ids, for each of asked and not asked."""
        for b in batches:
            x, good = matrix(b.column("v"), dim)
            x = np.ascontiguousarray(x[good].astype(kind))
            if not len(x):
                continue
            ids, ask = (np.asarray(b.column(c))[good] for c in ("id", "asked"))
            order = np.lexsort((ids, np.unique(x.view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel(), return_inverse=True)[1].ravel()))
            same = (x[order][1:] == x[order][:-1]).all(1)
            start = np.flatnonzero(np.concatenate([[True], ~same]))
            stop = np.append(start[1:], len(order))
            least = [np.unique(ids[order[a:z]])[: k + 1].tolist() for a, z in zip(start, stop)]
            mine = [np.unique(ids[order[a:z]][ask[order[a:z]]]).tolist() for a, z in zip(start, stop)]
            yield pa.RecordBatch.from_arrays([pa.array([x[order[a]].tobytes() for a in start], pa.binary()), pa.array(least, pa.list_(pa.int64())), pa.array(mine, pa.list_(pa.int64()))], ["v", "ids", "mine"])

    gathered = space.write(own.mapInArrow(gather, "v binary, ids array<long>, mine array<long>").withColumn("d", F.unhex(F.sha2("v", 256))), "gathered")
    asked_rows = space.write(gathered.select("d", F.explode("mine").alias("query_id")).distinct(), "asked")
    questions = gathered.where(F.size("mine") > 0).groupBy("d").agg(F.first("v").alias("v"))

    def merged(batches):
        """The least ids of equal vectors, from rows sorted by digest."""
        def each():
            rows = itertools.chain.from_iterable(zip(*(b.column(c).to_pylist() for c in ("d", "v", "ids"))) for b in batches)
            for d, part in itertools.groupby(rows, key=lambda r: r[0]):
                _, v, ids = next(part)
                for _, _, more in part:
                    ids = sorted({*ids, *more})[: k + 1]
                yield d, v, ids

        return _chunks(each(), ["d", "v", "ids"], [pa.binary(), pa.binary(), pa.list_(pa.int64())])

    classes = space.write(gathered.select("d", "v", "ids").repartition(n_parts, "d").sortWithinPartitions("d").mapInArrow(merged, "d binary, v binary, ids array<long>"), "classes")
    total = classes.count()
    if not total:
        return spark.createDataFrame([], result)
    most = min(sample, _SAMPLE_BYTES // (dim * 8))
    part = F.pmod(F.xxhash64("d"), F.lit(1 << 20)) < max(1, min(1 << 20, round((1 << 20) * 0.95 * most / total)))
    points = _table(classes.where(part).select("v").toArrow().column("v"), kind) if total > most else _table(classes.select("v").toArrow().column("v"), kind)
    tree = Tree(points.reshape(-1, dim), min(leaves, -(-total // leaf_rows)), branches)
    sent = spark.sparkContext.broadcast(tree)

    def put(batches):
        for b in batches:
            leaf = sent.value.place(_table(b.column("v"), kind)) if b.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *(b.column(c) for c in ("d", "v", "ids"))], ["leaf", "d", "v", "ids"])

    placed = space.write(classes.mapInArrow(put, "leaf int, d binary, v binary, ids array<long>"), "placed")
    space.drop(classes)
    laid = placed.groupBy("leaf").agg(F.sum(F.size("ids")).alias("n"), F.count("*").alias("rows")).collect()  # a line a leaf, 4,096 at most
    held = {r.leaf: r.n for r in laid}
    room = max(1, min(16 * block, max(block, total // 16), _SHELF_BYTES // (8 * dim)))
    shelves = _shelves({r.leaf: r.rows for r in laid}, room)
    stands = {leaf: (shelf, bit) for shelf, (own, _) in enumerate(shelves) for bit, leaf in enumerate(own)}
    visits = _calibrated(tree, placed, questions, asked_rows, kind, k, recall, asked_sample)

    def routes(batches):
        """A row for each query and shelf that it visits, with the bits of its leaves there."""
        t = sent.value
        for b in batches:
            for a in range(0, b.num_rows, _AT_ONCE):
                d, v = (b.column(c).slice(a, _AT_ONCE) for c in ("d", "v"))
                who, shelf, bits = [], [], []
                for i, s in enumerate(_table(v, kind) @ t.centre.T):
                    there, ways = 0, {}
                    for n, x in enumerate(t.best_first(s.tolist())):
                        if n >= visits and there > k:
                            break
                        there += held.get(x, 0)
                        if x in stands:
                            ways.setdefault(stands[x][0], []).append(stands[x][1])
                    for at, own in ways.items():
                        field = np.zeros(len(shelves[at][0]), bool)
                        field[own] = True
                        who.append(i)
                        shelf.append(at)
                        bits.append(np.packbits(field).tobytes())
                at = pa.array(who, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(shelf, pa.int32()), d.take(at), v.take(at), pa.array(bits, pa.binary())], ["shelf", "d", "v", "bits"])

    ways = space.write(questions.select("d", "v").mapInArrow(routes, "shelf int, d binary, v binary, bits binary"), "visits")
    asks = ways.groupBy("shelf").agg(F.ceil(F.count("*") / block).cast("int").alias("asks"))
    cut = spark.createDataFrame([(leaf, shelf, bit, shelves[shelf][1]) for leaf, (shelf, bit) in stands.items()], "leaf int, shelf int, bit int, rows int").join(F.broadcast(asks), "shelf")
    place = lambda n: F.pmod(F.xxhash64("d", F.lit(7)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(F.broadcast(cut), "leaf").select("shelf", place("rows").alias("i"), every("asks").alias("j"), "bit", "v", "ids")
    right = ways.join(F.broadcast(cut.where("bit = 0").drop("leaf", "bit")), "shelf").select("shelf", every("rows").alias("i"), place("asks").alias("j"), "d", "v", "bits")

    def compare(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out, order = [], np.zeros(0, int)
        if rows.num_rows and asks.num_rows:
            rows = rows.take(pa.array(np.argsort(rows.column("bit").to_numpy(), kind="stable")))
            x, q, ids = _table(rows.column("v"), kind), _table(asks.column("v"), kind), rows.column("ids").to_pylist()
            first = np.array([i[0] for i in ids])
            bit, size = np.unique(rows.column("bit").to_numpy(), return_counts=True)
            goes = np.unpackbits(np.frombuffer(b"".join(asks.column("bits").to_pylist()), np.uint8).reshape(len(q), -1), axis=1)[:, bit].astype(bool)
            order = np.argsort(goes.argmax(1), kind="stable")  # neighbours mostly visit the same leaves
            for a in range(0, len(q), _AT_ONCE):
                some = order[a : a + _AT_ONCE]
                used = goes[some].any(0)
                own = np.flatnonzero(np.repeat(used, size))
                mine, seen = (x if used.all() else x[own]), np.repeat(goes[some][:, used], size[used], axis=1)
                s = q[some] @ mine.T
                s[~seen] = -np.inf
                for n, one in enumerate(q[some]):
                    chosen, exact = _best(s[n], mine, one, first[own], k + 1, seen[n])
                    out.append(_expanded(ids, own[chosen], exact, k + 1))
        d = asks.column("d").take(pa.array(order))
        return pa.table({"d": d, "ids": pa.array([x for x, _ in out], pa.list_(pa.int64())), "scores": pa.array([x for _, x in out], pa.list_(pa.float64()))})

    by = ("shelf", "i", "j")
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(compare, "d binary, ids array<long>, scores array<double>")

    def best(batches):
        """The k + 1 best of all leaves by query, from rows sorted by digest."""
        def each():
            rows = itertools.chain.from_iterable(zip(*(b.column(c).to_pylist() for c in ("d", "ids", "scores"))) for b in batches)
            for d, part in itertools.groupby(rows, key=lambda r: r[0]):
                top: list = []
                for _, ids, scores in part:
                    top = sorted([*top, *((-s, i) for i, s in zip(ids, scores))])[: k + 1]
                yield d, [i for _, i in top], [-s for s, _ in top]

        return _chunks(each(), ["d", "ids", "scores"], [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64())])

    top = found.repartition(n_parts, "d").sortWithinPartitions("d").mapInArrow(best, "d binary, ids array<long>, scores array<double>")
    each = asked_rows.join(top, "d").select("query_id", F.arrays_zip("ids", "scores").alias("x"))
    each = each.select("query_id", F.posexplode(F.slice(F.filter("x", lambda y: y["ids"] != F.col("query_id")), 1, k)).alias("at", "x"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))


def _shelves(rows: dict[int, int], room: int) -> list[tuple[list[int], int]]:
    """(leaves that follow one another with ``room`` vectors at most, 1), or (one larger leaf, how many blocks it needs)."""
    out: list[tuple[list[int], int]] = []
    free = 0
    for leaf, n in sorted(rows.items()):
        if n > free:
            out.append(([], max(1, -(-n // room))))
            free = room
        out[-1][0].append(leaf)
        free -= n
    return out


def _chunks(rows, names: list[str], kinds: list, size: int = 2000):
    while part := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds)], names)


def _calibrated(tree: Tree, placed: DataFrame, questions: DataFrame, asked: DataFrame, kind: str, k: int, recall: float, size: int) -> int:
    """How many leaves to visit so that a sample of queries finds the share ``recall`` of its exact neighbours."""
    spark = placed.sparkSession
    some = questions.orderBy(F.xxhash64("d", F.lit(3)), "d").limit(size)
    own = some.join(asked.groupBy("d").agg(F.min("query_id").alias("query_id")), "d").select("d", "v", "query_id").toArrow()
    if not own.num_rows:
        return 1
    q, who = _table(own.column("v"), kind), own.column("query_id").to_pylist()
    sent = spark.sparkContext.broadcast(q)

    def scan(batches):
        """Of each batch, the k + 1 best of every query in the sample."""
        q = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            x, ids, leaf = _table(b.column("v"), kind), b.column("ids").to_pylist(), b.column("leaf").to_pylist()
            first, out = np.array([i[0] for i in ids]), []
            for n, (s, one) in enumerate(zip(q @ x.T, q)):
                rows, exact = _best(s, x, one, first, k + 1)
                pairs = sorted((-e, i, leaf[r]) for r, e in zip(rows.tolist(), exact.tolist()) for i in ids[r])[: k + 1]
                out += [(n, i, -e, at) for e, i, at in pairs]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.float64(), pa.int32()))], ["q", "id", "score", "leaf"])

    from pyspark.sql import Window as W

    best = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "id"))
    exact = placed.mapInArrow(scan, "q int, id long, score double, leaf int").withColumn("rank", best).where(F.col("rank") <= k + 1).collect()  # (k + 1) lines a sampled query
    near: dict[int, list] = {}
    for r in sorted(exact, key=lambda r: (r.q, r["rank"])):
        if r.id != who[r.q]:
            near.setdefault(r.q, []).append(r.leaf)
    order = {n: {leaf: i for i, leaf in enumerate(tree.best_first((tree.centre @ q[n]).tolist()))} for n in near}
    places = sorted(order[n][leaf] for n, x in near.items() for leaf in x[:k])
    visits, within = 0, 0
    while visits < tree.leaves and within < recall * len(places):  # one more leaf at a time
        visits += 1
        within = int(np.searchsorted(places, visits))
    return max(1, visits)


def brute_force(rows, asked, k: int = 20) -> dict:
    """{query: [(id, score), ...]} by definition, for tests: rows are (id, vector)."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    size = max((len(v) for _, v in good), default=0)
    good = list({(i, v.tobytes()): (i, np.pad(v, (0, size - len(v)))) for i, v in good}.values())
    out = {}
    for i, v in good:
        if asked(i):
            scored = sorted((-float((w * v).sum()), j) for j, w in good if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out
