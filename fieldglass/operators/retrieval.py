"""Keyword scoring, vector search, rank fusion and their evaluation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .stored import shared_folder


def term_count(text: Column, term: str) -> Column:
    """Non-overlapping occurrences of ``term``."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))) / len(term)).cast("long")


def word_total(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]+"))


def bm25(docs: DataFrame, key: str, text: str, title: str, words: list[str], k: int = 5, k1: float = 1.5, b: float = 0.75, boost: float = 1.2, where: Column | None = None) -> DataFrame:
    """Top k of the documents that hold any of the words; all statistics are over these documents.

    Words are looked for in title and text together, as parts of words too, and
    lengths count their words.  A word found in the title multiplies what has been
    gathered up to then, so the order of words matters.  A missing title reads
    'None' where words are counted, and nothing where documents are.  ``where``
    (filters, see ``chunk_filter``) applies before the statistics.  Ties go to the
    smaller key.
    """
    words = [w.lower() for w in words]
    body, head = F.coalesce(F.col(text), F.lit("")), F.lower(F.coalesce(F.col(title), F.lit("")))
    whole = F.lower(F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(" "), body))
    named = F.lower(F.concat(F.coalesce(F.col(title), F.lit("None")), F.lit(" "), body))
    hit = F.lit(False)
    for w in words:
        hit = hit | F.lower(body).contains(w) | head.contains(w)
    own = docs.where(hit if where is None else hit & where)
    own = own.select(F.col(key).alias("key"), head.alias("head"), word_total(whole).alias("len0"), word_total(named).alias("len"), *[term_count(named, w).alias(f"tf{i}") for i, w in enumerate(words)], *[whole.contains(w).alias(f"in{i}") for i, w in enumerate(words)])
    own = own.repartition("key")  # a few numbers a candidate; without it every use of one computes it from the text again
    stats = own.agg(F.count("*").alias("n"), F.greatest(F.coalesce(F.avg("len0"), F.lit(0.0)), F.lit(1.0)).alias("avg"), *[F.count_if(f"in{i}").alias(f"df{i}") for i in range(len(words))])
    x = own.crossJoin(F.broadcast(stats))
    score = F.lit(0.0)
    for i, w in enumerate(words):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        idf = F.greatest(F.lit(0.0), F.log((F.col("n") - df + 0.5) / (df + 0.5) + 1))
        more = score + idf * (tf * (k1 + 1)) / (tf + k1 * (1 - b + b * F.col("len") / F.col("avg")))
        score = F.when(tf > 0, F.when(F.col("head").contains(w), more * boost).otherwise(more)).otherwise(score)
    return x.select("key", F.round(score, 6).alias("score")).orderBy(F.desc("score"), "key").limit(k)


# Document categories that a public category stands for.
CATEGORIES = {
    "press_release": ["press_release", "notice"],
    "milestone": ["milestone", "player_milestone"],
    "futures_schedule": ["futures_schedule", "futures_game"],
    "player_splits": ["player_splits", "split", "player_split"],
    "stadium_facility": ["stadium_facility", "stadium_food", "stadium_ticket"],
}


def chunk_filter(category: str | None = None, contains: dict[str, str] | None = None, **equal) -> Column:
    """Rows that may be found: status ACTIVE (or none) or INDEXED, the category or one it stands for, exact values, words in title or text.

    A row without the value asked for does not match.
    """
    out = F.coalesce("index_status", F.lit("ACTIVE")).isin("ACTIVE", "INDEXED")
    if category:
        out = out & F.coalesce(F.col("category").isin(*CATEGORIES.get(category, [category])), F.lit(False))
    for c, v in equal.items():
        if v is not None:
            out = out & F.coalesce(F.col(c) == F.lit(v), F.lit(False))
    text = F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("content", F.lit(""))))
    for word in (contains or {}).values():
        out = out & text.contains(word.lower())
    return out


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays as double; NULL where one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size)


def cosine_topk(items: DataFrame, queries: DataFrame, key: str, vector: str, query_key: str, query_vector: str, k: int = 5, digits: int = 6, block: int = 4096) -> DataFrame:
    """Exact top k by cosine for each row of a stated set of queries, against all items.

    Queries are sent to the tasks in blocks of at most ``block`` vectors, so what a
    task holds does not grow with their number; a task keeps k items a query and
    batch of items.  Vectors that are NULL, hold NULL, have no length or another
    number of dimensions find nothing.  Ties go to the smaller item.
    """
    import numpy as np
    import pyarrow as pa

    spark = items.sparkSession
    asked = queries.where(F.col(query_vector).isNotNull()).select(F.col(query_key).alias("q"), F.transform(F.col(query_vector), lambda v: v.cast("double")).alias("v"))
    total = asked.count()
    blocks = max(1, -(-total // block))
    kind = f"query_id {queries.schema[query_key].dataType.simpleString()}, item_id {items.schema[key].dataType.simpleString()}, score double"

    def unit(column):
        rows = [np.asarray(x, float) if x is not None and None not in x else np.zeros(0) for x in column.to_pylist()]
        size = max(map(len, rows), default=0)
        out = np.zeros((len(rows), size))
        for i, r in enumerate(rows):
            if len(r) == size:
                out[i] = r
        length = np.sqrt((out * out).sum(1))
        return out / np.where(length > 0, length, 1)[:, None], length > 0

    found = None
    for i in range(blocks):
        part = (asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i)).toArrow()
        sent = spark.sparkContext.broadcast((part.column("q").combine_chunks(), *unit(part.column("v").combine_chunks())))

        def score(batches, sent=sent):
            ids, q, real = sent.value
            for b in batches:
                own, fine = unit(b.column("v"))
                if not len(own) or not len(ids) or own.shape[1] != q.shape[1]:
                    continue
                s = np.round(own @ q.T, digits)
                s[~fine] = -np.inf
                best = np.argsort(-s, axis=0, kind="stable")[:k]
                rows, cols = best.ravel(), np.tile(np.arange(len(ids)), len(best))
                ok = real[cols] & np.isfinite(s[rows, cols])
                rows, cols = rows[ok], cols[ok]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(cols)), b.column("key").take(pa.array(rows)), pa.array(s[rows, cols])], ["query_id", "item_id", "score"])

        own = items.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.transform(F.col(vector), lambda v: v.cast("double")).alias("v")).sortWithinPartitions("key").mapInArrow(score, kind)
        found = own if found is None else found.unionByName(own)
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "item_id")
    return found.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)


def rrf(sparse: DataFrame, dense: DataFrame, k: int = 2, weight: float = 2.0) -> DataFrame:
    """Reciprocal rank fusion of (query_id, item_id, rank) lists; ranks keep the gaps they come with."""
    s = sparse.select("query_id", "item_id", F.col("rank").alias("rs"))
    d = dense.select("query_id", "item_id", F.col("rank").alias("rd"))
    part = lambda r, w: F.coalesce(F.lit(w) / (F.lit(float(k)) + F.col(r)), F.lit(0.0))
    return s.join(d, ["query_id", "item_id"], "full").select("query_id", "item_id", F.round(part("rs", 1.0) + part("rd", weight), 6).alias("score"))


def hybrid(sparse: DataFrame, dense: DataFrame, top: int = 5, k: int = 2, weight: float = 2.0) -> DataFrame:
    """The ``top`` of two ranked lists (query_id, item_id, rank, content_hash) of the same questions, fused.

    A dense hit that the sparse list has too is stale if the hashes differ (one of
    them missing is a difference, both is none) and counts for nothing; one that
    only the dense list has is taken as it is.  Ranks keep the gaps they come with.
    Ties go to the better sparse rank, then the better dense rank.
    """
    s = sparse.select("query_id", "item_id", F.col("rank").alias("bm25_rank"), F.col("content_hash").alias("_s"), F.lit(True).alias("_there"))
    d = dense.select("query_id", "item_id", F.col("rank").alias("vector_rank"), F.col("content_hash").alias("_d"))
    both = s.join(d, ["query_id", "item_id"], "full")
    stale = F.coalesce("_there", F.lit(False)) & ~F.col("_s").eqNullSafe(F.col("_d"))
    both = both.withColumn("vector_rank", F.when(~stale, F.col("vector_rank")))
    part = lambda r, w: F.coalesce(F.lit(w) / (F.lit(float(k)) + F.col(r)), F.lit(0.0))
    out = both.withColumn("score", F.round(part("bm25_rank", 1.0) + part("vector_rank", weight), 6))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("bm25_rank"), F.asc_nulls_last("vector_rank"))
    return out.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= top).select("query_id", "item_id", "rank", "bm25_rank", "vector_rank", "score")


def evaluate(top: DataFrame, asked: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """By query: found, recall, precision (of k), reciprocal rank of the first hit, hit.

    ``asked`` has query_id and relevant (how many there are), ``relevant`` the pairs
    that count; a query without hits has zeros.
    """
    good = top.where(F.col("rank") <= k).join(relevant.distinct(), ["query_id", "item_id"]).groupBy("query_id").agg(F.count("*").alias("found"), F.min("rank").alias("first"))
    x = asked.join(good, "query_id", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    recall = F.when(F.col("relevant") > 0, F.col("found") / F.col("relevant")).otherwise(0.0)
    return x.select("query_id", "found", F.round(recall, 6).alias("recall"), (F.col("found") / F.lit(float(k))).alias("precision"), F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("reciprocal"), (F.col("found") > 0).alias("hit"))


def nearest_rank(df: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles in one row: the least value whose running count reaches the share.

    Counts by value are summed in one window, so it sees values and not rows.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    x = counts.crossJoin(F.broadcast(total)).withColumn("upto", F.sum("n").over(W.orderBy(column)))
    return x.agg(*[F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * share), F.col(column))).alias(name) for name, share in shares.items()])


def selected_ranks(df: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles of any number of different values in one row, NULLs left out.

    Equal values become one with a count, values are dealt out by ranges, and the
    counts of the ranges (a line each) say which range holds each rank; only those
    are read again and counted through, each by itself.  An empty table gives NULLs.
    """
    spark = df.sparkSession
    kind = df.schema[column].dataType
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    path = shared_folder(spark)
    counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()).write.parquet(path)
    laid = spark.read.parquet(path)
    sizes = sorted((r.part, r.n) for r in laid.groupBy("part").agg(F.sum("n").alias("n")).collect())
    total, before, wanted = sum(n for _, n in sizes), 0, []
    for part, n in sizes:
        wanted += [(name, part, rank - before) for name, share in shares.items() if before < (rank := max(1, math.ceil(total * share))) <= before + n]
        before += n
    own = laid.where(F.col("part").isin([p for _, p, _ in wanted])).withColumn("upto", F.sum("n").over(W.partitionBy("part").orderBy("v")))
    at = {name: (part, rank) for name, part, rank in wanted}
    pick = lambda name: F.min(F.when((F.col("part") == at[name][0]) & (F.col("upto") >= at[name][1]), F.col("v"))) if name in at else F.lit(None).cast(kind)
    return own.agg(F.count("*").alias("_n"), *[pick(name).alias(name) for name in shares]).drop("_n")


def cache_hits(docs: DataFrame, key: str, text: str, store: DataFrame) -> DataFrame:
    """(key, hit): whether the hash of a text is among the hashes ``h`` of the store; hashes are shuffled, texts are not."""
    own = docs.select(key, F.sha2(F.col(text), 256).alias("h"))
    return own.join(store.select("h", F.lit(True).alias("_hit")), "h", "left").select(key, F.coalesce("_hit", F.lit(False)).alias("hit"))
