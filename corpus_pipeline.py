"""Corpus preparation: quality rules, near-dedup, PII, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept.  ``run`` applies them to ``documents``, each stage written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.llm import line_quality, mixing, near_dedup, packing, pii
from fieldglass.llm.common import Workspace, table, written
from fieldglass.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go; lines found in too many documents of a host go from the others.

    Null and empty texts fail and go; a null source is a host of its own; repeated
    rows stay or go alike; extra columns stay, whatever their names.
    """
    return line_quality.filtered(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays; of rows with one doc_id and text, one.

    Rows without doc_id take no part and stay, and so do texts without words.  Extra
    columns stay, whatever their names; an empty table gives an empty one.
    """
    rows = docs.select(F.struct("*").alias("doc")).select("doc", F.col("doc.doc_id").cast("long").alias("id"), F.col("doc.text").cast("string").alias("text"))
    known = _keyed(rows.where("id is not null"))
    kept = near_dedup.near_duplicates(known.select(F.col("key").alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias("kept_key")).distinct()
    once = known.select("doc", "key").dropDuplicates(["key"])
    out = once.join(kept, F.col("key") == F.col("kept_key"), "left_semi").select("doc")
    return out.unionByName(rows.where("id is null").select("doc")).select("doc.*")


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (doc, id, text) with key, one for each id and text.

    It is the id, but for further texts of an id a hash of both above 2**62, so that
    other documents go before them.
    """
    own = rows.withColumn("digest", F.coalesce(F.sha2("text", 256), F.lit("")))
    several = own.groupBy("id").agg(F.min("digest").alias("first"), F.max("digest").alias("last")).where("first <> last").select(F.col("id").alias("shared"), "first")
    several = written(several, "several")
    if several.isEmpty():
        return rows.withColumn("key", F.col("id"))
    both = own.join(several, F.col("id") == F.col("shared"), "left")
    further = F.shiftrightunsigned(F.xxhash64("id", "digest"), 2).bitwiseOR(F.lit(1 << 62))
    return written(both.select("doc", "id", "text", F.when(F.col("digest") != F.col("first"), further).otherwise(F.col("id")).alias("key")), "keyed")


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows the text.

    A null or empty text stays what it is (n_chars null for a null one); every row
    stands alone, so repeated rows stay alike; extra columns stay, whatever their names.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    out = pii.find_personal_data(docs.select(rest.alias("doc"), "text"), mask=True)
    doc = F.col("doc")
    return out.select(*[F.col("masked").alias(c) if c == "text" else F.length("masked").cast("long").alias(c) if c == "n_chars" else doc[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, dealt out by shard and in the shard's order.

    Ranges of (shard, order) and not shards alone are dealt out, so a shard of a
    large corpus is not one task; partitions follow one another in shards.  Null
    texts have size 0, a null source is the last one, rows without doc_id share one
    block of their source, repeated rows are drawn alike; extra columns stay.
    """
    own = {c: f"own_{c}" for c in docs.columns if c in ("mix_shard", "mix_order")}
    drawn = mixing.draws(docs.withColumnsRenamed(own))
    dealt = drawn.repartitionByRange("mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order")
    return dealt.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens; null and empty texts are their end id alone, repeated rows are packed each."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup_stage),
    ("pii", mask_pii),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenization and MinHash have no SQL form; stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote is removed when the next one is written."""
    space = Workspace(spark)
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = space.write(stage(spark, docs, sf_dir), name)
        space.drop(*last)
        last = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
