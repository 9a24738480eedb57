"""The operators bound to the standard tables, and what of them SQL can check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_paths, kmeans_tree, line_quality, media_archive, merkle_manifest, mixing, near_dedup, packing, pii, span_dedup, token_records, turn_repair, warc_fixity
from .common import scratch, table, written


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_paths.extract(table(spark, sf_dir, "pages"))


def op2_media_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as an image in an archive, read back and described."""
    return media_archive.media_column(table(spark, sf_dir, "documents"), scratch(spark, "media"))


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of every document."""
    return line_quality.quality(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to record files and read back."""
    folder = scratch(spark, "records")
    return token_records.read_records(token_records.write_records(table(spark, sf_dir, "documents"), folder, tokenizer_file("word_bpe_49k.json"), 2), folder)


#: In the audit query the second replica has one flipped bit in the records of these pages.
DRILL_EVERY = 97


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two WARC replicas of all pages, one damaged by rule, compared by Merkle trees; a row per record."""
    a, b = scratch(spark, "warc-a"), scratch(spark, "warc-b")
    index = written(warc_fixity.write_warc(table(spark, sf_dir, "pages"), a), "warc-index")
    warc_fixity.copy_replica(index, a, b, lambda k: k is not None and k % DRILL_EVERY == 0).collect()  # a row per file
    return warc_fixity.audit(index, a, b).selectExpr("key as page_id", "n_bytes", "payload_sha256", "status")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without spans that an earlier one has."""
    return span_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents; a fifth of their texts, named by crc32 of the id, is checked in lower case."""
    lower = F.translate("text", merkle_manifest._UPPER, merkle_manifest._LOWER)
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"), F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, lower))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule, and its cheapest repair."""
    return turn_repair.repair(table(spark, sf_dir, "conversations"))


def op13_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every twentieth vector."""
    return kmeans_tree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_html_paths, op2_media_archive, op3_line_quality, op4_packing, op5_token_records, op6_warc_fixity, op7_mixing, op8_span_dedup, op9_pii, op10_near_dedup, op11_merkle_manifest, op12_turn_repair, op13_kmeans_tree)
}

ORACLES: dict[str, str] = {
    "op3_line_quality": line_quality.ORACLE,
    "op11_merkle_manifest": merkle_manifest.ORACLE,
    "op12_turn_repair": turn_repair.oracle(),
    "op6_warc_fixity": """
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n_bytes, sha256(coalesce(html, '')) AS payload_sha256,
            CASE WHEN page_id % 97 = 0 THEN 'mismatch' ELSE 'ok' END AS status
        FROM pages""",
    "op8_span_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
        hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM hit),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_near_dedup": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        links AS (SELECT x.a, x.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY 1, 2) x
            JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.c AS component_id, r.c = d.doc_id AS kept
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY 1) r ON r.a = d.doc_id""",
}
