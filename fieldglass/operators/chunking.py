"""Texts cut into chunks: by size with overlap, by heading, in parents and children, by meaning.

All of it are expressions over arrays of pieces, folded inside the JVM; a text is one
row until its chunks are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .retrieval import cosine

# What a heading looks like, how short a stub is, which categories have headings.
HEADING = r"(?m)(?=^\s*#{1,3}\s+조항\s+\d+|^\s*제\s*\d+\s*조(?:\s|\.|\:)|^\s*#{1,3}\s+[가-힣A-Za-z]|^\s*ARTICLE\s+\d+|^\s*\d+\.\s+[가-힣A-Z])"
KEYWORDS = r"(?ms)^#{1,3}\s*키워드\s*\n(.*?)(?=^#{1,3}\s|\z)"
STUB = 30
BY_HEADING = ("rulebook", "rules", "namuwiki")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _filled(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def paragraphs(text: Column) -> Column:
    """Parts between blank lines; lines only where no part is left."""
    blocks = _filled(F.split(text, "\n\n"))
    return F.when(F.size(blocks) > 0, blocks).otherwise(_filled(F.split(text, "\n")))


def sentences(text: Column) -> Column:
    """Parts after . ! ? and white space."""
    return F.split(text, r"(?<=[.!?])\s+")


def _piece(text: Column, sep: str) -> Column:
    return F.struct(text.alias("text"), F.lit(sep).alias("sep"))


def _packed(pieces: Column, limit: int, overlap: int) -> Column:
    """Pieces put together up to ``limit`` characters; the next chunk begins with the tail of the one before."""

    def step(state, p):
        done, now = state["done"], state["now"]
        joined = F.concat(now, p["sep"], p["text"])
        fits = F.length(now) + F.length(p["text"]) <= limit
        grown = F.when(p["sep"] == " ", strip(joined)).otherwise(joined)
        next_now = F.when(now == "", p["text"]).when(fits, grown).otherwise(F.concat(F.right(now, F.lit(overlap)), p["sep"], p["text"]))
        return F.struct(F.when((now == "") | fits, done).otherwise(F.array_append(done, now)).alias("done"), next_now.alias("now"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))
    return F.aggregate(pieces, start, step, lambda s: F.when(s["now"] != "", F.array_append(s["done"], s["now"])).otherwise(s["done"]))


def overlap_chunks(text: Column, limit: int = 800, overlap: int = 150) -> Column:
    """Paragraphs up to ``limit`` characters; one above it goes by sentences."""
    pieces = F.transform(paragraphs(text), lambda p: F.when(F.length(p) > limit, F.transform(sentences(p), lambda s: _piece(s, " "))).otherwise(F.array(_piece(p, "\n\n"))))
    return _packed(F.flatten(pieces), limit, overlap)


def child_chunks(text: Column, size: int = 250, overlap: int = 50) -> Column:
    """Paragraphs of a parent up to ``size``, none parted."""
    return F.transform(_packed(F.transform(paragraphs(text), lambda p: _piece(p, "\n\n")), size, overlap), strip)


def _rows(docs: DataFrame, key: str, chunks: Column) -> DataFrame:
    return docs.select(key, F.posexplode(chunks).alias("n", "chunk"))


def chunk_overlap(docs: DataFrame, key: str, text: str, limit: int = 800, overlap: int = 150) -> DataFrame:
    """(key, n, chunk) of all texts; empty and null texts give no chunk."""
    return _rows(docs, key, overlap_chunks(F.col(text).cast("string"), limit, overlap))


def chunk_headings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, chunk, keywords): texts cut before each heading, which stays with its part.

    A keyword section is taken out first.  A part under STUB characters goes to the
    end of the one before; the first part is never merged.
    """
    t = F.col(text).cast("string")
    said = F.regexp_extract(t, KEYWORDS, 1)
    words = F.flatten(F.transform(F.split(said, "\n"), lambda line: F.transform(F.split(F.regexp_replace(strip(line), r"^-+", ""), r"[,，]"), strip)))
    rest = strip(F.regexp_replace(t, KEYWORDS, ""))
    parts = _filled(F.split(rest, HEADING))

    def merge(done, p):
        short = (F.length(p) < STUB) & (F.size(done) > 0)
        return F.when(short, F.array_append(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.concat(F.element_at(done, -1), F.lit("\n"), p))).otherwise(F.array_append(done, p))

    merged = F.aggregate(parts, F.array().cast("array<string>"), lambda done, p: F.when(F.size(done) == 0, F.array(p)).otherwise(merge(done, p)))
    keywords = F.array_join(F.filter(words, lambda w: w != ""), ",")
    return docs.select(key, F.posexplode(merged).alias("n", "chunk"), keywords.alias("keywords"))


def chunk_family(docs: DataFrame, key: str, text: str, parent: int = 1000, child: int = 250) -> DataFrame:
    """(key, parent_n, n, parent, chunk): large chunks, which overlap by 100 characters, and the small ones made of each, by 50."""
    above = docs.select(key, F.posexplode(overlap_chunks(F.col(text).cast("string"), parent, 100)).alias("parent_n", "parent"))
    return above.select(key, "parent_n", "parent", F.posexplode(child_chunks(F.col("parent"), child, 50)).alias("n", "chunk")).select(key, "parent_n", "n", "parent", "chunk")


def chunk_semantic(rows: DataFrame, key: str, order: str, text: str, vector: str, least: float = 0.6) -> DataFrame:
    """(key, n, chunk): sentences in order, parted where neighbours' cosine is below ``least``."""
    w = W.partitionBy(key).orderBy(order)
    cut = F.when(cosine(F.lag(vector).over(w), F.col(vector)) < least, 1).otherwise(0)
    rows = rows.withColumn("_cut", cut).withColumn("n", F.sum("_cut").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return rows.groupBy(key, "n").agg(F.array_join(F.transform(parts, lambda x: x["t"]), " ").alias("chunk"))


def sentence_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, sentence) of all texts, for ``chunk_semantic`` once they have vectors."""
    return docs.select(key, F.posexplode(_filled(sentences(F.col(text).cast("string")))).alias("place", "sentence"))


def chunk_by_category(docs: DataFrame, key: str, text: str, category: str) -> DataFrame:
    """(key, way, n, chunk): rule texts by heading, all others by size with overlap."""
    ruled = F.coalesce(F.col(category).isin(*BY_HEADING), F.lit(False))
    a = chunk_headings(docs.where(ruled), key, text).select(key, F.lit("headings").alias("way"), "n", "chunk")
    return a.unionByName(chunk_overlap(docs.where(~ruled), key, text).select(key, F.lit("overlap").alias("way"), "n", "chunk"))


def row_sentence(name: str, season: str, fields: list[str]) -> Column:
    """"name season: field=value, ..." of a row; fields without a value are left out."""
    pairs = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in fields]))
    return F.concat(F.col(name).cast("string"), F.lit(" "), F.col(season).cast("string"), F.lit(": "), F.array_join(pairs, ", "))
