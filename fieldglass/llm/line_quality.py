"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised (trimmed, lower case, runs of white space as one blank,
digit runs as 0) and hashed.  Per host, the distinct documents that hold a line
are counted in two steps, first by (host, line, document), so the count of a
line in a third of all rows is summed from many tasks.  A line above the limit is
removed from every document of the host but the first that has it, and documents
left with too small a share of their words are rejected.  The lines above the
limit are few (a host cannot have more of them than its words allow) and are
joined back by (host, line, salt), so a frequent line is spread as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALTS = 16
_SPLIT = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPLIT), lambda w: w != "")


def repeat_words(words: Column, size: int = 3) -> Column:
    """How many words lie in ``size``-word windows that occur more than once in the text.

    Windows are first compared by hash, which settles texts without repeats.  In
    the others, windows are sorted by their words and then place, those equal to a
    neighbour give the places, and sorted places give the words covered.
    """
    return _let(words, lambda w: _repeats(w, size)).cast("long")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; a plain Column would be computed for every use in a lambda."""
    return F.transform(F.array(value), body)[0]


def _repeats(words: Column, size: int) -> Column:
    n = F.size(words) - size + 1
    at = F.sequence(F.lit(1), n)
    gram = lambda i: [F.element_at(words, (i + k).cast("int")) for k in range(size)]
    some = F.size(F.array_distinct(F.transform(at, lambda i: F.xxhash64(*gram(i))))) < n
    order = F.sort_array(F.transform(at, lambda i: F.struct(F.concat_ws(" ", *gram(i)).alias("w"), i.alias("i"))))
    return F.when(n < 2, F.lit(0)).when(some, _let(order, lambda o: _covered(_equal_places(o), size))).otherwise(F.lit(0))


def _equal_places(order: Column) -> Column:
    """Places of the entries of a sorted array that equal a neighbour."""
    same = lambda x, k: F.coalesce(F.get(order, k)["w"] == x["w"], F.lit(False))
    return F.transform(F.filter(order, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])


def _covered(places: Column, size: int) -> Column:
    """Words in windows that start at the places given."""
    step = F.aggregate(
        F.sort_array(places),
        F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(i - s["last"], F.lit(size))).cast("int").alias("n"), i.cast("int").alias("last")),
    )
    return step["n"]


def normal_line(line: Column) -> Column:
    """What two lines must have in common to count as one."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(line, _SPLIT, " "))), "[0-9]+", "0")


def base_rules(docs: DataFrame, text: str = "text") -> list[Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a column named ``text``."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return [
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, _SPLIT, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.col("_repeat").alias("n_repeat_words"),
    ]


def quality(docs: DataFrame, host: str = "source", min_docs: int = 20, share: float = 0.02, least_left: float = 0.3, most_docs: int = 1000) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base figures, base_failed, n_removed_words and kept.

    A line is above the limit if more than max(min_docs, share * documents of the
    host) documents of the host hold it, or more than ``most_docs`` whatever the
    host's size.  Its words are removed from all of these but the one with the least
    doc_id.  kept is false if base_failed, or if fewer
    than ``least_left`` of the words are left.

    Null or empty texts have no words and so fail the base rules.  A null host is
    a host of its own.  Rows that repeat a doc_id with the same text count as one
    document and get the same result each; a null doc_id is one document too.
    Other columns are not looked at.
    """
    own, lines = _parts(docs, host)
    gone = _removed(lines, own, min_docs, share, most_docs)
    figures = own.withColumn("_words", words_of(F.col("text"))).withColumn("_repeat", repeat_words(F.col("_words"))).select("_id", "_key", *base_rules(own))
    bad = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    total = gone.groupBy(F.col("_id").alias("_gid"), F.col("_key").alias("_gkey")).agg(F.sum("words").alias("removed"))
    both = figures.join(total, F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_key") == F.col("_gkey")), "left")
    removed = F.coalesce("removed", F.lit(0)).cast("long")
    return both.select(
        F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        bad.alias("base_failed"), removed.alias("n_removed_words"),
        (~bad & ((F.col("n_words") - removed) >= F.lit(least_left) * F.col("n_words"))).alias("kept"),
    )


def _parts(docs: DataFrame, host: str) -> tuple[DataFrame, DataFrame]:
    """(documents, their distinct lines with the words each takes up)."""
    own = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.concat(F.lit("h"), F.col(host).cast("string")), F.lit("")).alias("_host"), F.col("text").cast("string").alias("text"))
    own = own.withColumn("_key", F.xxhash64("_host", F.coalesce("text", F.lit(""))))
    line = F.explode(F.split(F.coalesce("text", F.lit("")), "\n"))
    lines = own.select("_host", "_id", "_key", line.alias("line")).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return own, lines.select("_host", "_id", "_key", F.xxhash64(normal_line(F.col("line"))).alias("_line"), F.size(words_of(F.col("line"))).alias("words"))


def _removed(lines: DataFrame, own: DataFrame, min_docs: int, share: float, most_docs: int) -> DataFrame:
    """The lines to remove: _id, _key, _line and the words they take up in the document."""
    hosts = own.groupBy("_host").agg(F.count_distinct(F.coalesce(F.col("_id").cast("string"), F.lit("null"))).alias("docs"))
    held = lines.groupBy("_host", "_line", "_id").agg(F.lit(1).alias("one")).groupBy("_host", "_line").agg(F.count("*").alias("n"), F.min("_id").alias("first"))
    often = held.where(F.col("n") > min_docs).join(hosts, "_host").where((F.col("n") > share * F.col("docs")) | (F.col("n") > most_docs))
    often = often.select(F.col("_host").alias("_h"), F.col("_line").alias("_l"), "first", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_s"))
    salt = F.pmod(F.xxhash64("_id"), F.lit(_SALTS)).cast("int")
    hit = lines.join(often, (F.col("_host") == F.col("_h")) & (F.col("_line") == F.col("_l")) & (salt == F.col("_s"))).where(~F.col("_id").eqNullSafe(F.col("first")))
    return hit.select("_id", "_key", "_line", "words")


def filtered(docs: DataFrame, host: str = "source", min_docs: int = 20, share: float = 0.02, least_left: float = 0.3, most_docs: int = 1000) -> DataFrame:
    """The rows that are kept, with their columns, frequent lines taken out of ``text`` and n_chars following it.

    Edge cases as in ``quality``.
    """
    own, lines = _parts(docs, host)
    gone = _removed(lines, own, min_docs, share, most_docs).groupBy(F.col("_id").alias("_gid"), F.col("_key").alias("_gkey")).agg(F.sum("words").alias("_removed"), F.collect_set("_line").alias("_gone"))
    # the row goes along as one column, so no name of its own meets those used here
    doc = F.col("doc")
    key = F.xxhash64(F.coalesce(F.concat(F.lit("h"), doc[host].cast("string")), F.lit("")), F.coalesce(doc["text"].cast("string"), F.lit("")))
    rows = docs.select(F.struct("*").alias("doc")).select("doc", doc["doc_id"].cast("long").alias("_id"), key.alias("_key"))
    both = rows.join(gone, F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_key") == F.col("_gkey")), "left")
    both = both.withColumn("_words", words_of(doc["text"])).withColumn("_n", F.size("_words"))
    left = F.col("_n") - F.coalesce("_removed", F.lit(0))
    good = both.where((F.col("_n") >= 50) & (left >= F.lit(least_left) * F.col("_n"))).where(100 * repeat_words(F.col("_words")) <= 50 * F.col("_n"))
    kept = F.array_join(F.filter(F.split(doc["text"], "\n"), lambda x: ~F.array_contains(F.col("_gone"), F.xxhash64(normal_line(x)))), "\n")
    text = F.when(F.col("_gone").isNull(), doc["text"]).otherwise(kept)
    out = good.select("doc", text.alias("_kept"))
    return out.select(*[F.col("_kept").alias(c) if c == "text" else F.length("_kept").cast("long").alias(c) if c == "n_chars" else doc[c].alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY 1),
ln AS (SELECT doc_id, host, line, regexp_replace(lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))), '[0-9]+', '0', 'g') AS norm,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
    FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY 1),
hosts AS (SELECT host, count(DISTINCT doc_id) AS docs FROM d GROUP BY 1),
often AS (SELECT host, norm, min(doc_id) AS first FROM ln JOIN hosts USING (host) GROUP BY host, norm, docs
    HAVING count(DISTINCT doc_id) > 20 AND (count(DISTINCT doc_id) > 0.02 * docs OR count(DISTINCT doc_id) > 1000)),
gone AS (SELECT ln.doc_id, sum(words) AS n FROM ln JOIN often USING (host, norm) WHERE ln.doc_id <> often.first GROUP BY 1),
f AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
    FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_removed_words,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed_words >= 0.3 * n_words AS kept
FROM f
"""
