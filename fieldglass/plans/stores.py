"""Keyed writes, replay, event keys, saved pages and chunks on the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunking
from ..registry import Tables, query
from ..operators.stored import shared_folder, state_of
from ..sources import KeyedTable, html_tables, html_text, merge, published, upsert
from ..streaming import changed_only, purged, replay
from ..streaming.live import event_key

_NEW = "SELECT c_custkey + 700 AS c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'new' END AS c_mktsegment, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 99 END AS c_nationkey FROM customer"


def _sides(t: Tables):
    old = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    k = F.col("c_custkey")
    return old, old.select((k + 700).alias("c_custkey"), F.when(k % 3 > 0, "new").alias("c_mktsegment"), F.when(k % 4 > 0, 99).alias("c_nationkey"))


@query("s15_upsert", f"SELECT c_custkey, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment, coalesce(n.c_nationkey, o.c_nationkey) AS c_nationkey FROM customer o FULL JOIN ({_NEW}) n USING (c_custkey)")
def s15(t: Tables):
    """A NULL never overwrites."""
    return upsert(*_sides(t), ["c_custkey"])


@query("s16_merge", f"WITH n AS ({_NEW}) SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM n) UNION ALL SELECT * FROM n")
def s16(t: Tables):
    """A NULL overwrites."""
    return merge(*_sides(t), ["c_custkey"])


_ORDERS = "o_orderkey long, o_orderstatus string, o_orderdate timestamp, year int"
_KEPT: dict = {}


def _published_orders(t: Tables) -> str:
    """The orders as a published table of files by ranges of keys, with zone maps; written at the first call."""
    path = f"{t.folder}/orders.parquet"
    key = (t.spark.sparkContext.applicationId, *state_of(t.spark, path))
    if key not in _KEPT:
        folder = shared_folder(t.spark)
        rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate", F.year("o_orderdate").alias("year"))
        published.write(rows.repartitionByRange(16, "o_orderkey"), folder, zones=["o_orderkey"])
        _KEPT[key] = folder
    return _KEPT[key]


@query("s12_zone_page", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 500")
def s12_zones(t: Tables):
    """A page after a key, from the files whose zone maps say that they may hold it."""
    return published.page(t.spark, _published_orders(t), _ORDERS, "o_orderkey", 5000, 500).select("o_orderkey", "o_orderstatus")


@query("s18_zone_since", "SELECT o_orderkey FROM orders WHERE o_orderkey >= (SELECT max(o_orderkey) * 9 // 10 FROM orders)")
def s18_zones(t: Tables):
    """What a mark or later is, without opening files that end before it."""
    path = _published_orders(t)
    mark = max(f["zones"]["o_orderkey"][1] for f in published.manifest(path)["files"]) * 9 // 10
    return published.since(t.spark, path, _ORDERS, "o_orderkey", mark).select("o_orderkey")


@query("s17_replaced_years", "SELECT o_orderkey, year(o_orderdate)::INT AS year FROM orders WHERE year(o_orderdate) NOT IN (1995, 1996) OR (year(o_orderdate) = 1995 AND o_orderstatus = 'F')")
def s17(t: Tables):
    """Two years are rebuilt; one of them has no rows any more and goes."""
    folder = shared_folder(t.spark)
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate", F.year("o_orderdate").alias("year"))
    published.write(rows, folder, by="year")
    published.write(rows.where("year = 1995 AND o_orderstatus = 'F'"), folder, by="year", replace=[1995, 1996])
    return published.read(t.spark, folder, _ORDERS).select("o_orderkey", "year")


@query("m07_keyed_batches", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'second' ELSE c_mktsegment END AS c_mktsegment, c_nationkey FROM customer UNION ALL SELECT c_custkey + 1000000, NULL, 7 FROM customer WHERE c_custkey % 50 = 0")
def m07(t: Tables):
    """Two batches of changes to a keyed table; the second comes twice and counts once."""
    table = KeyedTable(shared_folder(t.spark), "c_custkey long, c_mktsegment string, c_nationkey int", ["c_custkey"], buckets=8)
    k = F.col("c_custkey")
    table.apply(t.customer.select("c_custkey", "c_mktsegment", "c_nationkey"), 0)
    changed = t.customer.select("c_custkey", F.when(k % 3 == 0, "second").alias("c_mktsegment"), F.lit(None).cast("int").alias("c_nationkey"))
    second = changed.unionByName(t.customer.where(k % 50 == 0).select((k + 1000000).alias("c_custkey"), F.lit(None).cast("string").alias("c_mktsegment"), F.lit(7).alias("c_nationkey")))
    table.apply(second, 1)
    table.apply(second, 1)
    return table.read(t.spark)


@query("m02_replay", "SELECT user_id, count(*) AS n, string_agg(event_type, ',' ORDER BY event_id) AS buffer FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= 500 GROUP BY 1")
def m02(t: Tables):
    """The last 500 events of each game, oldest first."""
    x = replay(t.events, "user_id", "event_id", "event_type")
    return x.select("user_id", F.size("buffer").cast("long").alias("n"), F.array_join("buffer", ",").alias("buffer"))


@query("m03_purged", "SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 480)")
def m03(t: Tables):
    """Games that have ended leave the buffer."""
    return purged(t.events, t.events.where("event_type = 'error' and value > 480"), "user_id").select("event_id")


@query("m04_event_keys", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'log' || event_id::VARCHAR WHEN event_id % 3 = 1 THEN ' ' ELSE substr(sha256((event_id % 9)::VARCHAR || ':' || event_id::VARCHAR || ':' || event_type), 1, 16) END AS key FROM events")
def m04(t: Tables):
    """The provider's id, blank ones too, else a hash."""
    x = t.events.selectExpr("event_id", "event_type", "event_id % 9 AS inning", "CASE WHEN event_id % 3 = 0 THEN concat('log', event_id) WHEN event_id % 3 = 1 THEN ' ' WHEN event_id % 2 = 0 THEN '' END AS log_id")
    return x.select("event_id", event_key("log_id", "inning", "event_id", "event_type").alias("key"))


@query("m05_changed_polls", "SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) WHERE p IS NULL OR p <> event_type")
def m05(t: Tables):
    """Polls whose payload is as before are left out."""
    return changed_only(t.events, "user_id", "event_id", "event_type").select("user_id", "event_id", "event_type")


@query("s07_page_tables", "SELECT o_orderkey, 0 AS \"table\", r::INT AS row, CASE r WHEN 0 THEN 'key|key|status' ELSE o_orderkey::VARCHAR || '|R & ' || o_orderstatus || '|' END AS cells FROM orders, (SELECT unnest([0, 1]) AS r) UNION ALL SELECT o_orderkey, 1, 0, o_custkey::VARCHAR FROM orders")
def s07(t: Tables):
    """Rows of tables in pages: references decoded, a wide cell in each of its columns, inner tables apart."""
    html = F.concat(F.lit("<table><tr><th colspan=2>key<th>status</tr><tr><td>"), F.col("o_orderkey").cast("string"), F.lit("</td><td>R &amp;\n "), F.col("o_orderstatus"), F.lit("<td><table><td>"), F.col("o_custkey").cast("string"), F.lit("</table></td></tr></table>"))
    return html_tables(t.orders.select("o_orderkey", html.alias("html")), "o_orderkey", "html").select("o_orderkey", "table", "row", F.array_join("cells", "|").alias("cells"))


@query("s08_page_text")
def s08(t: Tables):
    """Paragraphs of saved pages."""
    return html_text(t.pages, "page_id", "html", "p")


@query("c01_overlap_chunks")
def c01(t: Tables):
    """Chunks of 800 characters of every text; folds have no SQL and are tested against plain Python."""
    return chunking.chunk_overlap(t.documents, "doc_id", "text")


@query("c02_heading_chunks")
def c02(t: Tables):
    return chunking.chunk_headings(t.documents, "doc_id", "text")


@query("c03_parent_child_chunks")
def c03(t: Tables):
    return chunking.chunk_family(t.documents, "doc_id", "text")


@query(
    "c04_semantic_chunks",
    "WITH s AS (SELECT vec_id // 20 AS doc, vec_id AS o, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), c AS (SELECT *, CASE WHEN list_cosine_similarity(lag(v) OVER (PARTITION BY doc ORDER BY o), v) < 0.6 THEN 1 ELSE 0 END AS cut FROM s), n AS (SELECT *, sum(cut) OVER (PARTITION BY doc ORDER BY o) AS n FROM c) SELECT doc, n::INT AS n, string_agg('s' || o::VARCHAR, ' ' ORDER BY o) AS chunk FROM n GROUP BY 1, 2",
)
def c04(t: Tables):
    """Neighbours whose vectors are far apart are parted."""
    x = t.embeddings.selectExpr("vec_id div 20 AS doc", "vec_id AS o", "concat('s', vec_id) AS s", "embedding")
    return chunking.chunk_semantic(x, "doc", "o", "s", "embedding")


@query("c05_chunks_by_category")
def c05(t: Tables):
    """Rule texts go by heading, others by size."""
    return chunking.chunk_by_category(t.documents.withColumn("c", F.when(F.col("lang") == "de", "rules").otherwise(F.col("source"))), "doc_id", "text", "c")
