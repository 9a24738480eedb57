"""Readers: CSV, JSON, saved HTML, folders of Markdown, rows since a mark."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: The columns of an uploaded relay file.
RELAY = "game_id string, event_seq int, inning int, inning_half string, description string, home_score int, away_score int"

#: The fields a golden retrieval query has.
GOLDEN = "id string, query string, relevantChunkIds array<string>, expectedIntent string, expectedRoute string, tags array<string>"


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header; a value that does not fit its type becomes NULL, a line that cannot be parsed too."""
    return spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE", enforceSchema=False)


def json_table(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """JSON documents, one a file (an array gives a row an element), or one a line where ``lines``."""
    return spark.read.json(path, schema=schema, multiLine=not lines)


def golden_queries(spark: SparkSession, path: str) -> DataFrame:
    """Golden retrieval queries; rows without id or query are left out."""
    return json_table(spark, path, GOLDEN).where("id is not null and query is not null")


def relay_upload(spark: SparkSession, path: str) -> DataFrame:
    """Relay lines of an uploaded CSV with a header: rows without game_id or event_seq are left out, of equal pairs the last line stays.

    Lines are told apart by file and place, so the outcome does not depend on how the
    file is split.
    """
    rows = csv_table(spark, path, RELAY).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
    known = rows.where("game_id is not null and event_seq is not null")
    names = [c.split()[0] for c in RELAY.split(", ")]
    last = known.groupBy("game_id", "event_seq").agg(F.max_by(F.struct(*[c for c in names if c not in ("game_id", "event_seq")]), F.struct("_file", "_block", "_line")).alias("x"))
    return last.select("game_id", "event_seq", "x.*").select(*names)


class _Elements(HTMLParser):
    """Texts of elements and rows of tables of one page; character references are decoded."""

    def __init__(self, tag: str | None):
        super().__init__(convert_charrefs=True)
        self.tag, self.open, self.texts = tag, [], []
        self.tables, self.stack = [], []  # of a table: rows; open tables, innermost last

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            self.texts.append([])
            self.open.append(self.texts[-1])
        if tag == "table":
            self.tables.append([])
            self.stack.append((self.tables[-1], []))
        elif tag == "tr" and self.stack:
            self.stack[-1][0].append([])
        elif tag in ("td", "th") and self.stack:
            rows, cell = self.stack[-1]
            if not rows:
                rows.append([])
            span = next((v for k, v in attrs if k == "colspan"), None)
            text: list[str] = []
            rows[-1] += [text] * (int(span) if span and span.isdigit() and 0 < int(span) < 1000 else 1)
            self.stack[-1] = rows, text
        elif tag in ("br", "p", "div", "li"):
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag == self.tag and self.open:
            self.open.pop()
        if tag == "table" and self.stack:
            self.stack.pop()
        elif tag in ("td", "th") and self.stack:
            self.stack[-1] = self.stack[-1][0], []

    def handle_data(self, data):
        for text in self.open:
            text.append(data)
        if self.stack:
            self.stack[-1][1].append(data)


def _read(page: str | None, tag: str | None = None) -> _Elements:
    p = _Elements(tag)
    p.feed(page or "")
    p.close()
    return p


def _clean(text: list[str]) -> str:
    return " ".join("".join(text).split())


def html_text(pages: DataFrame, key: str, html: str, tag: str) -> DataFrame:
    """(key, n, text): the text of each element ``tag`` in page order from 0, nested ones too; null and empty pages give none."""
    ship(pages.sparkSession)

    @F.pandas_udf("array<string>")
    def texts(s: pd.Series) -> pd.Series:
        return s.map(lambda page: [_clean(t) for t in _read(page, tag.lower()).texts])

    return pages.select(key, F.posexplode(texts(F.coalesce(F.col(html).cast("string"), F.lit("")))).alias("n", "text"))


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table, row, cells): rows of the tables of each page, inner tables as tables of their own; a cell over several columns fills each."""
    ship(pages.sparkSession)

    @F.pandas_udf("array<array<array<string>>>")
    def tables(s: pd.Series) -> pd.Series:
        return s.map(lambda page: [[[_clean(c) for c in row] for row in rows] for rows in _read(page).tables])

    found = pages.select(key, F.posexplode(tables(F.coalesce(F.col(html).cast("string"), F.lit("")))).alias("table", "_t"))
    return found.select(key, "table", F.posexplode("_t").alias("row", "cells"))


# Folders of rule texts and the categories they stand for.
CATEGORIES = {
    "baseball_rules": "game_rules",
    "glossary": "glossary",
    "bylaws": "bylaws",
    "league_regulations": "league_regulations",
    "player_regulations": "player_regulations",
    "scoring_rules": "scoring_rules",
    "disciplinary_regulations": "disciplinary_regulations",
    "supplementary_regulations": "supplementary_regulations",
    "kbo_knowledge": "kbo_knowledge",
    "kbo_rulebook": "rulebook",
}


def markdown_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, category, subcategory, title, content) of every .md file below ``folder``.

    Of the folders between ``folder`` and the file that are known (CATEGORIES), the
    first one other than the rulebook's gives the category and the last one after it
    the subcategory; without one the category is ``rulebook``.  The title is the first
    line that is not blank, if it is a heading, else the file's name in title case.
    Files that are empty or not UTF-8 are left out.
    """
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(folder)
    files = read.select("path", F.try_validate_utf8(F.col("content").cast("string")).alias("content")).where("content is not null")
    first = F.regexp_extract("content", r"^\s*([^\n]*)", 1)
    heading = F.trim(F.regexp_replace(first, "^#+", ""))
    name = F.initcap(F.replace(F.regexp_extract("path", r"([^/]+)\.md$", 1), F.lit("_"), F.lit(" ")))
    root = folder.split(":", 1)[-1].rstrip("/").rsplit("/", 1)[-1]
    below = F.slice(F.split(F.regexp_extract("path", rf"(?s)^.*?/{re.escape(root)}/(.*)$", 1), "/"), 1, 99)
    names = F.create_map(*[F.lit(x) for pair in CATEGORIES.items() for x in pair])
    known = F.filter(F.transform(F.slice(below, 1, F.greatest(F.size(below) - 1, F.lit(0))), lambda p: F.try_element_at(names, p)), lambda c: c.isNotNull())
    # the rulebook's own name never ends the search for a category
    start = F.array_position(F.transform(known, lambda c: c != "rulebook"), True)
    category = F.when(start > 0, F.try_element_at(known, start.cast("int"))).otherwise("rulebook")
    rest = F.when(start > 0, F.slice(known, start.cast("int") + 1, 99)).otherwise(F.array().cast("array<string>"))
    return files.select("path", category.alias("category"), F.try_element_at(rest, F.lit(-1)).alias("subcategory"), F.when(first.startswith("#"), heading).otherwise(name).alias("title"), "content")


def since(df: DataFrame, changed: str, mark) -> DataFrame:
    """Rows changed at ``mark`` or later; all rows where there is none yet."""
    return df if mark is None else df.where(F.col(changed) >= F.lit(mark))


def stream_rows(df: DataFrame) -> Iterator[Row]:
    """Rows one partition at a time, so the driver holds one partition at most; for exports, not for joins or sums."""
    return df.toLocalIterator(prefetchPartitions=False)
