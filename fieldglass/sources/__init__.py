"""Readers and writers beyond plain parquet."""

from .published import KeyedTable, follow
from .readers import csv_table, golden_queries, html_tables, html_text, json_table, markdown_documents, relay_upload, since, stream_rows
from .writers import csv_report, json_report, merge, replace_partitions, upsert

__all__ = ["KeyedTable", "csv_report", "csv_table", "follow", "golden_queries", "html_tables", "html_text", "json_report", "json_table", "markdown_documents", "merge", "relay_upload", "replace_partitions", "since", "stream_rows", "upsert"]
