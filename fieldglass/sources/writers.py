"""Writers: reports, and tables of parquet kept up to date by key or by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def csv_report(df: DataFrame, path: str) -> None:
    """CSV with a header in each part; NULL is an empty field, an empty text a quoted one."""
    df.write.csv(path, header=True, mode="overwrite", nullValue="", emptyValue='""')


def json_report(df: DataFrame, path: str) -> None:
    """One JSON object a line, with NULL fields kept."""
    df.write.json(path, mode="overwrite", ignoreNullFields=False)


def upsert(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both by key; a NULL in ``new`` never overwrites a value. Keys are unique on either side."""
    rest = [c for c in target.columns if c not in keys]
    rows = target.alias("t").join(new.alias("n"), keys, "full")
    return rows.select(*keys, *[(F.coalesce(F.col(f"n.{c}"), F.col(f"t.{c}")) if c in new.columns else F.col(f"t.{c}")).alias(c) for c in rest])


def merge(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and those of ``target`` whose key is not among them; NULLs overwrite."""
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Writes ``df`` in place of just those partitions it has rows of; doing it again changes nothing.

    Rows are dealt by partition and a spread of 8, so a partition gets 8 files at
    most and a large one is not written by one task.
    """
    spread = F.pmod(F.xxhash64(*[c for c in df.columns if c not in by][:4] or [F.lit(0)]), F.lit(8))
    df.repartition(*by, spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
