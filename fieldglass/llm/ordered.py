"""Places of rows in the order of their groups, without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Workspace


def numbered(rows: DataFrame, group: str, order: list[str], space: Workspace) -> DataFrame:
    """``rows`` with ``pos`` (from 0 by ``order``, nulls first, in the rows' group) and ``of`` (rows of the group); written.

    Rows are dealt out by ranges of (group, order), so a group of any size lies in
    many tasks; what is gathered is one line by range and group.  Rows alike in all
    of these are told apart by where they were read, and any of their places suits
    any of them.
    """
    own = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [group, *order, "_tie"]
    laid = space.write(own.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).drop("_tie"), "laid")
    part = F.shiftright("_at", 33).alias("_part")
    counts = laid.groupBy(part, F.col(group).alias("_group")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    w = W.partitionBy("_group")
    starts = counts.select("_part", "_group", "_first", F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(w).alias("of"))
    there = laid.withColumn("_in", F.shiftright("_at", 33))
    both = there.join(starts, (F.col("_in") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group")))
    out = space.write(both.select(*rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("pos"), "of"), "numbered")
    space.drop(laid)
    return out
