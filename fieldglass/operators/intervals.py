"""Joins by validity range, without comparing every row with every range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pieces(lo: Column, hi: Column, top: int) -> Column:
    """The aligned blocks (level, number) that make up [lo, hi], two of a level at most, of levels up to ``top``.

    Block n of level k holds the places from n * 2**k to (n + 1) * 2**k - 1.  Going up,
    an odd first block and an even last one are pieces of their own; what is left
    between them is blocks of the next level.
    """
    start = F.struct(lo.alias("a"), (hi + 1).alias("b"), F.array().cast("array<struct<level: int, block: bigint>>").alias("out"))

    def piece(level: Column, block: Column) -> Column:
        return F.array(F.struct(level.cast("int").alias("level"), block.cast("bigint").alias("block")))

    def up(state: Column, level: Column) -> Column:
        a, b, out, none = state["a"], state["b"], state["out"], F.array().cast("array<struct<level: int, block: bigint>>")
        open_ = a < b
        first = open_ & (F.pmod(a, F.lit(2)) == 1)
        a2 = F.when(first, a + 1).otherwise(a)
        last = (a2 < b) & (F.pmod(b, F.lit(2)) == 1)
        b2 = F.when(last, b - 1).otherwise(b)
        found = F.concat(out, F.when(first, piece(level, a)).otherwise(none), F.when(last, piece(level, b - 1)).otherwise(none))
        half = lambda x: F.when(open_, F.shiftright(x, 1)).otherwise(F.lit(0).cast("bigint"))
        return F.struct(half(a2).alias("a"), half(b2).alias("b"), found.alias("out"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(top)), start, up, lambda s: s["out"])


def _cut(rows: DataFrame, at: str, ranges: DataFrame, first: str, last: str) -> tuple[Column, int, int, DataFrame]:
    """The place of a row as a number, the least one, the highest level there is, and ``ranges`` with a row for each of its blocks (_level, _block)."""
    whole = lambda c: F.unix_date(c).cast("long") if dict(rows.dtypes)[at] == "date" else c.cast("long")
    place = whole(F.col(at))
    bounds = rows.agg(F.min(place).alias("low"), F.max(place).alias("high")).first()
    low, high = (bounds.low, bounds.high) if bounds.low is not None else (0, -1)
    top = (high - low + 1).bit_length()
    lo = F.greatest(F.coalesce(whole(F.col(first)), F.lit(low)), F.lit(low)) - low
    hi = F.least(F.coalesce(whole(F.col(last)), F.lit(high)), F.lit(high)) - low
    cut = ranges.withColumns({"_lo": lo.cast("bigint"), "_hi": hi.cast("bigint")}).where("_lo <= _hi")
    cut = cut.withColumn("_piece", F.explode(_pieces(F.col("_lo"), F.col("_hi"), top))).withColumns({"_level": F.col("_piece.level"), "_block": F.col("_piece.block")}).drop("_piece", "_lo", "_hi")
    return place, low, top, cut


def range_join(rows: DataFrame, at: str, ranges: DataFrame, first: str, last: str, keys: list[str] = ()) -> DataFrame:
    """``rows`` with each range that holds ``at`` (first <= at <= last) and has equal ``keys``.

    A NULL ``first`` or ``last`` is an open end; a NULL ``at`` or key is in no range,
    and neither is anything in a range that ends before it starts.  Places are whole
    numbers, dates too.  Ranges may overlap: each gives a row.  A range is cut into
    aligned blocks, two of a level at most and mostly a few, a row asks for the one block of
    each level that occurs, and both are joined by equality, so the work follows the
    rows and their results.  The least and the largest place and the levels are asked
    for at once.  Columns of both sides, but for ``keys``, must have names of their own.
    """
    place, low, _, cut = _cut(rows, at, ranges, first, last)
    used = [r._level for r in cut.select("_level").distinct().collect()]  # 65 numbers at most
    levels = F.array(*map(F.lit, sorted(used))) if used else F.array().cast("array<int>")
    asked = rows.where(place.isNotNull()).withColumn("_level", F.explode(levels)).withColumn("_off", place - low).withColumn("_block", F.expr("shiftright(_off, _level)")).drop("_off")
    return asked.join(cut, [*keys, "_level", "_block"]).drop("_level", "_block")


def range_totals(rows: DataFrame, at: str, ranges: DataFrame, first: str, last: str, value: str, keys: list[str] = ()) -> DataFrame:
    """``rows`` with n, least, most and total of ``value`` over the ranges that ``range_join`` gives them; rows in no range are left out.

    No pair of a row and a range is made, of which there are as many as rows times
    the ranges of a place: what ranges have in a block is added up first, then what
    the blocks of each different place have, and rows take the figures of their place.
    """
    place, low, top, cut = _cut(rows, at, ranges, first, last)
    one = [F.count("*").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"), F.sum(value).alias("total")]
    blocks = cut.groupBy(*keys, "_level", "_block").agg(*one)
    own = rows.where(place.isNotNull()).withColumn("_off", place - low)
    asked = own.select(*keys, "_off").distinct().withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top)))).withColumn("_block", F.expr("shiftright(_off, _level)"))
    more = [F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("total").alias("total")]
    known = asked.join(blocks, [*keys, "_level", "_block"]).groupBy(*keys, "_off").agg(*more)
    return own.join(known, [*keys, "_off"]).drop("_off")
