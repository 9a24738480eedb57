"""Rate metrics as columns; NULL counts as 0 and an empty denominator gives the default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def num(c: Column | str) -> Column:
    """A numeric column with NULL as 0."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def ratio(top: Column, bottom: Column, digits: int | None = None, default: float | None = 0.0) -> Column:
    """top / bottom as double where bottom > 0, else ``default``."""
    x = F.when(bottom > 0, top.cast("double") / bottom.cast("double")).otherwise(F.lit(default).cast("double"))
    return x if digits is None else F.round(x, digits)


def half_up(above: str, below: str, places: int) -> Column:
    """above / below of whole, non-negative SQL expressions, rounded half up by whole numbers; null where below is 0."""
    return F.when(F.expr(below) != 0, F.expr(f"({2 * 10**places} * ({above}) + ({below})) div nullif(2 * ({below}), 0)").cast("double") / 10**places)
