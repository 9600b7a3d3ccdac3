"""Array helpers that stay inside Spark's expression engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

def total(values: Column) -> Column:
    """Sum of a double array."""
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def packed(values: Column) -> Column:
    """An integer array in the narrowest of 8, 16 or 32 bits that holds all its values, for arrays that are shuffled; see ``unpacked``."""
    low, high = F.array_min(values), F.array_max(values)

    def fits(bits: int) -> Column:
        return (low >= -(1 << (bits - 1))) & (high < 1 << (bits - 1))

    bits = F.when(fits(8), 8).when(fits(16), 16).otherwise(32)
    return F.struct(
        F.when(bits == 8, values.cast("array<tinyint>")).alias("b8"),
        F.when(bits == 16, values.cast("array<smallint>")).alias("b16"),
        F.when(bits == 32, values).alias("b32"),
    )


def unpacked(values: Column) -> Column:
    """The integer array that ``packed`` was given."""
    return F.coalesce(values["b8"].cast("array<int>"), values["b16"].cast("array<int>"), values["b32"])


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``, which may use it many times.

    The optimizer merges projections, so an array computed in an earlier ``select`` would otherwise be computed again
    for every cell of a lambda that mentions it.
    """
    return F.transform(F.array(value), body)[0]
