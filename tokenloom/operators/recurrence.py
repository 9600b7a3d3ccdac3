"""Backward recurrences over array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.arrays import bind

# Cells that a fold appends to one array: what it copies at an append.
BLOCK = 16


def _block_sums(values: Column, carry: Column, decay: float) -> Column:
    """The recurrence inside one block; the carry from the next block stands behind it."""

    def put(later: Column, x: Column) -> Column:
        # a missing number spoils what stands before it, as NaN
        return F.concat(F.array(F.coalesce(x, F.lit(float("nan"))) + F.lit(decay) * F.get(later, F.lit(0))), later)

    return F.aggregate(F.reverse(values), F.array(carry), put)


def _suffix_sums(values: Column, decay: float) -> Column:
    """The recurrence over one row, block by block from the last one."""
    last = F.floor((F.size(values) - 1) / F.lit(BLOCK)).cast("int")

    def put(later: Column, b: Column) -> Column:
        own = F.slice(values, b * BLOCK + 1, F.lit(BLOCK))
        return F.concat(F.array(_block_sums(own, F.get(F.get(later, F.lit(0)), F.lit(0)), decay)), later)

    blocks = F.aggregate(F.reverse(F.sequence(F.lit(0), last)), F.array(F.array(F.lit(0.0))), put)
    # the first carry is a block of its own, and each block ends with its carry
    return F.flatten(F.transform(blocks, lambda cells: F.slice(cells, F.lit(1), F.size(cells) - 1)))


def discounted_suffix_sums(df: DataFrame, values: Column, decay: float, name: str) -> DataFrame:
    """Add ``name`` with ``out[t] = values[t] + decay * out[t+1]`` for every row. No row moves or leaves the JVM.

    A fold copies its growing output at every append, so a row is folded block by block; the closed form would divide by powers
    of ``decay`` that vanish on long arrays. Other columns of the row are not touched, so a plan reads only what it needs.
    """
    held = values.cast("array<double>")
    sums = bind(held, lambda v: F.when(F.size(v) == 0, v).when(v.isNotNull(), _suffix_sums(v, decay)))
    return df.withColumn(name, sums)
