"""Masked statistics over cell tables (one row per value and mask) and handling of nested statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.plans.staging import staged_with

# Fixed value: keeps the whitening factor finite.
WHITEN_EPS = 1e-8
EMPTY_MASK = "the mask is empty, a variance does not exist"


def mean_of(value: Column, mask: Column) -> Column:
    """Aggregate ``sum(v * m) / sum(m)``; NULL when nothing is masked in."""
    return F.try_divide(F.sum(value * mask), F.sum(mask))


def var_of(value: Column, mask: Column, unbiased: bool = True) -> Column:
    """Variance over the masked-in cells; unbiased form fails without cells and is NULL for one cell."""
    inside = F.when(mask == 1, value)
    if not unbiased:
        return F.var_pop(inside)
    failed = F.raise_error(F.lit(EMPTY_MASK)).cast("double")
    return F.when(F.coalesce(F.sum(mask), F.lit(0)) == 0, failed).otherwise(F.var_samp(inside))


def masked_mean(df: DataFrame, by: Sequence[str] = (), value: str = "value", mask: str = "mask") -> DataFrame:
    """Masked mean of all cells, or one per group."""
    return df.groupBy(*by).agg(mean_of(F.col(value), F.col(mask)).alias("masked_mean"))


def masked_var(df: DataFrame, by: Sequence[str] = (), value: str = "value", mask: str = "mask", unbiased: bool = True) -> DataFrame:
    """Masked variance of all cells, or one per group."""
    return df.groupBy(*by).agg(var_of(F.col(value), F.col(mask), unbiased).alias("masked_var"))


def masked_whiten(
    df: DataFrame, value: str = "value", mask: str = "mask", name: str = "whitened", shift_mean: bool = True
) -> DataFrame:
    """Centre and scale all cells by the masked mean and variance; masked-out cells are transformed too.

    The cells are written once, the statistics are observed on the way: ``df`` is computed once, and its cells are read
    once afterwards.
    """
    v, m = F.col(value), F.col(mask)
    held, stats = staged_with(df, "cells", F.sum(m).alias("n"), mean_of(v, m).alias("mean"), F.var_samp(F.when(m == 1, v)).alias("var"))
    return held.withColumn(name, whitened(F.col(value), stats, shift_mean))


def whitened(value: Column, stats: dict, shift_mean: bool = True) -> Column:
    """A value by observed ``n``, ``mean`` and ``var``; without masked-in cells that is an error, with one it is NULL."""
    if not stats["n"]:
        return F.raise_error(F.lit(EMPTY_MASK)).cast("double")
    if stats["var"] is None:
        return F.lit(None).cast("double")
    scaled = (value - F.lit(stats["mean"])) / F.lit((stats["var"] + WHITEN_EPS) ** 0.5)
    return scaled if shift_mean else scaled + F.lit(stats["mean"])


def flatten_stats(df: DataFrame, sep: str = "/") -> DataFrame:
    """Nested structs to flat ``a/b`` columns; a key that contains the separator is an error."""
    flat: list[Column] = []

    def walk(fields: list[T.StructField], path: list[str]) -> None:
        for field in fields:
            if sep in field.name:
                raise ValueError(f"field {field.name!r} holds {sep!r}, the separator of nested names")
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType.fields, here)
            else:
                flat.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))

    walk(df.schema.fields, [])
    return df.select(*flat)


def stack_and_mean_stats(df: DataFrame, by: Sequence[str], prefix: str = "ppo/") -> DataFrame:
    """Mean of every statistics column over the mini-batches of a step, with a prefix."""
    names = [c for c in df.columns if c not in by and c != "mini_batch"]
    return df.groupBy(*by).agg(*[F.avg(F.col(f"`{c}`")).alias(prefix + c) for c in names])
