"""Joins against a smaller table whose size is checked before it is broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 8 for each plain value, the octets of text, 8 for each element of an array."""
    fixed, parts = 0, []
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            parts.append(F.octet_length(field.name))
        elif isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.ArrayType, T.StructType, T.MapType)):
            parts.append(F.size(field.name) * 8)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.octet_length(F.to_json(field.name)))
        else:
            fixed += 8
    return reduce(lambda a, b: a + F.coalesce(b, F.lit(0)), parts, F.lit(fixed)).cast("long")


def fits_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a table (one narrow aggregate) against the broadcast limits."""
    size = small.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(small)), F.lit(0)).alias("bytes")).first()
    return size["n"] <= max_rows and size["bytes"] <= max_bytes


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join on columns of the same names where two NULLs are equal, so a group without a key keeps its rows."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    condition = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on]
    return left.join(F.broadcast(renamed) if small else renamed, condition, how).drop(*[f"_right_{c}" for c in on])


def lookup(
    df: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    null_safe: bool = False,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``df`` to ``small``, which holds one row per key.

    Within the limits ``small`` is broadcast and ``df`` does not move. Beyond them both are shuffled by key, and the
    adaptive planner splits the partitions that a hot key fills: only the rows of ``small`` that belong to those
    partitions are read more than once, cold keys never. ``null_safe`` is for keys of groups: a NULL finds a NULL.
    """
    fits = fits_broadcast(small, max_rows, max_bytes)
    if null_safe:
        return join_null_safe(df, small, on, how, fits)
    return df.join(F.broadcast(small) if fits else small, list(on), how)
