"""Tables of named vectors: lookup, shard merge, inventories, quantization reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.vectors import quantize_groups
from tokenloom.plans.lookups import lookup
from tokenloom.plans.running import BUCKET_WIDTH, blocks, running

# Tensors that are joined along their columns; every other matrix is joined along its rows.
COLUMN_PREFIXES = ("tok_embeddings.",)
COLUMN_SUFFIXES = (".attention.wo.weight", ".feed_forward.w2.weight")


def embedding_lookup(tokens: DataFrame, vectors: DataFrame, key: Sequence[str], ids: str = "ids") -> DataFrame:
    """One vector per token: (key, pos, id, embedding). An id without a vector fails the job."""
    long = tokens.select(*key, F.posexplode(ids).alias("pos", "id"))
    found = lookup(long, vectors.select("id", "embedding"), ["id"], "left")
    missing = F.raise_error(F.lit("a token id has no vector")).cast(vectors.schema["embedding"].dataType)
    return found.withColumn(
        "embedding", F.when(F.col("embedding").isNull(), missing).otherwise(F.col("embedding"))
    )


def key_diff(have: DataFrame, want: DataFrame, key: str) -> DataFrame:
    """Keys that are wanted but absent (``missing``) and present but not wanted (``unexpected``)."""
    here = have.select(key, F.lit(True).alias("_here"), F.lit(False).alias("_there"))
    there = want.select(key, F.lit(False).alias("_here"), F.lit(True).alias("_there"))
    sides = here.unionByName(there).groupBy(key).agg(F.bool_or("_here").alias("_here"), F.bool_or("_there").alias("_there"))
    status = F.when(F.col("_here"), F.lit("unexpected")).otherwise(F.lit("missing"))
    return sides.where(F.col("_here") != F.col("_there")).select(key, status.alias("status"))


def _by_columns():
    name = F.col("name")
    test = F.lit(False)
    for prefix in COLUMN_PREFIXES:
        test = test | name.startswith(prefix)
    for suffix in COLUMN_SUFFIXES:
        test = test | name.endswith(suffix)
    return test


def merge_vector_shards(parts: DataFrame, width: int = BUCKET_WIDTH) -> DataFrame:
    """Merge (name, ndim, part, row_idx, vec) into whole tensors (name, ndim, row_idx, vec).

    One-dimensional tensors and tensors with a single part are taken from the first part. Column-split matrices gather
    the parts of one row, row-split matrices get running row numbers in (part, row) order.
    """
    first = parts.groupBy("name").agg(F.min("part").alias("_first"), F.max("part").alias("_last"))
    known = lookup(parts, first, ["name"], null_safe=True)
    single = (F.col("ndim") == 1) | (F.col("_first") == F.col("_last"))
    columns = ["name", "ndim", "row_idx", "vec"]
    taken = known.where(single & (F.col("part") == F.col("_first"))).select(*columns)
    matrix = known.where(~single)
    wide = (
        matrix.where(_by_columns())
        .groupBy("name", "ndim", "row_idx")
        .agg(F.array_sort(F.collect_list(F.struct("part", "vec"))).alias("_parts"))
        .select("name", "ndim", "row_idx", F.flatten("_parts.vec").alias("vec"))
    )
    tall = running(
        matrix.where(~_by_columns()),
        group=["name"],
        bucket=[F.col("part"), blocks("row_idx", width)],
        order=["part", "row_idx"],
        value=F.lit(1).cast("long"),
        kind="sum",
        name="_row",
    ).select("name", "ndim", F.col("_row").alias("row_idx"), "vec")
    as_long = F.col("row_idx").cast("long").alias("row_idx")
    result = None
    for piece in (taken, wide, tall):
        piece = piece.select("name", "ndim", as_long, "vec")
        result = piece if result is None else result.unionByName(piece)
    return result


def parameter_inventory(weights: DataFrame) -> DataFrame:
    """Tensors and elements with two or more dimensions (decayed) against the others."""
    tensors = weights.groupBy("name").agg(
        F.max("ndim").alias("ndim"), F.sum(F.size("vec").cast("long")).alias("numel")
    )
    return tensors.groupBy((F.col("ndim") >= 2).alias("decayed")).agg(
        F.count(F.lit(1)).alias("tensors"), F.sum("numel").alias("elements")
    )


def quantize_q80(df: DataFrame, key: Sequence[str], group_size: int, vec: str = "vec") -> DataFrame:
    """One row per group: (key, group_id, scale, codes, max_error). No shuffle."""
    groups = F.posexplode(quantize_groups(F.col(vec), group_size)).alias("group_id", "g")
    return df.select(*key, groups).select(*key, "group_id", "g.*")


def quant_error_report(groups: DataFrame) -> DataFrame:
    """Largest error per tensor, worst first, with the overall worst."""
    worst = groups.groupBy("name").agg(F.max("max_error").alias("max_error"))
    overall = worst.agg(F.max("max_error")).scalar()
    return worst.withColumn("overall_max_error", overall).orderBy(F.desc("max_error"), F.desc("name"))
