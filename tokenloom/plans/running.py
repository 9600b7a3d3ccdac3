"""Running values and positions over groups of any size.

A window partitioned by the group alone would put a hot group into one task. Here every group is cut into ordered
buckets: the window runs inside a bucket, the bucket totals (a small table) are accumulated per group, and the two are
combined. The big side is shuffled once, on (group, bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.plans.lookups import join_null_safe
from tokenloom.plans.staging import staged

BUCKET_WIDTH = 1 << 16


def blocks(position: Column | str, width: int = BUCKET_WIDTH) -> Column:
    """Bucket number of an integer position; at most ``width`` rows per bucket when positions are unique."""
    position = F.col(position) if isinstance(position, str) else position
    return F.floor(position / F.lit(width)).cast("long")


def running(
    df: DataFrame,
    *,
    group: Sequence[str],
    bucket: Sequence[Column],
    order: Sequence[str],
    value: Column,
    kind: str,
    name: str,
    inclusive: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: the ``kind`` (sum, min, product or last) of ``value`` over the earlier rows of the group.

    ``bucket`` must grow with ``order`` (an earlier row never has a later bucket). ``inclusive`` counts the row
    itself. The first row of a group gets 0 for a sum, 1 for a product and NULL otherwise. ``partitions`` deals the rows to so many
    tasks; without it the session decides.
    """
    aggregate = {"sum": F.sum, "min": F.min, "product": F.product, "last": F.last}[kind]
    group, order = list(group), list(order)
    cuts = [f"_bucket{i}" for i in range(len(bucket))]
    # One key that is never NULL and whose NULL fields are equal: the window and the join agree on the partitioning and the order.
    key = F.struct(*group, *[c.alias(cut) for cut, c in zip(cuts, bucket)])
    cut = df.withColumn("_group_key", key).withColumn("_value", value)
    if kind == "last":
        total = F.max_by("_value", F.struct(*order))
    else:
        total = aggregate("_value")
    totals = cut.groupBy("_group_key").agg(total.alias("_total"))
    before = Window.partitionBy(*[F.col(f"_group_key.{c}") for c in group]).orderBy(*[F.col(f"_group_key.{c}") for c in cuts]).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("_group_key", aggregate("_total").over(before).alias("_carry"))
    upto = 0 if inclusive else -1
    inside = Window.partitionBy("_group_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
    local, carried = F.col("_local"), F.col("_carry")
    combined = {
        "sum": F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0)),
        "product": F.coalesce(local, F.lit(1.0)) * F.coalesce(carried, F.lit(1.0)),
        "min": F.least(local, carried),
        "last": F.coalesce(local, carried),
    }[kind]
    # the group's columns travel inside the key
    narrow = cut.drop(*[c for c in group if c not in order])
    dealt = narrow.repartition(partitions, "_group_key") if partitions else narrow
    done = dealt.withColumn("_local", aggregate("_value").over(inside)).join(carry, "_group_key").withColumn(name, combined)
    return done.select(*[F.col(f"_group_key.{c}").alias(c) if c in group else F.col(c) for c in df.columns if c != name], name)


def hashed_position(df: DataFrame, *, group: Sequence[str], key: str, ties: Sequence[str], name: str, digits: int = 3, partitions: int | None = None) -> DataFrame:
    """Zero-based position of each row in the order of an md5 ``key`` inside its group.

    The leading hex digits of an md5 cut any group into 16**digits even buckets.
    """
    return running(
        df,
        group=group,
        bucket=[F.substring(key, 1, digits)],
        order=[key, *ties],
        value=F.lit(1).cast("long"),
        kind="sum",
        name=name,
        partitions=partitions,
    )


def ordered_position(df: DataFrame, *, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Zero-based position of each row in its group for order columns of any type.

    Rows are range-partitioned on (group, order), so a hot group spans as many partitions as it needs. The write
    freezes the partition layout; afterwards a row's position is its place in its partition plus the rows its group
    has in earlier partitions.
    """
    group = list(group)
    place = F.monotonically_increasing_id()
    ranged = staged(
        df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order).withColumn("_place", place),
        "ordered",
    ).withColumn("_part", F.shiftright("_place", 33))
    runs = ranged.groupBy(*group, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *group, "_part", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        join_null_safe(ranged, starts, [*group, "_part"])
        .withColumn(name, F.col("_before") + F.col("_place") - F.col("_first"))
        .drop("_place", "_part", "_first", "_before")
    )
