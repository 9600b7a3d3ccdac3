"""Vector rows: group-wise int8 quantization and normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.arrays import bind

# Fixed value: the largest code of the symmetric int8 range.
MAX_CODE = 127.0


def fitting_group_size(width: int, group_size: int) -> int:
    """Halve the group size until it divides the row width."""
    while width % group_size:
        group_size //= 2
    return group_size


def quantize_groups(vec: Column, group_size: int) -> Column:
    """Quantize a vector in groups: array of (scale, codes, max_error).

    ``scale = max|w| / 127``, codes are ``w / scale`` rounded half to even. A group of zeros has scale, codes and error
    0. A length that the group size does not divide is an error.
    """

    def starts(size: Column) -> Column:
        misfit = F.raise_error(F.lit("vector length is not a multiple of the group size")).cast("array<int>")
        empty = F.array().cast("array<int>")
        return (
            F.when(size % group_size != 0, misfit)
            .when(size > 0, F.sequence(F.lit(1), size, F.lit(group_size)))
            .otherwise(empty)
        )

    def quantized(cells: Column) -> Column:
        return bind(
            F.array_max(F.transform(cells, lambda x: F.abs(x))) / F.lit(MAX_CODE),
            lambda scale: bind(
                F.transform(cells, lambda x: F.when(scale == 0, F.lit(0.0)).otherwise(F.rint(F.try_divide(x, scale)))),
                lambda codes: F.struct(
                    scale.cast("float").alias("scale"),
                    codes.cast("array<tinyint>").alias("codes"),
                    F.array_max(F.zip_with(cells, codes, lambda x, q: F.abs(q * scale - x))).alias("max_error"),
                ),
            ),
        )

    return bind(
        vec.cast("array<double>"),
        lambda v: F.transform(starts(F.size(v)), lambda s: bind(F.slice(v, s, group_size), quantized)),
    )


def dequantize_groups(groups: Column) -> Column:
    """Back to one vector of doubles."""
    return F.flatten(
        F.transform(groups, lambda g: F.transform(g["codes"], lambda q: q.cast("double") * g["scale"].cast("double")))
    )


def rms_norm(vec: Column, weight: Column, eps: float = 1e-5) -> Column:
    """``v / sqrt(mean(v^2) + eps) * weight``."""

    def of(v: Column) -> Column:
        mean_square = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x) / F.size(v)
        return bind(
            F.sqrt(mean_square + F.lit(eps)),
            lambda norm: F.zip_with(v, weight.cast("array<double>"), lambda x, w: x / norm * w),
        )

    return bind(vec.cast("array<double>"), of)
