"""Whitening of vectors from an exact covariance, by bit-sliced scatter.

Components become whole numbers. In a block of rows each dimension is shifted by its least value and its bit planes are
packed across the rows into 64-bit words; the product of two dimensions summed over the rows is the sum over pairs of
planes of 2^(a+b) times the number of bits that both have set. Cross-products and sums are whole numbers from the first
block to the last, and ``n * products - sums * sums`` is centred exactly however far the values lie from 0, before
anything is rounded for the eigenvectors.

A task gives out one triangle of cross-products; they are added by decimal sums. The driver holds a matrix for each length of
vectors, never anything that grows with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.dense import finite_rows
from tokenloom.plans.staging import staged

SCALE, COMPONENTS = 64, 16
#: Rows of a block; a multiple of 64, the bits of a word.
BLOCK = 4096
#: Words that one popcount looks at, at most.
WORDS = 1 << 18
#: A component that becomes a larger whole number counts as non-finite.
LARGEST = 1 << 60
_SAFE = 1 << 62


def _whole(scale: float):
    """(id, vector) to (id, whole components as bytes) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in finite_rows(batch.column(1)):
                with np.errstate(over="ignore"):
                    z = np.floor(x * scale)
                fits = (np.abs(z) < LARGEST).all(1)
                z = z[fits].astype(np.int64)
                for first in range(0, len(z), BLOCK):
                    rows = z[first : first + BLOCK]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[fits][first : first + BLOCK])), pa.array([r.tobytes() for r in rows], pa.binary())], ["id", "z"])

    return run


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length in a column of packed rows."""
    rows = [v.as_py() for v in column]
    sizes = np.array([len(r) for r in rows])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.frombuffer(b"".join(rows[i] for i in at), np.int64).reshape(len(at), -1)


def bit_planes(y: np.ndarray) -> list[np.ndarray]:
    """Planes of a matrix without negative values, lowest bit first: a word array per dimension, rows filled up with zeros."""
    rows = -(-len(y) // 64) * 64
    filled = np.zeros((rows, y.shape[1]), np.int64)
    filled[: len(y)] = y
    top = int(y.max(initial=0)).bit_length()
    return [np.ascontiguousarray(np.packbits((filled >> b & 1).astype(np.uint8), axis=0).T).view(np.uint64) for b in range(top)]


def _common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bits that each dimension of ``left`` shares with each of ``right``."""
    out = np.empty((len(left), len(right)), np.int64)
    step = max(1, WORDS // max(1, right.size))
    for i in range(0, len(left), step):
        out[i : i + step] = np.bitwise_count(left[i : i + step, None, :] & right[None, :, :]).sum(-1, dtype=np.int64)
    return out


def cross_products(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums, and sums of products of all pairs of dimensions, as exact whole numbers (of Python where 64 bits do not do)."""
    shift = z.min(0)
    planes = bit_planes(z - shift)
    top = int(np.abs(z).max(initial=0)) + 1
    kind = np.int64 if 16 * len(z) * top * top < _SAFE else object
    total, sums = np.zeros((z.shape[1],) * 2, kind), np.zeros(z.shape[1], kind)
    for a, left in enumerate(planes):
        sums += np.bitwise_count(left).sum(1, dtype=np.int64).astype(kind) * (1 << a)
        total += _common(left, left).astype(kind) * (1 << 2 * a)
        for b in range(a + 1, len(planes)):
            both = _common(left, planes[b]).astype(kind) * (1 << a + b)
            total += both + both.T
    shift = shift.astype(kind)
    total += shift[:, None] * sums + sums[:, None] * shift + len(z) * shift[:, None] * shift
    return sums + len(z) * shift, total


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows to (dims, i, j, total): products for i <= j, sums at i = -1, the count at i = j = -1."""
    held: dict[int, list] = {}
    waiting: dict[int, list[np.ndarray]] = {}

    def add(z: np.ndarray) -> None:
        sums, total = cross_products(z)
        at = held.setdefault(z.shape[1], [0, 0, 0, 0])
        room = at[3] + int(np.abs(total).max()) < _SAFE and sums.dtype != object
        at[0], at[3] = at[0] + len(z), at[3] + int(np.abs(total).max())
        for k, new in ((1, sums), (2, total)):
            at[k] = at[k] + new if room else np.asarray(at[k], object) + new.astype(object)

    for batch in batches:
        for _, z in _by_length(batch.column(0)):
            parts = waiting.setdefault(z.shape[1], [])
            parts.append(z)
            if sum(map(len, parts)) >= BLOCK:
                whole = np.concatenate(parts)
                cut = len(whole) // BLOCK * BLOCK
                for first in range(0, cut, BLOCK):
                    add(whole[first : first + BLOCK])
                waiting[z.shape[1]] = [whole[cut:]]
    for parts in waiting.values():
        if len(rest := np.concatenate(parts)):
            add(rest)
    for dims, (count, sums, total, _) in held.items():
        i, j = np.triu_indices(dims)
        rows = np.concatenate([[-1], np.full(dims, -1), i]), np.concatenate([[-1], np.arange(dims), j])
        values = [count, *map(int, sums), *map(int, total[i, j])]
        for first in range(0, len(values), 1 << 16):
            cut = slice(first, first + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values[cut]), dims, np.int32)), pa.array(rows[0][cut], pa.int32()), pa.array(rows[1][cut], pa.int32()), pa.array(values[cut], pa.decimal128(38, 0))], ["dims", "i", "j", "total"])


@dataclass(frozen=True)
class Whitening:
    """``n`` different rows and their sums; the first components as columns, with their variances and shares of all."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    variance: np.ndarray
    explained: np.ndarray

    def centred(self, z: np.ndarray) -> np.ndarray:
        """``n * z - sums``, in 64 bits where squares can be added there and in Python's whole numbers elsewhere."""
        most = self.n * (int(np.abs(z).max(initial=0)) + 1) + max((abs(int(s)) for s in self.sums), default=0)
        if most * most * z.shape[1] < _SAFE:
            return self.n * z - self.sums.astype(np.int64)
        return self.n * z.astype(object) - self.sums

    def apply(self, far: np.ndarray) -> np.ndarray:
        """Whitened values of centred rows; NaN for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (far / self.n).astype(np.float64) @ self.vectors / np.sqrt(self.variance)
        out[:, self.variance <= 0] = np.nan
        return out


def solve(n: int, sums: np.ndarray, products: np.ndarray, components: int) -> Whitening:
    """Principal components from exact sums; variances that rounding cannot tell from 0 are 0."""
    centred = n * products.astype(object) - sums.astype(object)[:, None] * sums.astype(object)
    covariance = (centred / (n * n)).astype(np.float64)
    value, vector = np.linalg.eigh(covariance)
    value, vector = value[::-1], vector[:, ::-1]
    value = np.where(value > max(value[0], 0) * len(value) * np.finfo(float).eps, value, 0.0)
    top = vector[np.abs(vector).argmax(0), np.arange(len(value))]
    vector = vector * np.where(top < 0, -1.0, 1.0)
    trace = float(np.trace(covariance))
    share = value / trace if trace > 0 else np.zeros_like(value)
    return Whitening(n, sums, vector[:, :components], value[:components], share[:components])


def _moments(models: dict[int, Whitening]):
    """Packed rows to the count, means and centred cross-products of their whitened values, one triangle a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for _, z in _by_length(batch.column(0)):
                model = models[z.shape[1]]
                w = np.nan_to_num(model.apply(model.centred(z)))
                mean = w.mean(0)
                n, about, c = len(w), mean, (w - mean).T @ (w - mean)
                if z.shape[1] in held:
                    n0, about0, c0 = held[z.shape[1]]
                    far = about - about0
                    c = c0 + c + np.outer(far, far) * (n0 * n / (n0 + n))
                    about, n = about0 + far * (n / (n0 + n)), n0 + n
                held[z.shape[1]] = n, about, c
        for dims, (n, mean, c) in held.items():
            i, j = np.triu_indices(len(mean))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dims, np.int32)), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(len(i), n, np.int64)), pa.array(mean[i]), pa.array(mean[j]), pa.array(c[i, j])], ["dims", "i", "j", "n", "mean_i", "mean_j", "c"])

    return run


def _project(models: dict[int, Whitening], error: dict[int, float]):
    """(id, packed row) to one row for each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, z in _by_length(batch.column(1)):
                model = models[z.shape[1]]
                far = model.centred(z)
                deviation = [d if (d := int(s)) < 1 << 63 else None for s in (far * far).sum(1)]
                w = model.apply(far)
                rows, k = w.shape
                again = np.repeat(np.arange(rows), k)
                columns = [
                    batch.column(0).take(pa.array(at[again])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n, np.int64)),
                    pa.array(deviation, pa.int64()).take(pa.array(again)), pa.array(w.reshape(-1), pa.float64(), from_pandas=True), pa.array(np.tile(model.explained, rows)),
                    pa.array(np.full(rows * k, error[z.shape[1]])),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each length among packed rows."""
    totals: dict[int, dict] = {}
    for r in fit_list.mapInArrow(_scatter, "dims int, i int, j int, total decimal(38,0)").groupBy("dims", "i", "j").agg(F.sum("total").alias("total")).collect():
        totals.setdefault(r["dims"], {})[r["i"], r["j"]] = int(r["total"])
    models = {}
    for dims, t in totals.items():
        products = np.empty((dims, dims), object)
        for i in range(dims):
            for j in range(i, dims):
                products[i, j] = products[j, i] = t[i, j]
        models[dims] = solve(t[-1, -1], np.array([t[-1, j] for j in range(dims)], object), products, components)
    return models


def identity_errors(fit_list: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """Of each length: the largest entry of the covariance of whitened rows minus the identity, measured on all of them."""
    parts = fit_list.mapInArrow(_moments(models), "dims int, i int, j int, n long, mean_i double, mean_j double, c double")
    n = F.sum("n")
    mean_i, mean_j = F.sum(F.col("n") * F.col("mean_i")) / n, F.sum(F.col("n") * F.col("mean_j")) / n
    covariance = (F.sum(F.col("c") + F.col("n") * F.col("mean_i") * F.col("mean_j")) - n * mean_i * mean_j) / n
    out = dict.fromkeys(models, 0.0)
    for r in parts.groupBy("dims", "i", "j").agg(covariance.alias("v")).collect():
        variance = models[r["dims"]].variance
        if variance[r["i"]] > 0 and variance[r["j"]] > 0:
            out[r["dims"]] = max(out[r["dims"]], abs(r["v"] - (r["i"] == r["j"])))
    return out


def whiten(vectors: DataFrame, scale: float = SCALE, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each row and component.

    Each component c of a vector becomes the whole number floor(scale * c); a constant added to all of them changes nothing
    in what is returned. Rows whose vector is null or empty, holds null or non-finite components or whole numbers of 2^60 and more
    are left out. The fit list is each different vector once. Vectors of one length are whitened among themselves, with
    as many components as they are long, ``components`` at most. A component without variance (a single vector,
    dimensions that depend on others) has a null ``whitened`` and explains 0; it takes no part in ``identity_error``. A
    ``deviation`` that no long holds is null. Repeated rows and rows with a null id are returned as often as they stand. An
    empty table gives an empty result; other columns are not read.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")).mapInArrow(_whole(scale), "id long, z binary")
    fit_list = staged(rows.select("z").distinct(), "fit-list")
    models = fit(fit_list, components)
    error = identity_errors(fit_list, models)
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(_project(models, error), kinds).withColumnRenamed("vec_id", id_column)
