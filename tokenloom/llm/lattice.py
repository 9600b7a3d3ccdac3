"""Near-duplicate vectors by lattice hashing.

In each of ``TABLES`` tables a vector is projected at random to ``BLOCKS`` blocks of eight dimensions; each block is
decoded to its nearest point of the E8 lattice, and the points together name the vector's cell. A vector also probes the
``PROBES`` cells that change one block to the neighbouring lattice point least farther away. Cosines are verified.

Dense groups never become pairs: vectors within half the threshold angle of a leader form a ball, in which every pair is
linked by the triangle inequality. Cells hold balls, two balls are compared by their leaders' angle and their radii, and
only where that leaves doubt are members compared, first with the other leader, then one by one. Links are counted, not
listed, and all decisions are those of the exact cosine.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import spans as S
from tokenloom.llm.components import components
from tokenloom.plans.staging import staged

COSINE = 0.95
TABLES, BLOCKS, PROBES, SCALE = 12, 3, 10, 0.5
#: Rounds of ball building; each takes the cells of another table. Vectors left over are balls of their own.
ROUNDS = 4
_SAFE = 1e-6


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of 1 or -1, or all of a half with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """The nearest integer point with an even sum: where rounding gives an odd one, the worst coordinate goes the other way."""
    point = np.rint(y)
    error = y - point
    odd = np.flatnonzero(point.sum(1) % 2 != 0)
    worst = np.abs(error[odd]).argmax(1)
    point[odd, worst] += np.where(error[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The nearest point of E8: that of its two cosets of D8 which lies nearer."""
    whole, half = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    return np.where((((y - whole) ** 2).sum(1) <= ((y - half) ** 2).sum(1))[:, None], whole, half)


@lru_cache(maxsize=8)
def _projection(dimension: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([8, dimension])
    return rng.standard_normal((TABLES, dimension, 8 * BLOCKS)) * SCALE, rng.random((TABLES, 8 * BLOCKS)) * 2


def _point_hash(point: np.ndarray, block: int) -> np.ndarray:
    h = np.full(len(point), block + 1, np.uint64)
    for i in range(8):
        h = S.mix(h * np.uint64(0x9E3779B97F4A7C15) + np.rint(point[:, i] * 2).astype(np.int64).view(np.uint64))
    return h


def cells(unit: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the own cell per table, and of the probed cells; blocks enter a key by sum, so one can be exchanged."""
    n, dimension = unit.shape
    matrix, offset = _projection(dimension)
    own, probed = np.empty((n, TABLES), np.uint64), np.empty((n, TABLES * probes), np.uint64)
    salt = np.arange(1, TABLES + 1, dtype=np.uint64) * np.uint64(1 << 32) + np.uint64(dimension)
    for t in range(TABLES):
        y = unit @ matrix[t] + offset[t]
        blocks = [y[:, 8 * b : 8 * b + 8] for b in range(BLOCKS)]
        points = [nearest_e8(b) for b in blocks]
        parts = [_point_hash(p, b) for b, p in enumerate(points)]
        total = sum(parts[1:], parts[0])
        own[:, t] = S.mix(total + salt[t])
        if not probes:
            continue
        # how much farther each neighbour is, over all blocks
        cost = np.concatenate([2 - 2 * (y_ - p) @ ROOTS.T for y_, p in zip(blocks, points)], axis=1)
        best = np.argpartition(cost, probes - 1, axis=1)[:, :probes]
        for k in range(probes):
            block, root = best[:, k] // 240, best[:, k] % 240
            key = total.copy()
            for b in range(BLOCKS):
                here = np.flatnonzero(block == b)
                key[here] += _point_hash(points[b][here] + ROOTS[root[here]], b) - parts[b][here]
            probed[:, t * probes + k] = S.mix(key + salt[t])
    return own, probed


def _units(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors of length 1; None for a null, empty, zero or non-finite one, or one with null components."""
    out: list[np.ndarray | None] = []
    for row in column:
        values = row.values
        x = None if values is None or len(values) == 0 or values.null_count else values.to_numpy(zero_copy_only=False).astype(np.float64)
        if x is None or not np.isfinite(x).all() or not (top := np.abs(x).max()) > 0:
            out.append(None)
            continue
        x = x / top
        out.append(x / np.sqrt((x * x).sum()))
    return out


def _longs(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32()), pa.array(np.ascontiguousarray(rows).reshape(-1).view(np.int64)))


def _cut(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        units = _units(batch.column(1))
        for size in {len(u) for u in units if u is not None}:
            at = [i for i, u in enumerate(units) if u is not None and len(u) == size]
            x = np.stack([units[i] for i in at])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array([u.tobytes() for u in x], pa.binary()), _longs(cells(x, 0)[0])], ["id", "unit", "own"])


def _matrix(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.float64) for v in column]


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        units = _matrix(batch.column(1))
        for size in {len(u) for u in units}:
            at = [i for i, u in enumerate(units) if len(u) == size]
            keys = cells(np.stack([units[i] for i in at]), PROBES)[1]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), _longs(keys)], ["ball", "probed"])


def _cosines(left: pa.Array, right: pa.Array) -> np.ndarray:
    return np.array([float(a @ b) if len(a) == len(b) else -1.0 for a, b in zip(_matrix(left), _matrix(right))])


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, leader, unit, leader's unit) to (id, leader, angle)."""
    for batch in _cut(batches):
        same = np.array(batch.column(0)) == np.array(batch.column(1))
        angle = np.where(same, 0.0, np.arccos(np.clip(_cosines(batch.column(2), batch.column(3)), -1, 1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(angle, pa.float64())], ["id", "leader", "angle"])


def _judge(limit: float, cosine: float):
    """(a, b, radius, unit_a, unit_b) to (a, b, state): 1 all linked, 2 in doubt; others are dropped. Radius 0 decides alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            got = _cosines(batch.column(3), batch.column(4))
            angle, radius = np.arccos(np.clip(got, -1, 1)), batch.column(2).to_numpy()
            state = np.where(angle + radius <= limit - _SAFE, 1, np.where(angle - radius > limit + _SAFE, 0, 2))
            state = np.where(radius == 0, (got >= cosine).astype(int), state)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(state, pa.int32())], ["a", "b", "state"]).filter(pa.array(state > 0))

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``n_links, component_id, kept`` of each vector, after its id.

    Links are pairs found with a cosine of at least ``cosine``, computed in doubles. A vector that is null, empty or
    zero, or holds null or non-finite components, links with nothing; nor do vectors of different lengths. Rows that share
    an id are one vector, of those that can link the one whose bytes at length 1 are least; links count the other ids,
    and each of the rows gets the id's result. A row with a null id has no links, a null component and is not kept. An
    empty table gives an empty result; other columns are not read.
    """
    limit = float(np.arccos(cosine))
    ids = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    placed = staged(ids.where("id IS NOT NULL").mapInArrow(_place, "id long, unit binary, own array<long>"), "cells")
    if not placed.groupBy("id").count().where("count > 1").isEmpty():
        placed = staged(placed.groupBy("id").agg(F.min("unit").alias("unit"), F.min_by("own", "unit").alias("own")), "cells")

    todo, balls = placed.select("id", "unit", "own"), []
    for r in range(ROUNDS):
        key = F.col("own")[r % TABLES]
        leaders = todo.groupBy(key.alias("key")).agg(F.min("id").alias("leader"), F.min_by("unit", "id").alias("leader_unit"))
        near = todo.withColumn("key", key).join(leaders, "key").select("id", "leader", "unit", "leader_unit").mapInArrow(_angles, "id long, leader long, angle double")
        found = staged(near.where(F.col("angle") <= limit / 2 - _SAFE), "balls")
        balls.append(found)
        todo = staged(todo.join(found.select("id"), "id", "left_anti"), "cells")
        if todo.isEmpty():
            break
    members = todo.select("id", F.col("id").alias("leader"), F.lit(0.0).alias("angle"))
    for b in balls:
        members = members.unionByName(b)
    members = staged(members.join(placed.select("id", "unit"), "id"), "members")
    ball = members.groupBy(F.col("leader").alias("ball")).agg(F.count(F.lit(1)).alias("size"), F.max("angle").alias("radius"))
    ball = staged(ball.join(placed.select(F.col("id").alias("ball"), "unit"), "ball"), "balls")

    home = members.select("id", "leader").join(placed.select("id", "own"), "id").select(F.col("leader").alias("ball"), F.explode("own").alias("key")).distinct()
    away = members.select("leader", "unit").mapInArrow(_probe, "ball long, probed array<long>").select("ball", F.explode("probed").alias("key")).distinct()
    visitors = home.unionByName(away).select(F.col("ball").alias("other"), "key")
    met = home.join(visitors, "key").where("ball <> other")
    pairs = staged(met.select(F.least("ball", "other").alias("a"), F.greatest("ball", "other").alias("b")).distinct(), "pairs")

    # a is the larger of the two balls from here on
    side = lambda c: ball.select(F.col("ball").alias(c), F.col("size").alias(f"n_{c}"), F.col("radius").alias(f"r_{c}"), F.col("unit").alias(f"u_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    judged = staged(both.select("a", "b", (F.col("r_a") + F.col("r_b")).alias("radius"), "u_a", "u_b").mapInArrow(_judge(limit, cosine), "a long, b long, state int"), "judged")
    sizes = ball.select("ball", "size")
    turn = (
        judged.join(sizes.select(F.col("ball").alias("a"), F.col("size").alias("n_a")), "a")
        .join(sizes.select(F.col("ball").alias("b"), F.col("size").alias("n_b")), "b")
        .select("state", F.expr("if(n_a >= n_b, a, b)").alias("a"), F.expr("if(n_a >= n_b, b, a)").alias("b"), F.greatest("n_a", "n_b").alias("n_a"), F.least("n_a", "n_b").alias("n_b"))
    )
    whole = turn.where("state = 1")
    doubt = turn.where("state = 2").join(members.select(F.col("leader").alias("a"), "id", "unit"), "a").join(ball.select(F.col("ball").alias("b"), "radius", F.col("unit").alias("unit_b")), "b")
    # one row per member of a and ball b; the id stands for a, which is looked up again afterwards
    half = staged(doubt.select("id", "b", "radius", "unit", "unit_b").mapInArrow(_judge(limit, cosine), "a long, b long, state int").withColumnRenamed("a", "id"), "judged")
    owner = members.select("id", F.col("leader").alias("a"), "unit")
    half = half.join(owner, "id").join(sizes.select(F.col("ball").alias("b"), F.col("size").alias("n_b")), "b")
    some = half.where("state = 1")
    last = half.where("state = 2").join(members.select(F.col("leader").alias("b"), F.col("id").alias("id_b"), F.col("unit").alias("unit_b")), "b")
    exact = staged(last.select("id", "id_b", F.lit(0.0).alias("radius"), "unit", "unit_b").mapInArrow(_judge(limit, cosine), "a long, b long, state int"), "exact")

    per_ball = (
        whole.select(F.col("a").alias("ball"), F.col("n_b").alias("n"))
        .unionByName(whole.select(F.col("b").alias("ball"), F.col("n_a").alias("n")))
        .unionByName(some.select(F.col("b").alias("ball"), F.lit(1).cast("long").alias("n")))
        .groupBy("ball").agg(F.sum("n").alias("n_ball"))
    )
    per_member = (
        some.select("id", F.col("n_b").alias("n"))
        .unionByName(exact.select(F.col("a").alias("id"), F.lit(1).cast("long").alias("n")))
        .unionByName(exact.select(F.col("b").alias("id"), F.lit(1).cast("long").alias("n")))
        .groupBy("id").agg(F.sum("n").alias("n_member"))
    )
    lead = members.select("id", "leader")
    ends = exact.join(lead.select(F.col("id").alias("a"), F.col("leader").alias("l_a")), "a").join(lead.select(F.col("id").alias("b"), F.col("leader").alias("l_b")), "b")
    edges = whole.select("a", "b").unionByName(some.select("a", "b")).unionByName(ends.select(F.col("l_a").alias("a"), F.col("l_b").alias("b")))
    joined = components(edges).select(F.col("id").alias("ball"), "component_id")
    summary = (
        sizes.join(per_ball, "ball", "left").join(joined, "ball", "left")
        .select(F.col("ball").alias("leader"), (F.col("size") - 1 + F.coalesce("n_ball", F.lit(0))).alias("n"), F.coalesce("component_id", "ball").alias("component_id"))
    )
    linked = lead.join(summary, "leader").join(per_member, "id", "left").select("id", (F.col("n") + F.coalesce("n_member", F.lit(0))).alias("n_links"), "component_id")
    out = ids.select("id").join(linked, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
