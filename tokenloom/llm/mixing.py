"""Mixing sources to target weights by the cube method.

A source's target divided by its size is the number of times each of its documents should enter. The whole part is
taken as it is; the fraction is an inclusion probability. The flight moves these probabilities along directions that
change neither the sum of tokens nor the number of documents, until each is 0 or 1 but for at most two per block.
Blocks of one source are independent tasks; their leftovers form new blocks, until one block per source is left.
There a dozen units of all sizes are the landing problem: of all their outcomes the one nearest to the target is taken.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.plans.staging import staged

#: Weights of the sources in their order, repeating; most times that a document enters.
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
BLOCK = 2048
#: Units of the landing problem of a source, all of whose outcomes are compared.
LANDING = 12
_EPS = 1e-9


def targets(sizes: Sequence[float], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Share ``share`` of all sizes by weight; none above ``most`` times its size, the excess reshared by weight."""
    out = [0.0] * len(sizes)
    free = [i for i in range(len(sizes)) if sizes[i] > 0]
    left = share * sum(sizes)
    while free and left > 0:
        total = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return out


def flight(size: np.ndarray, chance: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities in the null space of (sum of sizes, number) until at most two are fractions.

    Any three units have one direction that keeps both sums; it is followed to the first 0 or 1 on either side, the side
    drawn so that the expectation of each probability stays. Sizes come in falling order. Two neighbours from the large
    end exchange probability while one unit from the small end makes up the difference of their sizes, so what is left
    over is small.
    """
    p = chance.astype(float).tolist()
    s = size.astype(float).tolist()
    order = [k for k in range(len(p)) if _EPS < p[k] < 1 - _EPS]
    draws = rng.random(len(p) + 1).tolist()
    large: list[int] = []
    small: int | None = None
    head, tail = 0, len(order) - 1
    while True:
        if small is None and head <= tail:
            small, tail = order[tail], tail - 1
        while len(large) < 2 and head <= tail:
            large.append(order[head])
            head += 1
        if small is None or len(large) < 2:
            return np.array(p)
        i, j, m = *large, small
        u = (s[j] - s[m], s[m] - s[i], s[i] - s[j])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[a]) / d if d > 0 else p[a] / -d for a, d in zip((i, j, m), u) if d)
        down = min(p[a] / d if d > 0 else (1 - p[a]) / -d for a, d in zip((i, j, m), u) if d)
        step = up if draws[head] * (up + down) < down else -down
        for a, d in zip((i, j, m), u):
            p[a] += step * d
            if p[a] < _EPS:
                p[a] = 0.0
            elif p[a] > 1 - _EPS:
                p[a] = 1.0
        large = [a for a in large if 0.0 < p[a] < 1.0]
        if p[small] in (0.0, 1.0):
            small = None


def landing(size: np.ndarray, chance: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round the last fractions of a source: the outcome nearest to the expected tokens, and then to the number."""
    left = np.flatnonzero((chance > 0) & (chance < 1))
    p = chance.copy()
    if len(left):
        outcomes = (np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1).astype(float)
        off = outcomes - chance[left]
        cost = np.abs(off @ size[left]) + 0.01 * size[left].mean() * np.abs(off.sum(1))
        best = np.flatnonzero(cost <= cost.min() + _EPS)
        p[left] = outcomes[best[int(rng.integers(len(best)))]]
    return p


def _fly(seed: int, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "key", "id"], ascending=[False, True, True], kind="stable")
        rng = np.random.default_rng([seed, int(rows["source_no"].iloc[0]), int(rows["block"].iloc[0]), len(rows)])
        size, p = rows["size"].to_numpy(), rows["chance"].to_numpy()
        if last:  # units of all sizes stay on the ground, for the landing to balance what the flight leaves
            ground = np.unique(np.linspace(0, len(p) - 1, LANDING - 2).astype(int))
            air = np.ones(len(p), bool)
            air[ground] = False
            p = p.copy()
            p[air] = flight(size[air], p[air], rng)
            p = landing(size, p, rng)
        else:
            p = flight(size, p, rng)
        return rows.assign(chance=p).drop(columns="block")

    return run


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    most: float = MOST,
    seed: int = 17,
    block: int = BLOCK,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """Times each document enters: ``doc_id, source, size, source_size, target, copies, taken``.

    ``size`` is the number of words (null text: 0). Sources are ordered by code point with null as a source of its own
    at the end; ``weights`` repeat over them. Documents of size 0 get 0 copies. Repeated rows are units of their own.
    A source or table without words has target 0. Equal inputs give equal results whatever the partitioning, since all
    randomness comes from the seed and the order (size, hash, id). Sources are few: one row each comes to the driver.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    sized = staged(
        docs.select(
            F.col(id_column).cast("long").alias("id"),
            F.col(source_column).cast("string").alias("source"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
            F.xxhash64(F.col(id_column).cast("long"), text).alias("key"),
        ),
        "mix",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("total"), F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("units")).collect()
    sources.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    sizes = [float(r["total"]) for r in sources]
    target = targets(sizes, [weights[i % len(weights)] for i in range(len(sources))], share, most)
    plan = []
    for i, r in enumerate(sources):
        rate = target[i] / sizes[i] if sizes[i] else 0.0
        whole = floor(rate + _EPS)
        fraction = max(0.0, rate - whole)
        plan.append((i, r["source"], r["total"], float(target[i]), whole, fraction if fraction > _EPS else 0.0, r["units"] or 0))
    table = spark.createDataFrame(plan, "source_no int, source string, source_size long, target double, whole int, fraction double, units long")
    # one row per source: as few as the list that the driver has just held
    joined = sized.join(F.broadcast(table), sized["source"].eqNullSafe(table["source"])).drop(table["source"])
    flying = (F.col("size") > 0) & (F.col("fraction") > 0)
    rows = joined.withColumn("chance", F.when(flying, F.col("fraction")).otherwise(0.0))
    columns = "id long, size long, key long, source_no int, chance double"
    resting = rows.where(~flying).select("id", "size", "key", "source_no", "chance")
    pending = rows.where(flying).select("id", "size", "key", "source_no", "chance")
    units = max([p[6] for p in plan if p[5] > 0], default=0)
    done = [resting]
    level = 0
    while units:
        blocks = {p[0]: max(1, ceil(p[6] / block)) for p in plan} if level == 0 else {p[0]: max(1, ceil(2 * blocks[p[0]] / block)) for p in plan}
        last = max(blocks.values()) == 1
        per = F.coalesce(*[F.when(F.col("source_no") == i, F.lit(n)) for i, n in blocks.items() if n > 1], F.lit(1)) if not last else F.lit(1)
        flown = (
            pending.withColumn("block", F.pmod(F.xxhash64("key", F.lit(level)), per))
            .groupBy("source_no", "block")
            .applyInPandas(_fly(seed + level, last), columns)
        )
        flown = staged(flown, "flight")
        done.append(flown.where("chance <= 0 OR chance >= 1"))
        if last:
            break
        pending = flown.where("chance > 0 AND chance < 1")
        level += 1
    chosen = done[0]
    for d in done[1:]:
        chosen = chosen.unionByName(d)
    copies = (F.col("whole") + F.when(F.col("chance") >= 1, 1).otherwise(0)).cast("long")
    return (
        chosen.join(F.broadcast(table), "source_no")
        .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0).cast("long")))
        .select(
            F.col("id").alias(id_column), F.col("source").alias(source_column), "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )
