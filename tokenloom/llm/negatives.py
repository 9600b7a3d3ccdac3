"""Hard negatives of anchor vectors, with bounds along a spanning tree of the anchors.

Anchors are taken in passes of a bounded number, which is broadcast; no candidate row ever moves. The anchors of a pass
are the nodes of a least spanning tree. A candidate's score at an anchor is known exactly or lies between two bounds; at a
child anchor it lies within the edge's length times the candidate's norm of the parent's bounds. Only candidates whose
bounds overlap the window that can still change the anchor's result are scored again.

A first scan finds each anchor's positives, the best rows of its own label; a second one finds, for each positive, the best
rows of other labels whose score is a given share of the positive's. A task gives out the few best rows it has seen for
each anchor, whatever the label: a label that holds a third of all rows is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.dense import finite_rows
from tokenloom.plans.staging import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is from LOW to HIGH percent of its positive's.
LOW, HIGH = 50, 95
#: Anchors of a pass, and candidates that walk the tree together.
PASS, BLOCK = 2048, 2048
#: Scores must be exact in 64 bits: components whose whole number is larger, in either direction, take part in nothing.
LARGEST = 1 << 24


def _whole(scale: float):
    """(id, label, vector) to (id, label, whole components as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in finite_rows(batch.column(2)):
                with np.errstate(over="ignore"):
                    z = np.floor(x * scale)
                fits = (np.abs(z) <= LARGEST).all(1)
                rows, z = pa.array(at[fits]), z[fits].astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array([r.tobytes() for r in z], pa.binary())], ["id", "label", "z"])

    return run


class AnchorTree:
    """Anchors of one length as a least spanning tree, in an order in which parents come before their children."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, z: np.ndarray) -> None:
        n = len(ids)
        exact = z.astype(np.float64)
        nearest, parent, free = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
        children: list[list[int]] = [[] for _ in range(n)]
        edge, at = np.zeros(n), 0
        for _ in range(n):  # Prim's way from the first anchor
            free[at] = False
            if parent[at] >= 0:
                edge[at] = nearest[at]
                children[parent[at]].append(at)
            far = np.sqrt(((exact - exact[at]) ** 2).sum(1))
            closer = free & (far < nearest)
            nearest[closer], parent[closer] = far[closer], at
            at = int(np.where(free, nearest, np.inf).argmin())
        order, stack = [], [0] if n else []
        while stack:
            order.append(node := stack.pop())
            stack += children[node]
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids, self.labels, self.z = ids[order], labels[order], z[order].astype(np.int64)
        self.parent = np.where(parent[order] >= 0, place[parent[order]], -1)
        self.edge = edge[order]
        self.last_child = np.full(n, -1)
        for i, p in enumerate(self.parent):
            if p >= 0:
                self.last_child[p] = i

    def __len__(self) -> int:
        return len(self.ids)


class Candidates:
    """A block of candidates on its walk along a tree: bounds of their scores at the anchors that still have children."""

    def __init__(self, tree: AnchorTree, ids: np.ndarray, labels: np.ndarray, z: np.ndarray) -> None:
        self.tree, self.ids, self.labels = tree, ids, labels
        largest = int(np.abs(z).max(initial=0)) * int(np.abs(tree.z).max(initial=0)) * z.shape[1]
        kind = np.float64 if largest < 1 << 53 else np.int64  # doubles hold such sums exactly
        self.z, self.anchors = z.astype(kind), tree.z.astype(kind)
        self.norm = np.sqrt((z.astype(np.float64) ** 2).sum(1))
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0

    def at(self, i: int, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of all candidates that score from ``low`` to ``high`` at anchor ``i``, and maybe others.

        Anchors must be visited in order.
        """
        parent = self.tree.parent[i]
        if parent < 0:
            rows, scores = np.arange(len(self.ids)), self.z @ self.anchors[i]
            least = most = scores.astype(np.float64)
        else:
            # the little more makes up for rounding
            reach = self.norm * (self.tree.edge[i] * (1 + 1e-9)) + 1
            least, most = self.held[parent]
            least, most = least - reach, most + reach
            rows = np.flatnonzero((most >= low) & (least <= high))
            if 4 * len(rows) > len(self.ids):  # reading the rows in place is cheaper than to gather them
                rows, scores = np.arange(len(self.ids)), self.z @ self.anchors[i]
                least = most = scores.astype(np.float64)
            else:
                scores = self.z[rows] @ self.anchors[i]
                least[rows] = most[rows] = scores
            if self.tree.last_child[parent] == i:
                del self.held[parent]
        if self.tree.last_child[i] >= 0:
            self.held[i] = least, most
        self.scored += len(rows)
        return rows, scores.astype(np.int64)


def _merge(best: tuple[np.ndarray, np.ndarray], scores: np.ndarray, ids: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` highest scores and their ids, ties by smaller id."""
    scores, ids = np.concatenate([best[0], scores]), np.concatenate([best[1], ids])
    order = np.lexsort((ids, -scores))[:keep]
    return scores[order], ids[order]


_NONE = np.zeros(0, np.int64), np.zeros(0, np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], trees: dict[int, AnchorTree]) -> Iterator[Candidates]:
    """Candidates in blocks of one length, those without an anchor of their length left out."""
    waiting: dict[int, list[tuple]] = {}

    def block(size: int) -> Candidates:
        rows = waiting.pop(size)
        z = np.frombuffer(b"".join(r[2] for r in rows), np.int32).reshape(len(rows), -1)
        return Candidates(trees[size], np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), z)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            size = len(row[2]) // 4
            if size in trees:
                waiting.setdefault(size, []).append(row)
                if len(waiting[size]) == BLOCK:
                    yield block(size)
    for size in list(waiting):
        yield block(size)


def _positives(shared, keep: int):
    """Candidates to each anchor's best rows of its own label in this task: (anchor_id, id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        best = {size: [_NONE] * len(tree) for size, tree in trees.items()}
        for block in _blocks(batches, trees):
            tree, found = block.tree, best[block.tree.z.shape[1]]
            for i in range(len(tree)):
                low = found[i][0][-1] if len(found[i][0]) == keep else -np.inf
                rows, scores = block.at(i, low, np.inf)
                fit = (scores >= low) & (block.labels[rows] == tree.labels[i]) & (block.ids[rows] != tree.ids[i])
                if fit.any():
                    found[i] = _merge(found[i], scores[fit], block.ids[rows[fit]], keep)
        for size, tree in trees.items():
            yield _rows([(a, None, s, i) for a, (scores, ids) in zip(tree.ids.tolist(), best[size]) for s, i in zip(scores.tolist(), ids.tolist())])

    return run


def _negatives(shared, keep: int, low_percent: int, high_percent: int):
    """Candidates to the best rows of other labels in the window of each (anchor, positive) in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, positives = shared.value
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for block in _blocks(batches, trees):
            tree = block.tree
            for i, anchor in enumerate(tree.ids.tolist()):
                windows = []
                for positive, score in positives.get(anchor, ()):
                    low, high = -(-low_percent * score // 100), high_percent * score // 100
                    held = best.get((anchor, positive), _NONE)
                    if len(held[0]) == keep:
                        low = max(low, int(held[0][-1]))
                    if low <= high:
                        windows.append((positive, low, high))
                least, most = min((w[1] for w in windows), default=np.inf), max((w[2] for w in windows), default=-np.inf)
                rows, scores = block.at(i, least, most)
                fit = (scores >= least) & (scores <= most)
                fit[fit] = block.labels[rows[fit]] != tree.labels[i]
                scores, ids = scores[fit], block.ids[rows[fit]]
                for positive, low, high in windows if len(scores) else ():
                    inside = (scores >= low) & (scores <= high)
                    if inside.any():
                        best[anchor, positive] = _merge(best.get((anchor, positive), _NONE), scores[inside], ids[inside], keep)
        yield _rows([(a, p, s, i) for (a, p), (scores, ids) in best.items() for s, i in zip(scores.tolist(), ids.tolist())])

    return run


_KINDS = "anchor_id long, positive_id long, score long, id long"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "positive_id", "score", "id"])


def _ranked(rows: DataFrame, keep: int, *by: str) -> DataFrame:
    """The first rows of each group; a task has sent ``keep`` of them at most."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= keep)


def mine(
    vectors: DataFrame, anchors: Column | None = None, label: Column | None = None, scale: float = SCALE, positives: int = POSITIVES,
    negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, pass_anchors: int = PASS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of vectors ``vec_id, embedding, label``.

    Each component x becomes floor(scale * x); the score of two rows is the inner product of these whole numbers. Anchors are the
    rows for which ``anchors`` holds (all by default); ``label`` may replace the label column. An anchor's positives are the
    ``positives`` other rows of its label that score highest with it. For each positive, the ``negatives`` best rows of other labels
    whose score is from ``low`` to ``high`` percent of the positive's are returned, ranked from 1. Higher scores come first, ties by
    smaller ``vec_id``. A positive below 0 has no negatives; pairs without any have no row.

    Rows with a null id or label, or a vector that is null, empty, or holds null or non-finite components or
    whole numbers beyond 2^24, take no part; nor do rows of different lengths with each other. Rows that share an id are one, of
    those that take part that with the least label, then the least vector. An empty table gives an empty result; other columns are
    not read. ``pass_anchors`` bounds what is broadcast: a scan of all rows serves about that many anchors.
    """
    spark = vectors.sparkSession
    marked = vectors.select(F.col("vec_id").cast("long").alias("id"), (F.col("label") if label is None else label).cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    whole = staged(marked.where("id IS NOT NULL AND label IS NOT NULL").mapInArrow(_whole(scale), "id long, label long, z binary"), "whole")
    if not whole.groupBy("id").count().where("count > 1").isEmpty():
        one = whole.groupBy("id").agg(F.min(F.struct("label", "z")).alias("row"))
        whole = staged(one.select("id", "row.label", "row.z"), "whole")
    chosen = whole if anchors is None else whole.where(anchors)
    passes = -(-5 * chosen.count() // (4 * pass_anchors))  # hashing fills passes unevenly
    out = None
    for k in range(passes):
        trees = {}
        part = chosen.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == k).collect()
        for size in {len(r["z"]) for r in part}:
            same = sorted((r["id"], r["label"], bytes(r["z"])) for r in part if len(r["z"]) == size)
            if size:
                trees[size // 4] = AnchorTree(np.array([r[0] for r in same]), np.array([r[1] for r in same]), np.frombuffer(b"".join(r[2] for r in same), np.int32).reshape(len(same), -1))
        shared = spark.sparkContext.broadcast(trees)
        near = _ranked(whole.mapInArrow(_positives(shared, positives), _KINDS), positives, "anchor_id")
        known: dict[int, list[tuple[int, int]]] = {}
        for r in near.select("anchor_id", "id", "score").collect():
            known.setdefault(r["anchor_id"], []).append((r["id"], r["score"]))
        shared = spark.sparkContext.broadcast((trees, known))
        far = _ranked(whole.mapInArrow(_negatives(shared, negatives, low, high), _KINDS), negatives, "anchor_id", "positive_id")
        pairs = spark.createDataFrame([(a, p, s) for a, rows in known.items() for p, s in rows], "anchor_id long, positive_id long, positive_score long")
        done = staged(far.join(F.broadcast(pairs), ["anchor_id", "positive_id"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives")
        out = done if out is None else out.unionByName(done)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out


def anchor_rows() -> Column:
    """Every fiftieth id."""
    return F.col("id") % 50 == 0


def moved_label() -> Column:
    """The label, moved on by one where the id is divisible by 7."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def oracle() -> str:
    """The query's rows in SQL."""
    return f"""WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS z
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
        CAST(list_sum(list_transform(list_zip(a.z, b.z), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.z) = len(b.z) WHERE a.vec_id % 50 = 0),
    p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES}),
    n AS (SELECT p.a, p.b, p.score AS p_score, s.b AS neg, s.score AS n_score,
        row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
    SELECT a AS anchor_id, b AS positive_id, CAST(rank AS INTEGER) AS rank, neg AS negative_id, p_score AS positive_score,
      n_score AS negative_score FROM n WHERE rank <= {NEGATIVES}"""
