"""Next-token statistics and long-form scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.scores import ranked_probs
from tokenloom.operators import packing
from tokenloom.operators.corpus import split_name
from tokenloom.plans.lookups import lookup
from tokenloom.plans.staging import staged

#: Tokens whose pairs a task looks at together.
TOKENS_HELD = 1 << 18


def pair_totals(examples: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of (context, next) over the x, y pairs of the examples; combined before the shuffle."""
    pairs = examples.select(*by, F.explode(F.arrays_zip("x", "y")).alias("p"))
    return pairs.groupBy(*by, F.col("p.x").alias("context"), F.col("p.y").alias("next")).agg(
        F.count(F.lit(1)).alias("cnt")
    )


def _counted_pairs(by: str, vocab_size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(by, ids) to (by, context, next, cnt): a task holds a number for each pair of the vocabulary and value of ``by``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, np.ndarray] = {}

        def count(part: pa.RecordBatch) -> None:
            names = np.array(part.column(0).to_pylist(), object)
            for name in dict.fromkeys(names):
                ids = part.column(1).filter(pa.array(names == name))
                context, following = _adjacent(ids.flatten().to_numpy(zero_copy_only=False), ids.value_lengths().to_numpy(zero_copy_only=False))
                counted = np.bincount(context * vocab_size + following, minlength=vocab_size**2)
                held[name] = held[name] + counted if name in held else counted

        for batch in batches:
            for part in _in_token_batches(batch.column(1).value_lengths().to_pylist(), TOKENS_HELD, lambda rows: batch.slice(rows[0], rows[1] - rows[0])):
                count(part)
        for name, counted in held.items():
            pair = np.flatnonzero(counted)
            parts = pa.array([name] * len(pair), pa.string()), (pair // vocab_size).astype(np.int32), (pair % vocab_size).astype(np.int32), counted[pair]
            yield pa.RecordBatch.from_arrays([parts[0], *map(pa.array, parts[1:])], [by, "context", "next", "cnt"])

    return run


def stream_pair_totals(docs: DataFrame, length: int, vocab_size: int) -> DataFrame:
    """``pair_totals`` by ``split`` of the examples that ``packing.training_examples`` would make of a token table.

    The pairs of a shard's chunks are those of its stream up to the end of the last chunk. So documents count their own pairs
    where they lie, sizes and end tokens alone give the pairs between documents and what the cut takes off: no token array
    moves. As there, a shard too small for a chunk fails the job. A table that repeats a position has no one stream; it is packed.
    """
    if vocab_size**2 > PairModel.MOST:
        return pair_totals(packing.training_examples(docs, length), ["split"])
    ends = staged(docs.select("shard_id", "doc_pos", "n_tokens", F.get("ids", F.lit(0)).alias("first"), F.get("ids", F.size("ids") - 1).alias("last")), "ends")
    if not ends.groupBy("shard_id", "doc_pos").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return pair_totals(packing.training_examples(docs, length), ["split"])
    packing.require_chunks(ends, length)
    located = staged(packing.neighbours(ends, length), "located")
    split = split_name(F.col("shard_id")).alias("split")
    own = F.col("used") - F.col("start")
    cut = located.where(own < F.col("n_tokens")).select("shard_id", "doc_pos", F.greatest(own, F.lit(0)).cast("int").alias("_own"))
    kept = F.when(F.col("_own").isNull(), F.col("ids")).otherwise(F.slice("ids", F.lit(1), F.col("_own") + 1))
    whole = lookup(docs.where("n_tokens > 1"), cut, ["shard_id", "doc_pos"], "left", null_safe=True).select(split, kept.alias("ids"))
    inside = whole.mapInArrow(_counted_pairs("split", vocab_size), "split string, context int, next int, cnt long")
    between = located.where("before IS NOT NULL AND start <= used").select(split, F.col("before").alias("context"), F.col("first").alias("next"), F.lit(1).cast("long").alias("cnt"))
    return inside.unionByName(between).groupBy("split", "context", "next").agg(F.sum("cnt").alias("cnt"))


def next_token_counts(examples: DataFrame) -> DataFrame:
    """Pair counts with the total of their context and their log-probability.

    The window runs over counts: at most one vocabulary per context.
    """
    counts = pair_totals(examples)
    total = F.sum("cnt").over(Window.partitionBy("context"))
    return counts.withColumn("context_cnt", total).withColumn("logp", F.ln(F.col("cnt") / F.col("context_cnt")))


def context_stats(counts: DataFrame, vocab_size: int) -> DataFrame:
    """Per context: its count and the entropy of its add-one smoothed next-token distribution."""
    weight = (F.col("cnt") + 1) * F.ln(F.col("cnt") + 1)
    mass = F.sum("cnt") + F.lit(vocab_size)
    return counts.groupBy("context").agg(
        F.sum("cnt").alias("context_cnt"), (F.ln(mass) - F.sum(weight) / mass).alias("entropy")
    )


def token_pairs(df: DataFrame, key: Sequence[str], ids: str) -> DataFrame:
    """(context, next) of every cell: cell ``pos`` scores token ``pos + 1``."""
    size = F.size(ids)
    pairs = F.arrays_zip(
        F.slice(ids, F.lit(1), size - 1).alias("context"), F.slice(ids, F.lit(2), size - 1).alias("next")
    )
    return df.where(size > 1).select(*key, F.posexplode(pairs).alias("pos", "p")).select(*key, "pos", "p.*")


def score_pairs(
    pairs: DataFrame, counts: DataFrame, vocab_size: int, name: str, with_entropy: bool = False
) -> DataFrame:
    """Add the add-one smoothed log-probability ``name`` of every pair under a table of next-token counts.

    Unseen pairs and contexts need no rows: their counts are 0. ``counts`` is read three times and should be a table.
    """
    counts = counts.select("context", "next", "cnt")
    contexts = context_stats(counts, vocab_size)
    if not with_entropy:
        contexts = contexts.drop("entropy")
    found = lookup(pairs, counts, ["context", "next"], "left")
    found = lookup(found, contexts, ["context"], "left")
    seen = F.coalesce(F.col("cnt"), F.lit(0)) + 1
    mass = F.coalesce(F.col("context_cnt"), F.lit(0)) + F.lit(vocab_size)
    scored = found.withColumn(name, F.ln(seen / mass))
    if with_entropy:
        uniform = F.ln(F.lit(float(vocab_size)))
        scored = scored.withColumn("entropy", F.coalesce("entropy", uniform))
    return scored.drop("cnt", "context_cnt")


def score_unigrams(pairs: DataFrame, counts: DataFrame, vocab_size: int, name: str) -> DataFrame:
    """Add the add-one smoothed log-probability of the next token alone."""
    single = counts.groupBy("next").agg(F.sum("cnt").alias("cnt"))
    held = pairs.withColumn("_all", counts.agg(F.sum("cnt")).scalar())
    found = lookup(held, single, ["next"], "left")
    seen = F.coalesce(F.col("cnt"), F.lit(0)) + 1
    return found.withColumn(name, F.ln(seen / (F.col("_all") + F.lit(vocab_size)))).drop("cnt", "_all")


def score_tokens(pairs: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score (context, next) cells with a pluggable scorer: a join against a table of scores, or ``mapInArrow`` around
    a model that has to be called. The scorer must keep the rows and add its columns."""
    before = set(pairs.columns)
    scored = scorer(pairs)
    lost = before - set(scored.columns)
    if lost:
        raise ValueError(f"the scorer dropped columns {sorted(lost)}")
    return scored


def _adjacent(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, next) of all cells of the sequences that stand one after the other in ``ids``; a sequence of n has n - 1."""
    cell = np.ones(len(ids), bool)
    cell[np.cumsum(lengths)[lengths > 0] - 1] = False
    at = np.flatnonzero(cell)
    return ids[at].astype(np.int64), ids[at + 1].astype(np.int64)


@dataclass(frozen=True)
class PairModel:
    """Next-token counts as a model that is called with sequences: add-one smoothed log-probabilities and entropies.

    Pairs are numbers ``context * vocab_size + next`` in order; contexts are an index.
    """

    vocab_size: int
    pairs: np.ndarray
    counts: np.ndarray
    totals: np.ndarray
    entropies: np.ndarray

    #: A model is held by the driver and by each worker; tables with more pairs are for the join form.
    MOST = 4_000_000

    @classmethod
    def of(cls, counts: DataFrame, vocab_size: int) -> PairModel:
        rows = counts.select("context", "next", "cnt").limit(cls.MOST + 1).toPandas()
        if len(rows) > cls.MOST:
            raise ValueError(f"more than {cls.MOST} pairs: score against the table with score_pairs")
        pairs = rows["context"].to_numpy(np.int64) * vocab_size + rows["next"].to_numpy(np.int64)
        order = np.argsort(pairs)
        cnt = rows["cnt"].to_numpy(np.float64)
        totals = np.bincount(rows["context"], cnt, vocab_size)
        weight = np.bincount(rows["context"], (cnt + 1) * np.log(cnt + 1), vocab_size)
        entropies = np.log(totals + vocab_size) - weight / (totals + vocab_size)
        return cls(vocab_size, pairs[order], cnt[order], totals, entropies)

    def __call__(self, ids: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
        """Values of all cells of the sequences that stand one after the other in ``ids``; a sequence of n has n - 1."""
        context, following = _adjacent(ids, lengths)
        pair = context * self.vocab_size + following
        place = np.minimum(np.searchsorted(self.pairs, pair), max(len(self.pairs) - 1, 0))
        seen = np.where(self.pairs[place] == pair, self.counts[place], 0.0) if len(self.pairs) else np.zeros(len(pair))
        return {"logprobs": np.log((seen + 1) / (self.totals[context] + self.vocab_size)), "entropy": self.entropies[context]}


@dataclass(frozen=True)
class PairTable:
    """What a scorer of ``score_tokens`` gives each pair of the vocabulary, as a model that is called with sequences."""

    vocab_size: int
    values: dict[str, np.ndarray]

    @classmethod
    def of(cls, spark: SparkSession, scorer: Callable[[DataFrame], DataFrame], vocab_size: int, names: Sequence[str]) -> PairTable:
        if vocab_size**2 > PairModel.MOST:
            raise ValueError(f"more than {PairModel.MOST} pairs: score the cells with score_tokens")
        context, following = F.floor(F.col("id") / vocab_size).cast("int"), (F.col("id") % vocab_size).cast("int")
        pairs = spark.range(vocab_size**2).select(F.col("id").alias("pos"), context.alias("context"), following.alias("next"))
        rows = score_tokens(pairs, scorer).select("pos", *names).toPandas().sort_values("pos")
        if rows["pos"].tolist() != list(range(vocab_size**2)):
            raise ValueError("the scorer did not keep the rows")
        return cls(vocab_size, {n: rows[n].to_numpy(np.float64) for n in names})

    def __call__(self, ids: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
        context, following = _adjacent(ids, lengths)
        if len(ids) and not (0 <= ids.min() and ids.max() < self.vocab_size):
            raise ValueError("an id outside the vocabulary")
        pair = context * self.vocab_size + following
        return {n: v[pair] for n, v in self.values.items()}


def _in_token_batches(lengths: Sequence[int], tokens: int, use: Callable[[tuple[int, int]], object]) -> Iterator:
    """Rows first to last that hold ``tokens`` tokens at most; a longer row stands alone."""
    first, held = 0, 0
    for i, n in enumerate(lengths):
        if i > first and held + n > tokens:
            yield use((first, i))
            first, held = i, 0
        held += n
    if first < len(lengths):
        yield use((first, len(lengths)))


def score_sequences(df: DataFrame, ids: str, model: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]], names: Sequence[str], tokens: int = 1 << 18) -> DataFrame:
    """Add arrays ``names`` that a model gives for each cell of a sequence; cell ``pos`` scores token ``pos + 1``.

    Sequences, not cells, go through Arrow, in batches bounded by their tokens; no row moves. The model is broadcast: a worker
    gets it once, not with each task. A NULL sequence has NULL values, one of fewer than two tokens empty ones.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.ArrayType(T.DoubleType())) for n in names]])
    place = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

            def score(rows: tuple[int, int]) -> pa.RecordBatch:
                part = batch.slice(rows[0], rows[1] - rows[0])
                sizes = lengths[rows[0] : rows[1]]
                flat = part.column(place).flatten().to_numpy(zero_copy_only=False)
                values = shared.value(flat, sizes)
                ends = pa.array(np.concatenate([[0], np.cumsum(np.maximum(sizes - 1, 0))]), pa.int32())
                empty = part.column(place).is_null() if part.column(place).null_count else None
                arrays = [pa.ListArray.from_arrays(ends, pa.array(values[n], pa.float64()), mask=empty) for n in names]
                return pa.RecordBatch.from_arrays([*part.columns, *arrays], schema.names)

            yield from _in_token_batches(lengths.tolist(), tokens, score)

    return df.mapInArrow(run, schema)


def mean_loss(df: DataFrame, loss: Column, by: Sequence[str] = ()) -> DataFrame:
    """Mean loss over the positions that have one (ignored targets give NULL)."""
    return df.groupBy(*by).agg(F.avg(loss).alias("loss"), F.count(loss).alias("targets"))


def nucleus_cutoff(df: DataFrame, key: Sequence[str], probs: Column, top_p: float) -> DataFrame:
    """Long form of the ranking: per entry its rank, its preceding mass and whether it stays.

    Running masses need one row per entry, so this is for reports; filtering and sampling use ``nucleus`` inside the
    row.
    """
    ranked = df.select(*key, F.posexplode(ranked_probs(probs)).alias("rank", "e")).select(*key, "rank", "e.*")
    before = Window.partitionBy(*key).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    mass = F.coalesce(F.sum("p").over(before), F.lit(0.0))
    return ranked.withColumn("preceding_mass", mass).withColumn("kept", F.col("preceding_mass") <= top_p)
