"""Token streams to training examples: offsets, packing, shuffling, batching.

A shard may be arbitrarily large: offsets and orders are running values over bounded buckets, and a packed chunk never
gathers more than its own L+1 tokens.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.arrays import packed, unpacked
from tokenloom.operators.corpus import split_name
from tokenloom.plans.lookups import BROADCAST_ROWS, join_null_safe, lookup
from tokenloom.plans.running import BUCKET_WIDTH, blocks, hashed_position, running
from tokenloom.plans.staging import shuffles_removed, staged

# Fixed values of the per-worker shuffle seed.
BASE_SEED = 42
RANK_STRIDE = 1337

#: Chunks of a shard that one task numbers at a time, and narrow rows that one task sorts.
CHUNKS_PER_BLOCK, ROWS_PER_TASK = 1 << 13, 1 << 20


def _with_sizes(df: DataFrame) -> DataFrame:
    return df if "n_tokens" in df.columns else df.withColumn("n_tokens", F.size("ids"))


def _stored(df: DataFrame) -> bool:
    """Whether the table carries the layout that ``write_token_shards`` has written."""
    return {"block", "block_start"} <= set(df.columns)


def _block_starts(df: DataFrame) -> DataFrame:
    """(shard_id, block, _first, _shard_tokens) from the totals of stored blocks, a small table.

    Positions inside a block hold only for all of its documents, so a block with a gap is an error.
    """
    tokens = F.sum(F.col("n_tokens").cast("long"))
    totals = df.groupBy("shard_id", "block").agg(tokens.alias("_tokens"), F.max(F.col("block_start") + F.col("n_tokens")).alias("_end"))
    whole = F.when(F.col("_tokens") == F.col("_end"), F.col("_tokens")).otherwise(F.raise_error(F.lit("documents of a stored block are missing: drop block and block_start")).cast("long"))
    earlier = Window.partitionBy("shard_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard_id", "block", whole.alias("_tokens")).select(
        "shard_id",
        "block",
        F.coalesce(F.sum("_tokens").over(earlier), F.lit(0)).alias("_first"),
        F.sum("_tokens").over(Window.partitionBy("shard_id")).alias("_shard_tokens"),
    )


def _narrow_offsets(df: DataFrame, width: int) -> DataFrame:
    return running(
        df.select("shard_id", "doc_pos", "n_tokens"),
        group=["shard_id"],
        bucket=[blocks("doc_pos", width)],
        order=["doc_pos"],
        value=F.col("n_tokens").cast("long"),
        kind="sum",
        name="start",
    )


def _integer_arrays(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType in (T.ArrayType(T.IntegerType(), True), T.ArrayType(T.IntegerType(), False))]


def _moved(df: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join ``df`` to narrow rows by shuffles: integer arrays move in few bits, and are not sorted as the narrow rows are hashed."""
    arrays = _integer_arrays(df)
    joined = join_null_safe(df.withColumns({c: packed(F.col(c)) for c in arrays}), small.hint("shuffle_hash"), on)
    return joined.withColumns({c: unpacked(F.col(c)) for c in arrays})


def _located(df: DataFrame, width: int, sizes: DataFrame | None = None) -> DataFrame:
    """``df`` with ``start``, ``_shard_tokens`` and whether its shard has a document at each position once (``_single``).

    Of a stored layout only block totals are joined. Otherwise positions are computed on (shard, position, size) rows and
    joined back, for which a position must be unique in its shard; ``sizes`` are those rows, if they were written before. Token
    arrays move here only if those rows are too many to be broadcast.
    """
    if _stored(df):
        found = lookup(df, _block_starts(df), ["shard_id", "block"], null_safe=True)
        return found.withColumns({"start": F.col("_first") + F.col("block_start"), "_single": F.lit(True)}).drop("_first")
    narrow = df.select("shard_id", "doc_pos", "n_tokens") if sizes is None else sizes
    places = narrow.groupBy("shard_id", "doc_pos").agg(F.sum(F.col("n_tokens").cast("long")).alias("_tokens"), F.count(F.lit(1)).alias("_rows"))
    totals = places.groupBy("shard_id").agg(F.sum("_tokens").alias("_shard_tokens"), (F.max("_rows") == 1).alias("_single"))
    starts = join_null_safe(_narrow_offsets(narrow, width), totals, ["shard_id"]).drop("n_tokens")
    # three numbers a document: their count is their size
    if narrow.count() <= BROADCAST_ROWS:
        return join_null_safe(df, starts, ["shard_id", "doc_pos"], small=True)
    return _moved(df, starts, ["shard_id", "doc_pos"])


def neighbours(ends: DataFrame, length: int, width: int = BUCKET_WIDTH) -> DataFrame:
    """Documents with tokens, as (shard_id, doc_pos, n_tokens, first, last) tokens: add ``start``, the token ``before`` it in its
    shard (NULL for the first) and ``used``, the tokens of the shard that chunks take as inputs. A position must be unique."""
    held = ends.where(F.col("n_tokens") > 0)
    rule = dict(group=["shard_id"], bucket=[blocks("doc_pos", width)], order=["doc_pos"])
    starts = running(held, **rule, value=F.col("n_tokens").cast("long"), kind="sum", name="start")
    placed = running(starts, **rule, value=F.col("last"), kind="last", name="before")
    used = chunk_counts(held, length).select("shard_id", (F.col("chunks") * length).alias("used"))
    return lookup(placed, used, ["shard_id"], null_safe=True)


def token_offsets(df: DataFrame, width: int = BUCKET_WIDTH) -> DataFrame:
    """Add ``start``: the position of each document in the token stream of its shard."""
    sizes = _with_sizes(df)
    if not _stored(df) and set(sizes.columns) == {"shard_id", "doc_pos", "n_tokens"}:
        return _narrow_offsets(sizes, width)
    return _located(sizes, width).drop("_shard_tokens", "_single")


def _chunks(tokens: Column, length: int) -> Column:
    return F.greatest(F.floor(tokens / F.lit(length)) - 1, F.lit(0)).cast("long")


def chunk_counts(df: DataFrame, length: int) -> DataFrame:
    """Tokens and chunks per shard: ``tokens div length - 1`` chunks are kept, never fewer than 0."""
    tokens = F.sum((F.col("n_tokens") if "n_tokens" in df.columns else F.size("ids")).cast("long"))
    return df.groupBy("shard_id").agg(tokens.alias("tokens")).withColumn("chunks", _chunks(F.col("tokens"), length))


def chunk_keys(df: DataFrame, length: int) -> DataFrame:
    """(shard_id, chunk_id) of every chunk of a token table, from the sizes of its documents.

    A shard's chunks are numbered in blocks that are dealt to tasks, so a large shard is not numbered by one.
    """
    counts = chunk_counts(df, length).where(F.col("chunks") > 0)
    last = F.floor((F.col("chunks") - 1) / F.lit(CHUNKS_PER_BLOCK)).cast("long")
    blocked = counts.select("shard_id", "chunks", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_block"))
    first = F.col("_block") * CHUNKS_PER_BLOCK
    numbers = F.sequence(first, F.least(first + (CHUNKS_PER_BLOCK - 1), F.col("chunks") - 1))
    return blocked.repartition(_tasks(df), "shard_id", "_block").select("shard_id", F.explode(numbers).alias("chunk_id"))


def _tasks(df: DataFrame, rows: int = 0) -> int:
    """As many tasks as the session shuffles to, more if a task got over a million narrow rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def pack_sequences(df: DataFrame, length: int, width: int = BUCKET_WIDTH, strict: bool = False) -> DataFrame:
    """Cut every shard's stream at multiples of ``length``: chunk i holds tokens [i*L, i*L + L + 1).

    Documents are sliced into the chunks they touch, so rows grow with documents and chunks, not with tokens. A chunk that lies
    in one document is cut where the document is; only the parts of chunks that documents share are shuffled, once, by chunk.
    ``strict`` fails on a shard too small for a chunk.
    """
    located = _located(_with_sizes(df), width).withColumn("_chunks", _chunks(F.col("_shard_tokens"), length))
    if strict:
        message = F.concat(F.lit("shard too small for a chunk: "), F.coalesce(F.col("shard_id").cast("string"), F.lit("NULL")))
        located = located.where(F.when(F.col("_chunks") == 0, F.raise_error(message).cast("boolean")).otherwise(True))
    parts = _cut(located, length, F.col("_chunks") - 1)
    # at a repeated position documents overlap, so a part of full length need not be all of its chunk
    whole = F.col("_single") & (F.col("_high") - F.col("_low") == length + 1)
    inside = parts.where(whole).select("shard_id", "chunk_id", F.col("part").alias("chunk"))
    return inside.unionByName(_gathered(parts.where(~whole)).drop("_tail"))


def _cut(located: DataFrame, length: int, last_chunk: Column, tail: bool = False) -> DataFrame:
    """Documents with ``start`` to the parts (shard_id, chunk_id, _tail, _single, _low, _high, part) of chunks up to ``last_chunk``.

    With ``tail``, also one part of each document that reaches behind them, as chunk ``last_chunk + 1``.
    """
    L = F.lit(length).cast("long")
    start, end = F.col("start"), F.col("start") + F.col("n_tokens")
    # A token at a multiple of L is also the last label of the chunk before it.
    first = F.greatest(F.floor((start - 1) / L), F.lit(0)).cast("long")
    last = F.floor((end - 1) / L).cast("long")
    behind = (last_chunk + 1) * L
    numbers = F.when(first <= F.least(last, last_chunk), F.sequence(first, F.least(last, last_chunk))).otherwise(F.array().cast("array<long>"))
    if tail:
        numbers = F.concat(numbers, F.when(end > behind, F.array(last_chunk + 1)).otherwise(F.array().cast("array<long>")))
    is_tail = F.col("chunk_id") == last_chunk + 1
    low = F.greatest(start, F.col("chunk_id") * L)
    high = F.when(is_tail, end).otherwise(F.least(end, F.col("chunk_id") * L + L + 1))
    return (
        located.where(F.col("n_tokens") > 0)
        .withColumn("chunk_id", F.explode(numbers))
        .withColumns({"_low": low, "_high": high, "_tail": is_tail})
        .where(F.col("_low") < F.col("_high"))
        .select(
            "shard_id",
            "chunk_id",
            "_tail",
            "_single",
            "_low",
            "_high",
            F.slice("ids", (F.col("_low") - start + 1).cast("int"), (F.col("_high") - F.col("_low")).cast("int")).alias("part"),
        )
    )


def _gathered(parts: DataFrame) -> DataFrame:
    """Parts to chunks; parts move in few bits."""
    ordered = F.array_sort(F.transform("parts", lambda p: F.struct(p["_low"].alias("_low"), unpacked(p["part"]).alias("part"))))
    return (
        parts.groupBy("shard_id", "chunk_id", "_tail")
        .agg(F.collect_list(F.struct("_low", packed(F.col("part")).alias("part"))).alias("parts"))
        .select("shard_id", "chunk_id", "_tail", F.flatten(ordered["part"]).alias("chunk"))
    )


def pack_with_tails(df: DataFrame, length: int, before: DataFrame, width: int = BUCKET_WIDTH) -> DataFrame:
    """Chunks of the streams that go on from ``before`` (shard_id, next_chunk, ids: tokens left over), and what is left over now.

    Rows (shard_id, chunk_id, tail, chunk): chunks numbered on from ``next_chunk``, and for each shard of ``df`` one row with
    ``tail``, whose ``chunk_id`` is the next chunk's and whose tokens, fewer than 2L, are left over. One pass of offsets.
    """
    held = before.select("shard_id", F.lit(-1).cast("long").alias("doc_pos"), "ids", F.size("ids").alias("n_tokens"))
    docs = _with_sizes(df).select("shard_id", "doc_pos", "ids", "n_tokens").unionByName(held)
    # a micro-batch has no pruned scan: whoever reads its sizes reads its token arrays too
    sizes = staged(docs.select("shard_id", "doc_pos", "n_tokens"), "sizes")
    located = _located(docs, width, sizes).withColumn("_chunks", _chunks(F.col("_shard_tokens"), length))
    packed = _gathered(_cut(located, length, F.col("_chunks") - 1, tail=True))
    # every shard has a tail of L tokens at least, or all it has: only one without tokens has none
    empty = sizes.groupBy("shard_id").agg(F.sum("n_tokens").alias("_n")).where("_n = 0")
    none = empty.select("shard_id", F.lit(0).cast("long").alias("chunk_id"), F.lit(True).alias("_tail"), F.array().cast("array<int>").alias("chunk"))
    numbered = join_null_safe(packed.unionByName(none), before.select("shard_id", "next_chunk"), ["shard_id"], "left")
    chunk_id = F.col("chunk_id") + F.coalesce("next_chunk", F.lit(0))
    return numbered.select("shard_id", chunk_id.alias("chunk_id"), F.col("_tail").alias("tail"), "chunk")


def shift_xy(df: DataFrame, length: int) -> DataFrame:
    """Inputs and labels of a chunk: the labels are the inputs moved by one token."""
    return df.withColumns({"x": F.slice("chunk", 1, length), "y": F.slice("chunk", 2, length)}).drop("chunk")


def training_examples(df: DataFrame, length: int, width: int = BUCKET_WIDTH) -> DataFrame:
    """(split, shard_id, chunk_id, x, y) rows of a token table. A shard too small for a chunk fails the job."""
    examples = shift_xy(pack_sequences(df, length, width, strict=True), length)
    return examples.select(split_name(F.col("shard_id")).alias("split"), "shard_id", "chunk_id", "x", "y")


def short_shards(df: DataFrame, length: int) -> DataFrame:
    """Shards that yield no chunk; must be empty."""
    return chunk_counts(df, length).where(F.col("chunks") == 0).select("shard_id", "tokens")


def require_chunks(df: DataFrame, length: int) -> None:
    """Fail when a shard is too small to yield a chunk."""
    short = short_shards(df, length).limit(5).collect()
    if short:
        raise ValueError(f"shards too small for chunks of {length} tokens: {[r['shard_id'] for r in short]}")


def worker_seeds(df: DataFrame, workers: int, ranks: int) -> DataFrame:
    """One copy of ``df`` per (rank, worker) with its seed: every worker reads all data in an order of its own."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(r).alias("rank"),
                F.lit(w).alias("worker"),
                F.lit(BASE_SEED + w + RANK_STRIDE * r).alias("seed"),
            )
            for r in range(ranks)
            for w in range(workers)
        ]
    )
    return df.withColumn("_who", F.explode(pairs)).select(*df.columns, "_who.*")


def shuffle_examples(df: DataFrame, epochs: int, seed: int = BASE_SEED, keep: Sequence[str] = ()) -> DataFrame:
    """Per epoch an order key for the shard and one for the chunk: sort by both to get the shuffled stream.

    A ``seed`` column in ``df`` (see ``worker_seeds``) overrides the parameter. ``keep`` names more columns to carry;
    leave the token arrays out when only the order is wanted.
    """
    seeds = F.col("seed") if "seed" in df.columns else F.lit(seed)
    who = [c for c in ("rank", "worker") if c in df.columns]
    return (
        df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("shard_key", F.md5(F.concat_ws("|", seeds, "epoch", "shard_id")))
        .withColumn("chunk_key", F.md5(F.concat_ws("|", seeds, "epoch", "shard_id", "chunk_id")))
        .select(*who, "epoch", "shard_id", "chunk_id", "shard_key", "chunk_key", *keep)
    )


def assign_batches(df: DataFrame, batch_size: int, digits: int = 3) -> DataFrame:
    """Number the shuffled stream (``stream_pos``) and cut it into batches that run across epoch borders.

    Positions inside a shard come from hash buckets; the shards and epochs before are sums over the manifest.
    """
    who = [c for c in ("rank", "worker") if c in df.columns]
    shard = [*who, "epoch", "shard_key", "shard_id"]
    counts = staged(df.groupBy(*shard).agg(F.count(F.lit(1)).alias("_n")), "chunks-per-shard")
    rows = counts.agg(F.sum("_n")).first()[0] or 0
    placed = hashed_position(df, group=shard, key="chunk_key", ties=["chunk_id"], name="_in_shard", digits=digits, partitions=_tasks(df, rows))
    earlier = (
        Window.partitionBy(*who)
        .orderBy("epoch", "shard_key", "shard_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = counts.select(*shard, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        lookup(placed, before, shard, null_safe=True)
        .withColumn("stream_pos", F.col("_before") + F.col("_in_shard"))
        .withColumn("batch_id", F.floor(F.col("stream_pos") / F.lit(batch_size)).cast("long"))
        .drop("_before", "_in_shard")
    )


def serve_batches(examples: DataFrame, order: DataFrame, shown: Mapping[str, Column] | None = None) -> DataFrame:
    """Examples in the order of ``assign_batches``: one row for each place of an example in the stream.

    The order is made of keys alone and meets the token arrays once, whatever the number of epochs. It is written first, so that
    the shuffles it took are gone when the arrays move. Its rows are held in hash tables, so the arrays are not sorted; they are
    copied for each epoch behind the join. ``shown`` names expressions to be computed once for an example, before it is copied.
    """
    with shuffles_removed(order.sparkSession):
        order = staged(order.select("shard_id", "chunk_id", "epoch", "stream_pos", "batch_id"), "order")
    places = order.groupBy("shard_id", "chunk_id").agg(F.collect_list(F.struct("epoch", "stream_pos", "batch_id")).alias("_places"))
    joined = _moved(examples, places, ["shard_id", "chunk_id"]).withColumns(dict(shown or {}))
    return joined.withColumn("_place", F.explode("_places")).select("_place.*", *examples.columns)


def minibatch_permutation(
    df: DataFrame, key: str, epochs: int, mini_batch: int, grad_accum: int = 1, seed: int = 0, digits: int = 3
) -> DataFrame:
    """Permute the rows per optimisation epoch, cut into backward batches, then into mini-batches."""
    backward = mini_batch * grad_accum
    keyed = (
        df.select(key)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("_key", F.md5(F.concat_ws("|", F.lit(seed), "epoch", key)))
    )
    placed = hashed_position(keyed, group=["epoch"], key="_key", ties=[key], name="place", digits=digits)
    return placed.select(
        key,
        "epoch",
        "place",
        F.floor(F.col("place") / F.lit(backward)).cast("long").alias("backward_batch"),
        F.floor((F.col("place") % F.lit(backward)) / F.lit(mini_batch)).cast("long").alias("mini_batch"),
    )
