"""Offsets, packing, shuffling, batching."""

from pyspark.sql import functions as F

from tokenloom.catalog import tables as t
from tokenloom.catalog import vocab_queries as VQ
from tokenloom.catalog.registry import query, text
from tokenloom.operators import corpus as C
from tokenloom.operators import packing as K
from tokenloom.operators import vocab as V
from tokenloom.plans.staging import new_folder
from tokenloom.sources import shards as S

L = t.LENGTH
BATCH = 128
EPOCHS = 2


@query(
    "token_offsets",
    f"""WITH {t.SQL_TOKENS} SELECT shard_id, doc_pos, len(ids) AS n_tokens,
    CAST(coalesce(sum(len(ids)) OVER (PARTITION BY shard_id ORDER BY doc_pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM token_docs""",
)
def token_offsets(spark, sf):
    sizes = C.pretokenize_bytes(t.corpus(spark, sf)).select("shard_id", "doc_pos", "n_tokens")
    return K.token_offsets(sizes).withColumn("n_tokens", F.col("n_tokens").cast("long"))


@query(
    "pack_sequences",
    f"WITH {t.SQL_CHUNKS} SELECT shard_id, chunk_id, array_to_string(chunk, ',') AS chunk FROM chunks",
)
def pack_sequences(spark, sf):
    return K.pack_sequences(t.token_docs(spark, sf), L).withColumn("chunk", text("chunk"))


SQL_EXAMPLES = f"""WITH {t.SQL_CHUNKS}
  SELECT CASE WHEN shard_id > 0 THEN 'train' ELSE 'test' END AS split, shard_id, chunk_id,
    array_to_string(chunk[1:{L}], ',') AS x, array_to_string(chunk[2:{L + 1}], ',') AS y FROM chunks"""


@query("training_examples", SQL_EXAMPLES)
def training_examples(spark, sf):
    return t.examples(spark, sf).withColumns({"x": text("x"), "y": text("y")})


@query(
    "shift_xy",
    f"""WITH {t.SQL_CHUNKS} SELECT shard_id, chunk_id, chunk[1] AS x_first, chunk[{L}] AS x_last,
      chunk[2] AS y_first, chunk[{L + 1}] AS y_last FROM chunks""",
)
def shift_xy(spark, sf):
    rows = K.shift_xy(K.pack_sequences(t.token_docs(spark, sf), L), L)
    return rows.select(
        "shard_id",
        "chunk_id",
        F.element_at("x", 1).alias("x_first"),
        F.element_at("x", -1).alias("x_last"),
        F.element_at("y", 1).alias("y_first"),
        F.element_at("y", -1).alias("y_last"),
    )


SHORT_LENGTH = 60_000


@query(
    "require_chunks",
    f"""WITH {t.SQL_STREAMS} SELECT shard_id, len(toks) AS tokens FROM streams
    WHERE len(toks) // {SHORT_LENGTH} - 1 <= 0""",
)
def require_chunks(spark, sf):
    """Shards too small for chunks of 60,000 tokens."""
    sizes = C.pretokenize_bytes(t.corpus(spark, sf)).select("shard_id", "n_tokens")
    return K.short_shards(sizes, SHORT_LENGTH)


SQL_SHUFFLE = f"""keys AS (
  SELECT shard_id, unnest(range(greatest(len(toks) // {L} - 1, 0))) AS chunk_id FROM streams),
shuffled AS (
  SELECT epoch, shard_id, chunk_id, md5('42|' || epoch || '|' || shard_id) AS shard_key,
         md5('42|' || epoch || '|' || shard_id || '|' || chunk_id) AS chunk_key
  FROM keys CROSS JOIN range({EPOCHS}) e(epoch)),
batched AS (
  SELECT *, row_number() OVER (ORDER BY epoch, shard_key, shard_id, chunk_key, chunk_id) - 1 AS stream_pos
  FROM shuffled)"""
SQL_SHUFFLED = f"{t.SQL_STREAMS}, {SQL_SHUFFLE}"


@query("shuffle_examples", f"WITH {SQL_SHUFFLED} SELECT epoch, shard_id, chunk_id, shard_key, chunk_key FROM shuffled")
def shuffle_examples(spark, sf):
    return K.shuffle_examples(t.chunk_keys(spark, sf), EPOCHS)


@query(
    "assign_batches",
    f"WITH {SQL_SHUFFLED} SELECT epoch, shard_id, chunk_id, stream_pos, stream_pos // {BATCH} AS batch_id FROM batched",
)
def assign_batches(spark, sf):
    shuffled = K.shuffle_examples(t.chunk_keys(spark, sf), EPOCHS)
    return K.assign_batches(shuffled, BATCH).drop("shard_key", "chunk_key")


def served_batches(tokens):
    examples = K.training_examples(tokens, L)
    order = K.assign_batches(K.shuffle_examples(K.chunk_keys(tokens, L), EPOCHS), BATCH)
    served = K.serve_batches(examples.select("shard_id", "chunk_id", "x", "y"), order, {"x": text("x"), "y": text("y")})
    return served.select("epoch", "batch_id", "stream_pos", "x", "y")


@query(
    "batches",
    f"""WITH {t.SQL_CHUNKS}, {SQL_SHUFFLE} SELECT epoch, stream_pos // {BATCH} AS batch_id, stream_pos,
      array_to_string(chunk[1:{L}], ',') AS x, array_to_string(chunk[2:{L + 1}], ',') AS y
    FROM batched JOIN chunks USING (shard_id, chunk_id)""",
)
def batches(spark, sf):
    """Token shards as they were written, served as shuffled batches of inputs and labels."""
    path = new_folder(spark, "token_shards")
    S.write_token_shards(C.pretokenize_bytes(t.corpus(spark, sf)), "tok259", path)
    return served_batches(S.read_token_shards(spark, path, "custom", 259))


@query(
    "trained_batches",
    f"""WITH {VQ.SQL_ENCODED},
    streams AS (SELECT shard_id, flatten(list(ids ORDER BY doc_pos)) AS toks FROM encoded GROUP BY shard_id),
    {t.SQL_CUT}, {SQL_SHUFFLE} SELECT epoch, stream_pos // {BATCH} AS batch_id, stream_pos,
      array_to_string(chunk[1:{L}], ',') AS x, array_to_string(chunk[2:{L + 1}], ',') AS y
    FROM batched JOIN chunks USING (shard_id, chunk_id)""",
)
def trained_batches(spark, sf):
    """The corpus as token shards of the trained vocabulary, read back by its name and served as shuffled batches."""
    path = new_folder(spark, "token_shards")
    encoded = C.pretokenize(t.corpus(spark, sf), lambda d: V.encode_corpus(d, VQ.trained(spark, sf)))
    S.write_token_shards(encoded, S.vocab_name("custom", VQ.VOCAB_SIZE), path)
    return served_batches(S.read_token_shards(spark, path, "custom", VQ.VOCAB_SIZE))


@query(
    "worker_streams",
    f"""WITH {t.SQL_STREAMS},
    keys AS (SELECT shard_id, unnest(range(greatest(len(toks) // {L} - 1, 0))) AS chunk_id FROM streams),
    seeded AS (
      SELECT shard_id, chunk_id, rank, worker, 42 + worker + 1337 * rank AS seed
      FROM keys CROSS JOIN range(2) a(rank) CROSS JOIN range(2) b(worker)),
    shuffled AS (
      SELECT *, md5(seed || '|0|' || shard_id) AS shard_key, md5(seed || '|0|' || shard_id || '|' || chunk_id) AS chunk_key
      FROM seeded)
    SELECT rank, worker, shard_id, chunk_id, row_number() OVER (
      PARTITION BY rank, worker ORDER BY shard_key, shard_id, chunk_key, chunk_id) - 1 AS stream_pos FROM shuffled""",
)
def worker_streams(spark, sf):
    """Every worker of every rank reads all chunks in an order of its own."""
    seeded = K.worker_seeds(t.chunk_keys(spark, sf), workers=2, ranks=2)
    placed = K.assign_batches(K.shuffle_examples(seeded, 1), BATCH)
    return placed.select("rank", "worker", "shard_id", "chunk_id", "stream_pos")


@query(
    "minibatch_permutation",
    f"""WITH {t.SQL_ROLLOUTS}, keyed AS (
      SELECT rollout_id, epoch, md5('0|' || epoch || '|' || rollout_id) AS k FROM rollouts CROSS JOIN range(4) e(epoch)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY k, rollout_id) - 1 AS place FROM keyed)
    SELECT rollout_id, epoch, place, place // 32 AS backward_batch, (place % 32) // 8 AS mini_batch FROM placed""",
)
def minibatch_permutation(spark, sf):
    return K.minibatch_permutation(t.rollout_rows(spark, sf), "rollout_id", epochs=4, mini_batch=8, grad_accum=4)
