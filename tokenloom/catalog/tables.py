"""Operator inputs derived from the driver tables, each with the SQL that derives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.rollout import concat_prompt_response, length_reward, response_mask
from tokenloom.functions.text import BYTE_OFFSET, add_bos_eos, byte_tokenize
from tokenloom.operators import packing, rollouts, scoring
from tokenloom.operators.corpus import pretokenize_bytes
from tokenloom.plans.lookups import join_null_safe
from tokenloom.plans.running import ordered_position
from tokenloom.plans.session import spread_small
from tokenloom.plans.staging import staged
from tokenloom.sources.shards import with_shard_ids

T = TypeVar("T")
LENGTH = 256
BYTE_VOCAB = BYTE_OFFSET + 256


_derived: dict[tuple[str, str, str], object] = {}


def derived(fn: Callable[[SparkSession, str], T]) -> Callable[[SparkSession, str], T]:
    """Derive an input once per session and data folder; several queries read the table that was written."""

    @functools.wraps(fn)
    def get(spark: SparkSession, sf: str) -> T:
        key = (spark.sparkContext.applicationId, sf, fn.__name__)
        if key not in _derived:
            _derived[key] = fn(spark, sf)
        return _derived[key]

    return get


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- documents ------------------------------------------------------------------------------------------------------

_SPACE_CLASS = r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: More turns than a conversation can have; keeps the ids of rollouts apart.
TURNS = 1 << 20

SQL_STRIP = rf"regexp_replace(text, '^{_SPACE_CLASS}+|{_SPACE_CLASS}+$', '', 'g')"

SQL_CORPUS = """corpus AS (
  SELECT CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) AS shard_id, doc_id AS doc_pos, text FROM documents)"""


def sql_bytes(expr: str) -> str:
    return f"list_transform(regexp_extract_all(hex({expr}), '..'), lambda h: CAST('0x' || h AS INTEGER) + 3)"


SQL_TOKENS = f"""{SQL_CORPUS},
stripped AS (SELECT shard_id, doc_pos, {SQL_STRIP} AS text FROM corpus),
token_docs AS (SELECT shard_id, doc_pos, list_concat([1], {sql_bytes('text')}) AS ids FROM stripped)"""

SQL_STREAMS = f"""{SQL_TOKENS},
streams AS (SELECT shard_id, flatten(list(ids ORDER BY doc_pos)) AS toks FROM token_docs GROUP BY shard_id)"""

# A token at a multiple of the length is also the last label of the chunk before it.
SQL_CUT = f"""numbered AS (
  SELECT shard_id, unnest(toks) AS tok, unnest(range(len(toks))) AS i, greatest(len(toks) // {LENGTH} - 1, 0) AS n FROM streams),
chunks AS MATERIALIZED (SELECT shard_id, chunk_id, list(tok ORDER BY i) AS chunk FROM (
  SELECT shard_id, i // {LENGTH} AS chunk_id, tok, i FROM numbered WHERE i // {LENGTH} < n
  UNION ALL SELECT shard_id, i // {LENGTH} - 1, tok, i FROM numbered WHERE i % {LENGTH} = 0 AND i > 0 AND i // {LENGTH} - 1 < n)
  GROUP BY shard_id, chunk_id)"""

SQL_CHUNKS = f"{SQL_STREAMS}, {SQL_CUT}"

# The pairs of all chunks of a shard are those of its stream up to the last chunk's end.
SQL_COUNTS = f"""{SQL_STREAMS},
used AS (SELECT shard_id, toks, greatest(len(toks) // {LENGTH} - 1, 0) * {LENGTH} AS n FROM streams),
steps AS (SELECT shard_id, unnest(toks[1:n]) AS context, unnest(toks[2:n + 1]) AS next FROM used),
counts_train AS MATERIALIZED (SELECT context, next, count(*) AS cnt FROM steps WHERE shard_id > 0 GROUP BY ALL),
counts_all AS MATERIALIZED (SELECT context, next, count(*) AS cnt FROM steps GROUP BY ALL)"""


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """(shard_id, doc_pos, text): shards are the sources in name order."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    ids = with_shard_ids(spread_small(docs, "doc_id"), "source")
    return ids.select("shard_id", F.col("doc_id").alias("doc_pos"), "text")


@derived
def token_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Byte tokens of every document, written once."""
    return staged(pretokenize_bytes(corpus(spark, sf)), "tokens")


def examples(spark: SparkSession, sf: str) -> DataFrame:
    return packing.training_examples(token_docs(spark, sf), LENGTH)


def chunk_keys(spark: SparkSession, sf: str) -> DataFrame:
    """(shard_id, chunk_id) of every example, without its tokens."""
    return packing.chunk_keys(token_docs(spark, sf).select("shard_id", "n_tokens"), LENGTH)


# --- conversations --------------------------------------------------------------------------------------------------

SQL_ROLLOUTS = f"""turns AS (
  SELECT u.conv_id * 1048576 + u.turn AS rollout_id, u.conv_id, u.text AS q, a.text AS r
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'),
rollout_ids AS (
  SELECT rollout_id, conv_id, list_concat([1], {sql_bytes('q')}) AS query_ids,
         list_concat({sql_bytes('r')}, [2]) AS response_ids FROM turns),
rollouts AS (SELECT *, -abs(200 - len(response_ids)) / 100.0::DOUBLE AS score FROM rollout_ids)"""

SQL_CELLS = f"""{SQL_COUNTS},
{SQL_ROLLOUTS},
placed AS (
  SELECT rollout_id, conv_id, score, query_ids, response_ids, list_concat(query_ids, response_ids) AS ids,
         least(len(response_ids) // 200, 9) AS band FROM rollouts),
bands AS (SELECT band, avg(score) AS value FROM placed GROUP BY band),
tokens AS (
  SELECT rollout_id, conv_id, score, band, len(ids) AS n, unnest(range(len(ids) - 1)) AS pos,
         unnest(ids[1 : len(ids) - 1]) AS context, unnest(ids[2 : len(ids)]) AS next,
         unnest(list_transform(range(len(ids) - 1), lambda i: CASE WHEN i >= len(query_ids) - 1 THEN 1 ELSE 0 END)) AS mask
  FROM placed),
ctx_train AS (
  SELECT context, sum(cnt) AS total,
         ln(sum(cnt) + {BYTE_VOCAB}) - sum((cnt + 1) * ln(cnt + 1)) / (sum(cnt) + {BYTE_VOCAB}) AS entropy
  FROM counts_train GROUP BY context),
ctx_all AS (SELECT context, sum(cnt) AS total FROM counts_all GROUP BY context),
uni AS (SELECT next, sum(cnt) AS cnt FROM counts_train GROUP BY next),
mass AS (SELECT sum(cnt) AS total FROM uni),
cells AS MATERIALIZED (
  SELECT t.rollout_id, t.conv_id, t.score, t.pos, t.n, t.mask,
         ln((coalesce(p.cnt, 0) + 1) / (coalesce(c.total, 0) + {BYTE_VOCAB})::DOUBLE) AS logprob,
         ln((coalesce(u.cnt, 0) + 1) / (m.total + {BYTE_VOCAB})::DOUBLE) AS ref_logprob,
         ln((coalesce(a.cnt, 0) + 1) / (coalesce(d.total, 0) + {BYTE_VOCAB})::DOUBLE) AS new_logprob,
         coalesce(c.entropy, ln({BYTE_VOCAB}::DOUBLE)) AS entropy,
         b.value AS value, b.value + (t.pos % 7 - 3) / 10.0::DOUBLE AS vpred
  FROM tokens t
  LEFT JOIN counts_train p ON p.context = t.context AND p.next = t.next
  LEFT JOIN ctx_train c ON c.context = t.context
  LEFT JOIN uni u ON u.next = t.next
  LEFT JOIN counts_all a ON a.context = t.context AND a.next = t.next
  LEFT JOIN ctx_all d ON d.context = t.context
  JOIN bands b ON b.band = t.band
  CROSS JOIN mass m)"""



def sql_rewards(penalty: str) -> str:
    return f"""{SQL_CELLS},
rewarded AS (
  SELECT *, -0.2::DOUBLE * {penalty} AS non_score_reward,
         -0.2::DOUBLE * {penalty} + CASE WHEN pos = n - 2 THEN score ELSE 0 END AS reward
  FROM cells)"""


SQL_REWARDS = sql_rewards("(logprob - ref_logprob)")

SQL_ADVANTAGES = f"""{SQL_REWARDS},
masked AS (SELECT *, value * mask AS v, reward * mask AS r FROM rewarded),
residual AS (
  SELECT *, r + coalesce(lead(v) OVER (PARTITION BY rollout_id ORDER BY pos), 0) - v AS delta FROM masked),
raw AS MATERIALIZED (
  SELECT *, sum(delta * power(0.95::DOUBLE, pos)) OVER (PARTITION BY rollout_id ORDER BY pos DESC)
            / power(0.95::DOUBLE, pos) AS adv FROM residual),
stat AS (
  SELECT avg(adv) FILTER (WHERE mask = 1) AS mean, var_samp(adv) FILTER (WHERE mask = 1) AS var FROM raw),
advantages AS (
  SELECT raw.*, adv + v AS ret, (adv - stat.mean) / sqrt(stat.var + 1e-8) AS white FROM raw CROSS JOIN stat)"""

SQL_LOSSES = f"""{SQL_ADVANTAGES},
ratios AS (SELECT *, conv_id // 16 AS mini_batch, exp(new_logprob - logprob) AS ratio FROM advantages),
losses AS (
  SELECT *, -white * ratio AS pg, -white * greatest(least(ratio, 1.2::DOUBLE), 0.8::DOUBLE) AS pg2,
         (vpred - ret) ** 2 AS vf, (greatest(least(vpred, v + 0.2::DOUBLE), v - 0.2::DOUBLE) - ret) ** 2 AS vf2
  FROM ratios)"""


def rollout_rows(spark: SparkSession, sf: str) -> DataFrame:
    """User turns answered by an assistant turn: queries, responses and the length reward."""
    turns = spread_small(table(spark, sf, "conversations"), "conv_id")
    user = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("q"))
    answer = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("r")
    )
    return (
        user.join(answer, ["conv_id", "turn"])
        .select(
            (F.col("conv_id") * TURNS + F.col("turn")).alias("rollout_id"),
            "conv_id",
            add_bos_eos(byte_tokenize(F.col("q")), bos=True).alias("query_ids"),
            add_bos_eos(byte_tokenize(F.col("r")), bos=False, eos=True).alias("response_ids"),
        )
        .withColumn("score", length_reward(F.size("response_ids")))
    )


@derived
def rollout_cells(spark: SparkSession, sf: str) -> DataFrame:
    """One row per rollout with the arrays a step works on; log-probabilities come from next-token counts."""
    counts = staged(scoring.stream_pair_totals(token_docs(spark, sf), LENGTH, BYTE_VOCAB), "counts")
    counts_train = counts.where(F.col("split") == "train").drop("split")
    counts_all = counts.groupBy("context", "next").agg(F.sum("cnt").alias("cnt"))
    rows = rollout_rows(spark, sf).withColumn("ids", concat_prompt_response(F.col("query_ids"), F.col("response_ids")))
    mask = response_mask(F.col("query_ids"), F.col("response_ids"), F.array_repeat(F.lit(1), F.size("ids")))
    key = ["rollout_id"]

    def models(cells: DataFrame) -> DataFrame:
        cells = scoring.score_pairs(cells, counts_train, BYTE_VOCAB, "logprobs", with_entropy=True)
        cells = scoring.score_unigrams(cells, counts_train, BYTE_VOCAB, "ref_logprobs")
        return scoring.score_pairs(cells, counts_all, BYTE_VOCAB, "new_logprobs")

    names = ["logprobs", "ref_logprobs", "new_logprobs", "entropy"]
    band = F.least(F.floor(F.size("response_ids") / 200), F.lit(9))
    banded = rows.withColumn("band", band)
    means = banded.groupBy("band").agg(F.avg("score").alias("value"))
    # At most ten bands.
    valued = banded.join(F.broadcast(means), "band")
    # Rollouts that share an id have their cells in common, so those cells have to meet; all others stay where they are.
    repeated = staged(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), "repeated")
    alone = valued
    if again := not repeated.isEmpty():
        alone = join_null_safe(valued, repeated, key, "left_anti")
    # The models score each pair of the vocabulary once; rows look their pairs up.
    scored = scoring.score_sequences(alone.where(F.size("ids") > 1), "ids", scoring.PairTable.of(spark, models, BYTE_VOCAB, names), names)
    if again:
        shared = join_null_safe(valued, repeated, key, "left_semi")
        cells = scoring.score_tokens(scoring.token_pairs(shared, key, "ids"), models)
        scored = scored.unionByName(shared.join(rollouts.gather_cells(cells, key, names), key))
    return staged(
        scored.withColumn("mask", mask)
        .withColumn("values", F.transform("mask", lambda m: F.col("value")))
        .withColumn("vpreds", F.transform("mask", lambda m, i: F.col("value") + (i % 7 - 3) / F.lit(10.0)))
        .drop("band", "value"),
        "rollouts",
    )


# --- events ---------------------------------------------------------------------------------------------------------

SQL_LOG = """log AS (
  SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
         CASE WHEN event_type IN ('view', 'click') THEN 'train' ELSE 'val' END AS split,
         value AS loss, ts, event_id FROM events)"""


@derived
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """One run per user, one step per event in time order."""
    placed = ordered_position(
        table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value"),
        group=["user_id"],
        order=["ts", "event_id"],
        name="step",
    )
    split = F.when(F.col("event_type").isin("view", "click"), "train").otherwise("val")
    named = placed.select(
        F.col("user_id").alias("run_id"), "step", split.alias("split"), F.col("value").alias("loss"), "ts", "event_id"
    )
    return staged(named, "run_log")


SQL_KL_LOG = f"""{SQL_LOG},
kl_log AS (
  SELECT run_id, step, step // 8 AS epoch, event_id % 2 AS rank, step % 8 AS minibatch, loss / 5000 AS kl, 256 AS n
  FROM log)"""


def kl_log(spark: SparkSession, sf: str) -> DataFrame:
    return run_log(spark, sf).select(
        "run_id",
        "step",
        F.floor(F.col("step") / 8).alias("epoch"),
        (F.col("event_id") % 2).alias("rank"),
        (F.col("step") % 8).alias("minibatch"),
        (F.col("loss") / 5000).alias("kl"),
        F.lit(256).alias("n"),
    )


# --- embeddings -----------------------------------------------------------------------------------------------------

SQL_LOGITS = """score_vectors AS (
  SELECT vec_id AS row_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 10) AS logits, label
  FROM embeddings)"""


def score_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    logits = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 10)
    return vectors.select(F.col("vec_id").alias("row_id"), logits.alias("logits"), "label")


# Labels decide the tensor: column-split matrices, row-split matrices, one-dimensional tensors, single parts. The names are fixed
# values: the merge rule looks for them.
SQL_WEIGHTS = """weights AS (
  SELECT CASE WHEN label = 9 THEN 'layers.' || vec_id || '.ffn_norm.weight'
              WHEN label % 4 = 0 THEN 'tok_embeddings.weight'
              WHEN label % 4 = 1 THEN 'layers.0.attention.wq.weight'
              WHEN label % 4 = 2 THEN 'layers.0.feed_forward.w2.weight'
              ELSE 'layers.1.attention.wk.weight' END AS name,
         CASE WHEN label = 9 THEN 1 ELSE 2 END AS ndim,
         CASE WHEN label = 9 OR label % 4 = 3 THEN 0 ELSE vec_id % 2 END AS part,
         vec_id // 2 AS row_idx, vec_id, embedding AS vec FROM embeddings)"""


def weights(spark: SparkSession, sf: str) -> DataFrame:
    label = F.col("label")
    name = (
        F.when(label == 9, F.concat(F.lit("layers."), F.col("vec_id").cast("string"), F.lit(".ffn_norm.weight")))
        .when(label % 4 == 0, "tok_embeddings.weight")
        .when(label % 4 == 1, "layers.0.attention.wq.weight")
        .when(label % 4 == 2, "layers.0.feed_forward.w2.weight")
        .otherwise("layers.1.attention.wk.weight")
    )
    return table(spark, sf, "embeddings").select(
        name.alias("name"),
        F.when(label == 9, 1).otherwise(2).alias("ndim"),
        F.when((label == 9) | (label % 4 == 3), F.lit(0).cast("long")).otherwise(F.col("vec_id") % 2).alias("part"),
        F.floor(F.col("vec_id") / 2).alias("row_idx"),
        "vec_id",
        F.col("embedding").alias("vec"),
    )
