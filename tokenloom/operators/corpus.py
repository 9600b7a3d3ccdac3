"""Documents to token documents: splits, tokenization, padding, shard statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import (
    BOS_ID,
    PAD_ID,
    add_bos_eos,
    byte_length,
    byte_tokenize,
    count_token,
    out_of_range,
    strip_text,
)
from tokenloom.plans.lookups import lookup

# Fixed value: shards used for vocabulary training.
VOCAB_SHARDS = 10


def first_shards(df: DataFrame, n: int = VOCAB_SHARDS) -> DataFrame:
    """The first ``n`` shards; on a partitioned table this prunes directories."""
    return df.where(F.col("shard_id") < n)


def split_name(shard_id: Column) -> Column:
    """Shard 0 is the test split, every other shard belongs to ``train``."""
    return F.when(shard_id > 0, F.lit("train")).otherwise(F.lit("test"))


def split_train_test(df: DataFrame) -> DataFrame:
    return df.withColumn("split", split_name(F.col("shard_id")))


def take_split(df: DataFrame, split: str) -> DataFrame:
    """``train`` is every shard but the first; any other name means the first shard. An empty split is an error."""
    wanted = F.col("shard_id") > 0 if split == "train" else F.col("shard_id") == 0
    chosen = df.where(wanted)
    if chosen.isEmpty():
        raise ValueError(f"no shards in split {split!r}")
    return chosen


def check_token_range(df: DataFrame) -> DataFrame:
    """Rows whose ids do not fit 16 bits; must be empty."""
    return df.where(out_of_range(F.col("ids")))


def pretokenize_bytes(docs: DataFrame, bos: bool = True, eos: bool = False) -> DataFrame:
    """(shard_id, doc_pos, text) to (shard_id, doc_pos, ids, n_tokens) with the byte vocabulary.

    The token count comes from the text length: a plan that needs only offsets never builds the id arrays.
    """
    text = strip_text(F.col("text"))
    return docs.select("shard_id", "doc_pos", text.alias("_text")).select(
        "shard_id",
        "doc_pos",
        add_bos_eos(byte_tokenize(F.col("_text")), bos, eos).alias("ids"),
        (byte_length(F.col("_text")) + F.lit(int(bos) + int(eos))).alias("n_tokens"),
    )


def pretokenize(docs: DataFrame, encode: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Strip the texts, then tokenize with ``encode`` (for example a trained vocabulary)."""
    return encode(docs.withColumn("text", strip_text(F.col("text"))))


def shard_stats(df: DataFrame) -> DataFrame:
    """Tokens, documents and average length per shard; BOS is counted by value, none gives a NULL average."""
    return (
        df.groupBy("shard_id")
        .agg(
            F.sum(F.size("ids").cast("long")).alias("tokens"),
            F.count(F.lit(1)).alias("docs"),
            F.sum(count_token(F.col("ids"), BOS_ID).cast("long")).alias("bos_tokens"),
        )
        .withColumn("avg_seq_len", F.try_divide("tokens", "bos_tokens"))
    )


def pad_batch(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Right-pad ids and mask with zeros to the longest sequence of the batch.

    The longest length is a partial aggregate joined back, not a window: a batch that holds a large share of the rows
    is never gathered in one task.
    """
    longest = df.groupBy(batch).agg(F.max(F.size("input_ids")).alias("_longest"))
    missing = F.col("_longest") - F.size("input_ids")
    mask_missing = F.col("_longest") - F.size("attention_mask")
    return (
        lookup(df, longest, [batch], null_safe=True)
        .withColumns(
            {
                "input_ids": F.concat("input_ids", F.array_repeat(F.lit(PAD_ID), missing)),
                "attention_mask": F.concat("attention_mask", F.array_repeat(F.lit(0), mask_missing)),
            }
        )
        .drop("_longest")
    )
