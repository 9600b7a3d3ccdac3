"""Incremental tokenization, packing and run-log decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tokenloom.functions.text import add_bos_eos, byte_length, byte_tokenize, strip_text
from tokenloom.operators import packing
from tokenloom.operators.runlog import MAX_KL_STEP, START_LOSS
from tokenloom.operators.vocab import Vocabulary, encode_corpus
from tokenloom.plans.staging import folders_listed
from tokenloom.sources.shards import STORY, write_token_shards
from tokenloom.streaming.carry import STATE_PARTS, run_with_parts
from tokenloom.streaming.keyed import RunningValue, best_update, kl_update, run_keyed


# Fixed value: name of the vocabulary of bytes.
BYTE_VOCAB_NAME = "tok259"

#: Bytes of files in a micro-batch, unless one file has more.
BYTES_PER_BATCH = 512 << 20


def read_shard_stream(spark: SparkSession, path: str, bytes_per_batch: int = BYTES_PER_BATCH) -> DataFrame:
    """Stories of shards as they arrive: one row per object with its file and position.

    A micro-batch is bounded by its bytes: by a number of files, small files would make as many micro-batches as there are shards.
    """
    stories = F.from_json("value", T.ArrayType(STORY), {"mode": "FAILFAST"})
    with folders_listed(spark):
        files = spark.readStream.option("wholetext", True).option("maxBytesPerTrigger", bytes_per_batch).text(path)
    return (
        files.select(F.col("_metadata.file_path").alias("shard"), F.posexplode(stories).alias("doc_pos", "record"))
        .select("shard", F.col("doc_pos").cast("long").alias("doc_pos"), F.col("record.story").alias("text"))
    )


def stream_pretokenize(stories: DataFrame, folder: str, vocabulary: Vocabulary | None = None, name: str = BYTE_VOCAB_NAME) -> StreamingQuery:
    """Tokenize new shards (shard, doc_pos, text) with a trained vocabulary, or with bytes, into ``folder/output``.

    The sink is the table of token shards with one folder per shard, which the last arrival of a shard replaces: neither a
    repeated micro-batch nor a second arrival of a shard adds rows. A shard that stands twice in one micro-batch counts once.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        clean = batch.dropDuplicates(["shard", "doc_pos"]).withColumn("text", strip_text(F.col("text")))
        if vocabulary is None:
            ids = add_bos_eos(byte_tokenize(F.col("text")))
            tokens = clean.select("shard", "doc_pos", ids.alias("ids"), (byte_length(F.col("text")) + 1).alias("n_tokens"))
        else:
            tokens = encode_corpus(clean, vocabulary, keep=("shard", "doc_pos"))
        write_token_shards(tokens, name, f"{folder}/output", key="shard")

    return (
        stories.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


PACK_STATE = "shard_id INT, next_chunk BIGINT, ids ARRAY<INT>"


def stream_pack(tokens: DataFrame, length: int, folder: str, parts: int = STATE_PARTS) -> StreamingQuery:
    """Pack token documents as they arrive; a chunk appears once the tokens of the next one are there too.

    Documents of a shard must arrive in order; inside a micro-batch they are ordered by position. The tokens left over of a shard,
    fewer than 2L, and its next chunk are kept in parts by a hash of the shard: a micro-batch reads and writes the parts of its shards.
    """

    def step(batch: DataFrame, state: DataFrame) -> DataFrame:
        return packing.pack_with_tails(batch, length, state)

    def state(done: DataFrame) -> DataFrame:
        return done.where("tail").select("shard_id", F.col("chunk_id").alias("next_chunk"), F.col("chunk").alias("ids"))

    def output(done: DataFrame) -> DataFrame:
        return done.where("NOT tail").drop("tail")

    return run_with_parts(tokens, "shard_id", step, output, state, PACK_STATE, folder, parts)


def stream_kl_controller(log: DataFrame, start: float, target: float, horizon: int, folder: str) -> StreamingQuery:
    """Penalty coefficient after each step, one number per run in the state store. Steps of a run arrive in order."""
    schema = T.StructType([*log.schema.fields, T.StructField("kl_coef", T.DoubleType())])
    return run_keyed(log, "run_id", RunningValue("step", start, kl_update(target, horizon, MAX_KL_STEP)), schema, folder)


def stream_best_checkpoint(log: DataFrame, folder: str) -> StreamingQuery:
    """Checkpoint decisions at evaluation steps, the best loss of each run in the state store. Steps of a run arrive in order."""
    more = [T.StructField("best_before", T.DoubleType()), T.StructField("improved", T.BooleanType()), T.StructField("saved", T.BooleanType())]
    schema = T.StructType([*log.schema.fields, *more])
    return run_keyed(log, "run_id", RunningValue("step", START_LOSS, best_update), schema, folder)
