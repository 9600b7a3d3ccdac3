"""Story shards, text samples and token tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.arrays import packed, unpacked
from tokenloom.functions.text import out_of_range
from tokenloom.plans.lookups import lookup
from tokenloom.plans.running import blocks
from tokenloom.plans.staging import MOVED_BY_TASKS, group_options, shuffles_removed
from tokenloom.sources.json_arrays import list_files, read_objects

# Fixed layout of a story object; the key of the nested prompt really ends in a colon.
STORY = T.StructType(
    [
        T.StructField("story", T.StringType()),
        T.StructField(
            "instruction",
            T.StructType(
                [
                    T.StructField("prompt:", T.StringType()),
                    T.StructField("words", T.ArrayType(T.StringType())),
                    T.StructField("features", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("summary", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

# Fixed value: number of records a preview shows.
PREVIEW_ROWS = 30

#: Documents of a block of a token shard.
DOCS_PER_BLOCK = 1 << 14
TOKEN_DOCS = "vocab STRING, shard_id INT, doc_pos BIGINT, ids ARRAY<INT>, n_tokens INT, block BIGINT, block_start BIGINT"


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Read JSON-array shards: one row per object with its file and position in the file.

    Large files are split by byte ranges; no value holds a file. Malformed files fail the job.
    """
    record = F.from_json("text", STORY, {"mode": "FAILFAST"}).alias("record")
    return read_objects(spark, path).select("shard", "doc_pos", record).select("shard", "doc_pos", "record.*")


def list_shards(spark: SparkSession, path: str, name: Column | None = None) -> DataFrame:
    """The manifest of the files below a path, from the listing alone: no content is read, a shard without stories has its id.

    ``name`` may derive the shard's name from its file, ``shard``.
    """
    files = list_files(spark, path).select((F.col("shard") if name is None else name).alias("shard"))
    return shard_manifest(files)


def shard_manifest(df: DataFrame, name: str = "shard") -> DataFrame:
    """Shards in name order with their ids and the number of shards.

    The unpartitioned window runs over one row per shard, never over documents.
    """
    names = df.select(name).distinct()
    return names.select(
        F.col(name),
        (F.row_number().over(Window.orderBy(name)) - 1).alias("shard_id"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("num_shards"),
    )


def with_shard_ids(df: DataFrame, name: str = "shard") -> DataFrame:
    """Replace the shard name by its id."""
    ids = shard_manifest(df, name).select(name, "shard_id")
    return lookup(df, ids, [name], null_safe=True).drop(name)


def preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first records of shard 0."""
    return df.where(F.col("shard_id") == 0).orderBy("doc_pos").limit(rows)


def write_text_sample(df: DataFrame, num_shards: int, path: str) -> DataFrame:
    """Write the documents of the first shards as text; lines and size in MB of what was written."""
    df.where(F.col("shard_id") < num_shards).select("text").write.mode("overwrite").text(path)
    written = df.sparkSession.read.option("lineSep", "\n").text(path)
    total = F.sum(F.octet_length("value") + F.lit(1).cast("long"))
    return written.agg(F.count(F.lit(1)).alias("lines"), (total / F.lit(1024 * 1024)).alias("size_mb"))


def write_token_shards(df: DataFrame, vocab: str, path: str, docs_per_block: int = DOCS_PER_BLOCK, key: str = "shard_id") -> None:
    """Write one row per document, partitioned by vocabulary and shard, with its block and its position in the block's tokens.

    Rows are gathered per (shard, block of documents), so a large shard is written by many tasks and a small one by
    one. Shards that are written again are replaced, others stay. Ids that do not fit 16 bits fail the job. ``key`` may
    name another column that tells shards apart, for example a file name. Ids move in the fewest bits that hold those of a document.
    """
    checked = F.when(out_of_range(F.col("ids")), F.raise_error(F.lit("a token id does not fit 16 bits")))
    n_tokens = F.col("n_tokens") if "n_tokens" in df.columns else F.size("ids")
    # the window asks for the partitioning and order that the write needs anyway
    inside = Window.partitionBy(key, "block").orderBy("doc_pos").rowsBetween(Window.unboundedPreceding, -1)
    gathered = (
        df.select(
            F.lit(vocab).alias("vocab"),
            F.col(key).cast("int" if key == "shard_id" else "string").alias(key),
            "doc_pos",
            packed(checked.otherwise(F.col("ids").cast("array<int>"))).alias("ids"),
            n_tokens.cast("int").alias("n_tokens"),
            blocks("doc_pos", docs_per_block).alias("block"),
        )
        .repartition(key, "block")
        .withColumn("block_start", F.coalesce(F.sum(F.col("n_tokens").cast("long")).over(inside), F.lit(0)).cast("long"))
        .withColumn("ids", unpacked(F.col("ids")))
    )
    with shuffles_removed(df.sparkSession):
        (
            gathered.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", docs_per_block)
            .options(**group_options(df.select("ids").schema))
            .options(**MOVED_BY_TASKS)
            .option("compression", "zstd")
            .partitionBy("vocab", key)
            .parquet(path)
        )


def read_token_shards(spark: SparkSession, path: str, vocab_source: str, vocab_size: int = 0) -> DataFrame:
    """Token documents of one vocabulary; the filter prunes to its directory.

    ``block`` and ``block_start`` spare packing a pass over the documents; drop them before documents are filtered.
    """
    return (
        spark.read.schema(TOKEN_DOCS)
        .parquet(path)
        .where(F.col("vocab") == vocab_name(vocab_source, vocab_size))
    )


def vocab_name(vocab_source: str, vocab_size: int = 0) -> str:
    """``llama2`` names the shared vocabulary, ``custom`` one trained to a given size."""
    if vocab_source == "llama2":
        return "llama2"
    if vocab_source == "custom":
        if vocab_size <= 0:
            raise ValueError("a custom vocabulary needs a positive size")
        return f"tok{vocab_size}"
    raise ValueError(f"unknown vocabulary source {vocab_source!r}")


def materialize_once(df: DataFrame, path: str) -> DataFrame:
    """Compute a stage unless its complete output exists already, then read the output.

    Only the mark of a committed write counts: what an aborted one has left is written anew.
    """
    spark = df.sparkSession
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
