"""Streaming forms; each must give what the batch form gives."""

from pyspark.sql import functions as F

from tokenloom.catalog import tables as t
from tokenloom.catalog import vocab_queries as VQ
from tokenloom.catalog.corpus_queries import SQL_FILES, file_name, write_story_files
from tokenloom.catalog.registry import query, r6, text
from tokenloom.catalog.runlog_queries import eval_log
from tokenloom.plans.staging import folders_listed, new_folder, shuffles_removed
from tokenloom.streaming import jobs

WAVES = 3


def waves(df, order):
    """The table in three waves by the whole number ``order``; each is a range of it, so a scan passes over the row groups of the others."""
    top = df.agg(F.max(order)).first()[0] + 1
    bounds = [-(-i * top // WAVES) for i in range(WAVES + 1)]
    return [df.where((F.col(order) >= first) & (F.col(order) < end)) for first, end in zip(bounds, bounds[1:])]


def in_waves(df, order, start):
    """Let the table arrive in three waves by ``order`` and run the query over each, resuming from its checkpoint."""
    spark = df.sparkSession
    path, folder = new_folder(spark, "arrivals"), new_folder(spark, "stream")
    for wave in waves(df, order):
        wave.write.mode("append").parquet(path)
        start(spark.readStream.schema(df.schema).parquet(path), folder).awaitTermination()
    return spark.read.parquet(f"{folder}/output")


@query(
    "stream_pretokenize",
    f"""WITH {VQ.SQL_ENCODED}, {SQL_FILES},
    numbered AS (SELECT file, row_number() OVER (PARTITION BY file ORDER BY doc_id) - 1 AS doc_pos, doc_id FROM files)
    SELECT file AS shard, n.doc_pos, array_to_string(ids, ',') AS ids FROM numbered n JOIN encoded e ON e.doc_pos = n.doc_id""",
)
def stream_pretokenize(spark, sf):
    """Shards arrive in three waves and are tokenized with the trained vocabulary; those of the first come again with the last."""
    path, folder = new_folder(spark, "arrivals"), new_folder(spark, "stream")
    with folders_listed(spark), shuffles_removed(spark):
        vocabulary = VQ.trained(spark, sf)
        for waves in ((0,), (1,), (2, 0)):
            for wave in waves:
                write_story_files(spark, sf, wave, path)
            stories = jobs.read_shard_stream(spark, f"{path}/*").withColumn("shard", file_name())
            jobs.stream_pretokenize(stories, folder, vocabulary, f"tok{VQ.VOCAB_SIZE}").awaitTermination()
        done = spark.read.parquet(f"{folder}/output")
    return done.select("shard", "doc_pos", text("ids").alias("ids"))


@query(
    "stream_pack",
    f"WITH {t.SQL_CHUNKS} SELECT shard_id, chunk_id, array_to_string(chunk, ',') AS chunk FROM chunks",
)
def stream_pack(spark, sf):
    done = in_waves(t.token_docs(spark, sf), "doc_pos", lambda s, folder: jobs.stream_pack(s, t.LENGTH, folder))
    return done.select("shard_id", "chunk_id", text("chunk").alias("chunk"))


@query(
    "stream_kl_controller",
    f"""WITH {t.SQL_KL_LOG}, mult AS (
      SELECT run_id, step, 1 + greatest(least(kl / 0.006::DOUBLE - 1, 0.2::DOUBLE), -0.2::DOUBLE) * n / 10000.0::DOUBLE AS m
      FROM kl_log)
    SELECT run_id, step, round(0.2::DOUBLE * product(m) OVER (PARTITION BY run_id ORDER BY step), 6) AS kl_coef FROM mult""",
)
def stream_kl_controller(spark, sf):
    log = t.kl_log(spark, sf).select("run_id", "step", "kl", "n")
    done = in_waves(log, "step", lambda s, folder: jobs.stream_kl_controller(s, 0.2, 0.006, 10_000, folder))
    return done.select("run_id", "step", r6("kl_coef").alias("kl_coef"))


@query(
    "stream_best_checkpoint",
    f"""WITH {t.SQL_LOG}, evals AS (SELECT run_id, step, loss AS val_loss FROM log WHERE step % 2 = 0),
    seen AS (SELECT *, least(coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY step
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1e9::DOUBLE), 1e9::DOUBLE) AS best_before FROM evals)
    SELECT run_id, step, val_loss, best_before, val_loss < best_before AND step > 0 AS saved FROM seen""",
)
def stream_best_checkpoint(spark, sf):
    done = in_waves(eval_log(spark, sf), "step", jobs.stream_best_checkpoint)
    return done.select("run_id", "step", "val_loss", "best_before", "saved")
