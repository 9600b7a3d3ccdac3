"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Inputs that an operator reads as a table (token documents, examples, word counts, rollout arrays, the run log) are
prepared before the clock starts and small ones are held in memory; deriving the rollouts is not timed at all. Each
figure is the median of three runs after one warm-up, that of ``train_bpe`` one run alone; the results go to Spark's
``noop`` sink in full.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tokenloom.catalog import rollout_queries as RQ  # noqa: E402
from tokenloom.catalog import tables as t  # noqa: E402
from tokenloom.catalog import vocab_queries as VQ  # noqa: E402
from tokenloom.functions import scores as P  # noqa: E402
from tokenloom.operators import packing as K  # noqa: E402
from tokenloom.operators import rollouts as O  # noqa: E402
from tokenloom.operators import runlog as L  # noqa: E402
from tokenloom.operators import scoring as Q  # noqa: E402
from tokenloom.operators import vectors as V  # noqa: E402
from tokenloom.operators import vocab as W  # noqa: E402
from tokenloom.operators.corpus import pretokenize_bytes  # noqa: E402
from tokenloom.plans.session import local_session, spread_small  # noqa: E402
from tokenloom.plans.staging import staged  # noqa: E402

RUNS = 3


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")

    tokens = t.token_docs(spark, sf)
    # Work bound by computing starts from one partition per core, as a table of many files would.
    examples = spread_small(staged(K.training_examples(tokens, t.LENGTH)), "shard_id", "chunk_id")
    words = spread_small(staged(VQ.training_words(spark, sf)), "word")
    rollouts = spread_small(t.rollout_cells(spark, sf), "rollout_id")
    log = t.run_log(spark, sf)
    weights = spread_small(t.table(spark, sf, "embeddings"), "vec_id")
    for held in (examples, words, rollouts, weights):
        held.persist().count()
    vectors = spread_small(t.score_vectors(spark, sf), "row_id")
    begin = time.perf_counter()
    vocabulary = W.train_bpe(words, VQ.VOCAB_SIZE)
    trained = time.perf_counter() - begin

    def rollout_step():
        return O.flat_ppo_stats(RQ.step_losses(rollouts), ["mini_batch"])

    def quantize():
        named = weights.select(F.col("label").cast("string").alias("name"), "vec_id", F.col("embedding").alias("vec"))
        return V.quant_error_report(V.quantize_q80(named, ["name", "vec_id"], 16))

    def batches():
        return K.assign_batches(K.shuffle_examples(examples.select("shard_id", "chunk_id"), 2), 128)

    def sampling():
        uniform = P.draw_uniform(11, F.col("row_id"))
        return vectors.select("row_id", P.decode_step(F.col("logits"), uniform, 0.6, 10, 0.9).alias("token"))

    plans = {
        "tokenize_corpus": lambda: pretokenize_bytes(t.corpus(spark, sf)),
        "pack_sequences": lambda: K.training_examples(tokens, t.LENGTH),
        "shuffle_batches": batches,
        "word_counts": lambda: VQ.training_words(spark, sf),
        "pair_counts": lambda: W.pair_counts(W.with_symbols(words)),
        "encode_corpus": lambda: W.encode_corpus(VQ.clean(spark, sf), vocabulary),
        "next_token_counts": lambda: Q.next_token_counts(examples),
        "rollout_step": rollout_step,
        "decode_step": sampling,
        "quantize_vectors": quantize,
        "best_checkpoint": lambda: L.best_checkpoint(log.select("run_id", "step", F.col("loss").alias("val_loss"))),
        "kl_controller": lambda: L.kl_controller(
            log.select("run_id", "step", (F.col("loss") / 5000).alias("kl"), F.lit(256).alias("n")), 0.2, 0.006, 10_000
        ),
    }
    sizes = {
        "tokenize_corpus": tokens.count(),
        "pack_sequences": examples.count(),
        "pair_counts": words.count(),
        "next_token_counts": examples.count() * t.LENGTH,
        "rollout_step": rollouts.count(),
        "quantize_vectors": weights.count(),
    }
    seconds = {"train_bpe": round(trained, 3)}
    for name, plan in plans.items():
        drain(plan())
        times = []
        for _ in range(RUNS):
            begin = time.perf_counter()
            drain(plan())
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": {n: round(rows / seconds[n]) for n, rows in sizes.items()},
                "sf": sf,
                "cores": int(cpus),
                "spark": pyspark.__version__,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
