"""Streams in several micro-batches: equal to the batch operators, replayed after a failure, state of touched keys only."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import packing, runlog, vocab
from tokenloom.streaming import carry, jobs

LOG = "run_id long, step int, val_loss double, kl double, n int"


def rows_of(wave, runs):
    return [(r, 10 * wave + i, float((7 * (r or 3) + 13 * i + 5 * wave) % 11), ((r or 2) + i) % 5 / 500, 256) for r in runs for i in range(10)]


@pytest.fixture(scope="module")
def waves():
    """Run 1 is in every wave, run 2 in the first and last, a run without an id in the second."""
    return [rows_of(0, [1, 2, 4]), rows_of(1, [1, None]), rows_of(2, [2, 1])]


STARTS = {
    "best": (lambda log, folder: jobs.stream_best_checkpoint(log.select("run_id", "step", "val_loss"), folder), lambda df: runlog.best_checkpoint(df.select("run_id", "step", "val_loss"))),
    "kl": (lambda log, folder: jobs.stream_kl_controller(log.select("run_id", "step", "kl", "n"), 0.2, 0.006, 10_000, folder), lambda df: runlog.kl_controller(df.select("run_id", "step", "kl", "n"), 0.2, 0.006, 10_000)),
}


def plain(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("kind", sorted(STARTS))
def test_keyed_state(spark, tmp_path, waves, kind):
    start, batch = STARTS[kind]
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    for i, rows in enumerate(waves):
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(source)
        log = spark.readStream.schema(LOG).parquet(source)
        if i == 2:  # the micro-batch fails after some of its runs were updated, and is replayed
            lost = F.when((F.col("run_id") == 2) & (F.col("step") == 25), F.raise_error(F.lit("executor lost")).cast("boolean")).otherwise(True)
            with pytest.raises(Exception, match="executor lost"):
                start(log.where(lost), folder).awaitTermination()
        query = start(log, folder)
        query.awaitTermination()
        state = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]][-1]
        # every touched run is written at most, others are not
        assert state["numRowsUpdated"] <= len({r[0] for r in rows}) and state["numRowsTotal"] == len({r[0] for w in waves[: i + 1] for r in w})
    everything = spark.createDataFrame([r for w in waves for r in w], LOG)
    want = batch(everything)
    got = spark.read.parquet(f"{folder}/output")
    assert plain(got.select(want.columns)) == plain(want)


TOKENS = "shard_id int, doc_pos long, ids array<int>, n_tokens int"


def test_pack_keeps_parts(spark, tmp_path):
    """Chunks of the whole stream; only parts of touched shards are written; a repeated micro-batch changes nothing."""
    rng = random.Random(2)
    sizes = [0, 1, 3, 9, 25, 60]
    doc = lambda shard, pos: (shard, pos, ids := [rng.randrange(3, 99) for _ in range(rng.choice(sizes))], len(ids))
    waves = [[doc(s, i) for s in (0, 1, 2, 9) for i in range(6)], [doc(s, 6 + i) for s in (0, None) for i in range(8)], [doc(s, 20 + i) for s in (0, 2, None) for i in range(7)], [(5, 0, [], 0)]]
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    start = lambda: jobs.stream_pack(spark.readStream.schema(TOKENS).parquet(source), 8, folder, parts=16)
    for i, rows in enumerate(waves):
        spark.createDataFrame(rows, TOKENS).coalesce(1).write.mode("append").parquet(source)
        start().awaitTermination()
        touched = {int(n.split("=")[1]) for n in os.listdir(f"{folder}/state/batch={i}") if n.startswith("part=")}
        store = carry.PartedState(spark, f"{folder}/state", "shard_id", jobs.PACK_STATE, 16)
        parts = spark.createDataFrame(rows, TOKENS).select(store.part_of()).distinct().collect()
        assert touched == {r[0] for r in parts}
        assert all(len(v) <= 2 for v in store.versions(i + 1).values())

    def result():
        return sorted((tuple(map(str, r)) for r in spark.read.parquet(f"{folder}/output").select("shard_id", "chunk_id", "chunk").collect()))

    everything = [r for w in waves for r in w]
    want = sorted(tuple(map(str, r)) for r in packing.pack_sequences(spark.createDataFrame(everything, TOKENS), 8).collect())
    assert result() == want and len(want) > 30
    # the mark of the last micro-batches is lost: they are replayed on the state before them
    last = max(int(n) for n in os.listdir(f"{folder}/checkpoint/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{folder}/checkpoint/commits/{name}"):
            os.remove(f"{folder}/checkpoint/commits/{name}")
    start().awaitTermination()
    assert result() == want


def test_pretokenize_in_waves(spark, tmp_path):
    """A trained vocabulary; a shard that comes again, in a later wave or in the same one, adds nothing."""
    texts = {"a": ["the cat", "  sat on the mat\n"], "b": ["", "then 12 cats"], "c": ["naïve"]}
    trained = vocab.train_bpe(vocab.word_counts(spark.createDataFrame([(t,) for v in texts.values() for t in v], "text string")), vocab.FIRST_FREE_ID + 30)
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "shard string, doc_pos long, text string"
    for wave in (["a"], ["b", "a"], ["c", "c"], ["b"]):
        rows = [(s, i, t) for s in wave for i, t in enumerate(texts[s])]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        jobs.stream_pretokenize(spark.readStream.schema(schema).parquet(source), folder, trained, "tok289").awaitTermination()
    docs = spark.createDataFrame([(s, i, t.strip()) for s, v in texts.items() for i, t in enumerate(v)], schema)
    want = vocab.encode_corpus(docs, trained, keep=("shard", "doc_pos")).select("shard", "doc_pos", "ids", "n_tokens").collect()
    got = spark.read.parquet(f"{folder}/output")
    assert sorted(map(str, got.where("vocab = 'tok289'").select("shard", "doc_pos", "ids", "n_tokens").collect())) == sorted(map(str, want))
