"""Rows that must not be lost or doubled: null keys, second writes, aborted stages, short shards, runs of spaces."""

import os

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import packing, runlog, vocab
from tokenloom.plans.running import blocks, ordered_position, running
from tokenloom.sources import shards


def test_null_group_keeps_its_rows(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (1, 1, 1.0), (None, 0, 5.0), (None, 1, 7.0)], "run INT, step INT, v DOUBLE")
    got = running(df, group=["run"], bucket=[blocks("step", 1)], order=["step"], value=F.col("v"), kind="sum", name="s", inclusive=True)
    assert {(r.run, r.step): r.s for r in got.collect()} == {(1, 0): 2.0, (1, 1): 3.0, (None, 0): 5.0, (None, 1): 12.0}
    assert ordered_position(df, group=["run"], order=["step"], name="p").count() == 4


def test_null_run_has_a_best_checkpoint(spark):
    log = spark.createDataFrame([(1, 0, 2.0), (None, 0, 3.0)], "run_id LONG, step INT, val_loss DOUBLE")
    assert runlog.best_checkpoint(log).count() == 2


def test_null_shards_and_batches_stay(spark):
    from tokenloom.operators import corpus

    named = spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "shard string, doc_pos long")
    assert {(r.doc_pos, r.shard_id) for r in shards.with_shard_ids(named).collect()} == {(2, 0), (3, 1), (1, 2)}
    docs = spark.createDataFrame([(s, i, list(range(9))) for s in (1, None) for i in range(3)], "shard_id INT, doc_pos LONG, ids ARRAY<INT>")
    got = packing.pack_sequences(docs, 8).groupBy("shard_id").count().collect()
    assert {(r.shard_id, r["count"]) for r in got} == {(1, 2), (None, 2)}
    padded = corpus.pad_batch(spark.createDataFrame([(None, [1], [1]), (1, [1, 2], [1, 1])], "batch_id INT, input_ids ARRAY<INT>, attention_mask ARRAY<INT>"))
    assert padded.count() == 2
    keys = spark.createDataFrame([(None, 0), (None, 1), (1, 0)], "shard_id INT, chunk_id LONG")
    assert sorted(r.stream_pos for r in packing.assign_batches(packing.shuffle_examples(keys, 2), 2).collect()) == list(range(6))


def test_stored_layout_packs_like_any_table(spark, tmp_path):
    rows = [(s, i * 3, [j % 50 + 3 for j in range((7 * i + 5 * s) % 40)]) for s in range(3) for i in range(30)]
    docs = spark.createDataFrame(rows, "shard_id INT, doc_pos LONG, ids ARRAY<INT>")
    shards.write_token_shards(docs, "tok259", str(tmp_path), docs_per_block=16)
    stored = shards.read_token_shards(spark, str(tmp_path), "custom", 259)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(packing.token_offsets(stored).select("shard_id", "doc_pos", "start")) == key(packing.token_offsets(docs).select("shard_id", "doc_pos", "start"))
    packed = packing.pack_sequences(stored, 8)
    assert key(packed) == key(packing.pack_sequences(docs, 8))
    plan = packing.pack_sequences(stored, 8)._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "chunk_id" in x]
    assert len(moved) == 1 and "Exchange hashpartitioning(shard_id" in plan  # ids go through the exchange by chunk only
    with pytest.raises(Exception, match="missing"):
        packing.pack_sequences(stored.where("doc_pos <> 9"), 8).count()
    assert packing.pack_sequences(stored.where("doc_pos <> 9").drop("block", "block_start"), 8).count() > 0


def test_second_write_replaces(spark, tmp_path):
    docs = spark.createDataFrame([(0, 0, [1, 5]), (1, 0, [1, 6])], "shard_id INT, doc_pos LONG, ids ARRAY<INT>")
    path = str(tmp_path / "tokens")
    for part in (docs, docs, docs.where("shard_id = 1")):
        shards.write_token_shards(part, "tok259", path)
    got = shards.read_token_shards(spark, path, "custom", 259)
    assert sorted((r.shard_id, r.ids) for r in got.collect()) == [(0, [1, 5]), (1, [1, 6])]


def test_aborted_stage_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "stage")
    df = spark.range(10).coalesce(1)
    assert shards.materialize_once(df, path).count() == 10
    os.remove(f"{path}/_SUCCESS")
    assert shards.materialize_once(df.where("id < 4"), path).count() == 4
    assert shards.materialize_once(df, path).count() == 4


def test_short_shard_fails_the_examples(spark):
    docs = spark.createDataFrame([(0, 0, list(range(40)), 40), (1, 0, [1, 2], 2)], "shard_id INT, doc_pos LONG, ids ARRAY<INT>, n_tokens INT")
    with pytest.raises(Exception, match="too small"):
        packing.training_examples(docs, 8).count()
    assert packing.training_examples(docs.where("shard_id = 0"), 8).count() == 4


def test_pieces_of_spaces_are_learned(spark):
    docs = spark.createDataFrame([("a    b",), ("c    d",), ("e    f",)], "text STRING")
    trained = vocab.train_bpe(vocab.word_counts(docs), vocab.FIRST_FREE_ID + 8)
    pieces = {r.piece for r in trained.vocab.where("kind = 'merge'").collect()}
    assert vocab.SPACE * 2 in pieces
    texts = spark.createDataFrame([(0, 0, "a    b  c 1  2")], "shard_id INT, doc_pos LONG, text STRING")
    encoded = vocab.encode_corpus(texts, trained)
    assert vocab.decode_corpus(encoded, trained.vocab).first().text == "a    b  c 1  2"
