import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import corpus as C
from tokenloom.operators import packing as K

SCHEMA = "shard_id INT, doc_pos BIGINT, ids ARRAY<INT>"


@pytest.fixture(scope="module")
def docs():
    """Shard 0 holds most documents; some are empty, some span many chunks."""
    rng = random.Random(5)
    rows = []
    for shard, count in ((0, 120), (1, 9), (2, 3)):
        for i in range(count):
            size = rng.choice([0, 1, 2, 7, 40])
            rows.append((shard, i * 3, [rng.randrange(3, 99) for _ in range(size)]))
    return rows


def streams(docs):
    out = {}
    for shard, _, ids in sorted(docs, key=lambda r: r[:2]):
        out.setdefault(shard, []).extend(ids)
    return out


@pytest.mark.parametrize("width", [4, 1 << 16])
def test_pack_equals_slices_of_the_stream(spark, docs, width):
    L = 8
    df = K.pack_sequences(
        K.token_offsets(spark.createDataFrame(docs, SCHEMA), width).drop("start"), L, width
    )
    got = {(r["shard_id"], r["chunk_id"]): r["chunk"] for r in df.collect()}
    want = {}
    for shard, toks in streams(docs).items():
        for i in range(max(len(toks) // L - 1, 0)):
            want[shard, i] = toks[i * L : i * L + L + 1]
    assert got == want


@pytest.mark.parametrize("tokens,chunks", [(15, 0), (16, 1), (17, 1), (24, 2), (1, 0)])
def test_chunk_count_rule(spark, tokens, chunks):
    df = spark.createDataFrame([(0, 0, list(range(3, 3 + tokens)))], SCHEMA)
    assert K.chunk_counts(df, 8).first()["chunks"] == chunks
    if chunks == 0:
        with pytest.raises(ValueError, match="too small"):
            K.require_chunks(df, 8)
    else:
        K.require_chunks(df, 8)


def test_shuffle_is_a_permutation_and_batches_run_on(spark):
    keys = spark.createDataFrame([(s, c) for s, n in ((0, 50), (1, 7)) for c in range(n)], "shard_id INT, chunk_id BIGINT")
    shuffled = K.shuffle_examples(keys, epochs=2)
    for digits in (1, 3):
        rows = K.assign_batches(shuffled, 10, digits).collect()
        assert sorted(r["stream_pos"] for r in rows) == list(range(114))
        assert all(r["batch_id"] == r["stream_pos"] // 10 for r in rows)
        order = sorted(rows, key=lambda r: (r["epoch"], r["shard_key"], r["chunk_key"]))
        assert [r["stream_pos"] for r in order] == list(range(114))
    first, second = ([(r["shard_id"], r["chunk_id"]) for r in order if r["epoch"] == e] for e in (0, 1))
    assert sorted(first) == sorted(second) and first != second


def test_pad_batch_masks_count_tokens(spark):
    rows = [(1, [5, 6, 7]), (1, [8]), (2, [9, 9])]
    df = spark.createDataFrame(rows, "batch_id INT, input_ids ARRAY<INT>")
    df = df.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
    got = {tuple(r["input_ids"]): r["attention_mask"] for r in C.pad_batch(df).collect()}
    assert got == {(5, 6, 7): [1, 1, 1], (8, 0, 0): [1, 0, 0], (9, 9): [1, 1]}


def test_take_split_fails_when_empty(spark):
    df = spark.createDataFrame([(0, 0, [1])], SCHEMA)
    assert C.take_split(df, "val").count() == 1
    with pytest.raises(ValueError, match="no shards"):
        C.take_split(df, "train")


def test_shard_without_bos_has_no_average(spark):
    df = spark.createDataFrame([(0, 0, [5, 6]), (1, 0, [1, 5, 1])], SCHEMA)
    got = {r["shard_id"]: r["avg_seq_len"] for r in C.shard_stats(df).collect()}
    assert got == {0: None, 1: 1.5}
