"""Findings of round 4: what packing, serving and writing token shards move and leave behind, how texts are encoded."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.catalog import streaming_queries
from tokenloom.functions.arrays import packed, unpacked
from tokenloom.operators import packing as K
from tokenloom.operators import vocab
from tokenloom.plans.staging import LISTING_TASKS, SHUFFLES_REMOVED
from tokenloom.sources import shards

TOKENS = "shard_id INT, doc_pos BIGINT, ids ARRAY<INT>, n_tokens INT"
SPACE_BYTES = [3 + b for b in vocab.SPACE.encode()]


def token_table(spark, sizes, top=120, repeat=()):
    """Documents of random tokens; ``sizes`` by shard."""
    rng = random.Random(4)
    rows = [(s, 3 * i, [rng.randrange(top) for _ in range(n)], n) for s, ns in sizes.items() for i, n in enumerate(ns)]
    return spark.createDataFrame([*rows, *[rows[i] for i in repeat]], TOKENS)


def moved(df):
    """Rows of ``df``, and the bytes its plan handed to each shuffle."""
    rows = sorted(map(str, df.collect()))
    found = []

    def walk(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(plan.executedPlan())
        if name.endswith("QueryStage"):
            return walk(plan.plan())
        if name == "Exchange":
            found.append(plan.metrics().apply("dataSize").value())
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return rows, found


def gathered(df, length):
    """All parts gathered by chunk, as text."""
    located = K._located(df, 4).withColumn("_chunks", K._chunks(F.col("_shard_tokens"), length))
    return sorted(map(str, K._gathered(K._cut(located, length, F.col("_chunks") - 1)).drop("_tail").collect()))


def test_arrays_move_in_few_bits(spark):
    rows = [[], [None], [None, 3], [-128, 127], [128], [-32768, 32767], [32768, None], [-(1 << 31), (1 << 31) - 1], None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i INT, a ARRAY<INT>").withColumn("p", packed(F.col("a")))
    got = df.select("i", unpacked(F.col("p")).alias("a"), F.size("p.b8").alias("b8"), F.size("p.b16").alias("b16")).orderBy("i").collect()
    assert [r["a"] for r in got] == rows
    assert [r["b8"] for r in got][2:4] == [2, 2] and [r["b16"] for r in got][4:6] == [1, 2]


def test_chunks_inside_a_document_are_not_shuffled(spark):
    df = token_table(spark, {0: [4000, 5, 3000], 1: [2500], None: [900, 0, 1, 40]})
    rows, sizes = moved(K.training_examples(df, 8))
    assert len(rows) == (7005 // 8 - 1) + (2500 // 8 - 1) + (941 // 8 - 1)
    assert sum(sizes) < 4000  # of 42,000 bytes of tokens
    assert sorted(map(str, K.pack_sequences(df, 8).collect())) == gathered(df, 8)


def test_a_repeated_position_is_packed_as_before(spark):
    """Documents overlap in the shard of a repeated position, and there alone: nothing of it is taken for a whole chunk."""
    df = token_table(spark, {0: [40, 9, 30], 1: [20, 50]}, repeat=(0, 1))
    assert sorted(map(str, K.pack_sequences(df, 8).collect())) == gathered(df, 8)
    assert {r["n"] for r in K.pack_sequences(df, 8).where("shard_id = 1").select(F.size("chunk").alias("n")).collect()} == {9}


@pytest.mark.parametrize("top", [120, 30_000, 65_536])
def test_tokens_of_many_documents_move_once_in_few_bits(spark, monkeypatch, top):
    df = token_table(spark, {0: [400] * 20, 1: [7] * 30}, top)
    want = sorted(map(str, K.training_examples(df, 8).collect()))
    monkeypatch.setattr(K, "BROADCAST_ROWS", 0)
    rows, sizes = moved(K.training_examples(df, 8))
    assert rows == want
    bytes_of = {120: 1, 30_000: 2, 65_536: 4}[top]
    # 50 documents of 8,210 tokens in all, and what rows hold besides
    assert max(sizes) < 8210 * bytes_of + 50 * 120


def test_served_batches_move_in_few_bits(spark):
    df = token_table(spark, {0: [600] * 10})
    examples = K.training_examples(df, 200).select("shard_id", "chunk_id", "x", "y")
    order = K.assign_batches(K.shuffle_examples(K.chunk_keys(df, 200), 2), 4)
    rows, sizes = moved(K.serve_batches(examples, order, {"x": F.array_join(F.col("x").cast("array<string>"), ",")}))
    served = K.serve_batches(examples, order).collect()
    assert rows == sorted(str(r) for r in spark.createDataFrame([(*r[:5], ",".join(map(str, r["x"])), r["y"]) for r in served], "epoch INT, stream_pos LONG, batch_id LONG, shard_id INT, chunk_id LONG, x STRING, y ARRAY<INT>").collect())
    assert sorted(r["stream_pos"] for r in served) == list(range(58))
    assert max(sizes) < 29 * (2 * 200 + 200)  # of 29 examples; as integers 46,400 bytes


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {n for i in range(blocks.size()) if (n := blocks.apply(i).name()).startswith("shuffle_")}


def test_written_shards_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    path = str(tmp_path / "tokens")
    df = token_table(spark, {0: [40, 9], 1: [30]})
    shards.write_token_shards(df, "tok259", path)
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert SHUFFLES_REMOVED not in spark.conf.getAll
    got = shards.read_token_shards(spark, path, "custom", 259).select(*df.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))


def segmented(merges, ids, texts):
    runs = vocab.Runs(vocab.Segmenter(merges, ids))
    return [runs.encode(t) for t in texts]


def test_texts_are_merged_at_once_as_word_by_word():
    """Random merges, also such whose symbol a merge of lower rank takes; digits, line ends, marks and characters without a piece."""
    rng = random.Random(6)
    early = 0
    for _ in range(150):
        chars = rng.sample(["a", "b", "c", vocab.SPACE, "é", "1"], rng.randint(1, 6))
        symbols, merges = list(chars), []
        for _ in range(rng.randint(0, 14)):
            merges.append((rng.choice(symbols), rng.choice(symbols)))
            symbols.append("".join(merges[-1]))
        rng.shuffle(merges)
        ids = {x: 300 + i for i, x in enumerate(dict.fromkeys(symbols)) if rng.random() < 0.8}
        letters = "aaabbbc  " + "é1\n\x01▁😀٣"
        texts = [None, "", " ", *("".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(20))]
        merger = vocab.Merger(merges, ids)
        early += bool(merger.early.any())
        assert merger.encode(texts) == segmented(merges, ids, texts)
    assert early > 20


def test_many_symbols_are_merged_word_by_word():
    merges = [(chr(0x4E00 + i), "x") for i in range(vocab.SYMBOLS_IN_TABLE)]
    ids = {a + b: 300 + i for i, (a, b) in enumerate(merges)}
    texts = ["一x 丁x", None, "x", ""]
    assert list(vocab._encoder(merges, ids)(texts)) == segmented(merges, ids, texts)
    assert list(vocab._encoder(merges[:9], ids)(texts)) == segmented(merges[:9], ids, texts)


def test_a_word_seen_once_costs_no_search_of_its_own(monkeypatch):
    """Few merges never look at words one by one."""
    monkeypatch.setattr(vocab.Segmenter, "symbols", None)
    assert list(vocab._encoder([("a", "b")], {"ab": 300, "a": 301})(["ab a", "b"])) == [np.array(x, np.int32).tobytes() for x in ([*SPACE_BYTES, 300, *SPACE_BYTES, 301], [*SPACE_BYTES, 3 + ord("b")])]


def test_folders_of_shards_are_listed_by_few_tasks(spark, monkeypatch, tmp_path):
    """The figure holds when files are read, and while a stream lists them; afterwards the session has what it had."""
    seen = []
    before = spark.conf.get(LISTING_TASKS)

    class Done:
        def awaitTermination(self):  # noqa: N802
            seen.append(spark.conf.get(LISTING_TASKS))
            out = spark.createDataFrame([("a", 0, [1, 2])], "shard string, doc_pos long, ids array<int>")
            out.write.mode("overwrite").parquet(f"{tmp_path}/stream/output")

    monkeypatch.setattr(streaming_queries.VQ, "trained", lambda spark, sf: None)
    monkeypatch.setattr(streaming_queries, "write_story_files", lambda *a: None)
    monkeypatch.setattr(streaming_queries, "new_folder", lambda spark, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(streaming_queries.jobs, "read_shard_stream", lambda *a: spark.range(1).withColumn("shard", F.lit("file=a/")))
    monkeypatch.setattr(streaming_queries.jobs, "stream_pretokenize", lambda *a: Done())
    assert [tuple(r) for r in streaming_queries.stream_pretokenize(spark, "").collect()] == [("a", 0, "1,2")]
    assert seen == [str(8 * spark.sparkContext.defaultParallelism)] * 3
    assert spark.conf.get(LISTING_TASKS) == before
