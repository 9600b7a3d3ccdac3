"""Findings F10, F21, F24 and F27 of round 3: vocabularies of large corpora."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_vocab import brute_force
from tokenloom.operators import vocab as V


def test_a_round_finds_the_words_that_spell_its_pair(spark):
    """Without a new snapshot, a late merge looks at the words that hold all of its symbols, not only those at its border."""
    words = {f"{'the' if i % 10 == 0 else 'te' if i % 10 == 1 else 'he'}{i}": 1 + (i % 10 == 0) * 50 for i in range(300)}
    df = spark.createDataFrame(list(words.items()), "word STRING, cnt BIGINT")
    rounds = []
    size = V.FIRST_FREE_ID + len(set("".join(words))) + 6
    merges = V.train_bpe(df, size, batch_rounds=False, on_round=lambda m, n: rounds.append((m[0], n))).merges.collect()
    assert [m for m, _ in rounds] == [(r["left"], r["right"]) for r in sorted(merges, key=lambda r: r["rank"])] == brute_force(words, 6)
    assert ("t", "he") in dict(rounds)
    assert all(n == sum(a + b in w for w in words) for (a, b), n in rounds)


@pytest.mark.parametrize("spellings", [0, 1, 16])
def test_pieces_that_are_spelled_in_many_ways(spark, monkeypatch, spellings):
    monkeypatch.setattr(V, "SPELLINGS", spellings)
    rng = random.Random(5)
    words = Counter("".join(rng.choice("aaab😀") for _ in range(rng.randrange(1, 14))) for _ in range(200))
    df = spark.createDataFrame([*words.items(), (None, 9)], "word STRING, cnt BIGINT")
    vocabulary = V.train_bpe(df, V.FIRST_FREE_ID + 17, merges_per_stage=7)
    merges = [(r["left"], r["right"]) for r in vocabulary.merges.orderBy("rank").collect()]
    assert merges == brute_force(words, len(merges)) and len(merges) >= 14


@pytest.mark.parametrize("held", [1, 1 << 18])
def test_words_are_counted_where_the_texts_lie(spark, monkeypatch, held):
    monkeypatch.setattr(V, "WORDS_HELD", held)
    rng = random.Random(3)
    texts = [None, "", " ", "  ", "\n", " \n", "\n ", "a ", "a\n", "a \n b", "a\n b", "😀 x😀y", "１２ 3a4", "▁ ▁▁a", "\x01a\x02 b\x01", "a  b\n\nc"]
    texts += ["".join(rng.choice("ab 1\n") for _ in range(rng.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame([(s,) for s in texts], "text STRING")
    for training, split in ((True, V.training_words_of), (False, V.words_of)):
        counts = V.word_counts(df, training)
        assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()
        want = Counter(r["w"] for r in df.select(F.explode(split(F.col("text"))).alias("w")).collect())
        assert {r["word"]: r["cnt"] for r in counts.collect()} == want


def test_texts_are_encoded_by_what_stands_between_spaces(spark, monkeypatch):
    monkeypatch.setattr(V, "IDS_HELD", 40)  # a batch leaves in parts
    rng = random.Random(8)
    texts = [None, "", " ", "  ", "\n", " \n", "\n ", "a ", "ab ab\n ab", "a \n b", "😀 x😀y", "１２ 3a4", "▁ ▁▁a", "\x01a\x02 b\x01"]
    texts += ["".join(rng.choice("aab 1\n") for _ in range(rng.randrange(14))) for _ in range(300)]
    docs = spark.createDataFrame([(0, i, s) for i, s in enumerate(texts)], "shard_id INT, doc_pos LONG, text STRING")
    vocabulary = V.train_bpe(V.word_counts(docs.where("doc_pos > 10")), V.FIRST_FREE_ID + 20)
    merges = [(r["left"], r["right"]) for r in vocabulary.merges.orderBy("rank").collect()]
    segment = V.Segmenter(merges, {r["piece"]: r["id"] for r in vocabulary.vocab.where("kind in ('char', 'merge')").collect()})
    words = {r["doc_pos"]: r["w"] for r in docs.select("doc_pos", V.words_of(F.col("text")).alias("w")).collect()}
    got = {r["doc_pos"]: r["ids"] for r in V.encode_corpus(docs, vocabulary, bos=False).collect()}
    assert got == {i: None if w is None else [x for s in w for x in segment[s]] for i, w in words.items()}
    runs = V.Runs(segment)
    assert runs.encode("ab b ab") == runs.encode("ab b ab") and set(runs) == {"ab", "b"}


def test_the_words_of_the_char_vocabulary_are_written_once(spark, monkeypatch):
    from tokenloom.catalog import vocab_queries as Q

    written, staged = [], V.staged
    monkeypatch.setattr(V, "staged", lambda df, label="stage": written.append(label) or staged(df, label))
    monkeypatch.setattr(Q.t, "_derived", {})
    assert Q.char_vocabulary(spark, "/root/testdata/sf0.001").merges.isEmpty()
    assert written == ["words"]


def test_a_micro_batch_is_read_for_its_sizes_once(spark):
    """the rows of a micro-batch are not pruned, so each pass over them reads the token arrays."""
    from tokenloom.operators.packing import pack_sequences, pack_with_tails

    read = spark.sparkContext.accumulator(0)
    rows = [(s, i, list(range(9)), 9) for s in (0, 1) for i in range(20)]
    schema = "shard_id INT, doc_pos LONG, ids ARRAY<INT>, n_tokens INT"
    batch = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(lambda r: read.add(1) or r), schema)
    none = spark.createDataFrame([], "shard_id INT, next_chunk LONG, ids ARRAY<INT>")
    done = pack_with_tails(batch, 8, none).where("NOT tail").drop("tail").collect()
    assert read.value <= 2 * len(rows)
    assert sorted(map(str, done)) == sorted(map(str, pack_sequences(spark.createDataFrame(rows, schema), 8).collect()))
