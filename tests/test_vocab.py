import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import vocab as V

TEXTS = ["the cat sat\non the mat", "a  thin thing 1234 then", "aaaa aaab aab abab ababab", "", "naïve ▁ café\x01x\x02"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(0, i, s) for i, s in enumerate(TEXTS)], "shard_id INT, doc_pos BIGINT, text STRING")


def brute_force(words: dict[str, int], merges: int):
    """One pair per round on plain lists."""
    state = {w: list(w) for w in words}
    done = []
    for _ in range(merges):
        pairs = Counter()
        for w, s in state.items():
            for p in zip(s, s[1:]):
                pairs[p] += words[w]
        if not pairs:
            break
        left, right = min(pairs, key=lambda p: (-pairs[p], len(p[0] + p[1]), p[0] + p[1], p[0]))
        done.append((left, right))
        for w, s in state.items():
            out, i = [], 0
            while i < len(s):
                if s[i : i + 2] == [left, right]:
                    out.append(left + right)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            state[w] = out
    return done


def test_words_spell_the_text(spark, docs):
    rows = docs.select("text", V.words_of(F.col("text")).alias("w")).collect()
    for r in rows:
        joined = "".join(r["w"])
        assert joined == ("▁" + r["text"].replace(" ", "▁") if r["text"] else "")
        assert all(len(w) == 1 for w in r["w"] if any(c.isdigit() or c == "\n" for c in w))


def test_quick_and_matching_split_agree(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab 1２\n▁é") for _ in range(rng.randrange(30))) for _ in range(200)]
    df = spark.createDataFrame([(s,) for s in texts], "text STRING")
    marked = F.concat(F.lit("▁"), F.replace("text", F.lit(" "), F.lit("▁")))
    slow = F.regexp_extract_all(marked, F.lit(V.WORD), F.lit(0))
    assert df.where(F.length("text") > 0).where(V.words_of(F.col("text")) != slow).count() == 0


@pytest.mark.parametrize("batch_rounds", [True, False])
def test_training_equals_one_pair_per_round(spark, batch_rounds):
    rng = random.Random(9)
    words = Counter("▁" + "".join(rng.choice("aaabbcd") for _ in range(rng.randrange(1, 7))) for _ in range(300))
    df = spark.createDataFrame(list(words.items()), "word STRING, cnt BIGINT")
    size = V.FIRST_FREE_ID + len(set("".join(words))) + 12
    vocabulary = V.train_bpe(df, size, candidates=24, batch_rounds=batch_rounds)
    merges = [(r["left"], r["right"]) for r in vocabulary.merges.orderBy("rank").collect()]
    assert merges == brute_force(words, len(merges))
    assert vocabulary.vocab.count() == size


@pytest.mark.parametrize("listed,stage,batch_rounds", [(6, 96, True), (10_000, 3, False)])
def test_training_from_differences(spark, listed, stage, batch_rounds):
    """Any list and any distance of snapshots give the merges of one-at-a-time training, pieces spelled twice included."""
    rng = random.Random(listed + stage)
    words = Counter("".join(rng.choice("aaab") for _ in range(rng.randrange(1, 12))) for _ in range(250))
    df = spark.createDataFrame(list(words.items()), "word STRING, cnt BIGINT")
    rounds = []
    vocabulary = V.train_bpe(df, V.FIRST_FREE_ID + 14, listed=listed, merges_per_stage=stage, batch_rounds=batch_rounds, on_round=lambda m, n: rounds.append((m, n)))
    merges = [(r["left"], r["right"]) for r in vocabulary.merges.orderBy("rank").collect()]
    assert merges == brute_force(words, len(merges)) == [m for batch, _ in rounds for m in batch]
    assert vocabulary.vocab.count() == V.FIRST_FREE_ID + 14


def test_a_merge_reads_the_words_that_hold_it(spark):
    words = {f"▁{'th' * (i % 3 == 0)}{'qu' * (i % 50 == 0)}x{i}": 1000 - i for i in range(600)}
    df = spark.createDataFrame(list(words.items()), "word STRING, cnt BIGINT")
    size = V.FIRST_FREE_ID + len(set("".join(words))) + 12
    rounds = []
    merges = V.train_bpe(df, size, merges_per_stage=1, batch_rounds=False, on_round=lambda m, n: rounds.append((m[0], n))).merges.collect()
    assert [(r["left"], r["right"]) for r in sorted(merges, key=lambda r: r["rank"])] == brute_force(words, len(merges))
    # with a snapshot before each merge the index holds exactly the words that the merge changes
    state = {w: list(w) for w in words}
    for (left, right), looked in rounds:
        holders = [w for w, s in state.items() if (left, right) in zip(s, s[1:])]
        assert looked == len(holders)
        for w in holders:
            text = V.OPEN + (V.CLOSE + V.OPEN).join(state[w]) + V.CLOSE
            text = text.replace(V.OPEN + left + V.CLOSE + V.OPEN + right + V.CLOSE, V.OPEN + left + right + V.CLOSE)
            state[w] = text[1:-1].split(V.CLOSE + V.OPEN)
    assert rounds[-1][1] < 0.3 * len(words) and sum(n for _, n in rounds) < 0.5 * len(rounds) * len(words)


def test_round_trip_and_unknown_characters(spark, docs):
    words = V.word_counts(docs.where("doc_pos < 3"))
    vocabulary = V.train_bpe(words, V.FIRST_FREE_ID + 40)
    encoded = V.encode_corpus(docs, vocabulary, bos=True, eos=True)
    decoded = {r["doc_pos"]: r["text"] for r in V.decode_corpus(encoded, vocabulary.vocab).collect()}
    assert decoded == {i: s.replace("▁", " ") for i, s in enumerate(TEXTS)}
    assert "Exchange" not in encoded._jdf.queryExecution().executedPlan().toString()
    ids = {r["doc_pos"]: r["ids"] for r in encoded.collect()}
    assert ids[3] == [1, 2]
    assert 0xC3 + 3 in ids[4] and 0xA9 + 3 in ids[4]


def test_merge_is_left_to_right_without_overlap(spark):
    df = V.with_symbols(spark.createDataFrame([("aaaaa", 1), ("a.b$", 1)], "word STRING, cnt BIGINT"))
    out = V.bpe_step(V.bpe_step(df, "a", "a"), "b", "$").select(V.symbol_list(F.col("symbols")).alias("s")).collect()
    assert [r["s"] for r in out] == [["aa", "aa", "a"], ["a", ".", "b$"]]


def test_vocabulary_must_hold_the_characters(spark, docs):
    words = V.word_counts(docs)
    with pytest.raises(ValueError, match="do not fit"):
        V.train_bpe(words, V.FIRST_FREE_ID + 3)
    with pytest.raises(ValueError, match="positive"):
        V.train_bpe(words, 0)


def test_coverage_keeps_rare_characters_out_of_merges(spark):
    df = spark.createDataFrame([("▁ab", 50), ("▁az", 50), ("▁aqb", 1)], "word STRING, cnt BIGINT")
    vocabulary = V.train_bpe(df, V.FIRST_FREE_ID + 6, coverage=0.99)
    assert not any("q" in r["piece"] for r in vocabulary.vocab.where("kind in ('char','merge')").collect())


def test_heap_equals_replaying_the_merges():
    rng = random.Random(4)
    letters = "abc"
    for _ in range(300):
        pieces, merges = list(letters), []
        for _ in range(rng.randrange(1, 9)):
            pair = rng.choice(pieces), rng.choice(pieces)
            if pair not in merges:
                merges.append(pair)
                pieces.append("".join(pair))
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 20)))
        symbols = list(word)
        while found := [(merges.index(p), i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in merges]:
            i = min(found)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        assert V.Segmenter(merges, {}).symbols(word) == symbols
