import math

import pytest
from pyspark.sql import functions as F

from tokenloom.functions import scores as P

VECTORS = [[1.0, 3.0, 3.0, 2.0], [0.0, 0.0, 0.0, 0.0], [-5.0, 800.0, 2.0, 1.0]]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(VECTORS)], "i INT, v ARRAY<DOUBLE>").cache()


def column(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def softmax(v, t=1.0):
    top = max(v)
    w = [math.exp((x - top) / t) for x in v]
    return [x / sum(w) for x in w]


def test_softmax_family(df):
    for got, lp, ent, v in zip(
        column(df, P.softmax(F.col("v"), 0.5)), column(df, P.log_softmax(F.col("v"))),
        column(df, P.entropy(F.col("v"))), VECTORS,
    ):
        assert got == pytest.approx(softmax(v, 0.5)) and sum(got) == pytest.approx(1)
        assert [math.exp(x) for x in lp] == pytest.approx(softmax(v))
        assert ent == pytest.approx(-sum(p * math.log(p) for p in softmax(v) if p), abs=1e-9)


def test_top_k_keeps_ties_and_caps_k(df):
    kept = column(df, P.top_k_filter(F.col("v"), 1))
    assert [x > float("-inf") for x in kept[0]] == [False, True, True, False]
    assert all(x > float("-inf") for x in kept[1])
    assert column(df, P.top_k_filter(F.col("v"), 99)) == VECTORS
    with pytest.raises(ValueError):
        P.top_k_filter(F.col("v"), 0)


def test_nucleus_limits(df):
    only_best = column(df, P.nucleus(P.softmax(F.col("v")), 0.0))
    assert [[e["token"] for e in row] for row in only_best] == [[1], [0], [1]]
    everything = column(df, P.nucleus(P.softmax(F.col("v")), 1.0))
    assert sum(e["p"] for e in everything[0]) == pytest.approx(1) and len(everything[0]) == 4


def test_draws_follow_the_running_mass(df):
    for u, token in ((0.0, 0), (0.24, 0), (0.26, 1), (0.74, 2), (0.99, 3)):
        assert column(df, P.sample_categorical(P.softmax(F.col("v")), F.lit(u)))[1] == token
    assert column(df, P.decode_step(F.col("v"), F.lit(0.5), 0)) == [1, 0, 1]
    assert column(df, P.decode_step(F.col("v"), F.lit(0.99), 0.7, top_k=3, top_p=0.0)) == [1, 0, 1]
    with pytest.raises(ValueError):
        P.softmax(F.col("v"), 0.0)


def test_loss_ignores_the_sentinel(df):
    losses = column(df, P.token_loss(F.col("v"), F.when(F.col("i") == 0, -1).otherwise(1)))
    assert losses[0] is None and losses[1] == pytest.approx(math.log(4))


def test_truncation_searches_behind_the_prompt(spark):
    rows = [([2, 7, 5, 2, 9], 2), ([2, 7, 5], 2), ([2, 7], 2)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i INT, v ARRAY<INT>, n INT")
    assert column(df, P.truncate_at_end(F.col("v"), F.col("n"), 2)) == [[5, 2], [5], []]
    assert column(df, P.truncate_at_end(F.col("v"), F.col("n"), 2, echo=True)) == [[2, 7, 5, 2], [2, 7, 5], [2, 7]]
