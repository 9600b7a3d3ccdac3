"""Findings of round 3 on larger tables: what moves, what a task holds, how often a step runs."""

import math
import random

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tokenloom.catalog.streaming_queries import WAVES, waves
from tokenloom.operators import packing as K
from tokenloom.operators import scoring as Q
from tokenloom.plans.staging import staged
from tokenloom.streaming.keyed import KEY, RunningValue, best_update

TOKENS = "shard_id INT, doc_pos BIGINT, ids ARRAY<INT>, n_tokens INT"


def token_table(spark, sizes, repeat=()):
    """Documents of random tokens; ``sizes`` by shard."""
    rng = random.Random(3)
    rows = [(s, 2 * i, None if n is None else [rng.randrange(9) for _ in range(n)], n) for s, ns in sizes.items() for i, n in enumerate(ns)]
    return spark.createDataFrame([*rows, *[rows[i] for i in repeat]], TOKENS)


def counted(df):
    return sorted((r["split"], r["context"], r["next"], r["cnt"]) for r in df.collect())


def test_pairs_are_counted_where_documents_lie(spark, monkeypatch):
    """The same counts as those of the packed examples, cut inside documents and between them; no array is shuffled."""
    monkeypatch.setattr(Q, "TOKENS_HELD", 20)
    for tail in (0, 1, 7):
        sizes = {0: [40, 1, 0, None, 3, 9, tail], 1: [1] * 17 + [tail], None: [16, tail], 2: [tail, 30, 8], 3: [16], 4: [9, 8]}
        df = token_table(spark, sizes)
        got = Q.stream_pair_totals(df, 8, 9)
        assert counted(got) == counted(Q.pair_totals(K.training_examples(df, 8), ["split"]))
    assert "collect_list" not in got._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_repeated_positions_are_those_of_the_examples(spark):
    df = token_table(spark, {0: [40, 9, 30], 1: [20, 20]}, repeat=(1, 4))
    assert counted(Q.stream_pair_totals(df, 8, 9)) == counted(Q.pair_totals(K.training_examples(df, 8), ["split"]))


def test_pairs_of_a_short_shard_are_an_error(spark):
    with pytest.raises(ValueError, match="too small"):
        Q.stream_pair_totals(token_table(spark, {0: [40], 1: [15]}), 8, 9).collect()


@pytest.mark.parametrize("top", [1, 2, 7, 299])
def test_a_wave_is_a_range_that_the_scan_knows(spark, top):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    df = staged(spark.range(top).withColumnRenamed("id", "step"))
    parts = waves(df, "step")
    assert [[r[0] for r in p.orderBy("step").collect()] for p in parts] == [[k for k in range(top) if math.floor(k * WAVES / top) == i] for i in range(WAVES)]
    plans = [p._jdf.queryExecution().executedPlan().toString() for p in parts]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThan(step" in plans[0], plans[0]


class Store:
    """A value of the state store that counts its calls."""

    def __init__(self):
        self.value, self.calls = None, []

    def get(self):
        self.calls.append("get")
        return self.value

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def update(self, value):
        self.calls.append("update")
        self.value = value


def test_a_key_calls_the_state_store_once_and_once_to_change_it():
    running = RunningValue("step", 1e9, best_update)
    running.held = Store()
    frame = pd.DataFrame({"step": [2, 0, 1], "val_loss": [3.0, 5.0, 4.0], KEY: "=1"})
    (out,) = running.handleInputRows(("=1",), iter([frame[:1], frame[1:]]), None)
    assert out["step"].tolist() == [0, 1, 2] and out["best_before"].tolist() == [1e9, 5.0, 4.0]
    assert running.held.calls == ["get", "update"] and running.held.value == (3.0,)
    (out,) = running.handleInputRows(("=1",), iter([pd.DataFrame({"step": [3, 4], "val_loss": [9.0, 3.5], KEY: "=1"})]), None)
    assert out["best_before"].tolist() == [3.0, 3.0] and not out["saved"].any()
    assert running.held.calls == ["get", "update", "get"]


def test_a_row_group_of_arrays_is_a_small_part_of_a_task(spark):
    """A reader decodes a whole group of every column, a writer holds one: long rows must not add up to much."""
    df = staged(spark.range(1000, numPartitions=1).select(F.array_repeat(F.col("id"), 500).alias("a")))
    (path,) = (f.removeprefix("file:") for f in df.inputFiles())
    meta = pq.ParquetFile(path).metadata
    assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 128
    assert df.count() == 1000
