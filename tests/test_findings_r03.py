"""Findings of round 3: what a step moves, holds and reads."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import packing
from tokenloom.operators import scoring as Q
from tokenloom.operators.recurrence import BLOCK, discounted_suffix_sums
from tokenloom.plans.running import running
from tokenloom.plans.staging import staged


def test_recurrence_stays_in_the_jvm(spark):
    """The backward loop itself, to the last bit, whatever the number of blocks; only the columns asked for are read."""
    rows = [(n, [((i * 7919 + n) % 101 - 50) / 7 for i in range(n)]) for n in (0, 1, 2, BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK, 500)]
    df = spark.createDataFrame([*rows, (-1, None)], "k INT, v ARRAY<DOUBLE>")
    out = discounted_suffix_sums(df, F.col("v"), 0.95, "o")
    assert "InArrow" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["k"]: r["o"] for r in out.collect()}
    assert got.pop(-1) is None
    for n, v in rows:
        want, later = [0.0] * n, 0.0
        for t in range(n - 1, -1, -1):
            later = want[t] = v[t] + 0.95 * later
        assert got[n] == want


def test_arrays_are_staged_in_small_row_groups(spark):
    df = spark.range(3000, numPartitions=1).select("id", F.array_repeat("id", 3).alias("a"))
    path = staged(df).inputFiles()[0].removeprefix("file:")
    meta = pq.ParquetFile(glob.glob(path)[0]).metadata
    assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 512


def test_pair_table_equals_the_scored_cells(spark):
    counts = spark.createDataFrame([(0, 1, 3), (1, 2, 4), (1, 3, 1), (4, 0, 2)], "context INT, next INT, cnt LONG")
    df = spark.createDataFrame([(1, [0, 1, 2, 4, 0]), (2, [1]), (3, None), (4, [3, 3])], "k INT, ids ARRAY<INT>")

    def scorer(cells):
        return Q.score_unigrams(Q.score_pairs(cells, counts, 5, "a", with_entropy=True), counts, 5, "b")

    names = ["a", "b", "entropy"]
    done = Q.score_sequences(df, "ids", Q.PairTable.of(spark, scorer, 5, names), names)
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
    got = {r["k"]: r for r in done.collect()}
    cells = Q.score_tokens(Q.token_pairs(df, ["k"], "ids"), scorer).collect()
    assert len(cells) == 5 and got[3]["a"] is None and got[2]["a"] == []
    assert all(got[c["k"]][n][c["pos"]] == c[n] for c in cells for n in names)
    with pytest.raises(ValueError, match="pairs"):
        Q.PairTable.of(spark, scorer, 65_536, names)


def test_running_moves_the_rows_once(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"), F.lit("x").alias("_key"))
    out = running(df, group=["g"], bucket=[F.floor(F.col("o") / 20)], order=["o"], value=F.lit(1), kind="sum", name="n")
    got = {(r["g"], r["o"]): r["n"] for r in out.collect()}
    assert all(n == o // 3 for (g, o), n in got.items()) and len(got) == 200


def test_chunks_are_numbered_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNKS_PER_BLOCK", 4)
    keys = packing.chunk_keys(spark.createDataFrame([(0, 8 * 40), (1, 8), (None, 8 * 9)], "shard_id INT, n_tokens INT"), 8)
    assert sorted(map(str, keys.collect())) == sorted(f"Row(shard_id={s}, chunk_id={c})" for s, n in ((0, 39), (None, 8)) for c in range(n))
    assert len({r[0] for r in keys.select(F.spark_partition_id()).collect()}) > 1
