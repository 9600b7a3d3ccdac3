import random

import pytest
from pyspark.sql import functions as F

from tokenloom.plans.lookups import lookup
from tokenloom.plans.running import blocks, ordered_position, running


@pytest.fixture(scope="module")
def log():
    """One run holds most rows."""
    rng = random.Random(3)
    return [(run, i, rng.uniform(0.5, 1.5)) for run, n in ((1, 300), (2, 20), (3, 1)) for i in range(n)]


@pytest.mark.parametrize("kind", ["sum", "min", "product", "last"])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_equals_a_loop(spark, log, kind, inclusive):
    df = spark.createDataFrame(log, "run INT, step INT, v DOUBLE")
    out = running(
        df, group=["run"], bucket=[blocks("step", 16)], order=["step"], value=F.col("v"), kind=kind, name="r",
        inclusive=inclusive,
    )
    got = {(r["run"], r["step"]): r["r"] for r in out.collect()}
    start = {"sum": 0.0, "product": 1.0}.get(kind)
    step = {
        "sum": lambda a, v: a + v,
        "product": lambda a, v: a * v,
        "min": lambda a, v: v if a is None else min(a, v),
        "last": lambda a, v: v,
    }[kind]
    state = {}
    for run, i, v in log:
        before = state.get(run, start)
        state[run] = step(before, v)
        want = state[run] if inclusive else before
        assert got[run, i] is None if want is None else got[run, i] == pytest.approx(want)


def test_ordered_position_numbers_every_group(spark, log):
    df = spark.createDataFrame([(r, f"k{s:05d}", v) for r, s, v in log], "run INT, key STRING, v DOUBLE").repartition(5)
    rows = ordered_position(df, group=["run"], order=["key"], name="p").collect()
    assert len(rows) == len(log) and all(r["p"] == int(r["key"][1:]) for r in rows)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_gives_the_same_beyond_the_broadcast_limit(spark, log, how):
    df = spark.createDataFrame(log, "run INT, step INT, v DOUBLE")
    small = spark.createDataFrame([(1, "a"), (3, "b")], "run INT, name STRING")
    near = lookup(df, small, ["run"], how)
    far = lookup(df, small, ["run"], how, max_rows=1)
    assert "BroadcastHashJoin" in near._jdf.queryExecution().toString()
    plan = far._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" not in plan.split("== Physical Plan ==")[1] or "BroadcastExchange" in plan
    assert "explode" not in plan  # no key is copied
    assert sorted(map(tuple, near.collect()), key=str) == sorted(map(tuple, far.select(near.columns).collect()), key=str)
