import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tokenloom.functions import rollout as R
from tokenloom.functions.vectors import dequantize_groups, fitting_group_size, quantize_groups
from tokenloom.operators import masked as M
from tokenloom.operators import packing as K
from tokenloom.operators import rollouts as O
from tokenloom.operators import runlog as L
from tokenloom.operators import scoring as Q
from tokenloom.operators import vectors as V


def test_gae_equals_the_backward_loop(spark):
    rng = random.Random(2)
    rows = [(n, [rng.gauss(0, 1) for _ in range(n)], [rng.gauss(0, 1) for _ in range(n)]) for n in (0, 1, 2, 700, 3)]
    df = spark.createDataFrame(rows, "n INT, rewards ARRAY<DOUBLE>, values ARRAY<DOUBLE>")
    config = O.RolloutConfig(gamma=0.9, lam=0.8)
    for r in O.gae(df, "rewards", "values", config).collect():
        want, last = [], 0.0
        for t in reversed(range(r["n"])):
            following = r["values"][t + 1] if t + 1 < r["n"] else 0.0
            last = r["rewards"][t] + 0.9 * following - r["values"][t] + 0.72 * last
            want.append(last)
        assert r["advantages"] == pytest.approx(want[::-1])


def test_whitened_advantages_have_mean_0_and_variance_1(spark):
    rng = random.Random(4)
    rows = []
    for i, n in enumerate((3, 40, 12)):
        mask = [0] + [1] * (n - 1)
        rows.append((i, *[[rng.gauss(0, 1) for _ in range(n)] for _ in range(3)], mask, -0.5))
    df = spark.createDataFrame(
        rows, "rollout_id INT, logprobs ARRAY<DOUBLE>, ref_logprobs ARRAY<DOUBLE>, values ARRAY<DOUBLE>, mask ARRAY<INT>, score DOUBLE"
    )
    done = O.compute_advantages(O.compute_rewards(df))
    cells = O.explode_cells(done, ["rollout_id"], ["advantages", "mask"]).where("mask = 1")
    mean, var = cells.agg(F.avg("advantages"), F.var_samp("advantages")).first()
    assert mean == pytest.approx(0, abs=1e-9) and var == pytest.approx(1, abs=1e-6)


def test_reward_needs_a_response_cell(spark):
    df = spark.createDataFrame([([0.1], [0.1], [0], 1.0)], "logprobs ARRAY<DOUBLE>, ref_logprobs ARRAY<DOUBLE>, mask ARRAY<INT>, score DOUBLE")
    with pytest.raises(PySparkException, match="no response cell"):
        O.compute_rewards(df).collect()
    with pytest.raises(ValueError, match="penalty mode"):
        R.kl_penalty(F.col("a"), F.col("b"), "other")


def test_masked_variance_edges(spark):
    df = spark.createDataFrame([(1, 2.0, 1), (2, 3.0, 0)], "g INT, value DOUBLE, mask INT")
    assert M.masked_var(df.where("g = 1"), ["g"]).first()["masked_var"] is None
    with pytest.raises(PySparkException, match="mask is empty"):
        M.masked_var(df.where("g = 2"), ["g"]).collect()


def test_alignment_fails_on_missing_rollouts(spark):
    q = spark.createDataFrame([(1, "a"), (2, "b")], "rollout_id INT, q STRING")
    r = spark.createDataFrame([(1, "a"), (2, "b")], "rollout_id INT, r STRING")
    s = spark.createDataFrame([(1, 0.5)], "rollout_id INT, score DOUBLE")
    with pytest.raises(PySparkException, match="not matched"):
        O.align_rollouts(q, r, s).collect()
    for twice in ([(1, 0.5), (2, 0.1), (2, 0.1)], [(1, 0.5), (None, 0.1)], [(1, 0.5), (2, 0.1), (3, 0.2)]):
        with pytest.raises(PySparkException, match="not matched"):
            O.align_rollouts(q, r, spark.createDataFrame(twice, "rollout_id INT, score DOUBLE")).collect()
    both = spark.createDataFrame([(1, 0.5), (2, 0.1)], "rollout_id INT, score DOUBLE")
    aligned = O.align_rollouts(q, r, both, 2)
    assert sorted(map(tuple, aligned.collect())) == [(1, "a", "a", 0.5), (2, "b", "b", 0.1)]
    # rows without a value count too, and each row is shuffled once
    empty = spark.createDataFrame([(1, None), (2, None)], "rollout_id INT, score DOUBLE")
    assert sorted(map(tuple, O.align_rollouts(q, r, empty).collect())) == [(1, "a", "a", None), (2, "b", "b", None)]
    assert O.align_rollouts(q, r, both)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    with pytest.raises(PySparkException, match="expected 3"):
        O.align_rollouts(q, r, both, 3).collect()


def test_flatten_rejects_the_separator(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("a/b")).alias("s"))
    with pytest.raises(ValueError, match="separator"):
        M.flatten_stats(df)


def test_scorers_plug_in(spark):
    df = spark.createDataFrame([(1, [1, 2, 3])], "rollout_id INT, ids ARRAY<INT>")

    @F.pandas_udf("double")
    def opaque(s):
        return s.map(len) * 2.0

    assert O.score_rollouts(df, opaque, "ids").first()["score"] == 6.0
    pairs = Q.token_pairs(df, ["rollout_id"], "ids")
    model = lambda p: p.withColumn("lp", -F.abs(F.col("next") - F.col("context")).cast("double"))
    assert [r["lp"] for r in Q.score_tokens(pairs, model).collect()] == [-1.0, -1.0]
    with pytest.raises(ValueError, match="dropped"):
        Q.score_tokens(pairs, lambda p: p.drop("pos"))


def test_quantization_error_stays_below_half_a_step(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.1) for _ in range(16)]) for i in range(20)] + [(99, [0.0] * 16)]
    df = spark.createDataFrame(rows, "i INT, vec ARRAY<DOUBLE>").withColumn("g", quantize_groups(F.col("vec"), 8))
    for r in df.withColumn("back", dequantize_groups(F.col("g"))).collect():
        for g in r["g"]:
            assert g["max_error"] <= g["scale"] / 2 + 1e-6 and all(-127 <= c <= 127 for c in g["codes"])
        assert r["back"] == pytest.approx(r["vec"], abs=max(g["scale"] for g in r["g"]) / 2 + 1e-6)
    assert fitting_group_size(48, 64) == 16
    with pytest.raises(PySparkException, match="not a multiple"):
        df.select(quantize_groups(F.col("vec"), 5)).collect()


def test_schedule_edges(spark):
    steps = spark.createDataFrame([(s,) for s in (0, 5, 10, 60, 61)], "step INT")
    cfg = L.Schedule(learning_rate=1.0, min_lr=0.1, warmup=10, max_steps=60)
    got = [r[0] for r in steps.orderBy("step").select(L.lr_schedule(F.col("step"), cfg)).collect()]
    assert got == pytest.approx([0.0, 0.5, 1.0, 0.1, 0.1])
    same = L.Schedule(learning_rate=1.0, min_lr=0.1, warmup=10, max_steps=10)
    assert steps.where("step = 10").select(L.lr_schedule(F.col("step"), same)).first()[0] == 1.0
    off = steps.select(L.lr_schedule(F.col("step"), L.Schedule(learning_rate=1.0, decay=False))).collect()
    assert {r[0] for r in off} == {1.0}


def test_unknown_token_has_no_vector(spark):
    tokens = spark.createDataFrame([(1, [0, 5])], "k INT, ids ARRAY<INT>")
    vectors = spark.createDataFrame([(0, [1.0])], "id INT, embedding ARRAY<FLOAT>")
    with pytest.raises(PySparkException, match="no vector"):
        V.embedding_lookup(tokens, vectors, ["k"]).collect()


def test_skipped_batch_has_no_loss(spark):
    names = "mask INT, logprobs DOUBLE, new_logprobs DOUBLE, values DOUBLE, vpreds DOUBLE, advantages DOUBLE, returns DOUBLE, entropy DOUBLE"
    rows = [(1, 0.0, math.log(2.0), 0.0, 1.0, 1.0, 0.5, 0.1), (1, 0.0, math.log(1.5), 0.0, 1.0, -1.0, 0.5, 0.1)]
    cells = O._with_losses(spark.createDataFrame(rows, names).withColumn("b", F.lit(1)), O.RolloutConfig())
    row = O.ppo_total_loss(cells, ["b"]).first()
    assert row["skipped"] and row["avg_ratio"] == pytest.approx(1.75)
    assert row["policy_loss"] == row["value_loss"] == row["total_loss"] == 0.0
    kept = O.ppo_total_loss(cells, ["b"], O.RolloutConfig(ratio_threshold=2.0)).first()
    assert kept["total_loss"] == pytest.approx(kept["policy_loss"] + 0.1 * kept["value_loss"])


def test_full_divergence_inside_the_rewards(spark):
    """Vectors over the vocabulary drive the penalty, the scalar columns stay for the losses."""
    import math

    p, q = [[math.log(0.7), math.log(0.3)], [math.log(0.5), math.log(0.5)]], [[math.log(0.5), math.log(0.5)], [math.log(0.25), math.log(0.75)]]
    df = spark.createDataFrame(
        [(1, p, q, [-0.3, -0.7], [-0.6, -0.9], [1, 1], 2.0)],
        "rollout_id INT, vectors ARRAY<ARRAY<DOUBLE>>, ref_vectors ARRAY<ARRAY<DOUBLE>>, logprobs ARRAY<DOUBLE>, ref_logprobs ARRAY<DOUBLE>, mask ARRAY<INT>, score DOUBLE",
    )
    config = O.RolloutConfig(kl_mode="full")
    row = O.compute_rewards(df, config, "vectors", "ref_vectors").first()
    want = [-config.kl_coef * sum(math.exp(a) * (a - b) for a, b in zip(x, y)) for x, y in zip(p, q)]
    assert row["non_score_rewards"] == pytest.approx(want)
    assert row["rewards"] == pytest.approx([want[0], want[1] + 2.0])
    assert row["logprobs"] == [-0.3, -0.7]


def step_rows(n=37):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        size = rng.randrange(1, 9)
        cell = lambda: [rng.uniform(-1, 1) for _ in range(size)]
        rows.append((i, [1] + [rng.randrange(2) for _ in range(size - 1)], *[cell() for _ in range(7)]))
    return rows


STEP = "rollout_id LONG, mask ARRAY<INT>, logprobs ARRAY<DOUBLE>, new_logprobs ARRAY<DOUBLE>, `values` ARRAY<DOUBLE>, vpreds ARRAY<DOUBLE>, advantages ARRAY<DOUBLE>, returns ARRAY<DOUBLE>, entropy ARRAY<DOUBLE>"


def test_step_equals_statistics_of_its_mini_batches(spark):
    """Sums per rollout give what the cells of each mini-batch give; the cells are read once."""
    df = spark.createDataFrame(step_rows(), STEP)
    step = O.ppo_step(df, epochs=3, mini_batch=4, grad_accum=2)
    assert "arrays_zip" not in step._jdf.queryExecution().toString()  # no cells in the plan: their sums were written
    got = M.flatten_stats(step)
    placed = K.minibatch_permutation(df, "rollout_id", 3, 4, 2)
    by = ["epoch", "backward_batch", "mini_batch"]
    want = O.flat_ppo_stats(O.loss_cells(placed.join(df, "rollout_id"), [*by, "rollout_id"]), by)
    key = lambda r: tuple(r[c] for c in by)
    one, two = ({key(r): r.asDict() for r in x.collect()} for x in (got, want))
    assert len(one) == 3 * 10 and one.keys() == two.keys()
    for k, r in one.items():
        assert {c for c in r if r[c] is None} == {c for c in r if two[k][c] is None}
        assert [v for v in r.values() if v is not None] == pytest.approx([v for v in two[k].values() if v is not None], rel=1e-9, abs=1e-9)


def test_whitening_is_observed_during_the_write(spark):
    df = spark.createDataFrame(step_rows(), STEP).select("rollout_id", "mask", "returns")
    white = O.whiten_arrays(df, "returns")
    plan = white._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Subquery" not in plan
    cells = [(v, w, m) for (_, mask, *_, returns, _), r in zip(step_rows(), sorted(white.collect())) for v, w, m in zip(returns, r["returns"], mask)]
    inside = [v for v, _, m in cells if m]
    mean = sum(inside) / len(inside)
    var = sum((v - mean) ** 2 for v in inside) / (len(inside) - 1)
    assert all(w == pytest.approx((v - mean) / (var + 1e-8) ** 0.5) for v, w, _ in cells)
    kept = M.masked_whiten(O.explode_cells(df, ["rollout_id"], ["mask", "returns"]), "returns", shift_mean=False)
    assert kept._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert sorted(r["whitened"] for r in kept.collect()) == pytest.approx(sorted(w + mean for _, w, _ in cells))
    none = spark.createDataFrame([(1.0, 0)], "value DOUBLE, mask INT")
    with pytest.raises(PySparkException, match="mask is empty"):
        M.masked_whiten(none).collect()
    assert M.masked_whiten(spark.createDataFrame([(1.0, 1)], "value DOUBLE, mask INT")).first()["whitened"] is None
    assert M.masked_whiten(none.where("value > 5")).collect() == []


def test_sequences_are_scored_in_batches_of_tokens(spark):
    rows = [(i, [(i * 7 + j) % 5 for j in range(i % 9)]) for i in range(40)] + [(99, None), (98, list(range(5)) * 30)]
    df = spark.createDataFrame(rows, "rollout_id LONG, ids ARRAY<INT>")
    counts = spark.createDataFrame([(0, 1, 3), (1, 2, 4), (1, 3, 1), (4, 0, 2)], "context INT, next INT, cnt LONG")
    model = Q.PairModel.of(counts, 5)
    done = {r["rollout_id"]: r for r in Q.score_sequences(df, "ids", model, ["logprobs", "entropy"], tokens=16).collect()}
    long = Q.score_pairs(Q.token_pairs(df, ["rollout_id"], "ids"), counts, 5, "logprob", with_entropy=True).collect()
    assert sum(len(r["logprobs"] or []) for r in done.values()) == len(long)
    for r in long:
        assert done[r["rollout_id"]]["logprobs"][r["pos"]] == pytest.approx(r["logprob"])
        assert done[r["rollout_id"]]["entropy"][r["pos"]] == pytest.approx(r["entropy"])
    assert done[99]["logprobs"] is None and done[0]["logprobs"] == []
    seen = []
    list(Q._in_token_batches([3, 40, 2, 2, 2], 6, seen.append))
    assert seen == [(0, 1), (1, 2), (2, 5)]
