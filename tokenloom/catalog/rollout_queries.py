"""Rollout steps: masks, rewards, advantages, losses, statistics."""

from pyspark.sql import functions as F

from tokenloom.catalog import tables as t
from tokenloom.catalog.registry import query, r6, text
from tokenloom.functions import rollout as R
from tokenloom.functions import scores as P
from tokenloom.operators import masked as M
from tokenloom.operators import rollouts as O
from tokenloom.operators import scoring as Q

KEY = ["rollout_id"]


def rewarded(spark, sf):
    return O.compute_rewards(t.rollout_cells(spark, sf))


REWARD_COLUMNS = "rollout_id mask values score logprobs ref_logprobs".split()
STEP_COLUMNS = "conv_id logprobs new_logprobs vpreds entropy".split()


def advantaged(rollouts, config=O.RolloutConfig(), keep=()):
    """Advantages of the rewards; only the columns in ``keep`` are written beside them, not the token ids or the scores."""
    columns = [*REWARD_COLUMNS, *[c for c in keep if c not in REWARD_COLUMNS]]
    rows = O.compute_rewards(rollouts.select(*columns)).select("rollout_id", "mask", "values", "rewards", *keep)
    return O.compute_advantages(rows, config)


def step_losses(rollouts):
    """Cells with their losses."""
    rows = advantaged(rollouts, keep=STEP_COLUMNS)
    return O.loss_cells(rows.withColumn("mini_batch", F.floor(F.col("conv_id") / 16)), ["mini_batch", *KEY])


def losses(spark, sf):
    return step_losses(t.rollout_cells(spark, sf))


def value_cells(spark, sf):
    """Cells of the log ratio to the reference: real numbers with a real mask."""
    cells = O.explode_cells(t.rollout_cells(spark, sf), KEY, ["logprobs", "ref_logprobs", "mask"])
    return cells.select(*KEY, "pos", (F.col("logprobs") - F.col("ref_logprobs")).alias("value"), "mask")


SQL_VALUES = f"{t.SQL_CELLS}, vals AS (SELECT rollout_id, pos, logprob - ref_logprob AS value, mask FROM cells)"


@query(
    "align_rollouts",
    f"""WITH {t.SQL_ROLLOUTS} SELECT rollout_id, array_to_string(query_ids, ',') AS query_ids,
      array_to_string(response_ids, ',') AS response_ids, round(score, 6) AS score FROM rollouts""",
)
def align_rollouts(spark, sf):
    rows = t.rollout_rows(spark, sf)
    parts = [rows.select("rollout_id", c) for c in ("query_ids", "response_ids", "score")]
    return O.align_rollouts(*parts).select(
        "rollout_id", text("query_ids").alias("query_ids"), text("response_ids").alias("response_ids"),
        r6("score").alias("score"),
    )


@query(
    "concat_prompt_response",
    f"WITH {t.SQL_ROLLOUTS} SELECT rollout_id, array_to_string(list_concat(query_ids, response_ids), ',') AS ids FROM rollouts",
)
def concat_prompt_response(spark, sf):
    ids = R.concat_prompt_response(F.col("query_ids"), F.col("response_ids"))
    return t.rollout_rows(spark, sf).select("rollout_id", text(ids).alias("ids"))


@query(
    "response_mask",
    f"""WITH {t.SQL_ROLLOUTS}, cells AS (
      SELECT rollout_id, len(query_ids) AS qn, response_ids,
             unnest(range(len(query_ids) + len(response_ids) - 1)) AS pos FROM rollouts)
    SELECT rollout_id, pos, CASE WHEN pos >= qn - 1 THEN 1 ELSE 0 END AS mask,
      CASE WHEN pos >= qn - 1 AND response_ids[pos - qn + 2] <> 35 THEN 1 ELSE 0 END AS extra_mask,
      CASE WHEN pos >= 3 AND pos - 3 >= qn - 1 THEN 1 ELSE 0 END AS padded_mask FROM cells""",
)
def response_mask(spark, sf):
    """Plain; with a per-response mask that drops spaces; with the first three tokens of the row as left padding."""
    rows = t.rollout_rows(spark, sf)
    q, r = F.col("query_ids"), F.col("response_ids")
    size = F.size(q) + F.size(r)
    plain = R.response_mask(q, r, F.array_repeat(F.lit(1), size))
    no_space = F.transform(r, lambda i: F.when(i == 35, 0).otherwise(1))
    extra = R.response_mask(q, r, F.array_repeat(F.lit(1), size), no_space)
    padded = R.response_mask(q, r, F.concat(F.array_repeat(F.lit(0), 3), F.array_repeat(F.lit(1), size - 3)))
    masks = rows.select("rollout_id", plain.alias("mask"), extra.alias("extra_mask"), padded.alias("padded_mask"))
    cells = O.explode_cells(masks, KEY, ["mask", "extra_mask", "padded_mask"])
    return cells.withColumn("pos", F.col("pos").cast("long"))


@query(
    "score_tokens",
    f"""WITH {t.SQL_CELLS} SELECT rollout_id, CAST(pos AS INTEGER) AS pos, mask, round(logprob, 6) AS logprob,
      round(ref_logprob, 6) AS ref_logprob, round(new_logprob, 6) AS new_logprob, round(entropy, 6) AS entropy
      FROM cells""",
)
def score_tokens(spark, sf):
    values = ["mask", "logprobs", "ref_logprobs", "new_logprobs", "entropy"]
    cells = O.explode_cells(t.rollout_cells(spark, sf), KEY, values)
    return cells.select(
        "rollout_id",
        "pos",
        "mask",
        r6("logprobs").alias("logprob"),
        r6("ref_logprobs").alias("ref_logprob"),
        r6("new_logprobs").alias("new_logprob"),
        r6("entropy").alias("entropy"),
    )


@query(
    "align_policies",
    f"WITH {t.SQL_CELLS} SELECT rollout_id, CAST(pos AS INTEGER) AS pos, round(logprob - ref_logprob, 6) AS ratio FROM cells",
)
def align_policies(spark, sf):
    cells = t.rollout_cells(spark, sf)
    policy = O.explode_cells(cells, KEY, ["logprobs"])
    reference = O.explode_cells(cells, KEY, ["ref_logprobs"])
    both = O.align_policies(policy, reference)
    return both.select("rollout_id", "pos", r6(F.col("logprobs") - F.col("ref_logprobs")).alias("ratio"))


@query(
    "score_sequences",
    f"""WITH {t.SQL_CELLS} SELECT rollout_id, CAST(pos AS INTEGER) AS pos, round(logprob, 6) AS logprob,
      round(entropy, 6) AS entropy FROM cells""",
)
def score_sequences(spark, sf):
    """The policy of ``score_tokens`` as a model that is called with whole sequences."""
    counts = Q.pair_totals(t.examples(spark, sf).where("split = 'train'"))
    model = Q.PairModel.of(counts, t.BYTE_VOCAB)
    rows = t.rollout_rows(spark, sf).select("rollout_id", R.concat_prompt_response(F.col("query_ids"), F.col("response_ids")).alias("ids"))
    scored = Q.score_sequences(rows, "ids", model, ["logprobs", "entropy"])
    cells = O.explode_cells(scored, KEY, ["logprobs", "entropy"])
    return cells.select("rollout_id", "pos", r6("logprobs").alias("logprob"), r6("entropy").alias("entropy"))


@query("masked_mean", f"WITH {SQL_VALUES} SELECT round(sum(value * mask) / sum(mask), 6) AS masked_mean FROM vals")
def masked_mean(spark, sf):
    return M.masked_mean(value_cells(spark, sf)).withColumn("masked_mean", r6("masked_mean"))


@query(
    "masked_mean_by_rollout",
    f"WITH {SQL_VALUES} SELECT rollout_id, round(sum(value * mask) / sum(mask), 6) AS masked_mean FROM vals GROUP BY rollout_id",
)
def masked_mean_by_rollout(spark, sf):
    return M.masked_mean(value_cells(spark, sf), KEY).withColumn("masked_mean", r6("masked_mean"))


@query(
    "masked_var",
    f"""WITH {SQL_VALUES} SELECT rollout_id, round(var_samp(value) FILTER (WHERE mask = 1), 6) AS unbiased,
      round(var_pop(value) FILTER (WHERE mask = 1), 6) AS biased FROM vals GROUP BY rollout_id""",
)
def masked_var(spark, sf):
    cells = value_cells(spark, sf)
    value, mask = F.col("value"), F.col("mask")
    return cells.groupBy(*KEY).agg(
        r6(M.var_of(value, mask)).alias("unbiased"), r6(M.var_of(value, mask, unbiased=False)).alias("biased")
    )


@query(
    "masked_whiten",
    f"""WITH {SQL_VALUES}, s AS (
      SELECT avg(value) FILTER (WHERE mask = 1) AS m, var_samp(value) FILTER (WHERE mask = 1) AS v FROM vals)
    SELECT rollout_id, CAST(pos AS INTEGER) AS pos, round((value - m) / sqrt(v + 1e-8), 6) AS whitened,
      round((value - m) / sqrt(v + 1e-8) + m, 6) AS scaled FROM vals CROSS JOIN s""",
)
def masked_whiten(spark, sf):
    white = M.masked_whiten(value_cells(spark, sf))
    both = M.masked_whiten(white, name="scaled", shift_mean=False)
    return both.select("rollout_id", "pos", r6("whitened").alias("whitened"), r6("scaled").alias("scaled"))


@query(
    "sequence_kl",
    f"""WITH {t.SQL_CELLS}, sums AS (
      SELECT rollout_id, sum((logprob - ref_logprob) * mask) AS s FROM cells GROUP BY rollout_id)
    SELECT round(avg(s), 6) AS kl_ref FROM sums""",
)
def sequence_kl(spark, sf):
    return O.sequence_kl(t.rollout_cells(spark, sf)).withColumn("kl_ref", r6("kl_ref"))


@query(
    "kl_penalty",
    f"""WITH {t.SQL_CELLS}, d AS (SELECT rollout_id, CAST(pos AS INTEGER) AS pos, logprob - ref_logprob AS d FROM cells)
    SELECT rollout_id, pos, round(d, 6) AS kl, round(abs(d), 6) AS abs_kl, round(0.5::DOUBLE * d * d, 6) AS mse_kl FROM d""",
)
def kl_penalty(spark, sf):
    cells = O.explode_cells(t.rollout_cells(spark, sf), KEY, ["logprobs", "ref_logprobs"])
    p, q = F.col("logprobs"), F.col("ref_logprobs")
    return cells.select(
        "rollout_id",
        "pos",
        r6(R.kl_penalty(p, q, "kl")).alias("kl"),
        r6(R.kl_penalty(p, q, "abs")).alias("abs_kl"),
        r6(R.kl_penalty(p, q, "mse")).alias("mse_kl"),
    )


@query(
    "compute_rewards",
    f"""WITH {t.SQL_REWARDS} SELECT rollout_id, CAST(pos AS INTEGER) AS pos, round(reward, 6) AS reward,
      round(non_score_reward, 6) AS non_score_reward FROM rewarded""",
)
def compute_rewards(spark, sf):
    cells = O.explode_cells(rewarded(spark, sf), KEY, ["rewards", "non_score_rewards"])
    return cells.select(
        "rollout_id", "pos", r6("rewards").alias("reward"), r6("non_score_rewards").alias("non_score_reward")
    )


def _rewards(name, mode, penalty):
    @query(
        name,
        f"""WITH {t.sql_rewards(penalty)} SELECT rollout_id, CAST(pos AS INTEGER) AS pos, round(reward, 6) AS reward
        FROM rewarded""",
    )
    def rewards(spark, sf):
        done = O.compute_rewards(t.rollout_cells(spark, sf), O.RolloutConfig(kl_mode=mode))
        return O.explode_cells(done, KEY, ["rewards"]).select("rollout_id", "pos", r6("rewards").alias("reward"))


_rewards("compute_rewards_abs", "abs", "abs(logprob - ref_logprob)")
_rewards("compute_rewards_mse", "mse", "(0.5::DOUBLE * (logprob - ref_logprob) * (logprob - ref_logprob))")


@query(
    "compute_rewards_full",
    """WITH v AS (
      SELECT vec_id // 8 AS rollout_id, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 10) AS a,
        list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 5) AS b FROM embeddings),
    n AS (SELECT *, ln(list_sum(list_transform(a, lambda x: exp(x)))) AS la, ln(list_sum(list_transform(b, lambda x: exp(x)))) AS lb FROM v),
    k AS (SELECT rollout_id, vec_id, label, list_sum(list_transform(list_zip(a, b),
      lambda p: exp(p[1] - la) * ((p[1] - la) - (p[2] - lb)))) AS kl FROM n),
    cells AS (SELECT rollout_id, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY rollout_id) AS size, kl,
      sum(label) OVER (PARTITION BY rollout_id) / 10.0::DOUBLE AS score FROM k WINDOW w AS (PARTITION BY rollout_id ORDER BY vec_id))
    SELECT rollout_id, CAST(pos AS INTEGER) AS pos, round(-0.2::DOUBLE * kl, 6) AS non_score_reward,
      round(-0.2::DOUBLE * kl + CASE WHEN pos = size - 1 THEN score ELSE 0 END, 6) AS reward FROM cells""",
)
def compute_rewards_full(spark, sf):
    """The divergence over the whole vocabulary: eight vectors make a rollout, two temperatures are policy and reference."""
    logits = F.col("embedding").cast("array<double>")
    scored = [P.log_softmax(F.transform(logits, lambda x: x * factor)).alias(name) for name, factor in (("policy", 10.0), ("reference", 5.0))]
    cells = t.table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 8).alias("rollout_id"), F.col("vec_id").alias("pos"), "label", *scored)
    rows = O.gather_cells(cells, KEY, ["label", "policy", "reference"])
    score = F.aggregate("label", F.lit(0.0), lambda acc, x: acc + x) / 10
    ready = rows.select("rollout_id", "policy", "reference", score.alias("score"), F.transform("label", lambda x: F.lit(1)).alias("mask"))
    done = O.compute_rewards(ready, O.RolloutConfig(kl_mode="full"), "policy", "reference")
    out = O.explode_cells(done, KEY, ["non_score_rewards", "rewards"])
    return out.select("rollout_id", "pos", r6("non_score_rewards").alias("non_score_reward"), r6("rewards").alias("reward"))


@query(
    "mean_total_reward",
    f"""WITH {t.SQL_REWARDS}, sums AS (SELECT rollout_id, sum(reward * mask) AS s FROM rewarded GROUP BY rollout_id)
    SELECT round(avg(s), 6) AS mean_reward FROM sums""",
)
def mean_total_reward(spark, sf):
    return O.mean_total_reward(rewarded(spark, sf)).withColumn("mean_reward", r6("mean_reward"))


@query(
    "gae",
    f"WITH {t.SQL_ADVANTAGES} SELECT rollout_id, CAST(pos AS INTEGER) AS pos, round(adv, 6) AS advantage FROM advantages",
)
def gae(spark, sf):
    masked = {c: R.masked(F.col(c), F.col("mask")) for c in ("rewards", "values")}
    rows = rewarded(spark, sf).withColumns(masked).select(*KEY, *masked)
    cells = O.explode_cells(O.gae(rows, "rewards", "values"), KEY, ["advantages"])
    return cells.select("rollout_id", "pos", r6("advantages").alias("advantage"))


@query(
    "returns",
    f"""WITH {t.SQL_ADVANTAGES} SELECT rollout_id, CAST(pos AS INTEGER) AS pos, mask, round(ret, 6) AS ret,
      round(white, 6) AS advantage FROM advantages""",
)
def returns(spark, sf):
    cells = O.explode_cells(advantaged(t.rollout_cells(spark, sf)), KEY, ["mask", "returns", "advantages"])
    return cells.select("rollout_id", "pos", "mask", r6("returns").alias("ret"), r6("advantages").alias("advantage"))


@query(
    "whitened_rewards_advantages",
    f"""WITH {t.SQL_REWARDS},
    masked AS (SELECT *, value * mask AS v, reward * mask AS r0 FROM rewarded),
    rstat AS (SELECT avg(r0) FILTER (WHERE mask = 1) AS m, var_samp(r0) FILTER (WHERE mask = 1) AS v FROM masked),
    white_r AS (SELECT masked.*, (r0 - rstat.m) / sqrt(rstat.v + 1e-8) + rstat.m AS r FROM masked CROSS JOIN rstat),
    residual AS (
      SELECT *, r + coalesce(lead(v) OVER (PARTITION BY rollout_id ORDER BY pos), 0) - v AS delta FROM white_r)
    SELECT rollout_id, CAST(pos AS INTEGER) AS pos, round(v + sum(delta * power(0.95::DOUBLE, pos)) OVER (
      PARTITION BY rollout_id ORDER BY pos DESC) / power(0.95::DOUBLE, pos), 6) AS ret FROM residual""",
)
def whitened_rewards_advantages(spark, sf):
    """Returns with the reward whitening option on."""
    done = advantaged(t.rollout_cells(spark, sf), O.RolloutConfig(whiten_rewards=True))
    return O.explode_cells(done, KEY, ["returns"]).select("rollout_id", "pos", r6("returns").alias("ret"))


SQL_POLICY = "sum(greatest(pg, pg2) * mask) / sum(mask)"
SQL_VALUE = "0.5::DOUBLE * sum(greatest(vf, vf2) * mask) / sum(mask)"
SQL_POLICY_CLIP = "sum(CASE WHEN pg2 > pg THEN mask ELSE 0 END) / sum(mask)::DOUBLE"
SQL_VALUE_CLIP = "sum(CASE WHEN vf2 > vf THEN mask ELSE 0 END) / sum(mask)::DOUBLE"
SQL_RATIO = "sum(ratio * mask) / sum(mask)"


@query(
    "ppo_policy_loss",
    f"""WITH {t.SQL_LOSSES} SELECT mini_batch, round({SQL_POLICY}, 6) AS policy_loss,
      round({SQL_POLICY_CLIP}, 6) AS policy_clipfrac FROM losses GROUP BY mini_batch""",
)
def ppo_policy_loss(spark, sf):
    out = O.ppo_policy_loss(losses(spark, sf), ["mini_batch"])
    return out.select("mini_batch", r6("policy_loss").alias("policy_loss"), r6("policy_clipfrac").alias("policy_clipfrac"))


@query(
    "ppo_value_loss",
    f"""WITH {t.SQL_LOSSES} SELECT mini_batch, round({SQL_VALUE}, 6) AS value_loss,
      round({SQL_VALUE_CLIP}, 6) AS value_clipfrac FROM losses GROUP BY mini_batch""",
)
def ppo_value_loss(spark, sf):
    out = O.ppo_value_loss(losses(spark, sf), ["mini_batch"])
    return out.select("mini_batch", r6("value_loss").alias("value_loss"), r6("value_clipfrac").alias("value_clipfrac"))


# A threshold that some of the batches exceed.
THRESHOLD = 1.001


@query(
    "ppo_total_loss",
    f"""WITH {t.SQL_LOSSES}, sums AS (
      SELECT mini_batch, {SQL_POLICY} AS p, {SQL_VALUE} AS v, {SQL_RATIO} AS r FROM losses GROUP BY mini_batch)
    SELECT mini_batch, round(CASE WHEN r > {THRESHOLD}::DOUBLE THEN 0 ELSE p END, 6) AS policy_loss,
      round(CASE WHEN r > {THRESHOLD}::DOUBLE THEN 0 ELSE v END, 6) AS value_loss, round(r, 6) AS avg_ratio,
      round(CASE WHEN r > {THRESHOLD}::DOUBLE THEN 0 ELSE p + 0.1::DOUBLE * v END, 6) AS total_loss,
      r > {THRESHOLD}::DOUBLE AS skipped FROM sums""",
)
def ppo_total_loss(spark, sf):
    out = O.ppo_total_loss(losses(spark, sf), ["mini_batch"], O.RolloutConfig(ratio_threshold=THRESHOLD))
    return out.select(
        "mini_batch",
        "skipped",
        *[r6(c).alias(c) for c in ("policy_loss", "value_loss", "avg_ratio", "total_loss")],
    )


def _sql_stats(by, source="losses"):
    return f"""{t.SQL_LOSSES}, sums AS (
  SELECT {by}, {SQL_POLICY} AS p, {SQL_VALUE} AS v, {SQL_RATIO} AS r,
    sum(entropy * mask) / sum(mask) AS entropy, sum((logprob - new_logprob) * mask) / sum(mask) AS policykl,
    0.5::DOUBLE * sum((logprob - new_logprob) ** 2 * mask) / sum(mask) AS approxkl, {SQL_POLICY_CLIP} AS pclip,
    sum(white * mask) / sum(mask) AS adv_mean, sum(ret * mask) / sum(mask) AS ret_mean,
    var_samp(ret) FILTER (WHERE mask = 1) AS ret_var, sum(vpred * mask) / sum(mask) AS vpred,
    sum((vpred - ret) ** 2 * mask) / sum(mask) AS err, {SQL_VALUE_CLIP} AS vclip,
    sum(masked_value * mask) / sum(mask) AS v_mean, var_samp(masked_value) FILTER (WHERE mask = 1) AS v_var
  FROM (SELECT * RENAME (v AS masked_value) FROM {source}) GROUP BY {by}),
stats AS (
  SELECT {by}, CASE WHEN r > 1.5 THEN 0 ELSE p END AS "loss/policy", CASE WHEN r > 1.5 THEN 0 ELSE v END AS "loss/value",
    CASE WHEN r > 1.5 THEN 0 ELSE p + 0.1::DOUBLE * v END AS "loss/total", entropy AS "policy/entropy",
    policykl AS "policy/policykl", approxkl AS "policy/approxkl", pclip AS "policy/clipfrac",
    adv_mean AS "policy/advantages_mean", ret_mean AS "returns/mean", ret_var AS "returns/var", vpred AS "val/vpred",
    err AS "val/error", vclip AS "val/clipfrac", v_mean AS "val/mean", v_var AS "val/var" FROM sums)"""


SQL_STATS = _sql_stats("mini_batch")

STAT_NAMES = (
    "loss/policy loss/value loss/total policy/entropy policy/policykl policy/approxkl policy/clipfrac "
    "policy/advantages_mean returns/mean returns/var val/vpred val/error val/clipfrac val/mean val/var"
).split()


@query(
    "ppo_stats",
    f"WITH {SQL_STATS} SELECT mini_batch, " + ", ".join(f'round("{n}", 6) AS "{n}"' for n in STAT_NAMES) + " FROM stats",
)
def ppo_stats(spark, sf):
    flat = O.flat_ppo_stats(losses(spark, sf), ["mini_batch"])
    return flat.select("mini_batch", *[r6(F.col(f"`{n}`")).alias(n) for n in STAT_NAMES])


EPOCHS, MINI_BATCH, GRAD_ACCUM = 4, 8, 4
# Cells without their own mini-batch, once an epoch in that of the permutation.
SQL_PERMUTED = f"""(
    SELECT l.*, k.epoch, k.place // {MINI_BATCH * GRAD_ACCUM} AS backward_batch,
      (k.place % {MINI_BATCH * GRAD_ACCUM}) // {MINI_BATCH} AS mini_batch
    FROM (SELECT * EXCLUDE (mini_batch) FROM losses) l JOIN (
      SELECT rollout_id, epoch, row_number() OVER (PARTITION BY epoch ORDER BY md5('0|' || epoch || '|' || rollout_id), rollout_id) - 1
        AS place FROM rollouts CROSS JOIN range({EPOCHS}) e(epoch)) k USING (rollout_id))"""


@query(
    "ppo_step",
    f"""WITH {_sql_stats("epoch, backward_batch, mini_batch", SQL_PERMUTED)}
    SELECT CAST(epoch AS INTEGER) AS epoch, backward_batch, mini_batch, """
    + ", ".join(f'round("{n}", 6) AS "{n}"' for n in STAT_NAMES)
    + " FROM stats",
)
def ppo_step(spark, sf):
    """Every epoch permutes the rollouts into mini-batches of 8, four to a backward batch."""
    flat = M.flatten_stats(O.ppo_step(advantaged(t.rollout_cells(spark, sf), keep=STEP_COLUMNS), EPOCHS, MINI_BATCH, GRAD_ACCUM))
    return flat.select("epoch", "backward_batch", "mini_batch", *[r6(F.col(f"`{n}`")).alias(n) for n in STAT_NAMES])


@query(
    "stack_and_mean_stats",
    f"WITH {SQL_STATS} SELECT mini_batch // 2 AS step, "
    + ", ".join(f'round(avg("{n}"), 6) AS "ppo/{n}"' for n in STAT_NAMES)
    + " FROM stats GROUP BY mini_batch // 2",
)
def stack_and_mean_stats(spark, sf):
    """Two mini-batches make a step."""
    flat = O.flat_ppo_stats(losses(spark, sf), ["mini_batch"]).withColumn("step", F.floor(F.col("mini_batch") / 2))
    mean = M.stack_and_mean_stats(flat, ["step"])
    return mean.select("step", *[r6(F.col(f"`ppo/{n}`")).alias(f"ppo/{n}") for n in STAT_NAMES])


@query(
    "flatten_stats",
    """SELECT label AS "vec/label", vec_id AS "vec/id", round(embedding[1]::DOUBLE, 6) AS "vec/ends/first",
      round(embedding[64]::DOUBLE, 6) AS "vec/ends/last" FROM embeddings""",
)
def flatten_stats(spark, sf):
    ends = F.struct(
        r6(F.element_at("embedding", 1).cast("double")).alias("first"),
        r6(F.element_at("embedding", -1).cast("double")).alias("last"),
    )
    nested = t.table(spark, sf, "embeddings").select(
        F.struct("label", F.col("vec_id").alias("id"), ends.alias("ends")).alias("vec")
    )
    return M.flatten_stats(nested)


@query(
    "score_rollouts",
    f"WITH {t.SQL_ROLLOUTS} SELECT rollout_id, round(-abs(300 - len(response_ids)) / 100.0::DOUBLE, 6) AS reward FROM rollouts",
)
def score_rollouts(spark, sf):
    rows = t.rollout_rows(spark, sf).select("rollout_id", "response_ids")
    scored = O.score_rollouts(rows, lambda r: R.length_reward(F.size(r), 300), "response_ids", name="reward")
    return scored.select("rollout_id", r6("reward").alias("reward"))


@query(
    "early_stop",
    f"""WITH {t.SQL_KL_LOG},
    last AS (SELECT run_id, epoch, rank, arg_max(kl, minibatch) AS kl FROM kl_log GROUP BY ALL),
    epochs AS (SELECT run_id, epoch, avg(kl) AS kl FROM last GROUP BY ALL)
    SELECT run_id, coalesce(min(CASE WHEN kl > 1.5::DOUBLE * 0.01::DOUBLE THEN epoch END), -1) AS stop_epoch FROM epochs GROUP BY run_id""",
)
def early_stop(spark, sf):
    """A run that never stops shows -1."""
    stops = O.early_stop(t.kl_log(spark, sf), O.RolloutConfig(target_kl=0.01))
    return stops.withColumn("stop_epoch", F.coalesce("stop_epoch", F.lit(-1).cast("long")))
