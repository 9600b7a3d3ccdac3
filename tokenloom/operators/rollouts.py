"""Rollout tables: alignment, rewards, advantages, losses and statistics.

A rollout stays one row with array columns until a statistic over all cells is needed; rewards and advantages move no
data. Cell tables are exploded in the same stage that pre-aggregates them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import rollout as R
from tokenloom.functions.arrays import bind, total
from tokenloom.operators.masked import EMPTY_MASK, flatten_stats, mean_of, var_of, whitened
from tokenloom.operators.packing import minibatch_permutation
from tokenloom.operators.recurrence import discounted_suffix_sums
from tokenloom.plans.lookups import join_null_safe
from tokenloom.plans.staging import staged, staged_with


@dataclass(frozen=True)
class RolloutConfig:
    """Parameters of one step. The defaults are fixed values."""

    kl_coef: float = 0.2
    kl_mode: str = "kl"
    gamma: float = 1.0
    lam: float = 0.95
    clip: float = 0.2
    clip_value: float = 0.2
    value_coef: float = 0.1
    ratio_threshold: float = 1.5
    target_kl: float = 0.1
    stop_factor: float = 1.5
    whiten_rewards: bool = False


def align_rollouts(queries: DataFrame, responses: DataFrame, scores: DataFrame, batch_size: int | None = None) -> DataFrame:
    """Put queries, responses and scores with the same ``rollout_id`` side by side; all must hold each id exactly once.

    One pass in which each row is shuffled once: an id that is missing, repeated or NULL fails the job, as does another number
    of rollouts than ``batch_size`` (of empty tables there is no row to fail).
    """
    parts = [queries, responses, scores]
    packed = [F.struct(*[c for c in part.columns if c != "rollout_id"]).alias(f"_{i}") for i, part in enumerate(parts)]
    kinds = [part.select(p).schema[0].dataType for part, p in zip(parts, packed)]
    rows = reduce(
        DataFrame.unionByName,
        [part.select("rollout_id", *[packed[j] if i == j else F.lit(None).cast(kinds[j]).alias(f"_{j}") for j in range(3)]) for i, part in enumerate(parts)],
    )
    together = rows.groupBy("rollout_id").agg(*[F.first(f"_{j}", ignorenulls=True).alias(f"_{j}") for j in range(3)], *[F.count(f"_{j}").alias(f"_n{j}") for j in range(3)])
    named = F.coalesce(F.col("rollout_id").cast("string"), F.lit("NULL"))
    failed = F.raise_error(F.concat(F.lit("rollout not matched one to one in queries, responses and scores: "), named)).cast("boolean")
    once = (F.col("_n0") == 1) & (F.col("_n1") == 1) & (F.col("_n2") == 1) & F.col("rollout_id").isNotNull()
    matched = together.where(F.when(once, F.lit(True)).otherwise(failed)).select("rollout_id", "_0.*", "_1.*", "_2.*")
    if batch_size is None:
        return matched
    wrong = F.raise_error(F.concat(F.lit(f"expected {batch_size} rollouts, not "), F.col("_all").cast("string"))).cast("boolean")
    held = matched.withColumn("_all", queries.agg(F.count(F.lit(1))).scalar())
    return held.where(F.when(F.col("_all") == batch_size, F.lit(True)).otherwise(wrong)).drop("_all")


def align_policies(policy: DataFrame, reference: DataFrame) -> DataFrame:
    """Cells scored by both policies."""
    return policy.join(reference, ["rollout_id", "pos"])


def score_rollouts(df: DataFrame, scorer: Callable[..., Column], *columns: str, name: str = "score") -> DataFrame:
    """Attach a reward: any function from columns to a column, built-in expressions or a ``pandas_udf``."""
    return df.withColumn(name, scorer(*[F.col(c) for c in columns]))


def gather_cells(cells: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Long cells to one array per value column, in position order. A group is one rollout."""
    rows = F.array_sort(F.collect_list(F.struct("pos", *values)))
    return cells.groupBy(*key).agg(rows.alias("_rows")).select(*key, *[F.col(f"_rows.{v}").alias(v) for v in values])


def explode_cells(df: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Arrays to long cells (key, pos, values)."""
    return (
        df.select(*key, F.posexplode(F.arrays_zip(*values)).alias("pos", "_c"))
        .select(*key, "pos", *[F.col(f"_c.{v}").alias(v) for v in values])
    )


def _array_moments(values: Column, mask: Column) -> Column:
    """Number ``n``, ``mean`` and sum of squared deviations ``squares`` of the masked-in cells of a row."""
    inside = F.transform(F.filter(F.arrays_zip(values.alias("v"), mask.alias("m")), lambda c: c["m"] == 1), lambda c: c["v"])

    def around(cells: Column, mean: Column) -> Column:
        return F.struct(F.size(cells).alias("n"), mean.alias("mean"), F.aggregate(cells, F.lit(0.0), lambda acc, v: acc + (v - mean) * (v - mean)).alias("squares"))

    return bind(inside, lambda cells: bind(F.try_divide(total(cells), F.size(cells)), lambda mean: around(cells, mean)))


def whiten_arrays(df: DataFrame, values: str, mask: str = "mask", shift_mean: bool = True) -> DataFrame:
    """Whiten an array column by the masked statistics over all cells of the table.

    The rows are written once and their moments observed on the way, so nothing is computed or read a second time.
    """
    n, mean, squares = (F.col(f"_moments.{c}") for c in ("n", "mean", "squares"))
    middle = F.try_divide(F.sum(n * mean), F.sum(n))
    between = F.sum(n * mean * mean) - F.sum(n) * middle * middle
    held, stats = staged_with(
        df.withColumn("_moments", _array_moments(F.col(values), F.col(mask))), "whitening",
        F.coalesce(F.sum(n), F.lit(0)).alias("n"), middle.alias("mean"),
        F.when(F.sum(n) > 1, F.greatest(F.sum(squares) + between, F.lit(0.0)) / (F.sum(n) - 1)).alias("var"),
    )
    return held.drop("_moments").withColumn(values, F.transform(values, lambda v: whitened(v, stats, shift_mean)))


def compute_rewards(
    df: DataFrame, config: RolloutConfig = RolloutConfig(), policy: str = "logprobs", reference: str = "ref_logprobs"
) -> DataFrame:
    """Add ``non_score_rewards`` (penalty on every cell) and ``rewards`` (with the score on the last masked-in cell).

    In ``full`` mode ``policy`` and ``reference`` name columns that hold a vector over the vocabulary per cell, next to
    the scalar columns that the losses read.
    """
    penalty = R.non_score_rewards(F.col(policy), F.col(reference), config.kl_coef, config.kl_mode)
    return df.withColumn("non_score_rewards", penalty).withColumn(
        "rewards", R.token_rewards(F.col("non_score_rewards"), F.col("score"), F.col("mask"))
    )


def gae(df: DataFrame, rewards: str, values: str, config: RolloutConfig = RolloutConfig()) -> DataFrame:
    """Add ``advantages``: generalised advantage estimates from masked rewards and values."""
    residuals = R.td_residuals(F.col(rewards), F.col(values), config.gamma)
    return discounted_suffix_sums(df, residuals, config.gamma * config.lam, "advantages")


def compute_advantages(df: DataFrame, config: RolloutConfig = RolloutConfig()) -> DataFrame:
    """Mask values, then add ``returns`` and whitened ``advantages``.

    Returns use the advantages before whitening. Whitened rewards are not masked again, so masked-out cells carry
    non-zero rewards into the recurrence; this is the defined behaviour of that option.
    """
    masked = df.withColumns(
        {
            "values": R.masked(F.col("values"), F.col("mask")),
            "_rewards": R.masked(F.col("rewards"), F.col("mask")),
        }
    )
    if config.whiten_rewards:
        masked = whiten_arrays(masked, "_rewards", shift_mean=False)
    raw = gae(masked, "_rewards", "values", config).drop("_rewards")
    with_returns = raw.withColumn("returns", F.zip_with("advantages", "values", lambda a, v: a + v))
    return whiten_arrays(with_returns, "advantages")


def _masked_sum(values: Column, mask: Column) -> Column:
    return F.aggregate(R.masked(values, mask), F.lit(0.0), lambda acc, x: acc + x)


def sequence_kl(df: DataFrame) -> DataFrame:
    """Mean over rollouts of the summed masked log ratio to the reference."""
    ratio = F.zip_with("logprobs", "ref_logprobs", lambda p, q: p - q)
    return df.agg(F.avg(_masked_sum(ratio, F.col("mask"))).alias("kl_ref"))


def mean_total_reward(df: DataFrame) -> DataFrame:
    """Mean over rollouts of the summed masked rewards."""
    return df.agg(F.avg(_masked_sum(F.col("rewards"), F.col("mask"))).alias("mean_reward"))


CELL_VALUES = ("mask", "logprobs", "new_logprobs", "values", "vpreds", "advantages", "returns", "entropy")


def loss_cells(df: DataFrame, key: Sequence[str], config: RolloutConfig = RolloutConfig()) -> DataFrame:
    """One row per cell with its ratio and the plain and clipped losses."""
    cells = explode_cells(df, key, CELL_VALUES)
    return _with_losses(cells, config)


def _with_losses(cells: DataFrame, config: RolloutConfig) -> DataFrame:
    cells = cells.withColumn("ratio", F.exp(F.col("new_logprobs") - F.col("logprobs")))
    plain, clipped = R.policy_losses(F.col("ratio"), F.col("advantages"), config.clip)
    v_plain, v_clipped = R.value_losses(F.col("vpreds"), F.col("values"), F.col("returns"), config.clip_value)
    return cells.withColumns({"pg": plain, "pg_clipped": clipped, "vf": v_plain, "vf_clipped": v_clipped})


def ppo_policy_loss(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Masked mean of the worse of the two policy losses, and how often the clipped one is strictly worse."""
    m = F.col("mask")
    return cells.groupBy(*by).agg(
        mean_of(F.greatest("pg", "pg_clipped"), m).alias("policy_loss"),
        mean_of((F.col("pg_clipped") > F.col("pg")).cast("int"), m).alias("policy_clipfrac"),
    )


def ppo_value_loss(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Half the masked mean of the worse squared error, and the clip fraction."""
    m = F.col("mask")
    return cells.groupBy(*by).agg(
        (mean_of(F.greatest("vf", "vf_clipped"), m) * F.lit(0.5)).alias("value_loss"),
        mean_of((F.col("vf_clipped") > F.col("vf")).cast("int"), m).alias("value_clipfrac"),
    )


def ppo_total_loss(cells: DataFrame, by: Sequence[str], config: RolloutConfig = RolloutConfig()) -> DataFrame:
    """Policy plus weighted value loss; a batch whose mean ratio exceeds the threshold is skipped with zero losses."""
    m = F.col("mask")
    sums = cells.groupBy(*by).agg(
        mean_of(F.greatest("pg", "pg_clipped"), m).alias("policy_loss"),
        (mean_of(F.greatest("vf", "vf_clipped"), m) * F.lit(0.5)).alias("value_loss"),
        mean_of(F.col("ratio"), m).alias("avg_ratio"),
    )
    return _apply_threshold(sums, config)


def _apply_threshold(df: DataFrame, config: RolloutConfig) -> DataFrame:
    skipped = F.col("avg_ratio") > F.lit(config.ratio_threshold)

    def kept(c: Column) -> Column:
        return F.when(skipped, F.lit(0.0)).otherwise(c)

    total = F.col("policy_loss") + F.lit(config.value_coef) * F.col("value_loss")
    return df.withColumns(
        {
            "total_loss": kept(total),
            "policy_loss": kept(F.col("policy_loss")),
            "value_loss": kept(F.col("value_loss")),
            "skipped": skipped,
        }
    )


def _cell_terms() -> dict[str, Column]:
    """What the statistics average over masked-in cells."""
    drift = F.col("logprobs") - F.col("new_logprobs")
    error = F.col("vpreds") - F.col("returns")
    return {
        "policy_loss": F.greatest("pg", "pg_clipped"),
        "value_loss": F.greatest("vf", "vf_clipped") * F.lit(0.5),
        "avg_ratio": F.col("ratio"),
        "entropy": F.col("entropy"),
        "policykl": drift,
        "approxkl": drift * drift * F.lit(0.5),
        "pg_clipfrac": (F.col("pg_clipped") > F.col("pg")).cast("int"),
        "advantages_mean": F.col("advantages"),
        "return_mean": F.col("returns"),
        "vpred": F.col("vpreds"),
        "error": error * error,
        "vf_clipfrac": (F.col("vf_clipped") > F.col("vf")).cast("int"),
        "value_mean": F.col("values"),
    }


#: Statistics whose variance is reported too, and the cells they are over.
_SPREAD = {"return": "returns", "value": "values"}


def ppo_stats(cells: DataFrame, by: Sequence[str], config: RolloutConfig = RolloutConfig()) -> DataFrame:
    """The statistics of every mini-batch as nested structs; ``flat_ppo_stats`` names them ``a/b``.

    One aggregate over the cells. ``approxkl`` is reported next to the sampled ``policykl``.
    """
    m = F.col("mask")
    sums = cells.groupBy(*by).agg(
        *[mean_of(term, m).alias(name) for name, term in _cell_terms().items()],
        *[var_of(F.col(c), m).alias(f"{name}_var") for name, c in _SPREAD.items()],
    )
    return _nested_stats(sums, by, config)


def _nested_stats(sums: DataFrame, by: Sequence[str], config: RolloutConfig) -> DataFrame:
    done = _apply_threshold(sums, config)

    def group(**fields: str) -> Column:
        return F.struct(*[F.col(c).alias(k) for k, c in fields.items()])

    return done.select(
        *by,
        group(policy="policy_loss", value="value_loss", total="total_loss").alias("loss"),
        group(
            entropy="entropy",
            policykl="policykl",
            approxkl="approxkl",
            clipfrac="pg_clipfrac",
            advantages_mean="advantages_mean",
        ).alias("policy"),
        group(mean="return_mean", var="return_var").alias("returns"),
        group(vpred="vpred", error="error", clipfrac="vf_clipfrac", mean="value_mean", var="value_var").alias("val"),
    )


def rollout_sums(df: DataFrame, config: RolloutConfig = RolloutConfig(), key: str = "rollout_id") -> DataFrame:
    """One narrow row per rollout: the sums that the statistics of any set of rollouts need. Reads the cells once."""
    m = F.col("mask")
    terms = [F.sum(term * m).alias(name) for name, term in _cell_terms().items()]
    spread = [
        c
        for name, v in _SPREAD.items()
        for c in (F.avg(F.when(m == 1, F.col(v))).alias(f"{name}_middle"), (F.var_pop(F.when(m == 1, F.col(v))) * F.sum(m)).alias(f"{name}_squares"))
    ]
    return loss_cells(df, [key], config).groupBy(key).agg(F.sum(m).cast("long").alias("n"), *terms, *spread)


def ppo_step(
    df: DataFrame, epochs: int, mini_batch: int, grad_accum: int = 1, config: RolloutConfig = RolloutConfig(), seed: int = 0, key: str = "rollout_id"
) -> DataFrame:
    """Statistics of each mini-batch of a step: ``epoch, backward_batch, mini_batch`` and the structs of ``ppo_stats``.

    Every epoch permutes the rollouts and cuts them into backward batches and mini-batches. Cells are read once, for sums per
    rollout; only those are grouped anew in each epoch. Sums of squares are joined from those of the rollouts around
    their own means. A mini-batch without a masked-in cell is an error, as in ``ppo_stats``.
    """
    sums = staged(rollout_sums(df, config, key), "rollout-sums")
    placed = minibatch_permutation(sums, key, epochs, mini_batch, grad_accum, seed)
    by = ["epoch", "backward_batch", "mini_batch"]
    n = F.sum("n")
    means = [F.try_divide(F.sum(name), n).alias(name) for name in _cell_terms()]
    variances = []
    for name in _SPREAD:
        middle, own = F.col(f"{name}_middle"), F.col("n")
        between = F.sum(own * middle * middle) - F.try_divide(F.sum(own * middle) * F.sum(own * middle), n)
        squares = F.greatest(F.sum(f"{name}_squares") + between, F.lit(0.0))
        empty = F.raise_error(F.lit(EMPTY_MASK)).cast("double")
        variances.append(F.when(F.coalesce(n, F.lit(0)) == 0, empty).otherwise(F.try_divide(squares, n - 1)).alias(f"{name}_var"))
    grouped = join_null_safe(placed.select(key, *by), sums, [key]).groupBy(*by).agg(*means, *variances)
    return _nested_stats(grouped, by, config)


def flat_ppo_stats(cells: DataFrame, by: Sequence[str], config: RolloutConfig = RolloutConfig()) -> DataFrame:
    return flatten_stats(ppo_stats(cells, by, config))


def early_stop(log: DataFrame, config: RolloutConfig = RolloutConfig(), enabled: bool = True) -> DataFrame:
    """Per run the first epoch whose KL exceeds the limit.

    The KL of an epoch is that of its last mini-batch, averaged over the ranks. Runs that never stop, and every run
    when the rule is off, get NULL.
    """
    last = log.groupBy("run_id", "epoch", "rank").agg(F.max_by("kl", "minibatch").alias("kl"))
    per_epoch = last.groupBy("run_id", "epoch").agg(F.avg("kl").alias("kl"))
    over = F.col("kl") > F.lit(config.stop_factor * config.target_kl)
    if not enabled:
        over = F.lit(False)
    return per_epoch.groupBy("run_id").agg(F.min(F.when(over, F.col("epoch"))).alias("stop_epoch"))
