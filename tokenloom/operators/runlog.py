"""Run logs: schedules, evaluation averages, checkpoint decisions, controllers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.plans.running import BUCKET_WIDTH, blocks, running

# The loss no run can be worse than, the assumed peak of the accelerator, the limits of one KL update.
START_LOSS = 1e9
PEAK_FLOPS = 312e12
MAX_KL_STEP = 0.2


@dataclass(frozen=True)
class Schedule:
    """Learning-rate schedule. The defaults are fixed values."""

    learning_rate: float = 5e-4
    min_lr: float = 0.0
    warmup: int = 1000
    max_steps: int = 100_000
    decay: bool = True


def lr_schedule(step: Column, cfg: Schedule = Schedule()) -> Column:
    """Linear warm-up, cosine decay to the minimum, then constant; constant throughout when decay is off."""
    peak, low = F.lit(cfg.learning_rate), F.lit(cfg.min_lr)
    if not cfg.decay:
        return peak
    span = cfg.max_steps - cfg.warmup
    # With warm-up equal to the maximum only that single step is left for the cosine; its progress is 0.
    progress = (step - F.lit(cfg.warmup)) / F.lit(span) if span else F.lit(0.0)
    cosine = low + (F.cos(F.pi() * progress) + 1.0) * 0.5 * (peak - low)
    warm = peak * step / F.lit(cfg.warmup) if cfg.warmup else peak
    return F.when(step < cfg.warmup, warm).when(step > cfg.max_steps, low).otherwise(cosine)


def every_n(df: DataFrame, n: int, step: str = "step") -> DataFrame:
    """Steps at which something periodic happens, such as logging or evaluation."""
    return df.where(F.col(step) % n == 0)


def tokens_per_step(grad_accum: int, world: int, batch: int, length: int) -> int:
    return grad_accum * world * batch * length


def token_budget(log: DataFrame, per_step: int, width: int = BUCKET_WIDTH) -> DataFrame:
    """Cumulative tokens up to and including each step of a run."""
    return running(
        log.withColumn("tokens", F.lit(per_step).cast("long")),
        group=["run_id"],
        bucket=[blocks("step", width)],
        order=["step"],
        value=F.col("tokens"),
        kind="sum",
        name="cumulative_tokens",
        inclusive=True,
    )


def eval_mean_loss(evals: DataFrame, k: int) -> DataFrame:
    """Mean loss of the first ``k`` batches of every (run, step, split).

    The rank filter is pushed below the shuffle, so a group sends at most ``k`` rows per task.
    """
    order = Window.partitionBy("run_id", "step", "split").orderBy("batch")
    first = evals.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    return first.groupBy("run_id", "step", "split").agg(F.avg("loss").alias("loss"), F.count("loss").alias("batches"))


def best_checkpoint(log: DataFrame, always_save: bool = False, width: int = BUCKET_WIDTH) -> DataFrame:
    """Decision at each evaluation step: (best_before, improved, saved).

    The best loss starts at a very large value. A step with a lower loss becomes the best; step 0 is never saved. With
    ``always_save`` every later step is saved and the last loss is taken for the best even when it is worse.
    """
    seen = running(
        log,
        group=["run_id"],
        bucket=[blocks("step", width)],
        order=["step"],
        value=F.col("val_loss"),
        kind="last" if always_save else "min",
        name="_before",
    )
    before = F.coalesce(F.col("_before"), F.lit(START_LOSS))
    if not always_save:
        before = F.least(before, F.lit(START_LOSS))
    improved = F.col("val_loss") < F.col("best_before")
    saved = (F.col("step") > 0) & (F.lit(True) if always_save else F.col("improved"))
    return seen.withColumn("best_before", before).drop("_before").withColumn("improved", improved).withColumn("saved", saved)


def step_duration(log: DataFrame, width: int = BUCKET_WIDTH) -> DataFrame:
    """Milliseconds since the previous step of the run; NULL for the first."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    seen = running(
        log.withColumn("_micros", micros),
        group=["run_id"],
        bucket=[blocks("step", width)],
        order=["step"],
        value=F.col("_micros"),
        kind="last",
        name="_previous",
    )
    return seen.withColumn("ms", (F.col("_micros") - F.col("_previous")) / F.lit(1000.0)).drop("_micros", "_previous")


def kl_controller(
    log: DataFrame, start: float, target: float, horizon: int, adaptive: bool = True, width: int = BUCKET_WIDTH
) -> DataFrame:
    """Penalty coefficient after each step.

    Every update multiplies the coefficient by ``1 + clip(kl / target - 1) * n / horizon``, so the coefficient is the
    start value times a running product. The fixed variant never changes.
    """
    if not adaptive:
        return log.withColumn("kl_coef", F.lit(start))
    error = F.greatest(F.least(F.col("kl") / F.lit(target) - 1, F.lit(MAX_KL_STEP)), F.lit(-MAX_KL_STEP))
    product = running(
        log,
        group=["run_id"],
        bucket=[blocks("step", width)],
        order=["step"],
        value=error * F.col("n") / F.lit(float(horizon)) + 1.0,
        kind="product",
        name="_product",
        inclusive=True,
    )
    return product.withColumn("kl_coef", F.col("_product") * F.lit(start)).drop("_product")


def mfu(params: Column, layers: int, heads: int, head_dim: int, length: int, iters: Column, seconds: Column) -> Column:
    """Share of the assumed peak that a run reaches: ``6N + 12 L H Q T`` operations per token."""
    per_token = params * 6.0 + F.lit(12.0 * layers * heads * head_dim * length)
    return F.try_divide(per_token * F.lit(float(length)) * iters, seconds) / F.lit(PEAK_FLOPS)
