"""Run logs: schedules, averages, checkpoint decisions, controllers."""

from pyspark.sql import functions as F

from tokenloom.catalog import tables as t
from tokenloom.catalog.registry import query, r6
from tokenloom.operators import runlog as L

SCHEDULE = L.Schedule(learning_rate=5e-4, min_lr=5e-5, warmup=10, max_steps=60)


@query(
    "run_log",
    f"WITH {t.SQL_LOG} SELECT run_id, step, split, loss, event_id FROM log",
)
def run_log(spark, sf):
    """Steps of each run numbered in time order."""
    return t.run_log(spark, sf).drop("ts")


@query("every_n", f"WITH {t.SQL_LOG} SELECT run_id, step, loss FROM log WHERE step % 5 = 0")
def every_n(spark, sf):
    return L.every_n(t.run_log(spark, sf), 5).select("run_id", "step", "loss")


@query(
    "lr_schedule",
    f"""WITH {t.SQL_LOG} SELECT run_id, step, round(CASE WHEN step < 10 THEN 0.0005::DOUBLE * step / 10
      WHEN step > 60 THEN 0.00005::DOUBLE
      ELSE 0.00005::DOUBLE + 0.5::DOUBLE * (1 + cos(pi() * (step - 10) / 50.0::DOUBLE)) * (0.0005::DOUBLE - 0.00005::DOUBLE)
      END, 9) AS lr FROM log""",
)
def lr_schedule(spark, sf):
    log = t.run_log(spark, sf)
    return log.select("run_id", "step", F.round(L.lr_schedule(F.col("step"), SCHEDULE), 9).alias("lr"))


PER_STEP = L.tokens_per_step(grad_accum=4, world=2, batch=128, length=256)


@query(
    "token_budget",
    f"WITH {t.SQL_LOG} SELECT run_id, step, {PER_STEP} * (step + 1) AS cumulative_tokens FROM log",
)
def token_budget(spark, sf):
    log = t.run_log(spark, sf).select("run_id", "step")
    return L.token_budget(log, PER_STEP, width=16).drop("tokens")


def evals(spark, sf):
    """Eight steps of a run make one evaluation; its batches are the steps in order."""
    return t.run_log(spark, sf).select(
        "run_id", F.floor(F.col("step") / 8).alias("step"), "split", F.col("step").alias("batch"), "loss"
    )


@query(
    "eval_mean_loss",
    f"""WITH {t.SQL_LOG}, ranked AS (
      SELECT run_id, step // 8 AS step, split, loss,
        row_number() OVER (PARTITION BY run_id, step // 8, split ORDER BY log.step) AS rk FROM log)
    SELECT run_id, step, split, round(avg(loss), 6) AS loss, count(*) AS batches FROM ranked WHERE rk <= 3 GROUP BY ALL""",
)
def eval_mean_loss(spark, sf):
    return L.eval_mean_loss(evals(spark, sf), 3).withColumn("loss", r6("loss"))


def eval_log(spark, sf):
    """Every second step is an evaluation."""
    log = L.every_n(t.run_log(spark, sf), 2)
    return log.select("run_id", "step", F.col("loss").alias("val_loss"))


@query(
    "best_checkpoint",
    f"""WITH {t.SQL_LOG}, evals AS (SELECT run_id, step, loss AS val_loss FROM log WHERE step % 2 = 0),
    seen AS (SELECT *, least(coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY step
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1e9::DOUBLE), 1e9::DOUBLE) AS best_before FROM evals)
    SELECT run_id, step, val_loss, best_before, val_loss < best_before AS improved,
      val_loss < best_before AND step > 0 AS saved FROM seen""",
)
def best_checkpoint(spark, sf):
    return L.best_checkpoint(eval_log(spark, sf), width=16)


@query(
    "best_checkpoint_always",
    f"""WITH {t.SQL_LOG}, evals AS (SELECT run_id, step, loss AS val_loss FROM log WHERE step % 2 = 0),
    seen AS (SELECT *, coalesce(lag(val_loss) OVER (PARTITION BY run_id ORDER BY step), 1e9::DOUBLE) AS best_before
      FROM evals)
    SELECT run_id, step, val_loss, best_before, val_loss < best_before AS improved, step > 0 AS saved FROM seen""",
)
def best_checkpoint_always(spark, sf):
    return L.best_checkpoint(eval_log(spark, sf), always_save=True, width=16)


@query(
    "step_duration",
    f"""WITH {t.SQL_LOG} SELECT run_id, step, round((epoch_us(ts) - lag(epoch_us(ts)) OVER (
      PARTITION BY run_id ORDER BY step)) / 1000.0::DOUBLE, 6) AS ms FROM log""",
)
def step_duration(spark, sf):
    timed = L.step_duration(t.run_log(spark, sf), width=16)
    return timed.select("run_id", "step", r6("ms").alias("ms"))


@query(
    "kl_controller",
    f"""WITH {t.SQL_KL_LOG}, mult AS (
      SELECT run_id, step, 1 + greatest(least(kl / 0.006::DOUBLE - 1, 0.2::DOUBLE), -0.2::DOUBLE) * n / 10000.0::DOUBLE AS m
      FROM kl_log)
    SELECT run_id, step, round(0.2::DOUBLE * product(m) OVER (PARTITION BY run_id ORDER BY step), 6) AS kl_coef,
      0.2::DOUBLE AS fixed_coef FROM mult""",
)
def kl_controller(spark, sf):
    log = t.kl_log(spark, sf).select("run_id", "step", "kl", "n")
    done = L.kl_controller(log, start=0.2, target=0.006, horizon=10_000, width=16)
    fixed = L.kl_controller(done.withColumnRenamed("kl_coef", "adaptive"), 0.2, 0.006, 10_000, adaptive=False)
    return fixed.select(
        "run_id", "step", r6("adaptive").alias("kl_coef"), F.col("kl_coef").alias("fixed_coef")
    )


@query(
    "mfu",
    f"""WITH {t.SQL_LOG}, spans AS (
      SELECT run_id, count(*) AS iters, (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6::DOUBLE AS secs, sum(loss) AS n
      FROM log GROUP BY run_id)
    SELECT run_id, iters, round((6 * n * 1000000 + 12.0::DOUBLE * 6 * 6 * 48 * 256) * 256.0::DOUBLE * iters / nullif(secs, 0)
      / 312e12::DOUBLE * 1e6, 6) AS mfu_e6 FROM spans""",
)
def mfu(spark, sf):
    """The summed value of a run, in millions, plays its parameter count; a million times the share is shown."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    spans = t.run_log(spark, sf).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("iters"),
        ((F.max(micros) - F.min(micros)) / 1e6).alias("secs"),
        F.sum("loss").alias("n"),
    )
    share = L.mfu(F.col("n") * 1_000_000, 6, 6, 48, 256, F.col("iters"), F.col("secs"))
    return spans.select("run_id", "iters", r6(share * 1e6).alias("mfu_e6"))
