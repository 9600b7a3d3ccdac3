"""Per-rollout expressions: masks, penalties, rewards, advantages, losses.

A rollout is one row; its T-1 cells are arrays of that length. Nothing here moves rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.arrays import bind

# Fixed values of the length reward.
TARGET_LENGTH = 200
LENGTH_SCALE = 100.0

KL_MODES = ("kl", "abs", "mse", "full")


def clip_by_value(x: Column, low: Column, high: Column) -> Column:
    """Limit ``x`` to [low, high]; ``low`` wins when the limits cross."""
    return F.greatest(F.least(x, high), low)


def concat_prompt_response(query: Column, response: Column) -> Column:
    return F.concat(query, response)


def length_reward(length: Column, target: int = TARGET_LENGTH) -> Column:
    """Falls off linearly with the distance from the target length."""
    return -F.abs(F.lit(target) - length) / F.lit(LENGTH_SCALE)


def sample_length(low: int, high: int, seed: int, *keys: Column) -> Column:
    """Uniform integer in [low, high) fixed by the seed and the keys."""
    if high <= low:
        raise ValueError("the range is empty")
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (F.lit(low) + F.pmod(number, F.lit(high - low))).cast("int")


def response_mask(
    query: Column, response: Column, attention: Column, extra: Column | None = None
) -> Column:
    """1 on the T-1 cells that score a response token, 0 elsewhere.

    Cell ``i`` scores token ``i + 1``. The response starts ``size(query) - 1`` cells in, later by the left padding if
    there is any, and the attention mask and an optional per-response mask can switch cells off.
    """
    given = F.struct(
        attention.alias("attention"),
        F.size(query).alias("prompt"),
        F.size(response).alias("answer"),
        (extra if extra is not None else F.lit(None).cast("array<int>")).alias("extra"),
    )

    def limits(g: Column) -> Column:
        padding = F.when(
            F.element_at(g["attention"], 1) == 0, F.greatest(F.array_position(g["attention"], 1) - 1, F.lit(0))
        ).otherwise(0)
        start = g["prompt"] - 1 + padding
        return F.struct(start.alias("start"), (start + g["answer"]).alias("end"))

    def mask(g: Column, lim: Column) -> Column:
        def cell(i: Column) -> Column:
            inside = (i >= lim["start"]) & (i < lim["end"]) & (F.get(g["attention"], (i + 1).cast("int")) == 1)
            keep = F.when(inside, 1).otherwise(0)
            if extra is None:
                return keep
            # The per-response mask is aligned with the prompt without its padding.
            return (keep * F.coalesce(F.get(g["extra"], (i + 1 - g["prompt"]).cast("int")), F.lit(0))).cast("int")

        cells = F.size(g["attention"]) - 1
        positions = F.when(cells > 0, F.sequence(F.lit(0), cells - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(positions, cell)

    return bind(given, lambda g: bind(limits(g), lambda lim: mask(g, lim)))


def kl_penalty(logprob: Column, ref: Column, mode: str = "kl") -> Column:
    """Penalty of one cell; in ``full`` mode the arguments are log-probability vectors over the vocabulary."""
    if mode == "kl":
        return logprob - ref
    if mode == "abs":
        return F.abs(logprob - ref)
    if mode == "mse":
        return (logprob - ref) * (logprob - ref) * F.lit(0.5)
    if mode == "full":
        # Divergence with log targets: the policy weighs its own log ratio.
        terms = F.zip_with(logprob, ref, lambda p, q: F.exp(p) * (p - q))
        return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    raise ValueError(f"unknown penalty mode {mode!r}; choose one of {KL_MODES}")


def non_score_rewards(logprobs: Column, refs: Column, beta: Column | float, mode: str = "kl") -> Column:
    """``-beta * penalty`` on every cell, masked or not."""
    beta = F.lit(beta) if isinstance(beta, (int, float)) else beta
    return F.zip_with(logprobs, refs, lambda p, q: -beta * kl_penalty(p, q, mode))


def token_rewards(non_score: Column, score: Column, mask: Column) -> Column:
    """Add the rollout's score to its last masked-in cell; a rollout without any such cell is an error."""
    last = bind(
        mask,
        lambda m: F.when(F.array_contains(m, 1), F.size(m) - F.array_position(F.reverse(m), 1)).otherwise(
            F.raise_error(F.lit("a rollout has no response cell to reward")).cast("long")
        ),
    )
    given = F.struct(last.alias("last"), score.alias("score"))
    return bind(
        given,
        lambda g: F.transform(non_score, lambda r, i: F.when(i == g["last"], r + g["score"]).otherwise(r)),
    )


def masked(values: Column, mask: Column) -> Column:
    return F.zip_with(values, mask, lambda v, m: v * m)


def td_residuals(rewards: Column, values: Column, gamma: float) -> Column:
    """``r_t + gamma * V_{t+1} - V_t``; the value after the last cell is 0. Both inputs are already masked."""

    def residuals(v: Column) -> Column:
        # One cell longer than the rewards would be a cell too many for an empty rollout.
        following = F.slice(F.concat(v, F.array(F.lit(0.0))), F.lit(2), F.size(v))
        return F.zip_with(
            F.zip_with(rewards, following, lambda r, n: r + F.lit(gamma) * n), v, lambda d, now: d - now
        )

    return bind(values, residuals)


def policy_losses(ratio: Column, advantage: Column, clip: float) -> tuple[Column, Column]:
    """Plain and clipped policy loss of one cell."""
    limited = clip_by_value(ratio, F.lit(1.0 - clip), F.lit(1.0 + clip))
    return -advantage * ratio, -advantage * limited


def value_losses(vpred: Column, value: Column, target: Column, clip: float) -> tuple[Column, Column]:
    """Plain and clipped squared value error of one cell."""
    limited = clip_by_value(vpred, value - clip, value + clip)
    return (vpred - target) * (vpred - target), (limited - target) * (limited - target)
