"""Score vectors: log-probabilities, filtering and sampling of the next token.

Every function works inside one row. A vector of V scores costs O(V log V) at most: running sums over a sorted vector
are folds that keep two numbers, never growing arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.arrays import bind, total

_BANNED = float("-inf")


def as_double(scores: Column) -> Column:
    return scores.cast("array<double>")


def log_sum_exp(scores: Column) -> Column:
    """``ln(sum(exp(scores)))`` with the largest score taken out first."""
    return bind(scores, _log_sum_exp)


def _log_sum_exp(v: Column) -> Column:
    return bind(
        F.array_max(v),
        lambda top: top + F.ln(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))),
    )


def log_softmax(scores: Column) -> Column:
    """Logarithm of the softmax of a score vector."""
    return bind(
        as_double(scores), lambda v: bind(_log_sum_exp(v), lambda norm: F.transform(v, lambda x: x - norm))
    )


def softmax(scores: Column, temperature: float = 1.0) -> Column:
    """``softmax(scores / temperature)``; banned entries get probability 0."""
    if temperature <= 0:
        raise ValueError("temperature must be positive; use greedy() for temperature 0")
    scaled = F.transform(as_double(scores), lambda x: x / F.lit(float(temperature)))
    return bind(scaled, lambda v: bind(_log_sum_exp(v), lambda norm: F.transform(v, lambda x: F.exp(x - norm))))


def gather_label(values: Column, label: Column) -> Column:
    """The entry that belongs to the zero-based ``label``."""
    return F.element_at(values, (label + 1).cast("int"))


def logprobs_from_logits(scores: Column, label: Column, gather: bool = True) -> Column:
    """Log-probability of ``label``, or of every token when ``gather`` is off."""
    if not gather:
        return log_softmax(scores)
    return bind(as_double(scores), lambda v: gather_label(v, label) - _log_sum_exp(v))


def token_loss(scores: Column, target: Column) -> Column:
    """Cross entropy of one position; NULL for the ignored target -1."""
    return F.when(target != -1, -logprobs_from_logits(scores, target))


def entropy(scores: Column) -> Column:
    """Entropy of the softmax distribution: ``logsumexp(v) - sum(p * v)``."""

    def of(v: Column) -> Column:
        return bind(
            _log_sum_exp(v),
            lambda norm: norm - F.aggregate(v, F.lit(0.0), lambda acc, x: acc + F.exp(x - norm) * x),
        )

    return bind(as_double(scores), of)


def top_k_filter(scores: Column, k: int) -> Column:
    """Keep the scores that reach the k-th largest (ties stay), set the others to minus infinity."""
    if k < 1:
        raise ValueError("k must be at least 1")

    def of(v: Column) -> Column:
        cut = F.element_at(F.sort_array(v, asc=False), F.least(F.lit(k), F.size(v)))
        return bind(cut, lambda c: F.transform(v, lambda x: F.when(x < c, F.lit(_BANNED)).otherwise(x)))

    return bind(as_double(scores), of)


def ranked_probs(probs: Column) -> Column:
    """Entries (token, p) by falling probability; equal probabilities by token id."""
    entries = F.transform(probs, lambda p, i: F.struct((-p).alias("key"), i.alias("token"), p.alias("p")))
    return F.transform(F.array_sort(entries), lambda e: F.struct(e["token"].alias("token"), e["p"].alias("p")))


def nucleus(probs: Column, top_p: float) -> Column:
    """The leading entries whose *preceding* probability mass is at most ``top_p``, renormalised.

    The preceding mass never falls along the ranking, so the kept entries are a prefix and counting them is enough.
    """
    ranked = ranked_probs(probs)
    start = F.struct(F.lit(0.0).alias("mass"), F.lit(0).alias("kept"))

    def step(acc: Column, entry: Column) -> Column:
        return F.struct(
            (acc["mass"] + entry["p"]).alias("mass"),
            (acc["kept"] + F.when(acc["mass"] > top_p, 0).otherwise(1)).alias("kept"),
        )

    def cut(entries: Column) -> Column:
        kept = F.slice(entries, F.lit(1), F.aggregate(entries, start, step)["kept"])
        return bind(
            kept,
            lambda k: bind(
                total(F.transform(k, lambda e: e["p"])),
                lambda mass: F.transform(
                    k, lambda e: F.struct(e["token"].alias("token"), (e["p"] / mass).alias("p"))
                ),
            ),
        )

    return bind(ranked, cut)


def draw_uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) fixed by the seed and the keys: the first 52 bits of their md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def sample_entries(entries: Column, uniform: Column) -> Column:
    """Draw a token from (token, p) entries: the first whose running mass exceeds ``uniform``.

    Should rounding leave the mass just below the draw, the last entry with positive probability is taken.
    """
    start = F.struct(F.lit(0.0).alias("mass"), F.lit(-1).alias("token"), F.lit(False).alias("done"))

    def step(acc: Column, entry: Column, limit: Column) -> Column:
        open_ = (~acc["done"]) & (entry["p"] > 0)
        return F.struct(
            (acc["mass"] + entry["p"]).alias("mass"),
            F.when(open_, entry["token"]).otherwise(acc["token"]).alias("token"),
            (acc["done"] | ((entry["p"] > 0) & (acc["mass"] + entry["p"] > limit))).alias("done"),
        )

    return bind(uniform, lambda u: F.aggregate(entries, start, lambda acc, e: step(acc, e, u)))["token"]


def sample_categorical(probs: Column, uniform: Column) -> Column:
    """Draw one token id from a probability vector."""
    entries = F.transform(probs, lambda p, i: F.struct(i.alias("token"), p.alias("p")))
    return sample_entries(entries, uniform)


def greedy(scores: Column) -> Column:
    """Id of the largest score (the first one on ties)."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def decode_step(scores: Column, uniform: Column, temperature: float, top_k: int = 0, top_p: float | None = None) -> Column:
    """Next token of one row.

    Temperature 0 is greedy. Otherwise scores are divided by the temperature, cut to the top k when ``top_k`` > 0, and
    drawn from the nucleus when 0 <= ``top_p`` <= 1; the nucleus draw replaces the plain one.
    """
    if temperature == 0:
        return greedy(as_double(scores))
    kept = top_k_filter(scores, top_k) if top_k > 0 else scores
    probs = softmax(kept, temperature)
    if top_p is not None and 0 <= top_p <= 1:
        return sample_entries(nucleus(probs, top_p), uniform)
    return sample_categorical(probs, uniform)


def truncate_at_end(tokens: Column, prompt_length: Column, end_id: int, echo: bool = False) -> Column:
    """Cut generated tokens after the first end token behind the prompt; ``echo`` keeps the prompt once."""

    def of(g: Column) -> Column:
        all_, prompt = g["tokens"], g["prompt"]
        answer = F.slice(all_, prompt + 1, F.greatest(F.size(all_) - prompt, F.lit(0)))
        cut = bind(
            answer,
            lambda a: F.when(
                F.array_contains(a, end_id), F.slice(a, F.lit(1), F.array_position(a, end_id).cast("int"))
            ).otherwise(a),
        )
        return F.concat(F.slice(all_, F.lit(1), prompt), cut) if echo else cut

    return bind(F.struct(tokens.alias("tokens"), prompt_length.alias("prompt")), of)


def prompt_protect(prompt_token: Column, proposed: Column) -> Column:
    """A proposed token never replaces a prompt token."""
    return F.coalesce(prompt_token, proposed)
