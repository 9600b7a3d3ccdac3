"""Toxicity by weak supervision.

Voters are word stems mined from labelled rows, a few fixed patterns, and how dense all stems together are. A generative
label model learns, by expectation maximisation over labelled and unlabelled texts, how often each voter speaks in
either class, and how far voters repeat each other within a class; a voter that repeats others counts for less. Its
posterior labels train a linear classifier on the voters' measurements, which scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that the models are fitted on: labelled ones, and others. Both are drawn by hash.
LABELLED, UNLABELLED = 16_000, 4_000
STEMS = 96
STEM_LENGTHS = range(3, 11)
MIN_DOCS, MIN_GAIN = 5, 30.0
#: Shares of a text's words from which a stem's voter may speak, the best of which is chosen; those of the density voters.
RATES, DENSITIES = (0.0, 0.004, 0.01), (0.004, 0.008, 0.016)
#: How often a given label is right.
TRUST = 0.97
ROUNDS = 25
PREDICT_AT = 0.3
_NOT_LETTER = re.compile(r"[\W\d_]+")

#: Patterns of insults and shouting.
PATTERNS: list[tuple[str, str]] = [
    ("insult", r"\b(?:idiots?|morons?|imbeciles?|scum|losers?|stupid|pathetic|worthless|disgusting|trash|garbage|clowns?|dumb|shut up)\b"),
    ("you_are", r"\byou(?:'re| are)(?: all| such| nothing but)? (?:an? )?(?:idiot|moron|scum|loser|stupid|pathetic|worthless|disgusting|trash|clown)"),
    ("shouting", r"\b[A-Z]{4,}(?:\W+[A-Z]{3,}){2,}|!{3,}"),
]
_PATTERNS = [(n, re.compile(p, re.IGNORECASE if n != "shouting" else 0)) for n, p in PATTERNS]


def letters(text: str) -> str:
    """Lower-cased words of letters, one blank around each."""
    return " " + _NOT_LETTER.sub(" ", text.lower()).strip() + " "


def stems_of(text: str) -> Counter[str]:
    """Occurrences of every stem: the beginnings of words, and whole words (ending in a blank)."""
    out: Counter[str] = Counter()
    for word, n in Counter(letters(text).split()).items():
        for k in STEM_LENGTHS:
            if k <= len(word):
                out[word[:k]] += n
        out[word + " "] += n
    return out


def gain(a: float, b: float, p: float, n: float) -> float:
    """Likelihood gain of separate rates over a common one: ``a`` of ``p`` against ``b`` of ``n``."""
    def part(k, m, total, all_):
        return k * log(k / m / (total / all_)) if k > 0 else 0.0

    return 2 * (part(a, p, a + b, p + n) + part(b, n, a + b, p + n) + part(p - a, p, p + n - a - b, p + n) + part(n - b, n, p + n - a - b, p + n))


@dataclass
class Model:
    stems: list[str]
    rates: np.ndarray
    strength: np.ndarray
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def __post_init__(self) -> None:
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def hits(self, text: str) -> tuple[np.ndarray, int]:
        if self._automaton is None and self.stems:
            self._automaton = ahocorasick.Automaton()
            for i, s in enumerate(self.stems):
                self._automaton.add_word(" " + s, i)
            self._automaton.make_automaton()
        clean = letters(text)
        found = np.zeros(len(self.stems))
        if self.stems:
            for _, i in self._automaton.iter(clean):
                found[i] += 1
        return found, max(clean.count(" ") - 1, 0)

    def measure(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Votes (0 or 1) and the classifier's features of a text."""
        found, n = self.hits(text)
        rate = found / max(n, 1)
        total, weighted = found.sum() / max(n, 1), float(found @ self.strength) / max(n, 1)
        patterns = np.array([float(bool(p.search(text))) for _, p in _PATTERNS])
        votes = np.concatenate([(found > 0) & (rate >= self.rates), total >= np.array(DENSITIES), patterns])
        features = np.concatenate([np.log1p(500 * rate), [np.log1p(200 * total), np.log1p(200 * weighted), np.log1p(found.sum()), np.log1p(n)], votes[len(rate) :]])
        return votes.astype(float), features

    def score(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.mean) / self.spread) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def label_model(votes: np.ndarray, label: np.ndarray, prior: float) -> np.ndarray:
    """Posterior of class 1 for each row. ``label`` is 0, 1 or nan; it enters as one more voter of known accuracy.

    A voter that does not speak abstains; that none speaks is a vote of its own. Begins with what labelled rows say.
    """
    known = ~np.isnan(label)
    quiet = votes.sum(1) == 0
    given = np.where(known, np.where(label > 0, 1.0, -1.0), 0.0) * log(TRUST / (1 - TRUST))
    post = np.where(known, np.clip(label, 1 - TRUST, TRUST), np.nan)
    if not known.any():
        post = np.where(quiet, prior / 2, 0.5)
    for _ in range(ROUNDS):
        use = ~np.isnan(post)  # in the first round only labelled rows have a class
        q, v, silent = post[use], votes[use], quiet[use]
        n1, n0 = q.sum(), (1 - q).sum()
        p1, p0 = (v.T @ q + 0.5) / (n1 + 1), (v.T @ (1 - q) + 0.5) / (n0 + 1)
        # how far voters repeat each other: correlation of what is left of their votes within the classes
        rest = np.concatenate([(v - p1) * np.sqrt(q)[:, None], (v - p0) * np.sqrt(1 - q)[:, None]])
        size = np.sqrt((rest**2).sum(0)) + 1e-9
        together = np.clip((rest.T @ rest) / np.outer(size, size), 0, 1)
        weight = 1 / np.maximum(together.sum(1), 1)
        none1, none0 = (silent @ q + 0.5) / (n1 + 1), (silent @ (1 - q) + 0.5) / (n0 + 1)
        pi = float(np.clip(q.mean(), 1e-4, 1 - 1e-4))
        z = log(pi / (1 - pi)) + votes @ (weight * np.log(p1 / p0)) + quiet * log(none1 / none0) + given
        post = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return post


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 2.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias that fit soft labels, by Newton steps."""
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x1.shape[1])
    w[-1] = log(max(y.mean(), 1e-4) / max(1 - y.mean(), 1e-4))
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (p * (1 - p) + 1e-6)[:, None]).T @ x1 + np.diag(penalty), x1.T @ (y - p) - penalty * w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def family(text: str) -> int:
    """A number that near copies mostly share: the least hash of three words in a row."""
    words = letters(text).split()
    return min((crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))), default=0)


def mine(labelled: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Stems whose voter speaks in toxic rows rather than others, the rate from which it does, and its log ratio."""
    levels = [f"{c}{i}" for i in range(len(RATES)) for c in "ab"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {c: Counter() for c in levels}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = stems_of(text)
                n = max(len(letters(text).split()), 1)
                for i, rate in enumerate(RATES):
                    mine_ = seen[f"{'a' if toxic else 'b'}{i}"]
                    mine_[""] += 1
                    mine_.update([k for k, c in own.items() if c >= rate * n])
        keys = list(set().union(*seen.values()))
        yield pa.RecordBatch.from_pydict({"stem": pa.array(keys, pa.string())} | {c: pa.array([seen[c][k] for k in keys], pa.int64()) for c in levels})

    table = (
        labelled.select("text", "toxic").mapInArrow(count, "stem string, " + ", ".join(f"{c} long" for c in levels))
        .groupBy("stem").agg(*[F.sum(c).alias(c) for c in levels]).where(f"stem = '' OR a0 >= {MIN_DOCS}").collect()
    )
    all_ = next(((r["a0"], r["b0"]) for r in table if r["stem"] == ""), (0, 0))
    found = []
    for r in table if all_[0] and all_[1] else ():
        if not r["stem"]:
            continue
        g, i = max((gain(r[f"a{i}"], r[f"b{i}"], *all_), -i) for i in range(len(RATES)))
        a, b = r[f"a{-i}"], r[f"b{-i}"]
        if g >= MIN_GAIN and a >= MIN_DOCS and a * all_[1] > 4 * b * all_[0]:
            found.append((-g, -len(r["stem"]), r["stem"], RATES[-i], log((a + 0.5) / all_[0]) - log((b + 0.5) / all_[1])))
    chosen: list[tuple] = []
    for row in sorted(found):
        if len(chosen) < STEMS and not any(row[2].startswith(c[2]) or c[2].startswith(row[2]) for c in chosen):
            chosen.append(row)
    return [c[2] for c in chosen], np.array([c[3] for c in chosen]), np.array([c[4] for c in chosen])


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [family(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(0), batch.column(1)], ["family", "text", "toxic"])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Model:
    """Learn from rows for which ``allowed`` (on the id) holds: about ``LABELLED`` with a label and ``UNLABELLED`` without."""
    turn = F.xxhash64(F.col(id_column), F.lit("toxicity"))
    drawn = (
        labels.where(allowed & F.col(label_column).isin(0, 1)).select(F.col(id_column), F.col(label_column).cast("int").alias("toxic"))
        .groupBy(id_column).agg(F.max("toxic").alias("toxic")).orderBy(turn, id_column).limit(LABELLED)
    )
    texts = docs.where(allowed).select(F.col(id_column), F.col(text_column).cast("string").alias("text")).where("text IS NOT NULL")
    # at most LABELLED rows of an id and a number
    known = texts.join(F.broadcast(drawn), id_column).select("text", "toxic")
    # of near copies one stays, or what they happen to share would pass for toxic
    known = known.mapInArrow(_families, "family long, text string, toxic int").groupBy("family", "toxic").agg(F.min("text").alias("text")).select("text", "toxic").persist()
    stems, rates, strength = mine(known)
    model = Model(stems, rates, strength)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.measure(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v, _ in got], pa.binary()), pa.array([f.tobytes() for _, f in got], pa.binary()), batch.column(1).cast(pa.float64())], ["votes", "features", "label"])

    n = docs.count()
    share = min(1.0, UNLABELLED / n) if n else 0.0
    other = texts.where(F.pmod(F.xxhash64(F.col(id_column), F.lit("unlabelled")), F.lit(1 << 30)) < share * (1 << 30)).select("text", F.lit(None).cast("int").alias("toxic"))
    rows = known.unionByName(other).mapInArrow(measure, "votes binary, features binary, label double").collect()
    known.unpersist()
    width = len(stems) + 4 + len(DENSITIES) + len(_PATTERNS)
    if not rows:
        model.mean, model.spread, model.weights, model.bias = np.zeros(width), np.ones(width), np.zeros(width), -4.0
        return model
    rows.sort(key=lambda r: (bytes(r["features"]), -1 if r["label"] is None else r["label"]))
    votes = np.stack([np.frombuffer(r["votes"]) for r in rows])
    x = np.stack([np.frombuffer(r["features"]) for r in rows])
    label = np.array([np.nan if r["label"] is None else r["label"] for r in rows])
    seen = label[~np.isnan(label)]
    y = label_model(votes, label, float(seen.mean()) if len(seen) else 0.1)
    model.mean, model.spread = x.mean(0), x.std(0) + 1e-3
    model.weights, model.bias = logistic((x - model.mean) / model.spread, y)
    return model


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` (1 from ``PREDICT_AT`` on) of every text, after its id and the columns ``keep``.

    A null or empty text has no hits and gets the score of such a text. Rows are independent: repeated rows, null ids, an
    empty table and clashing names of other columns, which are not read, do not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                s = model.score(np.stack([model.measure(t.as_py() or "")[1] for t in part.column(0)]))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(s), pa.array((s >= PREDICT_AT).astype(np.int32))], [*batch.schema.names[1:], "score", "predicted"])

    narrow = docs.select(F.col(text_column).cast("string").alias("_text"), F.col(id_column), *[c.alias(n) for n, c in (keep or {}).items()])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[1:])
    return narrow.mapInArrow(run, f"{fields}, score double, predicted int")
