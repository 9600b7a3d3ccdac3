"""Language identification by nearest centroids.

A text becomes a vector of hashed n-grams of its lower-cased letters, weighted by TF-IDF and of length 1. Each language
has several centroids, found by clustering. A text gets the language of the centroid with the highest cosine, and is
rejected where it lies farther from that centroid than texts of its length that belong there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import spans as S

DIMENSIONS = 4096
ORDERS = (1, 2, 3)
CENTROIDS = 4
#: Labelled texts per language that the centroids are fitted on (about; drawn by hash). Document frequencies use all.
SAMPLE = 400
ROUNDS = 8
#: Cosine below which a text of few, or of many, n-grams is rejected: this share of the 1 % quantile of its like.
REJECT = 0.25
LENGTH_BANDS = (0, 16, 64, 256, 1024)
UNKNOWN = "und"

#: Byte to itself where it is a letter (or belongs to one beyond ASCII), else to a blank.
_CLEAN = np.full(256, 32, np.uint8)
_CLEAN[97:123] = np.arange(97, 123)
_CLEAN[128:] = np.arange(128, 256)


def counts(part: S.Slice) -> np.ndarray:
    """Hashed n-gram counts, one row per text. Blanks in a row count once, so layout has no say."""
    letters = _CLEAN[part.data]
    row = np.repeat(np.arange(part.rows), np.diff(part.at))
    out = np.zeros(part.rows * DIMENSIONS, np.float32)
    if len(letters):
        keep = np.ones(len(letters), bool)
        keep[1:] = (letters[1:] != 32) | (letters[:-1] != 32) | (row[1:] != row[:-1])
        letters, row = letters[keep].astype(np.uint32), row[keep]
        for order in ORDERS:
            n = len(letters) - order + 1
            if n <= 0:
                continue
            key = np.full(n, order, np.uint32)
            for i in range(order):
                key = (key * np.uint32(0x01000193)) ^ (letters[i : i + n] + np.uint32(1))
            key = (key * np.uint32(0x9E3779B1)) >> np.uint32(20)
            # within one text, and not a lone blank
            ok = (row[:n] == row[order - 1 :]) & ((letters[:n] != 32) | (order > 1))
            out += np.bincount(row[:n][ok] * DIMENSIONS + key[ok], minlength=len(out)).astype(np.float32)
    return out.reshape(part.rows, DIMENSIONS)


def _lower(batch: pa.RecordBatch, column: int) -> pa.Array:
    return pc.utf8_lower(batch.column(column).cast(pa.large_string()))


def vectors(part: S.Slice, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors (zero for a text without letters) and the number of n-grams."""
    raw = counts(part)
    size = raw.sum(1)
    weighted = np.log1p(raw) * idf
    norm = np.sqrt((weighted * weighted).sum(1, keepdims=True))
    return np.divide(weighted, norm, out=np.zeros_like(weighted), where=norm > 0), size


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floor: np.ndarray  # per label and length band

    def predict(self, x: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the label, cosine and whether it is too far."""
        if not len(self.labels):
            return np.full(len(x), -1), np.zeros(len(x)), np.ones(len(x), bool)
        cosine = x @ self.centroids.T
        best = cosine.argmax(1)
        label, score = self.owner[best], np.clip(cosine[np.arange(len(x)), best], 0, 1)
        return label, score, score < self.floor[label, bands(size)]


def bands(size: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTH_BANDS, size, side="right") - 1


def cluster(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors: farthest-first seeds, then alternating assignment and means."""
    seeds = [int((x @ x.mean(0)).argmax())]
    near = x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, x @ x[seeds[-1]])
    centers = x[seeds]
    for _ in range(rounds):
        own = (x @ centers.T).argmax(1)
        total = np.stack([x[own == i].sum(0) if (own == i).any() else centers[i] for i in range(len(centers))])
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centers = np.divide(total, norm, out=np.zeros_like(total), where=norm > 0)
    return centers


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> Model:
    """Learn from rows with a label: document frequencies from all of them, centroids from about ``SAMPLE`` per label."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for part in S.slices(_lower(batch, 0), rows=256):
                seen += (counts(part) > 0).sum(0)
                n += part.rows
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"gram": pa.array([-1, *at], pa.int32()), "n": pa.array([n, *seen[at]], pa.int64())})

    known = labelled.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"), F.col(label_column).cast("string").alias("label")).where("text IS NOT NULL AND label IS NOT NULL")
    table = known.select("text").mapInArrow(frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    count = {r["gram"]: r["n"] for r in table}  # a row per dimension
    seen = np.zeros(DIMENSIONS)
    for gram, n in count.items():
        if gram >= 0:
            seen[gram] = n
    idf = (np.log((1 + count.get(-1, 0)) / (1 + seen)) + 1).astype(np.float32)

    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for label, n in totals.items():
        share = F.when(F.col("label") == label, min(1.0, SAMPLE / n)).otherwise(share)
    drawn = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)

    rows = known.where(drawn < share).select("label", "text", "id")

    def sample_rows(batches):
        for batch in batches:
            for part in S.slices(_lower(batch, 1), rows=256):
                x, size = vectors(part, idf)
                cut = lambda i: batch.column(i).slice(part.first, part.rows)
                yield pa.RecordBatch.from_arrays([cut(0), cut(2), pa.array([v.astype(np.float16).tobytes() for v in x], pa.binary()), pa.array(size, pa.float64())], ["label", "id", "x", "size"])

    got = rows.mapInArrow(sample_rows, "label string, id string, x binary, size double").collect() if totals else []
    got.sort(key=lambda r: (r["label"], r["id"] or "", bytes(r["x"])))
    labels = sorted(totals)
    centers, owner, floor = [], [], np.zeros((len(labels), len(LENGTH_BANDS)))
    for i, label in enumerate(labels):
        own = [r for r in got if r["label"] == label and r["size"] > 0]
        if not own:
            continue
        x = np.stack([np.frombuffer(r["x"], np.float16) for r in own]).astype(np.float32)
        c = cluster(x, CENTROIDS)
        centers.append(c)
        owner += [i] * len(c)
        best = (x @ c.T).max(1)
        band = bands(np.array([r["size"] for r in own]))
        for b in range(len(LENGTH_BANDS)):
            like = best[band == b] if (band == b).sum() >= 20 else best[band <= b] if (band <= b).any() else np.zeros(1)
            floor[i, b] = REJECT * np.quantile(like, 0.01)
    matrix = np.concatenate(centers) if centers else np.zeros((0, DIMENSIONS), np.float32)
    return Model(labels if centers else [], idf, matrix, np.array(owner, int), floor)


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected`` of each document, after its id and the columns ``keep``.

    A null text, or one without a letter, is ``und`` with score 0 and rejected; so is every text when there was nothing to
    learn from. Of equal cosines the first label in code point order wins. Rows are independent; other columns are not
    read, so repeated rows, null ids and clashing names do not matter.
    """
    text = F.col(text_column).cast("string")
    narrow = docs.select(F.coalesce(text, F.lit("")).alias("_text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_letters"), F.col(id_column), *[c.alias(n) for n, c in (keep or {}).items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [*batch.schema.names[2:], "lang_pred", "score", "rejected"]
            for part in S.slices(_lower(batch, 0), rows=256):
                label, score, far = model.predict(*vectors(part, model.idf))
                letters = batch.column(1).slice(part.first, part.rows).to_numpy(zero_copy_only=False)
                known = letters & (label >= 0)
                names_of = [model.labels[i] if k else UNKNOWN for i, k in zip(label, known)]
                rest = [c.slice(part.first, part.rows) for c in batch.columns[2:]]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(names_of, pa.string()), pa.array(np.where(known, score, 0.0), pa.float64()), pa.array(far | ~known)], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[2:])
    return narrow.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")


def held_out(id_column: str = "doc_id") -> Column:
    """The fold that nothing is learned from: crc32 of the id as text, modulo 4, is 2. A null id is in no fold."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2
