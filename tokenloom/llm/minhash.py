"""Near-duplicate documents by MinHash.

1. Each document becomes its set of word shingles (64-bit hashes), the minima of ``HASHES`` universal hash functions over
   the set, and a key per band of ``ROWS`` minima. Documents with equal sets are one class from here on.
2. In each band bucket the smallest class is the hub, and every other member is a candidate with it. Candidates are
   verified on their signatures, then on their full sets; links join components by large-star and small-star.
3. Two members of a bucket that both differ from its hub may still be alike. Where a bucket's members are not all
   connected, those outside its largest component are compared with each other and with that component, block by block,
   with the sets at hand; only links leave a task. Members of one component are never compared again.

So no group emits its pairs, and no pair that shares a bucket stays unseen unless its ends are connected anyway. A pair
at the threshold shares no bucket with probability (1 - threshold^ROWS)^BANDS, 1e-6 at 0.85.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import spans as S
from tokenloom.llm.components import components
from tokenloom.plans.staging import staged

WIDTH = 5
THRESHOLD_PERCENT = 85
BANDS, ROWS = 24, 5
HASHES = BANDS * ROWS
#: Members of a bucket that meet in one task, two such blocks at a time.
BLOCK = 128
#: Signatures below the threshold by more than this many standard deviations of the estimate end a candidate.
DEVIATIONS = 5.0

_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(part: S.Slice, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle, ordered by both. Fewer words than ``width`` make one shingle."""
    data = S.LOWER[part.data]
    begin, end = S.word_bounds(part, data, S.NOT_SPACE)
    row = part.row_of(begin)
    words = S.span_hashes(data, begin, end)
    at = S.row_windows(row, width)
    rows, hashes = [row[at]], [S.window_hashes(words, width)[at] if len(at) else np.zeros(0, np.uint64)]
    count = np.bincount(row, minlength=part.rows)
    first = np.cumsum(count) - count
    for r in np.flatnonzero((count > 0) & (count < width)):
        h = count[r : r + 1].astype(np.uint64)
        for at in range(first[r], first[r] + count[r]):
            h = S.mix(h * np.uint64(31) + words[at : at + 1])
        rows.append(np.array([r]))
        hashes.append(h)
    row, value = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def minima(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Signature of each set; ``first`` is where each (non-empty) set begins in ``value``."""
    out = np.empty((HASHES, len(first)), np.uint32)
    for i in range(HASHES):
        out[i] = np.minimum.reduceat(((value * _A[i] + _B[i]) >> np.uint64(32)).astype(np.uint32), first)
    return out.T


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, different between bands."""
    keys = np.empty((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(signature), b + 1, np.uint64)
        for r in range(ROWS):
            h = S.mix(h * np.uint64(0x9E3779B97F4A7C15) + signature[:, b * ROWS + r])
        keys[:, b] = h
    return keys


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in S.slices(batch.column(1)):
            row, value = shingles(part)
            n = np.bincount(row, minlength=part.rows)
            full = np.flatnonzero(n)
            sig, keys = np.zeros((part.rows, HASHES), np.uint32), np.zeros((part.rows, BANDS), np.uint64)
            one, two = np.zeros(part.rows, np.uint64), np.zeros(part.rows, np.uint64)
            if len(full):
                first = (np.cumsum(n) - n)[full]
                sig[full] = minima(value, first)
                keys[full] = band_keys(sig[full])
                one[full] = np.add.reduceat(S.mix(value), first)
                two[full] = np.add.reduceat(S.mix(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (part.rows + 1) * BANDS, BANDS), pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(part.first, part.rows), pa.array(n, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), bands, pa.array([s.tobytes() for s in sig], pa.binary())],
                ["id", "n", "k1", "k2", "bands", "sig"],
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in S.slices(batch.column(1)):
            row, value = shingles(part)
            n = np.bincount(row, minlength=part.rows)
            ends = np.cumsum(n)
            sets = [value[e - k : e].tobytes() for e, k in zip(ends, n)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, part.rows), pa.array(sets, pa.binary())], ["id", "shingles"])


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _possible(percent: int) -> float:
    """Share of equal minima below which a pair is given up."""
    j = percent / 100
    return HASHES * (j - DEVIATIONS * (j * (1 - j) / HASHES) ** 0.5)


def _verify(percent: int):
    least = _possible(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sa, sb, xa, xb = batch.columns
            keep = []
            for i in range(batch.num_rows):
                same = np.frombuffer(sa[i].as_buffer(), np.uint32) == np.frombuffer(sb[i].as_buffer(), np.uint32)
                keep.append(bool(same.sum() >= least and alike(np.frombuffer(xa[i].as_buffer(), np.uint64), np.frombuffer(xb[i].as_buffer(), np.uint64), percent)))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _compare_block(percent: int):
    least = _possible(percent)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left = rows[rows["own"] == rows["i"]]
        right = rows[rows["own"] == rows["j"]]
        inside = rows["i"].iloc[0] == rows["j"].iloc[0]
        key = rows["key"].iloc[0]
        comp = dict(zip(rows["id"], rows["component_id"]))
        root = {c: c for c in comp.values()}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        take = lambda part, column, kind: [np.frombuffer(x, kind) for x in part[column]]
        sl, sr = np.stack(take(left, "sig", np.uint32)) if len(left) else None, np.stack(take(right, "sig", np.uint32)) if len(right) else None
        links = []
        if sl is not None and sr is not None:
            xl, xr = take(left, "shingles", np.uint64), take(right, "shingles", np.uint64)
            bl, br = left["bands"].tolist(), right["bands"].tolist()
            ids_l, ids_r = left["id"].tolist(), right["id"].tolist()
            for p in range(len(left)):
                near = np.flatnonzero((sr == sl[p]).sum(1) >= least)
                for q in near:
                    if inside and q <= p:
                        continue
                    x, y = ids_l[p], ids_r[q]
                    cx, cy = find(comp[x]), find(comp[y])
                    # in the first bucket that the two share, and not if they are connected by now
                    if cx == cy or key != min(set(bl[p]) & set(br[q])):
                        continue
                    if alike(xl[p], xr[q], percent):
                        links.append((x, y))
                        root[max(cx, cy)] = min(cx, cy)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def near_duplicates(docs: DataFrame, percent: int = THRESHOLD_PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``n_shingles, component_id, kept`` of each document, after its id.

    A null text, or one without words, has no shingles and is linked with nothing. Equal texts are linked. Ids are meant
    to be unique: rows that share one count as one document in links, equal ones as a single row. A row with a null id is linked with nothing, its
    component is null and it is not kept. An empty table gives an empty result; other columns are not read.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    signed = staged(texts.mapInArrow(_sign, "id long, n long, k1 long, k2 long, bands array<long>, sig binary"), "minhash")
    known = signed.where("n > 0 AND id IS NOT NULL")
    repeated = not known.groupBy("id").count().where("count > 1").isEmpty()
    if repeated:  # equal rows under one id, or every join by id would multiply them
        known = staged(known.dropDuplicates(["id", "n", "k1", "k2"]), "minhash")
    classes = known.groupBy("n", "k1", "k2").agg(F.min("id").alias("id"))
    reps = known.join(classes.select("id"), "id", "left_semi")
    banded = staged(reps.select("id", "n", F.explode("bands").alias("key")), "bands")
    member = F.struct("id", "n")
    buckets = banded.groupBy("key").agg(
        F.min(member).alias("hub"), F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("id")).alias("f1"), F.sum(F.hash("id")).alias("f2")
    ).where("size > 1")
    buckets = staged(buckets, "buckets")
    fair = 100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n")
    stars = staged(
        banded.join(buckets, "key").where((F.col("id") != F.col("hub.id")) & fair).select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct(),
        "stars",
    )

    # buckets with the same members, as near copies have in many bands, are one from here on
    wide = buckets.where("size > 2").groupBy("size", "f1", "f2").agg(F.min("key").alias("key")).select("key", "size")
    crowd = banded.join(wide, "key").select("key", "size", "id")
    needed = stars.select(F.col("a").alias("id")).union(stars.select("b")).union(crowd.select("id")).distinct()
    sets = staged(texts.join(needed, "id").mapInArrow(_full_sets, "id long, shingles binary"), "sets")
    if repeated:
        sets = staged(sets.dropDuplicates(["id", "shingles"]), "sets")
    sigs = known.select("id", "sig", "bands")
    rich = staged(sets.join(sigs, "id"), "rich")

    side = lambda end: rich.select(F.col("id").alias(end), F.col("sig").alias(f"sig_{end}"), F.col("shingles").alias(f"set_{end}"))
    pairs = stars.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sig_a", "sig_b", "set_a", "set_b")
    links = staged(pairs.mapInArrow(_verify(percent), "a long, b long"), "links")
    joined = staged(components(links), "components")

    member_of = crowd.join(joined, "id", "left").select("key", "size", "id", F.coalesce("component_id", "id").alias("component_id"))
    shares = member_of.groupBy("key", "component_id").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    split = shares.groupBy("key").agg(F.max(F.struct("n", "component_id")).alias("top"), F.first("size").alias("all")).where("top.n < all")
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    outside = F.col("component_id") != F.col("top.component_id")
    few, many = blocks(F.col("all") - F.col("top.n")), blocks(F.col("top.n"))
    hashed = F.xxhash64("id")
    spread = (
        # blocks of the others are numbered first, and every one of them meets every block
        member_of.join(split, "key")
        .withColumn("own", F.when(outside, F.pmod(hashed, few)).otherwise(few + F.pmod(hashed, many)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(outside, few + many).otherwise(few) - 1)))
        .select("key", "id", "component_id", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    more = staged(spread.join(rich, "id").groupBy("key", "i", "j").applyInPandas(_compare_block(percent), "a long, b long"), "links")
    end = lambda column: joined.select(F.col("id").alias(column), F.col("component_id").alias(f"c_{column}"))
    bridges = more.join(end("a"), "a", "left").join(end("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    merged = components(bridges).select(F.col("id").alias("component_id"), F.col("component_id").alias("final"))

    labelled = (
        classes.join(joined, "id", "left")
        .select("n", "k1", "k2", F.coalesce("component_id", "id").alias("component_id"))
        .join(merged, "component_id", "left")
        .select("n", "k1", "k2", F.coalesce("final", "component_id").alias("component_id"))
    )
    return signed.select("id", "n", "k1", "k2").join(labelled, ["n", "k1", "k2"], "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce(F.when(F.col("id").isNotNull(), F.col("component_id")), "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(False)).alias("kept"),
    )
