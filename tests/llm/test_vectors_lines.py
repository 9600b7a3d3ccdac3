"""Line dedup, whitening and hard negatives against plain versions, with the edge cases their docstrings name."""

import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from tests.llm.conftest import EDGE, SF
from tests.llm.plain import LOWER
from tokenloom.llm import lines, negatives, whitening
from tokenloom.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, id string, z string, vector string, score string, rank string"
CLASH = ("x",) * 5


@pytest.fixture(scope="session")
def vectors(spark):
    return lambda rows: spark.createDataFrame([(*r, *CLASH) for r in rows], VECTORS)


# ---- lines


def plain_lines(docs, min_docs=5, min_chars=40):
    """Sorted (doc_id, lines, dropped, kept) rows."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in docs:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if i is None or len(h := holders.get(key(x), ())) < min_docs or max(h) == i]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got_lines(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect()), key=str)


LONG = "This line is long enough to count as a line of forty characters"


@pytest.mark.parametrize("batches,fanout", [(1, 3), (5, 2)])
def test_lines_random(make, batches, fanout):
    rng = random.Random(batches)
    pool = [f"{LONG} {i}" for i in range(30)] + [f"\t{LONG.upper()} {i} \r" for i in range(30)] + ["short", "", "  ", "ü" * 39, "ü" * 40, "Ü" * 40, "é" * 80]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for i in range(-20, 80)]
    docs += [(3, docs[25][1]), (79, "\n".join(pool)), (79, "\n".join(pool)), (None, "\n".join(pool))]
    assert got_lines(lines.drop_repeated_lines(make(docs), batches=batches, fanout=fanout, buckets=5)) == plain_lines(docs)


def test_lines_edges(make, edge, nothing):
    assert got_lines(lines.drop_repeated_lines(edge)) == plain_lines(EDGE)
    assert lines.drop_repeated_lines(nothing).collect() == []
    # forty code points of many bytes count, thirty-nine do not; blanks of Unicode are no blanks
    at = [(i, "漢" * 40 + "\n" + "漢" * 39 + "\n　" + "漢" * 39) for i in range(6)]
    assert [r[2] for r in got_lines(lines.drop_repeated_lines(make(at)))] == [2] * 5 + [0]
    # four documents are too few, however often the line stands
    few = [(i % 4, f"{LONG}\n{LONG}") for i in range(40)]
    assert {r[2] for r in got_lines(lines.drop_repeated_lines(make(few)))} == {0}
    # a very long text whose lines all go
    text = "\n".join(f"{LONG} {i}" for i in range(5000))
    rows = got_lines(lines.drop_repeated_lines(make([(i, text) for i in range(5)])))
    assert rows == [(i, 5000, 5000, "") for i in range(4)] + [(4, 5000, 0, text)]


def test_runs_are_disjoint_and_levelled(spark):
    runs = lines.LineRuns(spark, buckets=4, fanout=2)
    for b in range(5):
        keys = [bytes([k]) * 16 for k in range(b, b + 3)]
        runs.add(spark.createDataFrame([(100 - 10 * b - j, k) for k in keys for j in range(2)], "id long, key binary"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [r["key"] for run in runs.runs() for r in run.collect()]
    assert len(held) == len(set(held)) == 7
    plan = runs.runs()[0].join(runs.runs()[1], "key", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan  # both sides have the same buckets
    assert {(bytes(r["key"])[0], r["keeper"]) for r in runs.frequent(5).collect()} == {(2, 100), (3, 90), (4, 80)}
    runs.drop()


# ---- whitening


def check_whitening(rows, got, scale=64):
    """Rows of (id, vector) of one length against numpy and Python's whole numbers."""
    good = [(i, [math.floor(scale * float(c)) + 1_000_000 for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in good})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    far = np.array([[n * x[j] - sums[j] for j in range(d)] for x in fit], float) / n
    cov = far.T @ far / n
    value = np.linalg.eigvalsh(cov)[::-1]
    k = min(16, d)
    want = sorted((i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in good for c in range(k))
    assert sorted((r["vec_id"], r["component"], r["n"], r["deviation"]) for r in got) == want
    assert len({r["identity_error"] for r in got}) <= 1 and all(r["identity_error"] < 1e-6 for r in got)
    for r in got:
        assert r["explained"] == pytest.approx(value[r["component"] - 1] / np.trace(cov), rel=1e-6, abs=1e-12)
    # whitened values: of distinct rows the covariance is the identity, and they are projections on eigenvectors of cov
    by_id = defaultdict(dict)
    for r in got:
        by_id[r["vec_id"]][r["component"]] = r["whitened"]
    x = {i: np.array([n * a - s for a, s in zip(v, sums)], float) / n for i, v in good}
    ids = sorted(by_id)
    w = np.array([[by_id[i][c + 1] for c in range(k)] for i in ids])
    a = np.array([x[i] for i in ids])
    vectors = np.linalg.lstsq(a, w, rcond=None)[0]  # whitened = a @ vectors
    assert np.abs(a @ vectors - w).max() < 1e-6
    assert np.abs(vectors.T @ cov @ vectors - np.eye(k)).max() < 1e-6
    assert np.abs(cov @ vectors - vectors * value[:k]).max() < 1e-6 * value[0]


def test_whitening_query(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' WHERE embedding IS NOT NULL").fetchall()
    check_whitening(rows, QUERIES["op12_whitening"](spark, SF).collect())


def test_whitening_repeats_and_edges(spark, vectors):
    rng = np.random.default_rng(5)
    good = [(i, (rng.standard_normal(6) * [1, 5, 0.5, 2, 3, 1]).astype(np.float32).tolist(), 0) for i in range(200)]
    good += [(1000 + i, good[0][1], 0) for i in range(300)]  # one vector holds over half of the rows
    bad = [(1, None, 0), (2, [], 0), (3, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (4, [float("nan")] * 6, 0), (5, [float("inf")] + [0.0] * 5, 0), (6, [3e38] * 6, 0)]
    df = vectors(good + bad)
    got = whitening.whiten(df).collect()
    check_whitening([r[:2] for r in good], got)
    assert whitening.whiten(vectors([])).collect() == [] and whitening.whiten(vectors(bad)).collect() == []
    # repeated rows come as often as they stand, rows without an id too; a length of its own is whitened by itself
    mixed = whitening.whiten(vectors([*good, good[0], (None, good[1][1], 0), (7777, [1.0, 2.0], 0), (7778, [2.0, 2.0], 0)])).collect()
    assert sum(r["vec_id"] == 0 for r in mixed) == 12 and sum(r["vec_id"] is None for r in mixed) == 6
    short = sorted((r["component"], r["vec_id"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in mixed if r["vec_id"] in (7777, 7778))
    assert [(c, n, dev, abs(w) if w is not None else None, e) for c, _, n, dev, w, e in short] == [(1, 2, 64 * 64, 1.0, 1.0)] * 2 + [(2, 2, 64 * 64, None, 0.0)] * 2
    single = whitening.whiten(vectors([(1, [1.0, 2.0], 0)])).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in single] == [(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]


@pytest.mark.parametrize("spread", [1, 300, 1 << 20, 1 << 40, 1 << 59])
def test_cross_products(spread):
    rng = np.random.default_rng(3)
    z = rng.integers(-spread, spread + 1, (130, 5)) + (spread // 3)
    exact = z.astype(object)
    sums, products = whitening.cross_products(z)
    assert (sums == exact.sum(0)).all() and (products == exact.T @ exact).all()


def test_bit_planes():
    y = np.arange(200).reshape(100, 2)
    planes = whitening.bit_planes(y)
    assert len(planes) == 8 and planes[0].shape == (2, 2)
    assert [int(np.bitwise_count(p).sum()) for p in planes] == [sum(v >> b & 1 for v in range(200)) for b in range(8)]


# ---- hard negatives


def plain_negatives(rows, every=50, scale=256):
    one = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        z = [math.floor(scale * c) for c in v]
        if max(map(abs, z)) <= 1 << 24:
            one[i] = min(one.get(i, (label, z)), (label, z))
    out = []
    for a, (label, z) in one.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(z, zz)), i, ll) for i, (ll, zz) in one.items() if i != a and len(zz) == len(z))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            window = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(window, 1)]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r) for r in negatives.mine(df, negatives.anchor_rows(), **more).collect())


def test_negatives_random(vectors):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((6, 8))
    rows = []
    for i in range(1200):  # a third of all rows has one label, and scores tie often
        label = 0 if i % 3 == 0 else int(rng.integers(1, 5))
        x = centres[rng.integers(6)] + 0.4 * rng.standard_normal(8)
        rows.append((i - 100, (np.round(x * 4) / 64).astype(np.float32).tolist(), label))
    rows += [(i, rows[i][1], rows[i][2] + 1) for i in range(5)]
    want = plain_negatives(rows)
    assert len(want) > 100 and mined(vectors(rows)) == want
    assert mined(vectors(rows), pass_anchors=7) == want  # several passes


def test_negatives_edges(vectors):
    one = [1.0, 0.0]
    assert mined(vectors([])) == [] and mined(vectors([(50, one, 1)])) == []
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.95, 0.0], 2), (3, [0.5, 0.0], 2), (4, [0.95, 0.0], 3), (5, [0.96, 0.0], 3), (6, [0.49, 0.0], 3)]
    rows += [(7, None, 2), (8, [0.9, None], 2), (9, [float("nan"), 0.0], 2), (10, [0.9, 0.0], None), (None, [0.9, 0.0], 2), (11, [0.9, 0.0, 0.0], 2), (12, [1e30, 0.0], 2), (13, [], 2)]
    rows += [(100, [-1.0, 0.0], 1), (150, [0.0, 0.0], 1), (200, [0.0, 0.0, 1.0], 2)]
    got = mined(vectors(rows))
    assert got == plain_negatives(rows) and [r[:4] for r in got if r[0] == 0 and r[1] == 1] == [(0, 1, 1, 2), (0, 1, 2, 4), (0, 1, 3, 3)]


def test_tree_spares_work():
    """Near anchors share their candidates' bounds: few candidates are scored again, and none in the window is missed."""
    rng = np.random.default_rng(1)
    base = rng.integers(-200, 200, 16)
    anchors = base + rng.integers(-2, 3, (64, 16))
    rows = rng.integers(-200, 200, (2000, 16))
    tree = negatives.AnchorTree(np.arange(64), np.zeros(64, int), anchors)
    block = negatives.Candidates(tree, np.arange(2000), np.zeros(2000, int), rows)
    for i in range(64):
        exact = rows @ tree.z[i]
        low = np.sort(exact)[-20]
        at, scores = block.at(i, low, np.inf)
        assert (scores == exact[at]).all() and set(np.flatnonzero(exact >= low)) <= set(at.tolist())
    assert block.scored < 0.2 * 64 * 2000 and not block.held
