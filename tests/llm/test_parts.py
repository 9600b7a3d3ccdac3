"""Helpers against plain versions on random input."""

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import plain
from tokenloom.llm import induced, lattice, minhash, mixing, pieces, repeats
from tokenloom.llm.components import components
from tokenloom.llm.queries import PIECE_MODEL


def plain_suffixes(text):
    ends = np.flatnonzero(text == 0)
    own = lambda i: text[i : ends[np.searchsorted(ends, i)]].tolist()
    order = sorted((i for i in range(len(text)) if text[i]), key=lambda i: ([x + len(text) for x in own(i)] + [int(np.searchsorted(ends, i))],))
    shared = [0]
    for a, b in zip(order, order[1:]):
        x, y = own(a), own(b)
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        shared.append(n)
    return order, shared


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=30), min_size=1, max_size=6), st.sampled_from([1, 300, 1 << 30]), st.sampled_from([3, 1 << 16]))
def test_suffix_array(segments, memory, piece):
    text = np.array([x for s in segments for x in [*s, 0]])
    before, induced.PIECE = induced.PIECE, piece
    try:
        place, shared = induced.suffix_array(text, memory)  # small limits: names by recursion, queues on disk
    finally:
        induced.PIECE = before
    want, common = plain_suffixes(text)
    assert place.tolist() == want and shared.tolist() == common


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=5, max_size=12).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8, unique=True), st.data())
def test_first_documents(segments, data):
    owner = np.array([data.draw(st.integers(0, 9)) for _ in segments])
    got = repeats.first_documents(segments, owner, 5)
    for i, s in enumerate(segments):
        for k in range(len(s) - 4):
            assert got[i][k] == min(o for o, t in zip(owner, segments) if s[k : k + 5] in t)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-(2**62), 2**62) | st.integers(0, 300), max_size=40))
def test_pack(values):
    values = np.array(values, np.int64)
    assert repeats.unpack(repeats.pack(values)).tolist() == values.tolist()
    assert repeats.unpack(repeats.pack(np.sort(values))).tolist() == sorted(values.tolist())


@pytest.fixture(scope="module")
def models():
    return pieces.load(PIECE_MODEL), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def test_encoding(models):
    mine, library = models

    @settings(max_examples=400, deadline=None)
    @given(st.text(max_size=60) | st.lists(st.sampled_from(mine.piece[259:]), max_size=12).map("".join) | st.text("ab e▁\n\té漢<>/s0x1.,-'\U0001f600", max_size=60))
    def check(text):
        text = text.encode("utf-8", "ignore").decode()
        ids = [mine.bos, *[i for c in mine.chunks(text) for i in mine.chunk_ids(c)], mine.eos]
        assert ids == library.encode(text, add_bos=True, add_eos=True)
        assert mine.decode(ids) == library.decode(ids)

    check()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 5000, "=" * 4000, " " * 900, "thethe" * 2000])
def test_long_words(models, text):
    mine, library = models
    assert [i for c in mine.chunks(text) for i in mine.chunk_ids(c)] == library.encode(text)


def test_lattice_points():
    rng = np.random.default_rng(0)
    y = rng.standard_normal((400, 8)) * 2
    point = lattice.nearest_e8(y)
    double = np.rint(2 * point)
    assert (double % 2 == double[:, :1] % 2).all() and (np.rint(point.sum(1)) % 2 == 0).all()
    # no neighbour is nearer
    away = ((y - point) ** 2).sum(1)
    assert all((((y[i] - point[i] - lattice.ROOTS) ** 2).sum(1) >= away[i] - 1e-9).all() for i in range(len(y)))


def test_lattice_recall(spark):
    rng = np.random.default_rng(5)
    u = rng.standard_normal((300, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal((300, 64))
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    c = rng.uniform(0.9502, 0.96, (300, 1))
    v = c * u + np.sqrt(1 - c**2) * w
    groups = [u[0] + 0.02 * k / 8 * rng.standard_normal(64) for k in range(60)]
    rows = [(i, x.tolist()) for i, x in enumerate([*u, *v, *groups])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = plain.near_vectors(rows)
    found, all_ = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert found <= all_ and found >= 0.97 * all_
    assert all(got[i][0] <= want[i][0] for i in want)


def test_minhash_groups(spark, make):
    """Chains, groups of near copies around a common hub, and pairs at the threshold."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], [words[i] for i in rng.integers(0, 400, 120)]
    for k in range(90):  # copies with a few changed words: some alike to each other but not to the smallest
        own = list(base)
        for at in rng.integers(0, 120, k % 6):
            own[at] = words[rng.integers(0, 400)]
        rows.append((k, " ".join(own)))
    chain = list(base[:100])
    for k in range(90, 130):
        chain = chain[1:] + [f"c{k}"]
        rows.append((k, " ".join(chain)))
    rows += [(k, " ".join(words[j] for j in rng.integers(0, 400, 60))) for k in range(130, 200)]
    for block in (48, 4):
        before, minhash.BLOCK = minhash.BLOCK, block
        try:
            got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(make(rows)).collect()}
        finally:
            minhash.BLOCK = before
        assert got == plain.near_documents(rows)


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [tuple(x) for x in rng.integers(200, 260, (40, 2)).tolist()] + [(300, 300)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    links = [(a, b) for a, b in edges if a != b]
    assert got == plain.components({x for link in links for x in link}, links)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12), st.floats(0.1, 3.5))
def test_targets(sizes, share):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    got = mixing.targets([float(s) for s in sizes], weights, share, 3.0)
    assert all(t <= 3 * s + 1e-6 for t, s in zip(got, sizes))
    free = [(t, w) for t, s, w in zip(got, sizes, weights) if s and t < 3 * s - 1e-6]
    if free:
        assert abs(sum(got) - share * sum(sizes)) < 1e-6 * max(1, sum(sizes))
        assert max(t / w for t, w in free) - min(t / w for t, w in free) < 1e-6 * max(1, sum(sizes))


def test_flight_keeps_sums():
    rng = np.random.default_rng(2)
    size = np.sort(rng.integers(1, 5000, 500))[::-1]
    chance = np.full(500, 0.37)
    p = mixing.flight(size, chance, rng)
    assert ((p > 0) & (p < 1)).sum() <= 3 and abs(p.sum() - chance.sum()) < 1e-6 and abs((p * size).sum() - (chance * size).sum()) < 1e-3
    many = np.mean([mixing.flight(size, chance, np.random.default_rng(i)) for i in range(200)], axis=0)
    assert abs(many.mean() - 0.37) < 0.01 and many[:50].mean() > 0.2 and many[-50:].mean() > 0.2
