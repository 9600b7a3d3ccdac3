"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import sentencepiece

from tests.llm import plain
from tests.llm.conftest import EDGE
from tokenloom.llm import html, language, lattice, licenses, minhash, mixing, pieces, quality, repeats, toxicity
from tokenloom.llm.queries import PIECE_MODEL


def by_id(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r[0], []).append(r)
    return out


def test_licenses(edge, nothing, make):
    got = by_id(licenses.scan(edge))
    assert len(got) == 11 and len(got[6]) == 2
    assert got[1][0].n_words == got[2][0].n_words == 0 and got[1][0].labels == "" and got[1][0].first_word is None
    assert got[7][0].n_words == 30_000
    assert licenses.scan(nothing).count() == 0
    rows = [
        (1, "x MIT\nLicense y mit license"), (2, "Licensed under CC BY-NC 4.0."), (3, "Licensed under CC BY 4.0."),
        (4, "the GNU General Public LICENSE"), (5, "submit license"), (6, "mit, license"),
        (7, "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation\nfiles, to deal in the Software without restriction"),
    ]
    got = {r.doc_id: r for r in licenses.scan(make(rows)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (2, 1, 4, "mit")
    assert (got[2].labels, got[2].base_labels, got[2].n_base) == ("cc-by-nc", "", 0) and got[3].labels == "cc-by"
    assert got[4].base_labels == "gpl" and got[5].n_base == 0 and got[6].n_base == 1
    assert got[7].labels == "mit" and got[7].n_base == 0 and got[7].score == 1.0


def test_quality(edge, nothing):
    got = by_id(quality.ledger(edge))
    assert len(got[6]) == 2 and got[1][0].n_words == 0 and got[7][0].n_repeat_words == 30_000
    assert (got[10][0].n_dup_lines, got[10][0].n_lines) == (3, 4)
    assert quality.ledger(nothing).count() == 0


def test_ablations(edge):
    book = quality.ledger(edge).collect()
    got = {r["rule"]: r for r in quality.ablations(quality.ledger(edge), "web-1").collect()}
    whole = quality.mask("web-1")
    assert set(got) == set(quality.POLICIES["web-1"])
    for i, (name, _) in enumerate(quality.RULES):
        if name not in got:
            continue
        bits = [r["fail_bits"] & whole for r in book]
        assert got[name]["failed"] == sum(b >> i & 1 for b in bits)
        assert got[name]["failed_alone"] == sum(b == 1 << i for b in bits)
        assert got[name]["kept"] == sum(b == 0 for b in bits)
        assert got[name]["kept_without"] == sum(b & ~(1 << i) == 0 for b in bits)


def test_pieces(edge, nothing):
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    got = sorted((r[0] or 0, *r[1:]) for r in pieces.encode(edge, PIECE_MODEL, digests=True).collect())
    assert got == sorted((i or 0, *plain.pieces(processor, t)) for i, t in EDGE)
    assert pieces.encode(nothing, PIECE_MODEL).count() == 0
    full = by_id(pieces.encode(edge, PIECE_MODEL))
    assert full[8][0].decoded == EDGE[9][1] and full[2][0].ids == [1, 2]


def test_language(edge, nothing, make):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog are here", "en"), ("der hund und die katze sind hier", "de")] * 20)]
    model = language.fit(make(rows))
    got = by_id(language.predict(edge, model))
    assert got[1][0].lang_pred == got[2][0].lang_pred == got[9][0].lang_pred == "und" and got[9][0].rejected
    assert len(got[6]) == 2 and language.predict(nothing, model).count() == 0
    assert {r.lang_pred for r in language.predict(make([(1, "the dog and the cat"), (2, "die katze und der hund")]), model).collect()} == {"en", "de"}
    untaught = language.predict(edge, language.fit(nothing)).collect()
    assert {r.lang_pred for r in untaught} == {"und"}


def test_toxicity(spark, edge, nothing, make):
    rows = [(i, ("you are a moron and " if i % 3 == 0 else "we met at ") + f"noon {'abc' * (i % 7)} day{i}") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    model = toxicity.fit(make(rows), labels, ~language.held_out())
    got = {r.doc_id: r for r in toxicity.score(make(rows), model).collect()}
    assert all(r.predicted == int(i % 3 == 0) for i, r in got.items())
    out = by_id(toxicity.score(edge, model))
    assert len(out[6]) == 2 and out[1][0].score == out[2][0].score and all(0 <= r[0].score <= 1 for r in out.values())
    assert toxicity.score(nothing, model).count() == 0
    blank = toxicity.fit(nothing, labels.limit(0), ~language.held_out())
    assert all(r.predicted == 0 for r in toxicity.score(edge, blank).collect())


def test_minhash(edge, nothing):
    got = by_id(minhash.near_duplicates(edge))
    want = plain.near_documents([r for r in dict(EDGE).items() if r[0] is not None])
    assert {i: (r[0].n_shingles, r[0].component_id) for i, r in got.items() if i is not None} == want
    assert len(got[6]) == 2 and got[6][0].component_id == 4 and not got[6][0].kept and got[1][0].kept
    assert got[None][0].component_id is None and not got[None][0].kept
    assert minhash.near_duplicates(nothing).count() == 0


def test_lattice(spark):
    nan, inf = float("nan"), float("inf")
    base = [1.0, 2.0, -1.0, 0.5, 3.0, -2.0, 0.25, 1.5]
    rows = [(1, base), (2, [2 * x for x in base]), (3, base), (4, None), (5, [0.0] * 8), (6, [nan] * 8), (7, [inf, *base[1:]]), (8, [None, *base[1:]]), (9, base[:4]), (10, [-x for x in base]), (None, base), (11, [])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, id string, unit string")
    got = {r.vec_id: r for r in lattice.near_duplicates(frame).collect()}
    assert {i: r.n_links for i, r in got.items()} == {1: 2, 2: 2, 3: 2, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0, 9: 0, 10: 0, None: 0, 11: 0}
    assert [got[i].component_id for i in (1, 2, 3, 4, 10)] == [1, 1, 1, 4, 10] and got[1].kept and not got[2].kept and not got[None].kept
    assert lattice.near_duplicates(frame.limit(0)).count() == 0


def test_repeats(edge, nothing):
    got = by_id(repeats.remove_repeats(edge))
    want = plain.without_repeats([r for r in EDGE if r[0] is not None])
    assert {i: (r[0].n_bytes, r[0].n_removed, r[0].n_spans, bytes(r[0].kept)) for i, r in got.items() if i is not None} == want
    assert len(got[6]) == 2 and bytes(got[None][0].kept) == b"no id here at all, none"
    assert repeats.remove_repeats(nothing).count() == 0


def test_pages(spark):
    cases = {
        None: "", "": "", "<b": "<b", "plain &amp; simple\n text": "plain & simple text",
        "<div class=x><p>Just one.</p></div><nav><a href=1>x</a></nav>": "Just one.",
        "<article><p>a&nbsp;b<p>c<br>d</article><footer>f</footer>": "a b\nc d",
        "<article><p>text <script>if (a < b) '</p>'</script>more</p><aside>no</aside><!-- no --></article>": "text more",
    }
    frame = spark.createDataFrame([(i, "u", h, "x") for i, h in enumerate(cases)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html.extract(frame).collect()}
    assert [got[i].text for i in range(len(cases))] == list(cases.values()) and got[3].n_chars == 19
    assert html.extract(frame.limit(0)).count() == 0
    parts = (
        '<html><body><div id="menu"><a href=1>Home</a></div><div class="wrap"><div class=s><p>Long first part of an article, it goes on.</p></div>'
        '<div class=s><p>Second section of it, also long enough.</p></div></div><div class="comments"><p>A reader says a lot of words here, many.</p></div>'
        "<form><p>Name</p><input></form></body></html>"
    )
    assert html.main_text(parts) == "Long first part of an article, it goes on.\nSecond section of it, also long enough."
    assert html.main_text("<p>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_mixing(edge, nothing, make):
    got = by_id(mixing.mix(edge))
    assert len(got[6]) == 2 and got[1][0].taken == 0 and mixing.mix(nothing).count() == 0
    rows = [(i, "w " * (1 + i * i % 37), None, ["b", None, "a", "é"][i % 4]) for i in range(400)]
    out = mixing.mix(make(rows)).toPandas()
    total = out["size"].sum()
    weights = dict(zip(["a", "b", "é", None], [5, 2, 1, 5]))
    for source, part in out.groupby(out.source.where(out.source.notna(), None), dropna=False):
        source = source if isinstance(source, str) else None
        assert abs(part.target.iloc[0] - total * weights[source] / 13) < 1e-6
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 0.02 * part.target.iloc[0]
