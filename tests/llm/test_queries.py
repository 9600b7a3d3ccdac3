"""The numbered queries at the smallest scale: against SQL where it can state them, else against plain versions."""

import duckdb
import numpy as np
import pytest
import sentencepiece

from tests.llm import plain
from tests.llm.conftest import SF
from tests.oracle import compare, duck
from tokenloom.llm.queries import ORACLES, PIECE_MODEL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck(SF).execute(ORACLES[name]).df()
    assert "rows" not in compare(got, want)


def test_pieces(spark, texts):
    got = {r["doc_id"]: r[1:] for r in QUERIES["op5_sentencepiece"](spark, SF).collect()}
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    assert got == {i: plain.pieces(processor, t) for i, t in texts}


def test_near_documents(spark, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op3_minhash_dedup"](spark, SF).collect()}
    assert got == plain.near_documents(texts)


def test_repeats(spark, texts):
    import hashlib

    got = {r["doc_id"]: tuple(r[1:]) for r in QUERIES["op8_suffix_dedup"](spark, SF).collect()}
    assert got == {i: (n, k, s, hashlib.sha256(rest).hexdigest()) for i, (n, k, s, rest) in plain.without_repeats(texts).items()}


def test_vectors(spark):
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in QUERIES["op2_lattice_dedup"](spark, SF).collect()}
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.95).sum(1) - 1
    assert {i: n for i, (n, _) in got.items()} == {i: int(n) for (i, _), n in zip(rows, near)}


def test_language(spark):
    got = QUERIES["op4_language_id"](spark, SF).toPandas()
    lang = duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").df()
    both = got.merge(lang, on="doc_id")
    held = both[both.held_out]
    assert len(got) == len(lang) and len(held) and (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_toxicity(spark):
    sf = SF.replace("0.001", "0.01")
    got = QUERIES["op6_toxicity"](spark, sf).toPandas().merge(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").df(), on="doc_id")
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert got[got.toxic == 0].predicted.mean() < 0.02 and got[got.toxic == 1].predicted.mean() > 0.5


def test_mixing(spark):
    got = QUERIES["op10_mixing"](spark, SF).toPandas().merge(duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").df(), on="doc_id")
    assert (got["size"] == got.text.map(lambda t: len(plain.WORD.findall(t or "")))).all()
    assert (got.taken <= 3 * got["size"]).all() and (got.taken % got["size"].clip(lower=1) == 0).all()
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(by.taken - by.target) <= 0.05 * by.target).all()
    again = QUERIES["op10_mixing"](spark, SF).toPandas()
    assert sorted(map(tuple, again.to_numpy().tolist())) == sorted(map(tuple, got[list(again.columns)].to_numpy().tolist()))


def test_pages(spark):
    import html
    import re

    got = {r["page_id"]: r for r in QUERIES["op9_html_extraction"](spark, SF).collect()}
    rows = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    for i, page in rows:
        article = re.search("<article>(.*?)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert got[i]["text"] == want and got[i]["n_chars"] == len(want)
