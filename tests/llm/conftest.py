import duckdb
import pytest

SF = "/root/testdata/sf0.001"
#: Columns that the operators use inside, as strings that would break them if they were read.
CLASH = {c: "x" for c in ("id", "n", "key", "n_words", "score", "kept", "component_id", "size", "copies", "_text", "held_out", "tokens")}


@pytest.fixture(scope="session")
def texts():
    """doc_id and text of the smallest table."""
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def make(spark):
    """A table of documents, with extra columns whose names clash; rows are (doc_id, text[, lang[, source]])."""

    def table(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or ""), *CLASH.values()) for r in rows]
        kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)
        return spark.createDataFrame(full, kinds)

    return table


EDGE = [
    (1, None), (2, ""), (3, " \t\n"), (4, "word"), (5, "a b c d"), (6, "word"), (6, "word"), (None, "no id here at all, none"),
    (7, "long " * 30_000), (8, "\U0001f600 ünïcode 漢字 　 end"), (9, "=" * 3000), (10, "line\nline\nline\n\nline"),
]


@pytest.fixture(scope="session")
def edge(make):
    """Nulls, empty and very long texts, ties, repeated rows."""
    return make(EDGE)


@pytest.fixture(scope="session")
def nothing(make):
    return make([])
