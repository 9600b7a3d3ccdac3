"""The numbered operators applied to whole tables, and their SQL twins where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import html, language, lattice, licenses, lines, minhash, mixing, negatives, pieces, quality, repeats, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
QUALITY_POLICY = "web-2"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op5_sentencepiece")
def op5(spark, sf_dir):
    return pieces.encode(table(spark, sf_dir, "documents"), PIECE_MODEL, digests=True)


def _quality_sql() -> str:
    bits = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, (_, rule) in enumerate(quality.RULES))
    return rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
    win AS (SELECT r, i, array_to_string(words[i:i+4], ' ') AS win
      FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
    again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM win) WHERE n > 1),
    rep AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
    l AS (SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    ln AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM l GROUP BY r),
    m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
      CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
      FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN ln USING (r)),
    b AS (SELECT *, CAST({bits} AS BIGINT) AS fail_bits FROM m)
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
      fail_bits & {quality.mask(QUALITY_POLICY)} = 0 AS kept FROM b"""


@query("op7_quality_rules", _quality_sql())
def op7(spark, sf_dir):
    book = quality.ledger(table(spark, sf_dir, "documents"))
    base_failed = ~quality.passes("base-1")
    return book.select("*", base_failed.alias("base_failed"), (~base_failed & quality.passes(QUALITY_POLICY)).alias("kept"))


@query("op1_license_scan", licenses.oracle())
def op1(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op10_mixing")
def op10(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_language_id")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fold = F.coalesce(language.held_out(), F.lit(False))
    model = language.fit(docs.where(~language.held_out()))
    return language.predict(docs, model, keep={"held_out": fold})


@query("op3_minhash_dedup")
def op3(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_lattice_dedup")
def op2(spark, sf_dir):
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op9_html_extraction")
def op9(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@query("op6_toxicity")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~language.held_out())
    return toxicity.score(docs, model, keep={"held_out": F.coalesce(language.held_out(), F.lit(False))})


@query("op8_suffix_dedup")
def op8(spark, sf_dir):
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_line_dedup", lines.oracle())
def op11(spark, sf_dir):
    cut = lines.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_whitening")
def op12(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op13_hard_negatives", negatives.oracle())
def op13(spark, sf_dir):
    return negatives.mine(table(spark, sf_dir, "embeddings"), negatives.anchor_rows(), negatives.moved_label())
