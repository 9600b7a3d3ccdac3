"""A corpus pipeline over ``documents``: stages of the numbered operators, each reading what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import language, minhash, mixing, pieces, queries, repeats
from tokenloom.plans.staging import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts and texts without a letter go. ``lang`` stays as it was."""
    model = language.fit(docs.where(~language.held_out()))
    rest = {c: F.col(c) for c in COLUMNS if c != "doc_id"}
    return language.predict(docs, model, keep=rest).where("NOT rejected").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the smallest id. A row without an id cannot be told apart and goes."""
    kept = minhash.near_duplicates(docs).where("kept").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds. A character that lost some of its bytes goes."""
    cut = repeats.remove_repeats(docs, keep=("lang", "source"), as_text=True)
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; documents without words, or not drawn, go."""
    times = mixing.mix(docs).where("copies > 0").select("doc_id", F.col("copies").cast("int").alias("copies"))
    return docs.join(times, "doc_id").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document's copy: number and digest of its ids, and digest of what they decode to."""
    return pieces.encode(docs, queries.PIECE_MODEL, digests=True)


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: SQL cannot state these stages; the tests compare run() with a plain version of each.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
