"""Removal of lines that many documents repeat, by levelled sorted runs of line hashes.

A run is a table of line keys, bucketed and sorted by key; no key is in two runs. Documents come in batches by falling id.
The keys of a batch are merged against the runs by anti-joins that shuffle nothing, as both sides have the same buckets:
what no run holds becomes a run of its own at level 0 and remembers the batch's largest document, which is the largest of
all because later batches hold smaller ids. What a run holds already is only counted. As soon as a level has ``FANOUT``
runs, they are compacted into one run of the next level, so a key is rewritten a logarithmic number of times.

Keys are 128-bit hashes. A line that a third of all documents hold is one row of its batch after the sum by key, and the
join that hands decisions back to documents is a plain one, whose large partitions the adaptive planner splits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.plans.staging import new_folder, staged

MIN_CHARS, MIN_DOCS = 40, 5
BATCHES, FANOUT = 4, 3
BLANKS = " \t\n\x0b\x0c\r"
#: Rows of an Arrow batch that a task gives out at once.
ROWS = 1 << 15


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """Hash of a line stripped at both ends with A-Z in lower case; None when fewer than ``min_chars`` code points stay."""
    line = line.strip(BLANKS)
    if len(line) < min_chars:
        return None
    return hashlib.blake2b(line.encode().lower(), digest_size=16).digest()  # bytes.lower() changes A-Z only


def _keys(min_chars: int):
    """(id, text) to one row per document and different key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        keys: list[bytes] = []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["id", "key"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                if len(text) < min_chars:
                    continue
                found = {k for line in text.split("\n") if (k := line_key(line, min_chars)) is not None}
                ids += [doc] * len(found)
                keys += found
                while len(ids) >= ROWS:
                    yield rows().slice(0, ROWS)
                    del ids[:ROWS], keys[:ROWS]
        if ids:
            yield rows()

    return run


def _cut(min_chars: int):
    """(id, text, dropped keys or null) to (id, n_lines, n_dropped, kept)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                n_lines, n_dropped, kept = [], [], []
                for text, gone in zip(part.column(1), part.column(2)):
                    text = text.as_py() or ""
                    lines = text.split("\n")
                    if gone.is_valid:
                        out = set(gone.as_py())
                        rest = [x for x in lines if line_key(x, min_chars) not in out]
                        text = "\n".join(rest)
                    else:
                        rest = lines
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(rest))
                    kept.append(text)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())], ["id", "n_lines", "n_dropped", "kept"])

    return run


class LineRuns:
    """Levelled sorted runs of (key, keeper, docs): first document batches that held a key, and how many documents in it.

    ``add`` takes batches in falling order of ids. The tables live in the shared folder under names of their own; ``drop``
    removes them when the results have been written.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.again: list[DataFrame] = []
        self.names: list[str] = []

    def _write(self, df: DataFrame) -> str:
        name = f"tokenloom_lines_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, "key").sortBy("key").option("path", new_folder(self.spark, "run")).saveAsTable(name)
        self.names.append(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, pairs: DataFrame) -> DataFrame:
        """Add a batch of different (id, key) rows; returns the run of its new keys."""
        batch = self._write(pairs.groupBy("key").agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("docs")))
        own = self.spark.table(batch)
        if older := self.runs():
            batch = self._write(reduce(lambda left, run: left.join(run, "key", "left_anti"), older, own))
            self.again.append(staged(own.join(self.spark.table(batch), "key", "left_anti").select("key", "docs"), "again"))
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(batch)
        self._compact()
        return self.spark.table(batch)

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            both = reduce(DataFrame.unionByName, [self.spark.table(name) for name in self.levels[level]])
            merged = self._write(both.groupBy("key").agg(F.max("keeper").alias("keeper"), F.sum("docs").alias("docs")))
            self.levels[level] = []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(merged)

    def frequent(self, min_docs: int) -> DataFrame:
        """(key, keeper) of the keys that at least ``min_docs`` documents hold."""
        every = reduce(DataFrame.unionByName, self.runs())
        if self.again:
            more = reduce(DataFrame.unionByName, self.again).groupBy("key").agg(F.sum("docs").alias("more"))
            every = every.join(more, "key", "left").withColumn("docs", F.col("docs") + F.coalesce("more", F.lit(0)))
        return every.where(F.col("docs") >= min_docs).select("key", "keeper")

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names, self.levels, self.again = [], [], []


def drop_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT, buckets: int | None = None) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept``: texts without the lines that at least ``min_docs`` documents hold.

    A line's key is the line without blanks at both ends, A-Z in lower case. Of a frequent key of at least ``min_chars``
    code points only the lines of the largest ``doc_id`` that holds it stay, all of them where it holds several. Other
    lines stay as they are. A null or empty text has one empty line. Rows that share an id are one document: a key
    that only they hold counts once, and where their id is the largest all of them keep it. A row with a null id is
    no document: it counts for no key and keeps its lines. An empty table gives an empty result; other columns are not
    read. ``batches`` and ``buckets`` change the work, never the result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    known = texts.where("id IS NOT NULL")
    cuts = known.approxQuantile("id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    number = reduce(lambda a, b: a + b, [(F.col("id") <= F.lit(int(c))).cast("int") for c in sorted(set(cuts))], F.lit(0))
    pairs = known.mapInArrow(_keys(min_chars), "id long, key binary")
    if not known.groupBy("id").count().where("count > 1").isEmpty():
        pairs = pairs.distinct()
    place = new_folder(spark, "line-keys")
    pairs.withColumn("batch", number).write.partitionBy("batch").parquet(place)
    pairs = spark.read.schema("id long, key binary, batch int").parquet(place)

    runs = LineRuns(spark, buckets, fanout)
    for b in range(len(set(cuts)) + 1):
        runs.add(pairs.where(F.col("batch") == b).select("id", "key"))
    often = staged(runs.frequent(min_docs), "frequent")
    runs.drop()
    # both joins by shuffle whatever the size, so that the plan is the same for any number of repeated lines
    lost = pairs.join(often.hint("merge"), "key").where("id <> keeper").groupBy("id").agg(F.collect_list("key").alias("keys"))
    lost = staged(lost.select(F.col("id").alias("of"), "keys"), "dropped")
    cut = texts.join(lost.hint("merge"), F.col("id") == F.col("of"), "left").select("id", "text", "keys")
    return cut.mapInArrow(_cut(min_chars), "id long, n_lines long, n_dropped long, kept string").withColumnRenamed("id", "doc_id")


def oracle() -> str:
    """The query's rows in SQL."""
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
    k AS (SELECT *, translate(trim(line, {blanks}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
    j AS (SELECT r, k.doc_id, line, i, coalesce(k.doc_id <> keeper, false) AS gone FROM k LEFT JOIN f USING (key))
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM j GROUP BY r"""
