"""JSON arrays of objects read in pieces, so that a file of any size is shared by many tasks.

The text source splits a file by byte ranges and its records at closing braces, so a value holds what stands between two of
them and never a file. Whether a brace is structure or text depends on all quotes before it: a first pass reduces each
range to what it does to the state (inside a string or not, depth of braces) from either start, the ranges of a file
are composed in order, and a second pass cuts objects knowing the state it starts in. Objects that cross ranges come as
parts and are put together by their position. Files of one range, the usual case, need the second pass only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ESCAPED = re.compile(r"\\.", re.S)
_BETWEEN = re.compile(r"[ \t\r\n]*[\[,]?[ \t\r\n]*")
_END = re.compile(r"[ \t\r\n]*(?:\[[ \t\r\n]*)?\][ \t\r\n]*")


def _opened(piece: str) -> tuple[tuple[int, int], int]:
    """Opening braces outside strings when the piece starts (outside, inside) one, and 1 if an odd number of quotes flips that."""
    parts = (_ESCAPED.sub("", piece) if "\\" in piece else piece).split('"')
    return (sum(p.count("{") for p in parts[::2]), sum(p.count("{") for p in parts[1::2])), (len(parts) - 1) % 2


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces to (shard, block, start, flips, depth, ends): for each start, the state after the range and how often a closing
    brace leads to each depth, relative to the depth before the range."""
    held: dict[tuple[str, int], list] = {}
    for shard, block, piece in _runs(batches):
        opened, flip = _opened(piece)
        for start, at in enumerate(held.setdefault((shard, block), [[0, 0, {}], [1, 0, {}]])):
            at[1] += opened[at[0]]
            at[0] ^= flip
            if at[0] == 0:  # the brace behind the piece closes something
                at[1] -= 1
                at[2][at[1]] = at[2].get(at[1], 0) + 1
    rows = [(shard, block, start, at[0], at[1], [k for k in at[2] if k <= 0], [n for k, n in at[2].items() if k <= 0]) for (shard, block), both in held.items() for start, at in enumerate(both)]
    kinds = pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())
    columns = list(zip(*rows)) or [[]] * len(kinds)
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "block", "start", "inside", "depth", "levels", "ends"])


def _states(effects: DataFrame) -> dict[tuple[str, int], tuple[int, int, int]]:
    """(inside, depth, objects before) at the start of each range of the files that have several; a few numbers a range."""
    ranges: dict[str, dict[int, dict]] = {}
    for r in effects.collect():
        ranges.setdefault(r["shard"], {}).setdefault(r["block"], {})[r["start"]] = r
    out = {}
    for shard, blocks in ranges.items():
        inside = depth = done = 0
        for block in sorted(blocks):
            out[shard, block] = inside, depth, done
            r = blocks[block][inside]
            done += dict(zip(r["levels"], r["ends"])).get(-depth, 0)
            inside, depth = r["inside"], depth + r["depth"]
        if (inside, depth) != (0, -1):  # the closing bracket is taken for a piece with a brace behind it
            raise ValueError(f"{shard}: cut off inside the array")
    return out


def _objects(states):
    """Pieces to (shard, block, doc_pos, whole, last, text): objects, and parts of those that cross ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = states.value
        rows: list[tuple] = []
        now: tuple[str, int] | None = None
        inside = depth = number = 0
        part: list[str] = []
        begun = True  # the object in ``part`` began in this range

        def left_over() -> None:
            text = "}".join(part)
            if depth or inside:  # goes on in the next range
                if not known:
                    raise ValueError(f"{now[0]}: cut off inside an object")
                rows.append((*now, number, False, False, text + "}"))
            elif not (_END.fullmatch(text) or not text and now in known):
                raise ValueError(f"{now[0]}: not an array of objects, at {text[:80]!r}")

        for shard, block, piece in _runs(batches):
            if (shard, block) != now:
                if now:
                    left_over()
                now, part = (shard, block), []
                inside, depth, number = known.get(now, (0, 0, 0))
                if block and now not in known:
                    raise ValueError("the files are split in another way than when the reader was made")
                begun = not (depth or inside)
            if begun and not part and not depth:
                if (at := piece.find("{")) >= 0:
                    if not _BETWEEN.fullmatch(piece[:at]):
                        raise ValueError(f"{shard}: not an array of objects, at {piece[:80]!r}")
                    piece = piece[at:]
            opened, flip = _opened(piece)
            depth += opened[inside]
            inside ^= flip
            part.append(piece)
            if inside == 0:
                if depth == 0:  # the text behind the last object of the file, or a brace too many
                    continue
                depth -= 1
                if depth == 0:
                    rows.append((*now, number, begun, True, "}".join(part) + "}"))
                    number, part, begun = number + 1, [], True
                    if len(rows) >= 1024:
                        yield _batch(rows)
                        rows.clear()
        if now:
            left_over()
        yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 6
    kinds = pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "block", "doc_pos", "whole", "last", "text"])


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, length) of the files below a path; no content is read."""
    return spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("shard"), "length")


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """(shard, doc_pos, text): each object of JSON-array files as text, with its position in its file."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("shard"), F.col("_metadata.file_block_start").alias("block"), "value",
        (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("_split"),
    )
    conf = spark._jsparkSession.sessionState().conf()
    unsplit = min(conf.filesOpenCostInBytes(), conf.filesMaxPartitionBytes())
    states = {}
    if not list_files(spark, path).where(F.col("length") > unsplit).isEmpty():
        cut = pieces.where("_split").drop("_split")
        states = _states(cut.mapInArrow(_effects, "shard string, block long, start int, inside int, depth long, levels array<long>, ends array<long>"))
    shared = spark.sparkContext.broadcast(states)
    rows = pieces.drop("_split").mapInArrow(_objects(shared), "shard string, block long, doc_pos long, whole boolean, last boolean, text string")
    whole = rows.where("whole").select("shard", "doc_pos", "text")
    if not states:
        return whole
    parts = rows.where("NOT whole").groupBy("shard", "doc_pos").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"), F.bool_or("last").alias("ended"))
    cut_off = F.raise_error(F.concat("shard", F.lit(": cut off inside an object")))
    return whole.unionByName(parts.select("shard", "doc_pos", F.when(F.col("ended"), F.array_join("parts.text", "")).otherwise(cut_off).alias("text")))
