"""Quality rules as a bitmask ledger.

Each rule is evaluated once per document. The ledger keeps the measurements and one integer whose bit *i* says that rule
*i* failed. A policy is a named, versioned set of rules: applying one, or asking what the corpus would be without one of
its rules, is arithmetic on that integer and never reads a text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import spans as S

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
WINDOW = 5
_SYMBOL = S.byte_table(b"#*$%&|<>")
_NEWLINE = 10

#: Rule name to the condition (SQL over the measures) under which a document fails; the place in the list is its bit.
RULES: list[tuple[str, str]] = [
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("too_many_symbols", "100 * n_symbols > 50 * n_words"),
    ("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    ("word_length_low", "word_chars < 2 * n_words"),
    ("word_length_high", "word_chars > 25 * n_words"),
    ("many_symbols", "100 * n_symbols > 25 * n_words"),
]

#: Policies are never edited; a changed one gets a new version.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("too_few_words", "repeated_windows"),
    "web-1": ("too_few_words", "repeated_windows", "too_many_symbols", "duplicate_lines", "word_length_low", "word_length_high"),
    "web-2": ("too_few_words", "repeated_windows", "many_symbols", "duplicate_lines", "word_length_low", "word_length_high"),
}


def mask(policy: str | tuple[str, ...]) -> int:
    """The bits of a policy's rules."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return sum(bits[n] for n in names)


def _repeats(key: np.ndarray) -> np.ndarray:
    """Flags of the values that occur twice or more."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    flags = np.zeros(len(key), bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return flags


def _measure(part: S.Slice) -> dict[str, np.ndarray]:
    data, rows = part.data, part.rows
    begin, end = S.word_bounds(part, data, S.NOT_SPACE)
    row = part.row_of(begin)
    hashes = S.span_hashes(data, begin, end)

    cover = np.zeros(len(begin) + 1, np.int64)
    at = S.row_windows(row, WINDOW)
    windows = S.window_hashes(hashes, WINDOW)[at] if len(at) else np.zeros(0, np.uint64)
    found = at[_repeats(S.mix(windows + S.mix(row[at].astype(np.uint64))))]
    np.add.at(cover, found, 1)
    np.add.at(cover, found + WINDOW, -1)
    repeated = np.cumsum(cover[:-1]) > 0

    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(S.NOT_SPACE[data], out=filled[1:])
    breaks = np.flatnonzero(data == _NEWLINE)
    starts = np.sort(np.concatenate([part.at[:-1], breaks + 1]))
    owner = np.searchsorted(part.at, starts, side="right") - 1
    stops = np.sort(np.concatenate([part.at[1:], breaks]))
    full = (filled[stops] - filled[starts]) > 0
    starts, stops, owner = starts[full], stops[full], owner[full]
    lines = S.mix(S.span_hashes(data, starts, stops) + S.mix(owner.astype(np.uint64)))
    _, first = np.unique(lines, return_index=True)
    later = np.ones(len(lines), bool)
    later[first] = False

    return {
        "n_words": np.bincount(row, minlength=rows),
        "word_chars": part.per_row(S.NOT_SPACE[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": part.per_row(_SYMBOL[data]),
        "n_lines": np.bincount(owner, minlength=rows),
        "n_dup_lines": np.bincount(owner[later], minlength=rows),
        "n_repeat_words": np.bincount(row[repeated], minlength=rows),
    }


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in S.slices(batch.column(1)):
            ids = batch.column(0).slice(part.first, part.rows)
            got = _measure(part)
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(got[m], pa.int64()) for m in MEASURES]], [batch.schema.names[0], *MEASURES])


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``MEASURES`` and ``fail_bits``.

    A null text counts as empty (all measures 0); repeated rows and null ids give one row each; an empty table gives an
    empty ledger. Other columns of ``docs`` are not read, so their names cannot clash.
    """
    narrow = docs.select(F.col(id_column), F.col(text_column).cast("string"))
    kind = narrow.schema[0].dataType.simpleString()
    measured = narrow.mapInArrow(_measure_batches, f"`{id_column}` {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(0).cast("long") for i, (_, rule) in enumerate(RULES)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("fail_bits", total)


def passes(policy: str, bits: Column | str = "fail_bits") -> Column:
    """Whether none of the policy's rules failed."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """One row per rule of the policy: documents that fail it, that fail nothing else, and that stay without it.

    The ledger is summed once by bit pattern (two to the number of rules at most); everything else is bit arithmetic on
    that small table.
    """
    whole = mask(policy)
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = [(name, 1 << i) for i, (name, _) in enumerate(RULES) if whole >> i & 1]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in rules]))
    apart = patterns.select("bits", "n", each.alias("r")).select("bits", "n", "r.rule", "r.bit")
    rest = F.col("bits").bitwiseAND(F.bitwise_not("bit"))
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    return apart.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        count((F.col("bits").bitwiseAND(F.col("bit")) != 0) & (rest == 0)).alias("failed_alone"),
        count(F.col("bits") == 0).alias("kept"),
        count(rest == 0).alias("kept_without"),
    )
