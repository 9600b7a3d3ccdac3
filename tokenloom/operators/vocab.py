"""Subword vocabulary: counting, training by pair merges, encoding and decoding.

The corpus is scanned once for word counts. Training then works on the table of distinct words, encoding on the rows as
they are. The driver only ever sees the best pairs of a round and the finished vocabulary, both bounded by parameters.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from heapq import heapify, heappop, heappush, nsmallest
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import BOS_ID, BYTE_OFFSET, EOS_ID, UNK_ID, add_bos_eos
from tokenloom.plans.lookups import lookup
from tokenloom.plans.session import spread_small
from tokenloom.plans.staging import staged

# The visible space, the number of byte pieces, the displayed forms of the two border tokens.
SPACE = "▁"
BYTE_PIECES = 256
BOS_DISPLAY = "\n<s>\n"
EOS_DISPLAY = "\n</s>\n"

FIRST_FREE_ID = BYTE_OFFSET + BYTE_PIECES
OPEN, CLOSE = "\x01", "\x02"
VOCAB_SCHEMA = "id INT, piece STRING, score FLOAT, kind STRING"
MERGE_SCHEMA = "rank INT, left STRING, right STRING"

# A word is one digit, or a run without spaces and digits with all the spaces before it, so pieces of spaces alone can be
# learned. Line ends and the symbol delimiters stand alone: they are never part of a learned piece and become bytes.
WORD = rf"[\n\x01\x02]|[0-9０-９]|{SPACE}*[^{SPACE}0-9０-９\n\x01\x02]+|{SPACE}+"
SPACES = f"{SPACE}+"
ALONE = r"([0-9０-９\n])"
#: What makes more than one word of a text without spaces.
APART = r"[0-9０-９\n\x01\x02]"

CANDIDATES_PER_ROUND = 256
#: Different words, or parts of texts between spaces, that a task holds.
WORDS_HELD = 1 << 18
#: Pairs whose counts the driver is told at a snapshot, and merges between two snapshots.
PAIRS_LISTED = 8192
MERGES_PER_STAGE = 256
#: Words in training: a character for each symbol, the first for the most frequent character.
CODED_SCHEMA = "codes string, cnt long"
PAIR_SCHEMA = "left string, right string, cnt long"
FIRST_CODE = 0x20
#: Ways to write a piece in symbols of a snapshot that a round looks for; of more, it looks for the two symbols at the border.
SPELLINGS = 16


def _split_words(marked: Column) -> Column:
    """Cut a marked text into words.

    One replacement puts a delimiter around the characters that stand alone and the text is split at it, which is
    several times faster than matching every word. Texts that contain a delimiter themselves take the slow way.
    """
    at_spaces = F.regexp_replace(marked, SPACES, f"{OPEN}$0")
    around = F.regexp_replace(at_spaces, ALONE, f"{OPEN}$1{OPEN}")
    quick = F.filter(F.split(around, OPEN), lambda w: w != "")
    return F.when(
        F.contains(marked, F.lit(OPEN)) | F.contains(marked, F.lit(CLOSE)),
        F.regexp_extract_all(marked, F.lit(WORD), F.lit(0)),
    ).otherwise(quick)


def words_of(text: Column) -> Column:
    """Words of a text, spaces shown as a leading mark; together they spell the whole text."""
    marked = F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE)))
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(_split_words(marked))


def training_words_of(text: Column) -> Column:
    """Words of a training text: every line starts afresh with a space mark, line ends are dropped."""
    marked = F.replace(F.replace(text, F.lit(" "), F.lit(SPACE)), F.lit("\n"), F.lit("\n" + SPACE))
    kept = F.filter(_split_words(F.concat(F.lit(SPACE), marked)), lambda w: ~w.isin("\n", OPEN, CLOSE))
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(kept)


def _cut(training: bool):
    """Texts to the (word, cnt) of a task, handed on whenever it holds many: the words of ``words_of`` or ``training_words_of``.

    Where single spaces part the words, what lies between two spaces is counted as it stands and cut once.
    """
    line = "\n" + SPACE if training else "\n"
    dropped = {"\n", OPEN, CLOSE} if training else set()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, apart, counts, between = re.compile(WORD), re.compile(APART).search, Counter(), Counter()

        def words(text: str) -> Iterator[str]:
            marked = SPACE + text.replace(" ", SPACE).replace("\n", line)
            return (w for m in word.finditer(marked) if (w := m.group()) not in dropped)

        def handed_on() -> pa.RecordBatch:
            for text, n in between.items():
                if apart(text):
                    for w in words(text):
                        counts[w] += n
                else:
                    counts[SPACE + text] += n
            out = pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], ["word", "cnt"])
            between.clear()
            counts.clear()
            return out

        for batch in batches:
            for value in batch.column(0):
                text = value.as_py()
                if not text:
                    continue
                if text[0] == " " or "  " in text or "\n " in text or SPACE in text:
                    counts.update(words(text))
                else:
                    between.update(text.split(" "))
                if len(counts) + len(between) >= WORDS_HELD:
                    yield handed_on()
        yield handed_on()

    return run


def word_counts(docs: DataFrame, training: bool = True) -> DataFrame:
    """Distinct words and how often they occur; a task counts its own words before any moves."""
    counted = docs.select(F.make_valid_utf8("text").alias("text")).mapInArrow(_cut(training), "word string, cnt long")
    return counted.groupBy("word").agg(F.sum("cnt").alias("cnt"))


def char_inventory(words: DataFrame, coverage: float = 1.0) -> DataFrame:
    """Character frequencies; the most frequent characters are ``kept`` until they cover the wanted share.

    The unpartitioned window sees one row per distinct character, at most the size of Unicode.
    """
    chars = (
        words.select(F.explode(F.split("word", "")).alias("ch"), "cnt")
        .groupBy("ch")
        .agg(F.sum("cnt").alias("cnt"))
    )
    ranked = Window.orderBy(F.desc("cnt"), "ch")
    before = F.coalesce(
        F.sum("cnt").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    mass = F.sum("cnt").over(Window.partitionBy())
    return chars.select("ch", "cnt", (before < mass * F.lit(coverage)).alias("kept"))


def with_symbols(words: DataFrame) -> DataFrame:
    """Start state of training: every character is a symbol, wrapped in an opening and a closing control character."""
    wrapped = F.transform(F.split("word", ""), lambda c: F.concat(F.lit(OPEN), c, F.lit(CLOSE)))
    return words.select("word", "cnt", F.array_join(wrapped, "").alias("symbols"))


def symbol_list(symbols: Column) -> Column:
    """The symbols of a word as an array."""
    return F.split(F.substring(symbols, F.lit(2), F.length(symbols) - 2), CLOSE + OPEN)


def _adjacent() -> Column:
    """Adjacent symbols of the array ``_list``."""
    return F.zip_with(
        F.slice("_list", F.lit(1), F.size("_list") - 1),
        F.slice("_list", F.lit(2), F.size("_list") - 1),
        lambda a, b: F.struct(a.alias("left"), b.alias("right")),
    )


def pair_counts(words: DataFrame) -> DataFrame:
    """Weighted counts of adjacent symbols."""
    symbols, pairs = symbol_list(F.col("symbols")), _adjacent()
    return (
        words.where(F.contains("symbols", F.lit(CLOSE + OPEN)))
        .select(symbols.alias("_list"), "cnt")
        .select(F.explode(pairs).alias("pair"), "cnt")
        .groupBy("pair.left", "pair.right")
        .agg(F.sum("cnt").alias("cnt"))
    )


def merged_symbols(symbols: Column, left: str, right: str) -> Column:
    """Merge every occurrence of (left, right), left to right, without overlap.

    No two symbols share a delimiter, so a plain text replacement finds exactly the whole-symbol pairs.
    """
    pair = OPEN + left + CLOSE + OPEN + right + CLOSE
    return F.replace(symbols, F.lit(pair), F.lit(OPEN + left + right + CLOSE))


def bpe_step(words: DataFrame, left: str, right: str) -> DataFrame:
    """One merge over the word table."""
    return words.withColumn("symbols", merged_symbols(F.col("symbols"), left, right))


def _in_order(pairs: DataFrame) -> DataFrame:
    """Most frequent pairs first; on ties the shorter merged piece first, then text order."""
    return pairs.withColumn("merged", F.concat("left", "right")).orderBy(F.desc("cnt"), F.length("merged"), "merged", "left")


def _rank(pair: tuple[str, str], count: int) -> tuple:
    """The same order for pairs that the driver holds: text order is that of code points on both sides."""
    return -count, len(pair[0]) + len(pair[1]), pair[0] + pair[1], pair[0]


def best_pairs(words: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent pairs; on ties the shorter merged piece first, then text order."""
    return _in_order(pair_counts(words)).limit(n)


def _independent(ranked: list[tuple[tuple[str, str], int]], floor: int, known: set[str], room: int) -> list[tuple[str, str]]:
    """Longest prefix of the ranked (pair, count) that one-at-a-time training would also pick next, in the same order.

    A pair may follow in the same round only if (i) no accepted pair can take an occurrence from it, and (ii) it is
    strictly more frequent than every pair an accepted merge can create. A new pair (ab, x) or (x, ab) occurs at most
    as often as (b, x) or (x, a); pairs that are not ranked occur ``floor`` times at most. A merge that spells a known
    piece ends the round, because it adds to the counts of existing pairs.
    """
    after: dict[str, int] = {}
    before: dict[str, int] = {}
    for (left, right), count in ranked:
        after[left], before[right] = max(after.get(left, floor), count), max(before.get(right, floor), count)
    chosen: list[tuple[str, str]] = []
    created, fresh = 0, 0
    for (left, right), count in ranked:
        if chosen and (count <= created or any(right == a or left == b for a, b in chosen)):
            break
        chosen.append((left, right))
        if left + right in known:
            break
        known.add(left + right)
        fresh += 1
        if fresh == room:
            break
        created = max(created, min(count, after.get(right, floor)), min(count, before.get(left, floor)))
    return chosen


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with ids and scores, and the merges in training order. Both tables are bounded by the vocabulary size."""

    vocab: DataFrame
    merges: DataFrame


def _vocabulary(spark: SparkSession, merges: list[tuple[str, str]], chars: list[str]) -> Vocabulary:
    rows = [(UNK_ID, "<unk>", 0.0, "unk"), (BOS_ID, "<s>", 0.0, "bos"), (EOS_ID, "</s>", 0.0, "eos")]
    rows += [(BYTE_OFFSET + b, f"<0x{b:02X}>", 0.0, "byte") for b in range(BYTE_PIECES)]
    seen = set(chars)
    learned = []
    for left, right in merges:
        if left + right not in seen:
            seen.add(left + right)
            learned.append((left + right, "merge"))
    for i, (piece, kind) in enumerate(learned + [(c, "char") for c in chars]):
        rows.append((FIRST_FREE_ID + i, piece, float(-i), kind))
    ranked = [(i, left, right) for i, (left, right) in enumerate(merges)]
    return Vocabulary(spark.createDataFrame(rows, VOCAB_SCHEMA), spark.createDataFrame(ranked, MERGE_SCHEMA))


class _Codes:
    """Symbols as single characters: a merge is a plain replacement, and a word takes as many characters as it has symbols.

    No symbol is the line end, which parts words that are handled together.
    """

    def __init__(self, symbols: list[str]) -> None:
        self.of: dict[str, str] = {}
        for symbol in symbols:
            self.add(symbol)

    def add(self, symbol: str) -> None:
        if symbol not in self.of:
            point = FIRST_CODE + len(self.of)
            # surrogates are no characters
            self.of[symbol] = chr(point if point < 0xD800 else point + 0x800)

    def replaced(self, merges: list[tuple[str, str]]) -> list[tuple[str, str]]:
        """What a merge replaces in a word, and by what."""
        return [(self.of[a] + self.of[b], self.of[a + b]) for a, b in merges]

    def symbols(self) -> dict[int, str]:
        return {ord(code): symbol for symbol, code in self.of.items()}


def _coded(words: DataFrame, codes: _Codes) -> DataFrame:
    """(codes, cnt) of the words of two symbols or more: every character is a symbol."""
    table = {ord(c): code for c, code in codes.of.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [w.translate(table) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column(1)], ["codes", "cnt"])

    held = words.where(F.length("word") > 1).select("word", F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt"))
    return held.mapInArrow(run, CODED_SCHEMA)


def _replay(patterns: list[tuple[str, str]]):
    """(codes, cnt) with the merges applied in their order, to the words of a batch at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = _replaced("\n".join(batch.column(0).to_pylist()), patterns).split("\n")
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column(1)], ["codes", "cnt"])

    return run


def _replaced(lines: str, patterns: list[tuple[str, str]]) -> str:
    for old, new in patterns:
        lines = lines.replace(old, new)
    return lines


class _PairTotals:
    """Weighted counts of adjacent codes in words, one a line."""

    def __init__(self) -> None:
        self.of: dict[int, int] = {}

    def add(self, lines: str, cnt: np.ndarray) -> None:
        points = np.frombuffer(lines.encode("utf-32-le"), "<u4").astype(np.int64)
        ends = points == ord("\n")
        inside = np.flatnonzero(~(ends[:-1] | ends[1:]))
        which, pairs = pd.factorize(points[inside] << 32 | points[inside + 1])
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, which, cnt[np.cumsum(ends)[inside]])
        for pair, n in zip(pairs.tolist(), sums.tolist()):
            self.of[pair] = self.of.get(pair, 0) + n

    def rows(self, symbols: dict[int, str], first: Sequence[tuple] = ()) -> pa.RecordBatch:
        """(left, right, cnt) of the counts that are not 0, behind the rows ``first``."""
        rows = [*first, *((symbols[p >> 32], symbols[p & 0xFFFFFFFF], n) for p, n in self.of.items() if n)]
        kinds = pa.string(), pa.string(), pa.int64()
        columns = list(zip(*rows)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["left", "right", "cnt"])


def _totals(symbols: dict[int, str]):
    """Words to the counts of their pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = _PairTotals()
        for batch in batches:
            if batch.num_rows:
                totals.add("\n".join(batch.column(0).to_pylist()), batch.column(1).to_numpy())
        yield totals.rows(symbols)

    return run


def _differences(pending: list[tuple[str, str]], merges: list[tuple[str, str]], symbols: dict[int, str]):
    """Words to what ``merges`` change in pair counts, after the ``pending`` ones; a row (NULL, NULL, n) tells the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, looked = _PairTotals(), 0
        for batch in batches:
            if batch.num_rows:
                looked += batch.num_rows
                lines, cnt = _replaced("\n".join(batch.column(0).to_pylist()), pending), batch.column(1).to_numpy()
                totals.add(lines, -cnt)
                totals.add(_replaced(lines, merges), cnt)
        yield totals.rows(symbols, [(None, None, looked)])

    return run


class _Snapshot:
    """The words as they were after some merges, and the counts of the best pairs, kept up to date.

    The driver knows the counts of ``listed`` pairs at the snapshot and of all pairs that later merges made: a merge changes
    only pairs of its own symbols with others, 4 x vocabulary at most. A pair it does not know occurs ``ceiling`` times at most.
    """

    def __init__(self, words: DataFrame, codes: _Codes, listed: int) -> None:
        self.words, self.codes, self.pending = words, codes, []
        counts = words.mapInArrow(_totals(codes.symbols()), PAIR_SCHEMA).groupBy("left", "right").agg(F.sum("cnt").alias("cnt"))
        rows = _in_order(counts).limit(listed).collect()
        self.counts = {(r["left"], r["right"]): r["cnt"] for r in rows}
        self.ceiling = self.listed_floor = 0 if len(rows) < listed else rows[-1]["cnt"]
        self.made: set[str] = set()
        self.grown: dict[tuple[str, str], int] = {}
        self.first: dict[str, set[str]] = {}
        self.last: dict[str, set[str]] = {}
        self.ways: dict[str, set[str]] = {}

    def _spelled(self, left: str, right: str) -> set[str]:
        """Ways to write two symbols side by side in codes of the snapshot; none if there are more than ``SPELLINGS``."""
        lefts, rights = (self.ways.get(x, {self.codes.of[x]}) for x in (left, right))
        return {x + y for x in lefts for y in rights} if len(lefts) * len(rights) <= SPELLINGS else set()

    def ranked(self, n: int) -> list[tuple[tuple[str, str], int]]:
        """The best pairs that are certain to come before all pairs the driver does not know."""
        sure = [(p, c) for p, c in self.counts.items() if c > self.ceiling or not self.pending and c > 0]
        return nsmallest(n, sure, key=lambda row: _rank(*row))

    def merge(self, merges: list[tuple[str, str]], known: set[str]) -> int:
        """Apply merges in their order; ``known`` are the pieces from before. Returns the words looked at."""
        before = self.codes.replaced(self.pending)
        for left, right in merges:
            self.codes.add(left + right)
        keys: set[str] = set()
        for left, right in merges:
            firsts, lasts = self.first.get(right, {right}), self.last.get(left, {left})
            spelled = self._spelled(left, right)
            # a word of the snapshot that holds the pair by now holds one of these
            keys |= spelled or {self.codes.of[a] + self.codes.of[b] for a in lasts for b in firsts}
            both = left + right
            if both not in known:
                self.made.add(both)
            old = set() if both in self.made else {both}
            self.first[both] = self.first.get(both, old) | self.first.get(left, {left})
            self.last[both] = self.last.get(both, old) | self.last.get(right, {right})
            earlier = self.ways.get(both, {self.codes.of[x] for x in old})
            counted = spelled and (earlier or both not in self.ways) and len(earlier | spelled) <= SPELLINGS
            self.ways[both] = earlier | spelled if counted else set()
        # the filter runs where the words are read: only those that may hold a pair reach Python
        held = reduce(lambda x, y: x | y, [F.contains("codes", F.lit(key)) for key in sorted(keys)])
        changes = self.words.where(held).mapInArrow(_differences(before, self.codes.replaced(merges), self.codes.symbols()), PAIR_SCHEMA)
        looked = 0
        for left, right, change in changes.groupBy("left", "right").agg(F.sum("cnt").alias("cnt")).collect():
            if left is None:
                looked = change
            elif (left, right) in self.counts or left in self.made or right in self.made:
                self.counts[left, right] = self.counts.get((left, right), 0) + change
            elif self.listed_floor:  # a pair of old symbols outside the list
                self.grown[left, right] = self.grown.get((left, right), 0) + change
                self.ceiling = max(self.ceiling, self.listed_floor + self.grown[left, right])
            else:
                self.counts[left, right] = change
        self.pending += merges
        return looked

    def settled(self) -> DataFrame:
        """The words with all merges applied, written anew."""
        merged = self.words.mapInArrow(_replay(self.codes.replaced(self.pending)), CODED_SCHEMA)
        return staged(merged.where(F.length("codes") > 1), "symbols")


def train_bpe(
    words: DataFrame,
    vocab_size: int,
    coverage: float = 1.0,
    candidates: int = CANDIDATES_PER_ROUND,
    batch_rounds: bool = True,
    listed: int = PAIRS_LISTED,
    merges_per_stage: int = MERGES_PER_STAGE,
    on_round: Callable[[list[tuple[str, str]], int], None] | None = None,
    written: bool = False,
) -> Vocabulary:
    """Train a vocabulary on (word, cnt): special ids, 256 bytes, merges, then characters by frequency.

    Pairs are counted once for each snapshot of the words. A round filters the words that hold its pairs as they are read and
    brings back what changes in the counts, so its work but for that filter shrinks with the merged pair. Several merges are applied per round
    when that provably equals one-at-a-time training (``batch_rounds``). A new snapshot is taken every ``merges_per_stage``
    merges, or when a pair outside the ``listed`` ones may be the best. ``on_round`` is told the merges of each round and the
    number of words it looked at. ``words`` that are a plain scan of a ``written`` table are not written again.
    """
    if vocab_size <= 0:
        raise ValueError("the vocabulary size must be positive")
    spark = words.sparkSession
    narrow = words.select("word", F.col("cnt").cast("long").alias("cnt"))
    counted = narrow if written else staged(narrow, "words")
    # The loop is bound by computing, not by reading: a small table is spread over all cores once.
    counted = spread_small(counted, "word")
    room = vocab_size - FIRST_FREE_ID
    kept = char_inventory(counted, coverage).where("kept").orderBy(F.desc("cnt"), "ch").select("ch")
    chars = [r["ch"] for r in kept.limit(max(room, 0) + 1).collect()]
    if len(chars) > room:
        raise ValueError(f"{len(chars)} or more characters do not fit a vocabulary of {vocab_size}")
    merges: list[tuple[str, str]] = []
    known = set(chars)
    if len(known) == room:
        return _vocabulary(spark, merges, chars)
    codes = _Codes(chars)
    state = _Snapshot(staged(_coded(_without_rare_chars(counted, chars, coverage), codes), "symbols"), codes, listed)
    while len(known) < room:
        ranked = state.ranked(candidates)
        if state.pending and (not ranked and state.ceiling or len(state.pending) >= merges_per_stage):
            state = _Snapshot(state.settled(), codes, listed)
            continue
        if not ranked:
            break
        before = set(known)
        floor = max(state.ceiling, ranked[-1][1] if len(ranked) == candidates else 0)
        batch = _independent(ranked, floor, known, room - len(known) if batch_rounds else 1)[: None if batch_rounds else 1]
        looked = state.merge(batch, before)
        merges += batch
        if on_round:
            on_round(batch, looked)
    return _vocabulary(spark, merges, chars)


def _without_rare_chars(words: DataFrame, chars: list[str], coverage: float) -> DataFrame:
    """Cut words at characters outside the inventory, which no merge may contain."""
    if coverage >= 1.0:
        return words
    outside = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]+"
    parts = words.select(F.explode(F.split("word", outside)).alias("word"), "cnt").where(F.length("word") > 0)
    return parts.groupBy("word").agg(F.sum("cnt").alias("cnt"))


# Words whose ids a task remembers; longer words are not remembered.
CACHED_WORDS, CACHED_LENGTH = 200_000, 64
#: Ids that a task holds before it hands them on, and characters of texts that it merges at once.
IDS_HELD, CHARACTERS_MERGED = 1 << 20, 1 << 17
#: Symbols and merges for which the ranks of all pairs are one table; of more, each word looks up its own pairs.
SYMBOLS_IN_TABLE, MERGES_IN_TABLE = 1024, 1 << 14


class Segmenter(dict):
    """Word to ids by the merges in rank order; a character without a piece falls back to its bytes.

    Pairs wait in a heap, so a word of n characters costs n log n however long it is. Frequent words are remembered.
    """

    def __init__(self, merges: list[tuple[str, str]], ids: dict[str, int]) -> None:
        super().__init__()
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.ids = ids

    def __missing__(self, word: str) -> list[int]:
        out: list[int] = []
        for s in self.symbols(word):
            known = self.ids.get(s)
            out += [known] if known is not None else [b + BYTE_OFFSET for b in s.encode("utf-8")]
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = out
        return out

    def symbols(self, word: str) -> list[str]:
        symbol: list[str | None] = list(word)
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := self.rank.get((symbol[i], symbol[i + 1]))) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if symbol[i] is None or j >= n or self.rank.get((symbol[i], symbol[j])) != r:
                continue  # one of the two has been merged meanwhile
            symbol[i] += symbol[j]
            symbol[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := self.rank.get((symbol[left], symbol[right]))) is not None:
                    heappush(heap, (r, left))
        return [s for s in symbol if s is not None]


class Runs(dict):
    """What stands between two single spaces to its ids, as bytes of 32-bit integers that need only be joined. Frequent ones are remembered."""

    def __init__(self, segment: Segmenter) -> None:
        super().__init__()
        self.segment, self.word = segment, re.compile(WORD)

    def __missing__(self, run: str) -> bytes:
        out = self.cut(SPACE + run)
        if len(run) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[run] = out
        return out

    def cut(self, marked: str) -> bytes:
        return array("i", chain.from_iterable(self.segment[w.group()] for w in self.word.finditer(marked))).tobytes()

    def encode(self, text: str | None) -> bytes | None:
        if not text:
            return None if text is None else b""
        if text[0] == " " or "  " in text or SPACE in text:
            return self.cut(SPACE + text.replace(" ", SPACE))
        return b"".join(map(self.__getitem__, text.split(" ")))


class Merger:
    """Texts to ids, those of many texts at once: in each round every word merges its pair of lowest rank, in arrays of symbols.

    That is what ``Segmenter`` does word by word. All places of a pair in a word are merged in one round, from the left, unless a
    symbol it makes may be taken by a pair of lower rank, which would then come first.
    """

    NO_RANK = np.iinfo(np.int16).max
    ALONE, MARK = 1, 2

    def __init__(self, merges: list[tuple[str, str]], ids: dict[str, int]) -> None:
        rank = {pair: i for i, pair in enumerate(merges)}
        # symbols of pairs; number ``self.other`` stands for all characters outside pairs
        names = list(dict.fromkeys(x for a, b in rank for x in (a, b, a + b)))
        number = {x: i for i, x in enumerate(names)}
        self.other = n = len(names)
        self.ranks = np.full((n + 1, n + 1), self.NO_RANK, np.int16)
        self.made, self.early = np.zeros(len(merges), np.int32), np.zeros(len(merges), bool)
        first_taken: dict[str, int] = {}
        for (a, b), r in rank.items():
            self.ranks[number[a], number[b]], self.made[r] = r, number[a + b]
            for x in (a, b):
                first_taken[x] = min(r, first_taken.get(x, r))
        for (a, b), r in rank.items():
            self.early[r] = first_taken.get(a + b, r) < r
        self.ranks = self.ranks.ravel()
        self.names = names
        self.symbol = np.full(0x110000, n, np.int32)
        self.char_id = np.full(0x110000, -1, np.int32)
        self.kind = np.zeros(0x110000, np.uint8)
        self.kind[[ord(c) for c in "\n" + OPEN + CLOSE + "0123456789０１２３４５６７８９"]] = self.ALONE
        self.kind[ord(SPACE)] = self.MARK
        self.symbol_id = np.array([ids.get(x, -1) for x in names] + [-1], np.int32)
        for piece, known in ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = known
        for x, i in number.items():
            if len(x) == 1:
                self.symbol[ord(x)] = i

    def encode(self, texts: Sequence[str | None]) -> list[bytes | None]:
        """Ids of each text as bytes of 32-bit integers."""
        held = [SPACE + t for t in texts if t]
        if not held:
            return [None if t is None else b"" for t in texts]
        points = np.frombuffer("".join(held).encode("utf-32-le"), "<u4").astype(np.int32)
        points[points == ord(" ")] = ord(SPACE)
        begin = np.cumsum([0, *map(len, held)])
        kind = self.kind[points]
        alone, mark = kind == self.ALONE, kind == self.MARK
        starts = alone | mark
        starts[1:] = alone[1:] | alone[:-1] | (mark[1:] & ~mark[:-1])
        starts[begin[:-1]] = True
        symbols = self._merged(self.symbol[points], starts)
        at = np.flatnonzero(symbols >= 0)
        left = symbols[at]
        out = np.where(left == self.other, self.char_id[points[at]], self.symbol_id[left])
        ends = np.searchsorted(at, begin)
        unknown = np.flatnonzero(out < 0)
        if len(unknown):
            out, ends = self._spelled(out, ends, unknown, np.where(left == self.other, -1 - points[at], left)[unknown])
        raw, ends = out.astype(np.int32).tobytes(), (4 * ends).tolist()
        parts = (raw[a:b] for a, b in zip(ends, ends[1:]))
        return [next(parts) if t else None if t is None else b"" for t in texts]

    def _merged(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Symbols where they begin, -1 elsewhere, of characters and the places where words start."""
        at, now, last = np.arange(len(symbols)), symbols.copy(), np.append(starts[1:], True)
        while len(at):
            pairs = now * (self.other + 1)
            pairs[:-1] += now[1:]
            pairs[last] = self.other  # a pair without a rank
            rank = self.ranks.take(pairs)
            ends = np.flatnonzero(last)
            first = np.append(0, ends[:-1] + 1)
            best = np.minimum.reduceat(rank, first)
            sizes = ends - first + 1
            target = np.repeat(best, sizes)
            mergeable = target < self.NO_RANK
            hits = np.flatnonzero((rank == target) & mergeable)
            if not len(hits):
                break
            hits = self._chosen(hits, rank, ends)
            new = self.made.take(rank.take(hits))
            now[hits], last[hits] = new, last.take(hits + 1)
            symbols[at.take(hits)], symbols[at.take(hits + 1)] = new, -1
            mergeable[hits + 1] = False
            kept = np.flatnonzero(mergeable)
            at, now, last = at.take(kept), now.take(kept), last.take(kept)
        return symbols

    def _chosen(self, hits: np.ndarray, rank: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The places to merge: of pairs that overlap every other from the left, of an early pair the first of its word."""
        follows = np.append(False, np.diff(hits) == 1)
        if follows.any():
            numbers = np.arange(len(hits))
            run = np.maximum.accumulate(np.where(follows, 0, numbers))
            hits = hits[(numbers - run) % 2 == 0]
        early = self.early[rank[hits]]
        if early.any():
            word = np.searchsorted(ends, hits)
            hits = hits[~early | np.append(True, word[1:] != word[:-1])]
        return hits

    def _spelled(self, out: np.ndarray, ends: np.ndarray, unknown: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with the symbols that have none spelled in bytes, and the ends of texts among them."""
        kinds, of = np.unique(which, return_inverse=True)
        spelling = [(chr(-1 - k) if k < 0 else self.names[k]).encode("utf-8") for k in kinds.tolist()]
        sizes = np.ones(len(out), np.int64)
        sizes[unknown] = np.array([len(b) for b in spelling])[of]
        places = np.append(0, np.cumsum(sizes))
        out = np.repeat(out, sizes)
        order = np.argsort(of, kind="stable")
        for places_of, letters in zip(np.split(places[unknown][order], np.cumsum(np.bincount(of))[:-1]), spelling):
            for i, b in enumerate(letters):
                out[places_of + i] = b + BYTE_OFFSET
        return out, places[ends]


def _groups(batch: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a batch, some characters at a time."""
    group, held = [], 0
    for value in batch:
        group.append(value.as_py())
        held += len(group[-1] or "")
        if held >= CHARACTERS_MERGED:
            yield group
            group, held = [], 0
    if group:
        yield group


def _id_lists(parts: list[bytes | None]) -> pa.Array:
    ends = np.cumsum([0, *(len(p or b"") // 4 for p in parts)]).astype(np.int32)
    ids = pa.array(np.frombuffer(b"".join(p for p in parts if p), np.int32))
    return pa.ListArray.from_arrays(pa.array(ends), ids, mask=pa.array([p is None for p in parts]))


def _encoder(merges: list[tuple[str, str]], ids: dict[str, int]) -> Callable[[Sequence[str | None]], Iterable[bytes | None]]:
    """What encodes some texts at a time: all at once if the symbols of the merges are few, otherwise word by word."""
    few = len({x for a, b in merges for x in (a, b, a + b)}) <= SYMBOLS_IN_TABLE and len(merges) <= MERGES_IN_TABLE
    if few and all(a and b for a, b in merges):
        return Merger(merges, ids).encode
    runs = Runs(Segmenter(merges, ids))
    return lambda texts: map(runs.encode, texts)


def encode_corpus(
    docs: DataFrame, vocabulary: Vocabulary, bos: bool = True, eos: bool = False, keep: Sequence[str] = ("shard_id", "doc_pos")
) -> DataFrame:
    """(shard_id, doc_pos, text) to (shard_id, doc_pos, ids, n_tokens); ``keep`` may name other columns to carry.

    Rows stay where they are: one Arrow pass over the texts with the merges, whose number the vocabulary size bounds. Few merges
    are applied to the words of many texts at once, more of them word by word with a cache per task. No word occurrence is shuffled, so a frequent word is no hot key.
    """
    merges = [(r["left"], r["right"]) for r in vocabulary.merges.orderBy("rank").collect()]
    pieces = vocabulary.vocab.where(F.col("kind").isin("char", "merge")).collect()
    ids = {r["piece"]: r["id"] for r in pieces}
    shared = docs.sparkSession.sparkContext.broadcast((merges, ids))

    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _encoder(*shared.value)
        for batch in batches:
            # a batch leaves in parts: the ids of a few texts are held, not those of thousands
            part, held = [], 0
            for texts in _groups(batch):
                for ids in encode(texts):
                    part.append(ids)
                    held += len(ids or b"") // 4
                    if held >= IDS_HELD:
                        yield _id_lists(part)
                        part, held = [], 0
            if part:
                yield _id_lists(part)

    encoded = docs.select(*keep, add_bos_eos(to_ids("text"), bos, eos).alias("ids"))
    return encoded.withColumn("n_tokens", F.size("ids"))


def export_vocab(vocab: DataFrame) -> DataFrame:
    """Pieces in id order as they are displayed, with byte lengths and the longest of them."""
    display = (
        F.when(F.col("id") == BOS_ID, F.lit(BOS_DISPLAY))
        .when(F.col("id") == EOS_ID, F.lit(EOS_DISPLAY))
        .otherwise(F.replace("piece", F.lit(SPACE), F.lit(" ")))
    )
    return (
        vocab.select("id", display.alias("display"), "score")
        .withColumn("byte_length", F.octet_length("display"))
        .withColumn("max_byte_length", F.max("byte_length").over(Window.partitionBy()))
        .orderBy("id")
    )


def piece_bytes(vocab: DataFrame) -> DataFrame:
    """(id, hex): the bytes a token stands for; special tokens stand for none."""
    plain = F.hex(F.encode(F.replace("piece", F.lit(SPACE), F.lit(" ")), "UTF-8"))
    return vocab.select(
        "id",
        F.when(F.col("kind").isin("unk", "bos", "eos"), F.lit(""))
        .when(F.col("kind") == "byte", F.substring("piece", 4, 2))
        .otherwise(plain)
        .alias("hex"),
    )


def decode_corpus(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add ``text``: pieces joined, bytes reassembled, special tokens and the leading space dropped.

    The whole vocabulary (at most 65,536 pieces) is one array found by a scalar subquery, so a token is an array access
    and no row moves. An id outside the vocabulary is an error.
    """
    entries = piece_bytes(vocab).agg(F.array_sort(F.collect_list(F.struct("id", "hex"))).alias("entries"))
    table = entries.select(F.col("entries.hex").alias("pieces")).scalar()
    with_table = df.withColumn("_pieces", table)
    joined = F.array_join(F.transform("ids", lambda i: F.element_at("_pieces", i + 1)), "")
    # Byte pieces may spell invalid text; such bytes become the replacement character.
    text = F.make_valid_utf8(F.unhex(joined).cast("string"))
    return with_table.withColumn("text", F.regexp_replace(text, r"\A ", "")).drop("_pieces")


def vocab_lookup(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Piece, score and kind of every token id in a long table."""
    return lookup(tokens, vocab, ["id"])
