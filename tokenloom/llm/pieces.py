"""Merge-type piece encoding by backtracking, equal to the greedy highest-score merge of the model's library.

A sequence of pieces is the result of merging exactly when every two neighbours are: re-merging the text of the two
gives the two back. So the encoder takes, from the left, the longest piece that fits its left neighbour and, where it
runs into a dead end, drops the last piece for its next shorter prefix. A bitfield marks end positions from which no
way leads on, which keeps the search linear. The longest piece at each position comes from one Aho-Corasick pass.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE_WORDS = 150_000
CACHE_PAIRS = 300_000


class PieceModel:
    """The vocabulary of a merge-type model with byte fallback; ``processor`` only supplies pieces and scores."""

    def __init__(self, processor) -> None:
        n = processor.get_piece_size()
        self.bos, self.eos = processor.bos_id(), processor.eos_id()
        self.unknown = processor.unk_id()
        self.piece = [processor.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i))]
        self.id_of = {self.piece[i]: i for i in plain}
        self.score = {self.piece[i]: processor.get_score(i) for i in plain}
        self.byte_ids = {int(self.piece[i][3:5], 16): i for i in range(n) if processor.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.special = {self.bos, self.eos, *self.byte_of}
        self.chunk = self._chunk_pattern()
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        #: Of each piece the two it was last merged from; absent for characters. Pieces that merging cannot reach are left out.
        self.halves: dict[str, tuple[str, str]] = {}
        self.whole = set()
        for p in self.id_of:
            steps = self.merge(p)
            if len(steps[-1]) == 1:
                self.whole.add(p)
                self.automaton.add_word(p)
                if len(p) > 1:
                    self.halves[p] = tuple(steps[-2])
        self.automaton.make_automaton()
        self._fits: dict[tuple[str, str], bool] = {}
        self.cache = ChunkCache(self)

    def _chunk_pattern(self) -> re.Pattern:
        """Cuts a text only between two characters that stand side by side in no piece, where no merge can reach over.

        These are the beginnings of runs of spaces, and the borders between punctuation (with all that shares a piece
        with it) and the rest. A vocabulary that joins them is not cut at all.
        """
        pairs = {(a, b) for p in self.id_of for a, b in zip(p, p[1:])}
        if any(b == SPACE != a for a, b in pairs):
            return re.compile("(?s:.+)")
        marks = {chr(c) for c in range(128) if not chr(c).isalnum()}
        while True:
            more = {x for a, b in pairs for x in (a, b) if (a in marks or b in marks)} - marks - {SPACE}
            if not more:
                break
            marks |= more
        if any(c.isascii() and c.isalnum() for c in marks):
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        inside = "".join(map(re.escape, sorted(marks)))
        return re.compile(f"{SPACE}*(?:[{inside}]+|[^{inside}{SPACE}]+)|{SPACE}+")

    def merge(self, text: str) -> list[list[str]]:
        """All states of merging neighbours by score, the leftmost of equal ones first; for pieces at load time."""
        states, score = [list(text)], self.score
        while True:
            parts = states[-1]
            found = [(-score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]
            if not found:
                return states
            i = min(found)[1]
            states.append([*parts[:i], parts[i] + parts[i + 1], *parts[i + 2 :]])

    def fits(self, left: str, right: str) -> bool:
        """Whether the two can stand side by side, that is, whether merging their joined text gives them back.

        Goes back through the merges of both, the later one first, and asks at each state whether a merge over the
        border would have come before the one just undone.
        """
        key = (left, right)
        known = self._fits.get(key)
        if known is not None:
            return known
        if len(self._fits) > CACHE_PAIRS:
            self._fits.clear()
        score, halves = self.score, self.halves
        undone = None  # (score, 0 if the merge undone is left of the border else 1)
        good = True
        while True:
            over = score.get(left + right)
            # of equal scores the leftmost comes first: a merge in the left part before one over the border
            if over is not None and (undone is None or over > undone[0] or (over == undone[0] and undone[1])):
                good = False
                break
            a, b = halves.get(left), halves.get(right)
            if a is None and b is None:
                break
            if b is None or (a is not None and score[left] < score[right]):
                undone, left = (score[left], 0), a[1]
            else:
                undone, right = (score[right], 1), b[0]
        self._fits[key] = good
        return good

    def split(self, text: str) -> list[str]:
        """The pieces of a text; a character outside the vocabulary is a piece of its own."""
        n = len(text)
        longest = [1] * n
        for end, size in self.automaton.iter(text):  # of one start, the longer match ends later
            longest[end - size + 1] = size
        known, whole = self._fits, self.whole
        dead = None  # bit p: nothing that ends at p can be carried on
        out: list[str] = []
        at, size, last = 0, longest[0] if n else 0, ""
        while at < n:
            end = at + size
            piece = text[at:end]
            if dead is None or not dead[end >> 3] >> (end & 7) & 1:
                good = known.get((last, piece)) if at else True
                if good is None:
                    good = self.fits(last, piece)
                if good:
                    out.append(piece)
                    at, last = end, piece
                    size = longest[end] if end < n else 0
                    continue
            size -= 1
            while size > 1 and text[at : at + size] not in whole:
                size -= 1
            while size < 1:  # dead end: take the last piece back and shorten it
                dead = dead or bytearray((n >> 3) + 1)
                dead[at >> 3] |= 1 << (at & 7)
                back = out.pop()
                at -= len(back)
                last = out[-1] if out else ""
                size = len(back) - 1
                while size > 1 and text[at : at + size] not in whole:
                    size -= 1
        return out

    def forget(self) -> None:
        """Empty what was remembered of texts."""
        self.cache.old = {}
        self.cache.clear()
        self._fits.clear()

    def chunk_ids(self, chunk: str) -> list[int]:
        pieces = self.split(chunk)
        try:
            return [self.id_of[p] for p in pieces]
        except KeyError:
            pass
        ids: list[int] = []
        for p in pieces:
            known = self.id_of.get(p)
            if known is not None:
                ids.append(known)
            elif self.byte_ids:
                ids.extend(self.byte_ids[b] for b in p.encode())
            else:
                ids.append(self.unknown)
        return ids

    def chunks(self, text: str) -> list[str]:
        """A text with its dummy space in front, spaces made visible, cut where no merge can reach over."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return self.chunk.findall(marked)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: control ids vanish, byte runs are read as UTF-8, the dummy space goes."""
        text = self.surface(ids)
        return text[1:] if text.startswith(" ") else text

    def surface(self, ids: list[int]) -> str:
        """What ``decode`` gives before the dummy space goes."""
        if self.special.isdisjoint(ids):
            return "".join([self.piece[i] for i in ids]).replace(SPACE, " ")
        out: list[str] = []
        run = bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(read_bytes(bytes(run)))
                run.clear()
            if i not in (self.bos, self.eos):
                out.append(self.piece[i])
        if run:
            out.append(read_bytes(bytes(run)))
        return "".join(out).replace(SPACE, " ")


def read_bytes(run: bytes) -> str:
    """UTF-8 with one U+FFFD for every byte that belongs to no character."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


class ChunkCache(dict):
    """Packed ids and decoded bytes of chunks. Two generations: when the young one is full it becomes the old one, so
    frequent chunks stay and memory is bounded."""

    def __init__(self, model: PieceModel) -> None:
        super().__init__()
        self.model = model
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def __missing__(self, chunk: str) -> tuple[bytes, bytes]:
        value = self.old.get(chunk)
        if value is None:
            ids = self.model.chunk_ids(chunk)
            value = struct.pack(f"<{len(ids)}I", *ids), self.model.surface(ids).encode()
        if len(chunk) <= 64:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[chunk] = value
        return value


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    """The model at ``path``, once per process."""
    import sentencepiece

    return PieceModel(sentencepiece.SentencePieceProcessor(model_file=path))


def _encoder(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        try:
            for batch in batches:
                for first in range(0, batch.num_rows, 256):
                    yield rows(model, batch.slice(first, 256))
        finally:  # the worker lives on beside other tasks, which need the memory
            model.forget()

    def rows(model: PieceModel, part: pa.RecordBatch) -> pa.RecordBatch:
        cache = model.cache
        bos, eos = struct.pack("<I", model.bos), struct.pack("<I", model.eos)
        count, left, right = [], [], []
        for text in part.column(1).to_pylist():
            found = [cache[c] for c in model.chunks(text or "")]
            ids = b"".join([bos, *[f[0] for f in found], eos])
            # the dummy space is the first byte of the first chunk
            decoded = b"".join([f[1] for f in found])[1:]
            count.append(len(ids) // 4)
            left.append(hashlib.sha256(ids).hexdigest() if digests else list(struct.unpack(f"<{len(ids) // 4}I", ids)))
            right.append(hashlib.sha256(decoded).hexdigest() if digests else decoded.decode())
        kind = pa.string() if digests else pa.list_(pa.int32())
        names = ["n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(count, pa.int64()), pa.array(left, kind), pa.array(right, pa.string())], [part.schema.names[0], *names])

    return run


def encode(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text", *, digests: bool = False) -> DataFrame:
    """Ids of every text with begin and end id, and what they decode to.

    Returns id, ``n_tokens``, ``ids`` and ``decoded``; with ``digests`` their SHA-256 instead (ids as little-endian
    unsigned 32-bit integers, text as UTF-8). A null text counts as empty: begin and end id only. Texts are encoded row
    by row, so repeated rows, null ids and an empty table need no care; other columns are not read. ``model_path`` must
    be readable on the executors.
    """
    narrow = docs.select(F.col(id_column), F.col(text_column).cast("string"))
    kind = narrow.schema[0].dataType.simpleString()
    out = "n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    return narrow.mapInArrow(_encoder(model_path, digests), f"`{id_column}` {kind}, {out}")
