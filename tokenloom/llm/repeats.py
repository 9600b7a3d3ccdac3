"""Removal of passages that an earlier document holds too, by suffix arrays over shards.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller id.

1. Each window of ``LENGTH`` bytes is named by its minimizer, the least hash of the ``GRAM``-byte strings in it. Equal
   windows have equal minimizers, so a minimizer that one document alone holds rules its windows out. Counting them
   moves a few bytes per minimizer, in blocks per (batch, part); what a batch can tell by itself stays out of it.
2. Neighbouring windows with one minimizer form a segment. Segments whose minimizer repeats are dealt to shards by it,
   so equal windows always meet in one shard. A batch sends each different segment once, for its smallest document.
   A minimizer of more than ``MOST`` documents would fill its shard: its segments are sent as single windows instead,
   each dealt by a hash of itself, so they spread over all shards and equal windows still meet.
3. A shard sorts the suffixes of its different segments by external induced sorting. Runs of suffixes that share
   ``LENGTH`` bytes are equal windows, and the smallest document of a run is where they were first.
4. Spans are joined back to their documents and cut out.

Texts move compressed, and once: both joins take them from the same shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import induced
from tokenloom.llm import spans as S

LENGTH = 50
GRAM = 20
#: Parts of the minimizer count, and shards of the suffix sort, for each shuffle partition of the session.
PARTS, SHARDS = 2, 4
#: Documents that a minimizer may stand in before its windows are dealt one by one: 4 MB of segments of 80 bytes.
MOST = 50_000
#: Marks such a minimizer, above the six bytes that name it.
_HOT = 1 << 48


def minimizers(part: S.Slice, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a slice: begin, end, row and minimizer. Windows never cross rows; of equal hashes the first counts."""
    data, n = part.data, len(part.data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = S.powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64, out=total[1:])
    hashes = S.mix((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    least, place, width, most = hashes, np.arange(len(hashes), dtype=np.int32), 1, length - gram + 1
    while width < most:
        step = min(width, most - width)
        right = least[step:] < least[:-step]
        place = np.where(right, place[step:], place[:-step])
        least = np.where(right, least[step:], least[:-step])
        width += step
    row = part.row_of(np.arange(len(place)))
    inside = np.arange(len(place)) + length <= part.at[row + 1]
    begin = np.flatnonzero(inside & np.r_[True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
    row = row[begin]
    last = np.minimum(np.r_[begin[1:], len(place)] - 1, part.at[row + 1] - length)
    return begin, last + length, row, hashes[place[begin]]


def pack(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as their differences need."""
    if not len(values):
        return b""
    low = int(values.min())
    steps = (values - low).astype(np.uint64)
    rising = bool((np.diff(values) >= 0).all())
    if rising:
        steps = np.diff(values, prepend=values[:1]).astype(np.uint64)
    width = next(w for w in (1, 2, 4, 8) if int(steps.max()) >> (8 * w - 1) == 0 or w == 8)
    return np.array([low, width, rising], np.int64).tobytes() + steps.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    low, width, rising = np.frombuffer(data, np.int64, 3)
    steps = np.frombuffer(data, f"<u{width}", offset=24).astype(np.int64)
    return low + (np.cumsum(steps) if rising else steps)


def _short(keys: np.ndarray) -> bytes:
    """The upper six bytes of each key; the part that a key goes to tells most of the rest."""
    return np.ascontiguousarray((keys >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _long(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(np.int64)


def _by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    bounds = np.r_[np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]]), len(order)] if len(order) else [0]
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield int(part[order[a]]), order[a:b]


def _count(parts: int, length: int, gram: int):
    """Per batch: minimizers of one document (0), of several with their number (1), and which documents hold the latter (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0), np.int64)
            keys, docs = [], []
            for part in S.slices(batch.column(1)):
                _, _, row, key = minimizers(part, length, gram)
                keys.append(key)
                docs.append(ids[part.first + row])
            key, doc = np.concatenate(keys) if keys else np.zeros(0, np.uint64), np.concatenate(docs) if docs else np.zeros(0, np.int64)
            if not len(key):
                continue
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
            key, doc = key[new], doc[new]
            head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[head, len(key)])
            rows: list[tuple[int, int, bytes, bytes]] = []
            single = head[size == 1]
            single = single[np.argsort(doc[single], kind="stable")]
            for p, at in _by_part((key[single] % np.uint64(parts)).astype(np.int64)):
                rows.append((p, 0, _short(key[single[at]]), pack(doc[single[at]])))
            several = head[size > 1]
            for p, at in _by_part((key[several] % np.uint64(parts)).astype(np.int64)):
                rows.append((p, 1, _short(key[several[at]]), pack(size[size > 1][at])))
            local = np.flatnonzero(np.repeat(size > 1, size))
            if len(local):
                local = local[np.argsort(doc[local], kind="stable")]
                rows.append((int(key[local[0]] % np.uint64(parts)), 2, _short(key[local]), pack(doc[local])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["part", "kind", "keys", "docs"])

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """The (document, minimizer) pairs of one part whose minimizer stands in several documents."""
    kinds = table["kind"].to_pylist()
    keys = [_long(k) for k in table["keys"].to_pylist()]
    docs = [unpack(d) for d in table["docs"].to_pylist()]
    every = np.concatenate([k for k, t in zip(keys, kinds) if t == 0] or [np.zeros(0, np.int64)])
    owner = np.concatenate([d for d, t in zip(docs, kinds) if t == 0] or [np.zeros(0, np.int64)])
    known = np.unique(np.concatenate([k for k, t in zip(keys, kinds) if t == 1] or [np.zeros(0, np.int64)]))
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    same = every[1:] == every[:-1]
    hit = (np.r_[False, same] | np.r_[same, False])[: len(every)] if len(every) else np.zeros(0, bool)
    if len(known) and len(every):
        hit |= known[np.minimum(np.searchsorted(known, every), len(known) - 1)] == every
    out_docs = [owner[hit], *[d for d, t in zip(docs, kinds) if t == 2]]
    out_keys = [every[hit], *[k for k, t in zip(keys, kinds) if t == 2]]
    return pa.table({"id": pa.array(np.concatenate(out_docs), pa.int64()), "key": pa.array(np.concatenate(out_keys), pa.int64())})


def _hot(most: int):
    """The minimizers of one part that stand in more than ``most`` documents."""

    def run(table: pa.Table) -> pa.Table:
        kinds = np.array(table["kind"].to_pylist(), np.int64)
        keys, docs = table["keys"].to_pylist(), table["docs"].to_pylist()
        single, several = np.flatnonzero(kinds == 0), np.flatnonzero(kinds == 1)
        empty = np.zeros(0, np.int64)
        known, at = np.unique(np.concatenate([_long(keys[i]) for i in several] or [empty]), return_inverse=True)
        count = np.zeros(len(known), np.int64)
        np.add.at(count, at, np.concatenate([unpack(docs[i]) for i in several] or [empty]))
        # a batch names a minimizer of one document once, so few can still come to the limit
        if len(single) > most:
            lone, times = np.unique(np.concatenate([_long(keys[i]) for i in single]), return_counts=True)
            known, at = np.unique(np.r_[known, lone], return_inverse=True)
            count = np.bincount(at, np.r_[count, times], len(known)).astype(np.int64)
        else:
            near = count + len(single) > most
            known, count = known[near], count[near]
            for i in single if len(known) else ():
                count += np.isin(known, _long(keys[i]))
        return pa.table({"key": pa.array(known[count > most], pa.int64())})

    return run


def _merged(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of spans that touch or overlap, within each document."""
    if not len(doc):
        return doc, begin, end
    order = np.lexsort((end, begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    block = np.cumsum(np.r_[False, doc[1:] != doc[:-1]]).astype(np.int64)
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(end + block * wide) - block * wide
    new = np.r_[True, (doc[1:] != doc[:-1]) | (begin[1:] > reach[:-1])]
    at = np.flatnonzero(new)
    return doc[at], begin[at], reach[np.r_[at[1:], len(doc)] - 1]


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, a text, compressed; null stays null."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.binary())
        packed = [None if t is None else press.compress(t) for t in texts.to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], batch.schema.names)


def _texts(column: pa.Array) -> list[bytes]:
    open_ = zstandard.ZstdDecompressor()
    return [b"" if t is None else open_.decompress(t) for t in column.to_pylist()]


def _windows(sent: list[int], hot: np.ndarray, texts: list[bytes], doc: list[int], begin: np.ndarray, length: int):
    """Of the hot segments: different windows as (window, document, begin), and repeats of them as (document, begin)."""
    first: dict[bytes, int] = {}
    windows: list[tuple[bytes, int, int]] = []
    alone: list[tuple[int, int]] = []
    for i in sent:  # by document, so that the first to hold a window is the smallest
        if hot[i]:
            t, d, a = texts[i], doc[i], int(begin[i])
            for k in range(len(t) - length + 1):
                w = t[k : k + length]
                if first.setdefault(w, d) == d:
                    windows.append((w, d, a + k))
                else:
                    alone.append((d, a + k))
    return windows, alone


def _segments(shards: int, length: int, gram: int):
    """Per batch: different segments with their smallest document (0), and spans that the batch settles itself (1).

    Segments of a minimizer marked hot go as their windows, different ones only, each to the shard of its own hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            batch = batch.filter(batch.column(2).is_valid())
            ids = np.asarray(batch.column(0), np.int64)
            wanted = batch.column(2)
            docs, begins, shard_of, hot_of, texts = [], [], [], [], []
            for part in S.slices(pa.array(_texts(batch.column(1)), pa.large_binary())):
                begin, end, row, key = minimizers(part, length, gram)
                own = wanted.slice(part.first, part.rows)
                flags = own.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
                flag_row = np.repeat(np.arange(part.rows), own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                name = lambda k, r: S.mix(k ^ S.mix(r.astype(np.uint64) + np.uint64(1)))
                hot = flags >= np.uint64(_HOT)
                flags &= np.uint64(_HOT - 1)
                names = name(key >> np.uint64(16), row)
                hit = np.flatnonzero(np.isin(names, name(flags, flag_row)))
                raw = part.data.tobytes()
                texts += [raw[a:b] for a, b in zip(begin[hit].tolist(), end[hit].tolist())]
                docs.append(ids[part.first + row[hit]])
                begins.append(begin[hit] - part.at[row[hit]])
                shard_of.append((key[hit] % np.uint64(shards)).astype(np.int64))
                hot_of.append(np.isin(names[hit], name(flags[hot], flag_row[hot])))
            if not texts:
                continue
            doc, begin, shard, hot = np.concatenate(docs), np.concatenate(begins), np.concatenate(shard_of), np.concatenate(hot_of)
            first: dict[bytes, int] = {}
            sent, settled = [], []
            doc_list = doc.tolist()
            for i in np.lexsort((begin, doc)).tolist():
                seen = first.setdefault(texts[i], i)
                (sent if doc_list[seen] == doc_list[i] else settled).append(i)
            del first
            rows = []
            windows, alone = _windows(sent, hot, texts, doc_list, begin, length)
            sent = [i for i in sent if not hot[i]]
            sent = np.array(sent, np.int64)
            for p, at in _by_part(np.array([zlib.crc32(t) % shards for t, _, _ in windows], np.int64)):
                t, d, a = zip(*[windows[i] for i in at.tolist()])
                rows.append((p, 0, pack(np.array(d, np.int64)), pack(np.array(a, np.int64)), pack(np.full(len(t), length, np.int64)), press.compress(b"".join(t))))
            for p, at in _by_part(shard[sent]):
                at = sent[at]
                own = [texts[i] for i in at.tolist()]
                rows.append((p, 0, pack(doc[at]), pack(begin[at]), pack(np.array([len(t) for t in own], np.int64)), press.compress(b"".join(own))))
            if settled or alone:
                at = np.array(settled, np.int64)
                d, a = np.array(alone, np.int64).reshape(-1, 2).T
                end = begin[at] + np.array([len(texts[i]) for i in settled], np.int64)
                d, a, b = _merged(np.r_[doc[at], d], np.r_[begin[at], a], np.r_[end, a + length])
                rows.append((int(d[0]) % shards, 1, pack(d), pack(a), pack(b - a), b""))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["part", "kind", "docs", "begins", "sizes", "data"])

    return run


def _repeating(segments: list[bytes], length: int) -> np.ndarray:
    """Which segments hold a window whose hash stands twice. Equal windows have equal hashes, so no other segment can share one."""
    owner, hashes = [], []
    first = 0
    while first < len(segments):  # about a megabyte at a time, for the powers of the hash
        last, size = first, 0
        while last < len(segments) and (last == first or size + len(segments[last]) <= S.SLICE_BYTES):
            size += len(segments[last])
            last += 1
        own = segments[first:last]
        sizes = np.array([len(x) for x in own], np.int64)
        data = np.frombuffer(b"".join(own), np.uint8)
        counts = sizes - length + 1
        begin = np.repeat(np.cumsum(sizes) - sizes - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        hashes.append(S.span_hashes(data, begin, begin + length))
        owner.append(np.repeat(np.arange(first, last, dtype=np.int32), counts))
        first = last
    out = np.zeros(len(segments), bool)
    if not hashes:
        return out
    hashes, owner = np.concatenate(hashes), np.concatenate(owner)
    order = np.sort(hashes)
    twice = order[1:][order[1:] == order[:-1]]
    del order
    if len(twice):
        twice = np.unique(twice)
        place = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
        out[owner[twice[place] == hashes]] = True
    return out


def first_documents(segments: list[bytes], owner: np.ndarray, length: int, memory: int = induced.MEMORY) -> list[np.ndarray]:
    """For each segment and window in it, the smallest owner of any segment with an equal window.

    Only segments in which a window may repeat are sorted; in the others each window is its owner's.
    """
    chosen = np.flatnonzero(_repeating(segments, length))
    out = [np.broadcast_to(o, max(0, len(s) - length + 1)) for s, o in zip(segments, owner)]
    if not len(chosen):
        return out
    owner = owner[chosen]
    size = np.array([len(segments[i]) for i in chosen], np.int64)
    starts = np.cumsum(size + 1) - size - 1
    text = np.frombuffer(b"\0".join(segments[i] for i in chosen) + b"\0", np.uint8).astype(np.int16) + 1
    text[starts + size] = 0
    place, shared = induced.suffix_array(text, memory)
    del text
    small = np.int32 if int(size.sum()) + len(size) < 1 << 31 else np.int64
    cut = np.cumsum(shared < length, dtype=small)
    del shared
    segment = (np.searchsorted(starts, place, side="right") - 1).astype(small)
    # the place of a window among all windows; suffixes too short to be one are left out
    offset = (place - starts[segment]).astype(small)
    whole = offset + length <= size[segment]
    segment, offset, cut = segment[whole], offset[whole], cut[whole]
    del place, whole
    head = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]])
    least = np.repeat(np.minimum.reduceat(owner[segment], head), np.diff(np.r_[head, len(cut)]))
    windows = size - length + 1
    base = np.cumsum(windows) - windows
    found = np.empty(int(windows.sum()), np.int64)
    found[base[segment] + offset] = least
    for i, part in zip(chosen.tolist(), np.split(found, base[1:])):
        out[i] = part
    return out


def _shard(length: int, memory: int):
    def run(table: pa.Table) -> pa.Table:
        docs, begins, ends = [], [], []
        number: dict[bytes, int] = {}
        seg, doc, begin = [], [], []
        for kind, d, a, n, data in zip(*[table[c].to_pylist() for c in ("kind", "docs", "begins", "sizes", "data")]):
            d, a, n = unpack(d), unpack(a), unpack(n)
            if kind == 1:
                docs.append(d), begins.append(a), ends.append(a + n)
                continue
            data = zstandard.ZstdDecompressor().decompress(data)
            cuts = np.r_[0, np.cumsum(n)].tolist()
            seg += [number.setdefault(data[x:y], len(number)) for x, y in zip(cuts[:-1], cuts[1:])]
            doc.append(d), begin.append(a)
        if seg:
            seg, doc, begin = np.array(seg, np.int64), np.concatenate(doc), np.concatenate(begin)
            segments = list(number)
            size = np.array([len(s) for s in segments], np.int64)
            owner = np.full(len(segments), np.iinfo(np.int64).max)
            np.minimum.at(owner, seg, doc)
            later = doc > owner[seg]
            docs.append(doc[later]), begins.append(begin[later]), ends.append(begin[later] + size[seg[later]])
            # in a segment's own first document, the windows that another segment had before
            firsts = first_documents(segments, owner, length, memory)
            spans: dict[int, list[tuple[int, int]]] = {}
            for s, first in enumerate(firsts):
                old = first < owner[s]
                if old.any():
                    edge = np.flatnonzero(np.diff(np.r_[False, old, False].astype(np.int8)))
                    spans[s] = [(a, b - 1 + length) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
            for i in np.flatnonzero(~later).tolist():
                for a, b in spans.get(int(seg[i]), ()):
                    docs.append(doc[i : i + 1]), begins.append(begin[i : i + 1] + a), ends.append(begin[i : i + 1] + b)
        empty = np.zeros(0, np.int64)
        doc, begin, end = _merged(*[np.concatenate(x) if x else empty for x in (docs, begins, ends)])
        return pa.table({"id": pa.array(doc, pa.int64()), "begin": pa.array(begin, pa.int64()), "end": pa.array(end, pa.int64())})

    return run


def squeezed(texts: DataFrame) -> DataFrame:
    """``texts`` (id first, text last) with the text compressed."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[:-1])
    return texts.mapInArrow(_squeeze, f"{fields}, packed binary")


def dealt_segments(texts: DataFrame, packed: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """What each shard (``part``) gets: segments or windows of ``texts`` (id, text), and spans that are settled already."""
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = texts.where("id IS NOT NULL AND text IS NOT NULL")
    counted = known.mapInArrow(_count(PARTS * width, length, gram), "part int, kind int, keys binary, docs binary")
    pairs = counted.groupBy("part").applyInArrow(_repeated, "id long, key long")
    # at most (pairs / most) keys; both readers share one shuffle
    hot = counted.groupBy("part").applyInArrow(_hot(most), "key long").select("key", F.lit(_HOT).alias("mark"))
    marked = pairs.join(F.broadcast(hot), "key", "left").select("id", F.col("key").bitwiseOR(F.coalesce("mark", F.lit(0).cast("long"))).alias("key"))
    wanted = marked.groupBy("id").agg(F.collect_list("key").alias("keys"))
    # an outer join, as the one that follows, so that the two share one shuffle of the texts
    return packed.join(wanted, "id", "left").select("id", "packed", "keys", *packed.columns[1:-1]).mapInArrow(
        _segments(SHARDS * width, length, gram), "part int, kind int, docs binary, begins binary, sizes binary, data binary"
    )


def repeated_spans(texts: DataFrame, packed: DataFrame, length: int = LENGTH, gram: int = GRAM, memory: int = induced.MEMORY, most: int = MOST) -> DataFrame:
    """``id, begin, end``: byte spans of ``texts`` (id, text) that repeat an earlier document; they may overlap.

    ``packed`` holds the same rows ``squeezed``; its columns between id and text are not looked at.
    """
    dealt = dealt_segments(texts, packed, length, gram, most)
    return dealt.groupBy("part").applyInArrow(_shard(length, memory), "id long, begin long, end long")


def _cut(as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                size, gone, number, kept = [], [], [], []
                for text, spans in zip(_texts(part.column(0)), part.column(1).to_pylist()):
                    size.append(len(text))
                    if not spans:
                        gone.append(0), number.append(0), kept.append(text)
                        continue
                    begin, end = (np.array([s[k] for s in spans], np.int64) for k in ("begin", "end"))
                    _, begin, end = _merged(np.zeros(len(begin), np.int64), begin, end)
                    gone.append(int((end - begin).sum())), number.append(len(begin))
                    kept.append(b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(text)])))
                if as_text:
                    kept = [k.decode("utf-8", "ignore") for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[2:], pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(number, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary())],
                    [*batch.schema.names[2:], "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return run


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = (), *, as_text: bool = False, memory: int = induced.MEMORY, most: int = MOST
) -> DataFrame:
    """``n_bytes, n_removed, n_spans, kept`` of each document, after its id and the columns ``keep``.

    ``kept`` holds the remaining bytes; with ``as_text`` a string without the characters that lost some of their bytes.
    A null text counts as empty. Ids are meant to be unique: rows that share an id should share the text, and never count
    as earlier than each other. A row with a null id keeps its text and is no source. Ties cannot occur between different
    ids. An empty table gives an empty result; columns not named are not read.
    """
    id_, text = F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")
    packed = squeezed(docs.select(id_, *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], text))
    found = repeated_spans(docs.select(id_, text), packed, length, memory=memory, most=most)
    spans = found.groupBy("id").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    own = [F.col("id").cast(docs.schema[id_column].dataType).alias(id_column), *[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)]]
    joined = packed.join(spans, "id", "left").select("packed", "spans", *own)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[2:])
    return joined.mapInArrow(_cut(as_text), f"{fields}, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}")
