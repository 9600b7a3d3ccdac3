"""License scans: an exact set-similarity join of text blocks with license templates.

A block matches a template when it holds at least ``THRESHOLD`` of the template's distinct words. Words are ordered by
their global document frequency, the rarest first. A match must share one of the template's first
``size - needed + 1`` words (prefix filter), hold enough template words (length filter), and still be able to reach the
needed overlap from the place where the shared word stands in both (positional filter). What is left is verified on the
full sets, so nothing that meets the threshold is missed.

Blocks are the lines of a text and its paragraphs (lines between blank ones). Any long enough paragraph holds the words of
a short notice somewhere, so a paragraph of more than ``PARAGRAPH_RATIO`` times the template's size counts only where
consecutive words of it, at most ``WINDOW_RATIO`` times that size in different ones, meet the template, and as a block of
its own only if none of its lines meets it. Of two templates, one of which holds all words of the other, the smaller counts where it is met
by consecutive words that do not meet the wider.

The SQL twin knows no windows of words: it passes over long paragraphs, and over the smaller template in the whole block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import spans as S

THRESHOLD = 0.9
PARAGRAPH_RATIO = 4
#: Different words of a window in a longer paragraph: as many others as the template has. At 4 times its size a line with
#: one notice and a chance word of the prose beside it ("mit") met another template in 3 of 10,000 documents of sf0.1.
WINDOW_RATIO = 2
#: Templates travel to every task, so their number has a bound.
MAX_TEMPLATES = 20_000
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_PARAGRAPH = re.compile(rb"\n[ \t\x0b\x0c\r]*\n")

#: Phrases and their labels.
PHRASES: list[tuple[str, str]] = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Public license notices and their labels.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "Licensed under the GNU Lesser General Public License."),
    ("agpl", "Licensed under the GNU Affero General Public License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights; dedicated to the public domain under CC0 1.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("proprietary", "All rights reserved. Unauthorized copying of this file is strictly prohibited."),
]


def words(text: bytes) -> list[bytes]:
    """A-Z lower-cased, then the runs of letters, digits and bytes beyond ASCII."""
    return WORD.findall(text.lower())


def template_sets(templates: Sequence[tuple[str, str]]) -> list[tuple[str, frozenset[bytes]]]:
    found = [(label, frozenset(words(text.encode()))) for label, text in templates]
    return sorted({t for t in found if t[1]}, key=lambda t: (t[0], sorted(t[1])))


def needed(size: int, threshold: float) -> int:
    """Words a block must share with a template of ``size`` words."""
    return max(1, ceil(threshold * size - 1e-9))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    for part in S.slices(batch.column(1)):
        raw = part.data.tobytes()
        for i in range(part.rows):
            yield part.first + i, raw[part.at[i] : part.at[i + 1]]


def word_frequencies(docs: DataFrame, vocabulary: frozenset[bytes], text_column: str = "text") -> dict[bytes, int]:
    """Documents that hold each word of the templates, counted over the whole table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for _, text in _texts(batch):
                seen.update(vocabulary.intersection(words(text)))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

    narrow = docs.select(F.lit(0).alias("_"), F.col(text_column).cast("string").alias("text"))
    counts = narrow.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counts.collect()}  # at most one row per template word


class TemplateIndex:
    """Prefix index over the templates under one global order of words."""

    def __init__(self, templates: list[tuple[str, frozenset[bytes]]], frequency: dict[bytes, int], threshold: float) -> None:
        self.templates = templates
        self.need = [needed(len(t), threshold) for _, t in templates]
        vocabulary = frozenset().union(*[t for _, t in templates])
        order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.vocabulary = vocabulary
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for i, (_, t) in enumerate(templates):
            for at, w in enumerate(sorted(t, key=self.rank.__getitem__)[: len(t) - self.need[i] + 1]):
                self.prefix.setdefault(w, []).append((i, at))
        self.least = min(self.need, default=0)
        #: Templates that hold all words of a template and more
        self.wider = [frozenset(j for j, (_, o) in enumerate(templates) if t < o) for _, t in templates]

    def narrowed(self, found: dict[int, float], own: list[bytes]) -> dict[int, float]:
        """Without the templates that the block's words meet only together with a wider one found."""
        return {i: c for i, c in found.items() if self.wider[i].isdisjoint(found) or self.window(i, own)}

    def window(self, i: int, own: list[bytes], most: int | None = None) -> float:
        """Highest containment of template ``i`` in consecutive words, ``most`` different ones, that meet no wider one; or 0.

        Looks at the windows that cannot lose a word at either end; any other holds one of them. Where ``most`` leaves
        room the containment is that of the window grown by what still fits on its left.
        """
        t, need = self.templates[i][1], self.need[i]
        wider = [(self.templates[j][1], self.need[j]) for j in self.wider[i]]
        inside: Counter[bytes] = Counter()
        held = left = 0
        best = 0.0
        there = len(t.intersection(own))  # no window holds more of the template
        for right, word in enumerate(own):
            inside[word] += 1
            held += word in t and inside[word] == 1
            while own[left] not in t or inside[own[left]] > 1 or held > need:
                first = own[left]
                if first in t and inside[first] == 1:
                    held -= 1
                inside[first] -= 1
                if not inside[first]:
                    del inside[first]
                left += 1
                if left > right:
                    break
            if held < need or word not in t or (most is not None and len(inside) > most):
                continue
            if any(len(o & inside.keys()) >= n for o, n in wider):
                continue
            best = max(best, self._grown(i, own, left, right, most, wider, there))
            if best == there / len(t):
                break
        return best

    def _grown(self, i: int, own: list[bytes], left: int, right: int, most: int | None, wider: list, there: int) -> float:
        """Containment when the window takes in neighbouring words, the right ones first, as long as it stays allowed."""
        t, seen = self.templates[i][1], set(own[left : right + 1])
        limit = most if most is not None else PARAGRAPH_RATIO * len(t)
        for steps in (range(right + 1, len(own)), range(left - 1, -1, -1)):
            for k in steps:
                grown = seen | {own[k]}
                if len(t & seen) == there or len(grown) > limit or any(len(o & grown) >= n for o, n in wider):
                    break
                seen = grown
        return len(t & seen) / len(t)

    def matches(self, known: set[bytes]) -> dict[int, float]:
        """Template to containment, of those that a block with these template words meets."""
        if len(known) < self.least or self.prefix.keys().isdisjoint(known):
            return {}
        ordered = sorted(known, key=self.rank.__getitem__)
        possible: set[int] = set()
        for j, w in enumerate(ordered):
            for i, at in self.prefix.get(w, ()):
                size = len(self.templates[i][1])
                # the first shared word: at most this many can follow on either side
                if i not in possible and len(ordered) >= self.need[i] and 1 + min(size - at - 1, len(ordered) - j - 1) >= self.need[i]:
                    possible.add(i)
        out = {}
        for i in possible:
            t = self.templates[i][1]
            shared = len(t & known)
            if shared >= self.need[i]:
                out[i] = shared / len(t)
        return out


def blocks(text: bytes) -> Iterator[tuple[bytes, bool]]:
    """Lines, and paragraphs of several lines (True)."""
    for paragraph in _PARAGRAPH.split(text):
        lines = paragraph.split(b"\n")
        for line in lines:
            yield line, False
        if len(lines) > 1:
            yield paragraph, True


def _scan(index: TemplateIndex, phrases: list[tuple[list[bytes], str]]):
    ends = {p[-1] for p, _ in phrases}

    def one(text: bytes) -> dict:
        seen = words(text)
        known = index.vocabulary.intersection(seen)
        places, base = [], set()
        if not ends.isdisjoint(seen):
            for i, w in enumerate(seen):
                if w in ends:
                    for phrase, label in phrases:
                        at = i - len(phrase) + 1
                        if at >= 0 and seen[at : i + 1] == phrase:
                            places.append(at)
                            base.add(label)
        labels, score, n_blocks = set(base), 1.0 if base else 0.0, 0
        if index.matches(known):  # a block holds no more than its document
            for block, paragraph in blocks(text):
                own = words(block)
                held = index.vocabulary.intersection(own)
                found = index.matches(held)
                if paragraph and found:
                    size = len(set(own))
                    most = {i: PARAGRAPH_RATIO * len(index.templates[i][1]) for i in found}
                    near = index.narrowed({i: c for i, c in found.items() if size <= most[i]}, own)
                    far = {i: index.window(i, own, WINDOW_RATIO * len(index.templates[i][1])) for i in found if size > most[i]}
                    if any(far.values()):
                        for line in block.split(b"\n"):
                            own = words(line)
                            for i in index.narrowed(index.matches(index.vocabulary.intersection(own)), own):
                                far.pop(i, None)
                    found = near | {i: c for i, c in far.items() if c}
                else:
                    found = index.narrowed(found, own)
                n_blocks += bool(found)
                labels.update(index.templates[i][0] for i in found)
                score = max([score, *found.values()])
        return {
            "n_words": len(seen), "n_base": len(places),
            "first_word": min(places, default=None), "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": score, "n_blocks": n_blocks,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "n_blocks": pa.int64()}
        for batch in batches:
            rows = [one(text) for _, text in _texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in rows], t) for k, t in kinds.items()]], [batch.schema.names[0], *kinds])

    return run


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES),
    phrases: Sequence[tuple[str, str]] = tuple(PHRASES),
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Labels of each document: id, ``n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks``.

    ``n_base`` counts the places where the words of a phrase stand consecutively, ``labels`` adds those of templates
    met by a block, ``n_blocks`` counts such blocks, and ``score`` is the highest containment (1 where a phrase stands,
    0 without a match). A null or empty text has no words and no labels ('' and null places). Rows are independent, so
    repeated rows and null ids give one row each; an empty table gives an empty result; other columns are not read.
    """
    sets = template_sets(templates)
    if len(sets) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates")
    vocabulary = frozenset().union(*[t for _, t in sets])
    index = TemplateIndex(sets, word_frequencies(docs, vocabulary, text_column), threshold)
    narrow = docs.select(F.col(id_column), F.col(text_column).cast("string"))
    kind = narrow.schema[0].dataType.simpleString()
    out = f"`{id_column}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_blocks long"
    return narrow.mapInArrow(_scan(index, [(words(p.encode()), label) for p, label in phrases]), out)


def oracle() -> str:
    """The same result by comparing every block with every template."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    every = template_sets(TEMPLATES)
    wider = [[j for j, (_, o) in enumerate(every) if t < o] for _, t in every]
    sets = ",\n".join(f"({i}, {q(label)}, [{', '.join(q(w.decode()) for w in sorted(t))}], {needed(len(t), THRESHOLD)}, {wider[i]}::INTEGER[])" for i, (label, t) in enumerate(every))
    starts = " || ".join(
        f"list_transform(list_filter(range(1, len(words) + 1), lambda i: words[i:i+{len(p.split()) - 1}] = [{', '.join(map(q, p.split()))}]), lambda i: {{'at': i - 1, 'label': {q(label)}}})"
        for p, label in PHRASES
    )
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""WITH t(t, label, tokens, need, wider) AS (VALUES {sets}),
    d AS (SELECT row_number() OVER () AS r, doc_id, {low.format("coalesce(text, '')")} AS text FROM documents),
    w AS (SELECT r, doc_id, regexp_extract_all(text, '{word}') AS words FROM d),
    p AS (SELECT r, unnest(string_split_regex(text, '\n[ \t\x0b\x0c\r]*\n')) AS par FROM d),
    b AS (SELECT r, unnest(string_split(par, chr(10))) AS block, false AS many FROM p
      UNION ALL SELECT r, par, true FROM p WHERE contains(par, chr(10))),
    s AS (SELECT r, row_number() OVER () AS b, list_distinct(regexp_extract_all(block, '{word}')) AS own, many FROM b),
    every AS (SELECT r, b, t, label, wider, len(list_intersect(tokens, own)) / len(tokens) AS score FROM s, t
      WHERE len(own) >= need AND len(list_intersect(tokens, own)) >= need
        AND (NOT many OR len(own) <= {PARAGRAPH_RATIO} * len(tokens))),
    m AS (SELECT * FROM every a WHERE NOT EXISTS (SELECT 1 FROM every o WHERE o.b = a.b AND list_contains(a.wider, o.t))),
    found AS (SELECT r, list(DISTINCT label) AS labels, max(score) AS score, count(DISTINCT b) AS n_blocks FROM m GROUP BY r),
    base AS (SELECT r, doc_id, len(words) AS n_words, {starts} AS places FROM w)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
      CAST(list_min(list_transform(places, lambda x: x['at'])) AS BIGINT) AS first_word,
      CAST(list_max(list_transform(places, lambda x: x['at'])) AS BIGINT) AS last_word,
      array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x['label']))), ',') AS base_labels,
      coalesce(array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x['label']) || coalesce(labels, []))), ','), '') AS labels,
      CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(score, 0) END::DOUBLE AS score,
      coalesce(n_blocks, 0) AS n_blocks FROM base LEFT JOIN found USING (r)"""
