"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def near_documents(docs, percent=85):
    """doc_id to (number of shingles, component)."""
    sets = {i: shingles(t) for i, t in docs}
    shared, holders = defaultdict(int), defaultdict(list)
    for i, s in sets.items():
        for g in s:
            for j in holders[g]:
                shared[j, i] += 1
            holders[g].append(i)
    links = [p for p, n in shared.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    found = components(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}


def near_vectors(vectors, cosine=0.95):
    """vec_id to (links, component); a vector that is None links with nothing."""
    good = {i: v for i, v in vectors if v is not None}
    links = []
    ids = sorted(good)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = good[i], good[j]
            if len(a) == len(b) and sum(x * y for x, y in zip(a, b)) >= cosine * (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5:
                links.append((i, j))
    found = components([i for i, _ in vectors], links)
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {i: (count[i], found[i]) for i, _ in vectors}


def without_repeats(docs, length=50):
    """doc_id to (bytes, bytes removed, spans, remaining bytes)."""
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


def pieces(processor, text):
    """(number of ids, digest of ids, digest of what they decode to) by the library itself."""
    ids = processor.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(processor.decode(ids).encode()).hexdigest()
