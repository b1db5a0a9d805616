"""Brute-force versions of the operators, straight from their definitions."""

from __future__ import annotations

import re
from fractions import Fraction

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def order(key):
    return LAST if key is None else key


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def repeated_words(rows, window=13):
    """(id, n_words, n_removed, kept) of every row."""
    first = {}
    docs = [(i, WORDS.findall(t or "")) for i, t in rows]
    for i, words in docs:
        for a in range(len(words) - window + 1):
            k = tuple(words[a : a + window])
            first[k] = min(first.get(k, LAST), order(i))
    out = []
    for i, words in docs:
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            if first[tuple(words[a : a + window])] < order(i):
                gone[a : a + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), kept))
    return out


def repeated_bytes(rows, length=100):
    """(id, n_bytes, n_removed, n_spans, kept) of every row."""
    first = {}
    docs = [(i, (t or "").encode()) for i, t in rows]
    for i, data in docs:
        for a in range(len(data) - length + 1):
            k = data[a : a + length]
            first[k] = min(first.get(k, (LAST, LAST)), (order(i), a))
    out = []
    for i, data in docs:
        gone = [False] * len(data)
        for a in range(len(data) - length + 1):
            if first[data[a : a + length]] < (order(i), a):
                gone[a : a + length] = [True] * length
        spans = sum(g and not (a and gone[a - 1]) for a, g in enumerate(gone))
        out.append((i, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def shingles(text, n):
    words = WORDS.findall(lower(text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[a : a + n]) for a in range(len(words) - n + 1)}


def linked(rows, n, threshold: Fraction):
    """(id, n_shingles, component_id) of every row, and the component number of every row."""
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) * threshold.denominator >= len(a | b) * threshold.numerator:
                up[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), LAST), order(key))
    found = [least[root(i)] for i in range(len(rows))]
    return [(k, len(s), None if f == LAST else f) for (k, _), s, f in zip(rows, sets, found)], [root(i) for i in range(len(rows))]


def occurs(item: bytes, text: bytes, limit: int) -> int | None:
    """Fewest edits of an occurrence of the item in the text, if at most the limit."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row) if min(row) <= limit else None
