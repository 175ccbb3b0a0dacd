"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from math import log10

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
LAST = 2**63 - 1


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def kept_words(rows, window=13):
    """[(id, words, removed places)] in the order of ``rows``."""
    first = {}
    for number, text in rows:
        w = words(text)
        key = LAST if number is None else number
        for k in range(len(w) - window + 1):
            at = tuple(w[k : k + window])
            first[at] = min(first.get(at, LAST), key)
    out = []
    for number, text in rows:
        w, gone = words(text), set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (LAST if number is None else number):
                gone.update(range(k, k + window))
        out.append((number, w, gone))
    return out


def shingles(text, length=5):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + length]) for k in range(max(1, len(w) - length + 1)))


def components(rows, percent=80):
    """id -> (set size, smallest id reachable)."""
    sets = [(number, shingles(text)) for number, text in rows]
    parent = {number: number for number, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {number: (len(s), find(number)) for number, s in sets}


def unigram(rows, folds=7, held=2):
    """id -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    tokens = {number: [*words(text, lower=True), None] for number, text in rows}
    out = {number: zlib.crc32(str(number).encode()) % folds == held for number in tokens}
    counts = Counter(t for number, ts in tokens.items() if not out[number] for t in ts)
    total, types = sum(counts.values()), len(counts)
    return {
        number: (out[number], len(ts), sum(t in counts for t in ts), total, sum(log10((counts[t] + 1) / (total + types + 1)) for t in ts))
        for number, ts in tokens.items()
    }


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
