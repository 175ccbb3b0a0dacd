"""Spelling variants against plain Python: counts, taken-out letters, near words, forms and roots."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from editsieve.llm import spelling
from tests.llm.data import DOCS, corpus, documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def counted(rows):
    out = Counter()
    for number, text in rows:
        for word in RUN.findall(text or ""):
            word = word.translate(LOWER)
            check = zlib.crc32(f"{number}:{word}".encode())
            if number is not None and check % 199 == 0:
                at = check % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 6:
                out[word] += 1
    return {w: n for w, n in out.items() if n >= 5}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(rows):
    n = counted(rows)
    shared = defaultdict(set)
    for w in n:
        for k in range(len(w) + 1):
            shared[w[:k] + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for group in shared.values():
        for a in group:
            near[a] |= {b for b in group if a != b and b not in near[a] and one_apart(a, b)}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 5 * n[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def mistyped(seed=3, size=150):
    """Words of very different frequency with typos of typos, letters beyond ASCII, anagrams and long words."""
    r = random.Random(seed)
    letters = "abcdeéüÿÀ"
    words = ["".join(r.choices(letters, k=r.randint(5, 9))) for _ in range(40)] + ["straße", "abcdef", "fedcba", "bacdef", "x" * 300, "x" * 301]
    rows = []
    for number in range(size):
        out = []
        for _ in range(60):
            w = words[min(int(r.expovariate(0.1)), len(words) - 1)]
            for _ in range(r.choice([0, 0, 0, 0, 1, 1, 2])):
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice("ab") + w[at:], w[:at] + r.choice("ab") + w[at + 1 :]])
            out.append(r.choice([w, w.upper() if w.isascii() else w, w.capitalize() if w.isascii() else w]))
        rows.append((number, r.choice([" ", "-", "1", "漢", "­"]).join(out)))
    return [*rows, (size, "chained " * 160 + "chainet " * 30 + "chaimet " * 5)]


@pytest.mark.parametrize("tile", [2048, 16])
def test_same_as_plain_python(spark, tile):
    rows = mistyped()
    got = spelling.variants(documents(spark, rows), tile=tile)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = expected(rows)
    assert any(w[1] and w[2] != w[1] for w in want)  # a chain of forms
    assert {tuple(r) for r in got.collect()} == want


def test_odd_tables(spark):
    rows = [*corpus(size=20), *corpus(size=20), (None, "nullword " * 7), (7, "NULLWORT×÷ " * 9 + "¿" * 9)]
    docs = documents(spark, rows)
    for name in ("word", "n", "size", "key", "tile", "data", "form", "root", "best"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = spelling.variants(docs)
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected(rows))
    none = spark.createDataFrame([], DOCS)
    assert spelling.variants(none).collect() == []
    assert spelling.variants(documents(spark, [(1, None), (2, ""), (3, "short word 12345678")])).collect() == []


def test_checksums_of_all_lengths():
    texts = pa.array(["a", "Über " * 3, "z" * 63 + " " + "y" * 64 + " " + "w" * 65 + " " + "v" * 5000, ""])
    found, length = spelling.letter_runs(texts)
    ids = [3, -12, 2**62, 5]
    words = [found.data[a:b].tobytes() for a, b in zip(found.start, found.end, strict=True)]
    assert length.tolist() == [len(w.decode()) for w in words]
    assert spelling.checksums(found, ids).tolist() == [zlib.crc32(b"%d:%s" % (ids[k], w)) for k, w in zip(found.row, words, strict=True)]


def test_blocks_meet_as_one_product():
    r = random.Random(1)
    sides = []
    for length in (7, 8):
        words = sorted({"".join(r.choices("abÿ", k=length)) for _ in range(60)})
        sides.append(spelling.Block(pa.table({"word": words, "n": np.ones(len(words), np.int64)})))
    one, two = sides
    counts = [[Counter(w) for w in s.words.to_pylist()] for s in sides]
    want = [[sum((x[c] - y[c]) ** 2 for c in "abÿ") for y in counts[1]] for x in counts[0]]
    assert spelling.squared_distances(one, two).tolist() == want
    for left, right, same in ((one, two, False), (one, one, True)):
        a, b = spelling.near_pairs(left, right, same)
        x, y = left.words.to_pylist(), right.words.to_pylist()
        assert sorted(zip(a, b, strict=True)) == [(i, j) for i in range(len(x)) for j in range(len(y)) if one_apart(x[i], y[j]) and (i < j or not same)]
