"""Language identification: n-grams against plain Python, held-out accuracy, rejection, and odd tables."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from editsieve.llm import languages
from tests.llm.data import DOCS, corpus


def plain(text):
    data = (text or "").lower().encode()
    out, at = bytearray(b" "), 0
    while at < len(data):
        end = at
        while end < len(data) and (data[end] >= 0x80 or chr(data[end]).isalnum()):
            end += 1
        run = data[at:end]
        out += b" " * len(run) if any(0x30 <= b < 0x3A for b in run) else run
        if end < len(data):
            out += b" "
        at = end + 1
    out += b" "
    found = Counter()
    for n in languages.ORDERS:
        for k in range(len(out) - n + 1):
            gram = bytes(out[k : k + n])
            if gram[:2] != b"  " and gram[-2:] != b"  ":
                code = (int.from_bytes(gram, "big") * 0x9E3779B1 + n * 0x85EBCA6B) % 2**32
                found[code >> 32 - languages.BUCKETS.bit_length() + 1] += 1
    return found


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_grams_as_in_plain_python(monkeypatch, piece):
    monkeypatch.setattr(languages, "_BYTES", piece)
    texts = ["Ab cd, ÉÜ!", None, "", "x", "  a  b ", "key=2abc3ff2 ab12 34", "漢字 ab", *[t for _, t in corpus(size=4) if t and len(t) < 3000]]
    got = languages.grams(pa.array(texts))
    for row, text in zip(got, texts, strict=True):
        assert {int(k): int(row[k]) for k in np.flatnonzero(row)} == plain(text)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = languages.held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    right = [r["lang_pred"] == r["lang"] for r in got if r["held_out"]]
    assert len(right) > 2000 and np.mean(right) >= 0.995
    assert all(0 <= r["score"] <= 1 for r in got)


def test_clusters_are_kept_apart():
    random = np.random.default_rng(1)
    base = np.abs(random.standard_normal((3, 40)))
    x = np.concatenate([b + 0.05 * random.random((20, 40)) for b in base])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres, own = languages.clustered(x, 3)
    assert len(centres) == 3 and [len(set(own[k : k + 20])) for k in (0, 20, 40)] == [1, 1, 1] and len(set(own)) == 3
    assert np.allclose(np.linalg.norm(centres, axis=1), 1)
    same = np.repeat(x[:1], 5, axis=0)
    assert len(set(languages.clustered(same, 4)[1])) == 1


def test_far_texts_are_rejected(spark):
    rows = [(k, f"the cat and the dog number {'and the ' * (k % 7)}", "en", "s", 1) for k in range(60)]
    rows += [(100 + k, f"le chat et le chien avec {'et le ' * (k % 7)}", "fr", "s", 1) for k in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    model = languages.fit(docs, "doc_id", "text", "lang")
    asked = spark.createDataFrame([(1, "the cat and the dog number and the and the and the", None, None, 0), (2, "zzyzx qwxk jjqv", None, None, 0), (3, "123", None, None, 0)], DOCS)
    got = {r["doc_id"]: r for r in languages.identify(asked, model, reject=True).collect()}
    assert (got[1]["lang_pred"], got[2]["lang_pred"], got[3]["lang_pred"]) == ("en", "und", "und")
    assert got[2]["is_far"] and got[3]["score"] == 0
    assert {r["doc_id"]: r["lang_pred"] for r in languages.identify(asked, model).collect()}[2] in ("en", "fr")


def test_odd_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert languages.held_out(none).collect() == []
    rows = [(k, t, ["en", "de", None][k % 3] if k is not None else "en", "s", 1) for k, t in corpus(size=30)]
    rows += [(None, "some text", "en", "s", 1), (950, None, "en", "s", 1), (951, "1234 -- 99", "en", "s", 1), *rows[:9]]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for name in ("id", "chosen", "bucket", "place", "lang_pred", "score", "bound", "held_out", "of"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = languages.held_out(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    silent = {k for k, t, *_ in rows if not t or not any(c.isalpha() for c in t)}
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if r["doc_id"] not in silent:
            assert r["lang_pred"] in ("en", "de") and 0 <= r["score"] <= 1
    assert {(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (900, 901, 902)} == {("und", 0.0)}
    unlearned = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in languages.held_out(unlearned).collect()} == {"und"}
    prefixed = {r["doc_id"]: r["lang_pred"] for r in got}
    swapped = docs.withColumn("source", F.lit("other")).filter(languages.fold("doc_id") == 2).withColumn("lang", F.lit("xx"))
    again = languages.held_out(docs.filter(languages.fold("doc_id") != 2).unionByName(swapped)).collect()
    assert all(r["lang_pred"] == prefixed[r["doc_id"]] for r in again if r["held_out"])
