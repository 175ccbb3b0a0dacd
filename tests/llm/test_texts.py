"""Windows, shingle classes, pieces and scores against plain Python, with the awkward cases."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from editsieve.llm import jaccard, pieces, pitmanyor, substrings
from editsieve.llm.components import components
from tests.llm import brute
from tests.llm.data import DOCS, corpus, documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows)


def test_windows_are_removed_as_by_hand(docs, rows):
    got = {r["doc_id"]: r for r in substrings.remove_repeated(docs).collect()}
    assert len(got) == len(rows)
    for number, w, gone in brute.kept_words(rows):
        r = got[number]
        assert (r["n_words"], r["n_removed"]) == (len(w), len(gone))
        assert r["text"] == " ".join(x for k, x in enumerate(w) if k not in gone)
        assert r["lang"] == "en"


def test_windows_of_null_ids_repeated_rows_and_clashing_columns(spark):
    text = " ".join(f"w{k}" for k in range(20))
    rows = [(1, text), (1, text), (None, text), (None, "short"), (0, "other " + text[:30])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("chunk", "data", "n_words", "part")})
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"], r["chunk"]) for r in substrings.remove_repeated(df).collect())
    want = sorted((n is None, n or 0, len(w), len(gone), 7) for n, w, gone in brute.kept_words(rows))
    assert got == want
    empty = substrings.remove_repeated(df.limit(0))
    assert empty.collect() == [] and set(empty.columns) >= {"doc_id", "text", "n_words", "n_removed"}


def test_classes_are_those_of_all_pairs(docs, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.classes(docs).collect()}
    assert got == brute.components(rows)


def test_classes_without_frequent_signatures_left_out(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 2)  # every larger bucket takes the other way
    monkeypatch.setattr(jaccard, "MASK_BYTES", 0)  # and chunks are shuffled to what is asked of them
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.classes(docs).collect()}
    assert got == brute.components(rows)


def test_classes_of_null_ids_repeated_rows_and_no_rows(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "q r s t u v"), (5, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1))
    got = sorted(jaccard.classes(df).collect(), key=str)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"]) == [(3, 2, 3), (3, 2, 3), (5, 0, 5)]
    assert sorted((r["n_shingles"], str(r["component_id"])) for r in got if r["doc_id"] is None) == [(0, "None"), (2, "3"), (2, "None")]
    assert jaccard.classes(df.limit(0)).collect() == []


@pytest.mark.parametrize("size", [3, 5, 8, 9, 16, 17, 33, 64, 100, 400])
def test_sets_at_the_threshold_share_a_signature(size):
    random = np.random.default_rng(size)
    for _ in range(60):
        other = random.integers(-(-4 * size // 5), size * 5 // 4 + 1)
        common = -(-80 * (size + other) // 180)
        if common > min(size, other):
            continue
        pool = random.integers(0, 2**64, size + other - common, np.uint64)
        sets = [np.sort(pool[:size]), np.sort(pool[size - common :])]
        flat = jaccard.Sets(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
        signature, row, _ = jaccard.signatures(flat)
        assert np.intersect1d(signature[row == 0], signature[row == 1]).size
        sketch = [np.frombuffer(jaccard._sketch(s), np.uint8) for s in sets]
        assert jaccard._may_link(*sketch, sum(map(len, sets)), 80)


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_pieces_are_those_of_the_library(spark, docs, rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    odd = [" ", "  ", "▁", "▁▁x", "a" + " " * 45 + "b", "\n\n a\tb", "<s> </s> <unk>", "漢  字", "\x00 x", "the" * 400, "ab" * 300, "<0x0A>"]
    more = [*rows, *[(2000 + k, t) for k, t in enumerate(odd)]]
    got = {r["doc_id"]: r for r in pieces.encode_texts(documents(spark, more), MODEL).collect()}
    for number, text in more:
        want = library.encode(text or "")
        assert got[number]["ids"] == want, text and text[:50]
        assert got[number]["decoded"] == library.decode(want)
    digest = pieces.digests(pieces.encode_texts(documents(spark, more), MODEL)).filter("doc_id = 905").first()
    assert digest["ids_sha256"] == brute.sha(",".join(map(str, library.encode("a b c d"))))
    assert digest["n_tokens"] == len(library.encode("a b c d"))


def test_ids_decode_alone(spark):
    rows = [(1, [259, 260, 200]), (2, None), (3, []), (4, [0, 13]), (5, [1, 300, None, 2]), (6, [230, 3, 3])]
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r["k"]: r["decoded"] for r in pieces.decode_ids(spark.createDataFrame(rows, "k int, ids array<int>"), MODEL).collect()}
    for k, ids in rows:
        plain = [i for i in ids or [] if i is not None]
        assert got[k].lstrip(" ") == library.decode(plain).lstrip(" ") if k == 4 else got[k] == library.decode(plain)
    assert pieces.encode_texts(spark.createDataFrame([], DOCS), MODEL).collect() == []


def test_scores_have_exact_counts_and_learn(docs, rows):
    got = {r["doc_id"]: r for r in pitmanyor.score(docs).collect()}
    for number, want in brute.unigram(rows).items():
        r = got[number]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:4]
        assert r["base_score"] == pytest.approx(want[4], rel=1e-9)
        assert r["score"] < 0
    seen = [r for r in got.values() if not r["held_out"] and r["n_tokens"] > 20]
    assert all(r["score"] > r["base_score"] for r in seen)


def test_scores_with_spread_contexts_hold_the_same_counts(docs, rows, monkeypatch):
    monkeypatch.setattr(pitmanyor, "HEAVY_FROM", 20)
    monkeypatch.setattr(pitmanyor, "HEAVY_MOST", 10_000)
    got = {r["doc_id"]: r for r in pitmanyor.score(docs).collect()}
    for number, want in brute.unigram(rows).items():
        r = got[number]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:4]
        assert r["base_score"] == pytest.approx(want[4], rel=1e-9)


def test_scores_repeat_and_take_nulls(spark):
    rows = [(1, "a b a b"), (1, "a b"), (None, "c"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    first, second = (sorted(pitmanyor.score(df).collect(), key=str) for _ in range(2))
    assert first == second and len(first) == 5
    assert pitmanyor.score(df.limit(0)).collect() == []


def test_seating_keeps_to_its_bounds():
    random = np.random.default_rng(1)
    count = np.array([1, 2, 5, 70, 5000, 1_000_000, 1])
    tables = pitmanyor.seat(count, np.full(7, 1.0), np.full(7, 0.01), 0.8, random)
    assert (tables >= 1).all() and (tables <= count).all() and tables[0] == tables[6] == 1
    # one customer more at a time: two customers share a table with probability (1 - d) / (1 - d + strength parent + d parent)
    many = pitmanyor.seat(np.full(200_000, 2), np.full(200_000, 1.0), np.full(200_000, 0.1), 0.5, random)
    new = (1.0 + 0.5) * 0.1
    assert (many == 2).mean() == pytest.approx(new / (new + 0.5), abs=0.01)


def test_probabilities_of_a_context_sum_to_one():
    """Discounted counts, and the strength left for the parent, make up a restaurant's customers."""
    count = np.array([3, 1, 7])
    seating = pitmanyor.gibbs(np.zeros(3, int), np.arange(3), count, np.ones(1), 3, 1)
    held = (count - pitmanyor.DISCOUNT * seating.mean_tables).sum()
    left = pitmanyor.STRENGTH + pitmanyor.DISCOUNT * seating.mean_total[0]
    assert held + left == pytest.approx(pitmanyor.STRENGTH + count.sum())


def test_counts_of_frequent_pairs_are_answered_whole():
    table = pa.table({"id": pa.array([1], pa.int64()), "text": ["a b a c b c c"]})
    pairs = pitmanyor.pairs_of(table, np.zeros(0, np.uint64), 1)
    pairs.count[:] = np.array([1, 2, 4e7, 3e8, 2e10, 1e11, 3e12, 1e6])[np.arange(len(pairs.count)) % 8]
    names, n = len(pairs.names), len(pairs.count)
    data = pitmanyor.message(pairs.names, pairs, 0, n, 0, names)
    left = pa.table({"part": pa.array([0], pa.int32()), "chunk": pa.array([0], pa.int64()), "data": [data]})
    out = pitmanyor._answers(1, 0)(left.cast(pitmanyor.exchange.SENT), pa.table({}))
    read = pitmanyor.Read(out.column("data")[0].as_py())
    for kind, count in ((np.float64, 2), (np.uint64, names), (np.float32, names), (np.float32, names)):
        read(kind, count)
    value = pitmanyor.decoded(read, n)
    assert read.at == len(read.data)
    tables = pitmanyor.Part(0, [data], 1).seating.mean_tables
    assert value == pytest.approx(pairs.count - pitmanyor.DISCOUNT * tables, rel=3e-4)
