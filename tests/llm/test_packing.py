"""Packing: every token once, sequences without gaps, patterns close to the bound."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from editsieve.llm import packing
from tests.llm.data import DOCS, corpus, documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("length", [2048, 64])
def test_every_token_lies_in_one_piece(spark, length):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = [*corpus(), (3000, "a <|endoftext|> b"), (3001, "ǅ ʼn 漢   x"), (3002, "don't  stop\n\n")]
    docs = documents(spark, rows).withColumn("start", F.lit("clash"))
    got, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, VOCABULARY, length=length).collect():
        got[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for number, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(got.pop(number), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not got
    for held in sequences.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= length


def test_nulls_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (2, None)], "doc_id long, text string")
    got = packing.pack(docs, VOCABULARY).collect()
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in got) == [("1", 3), ("1", 3), ("2", 1), ("None", 2)]
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 4
    assert packing.pack(spark.createDataFrame([], DOCS), VOCABULARY).collect() == []


def test_patterns_hold_the_demand_and_come_close_to_the_bound():
    random = np.random.default_rng(3)
    demand = np.zeros(129, np.int64)
    np.add.at(demand, random.integers(1, 128, 60_000), 1)
    demand[128] = 500
    found = packing.patterns(demand, 128)
    total = sum(pattern * times for pattern, times in found)
    assert (total == demand).all()
    assert all((pattern * np.arange(129)).sum() <= 128 for pattern, _ in found)
    bound = (demand * np.arange(129)).sum() / 128
    assert sum(times for _, times in found) <= 1.01 * bound + 130


def test_knapsack_is_the_best_of_all():
    kinds, worth = np.array([3, 4, 5]), np.array([2.0, 3.0, 4.1])
    best = max(
        a * 2 + b * 3 + c * 4.1
        for a in range(5) for b in range(5) for c in range(5) if 3 * a + 4 * b + 5 * c <= 13
    )
    assert packing.knapsack(kinds, worth, 13) @ worth == pytest.approx(best)


def test_one_class_gets_dense_ranks(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "0L AS start", "id AS ids_crc32", "1 AS _kind")
    got = packing.ranks(rows, 5000)
    assert sorted(r["_rank"] for r in got.collect()) == list(range(5000))
