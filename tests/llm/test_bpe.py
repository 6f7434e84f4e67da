import hashlib
import heapq
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tablexport.llm import bpe
from tests.llm import helpers

NAME = "byte_bpe_multi_50k.tiktoken"
ODD = [*" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0᠎ 　abAB'stre.,!0123456789éß漢字́😀﻿aaaa   "]


@pytest.fixture(scope="module")
def own():
    return bpe.load(NAME)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def test_rank_queue_against_a_heap():
    rnd = random.Random(3)
    queue, heap = bpe.RankQueue(50_000), []
    for _ in range(5_000):
        if heap and rnd.random() < 0.5:
            assert queue.pop() == heapq.heappop(heap)
        else:
            entry = (rnd.choice([rnd.randrange(50_000), rnd.randrange(70)]), rnd.randrange(1000))
            heapq.heappush(heap, entry)
            queue.push(*entry)
    while heap:
        assert queue.pop() == heapq.heappop(heap)
    assert queue.pop() is None


def test_random_texts_as_the_library(own, library):
    rnd = random.Random(1)
    for _ in range(3_000):
        text = "".join(rnd.choice(ODD) for _ in range(rnd.randrange(40)))
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_very_long_pre_tokens(own, library):
    rnd = random.Random(2)
    for text in ("a" * 5_000, "ab" * 3_000 + "é" * 500, "".join(rnd.choice("abcdefgh") for _ in range(8_000)), "=" * 3_001, " " * 2_000 + "x"):
        assert own.encode(text) == library.encode_ordinary(text)


def test_blocks_hold_the_whole_text_and_no_pre_token_crosses_them(library):
    rnd = random.Random(4)
    for _ in range(300):
        text = "".join(rnd.choice(ODD) for _ in range(200))
        parts = list(bpe.blocks(text, 10))
        assert "".join(parts) == text
        assert [i for p in parts for i in library.encode_ordinary(p)] == library.encode_ordinary(text)


def test_documents_null_empty_and_repeated(spark, library):
    rows = [(d["doc_id"], d["text"]) for d in helpers.documents()] + [(None, None), (-1, ""), (-2, " "), (-2, " ")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_tokens string")
    out = df.select("doc_id", bpe.digests(F.col("text"), NAME).alias("t")).select("doc_id", "t.*").collect()
    expected = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=repr) == sorted(expected, key=repr)
    assert df.limit(0).select(bpe.digests(F.col("text"), NAME)).count() == 0


def test_ids_as_arrays(spark, library):
    df = spark.createDataFrame([(0, "Hello, wörld"), (1, None)], "doc_id int, text string")
    got = {r[0]: r[1] for r in df.select("doc_id", bpe.ids(F.col("text"), NAME)).collect()}
    assert got == {0: library.encode_ordinary("Hello, wörld"), 1: []}
