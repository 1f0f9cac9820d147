import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from popspark.llm import byte_bpe

SAMPLES = [
    "",
    " ",
    "a",
    "  two  spaces ",
    "line\nbreak\n\n and  tabs\t\tend \n",
    "I'll we've don't it's 'S",
    "Éçole über ñandú 12345 ½ ²³",
    "中文　全角 \U0001f600\U0001f468‍\U0001f469",
    "a \x1c\x1cb \x85\x85 \xa0\xa0c",
    "of,%%% and*** [[x]] <|endoftext|>",
    "x" * 5000,
    "=" * 3001 + " " * 777 + "ab" * 999,
]


@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(text):
    return np.frombuffer(byte_bpe.codec().encode(text), "<u4").tolist()


@pytest.mark.parametrize("text", SAMPLES)
def test_same_ids_as_the_library(reference, text):
    assert ids(text) == reference.encode_ordinary(text)


def test_random_texts(reference):
    rng = random.Random(3)
    alphabet = ["a", "e", "th", "é", " ", " ", "  ", "\n", "\t", "1", "'s", "!", " ", "中", "\U0001f600", "\x1c", "ß"]
    for _ in range(400):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
        got = byte_bpe.codec().encode(text)
        assert np.frombuffer(got, "<u4").tolist() == reference.encode_ordinary(text), repr(text)
        assert byte_bpe.codec().decode(got) == text.encode()


def test_merge_piece_is_leftmost_lowest_rank():
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"ab": 3, b"aab": 4}
    assert byte_bpe.merge_piece(b"aaab", ranks) == [2, 3]
    assert byte_bpe.merge_piece(b"aab", {**ranks, b"aab": 4}) == [4]
    assert byte_bpe.merge_piece(b"aaaaa", ranks) == [2, 2, 0]


def test_full_cache_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_LIMIT", 3)
    bpe = byte_bpe.ByteBpe(reference._mergeable_ranks, public_tokenizers.PATTERN)
    text = "one two three four five one two three " * 20
    assert np.frombuffer(bpe.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_operator_cases(spark):
    rows = [(1, "Some text", "x"), (2, None, "x"), (2, "", "x"), (None, "Some text", None), (1, "Some text", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r.doc_id or 0), r.n_tokens, r.decoded_sha256) for r in byte_bpe.round_trip(df).collect())
    full = hashlib.sha256(b"Some text").hexdigest()
    none = hashlib.sha256(b"").hexdigest()
    assert got == [(0, 2, full), (1, 2, full), (1, 2, full), (2, 0, none), (2, 0, none)]
    assert byte_bpe.round_trip(df.limit(0)).collect() == []


def test_query_against_the_library(spark, reference):
    out = {r.doc_id: r for r in byte_bpe.op1_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(out) == len(docs)
    for d in docs:
        want = np.array(reference.encode_ordinary(d.text), "<u4").tobytes()
        r = out[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(want) // 4, hashlib.sha256(want).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()
