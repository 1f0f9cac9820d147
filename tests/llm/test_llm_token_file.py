import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from popspark.llm import token_file


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_same_ids_as_the_library(library, monkeypatch):
    rng = random.Random(3)
    alphabet = ["a", "E", "th", "é", " ", " ", "  ", "\n", "\t", "1", "'s", "'S", "!", " ", "中", "\U0001f600", "\x1c", "\x85", "\xa0", "ß", "Σ", "σ", "İ", "́", "<|endoftext|>", "ς", "ﬁ", "\r"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(1500)] + ["", " \n ", "x" * 10_000, "word " * 5000]
    for limit in (300_000, 40):
        monkeypatch.setattr(token_file, "CACHE_LIMIT", limit)
        got = token_file.Words(public_tokenizers.path("word_bpe_49k.json")).encode(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library(t) for t in texts]


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 1000, 70_001])
@pytest.mark.parametrize("used", [1, 2, 300, 40_000])
def test_block_round_trip_and_checkpoints(n, used):
    rng = np.random.default_rng(n + used)
    ids = (rng.integers(0, used, n) ** 2 % 49_408).astype(np.uint32)
    values, counts = np.unique(ids, return_counts=True)
    symbols = token_file.Symbols.scaled(values, counts)
    assert symbols.frequency.min() >= 1 and int(symbols.frequency.sum()) == 1 << symbols.bits
    payload = token_file.encode_block(ids, symbols)
    assert np.array_equal(token_file.decode_block(payload, symbols), ids)
    for _ in range(5):
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        assert np.array_equal(token_file.decode_block(payload, symbols, a, b), ids[a:b])


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.05, 200_000), 400).astype(np.uint32)
    values, counts = np.unique(ids, return_counts=True)
    p = counts / counts.sum()
    payload = token_file.encode_block(ids, token_file.Symbols.scaled(values, counts))
    marks = 64 + (8 * token_file.LANES + 4) * (-(-len(ids) // token_file.LANES // token_file.EVERY) + 1)
    assert len(payload) - marks < 1.01 * len(ids) * -(p * np.log2(p)).sum() / 8 + 8 * token_file.LANES


def test_damage_is_noticed():
    ids = np.arange(5000, dtype=np.uint32) % 50
    symbols = token_file.Symbols.scaled(np.arange(50), np.full(50, 100))
    payload = bytearray(token_file.encode_block(ids, symbols))
    payload[-3] ^= 1
    with pytest.raises(ValueError):
        token_file.decode_block(bytes(payload), symbols)


def brute(rows, library):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library(text)
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_write_and_read(spark, tmp_path, library, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK", 500)
    rows = [(i * 7 % 1009, f"Some Text {i} " * (i % 9)) for i in range(400)] + [(None, "null id"), (5000, None), (5001, ""), (3, "again"), (3, "again"), (6000, "long words " * 20_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, part string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in token_file.op4_token_file(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(rows, library)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert token_file.op4_token_file(spark, str(tmp_path)).collect() == []


def test_query_against_the_library(spark, library):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in token_file.op4_token_file(spark, d).collect()), key=str) == brute(rows, library)


def test_letters_beyond_ascii_as_the_library(library):
    """The plain path takes some of them; upper case, marks, signs and soft hyphens go through the whole tokenizer."""
    rng = random.Random(6)
    alphabet = ["ÿ", "ø", "÷", "×", "À", "É", "é", "ß", "\xad", "\xa1", "é", "ñandú", "l'été", "'s", "x", "9", "--", " "]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 12))) for _ in range(2000)]
    got = token_file.Words(public_tokenizers.path("word_bpe_49k.json")).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library(t) for t in texts]


def test_another_preparation_is_refused(tmp_path):
    import json

    told = json.load(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8"))
    told["normalizer"] = None
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    with pytest.raises(ValueError, match="another way"):
        token_file.Words(str(path))


@pytest.mark.parametrize("limit", [0, 3, 1000])
def test_stretches_hold_ids_whatever_the_room(monkeypatch, limit):
    """Plain stretches are held as ids at once, others when their ids are there; none waits behind a batch."""
    monkeypatch.setattr(token_file, "CACHE_LIMIT", limit)
    own = token_file.Words(token_file.worker_file(None, token_file.VOCABULARY))
    texts = ["plain words, 12 here", "Ünï cödé 中文 plain", "", "\n\n 中文", "y" * 90 + " Ж" * 3, "中文 here"]
    want = [np.array([*own.tokenizer.encode(t, add_special_tokens=False).ids, token_file.END_ID], "<u4").tobytes() for t in texts]
    assert own.encode(texts) == want
    assert own.encode(texts[::-1]) == want[::-1]
    assert len(own.stretches) <= limit and None not in own.stretches.values()
    assert all(len(s) <= 64 for s in own.stretches)


def test_counts_have_a_column_of_their_own():
    """So that the scan for the histograms reads no ids of documents."""
    assert token_file._TOKENS.names[-2:] == ["ids", "counts"]


def test_a_piece_is_held_once_whatever_stands_around_it(monkeypatch):
    """The library's model takes each distinct piece of a batch once; it used to be asked by stretches, marks and all."""
    own = token_file.Words(token_file.worker_file(None, token_file.VOCABULARY))
    asked, piece = [], own._piece
    monkeypatch.setattr(own, "_piece", lambda p: asked.append(p) or piece(p))
    own.encode(["Word, word. (word) été-word\nword 12", "WORD; don't (don't)", ""])
    plain = {b"word", b",", b".", b"(", b")", "été".encode(), b"-", b"1", b"2", b";"}
    assert set(own.stretches) == plain | {b"don't", b"(don't)"}
    assert plain <= set(asked) and asked.count(b"word") == 1
    asked.clear()
    own.encode(["(word) ; word, 2.", "don't"])
    assert asked == []


@pytest.mark.parametrize("limit", [0, 20, 100_000])
def test_cut_pieces_as_the_library(library, monkeypatch, limit):
    """Kinds of bytes beside each other: contractions, digits, marks, letters of two bytes, and what leaves a stretch whole."""
    monkeypatch.setattr(token_file, "CACHE_LIMIT", limit)
    rng = random.Random(8)
    alphabet = ["'", "''", "'re", "'ll", "'T", "a", "Re", "zz", "7", "42", ".", "--", "(", "é", "ã", "Ã", "ÿ", "×", "÷", "ß", "\u0301", "ă", "\xc2", "Ж", "中", "\t", "\r", "\x0b", "\x85", "\xa0", "\u2028", "\x00", "\x7f", " ", " ", " ", "\n", "\n\n"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(14))) for _ in range(4000)]
    own = token_file.Words(public_tokenizers.path("word_bpe_49k.json"))
    for start in range(0, len(texts), 500):
        got = own.encode(texts[start : start + 500])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library(t) for t in texts[start : start + 500]]
    assert len(own.stretches) <= limit
    assert own.encode([]) == [] and own.encode(["", " \n"]) == [b"\1\0\0\0"] * 2
