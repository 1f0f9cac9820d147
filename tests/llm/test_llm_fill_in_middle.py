import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from popspark.llm import fill_in_middle as fim


def brute(key, text):
    """(units, form, prefix and middle code points, output), by walking over all units."""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def made(keys, texts):
    out = list(fim.Transformer(fim.Plan()).run(keys, [t.encode() for t in texts]))
    return [(*row, o.decode()) for *row, o in out]


@pytest.mark.parametrize(("limit", "longest", "bits"), [(0, 40, 3), (5, 64, 2), (400_000, 4096, 7)])
def test_random_texts(monkeypatch, limit, longest, bits):
    for name, value in {"CACHE_LIMIT": limit, "LONGEST": longest, "BITS": bits}.items():
        monkeypatch.setattr(fim, name, value)
    rng = random.Random(limit)
    alphabet = ["a", "bc", "Z", " ", "é", "中", "\U0001f600", "<", "P>", "\n", "."]
    for _ in range(150):
        texts = ["".join(rng.choices(alphabet, k=rng.choice([0, 1, 3, 50, 400]))) for _ in range(rng.randrange(1, 9))]
        texts.append("x" * rng.randrange(300))
        keys = [rng.randrange(10**6) for _ in texts]
        assert made(keys, texts) == list(map(brute, keys, texts))


def test_very_long_texts():
    texts = ["a" * 1_000_000, "é" * 300_000, "one two " * 200_000, " " * 500_000]
    keys = [1, 2, 3, 4]
    assert made(keys, texts) == list(map(brute, keys, texts))


def test_chunks_are_cut_by_content():
    rng = random.Random(5)
    shared = "".join(rng.choices("abcdefgh ijkl", k=3000))
    own = fim.Transformer(fim.Plan())
    list(own.run([1], [shared.encode()]))
    before = len(own.cache)
    list(own.run([2], [("another start " + shared).encode()]))
    assert before > 8 and len(own.cache) <= before + 3  # the passage's chunks are found again behind other text


def test_rolling_hash_depends_on_the_window_only():
    import numpy as np

    rng = np.random.default_rng(1)
    a, b, c = (rng.integers(0, 256, k, dtype=np.uint8) for k in (50, 70, 40))
    x, y = fim.rolling_hash(np.concatenate([a, c])), fim.rolling_hash(np.concatenate([b, c]))
    assert (x[50 + fim.WINDOW - 1 :] == y[70 + fim.WINDOW - 1 :]).all()


def test_operator_cases(spark):
    rows = [(1, "Some text here", "x"), (2, None, "x"), (2, "", "x"), (None, "Some text", None), (1, "Some text here", "x"), (7, "has <M> in it", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string")
    got = fim.transform(df).withColumn("back", fim.restored())
    want = sorted((str(k), *brute(k, t or ""), t or "") for k, t, _ in rows)
    assert sorted((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got.collect()) == want
    assert fim.transform(df.limit(0)).collect() == []


def test_other_plans_restore(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for plan in (fim.Plan("9", 101, 0), fim.Plan("9", 101, 100), fim.Plan("x", 0, 0)):
        out = fim.transform(docs, plan=plan).withColumn("back", fim.restored()).join(docs.select("doc_id", "text"), "doc_id")
        assert out.filter(F.col("back") != F.col("text")).count() == 0
        assert {r.form for r in out.select("form").distinct().collect()} <= {"plain", "psm" if plan.suffix_first_below == 0 else "spm"}


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = fim.op12_fill_in_middle(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in out:
        *head, output = brute(r.doc_id, docs[r.doc_id])
        assert [r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256] == [*head, sha(output), sha(docs[r.doc_id])]
