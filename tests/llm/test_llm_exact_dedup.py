import hashlib
from collections import defaultdict

import pytest

from popspark.llm import exact_dedup

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(UP)].append(i)
    out = []
    for text, ids in groups.items():
        ranked = sorted(ids, key=lambda i: (i is not None, i if i is not None else 0), reverse=True)
        for k, i in enumerate(ranked):
            out.append((i, ranked[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture
def rows():
    out = [(i, "Hot TEXT " * 30) for i in range(0, 900, 3)]  # a third of all rows
    out += [(i, f"text number {i // 2}") for i in range(1, 900, 3)]
    out += [(i, f"Single {i}") for i in range(2, 900, 3)]
    return [*out, (1000, None), (1001, ""), (None, "text number 0"), (5, "Single 5"), (1002, "ÄÖ"), (1003, "äö"), (1004, "z" * 300_000), (1005, "Z" * 300_000)]


def test_against_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id long, text string, keep_id string, kept boolean")
    got = sorted((tuple(r) for r in exact_dedup.mark_duplicates(df).collect()), key=str)
    assert got == brute(rows)


def test_keep_one_returns_the_rows(spark, rows):
    df = spark.createDataFrame([(*r, f"src{r[0]}", None) for r in rows], "doc_id long, text string, rank string, norm string")
    kept = exact_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in brute(rows) if r[3]), key=str)
    assert all(r["rank"] == f"src{r.doc_id}" for r in kept.collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.mark_duplicates(df).collect() == []
    assert exact_dedup.keep_one(df).collect() == []


def test_plan_has_no_python(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plan = exact_dedup._runs(df, "text", "doc_id", ["doc_id", "text"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "rangepartitioning" in plan
