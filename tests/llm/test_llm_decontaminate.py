import hashlib
import random
import re

import pytest

from popspark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def toks(t):
    return WORD.findall((t or "").translate(UP))


def brute(text, items):
    ws, hit, found = toks(text), set(), set()
    for item, t in items:
        iw = toks(t)
        if not iw:
            continue
        m = min(13, len(iw))
        wins = {tuple(iw[i : i + m]) for i in range(len(iw) - m + 1)}
        for i in range(len(ws) - m + 1):
            if tuple(ws[i : i + m]) in wins:
                hit.update(range(i, i + m))
                found.add(item)
    n = len(hit)
    ids = sorted(str(x) for x in found if x is not None)  # a missing id counts as an item, and isn't listed
    return (len(ws), n, len(found), hashlib.sha256(",".join(ids).encode()).hexdigest(), n > 0 and 20 * n >= len(ws))


@pytest.fixture
def case():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(6)] + ["É", "ß9"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([2, 3, 5, 14, 20, 30])))) for i in range(20)]
    items += [(100, None), (101, "..."), (None, "w1 w2"), (7, "w0 w0 w0"), (102, items[4][1]), (103, " ".join(["rep"] * 20))]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randrange(120)))) for i in range(60)]
    docs += [(200 + i, f"zz yy, {items[i][1].upper()}! " + "qq " * rng.choice([0, 300])) for i in range(20)]
    docs += [(300, None), (301, ""), (None, items[3][1]), (0, docs[0][1]), (0, docs[0][1]), (302, "rep " * 5000), (303, "solo " * 3000 + items[9][1])]
    return docs, items


def run(spark, path, docs, items):
    spark.createDataFrame([(*d, 9) for d in docs], "doc_id long, text string, n_words long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return sorted((tuple(r) for r in decontaminate.op9_decontamination(spark, str(path)).collect()), key=str)


def test_against_brute_force(spark, tmp_path, case):
    docs, items = case
    assert run(spark, tmp_path, docs, items) == sorted(((i, *brute(t, items)) for i, t in docs), key=str)


def test_items_without_an_id_as_in_the_sql(spark, tmp_path, case):
    import duckdb

    docs, items = case
    docs = [d for d in docs if d[0] is not None][:80] + [(900, "one two three four five"), (901, "two three four " * 9)]
    docs = list({d[0]: d for d in docs}.values())  # the SQL names documents by their ids
    items = [*items, (None, "two three four")]
    got = run(spark, tmp_path, docs, items)
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = db.sql(decontaminate.ORACLE)
    at = [found.columns.index(c) for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")]
    assert got == sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=str)
    assert [r[2:4] for r in got if r[0] == 900] == [(3, 1)]


def test_blocks_of_windows_give_the_same(spark, case):
    docs, items = case
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.search_documents(df, bench)
    blocks = decontaminate.search_documents(df, bench, max_windows=25)
    assert sorted(map(str, whole.collect())) == sorted(map(str, blocks.collect()))


def test_empty_tables(spark, tmp_path, case):
    docs, items = case
    assert run(spark, tmp_path / "a", [], items) == []
    got = run(spark, tmp_path / "b", docs[:5], [])
    assert [r[2:4] for r in got] == [(0, 0)] * 5 and not any(r[5] for r in got)


def test_keep_clean_keeps_rows_and_columns(spark, case):
    docs, items = case
    df = spark.createDataFrame([(*d, "a", "b") for d in docs], "doc_id long, text string, spans string, row string")
    kept = decontaminate.keep_clean(df, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == df.columns
    want = sorted((i for i, t in docs if not brute(t, items)[-1]), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want


def test_shift_never_skips_an_occurrence():
    rng = random.Random(1)
    for _ in range(300):
        m = rng.randrange(1, 8)
        pats = {tuple(rng.choices([1, 2, 3], k=m)) for _ in range(rng.randrange(1, 5))}
        seq = rng.choices([0, 1, 2, 3, 4], k=60)
        want = [(i, tuple(seq[i : i + m])) for i in range(60 - m + 1) if tuple(seq[i : i + m]) in pats]
        assert list(decontaminate.WuManber(pats, m).find(seq)) == want
