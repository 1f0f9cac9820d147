import numpy as np
import pytest

import corpus_pipeline
from popspark.llm import byte_bpe, toxicity
from test_llm_decontaminate import brute as contaminated
from test_llm_near_join import brute as near

SF = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, machine):
    """Ids and texts that the first four stages keep, one by one."""
    score = machine.scorer()
    docs = [(i, t) for i, t in docs if score(t or "") < toxicity.THRESHOLD]
    best = {}
    for i, t in docs:
        key = (t or "").translate(UP)
        best[key] = max(best.get(key, (i, t)), (i, t))
    docs = sorted(best.values())
    kept = {i for i, _, c in near(docs) if i == c}
    return [(i, t) for i, t in docs if i in kept and not contaminated(t, items)[-1]]


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda n: spark.read.parquet(f"{SF}/{n}.parquet")
    return read("documents"), read("benchmark"), read("labels")


def test_run_against_brute_force(spark, tables):
    documents, benchmark, labels = tables
    machine = toxicity.fit(documents, labels)
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute(docs, [(r.item_id, r.text) for r in benchmark.collect()], machine)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(got) == sorted(i for i, _ in want)
    assert len(got) < len(docs)
    for i, t in want:
        ids = byte_bpe.codec().encode(t)
        assert bytes(got[i].ids) == ids and got[i].n_tokens == len(ids) // 4 and got[i].round_trip


def test_stages_return_the_columns_of_their_input(spark):
    rows = [(1, "a b c d e f g", "en", "s", 13, "x"), (2, None, None, None, None, None), (None, "", "en", "s", 0, "y"), (3, "a b c d e f g", "en", "s", 13, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.schema.simpleString() == docs.schema.simpleString()
    assert {r.doc_id for r in corpus_pipeline.drop_exact_copies(spark, docs, SF).collect()} >= {3, 2}
    assert np.all([s(spark, docs.limit(0), SF).count() == 0 for _, s in corpus_pipeline.STAGES])
