"""Operators 2, 7 and 10: held-out accuracy, edge cases, and parts against plain versions."""

from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from popspark.llm import common, language_id, quality, toxicity

SF = "/root/testdata/sf0.1"
EDGE = [(1, None), (2, ""), (3, "x"), (None, "moron"), (3, "x"), (4, "word " * 60_000), (5, "123 456 !!"), (6, "ÄÖÜ ß"), (9, "nine words"), (10, "ten")]


def edge_tables(spark, path, labels):
    spark.createDataFrame([(i, t, "en" if i else None, "s", 7) for i, t in EDGE], "doc_id long, text string, lang string, source string, score int").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.mark.parametrize("labels", [[], [(3, 1, 0), (4, 1, 0), (None, 1, 1)], [(i, i % 2, i % 2) for i in range(1, 9)] + [(3, None, None)]])
@pytest.mark.parametrize("query", [quality.op2_quality, toxicity.op7_toxicity])
def test_edge_cases(spark, tmp_path, query, labels):
    out = query(spark, edge_tables(spark, tmp_path, labels)).collect()
    assert len(out) == len(EDGE)
    for r in out:
        assert 0 <= r.score <= 1
        assert r.held_out == (crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= (0.3 if query is quality.op2_quality else 0.5))


def test_language_edge_cases(spark, tmp_path):
    out = language_id.op10_language_id(spark, edge_tables(spark, tmp_path, [])).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, r)
        assert 0 <= r.score <= 1 and r.held_out == (crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 3 == 1)
    assert len(out) == len(EDGE)
    learnt = any(i and t and any(map(str.isalnum, t)) and crc32(str(i).encode()) % 3 != 1 for i, t in EDGE)
    assert [by[i].lang_pred for i in (1, 2, 5)] == ["und"] * 3 and by[4].lang_pred == ("en" if learnt else "und")


@pytest.mark.parametrize("query", [quality.op2_quality, toxicity.op7_toxicity, language_id.op10_language_id])
def test_empty_tables(spark, tmp_path, query):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert query(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize(("query", "label"), [(quality.op2_quality, "quality"), (toxicity.op7_toxicity, "toxic")])
def test_held_out_accuracy(spark, query, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = query(spark, SF).filter("held_out").join(labels, "doc_id").select(F.col(label).alias("y"), "predicted").collect()
    assert np.mean([r.y == r.predicted for r in rows]) > 0.97
    rare = 0 if label == "quality" else 1
    found = [r.predicted == rare for r in rows if r.y == rare]
    assert np.mean(found) > 0.8
    assert np.mean([r.predicted == 1 - rare for r in rows if r.y != rare]) > 0.98


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = language_id.op10_language_id(spark, SF).filter("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.99
    assert np.mean([r.lang == r.lang_pred for r in rows if r.accepted]) > 0.99
    assert np.mean([r.accepted for r in rows]) > 0.9


def test_machine_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    m = toxicity.Machine(0.3, {i: i for i in range(9)}, rng.normal(size=9), rng.normal(size=(9, 4)))
    rows = [0, 3, 4, 8]
    want = 0.3 + sum(m.weight[i] for i in rows) + sum(m.factors[a] @ m.factors[b] for k, a in enumerate(rows) for b in rows[:k])
    assert m.raw(rows) == pytest.approx(want)


def test_machine_learns_an_interaction():
    """Either term alone is clean, both together are toxic: no linear weights do that."""
    rows, y = [], []
    for i in range(1200):
        rows.append(np.array([t for t, on in ((0, i % 2), (1, i // 2 % 2)) if on] + [2 + i % 7]))
        y.append(float(i % 2 and i // 2 % 2))
    m = toxicity.train(rows, np.array(y), np.arange(1, 10), epochs=60)
    score = lambda *terms: toxicity.sigmoid(m.raw([m.place[t] for t in terms if t in m.place]))
    assert score(1, 2) > 0.5 > max(score(1), score(2), score())


def test_isotonic_against_plain_pooling():
    rng = np.random.default_rng(4)
    for _ in range(40):
        s = rng.integers(0, 12, 40) / 4
        y = (rng.random(40) < s / 3).astype(float)
        knots, values = quality.isotonic(s, y)
        assert np.all(np.diff(values) >= 0) and np.all(np.diff(knots) > 0)
        xs = np.unique(s)
        fit = np.interp(xs, knots, values)
        mean, weight = np.array([y[s == x].mean() for x in xs]), np.array([(s == x).sum() for x in xs])
        for i in range(len(xs)):  # min-max formula of isotonic regression
            want = max(min(np.average(mean[a : b + 1], weights=weight[a : b + 1]) for b in range(i, len(xs))) for a in range(i + 1))
            assert fit[i] == pytest.approx(want)


def test_partition_sums_equal_one_sum(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(50, len(quality.NAMES)))
    y = rng.integers(0, 2, 50)
    model = quality.Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), rng.normal(size=(x.shape[1], quality.FEATURES)), rng.uniform(0, 6, quality.FEATURES), np.zeros(quality.FEATURES + 1), np.zeros(1), np.zeros(1))
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y, strict=True)], "x array<double>, y int").repartition(7)
    phi = np.hstack([model.features(x), y[:, None]])
    assert np.allclose(quality._sums(rows, model), phi.T @ phi)


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(6)
    d = 3
    model = quality.Model(np.zeros(d), np.ones(d), rng.normal(0, 1 / quality.WIDTH, (d, quality.FEATURES)), rng.uniform(0, 2 * np.pi, quality.FEATURES), np.zeros(1), np.zeros(1), np.zeros(1))
    a, b = rng.normal(size=(30, d)), rng.normal(size=(30, d))
    got = (model.features(a)[:, :-1] * model.features(b)[:, :-1]).sum(1)
    want = np.exp(-((a - b) ** 2).sum(1) / (2 * quality.WIDTH**2))
    assert np.abs(got - want).max() < 0.3 and np.abs(got - want).mean() < 0.08


def test_terms_are_chosen_by_association(spark):
    rows = [(i, int(i % 4 == 0), np.array([7, 9] if i % 4 == 0 else [9] if i % 3 else [9, 11], "<u4").tobytes()) for i in range(400)]
    sample = spark.createDataFrame(rows, "doc_id long, y int, terms binary").repartition(3)
    assert toxicity.choose_terms(sample).tolist() == [7, 11]


def test_subwords_of_long_words_in_pieces(monkeypatch):
    """Pieces of few bytes give the buckets of the plain version, each as often."""
    monkeypatch.setattr(language_id, "PIECE", 7)
    for n in [*range(1, 30), 61, 200]:
        word = ("日本語x" * n).encode()[:n]
        assert sorted(np.concatenate(list(language_id.long_subwords(word))).tolist()) == sorted(language_id.subwords(word))
    monkeypatch.setattr(language_id, "LONG", 10)
    ws = [b"a" * 25, b"short", b"a" * 25]
    want = [b for w in ws for b in language_id.subwords(w)]
    assert dict(zip(*language_id.counts(ws), strict=True)) == {b: want.count(b) for b in want}


def test_unspaced_text_is_judged_whole(spark):
    """Both texts are one word and start alike; what follows the first 60 bytes tells their language."""
    rng = np.random.default_rng(8)
    start = "一二三四五六七八九十" * 3
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    kinds = {"ja": "あいうえおかきくけこ", "th": "กขคงจฉชซญด"}
    rows = [(i, start + draw(kinds[lang], 200), lang) for i in range(120) for lang in [("ja", "th")[i % 2]]]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [(lang, start + draw(letters, 10_000)) for lang, letters in kinds.items()]
    got = language_id.identify(spark.createDataFrame(texts, "doc_id string, text string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {"ja": "ja", "th": "th"}


def test_the_bound_on_the_sample_holds_for_rows(spark, monkeypatch):
    """One id holds a third of all rows; it gives one row to every classifier."""
    rows = [(i, f"text {i}", "en") for i in range(1, 61)] + [(7, f"copy {i}", "en" if i % 2 else None) for i in range(30)] + [(None, "none", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 61)], "doc_id long, quality int, toxic int")
    kept = []
    for module in (quality, toxicity, language_id):
        plain = module.one_per_id
        monkeypatch.setattr(module, "one_per_id", lambda *a, plain=plain: kept.append(plain(*a)) or kept[-1])
    quality.fit(docs, labels), toxicity.fit(docs, labels), language_id.fit(docs)
    for df in kept:
        ids = [r.doc_id for r in df.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) > 30
    assert len(kept) == 3 and common.one_per_id(common.labelled_sample(docs, labels, "toxic", 20), "text").count() == 20


def test_rows_of_a_chosen_id_with_another_language_are_not_learnt(spark, monkeypatch):
    learnt, plain = [], language_id.train
    monkeypatch.setattr(language_id, "train", lambda rows, *a: learnt.extend(rows) or plain(rows, *a))
    rows = [(i, "uno dos", "es") for i in range(20)] + [(i, f"one two {i}", lang) for i in range(20) for lang in (None, "xx")]
    language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {b for r in learnt for b in r[0].tolist()} == {b for w in (b"uno", b"dos") for b in language_id.subwords(w)}


def test_a_rare_language_is_learnt(spark):
    """One row in 10,000, beside an id that holds a third of all rows."""
    rng = np.random.default_rng(2)
    draw = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(8))
    rows = [(i, draw("abcdefgh"), "en") for i in range(4000)] + [(i, draw("mnopqrst"), "de") for i in range(4000, 6500)]
    rows += [(7, "abc", "en")] * 3400 + [(20_001, "αβγδ εζηθ αγεη βδζθ " * 20, "el")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    rows = docs.filter(crc_of("doc_id") != 1)
    assert rows.filter("lang = 'el'").count() == 2
    model = language_id.fit(docs)
    assert model.langs == ["de", "el", "en"]
    texts = [("el", "αβγδ εζηθ βδζθ " * 9), ("de", draw("mnopqrst")), ("en", draw("abcdefgh"))]
    got = language_id.identify(spark.createDataFrame(texts, "doc_id string, text string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {x: x for x, _ in texts}


def crc_of(name):
    from pyspark.sql import functions as F

    return common.crc_mod(F.col(name), 3)
