import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from popspark.llm import language_model as lm

SF = "/root/testdata/sf0.001"


def tokens_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", lower)] + [lm.END]


def held_out(key):
    return crc32(("" if key is None else str(key)).encode()) % 7 == 2


def counted(rows):
    return Counter(lm.name(w) for key, text in rows if not held_out(key) for w in tokens_of(text))


def plain_score(text, p, counts, head):
    """log10 of the text's probability, one token after the other, in 64-bit numbers."""
    order = [lm.END, *sorted((k for k in counts if k != lm.END), key=lambda k: (-counts[k], k))[:head]]
    inner = {k: i for i, k in enumerate(order[: lm.CLASSES * lm.SLOTS])}
    n, v = Counter(), Counter()
    for k, c in counts.items():
        if k not in inner:
            n[lm.tail_hash(k) % lm.REST] += c
            v[lm.tail_hash(k) % lm.REST] += 1
    p = {k: x.astype(float) for k, x in p.items()}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h, last, total = np.zeros(lm.HIDDEN), 0, 0.0
    for word in tokens_of(text):
        key = lm.name(word)
        a, u = p["x"][last], h @ p["u"]
        z, r = sigmoid(a[: lm.HIDDEN] + u[: lm.HIDDEN]), sigmoid(a[lm.HIDDEN : -lm.HIDDEN] + u[lm.HIDDEN : -lm.HIDDEN])
        h = h + z * (np.tanh(a[-lm.HIDDEN :] + r * u[-lm.HIDDEN :]) - h)
        logit = h @ p["w1"] + p["b1"][0]
        logit -= np.log(np.exp(logit).sum())
        if key in inner:
            k, slot = divmod(inner[key], lm.SLOTS)
            own = h @ p["w2"][k] + p["b2"][k, 0]
            total += logit[k] + own[slot] - np.log(np.exp(own).sum())
            last = inner[key]
        else:
            b = lm.tail_hash(key) % lm.REST
            total += logit[lm.CLASSES + b] + math.log((counts[key] + 1) / (n[b] + v[b] + 1))
            last = lm.CLASSES * lm.SLOTS + lm.tail_hash(key) % lm.TAILS
    return total / math.log(10)


def check(spark, monkeypatch, rows, head, scored=None):
    """Every output column against a plain recomputation from the fitted parameters."""
    got = []
    learn = lm.train
    monkeypatch.setattr(lm, "train", lambda *a: got.append(learn(*a)) or got[0])
    if scored is None:
        df = spark.createDataFrame([(k, t, 1.0, "x") for k, t in rows], "doc_id long, text string, score double, key string")
        out = lm.score_documents(df, head=head)
    else:
        out = scored()
    out = sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] is not None, r[0], r[2], r[5]))
    counts = counted(rows)
    total, under = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    want = []
    for key, text in rows:
        own = [lm.name(w) for w in tokens_of(text)]
        base = sum(math.log10((counts[w] + 1) / under) for w in own)
        want.append((key, held_out(key), len(own), sum(counts[w] > 0 for w in own), total, base, plain_score(text, got[0], counts, head)))
    want.sort(key=lambda r: (r[0] is not None, r[0], r[2], r[5]))
    assert [r[:5] for r in out] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5] for r in out], [r[5] for r in want], rtol=1e-9)
    np.testing.assert_allclose([r[6] for r in out], [r[6] for r in want], rtol=2e-4, atol=1e-3)
    return out


def some_rows(n, seed=1):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "cat", "sat", "É", "中文", "x" * 60, "y" * 41, "a\x1cb", *(f"w{i}" for i in range(400))]
    rows = [(i, rng.choice([" ", "\n", "  "]).join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 90])))) for i in range(n)]
    return [*rows, (5, None), (5, None), (None, "the cat"), (None, None), (n + 1, "only here " * 5)]


@pytest.mark.parametrize("head", [3, 50, lm.HEAD])
def test_against_plain_recomputation(spark, monkeypatch, head):
    """Few known tokens send most words through the join."""
    monkeypatch.setattr(lm, "HELD", 40)
    monkeypatch.setattr(lm, "SLICE_CODES", 3000)
    monkeypatch.setattr(lm, "LONG_CODES", 100)
    check(spark, monkeypatch, some_rows(120), head)


def test_query_against_plain_recomputation(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = check(spark, monkeypatch, docs, lm.HEAD, lambda: lm.op11_language_model(spark, SF))
    assert len(out) == len(docs)


def test_state_is_carried_through_a_very_long_text(spark, monkeypatch):
    """Longer than many windows, beside short texts."""
    rng = random.Random(4)
    long = " ".join(rng.choices(["a", "b", "c", "dd"], k=30_000))
    check(spark, monkeypatch, [(1, long), (2, "a b"), (3, ""), (4, "dd " * 700)], lm.HEAD)


def test_edge_tables(spark):
    df = spark.createDataFrame([(1, "x y")], "doc_id long, text string")
    assert lm.score_documents(df.limit(0)).collect() == []
    key = next(i for i in range(100) if held_out(i))
    only = spark.createDataFrame([(key, "never seen"), (key, None)], "doc_id long, text string")
    got = sorted(lm.score_documents(only).collect(), key=lambda r: r.n_tokens)
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_backpropagation_against_differences(monkeypatch):
    """Numerical slopes of the loss over one window."""
    for name, value in {"HIDDEN": 3, "CLASSES": 2, "SLOTS": 3, "REST": 2, "TAILS": 2}.items():
        monkeypatch.setattr(lm, name, value)
    shapes = {"x": (8, 9), "u": (3, 9), "w1": (3, 4), "b1": (1, 4), "w2": (2, 3, 3), "b2": (2, 1, 3)}
    monkeypatch.setattr(lm, "SHAPES", shapes)
    keys = [lm.END, b"a", b"b", b"c", b"d", b"e"]
    v = lm.Vocabulary(keys, np.array([4, 3, 3, 2, 2, 1]), 20, 9, np.array([3, 2]), np.array([2, 1]))
    tokens = v.tables().read([b"a b zz c a", b"e d yy a b c", b""])
    rng = np.random.default_rng(5)
    p = {k: rng.normal(0, 0.5, s) for k, s in shapes.items()}
    got = {k: np.zeros(s) for k, s in shapes.items()}

    class Recording(lm.Network):
        def __init__(self, p):
            self.p = {k: x.copy() for k, x in p.items()}

        def _step(self, k, rows, slope, tokens):
            got[k][rows] += slope

    Recording(p).run(tokens.codes, tokens.lengths, learn=True)
    for k, x in p.items():
        for at in np.ndindex(x.shape):
            near = []
            for step in (1e-4, -1e-4):
                moved = {**p, k: x.copy()}
                moved[k][at] += step
                near.append(-Recording(moved).run(tokens.codes, tokens.lengths, learn=False).sum() * math.log(10))
            assert got[k][at] == pytest.approx((near[0] - near[1]) / 2e-4, abs=2e-3, rel=2e-3), (k, at)


def test_learning_beats_the_unigram_model_on_held_out_rows(spark):
    """Words follow each other in a fixed order with some noise: counts alone can't tell."""
    rng = random.Random(8)

    def text():
        at, out = rng.randrange(20), []
        for _ in range(60):
            at = (at + 1) % 20 if rng.random() < 0.9 else rng.randrange(20)
            out.append(f"word{at}")
        return " ".join(out)

    df = spark.createDataFrame([(i, text()) for i in range(1500)], "doc_id long, text string")
    rows = [r for r in lm.score_documents(df.repartition(3), rounds=3).collect() if r.held_out]
    assert sum(r.score for r in rows) > 0.88 * sum(r.base_score for r in rows)


def test_probabilities_add_up_to_one():
    """Over all known words and one unseen word per rest class."""
    counts = Counter({lm.END: 5, **{f"w{i}".encode(): 1 + i % 7 for i in range(3000)}})
    order = [lm.END, *sorted((k for k in counts if k != lm.END), key=lambda k: (-counts[k], k))]
    rest = np.zeros((2, lm.REST), np.int64)
    for k in order[lm.CLASSES * lm.SLOTS :]:
        rest[:, lm.tail_hash(k) % lm.REST] += counts[k], 1
    v = lm.Vocabulary(order, np.array([counts[k] for k in order]), sum(counts.values()), len(counts), rest[0], rest[1])
    p = lm.first_parameters(v)
    cls = np.exp(p["b1"][0].astype(float))
    slots = np.exp(p["b2"][:, 0].astype(float))
    assert cls.sum() == pytest.approx(1, abs=1e-5)
    np.testing.assert_allclose(slots.sum(1), 1, rtol=1e-4)
    for b in range(lm.REST):
        own = [counts[k] for k in order[lm.CLASSES * lm.SLOTS :] if lm.tail_hash(k) % lm.REST == b]
        assert sum((c + 1) / (rest[0, b] + rest[1, b] + 1) for c in [*own, 0]) == pytest.approx(1)


def test_rows_by_lane_lie_behind_each_other():
    values = np.arange(2 * 3 * 4, dtype=np.float32).reshape(2, 3, 4)
    valid = np.array([[True, True, True, False], [True, False, True, True]])
    rows = lm._by_lane(values)
    assert rows.flags.c_contiguous
    assert (np.take(rows, np.flatnonzero(valid), axis=0) == values.transpose(0, 2, 1)[valid]).all()
