import random
import re

import numpy as np
import pytest

from popspark.llm import near_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    ws = WORD.findall((text or "").translate(UP))
    if len(ws) < 5:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}


def brute(docs):
    """(doc_id, n_shingles, component_id), sorted; rows with a null id link with nothing."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if docs[i][0] is None or docs[j][0] is None or not a or not b:
                continue
            if 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), None if d is None else low[find(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=str)


def corpus(seed, groups, copies, vocabulary=400):
    rng = random.Random(seed)
    make = lambda n: [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    shared = make(60)
    out = []
    for _ in range(groups):
        base = make(rng.choice([3, 6, 40, 150, 300]))
        if rng.random() < 0.5:
            base[len(base) // 2 : len(base) // 2] = shared
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                text[rng.randrange(len(text))] = f"edit{rng.randrange(10**6)}"
            out.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in text))
    rng.shuffle(out)
    return [(i * 3 % 100_003, t) for i, t in enumerate(out)]


EDGE = [(None, "a b c d e f"), (None, None), (900_000, None), (900_001, ""), (900_002, "one two"), (900_003, "ONE\ttwo"), (900_004, "one two three"), (900_005, "  \n "), (900_006, "x " * 50_000), (900_007, "x x x x x x"), (900_002, "one two"), (900_008, "É a b c d e"), (900_009, "é a b c d e"), (900_010, "q" * 3_000_000)]


def run(spark, docs):
    df = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, digest string, label int")
    out = near_join.jaccard_components(df).select("doc_id", "n_shingles", "component_id")
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_against_brute_force(spark):
    docs = corpus(1, 60, 8) + EDGE
    assert run(spark, docs) == brute(docs)


def test_large_components_and_small_batches(spark, monkeypatch):
    """A group of near copies holds most rows; its blocks, salts and pivot come into play."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    docs = corpus(2, 12, 4)
    for i in range(90):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            text[rng.randrange(60)] = f"n{rng.randrange(40)}"
        docs.append((500_000 + i, " ".join(text)))
    rng.shuffle(docs)
    monkeypatch.setattr(near_join, "BLOCK", 8)
    assert near_join.BLOCK == 8
    assert run(spark, docs) == brute(docs)


def test_keep_one(spark):
    docs = corpus(3, 20, 6) + EDGE
    df = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, md5 string, component_id int")
    kept = near_join.keep_one(df)
    assert kept.columns == df.columns
    want = sorted((str(d) for d, _, c in brute(docs) if d == c))
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_empty_table(spark):
    assert run(spark, []) == []


def test_components(spark):
    rng = random.Random(4)
    nodes = [f"{i:03d}".encode() for i in range(80)]
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(55)] + [(nodes[i], nodes[i + 1]) for i in range(30, 60)]
    got = {bytes(r.node): bytes(r.label) for r in near_join.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    assert got == {n: find(n) for n in nodes if find(n) != n}


@pytest.mark.parametrize("seed", range(30))
def test_filters_lose_no_link(seed):
    """Pairs that link share a prefix shingle under each order, whatever the frequencies."""
    rng = np.random.default_rng(seed)
    universe = np.sort(rng.choice(2**60, 200, replace=False).astype(np.uint64))
    freq = dict(zip(universe.tolist(), rng.integers(2, 50, 200).tolist(), strict=True))
    base = rng.choice(universe, 60, replace=False)
    sets = [np.unique(np.concatenate([base[rng.random(60) < 0.93], rng.choice(universe, 4)])) for _ in range(14)]
    dfs = [np.array([freq[int(t)] for t in s], "<u2") for s in sets]
    sizes = np.array([len(s) + int(rng.integers(0, 4)) for s in sets])  # with shingles of their own
    got = near_join.linked(sizes, sets, dfs)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                common = len(np.intersect1d(a, b))
                assert got[i, j] == (100 * common >= 80 * (sizes[i] + sizes[j] - common))


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    data = b"  ab cd " + b"x" * 500 + b" ef" * 40
    whole = near_join.word_hashes(data)
    monkeypatch.setattr(near_join, "_PIECE", 7)
    cut = near_join.word_hashes(data)
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut, strict=True))
    assert whole[1].tolist() == [m.start() for m in re.finditer(rb"[^ ]+", data)]
