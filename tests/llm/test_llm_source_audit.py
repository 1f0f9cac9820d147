import random
import re
from collections import Counter, defaultdict

import pytest

from popspark.llm import source_audit

SCHEMA = "doc_id long, text string, lang string, source string, digest long, term string"


def brute(rows, min_docs, top):
    """(lang, source, part, item, value, rank) by plain loops."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        found = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        n[lang, source].update(found)
        docs[lang].update(set(found))
        groups.add((lang, source))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        sources = [s for x, s in groups if x == lang]

        def share(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: share(n[lang, s]) for s in sources}
        q = share(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            far = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            own = [(q[t] - p[s][t], t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, cells in (("pair", sorted(far)), ("term", sorted(own)[:top])):
                out |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(cells)}
    return out


def result(spark, rows, min_docs, top, bits=64):
    df = spark.createDataFrame([(1, *r, 5, "x") for r in rows], SCHEMA)
    return [tuple(r) for r in source_audit.audit(df, min_docs, top, bits).collect()]


def random_rows(seed, n, words, sources=("a", "b", "é", None, "")):
    rng = random.Random(seed)
    return [
        (
            None if rng.random() < 0.05 else " ".join(rng.choices(words, k=rng.choice([0, 1, 4, 30]))),
            rng.choice(["en", "en", "de", None]),
            rng.choice(["hot", *sources]) if rng.random() < 0.7 else "hot",
        )
        for _ in range(n)
    ]


WORDS = ["One", "two2three", "éa", "x-y", "中文", "z\x1cq", "TWO", "ß", *(f"w{chr(97 + i)}" for i in range(20))]


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_against_brute_force(spark, bits):
    """With 3 or 1 bits every digest stands for several terms, some of them kept, some not."""
    rows = random_rows(bits, 150, WORDS)
    got = result(spark, rows, 12, 5, bits)
    assert len(got) == len(set(got)) and set(got) == brute(rows, 12, 5)


def test_small_blocks_and_tiles(spark, monkeypatch):
    """Several blocks, several tiles, several tables a task, and shuffled joins instead of broadcasts."""
    for name, value in {"BLOCK": 3, "TILE": 2, "HELD": 10, "SMALL": 0}.items():
        monkeypatch.setattr(source_audit, name, value)
    rows = random_rows(9, 200, WORDS, [f"s{i}" for i in range(9)])
    assert set(result(spark, rows, 5, 3)) == brute(rows, 5, 3)


def test_cases(spark):
    assert result(spark, [], 1, 5) == []
    assert result(spark, [("a b", "en", "only")], 2, 5) == []
    # no kept term: pairs have value 0, ties are in the order of the items
    rows = [("a", "en", "z"), (None, "en", "y"), ("", None, None)]
    assert set(result(spark, rows, 9, 5)) == {("en", "z", "pair", "y", 0, 1), ("en", "y", "pair", "z", 0, 1)}
    # repeated rows count as documents; ties at the limit are cut by the item
    rows = [("b a c", "en", "s")] * 3 + [("q " * 50, "en", "t")] * 3
    got = set(result(spark, rows, 3, 2))
    assert got == brute(rows, 3, 2) and {r[3] for r in got if r[1:3] == ("s", "term")} == {"a", "b"}


def test_a_very_long_text(spark):
    rows = [("one two " * 200_000, "en", "s"), ("w" * 500_000, "en", "s"), ("one", "en", "t")]
    assert set(result(spark, rows, 1, 5)) == brute(rows, 1, 5)


def test_large_counts_stay_exact(spark):
    """10^9 times such a count leaves 64 bits."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(900_000_000_000, 1_700_000_000_001, 1234)], "n long, total long, v long")
    assert df.select(source_audit.share(F.col("n"))).first()[0] == 1 + 10**9 * 900_000_000_005 // (1_700_000_000_001 + 5 * 1234)
