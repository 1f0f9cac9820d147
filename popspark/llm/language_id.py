"""Operator 10: language identification.

A word's subwords (its byte n-grams of 1 to 4 with end marks, and the word)
are hashed to ``BUCKETS`` embeddings. A text is the average embedding of the
subwords of all its words, and a linear softmax over it gives the language.
Both are trained together by stochastic gradient descent in numpy on at most
``MAX_ROWS`` rows that are not held out, one for an id and equally many of every
language that has as many, each as a whole text and as a few words of it, so
that short texts are known too. A temperature fitted on other
rows calibrates the probability, and the rejection bound is the lowest
probability above which these rows are right in ``PRECISION`` of cases;
``accepted`` tells whether a row reaches it.

As the softmax is linear, a word adds a fixed vector; all words of all texts
are summed. A word is any run without ASCII separators, so an unspaced text is
one word; the subwords of long words are hashed with numpy, in overlapping
pieces, and none is left out.

Cases: a text that is null or holds no letter is ``und`` with score 0; so is
every text if there is nothing to learn from; repeated rows are each judged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popspark.llm.common import crc_mod, one_per_id, per_text, table, words

#: rows that the model learns from, at most; a rare language has up to ``LEAST`` rows also where there are more languages
MAX_ROWS, LEAST = 3_000, 20
BUCKETS, SIZE, EPOCHS, PRECISION = 1 << 15, 8, 5, 0.99
UNKNOWN = "und"
#: words whose vectors a worker remembers
CACHE_LIMIT = 200_000
#: words of more bytes are hashed with numpy, ``PIECE`` bytes at a time, and not remembered
LONG, PIECE = 60, 1 << 16
#: the table of crc32
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1)


def subwords(word: bytes) -> list[int]:
    marked = b"<" + word + b">"
    grams = [marked[i : i + n] for n in (1, 2, 3, 4) for i in range(len(marked) - n + 1)]
    return [crc32(g) & (BUCKETS - 1) for g in [*grams, b"=" + word]]


def long_subwords(word: bytes) -> Iterator[np.ndarray]:
    """The same buckets as ``subwords``, as bounded arrays: the n-grams that start in a piece, whose end overlaps the next by 3 bytes."""
    marked = b"<" + word + b">"
    for start in range(0, len(marked), PIECE):
        piece = np.frombuffer(marked[start : start + PIECE + 3], np.uint8)
        crc = np.full(len(piece), 0xFFFFFFFF, np.uint32)
        for n in (1, 2, 3, 4):
            own = piece[n - 1 :]
            crc = crc[: len(own)]
            crc = _CRC[(crc ^ own) & 0xFF] ^ (crc >> 8)
            yield (~crc[:PIECE] & (BUCKETS - 1)).astype(np.int64)
    yield np.array([crc32(b"=" + word) & (BUCKETS - 1)])


def counts(ws: list[bytes]) -> tuple[list[int], list[int]]:
    """Buckets and their counts, of whole words."""
    total: Counter[int] = Counter()
    for w, n in Counter(ws).items():
        if len(w) <= LONG:
            for b in subwords(w):
                total[b] += n
        else:
            own = sum(np.bincount(g, minlength=BUCKETS) for g in long_subwords(w))
            used = np.flatnonzero(own)
            total.update(dict(zip(used.tolist(), (own[used] * n).tolist(), strict=True)))
    return list(total), list(total.values())


@dataclass
class Model:
    langs: list[str]
    logits: np.ndarray  # bucket -> what it adds to each language
    bias: np.ndarray
    temperature: float
    bound: float

    def judge(self) -> Callable[[str], tuple[str, float]]:
        seen: dict[bytes, int] = {}
        rows = np.zeros((CACHE_LIMIT, len(self.langs) + 1), np.float32)
        both = np.hstack([self.logits, np.ones((len(self.logits), 1), np.float32)])  # and 1 for each subword

        def vector(w: bytes) -> np.ndarray:
            if len(w) > LONG:
                return sum(both.take(g, 0).sum(0, dtype=np.float64) for g in long_subwords(w))
            own = subwords(w)
            return both.take(own, 0).sum(0)

        def one(text: str) -> tuple[str, float]:
            if not self.langs or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0
            ws = words(text)
            if not ws:
                return UNKNOWN, 0.0
            at = list(map(seen.get, ws))
            total = np.zeros(rows.shape[1])
            if None in at:
                for i, k in enumerate(at):
                    if k is None:
                        k = seen.get(ws[i])
                        if k is None and len(ws[i]) <= LONG and len(seen) < CACHE_LIMIT:
                            k = seen[ws[i]] = len(seen)
                            rows[k] = vector(ws[i])
                        elif k is None:
                            total += vector(ws[i])
                        at[i] = k
                at = [k for k in at if k is not None]
            total += rows[at].sum(0, dtype=np.float64)
            z = (total[:-1] / total[-1] + self.bias) / self.temperature
            p = np.exp(z - z.max())
            p /= p.sum()
            best = int(p.argmax())
            return self.langs[best], float(p[best])

        return one


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_langs: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Logits of every bucket, and the biases. rows: buckets and weights that sum to 1."""
    rng = np.random.default_rng(3)
    e, w, bias = rng.normal(0, 0.1, (BUCKETS, SIZE)), rng.normal(0, 0.1, (SIZE, n_langs)), np.zeros(n_langs)
    steps = epochs * -(-len(rows) // 32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), 32):
            rate = 2.0 * (1 - step / steps) + 0.02
            step += 1
            batch = order[start : start + 32]
            flat = np.concatenate([rows[i][0] for i in batch])
            weight = np.concatenate([rows[i][1] for i in batch])
            cut = np.cumsum([0, *(len(rows[i][0]) for i in batch)])[:-1]
            mean = np.add.reduceat(e[flat] * weight[:, None], cut)
            z = mean @ w + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), y[batch]] -= 1
            back = (p @ w.T)[np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])] * weight[:, None]
            w -= rate / len(batch) * mean.T @ p
            bias -= rate / len(batch) * p.sum(0)
            used, where = np.unique(flat, return_inverse=True)
            for k in range(SIZE):
                e[used, k] -= rate * np.bincount(where, weights=back[:, k])
    return e @ w, bias


def calibrate(z: np.ndarray, y: np.ndarray, precision: float = PRECISION) -> tuple[float, float]:
    """The temperature with the least log loss, and the rejection bound."""
    if not len(y):
        return 1.0, 0.0

    def probabilities(t: float) -> np.ndarray:
        p = np.exp(z / t - (z / t).max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    t = min(np.geomspace(0.05, 20, 60), key=lambda t: -np.log(probabilities(t)[np.arange(len(y)), y] + 1e-12).mean())
    p = probabilities(t)
    top = p.max(1)
    order = np.argsort(-top, kind="stable")
    right = np.cumsum((p.argmax(1) == y)[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(right >= precision)
    return float(t), float(top[order][good[-1]]) if len(good) else 1.0


def fit(docs: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    known = docs.filter(F.col("lang").isNotNull() & (crc_mod(F.col("doc_id"), 3) != 1))
    # the ids with the smallest hashes of each language, so that none is left out; a bound on the hash, by the
    # (estimated) number of a language's ids, first leaves some times as many as wanted, and repeated rows go with it
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))
    wanted = max(LEAST, max_rows // max(sizes.count(), 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    near = known.select("doc_id", "lang", place.alias("place")).join(F.broadcast(sizes), "lang").filter(F.col("place") < 4.0 * wanted / F.col("ids") * (1 << 31))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    first = near.select("doc_id", "lang", "place").distinct().withColumn("rank", rank).filter(F.col("rank") <= wanted)
    chosen = first.groupBy("doc_id").agg(F.min("lang").alias("y"))
    # rows of a chosen id with another language aren't learnt
    sample = known.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.col("lang").alias("y")).join(F.broadcast(chosen), ["doc_id", "y"])

    def both(texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {"whole": [], "few": []}
        for t in texts:
            ws = words(t)
            pick = np.random.default_rng(len(ws)).integers(0, len(ws), 5) if ws else []
            for name, x in (("whole", ws), ("few", [ws[i] for i in pick])):
                out[name].append(np.array(counts(x), "<i4").tobytes())  # buckets, then their counts
        return out

    counted = per_text(sample, ["doc_id", "y", "text_hash"], "text", both, "whole binary, few binary")
    rows = one_per_id(counted, "whole", "few").orderBy("doc_id").toArrow()
    langs = sorted(set(rows.column("y").to_pylist()))
    examples = []
    for doc_id, lang, *pair in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "y", "whole", "few")), strict=True):
        for x in pair:
            buckets, times = np.frombuffer(x, "<i4").reshape(2, -1)
            if len(buckets):
                examples.append((buckets, times / max(times.sum(), 1), langs.index(lang), doc_id))
    if not examples:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    held = np.array([crc32(str(x[3]).encode()) // 3 % 5 == 0 for x in examples]) if len(examples) >= 100 else np.zeros(len(examples), bool)
    y = np.array([x[2] for x in examples])
    many = np.bincount(y, minlength=len(langs))
    held &= many[y] >= 10  # the few examples of a rare language are all learnt, and as often as a quarter of the commonest one's
    learn = np.flatnonzero(~held)
    learn = np.repeat(learn, np.clip(many.max() // (4 * many), 1, 500)[y[learn]])
    logits, bias = train([examples[i][:2] for i in learn], y[learn], len(langs))
    test = np.flatnonzero(held)
    z = np.array([(logits[examples[i][0]] * examples[i][1][:, None]).sum(0) + bias for i in test]).reshape(-1, len(langs))
    temperature, bound = calibrate(z, y[test])
    return Model(langs, logits.astype(np.float32), bias, temperature, bound)


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, lang_pred, score and accepted, one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows
    made: list[Callable[[str], tuple[str, float]]] = []

    def run(texts: list[str]) -> dict[str, list]:
        if not made:
            made.append(shared.value.judge())
        lang, score = zip(*map(made[0], texts), strict=True)
        return {"lang_pred": list(lang), "score": list(score), "accepted": [s >= shared.value.bound and x != UNKNOWN for x, s in zip(lang, score, strict=True)]}

    return per_text(docs, list(keep), text, run, "lang_pred string, score double, accepted boolean")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs))
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "accepted")
