"""Operator 7: toxicity by a factorization machine over hashed terms.

The terms of a text are its words and their first 4 and 5 bytes, hashed to 32
bits. The machine adds to the linear weights an inner product of small vectors
for every pair of terms, so a pair such as insult and group name can count for
more than both alone. A document's score is the logistic of

    w0 + sum_i w_i + 1/2 sum_f [(sum_i v_if)^2 - sum_i v_if^2]

over its distinct terms. The machine is trained with numpy (AdaGrad) on at
most ``MAX_ROWS`` labelled rows that are not held out, one for an id; their term hashes
are computed where their texts are. Terms are chosen by their association with
the label, which leaves a machine of at most ``MAX_TERMS`` terms for every
task. All documents are then scored from their whole texts.

Cases: a null or empty text has no terms and scores the base rate; repeated
rows are each scored; without labels, or with one class only, the score is the
base rate (0 without labels); a row with a null id is never a training row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popspark.llm.common import crc_mod, labelled_sample, one_per_id, per_text, staged, table, words

#: labelled rows that the machine learns from, at most
MAX_ROWS = 20_000
MAX_TERMS, FACTORS, EPOCHS = 4_000, 4, 30
THRESHOLD = 0.5
#: words whose terms a worker remembers
CACHE_LIMIT = 200_000


def word_terms(word: bytes) -> set[int]:
    return {crc32(b"w" + word), crc32(b"4" + word[:4]), crc32(b"5" + word[:5])}


def text_terms(text: str) -> list[int]:
    return sorted(set().union(*map(word_terms, set(words(text)))))


@dataclass
class Machine:
    bias: float
    place: dict[int, int]  # term -> row
    weight: np.ndarray
    factors: np.ndarray

    def raw(self, rows: list[int]) -> float:
        if not rows:
            return self.bias
        v = self.factors[rows]
        total = v.sum(0)
        return self.bias + self.weight[rows].sum() + 0.5 * float(total @ total - (v * v).sum())

    def scorer(self) -> Callable[[str], float]:
        seen: dict[bytes, tuple[int, ...]] = {}
        place = self.place

        def score(text: str) -> float:
            rows: set[int] = set()
            for w in set(words(text)):
                own = seen.get(w)
                if own is None:
                    own = tuple(place[t] for t in word_terms(w) if t in place)
                    if len(seen) < CACHE_LIMIT:
                        seen[w] = own
                if own:
                    rows.update(own)
            return sigmoid(self.raw(sorted(rows)))

        return score


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, rows, ones): a task's part of how many rows, and how many of label 1, hold a term."""
    for rb in batches:
        docs = [np.frombuffer(x, "<u4") for x in rb.column(0).to_pylist()]
        y = np.repeat(rb.column(1).to_numpy(), [len(d) for d in docs])
        terms, inverse = np.unique(np.concatenate(docs), return_inverse=True)
        ones = np.bincount(inverse, weights=y, minlength=len(terms)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int64)), pa.array(np.bincount(inverse, minlength=len(terms))), pa.array(ones)], names=["term", "rows", "ones"])


def choose_terms(sample: DataFrame, limit: int = MAX_TERMS) -> np.ndarray:
    """The terms most associated with the label (by the chi-square statistic), in at least two rows."""
    n, ones = sample.agg(F.count(F.lit(1)), F.sum("y")).first()
    counts = sample.select("terms", "y").mapInArrow(_count_terms, "term long, rows long, ones long").groupBy("term").agg(F.sum("rows").alias("rows"), F.sum("ones").alias("ones"))
    r, k = F.col("rows").cast("double"), F.col("ones").cast("double")
    chi = F.pow(k * n - r * ones, F.lit(2)) / (r * F.greatest(n - r, F.lit(0.5)) * ones * (n - ones)) * n
    best = counts.withColumn("chi", chi).filter((r >= 2) & (F.col("chi") > 6.63))  # a chance of 0.01
    return np.array([x.term for x in best.orderBy(F.desc("chi"), "term").limit(limit).collect()], np.int64)


def constant(rate: float) -> Machine:
    return Machine(float(np.clip(np.log(max(rate, 1e-18) / max(1 - rate, 1e-18)), -40, 40)), {}, np.zeros(0), np.zeros((0, FACTORS)))


def train(rows: list[np.ndarray], y: np.ndarray, terms: np.ndarray, k: int = FACTORS, epochs: int = EPOCHS) -> Machine:
    """A machine fitted by AdaGrad on batches of rows, given as places in ``terms``."""
    ones = float(y.sum())
    place = {int(t): i for i, t in enumerate(terms)}
    rng = np.random.default_rng(7)
    bias, w, v = float(np.log(ones / (len(y) - ones))), np.zeros(len(terms)), rng.normal(0, 0.01, (len(terms), k))
    gw, gv = np.full_like(w, 1e-6), np.full_like(v, 1e-6)
    rate, decay, size = 0.2, 1e-6, 128
    for _ in range(epochs):
        shuffled = rng.permutation(len(y))
        for start in range(0, len(y), size):
            batch = shuffled[start : start + size]
            own = [rows[i] for i in batch]
            flat = np.concatenate(own)
            if not len(flat):
                continue
            of = np.repeat(np.arange(len(batch)), [len(r) for r in own])
            x = v[flat]
            total = np.zeros((len(batch), k))
            np.add.at(total, of, x)
            squares = np.bincount(of, weights=(x * x).sum(1), minlength=len(batch))
            raw = bias + np.bincount(of, weights=w[flat], minlength=len(batch)) + 0.5 * ((total * total).sum(1) - squares)
            slope = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - y[batch])[of]
            used, where = np.unique(flat, return_inverse=True)
            dw = np.bincount(where, weights=slope) + decay * len(batch) * w[used]
            dv = np.zeros((len(used), k))
            np.add.at(dv, where, slope[:, None] * (total[of] - x))
            dv += decay * len(batch) * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= rate * dv / np.sqrt(gv[used])
    return Machine(bias, place, w, v)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> Machine:
    """Counts terms and chooses among them where the texts are; only the chosen terms' places are collected."""
    rows = per_text(labelled_sample(docs, labels, label, max_rows), ["doc_id", "y", "text_hash"], "text", lambda texts: {"terms": [np.array(text_terms(t), "<u4").tobytes() for t in texts]}, "terms binary")
    sample = staged(one_per_id(rows, "terms").repartition(8, "doc_id"), "toxicity-sample")
    n, ones = sample.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or ones in (0, n):
        return constant(ones / n if n else 0.0)
    terms = choose_terms(sample)
    order = np.argsort(terms)
    ranked = terms[order]

    def places(batches):
        for rb in batches:
            own = []
            for x in rb.column(2).to_pylist():
                d = np.frombuffer(x, "<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(ranked, d), max(len(ranked) - 1, 0))
                own.append(order[at[ranked[at] == d]].astype("<u2").tobytes() if len(ranked) else b"")
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(own, pa.binary())], names=["doc_id", "y", "places"])

    got = sample.select("doc_id", "y", "terms").mapInArrow(places, "doc_id long, y int, places binary").orderBy("doc_id").toArrow()
    own = [np.frombuffer(x, "<u2").astype(np.int64) for x in got.column("places").to_pylist()]
    return train(own, got.column("y").to_numpy().astype(float), terms)


def score_documents(docs: DataFrame, machine: Machine, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and score, one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # at most MAX_TERMS terms
    made: list[Callable[[str], float]] = []

    def run(texts: list[str]) -> dict[str, list]:
        if not made:
            made.append(shared.value.scorer())
        return {"score": list(map(made[0], texts))}

    return per_text(docs, list(keep), text, run, "score double")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of documents that aren't judged toxic, with all their columns."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    return score_documents(row, fit(docs, labels), ("row",)).filter(F.col("score") < THRESHOLD).select("row.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
