"""Operator 2: quality classifier.

A document becomes ``len(NAMES)`` statistics of its whole text. Random Fourier
features (cosines of random projections) approximate a Gaussian kernel over
the standardised statistics. Ridge scores solve the normal equations, whose
sums every partition adds up for its own rows; the partitions' sums are added
in two steps, and only those matrices reach the driver. Isotonic regression on
other rows turns scores into probabilities.

At most ``MAX_ROWS`` labelled rows that are not held out are used, one for an id;
one in four of them calibrates. All documents are scored.

Cases: a null or empty text has statistics of 0 and gets a score like any
other; repeated rows are each scored; without labels the score is 0.5, and
with one class only that class; a row with a null id is never a training row.
"""

from __future__ import annotations

import operator
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popspark.llm.common import crc_mod, labelled_sample, one_per_id, per_text, staged, table

#: labelled rows that the classifier learns from, at most
MAX_ROWS = 20_000
FEATURES, WIDTH, RIDGE = 256, 2.0, 1e-3
THRESHOLD = 0.3

_CLASSES = {
    "upper": string.ascii_uppercase,
    "lower": string.ascii_lowercase,
    "digit": string.digits,
    "stop": ".,;:",
    "mark": "!?",
    "bar": "|",
    "symbol": "%$*&#@^~+=<>{}[]\\/_`",
}
NAMES = [*_CLASSES, "wide", "log_words", "word_length", "distinct", "repeats", "lines", "distinct_lines", "symbols_in_words", "upper_words", "longest"]


def statistics(text: str) -> list[float]:
    """Shares and means over the whole text, in the order of NAMES."""
    raw = text.encode()
    n = max(len(raw), 1)
    out = [1 - len(raw.translate(None, c.encode())) / n if raw else 0.0 for c in _CLASSES.values()]
    ws = raw.split()
    m = max(len(ws), 1)
    lines = raw.split(b"\n")
    kinds = set(ws)
    out.append((len(raw) - len(text)) / n)
    out += [
        float(np.log1p(len(ws))),
        sum(map(len, ws)) / m,
        len(kinds) / m,
        sum(map(operator.eq, ws, ws[1:])) / m,
        len(lines) / m,
        len(set(lines)) / len(lines),
        (out[4] + out[6]) * n / m,
        sum(map(bytes.isupper, kinds)) / max(len(kinds), 1),
        float(np.log1p(max(map(len, kinds), default=0))),
    ]
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    project: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    knots: np.ndarray  # scores at which the calibrated values stand
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.project + self.phase
        return np.hstack([np.cos(z) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def isotonic(scores: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step function closest to the labels (pooled adjacent violators)."""
    at, inverse, count = np.unique(scores, return_inverse=True, return_counts=True)
    total = np.bincount(inverse, weights=y, minlength=len(at))
    pools: list[list[float]] = []  # sum of labels, count, lowest and highest score
    for x, v, c in zip(at.tolist(), total.tolist(), count.tolist(), strict=True):
        pools.append([v, c, x, x])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            high, low = pools.pop(), pools.pop()
            pools.append([low[0] + high[0], low[1] + high[1], low[2], high[3]])
    knots = [x for p in pools for x in ((p[2], p[3]) if p[3] > p[2] else (p[2],))]
    values = [p[0] / p[1] for p in pools for _ in range(2 if p[3] > p[2] else 1)]
    return np.array(knots), np.array(values)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy().reshape(len(column), -1) if len(column) else np.empty((0, len(NAMES)))


def _sums(rows: DataFrame, model: Model) -> np.ndarray:
    """Sum over all rows of [features, y]' [features, y], added within partitions, then in 16 tasks, then here."""
    width = FEATURES + 2

    def add(batches):
        total = None
        for rb in batches:
            phi = np.hstack([model.features(_matrix(rb.column(0))), rb.column(1).to_numpy()[:, None].astype(float)])
            total = phi.T @ phi if total is None else total + phi.T @ phi
        if total is not None:
            yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]}, schema=pa.schema([("m", pa.binary())]))

    def join(batches):
        total = None
        for rb in batches:
            for x in rb.column(0).to_pylist():
                m = np.frombuffer(x).reshape(width, width)
                total = m if total is None else total + m
        if total is not None:
            yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]}, schema=pa.schema([("m", pa.binary())]))

    parts = rows.select("x", "y").mapInArrow(add, "m binary").repartition(16).mapInArrow(join, "m binary").collect()
    return sum((np.frombuffer(r.m).reshape(width, width) for r in parts), np.zeros((width, width)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    sample = per_text(labelled_sample(docs, labels, label, max_rows), ["doc_id", "y", "text_hash"], "text", lambda texts: {"x": list(map(statistics, texts))}, "x array<double>")
    rows = staged(one_per_id(sample, "x").repartition(8, "doc_id"), "quality-sample")
    d = len(NAMES)
    rng = np.random.default_rng(11)
    model = Model(np.zeros(d), np.ones(d), rng.normal(0, 1 / WIDTH, (d, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or ones in (0, n):
        return model if not n else Model(model.mean, model.scale, model.project, model.phase, model.weight, np.zeros(1), np.full(1, float(ones > 0)))
    moments = rows.agg(*(f(F.col("x")[i]).alias(f"{f.__name__}{i}") for f in (F.avg, F.stddev_pop) for i in range(d))).first()
    model.mean, model.scale = np.array(moments[:d], float), np.maximum(np.array(moments[d:], float), 1e-6)
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(4)) == 0
    split = n >= 400  # fewer rows do both
    total = _sums(rows.filter(~calibrates) if split else rows, model)
    ridge = RIDGE * total[-2, -2] * np.eye(FEATURES + 1)
    model.weight = np.linalg.solve(total[:-1, :-1] + ridge, total[:-1, -1])
    others = (rows.filter(calibrates) if split else rows).select("x", "y").toArrow()
    x = np.array(others.column("x").to_pylist(), float).reshape(-1, d)
    model.knots, model.values = isotonic(model.raw(x), others.column("y").to_numpy().astype(float))
    return model


def score_documents(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and score, one row per document."""
    return per_text(docs, list(keep), text, lambda texts: {"score": model.score(np.array(list(map(statistics, texts)))).tolist()}, "score double")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
