"""Operator 8: license scan by an exact set-similarity join with containment.

The word sequence of a document is cut into blocks of ``BLOCK`` words, each
starting half a block after the one before, so any stretch of up to half a
block lies whole in some block. A template is a set of words. A block and a
template match when the block holds at least ``threshold`` of the template's
words.

The join is exact. Words are ordered by their frequency in the whole corpus,
rarest first. A block that holds at least ``need`` of a template's n words
holds one of its first n - need + 1 in that order, the prefix; so only words
of prefixes are indexed, and the blocks around their places are the
candidates. The length filter drops blocks with fewer distinct words than
needed. The positional filter drops a pair whose first common word stands so
late in the template that the words behind it can't make up the need. What is
left is verified by counting common words.

Base phrases are templates with threshold 1 whose matches are then checked
for consecutive places. The frequency is counted for template words only (no
other word is ever compared); those counts are as many as the templates have
words, whatever the corpus.

Cases: a null or empty text has no words, no labels and score 0; repeated rows
are each scanned; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popspark.llm.common import per_text, table, words

BLOCK = 64
THRESHOLD = 0.8
#: fixed values: phrases of the base labels
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
#: fixed values: opening words of public license notices, with the method's labels
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


class Join:
    """The template side: prefixes, and the order of the words by frequency."""

    def __init__(self, frequency: dict[str, int], templates=TEMPLATES, base=BASE, threshold: float = THRESHOLD, block: int = BLOCK):
        self.block = block
        self.sets: list[tuple[str, list[bytes], int, tuple[bytes, ...] | None]] = []
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}  # word -> (template, place in its order)
        entries = [(label, text, threshold, False) for label, text in templates] + [(label, text, 1.0, True) for label, text in base.items()]
        for label, text, share, exact in entries:
            phrase = tuple(words(text))
            if len(phrase) > block // 2:
                raise ValueError(f"a template is longer than half a block: {text}")
            order = sorted(set(phrase), key=lambda w: (frequency.get(w.decode(), 0), w))
            need = -(-round(share * 1000) * len(order) // 1000)
            k = len(self.sets)
            self.sets.append((label, order, need, phrase if exact else None))
            for place, w in enumerate(order[: len(order) - need + 1]):
                self.prefix.setdefault(w, []).append((k, place))
        self.indexed = frozenset(self.prefix)

    def matches(self, ws: list[bytes]) -> Iterator[tuple[int, int, float]]:
        """(template, start of the block, containment) of every match."""
        if self.indexed.isdisjoint(ws):
            return
        half = self.block // 2
        last = max(0, -(-(len(ws) - self.block) // half))  # number of the last block
        firsts: dict[tuple[int, int], int] = {}  # (block, template) -> place of the first common word
        for at, w in enumerate(ws):
            for k, place in self.prefix.get(w, ()):
                for b in range(max(0, min(at // half - 1, last)), min(at // half, last) + 1):
                    firsts[b, k] = min(place, firsts.get((b, k), place))
        cut: dict[int, set[bytes]] = {}
        for (b, k), place in firsts.items():
            _, order, need, _ = self.sets[k]
            if len(order) - place < need:  # position
                continue
            block = cut.get(b)
            if block is None:
                block = cut[b] = set(ws[b * half : b * half + self.block])
            if len(block) < need:  # length
                continue
            common = sum(w in block for w in order[place:])
            if common >= need:
                yield k, b * half, common / len(order)

    def scan(self, text: str) -> tuple[int, list[int], list[str], list[str], float]:
        """Number of words, starts of base places, base labels, all labels, score."""
        ws = words(text)
        places: set[tuple[int, int]] = set()
        labels: set[str] = set()
        score = 0.0
        for k, start, share in self.matches(ws):
            label, order, _, phrase = self.sets[k]
            if phrase is None:
                labels.add(label)
                score = max(score, share)
                continue
            n = len(phrase)
            for i in range(start, min(start + self.block, len(ws)) - n + 1):
                if ws[i] == phrase[0] and tuple(ws[i : i + n]) == phrase:
                    places.add((i, k))
        base = {self.sets[k][0] for _, k in places}
        return len(ws), [i for i, _ in sorted(places)], sorted(base), sorted(labels | base), 1.0 if base else score


def word_frequency(docs: DataFrame, wanted: set[str], text: str = "text") -> dict[str, int]:
    """How many documents hold each of the wanted words."""
    keys = {w.encode() for w in wanted}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found.update(keys.intersection(words(t)))
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in found], "n": list(found.values())}, schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

    counts = docs.select(text).mapInArrow(count, "word string, n long")
    return {r.word: r.n for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan_documents(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", templates=TEMPLATES, base=BASE) -> DataFrame:
    """``keep``, n_words, places (starts of base phrases), base and all (labels) and score."""
    wanted = {w.decode() for t in [*(x for _, x in templates), *base.values()] for w in words(t)}
    join = Join(word_frequency(docs, wanted, text), templates, base)

    def run(texts: list[str]) -> dict[str, list]:
        n, places, of_base, labels, score = zip(*map(join.scan, texts), strict=True)
        return {"n_words": list(n), "places": list(places), "base": list(of_base), "all": list(labels), "score": list(score)}

    return per_text(docs, list(keep), text, run, "n_words long, places array<long>, base array<string>, all array<string>, score double")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_documents(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.concat_ws(",", "base").alias("base_labels"),
        F.concat_ws(",", "all").alias("labels"),
        "score",
    )
