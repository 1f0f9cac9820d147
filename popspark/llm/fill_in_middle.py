"""Operator 12: fill-in-middle transformation.

A text is cut into units (a run of A-Z and a-z, or one other code point), and
the first, middle and last part of its units change places behind markers.
Where the cuts fall depends on the number of units of the whole text, which is
found without walking over its units:

* A rolling hash over the last ``WINDOW`` bytes cuts the text into chunks; a
  chunk ends where the hash has ``BITS`` low bits of 0, or after ``LONGEST``
  bytes. Equal passages have equal chunks wherever they stand.
* A worker's cache maps a chunk to its boundary summary: units, code points,
  whether it starts and whether it ends with a letter. The chunk's bytes are
  the key, so a hit is verified by comparing them. The cache is bounded and
  only saves work.
* Summaries combine: where one chunk ends and the next starts with a letter,
  one unit spans both, and it counts as ended in the chunk where it ends. Sums
  over the chunks give the number of units of a text and of each of its
  prefixes; a cut is looked up among them, and only the chunk that holds it is
  walked over.

The draws come from the sha256 of ``seed:id``: two cut places, whether the
text stays plain, and the order of the parts. A text that holds a marker stays
plain, so ``restored`` rebuilds every text from the output and its form.

Cases: a null text is an empty one; an empty text is plain with no units; a
null id is drawn as an empty one; rows with equal ids and texts get equal
results; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from popspark.llm.common import table, text_slices

#: bytes that the rolling hash covers, high bits that are 0 where a chunk ends, bytes of the longest chunk
WINDOW, BITS, LONGEST = 16, 7, 4096
#: chunks that a worker's cache holds (about 300 bytes each)
CACHE_LIMIT = 400_000
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_UNIT = re.compile(rb"[A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\x80-\xff][\x80-\xbf]*").finditer
_BYTES = np.arange(256)
_IS_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) & (_BYTES < 128)
_IS_LEAD = (_BYTES & 0xC0) != 0x80
_MIX = np.random.default_rng(12).integers(0, 1 << 32, 256, np.uint32)

Summary = tuple[int, int, bool, bool]  # units, code points, starts with a letter, ends with a letter


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum over the last WINDOW bytes of the byte's number shifted by its distance."""
    h = _MIX[data]
    width = 1
    while width < WINDOW:
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))  # the right side is read before it is written
        width *= 2
    return h


def cut_chunks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where chunks start in ``data``, the texts at [starts, ends) one behind the other; empty texts have none."""
    full = ends > starts
    if not full.any():
        return np.zeros(0, np.int64)
    found = np.flatnonzero(rolling_hash(data) < np.uint32(1 << (32 - BITS))) + 1
    found = found[found < len(data)]
    text = np.searchsorted(starts[full], found, "right") - 1
    found = found[found - starts[full][text] >= WINDOW]  # before that, the hash covers another text
    cuts = np.union1d(found, starts[full])
    gaps = np.diff(np.append(cuts, len(data)))
    long = np.flatnonzero(gaps > LONGEST)
    more = [np.arange(cuts[i] + LONGEST, cuts[i] + gaps[i], LONGEST) for i in long]
    cuts = np.union1d(cuts, np.concatenate(more)) if more else cuts
    while len(inside := np.flatnonzero(~_IS_LEAD[data[cuts]])):  # a cut never splits a code point
        cuts[inside] -= 1
    return np.unique(cuts)


def summarise(chunks: list[bytes]) -> list[Summary]:
    """The boundary summaries of chunks, none of them empty."""
    data = np.frombuffer(b"".join(chunks), np.uint8)
    starts = np.cumsum([0, *map(len, chunks[:-1])])
    letter, lead = _IS_LETTER[data], _IS_LEAD[data]
    begins = lead.copy()  # every code point but a letter behind another letter of the chunk
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[starts] = True
    units = np.add.reduceat(begins, starts, dtype=np.int64)
    chars = np.add.reduceat(lead, starts, dtype=np.int64)
    last = np.append(starts[1:], len(data)) - 1
    return list(zip(units.tolist(), chars.tolist(), letter[starts].tolist(), letter[last].tolist(), strict=True))


@dataclass(frozen=True)
class Plan:
    """How texts are transformed: the draws' seed, and in percent plain texts and the suffix first among the others."""

    seed: str = "1"
    plain_from: int = 90
    suffix_first_below: int = 20

    def draws(self, key: object) -> tuple[int, int, int, int]:
        digest = sha256(f"{self.seed}:{'' if key is None else key}".encode()).digest()
        return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


class Transformer:
    def __init__(self, plan: Plan):
        self.plan = plan
        self.cache: dict[bytes, Summary] = {}

    def summaries(self, chunks: list[bytes]) -> np.ndarray:
        """One row per chunk: units, code points, starts and ends with a letter."""
        known = list(map(self.cache.get, chunks))
        if None in known:
            new = list({c for c, s in zip(chunks, known, strict=True) if s is None})
            got = dict(zip(new, summarise(new), strict=True))
            self.cache.update(islice(got.items(), max(0, CACHE_LIMIT - len(self.cache))))
            known = [got[c] if s is None else s for c, s in zip(chunks, known, strict=True)]
        return np.array(known, np.int64).reshape(-1, 4)

    def run(self, keys: list, texts: list[bytes]) -> Iterator[tuple[int, str, int | None, int | None, bytes]]:
        """(units, form, code points of the prefix and of the middle, output) of each text."""
        data = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        cuts = cut_chunks(np.frombuffer(data, np.uint8), starts, ends)
        bounds = [*cuts.tolist(), len(data)]
        info = self.summaries([data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        first = np.searchsorted(cuts, starts)  # a text's chunks: first up to behind
        behind = np.searchsorted(cuts, ends)
        ended, chars = info[:, 0].copy(), np.cumsum(info[:, 1])
        spans = np.flatnonzero(info[:-1, 3] & info[1:, 2])
        last = behind[ends > starts] - 1
        ended[np.setdiff1d(spans, last)] -= 1  # the chunk's last unit ends in a later one
        ended = np.cumsum(ended)

        def place(k: int, a: int, b: int) -> tuple[int, int]:
            """(byte in data, code points before it in the text) behind the k-th unit of the chunks a up to b."""
            base = int(ended[a - 1]) if a else 0
            c = a + int(np.searchsorted(ended[a:b], base + k))
            j = base + k - (int(ended[c - 1]) if c else 0)
            chunk = data[bounds[c] : bounds[c + 1]]
            at = next(islice(_UNIT(chunk), j - 1, None)).end()
            before = (int(chars[c - 1]) if c else 0) - (int(chars[a - 1]) if a else 0)
            return bounds[c] + at, before + len(chunk[:at].decode())

        for key, text, start, end, a, b in zip(keys, texts, starts.tolist(), ends.tolist(), first.tolist(), behind.tolist(), strict=True):
            n = int(ended[b - 1]) - (int(ended[a - 1]) if a else 0) if b > a else 0
            h1, h2, h3, h4 = self.plan.draws(key)
            if not n or h3 % 100 >= self.plan.plain_from or b"<P>" in text or b"<S>" in text or b"<M>" in text:
                yield n, "plain", None, None, text
                continue
            low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
            x, x_chars = place(low, a, b) if low else (start, 0)
            y, y_chars = place(high, a, b) if high else (start, 0)
            parts = {"P": data[start:x], "M": data[x:y], "S": data[y:end]}
            form = "spm" if h4 % 100 < self.plan.suffix_first_below else "psm"
            yield n, form, x_chars, y_chars - x_chars, b"".join(b"<%s>%s" % (m.encode(), parts[m]) for m in form.upper())


_FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string"


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``key``, n (units), form, prefix_chars, middle_chars and output, one row per row."""
    src = docs.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    ddl = StructType.fromDDL(f"`{key}` {src.dtypes[0][1]}, {_FIELDS}")
    types = to_arrow_schema(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Transformer(plan)
        for batch in batches:
            for part in text_slices(batch, 1):
                rows = own.run(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist())
                columns = [part.column(0)]
                for values, field in zip(zip(*rows, strict=True), list(types)[1:], strict=True):
                    columns.append(pa.array(values, pa.binary()).cast(field.type) if field.name == "output" else pa.array(values, field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return src.mapInArrow(run, ddl)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made from: no part holds a marker, so the markers cut it into its parts."""
    body = F.expr(f"substring({output}, {len(PREFIX) + 1})")
    psm, spm = F.split(body, f"{SUFFIX}|{MIDDLE}", -1), F.split(body, f"{PREFIX}|{MIDDLE}", -1)
    return (
        F.when(F.col(form) == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(F.col(form) == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(F.col(output))
    )


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w,
        CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(w[1:a], '') AS x, array_to_string(w[a + 1:b], '') AS y, array_to_string(w[b + 1:n], '') AS z FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(x) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(y) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
                        ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))
