"""Operator 11: scores of a gated recurrent language model.

Tokens are the words of a text (A-Z lower-cased) and one end. Every distinct
training token is counted, whatever its frequency: the count table is the
result of a shuffle and grows with the corpus.

The model. A gated recurrent unit reads a text's tokens and keeps a state of
``HIDDEN`` numbers. The next token is drawn in two steps: a class, then a
token of the class. The most frequent tokens (``CLASSES * SLOTS`` of them at
most, the end always among them) stand in frequency order in ``CLASSES``
classes, with a softmax over classes and one over the ``SLOTS`` of a class.
All other words fall into ``REST`` further classes by the hash of their last
bytes; within such a class a word has the probability (c + 1) / (n + v + 1)
by its count c, with n occurrences of v words there, and 1 for all unseen
words. So the probabilities of all words add up to 1. Before training, the
biases are the logarithms of the counted shares, which is the unigram model.

Training. All training rows are learnt from, each once. The rows are dealt to
``ROUNDS`` rounds by the hash of their text. In a round every task starts at
the shared parameters and runs truncated backpropagation in numpy (AdaGrad)
over its own rows: texts lie one behind the other in ``LANES`` lanes, a window
is ``STEPS`` tokens of every lane (more where few lanes are left), and the
state is carried from window to window and is 0 where a text begins. At the end of the round the tasks'
changes are averaged, each weighted with the tokens that it was learnt from;
the changes are added up in two shuffles, cut into pieces, and only the sums,
as large as one model (0.5 MB), reach the driver.

Scoring runs over whole texts in the same way, without learning; so the state
runs through all windows of a document. Texts are read into 16-bit codes once,
which are stored for training and scoring. The ``HEAD`` most frequent tokens'
counts are known to every task, bounded by that number. Of the other words, a
document sends (row, word, occurrences) to a shuffle join with the counts; the
result is added to the document's sums.

Words above ``LONG_WORD`` bytes are named by a 128-bit digest. Scores differ in
the last digits with the cut into tasks (32-bit numbers). A task that runs
again gives the same result, as rows come from stored files.

Cases: a null or empty text has the end token only; a null id counts as an
empty one in the split; repeated rows are each counted and scored; without
training rows the counts are 0 and the model is untrained; an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popspark.llm.common import SPACE_BYTES, crc_mod, shuffle_partitions, staged, table, text_slices

HIDDEN, CLASSES, SLOTS, REST = 16, 32, 32, 16
LANES, STEPS, ROUNDS, RATE = 384, 32, 3, 0.1
#: input vectors of words outside the classes, by the hash of their last bytes
TAILS = 256
#: tokens whose counts every task knows, at most
HEAD = 1 << 17
#: words that a task counts before it emits them
HELD = 500_000
LONG_WORD = 40
#: bytes of codes (2 each) that the network runs over at a time, at least one text's; longer texts than ``LONG_CODES`` run together
SLICE_CODES, LONG_CODES = 4_000_000, 8_000
#: numbers of a piece, when changes of the model are added up
PIECE = 1 << 15
MOD, HELD_OUT = 7, 2
END = b" "  # no word holds a blank
_LN10 = float(np.log(10))


def name(word: bytes) -> bytes:
    """The word, or a blank and a digest for a long one."""
    return word if len(word) <= LONG_WORD else b" " + xxhash.xxh3_128_digest(word)


def words(text: bytes) -> list[bytes]:
    return text.translate(SPACE_BYTES).split()


def tail_hash(key: bytes) -> int:
    return crc32(key[-3:])


# ------------------------------------------------------------------- counts
_COUNTS = pa.schema([("key", pa.binary()), ("n", pa.int64())])


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(map(name, held), pa.binary()), pa.array(held.values(), pa.int64())], schema=_COUNTS)
        held.clear()
        return out

    for batch in batches:
        for part in text_slices(batch, 0):
            held[END] += part.num_rows
            for text in part.column(0).cast(pa.binary()).to_pylist():
                held.update(words(text))
            if len(held) >= HELD:
                yield rows()
    if held:
        yield rows()


def count_tokens(texts: DataFrame) -> DataFrame:
    """(key, n) of every distinct token of ``texts`` (one string column, no nulls)."""
    return staged(texts.mapInArrow(_count, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n")), "lm-counts")


@dataclass
class Vocabulary:
    """The most frequent tokens with their counts (the end first), and sums over all tokens."""

    keys: list[bytes]
    counts: np.ndarray
    total: int  # N
    distinct: int  # V
    rest_total: np.ndarray  # per rest class: occurrences, and distinct words
    rest_distinct: np.ndarray

    @property
    def inner(self) -> int:
        """Tokens that stand in classes."""
        return min(len(self.keys), CLASSES * SLOTS)

    @staticmethod
    def of(counts: DataFrame, head: int = HEAD) -> Vocabulary:
        total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        most = counts.filter(F.col("key") != F.lit(END)).orderBy(F.desc("n"), "key").limit(head).toArrow()
        end = counts.filter(F.col("key") == F.lit(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        keys = [END, *most.column("key").to_pylist()]
        own = np.array([end, *most.column("n").to_pylist()], np.int64)
        bucket = F.crc32(F.expr("substring(key, -3, 3)")) % REST
        rest_total, rest_distinct = np.zeros(REST, np.int64), np.zeros(REST, np.int64)
        for r in counts.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
            rest_total[r.b], rest_distinct[r.b] = r.n, r.v
        out = Vocabulary(keys, own, total, distinct, rest_total, rest_distinct)
        for key, n in zip(keys[: out.inner], own.tolist(), strict=False):  # these stand in classes of their own
            rest_total[tail_hash(key) % REST] -= n
            rest_distinct[tail_hash(key) % REST] -= n > 0
        return out

    def tables(self) -> Tables:
        return Tables(self)


class _Numbers(dict):
    """word -> number; a word that isn't known gets the next one, until ``forget``."""

    def __init__(self, keys: list[bytes]):
        super().__init__(zip(keys, range(len(keys)), strict=True))
        self.size, self.keys_, self.added = len(keys), [], []

    def __missing__(self, word: bytes) -> int:
        key = name(word)
        number = self.get(key)
        if number is None:
            number = self[key] = self.size + len(self.keys_)
            self.keys_.append(key)
            self.added.append(key)
        if key is not word:
            self[word] = number
            self.added.append(word)
        return number

    def forget(self) -> list[bytes]:
        """The keys of the new numbers, in their order."""
        keys = self.keys_
        for word in self.added:
            del self[word]
        self.keys_, self.added = [], []
        return keys


class Tables:
    """Per known token: its code, and log10 of what its count adds.

    A code is the place of an inner token, or ``CLASSES * SLOTS`` plus a hash
    of a word's last bytes: the row of its input vector. It fits in 16 bits.
    """

    def __init__(self, v: Vocabulary):
        hashes = np.array([tail_hash(k) for k in v.keys], np.int64)
        at = np.arange(len(v.keys))
        self.number = _Numbers(v.keys)
        self.known = v.counts > 0
        self.code = np.where(at < v.inner, at, CLASSES * SLOTS + hashes % TAILS).astype("<u2")
        self.log_count = np.log10(v.counts + 1)
        self.log_rest = np.log10(v.rest_total + v.rest_distinct + 1)

    def read(self, texts: list[bytes]) -> Tokens:
        return Tokens(self, texts)


def class_of(codes: np.ndarray) -> np.ndarray:
    return np.where(codes < CLASSES * SLOTS, codes // SLOTS, CLASSES + (codes - CLASSES * SLOTS) % REST)


class Tokens:
    """The tokens of some texts, in order; words that the tables lack have further numbers."""

    def __init__(self, t: Tables, texts: list[bytes]):
        find = t.number.__getitem__
        flat: list[int] = []
        lengths: list[int] = []
        for text in texts:
            before = len(flat)
            flat.extend(map(find, words(text)))
            flat.append(0)
            lengths.append(len(flat) - before)
        self.size, self.keys = t.number.size, t.number.forget()
        self.ids = np.array(flat, np.int32)
        self.lengths = np.array(lengths, np.int64)
        hashes = np.array([tail_hash(k) for k in self.keys], np.int64)
        self.codes = np.concatenate([t.code, (CLASSES * SLOTS + hashes % TAILS).astype("<u2")])[self.ids]
        self.new = self.ids >= self.size
        self.text = np.repeat(np.arange(len(texts)), self.lengths)


# -------------------------------------------------------------------- model
#: (name, shape) of the parameters; weights of a change: tokens that used the row of the first axis
SHAPES = {
    "x": (CLASSES * SLOTS + TAILS, 3 * HIDDEN),
    "u": (HIDDEN, 3 * HIDDEN),
    "w1": (HIDDEN, CLASSES + REST),
    "b1": (1, CLASSES + REST),
    "w2": (CLASSES, HIDDEN, SLOTS),
    "b2": (CLASSES, 1, SLOTS),
}


def first_parameters(v: Vocabulary) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(3)
    p = {k: (rng.normal(0, 0.1, s) if k in ("x", "u") else np.zeros(s)).astype(np.float32) for k, s in SHAPES.items()}
    p["x"][:, :HIDDEN] -= 1  # at first the state changes slowly
    inner = np.full(CLASSES * SLOTS, -30.0)
    inner[: v.inner] = np.log(v.counts[: v.inner] + 1.0)
    inner = inner.reshape(CLASSES, SLOTS)
    mass = np.log(np.exp(inner).sum(1, keepdims=True))
    p["b2"][:] = np.maximum(inner - mass, -30)[:, None, :]
    p["b1"][0] = np.concatenate([mass[:, 0], np.log(v.rest_total + v.rest_distinct + 1.0)])
    p["b1"] -= np.log(np.exp(p["b1"] - p["b1"].max()).sum()) + p["b1"].max()
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; an overflow to infinity gives 0."""
    np.negative(x, out=x)
    return _share(x)


def _share(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in place."""
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= -2
    _share(x)
    x *= 2
    x -= 1
    return x


def _softmax(logit: np.ndarray) -> np.ndarray:
    """Exponentials, in place, and their sums per row; no trained logit comes near the bound."""
    if logit.max(initial=0) > 60:
        np.minimum(logit, 60, out=logit)
    np.exp(logit, out=logit)
    return logit @ np.ones(logit.shape[1], logit.dtype)


def _by_lane(values: np.ndarray) -> np.ndarray:
    """(steps, width, lanes) as one row per step and lane."""
    return np.ascontiguousarray(values.transpose(0, 2, 1)).reshape(-1, values.shape[1])


class Network:
    """The recurrent unit and the two softmaxes; ``learn`` also takes a step for every window."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = {k: v.copy() for k, v in parameters.items()}
        self.squares = {k: np.full(s, 1e-2, np.float32) for k, s in SHAPES.items()}
        self.used = {k: np.zeros(s[0] if k in ("x", "w2", "b2") else 1) for k, s in SHAPES.items()}

    def run(self, codes: np.ndarray, lengths: np.ndarray, learn: bool) -> np.ndarray:
        """log10 of the model's part of each text's probability: classes, and slots of the inner tokens."""
        many = len(lengths)
        cls, slot = class_of(codes).astype(np.int16), codes % SLOTS  # 16 bits sort fastest
        # lanes of about equal length, the longest first, so that those still running are the first ones
        fit = len(codes) // max(int(lengths.max(initial=0)), 8 * STEPS)  # no lane shorter than the longest text
        lanes: list[tuple[int, int, list[int]]] = [(0, i, []) for i in range(min(LANES, max(1, fit), many))]
        for i in np.argsort(-lengths, kind="stable").tolist():
            size, k, texts = heapq.heappop(lanes)
            texts.append(i)
            heapq.heappush(lanes, (size + int(lengths[i]), k, texts))
        lanes.sort(key=lambda x: -x[0])
        begins = np.cumsum(lengths) - lengths
        order = np.array([i for _, _, texts in lanes for i in texts], np.int64)
        dealt = lengths[order]
        at = np.cumsum(dealt) - dealt
        target = np.repeat(begins[order] - at, dealt) + np.arange(len(codes))
        keep = np.ones(len(target), np.float32)  # 0 where a text begins
        keep[at] = 0
        reads = codes[target - 1]
        reads[at] = 0  # as behind an end
        sizes = np.array([x[0] for x in lanes])
        at = np.cumsum(sizes) - sizes
        state = np.zeros((HIDDEN, len(sizes)), np.float32)
        logs = np.zeros(len(codes))
        t, longest = 0, int(sizes.max(initial=0))
        while t < longest:
            live = int(np.count_nonzero(sizes > t))
            left = np.minimum(sizes[:live] - t, min(STEPS * max(1, LANES // (live + 1)), 16 * STEPS))
            steps = int(left.max())  # the fewer lanes, the more steps
            place = at[:live] + t + np.minimum(np.arange(steps)[:, None], left - 1)
            valid = np.arange(steps)[:, None] < left
            where = target[place[valid]]
            with np.errstate(over="ignore"):
                state, logs[where] = self._window(reads[place], keep[place], state[:, :live], valid, cls[where], slot[where], learn)
            t += steps
        return np.bincount(np.repeat(np.arange(many), lengths), weights=logs, minlength=many) / _LN10

    def _window(self, reads, keep, h, valid, cls, slot, learn):
        """The states behind the window, and the natural logs of its tokens' probabilities. States have a column per lane."""
        (steps, lanes), kind, width = reads.shape, self.p["u"].dtype, HIDDEN
        weight = np.ascontiguousarray(self.p["u"].T)
        # per step: update gate, reset gate, candidate
        a = np.ascontiguousarray(np.take(self.p["x"], reads, axis=0).transpose(0, 2, 1))
        u = np.empty((steps, 3 * width, lanes), kind)
        before, after = (np.empty((steps, width, lanes), kind) for _ in range(2))
        for t in range(steps):
            own, gates, inner = a[t], u[t], before[t]
            np.multiply(h, keep[t], out=inner)
            np.matmul(weight, inner, out=gates)
            own[: 2 * width] += gates[: 2 * width]
            zr = _sigmoid(own[: 2 * width])
            own[2 * width :] += zr[width:] * gates[2 * width :]
            h = np.subtract(_tanh(own[2 * width :]), inner, out=after[t])
            h *= zr[:width]
            h += inner
        # the places of the window's tokens; nearly always all of them
        own = slice(None) if valid.all() else np.flatnonzero(valid)
        logs, far = self._output(_by_lane(after) if isinstance(own, slice) else np.take(_by_lane(after), own, axis=0), cls, slot, learn)
        if learn:
            back = np.zeros((steps * lanes, width), kind)
            back[own] = far
            back = np.ascontiguousarray(back.reshape(steps, lanes, width).transpose(0, 2, 1))
            self._learn(reads.ravel()[own], keep, own, back, before, a, u)
        return h, logs

    def _output(self, h, cls, slot, learn):
        """Natural logs of the tokens' probabilities, and what the loss gives back to the states."""
        p, n = self.p, np.arange(len(h))
        e = h @ p["w1"]
        e += p["b1"]
        cell = n * e.shape[1] + cls
        logs = e.reshape(-1)[cell].astype(float)
        total = _softmax(e)
        logs -= np.log(total)
        far = None
        if learn:
            e /= total[:, None]
            e.reshape(-1)[cell] -= 1
            far = e @ p["w1"].T
            w1, b1 = h.T @ e, e.sum(0, keepdims=True)
        order = np.argsort(cls, kind="stable")
        bounds = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
        inner = order[: bounds[-1]]
        states, slots = np.take(h, inner, axis=0), slot[inner]
        own_logs, own_far = np.empty(len(inner)), np.zeros_like(h)  # in order; the last rows, of other words, stay 0
        for k in range(CLASSES):
            low, high = bounds[k], bounds[k + 1]
            if low == high:
                continue
            own, at = states[low:high], (n[: high - low], slots[low:high])
            e = own @ p["w2"][k]
            e += p["b2"][k]
            chosen = e[at]
            total = _softmax(e)
            own_logs[low:high] = chosen - np.log(total)
            if learn:
                e /= total[:, None]
                e[at] -= 1
                np.matmul(e, p["w2"][k].T, out=own_far[low:high])
                self._step("w2", k, own.T @ e, high - low)
                self._step("b2", k, e.sum(0, keepdims=True), high - low)
        logs[inner] += own_logs
        if learn:
            back = np.empty_like(order)
            back[order] = n
            far += np.take(own_far, back, axis=0)
            self._step("w1", slice(None), w1, len(h))
            self._step("b1", slice(None), b1, len(h))
        return logs, far

    def _learn(self, flat, keep, own, back, before, a, u) -> None:
        """Backpropagation through the window's steps, and no further. Writes over ``a`` and ``u``."""
        steps, width, lanes = before.shape
        z, r, c = a[:, :width], a[:, width : 2 * width], a[:, 2 * width :]
        # what doesn't depend on the later steps, for all steps at once
        to_c = z * (1 - c * c)
        to_z = (c - before) * z * (1 - z)
        to_r = u[:, 2 * width :] * r * (1 - r)
        stay, gain = 1 - z, r.copy()
        dh = np.zeros((width, lanes), before.dtype)
        for t in range(steps - 1, -1, -1):
            dh += back[t]
            x, y = a[t], u[t]
            dc = np.multiply(dh, to_c[t], out=x[2 * width :])
            np.multiply(dh, to_z[t], out=x[:width])
            np.multiply(dc, to_r[t], out=x[width : 2 * width])
            y[: 2 * width] = x[: 2 * width]
            np.multiply(dc, gain[t], out=y[2 * width :])
            dh *= stay[t]
            dh += self.p["u"] @ y
            dh *= keep[t]
        self._step("u", slice(None), np.matmul(before, u.transpose(0, 2, 1)).sum(0), len(flat))
        order = np.argsort(flat, kind="stable")
        flat = flat[order].astype(np.int64)
        at = order if isinstance(own, slice) else own[order]
        first = np.flatnonzero(np.diff(flat, prepend=-1))
        self._step("x", flat[first], np.add.reduceat(np.take(_by_lane(a), at, axis=0), first), np.diff(np.append(first, len(flat))))

    def _step(self, k: str, rows, slope: np.ndarray, tokens) -> None:
        s = self.squares[k][rows] + slope * slope
        self.squares[k][rows] = s
        slope *= RATE
        slope /= np.sqrt(s, out=s)
        self.p[k][rows] -= slope
        self.used[k][rows] += tokens


# ----------------------------------------------------------------- training
_CHANGES = pa.schema([("piece", pa.int32()), ("salt", pa.int32()), ("change", pa.binary()), ("weight", pa.binary())])


def _flat(values: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([values[k].ravel() for k in SHAPES])


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        size = int(np.prod(s))
        out[k], at = flat[at : at + size].reshape(s).astype(np.float32), at + size
    return out


def _by_length(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Slices of short texts' codes as they come, and of long texts' from several slices, so that lanes end together."""
    held: list[pa.RecordBatch] = []
    size = 0

    def together() -> Iterator[pa.RecordBatch]:
        for batch in pa.Table.from_batches(held).combine_chunks().to_batches():
            yield from text_slices(batch, column, SLICE_CODES)
        held.clear()

    for batch in batches:
        for part in text_slices(batch, column, SLICE_CODES):
            lengths = pc.binary_length(part.column(column))
            long = pc.greater(lengths, LONG_CODES)
            if len(short := part.filter(pc.invert(long))):
                yield short
            if len(rest := part.filter(long)):
                held.append(rest)
                size += pc.sum(lengths.filter(long)).as_py()
            if size >= SLICE_CODES:
                yield from together()
                size = 0
    if held:
        yield from together()


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a column, one text behind the other, and their numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u2"), pc.binary_length(column).to_numpy().astype(np.int64) // 2


def _train(shared_parameters):
    """A task's part of a round: its changes times their weights, and the weights, in pieces."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        net, start = None, None
        for part in _by_length(batches, 0):
            if net is None:
                start = shared_parameters.value
                net = Network(start)
            net.run(*_codes(part.column(0)), learn=True)
        if net is None:
            return
        weight = {k: np.broadcast_to(net.used[k].reshape(-1, *[1] * (len(s) - 1)), s) for k, s in SHAPES.items()}
        w = _flat(weight)
        change = (_flat(net.p).astype(np.float64) - _flat(start)) * w
        salt = TaskContext.get().partitionId() % 64
        pieces = range(0, len(w), PIECE)
        cols = [range(len(pieces)), [salt] * len(pieces), [change[i : i + PIECE].tobytes() for i in pieces], [w[i : i + PIECE].tobytes() for i in pieces]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _CHANGES, strict=True)], schema=_CHANGES)

    return run


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per piece of a task's rows."""
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for piece, _, *pair in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pair = [np.frombuffer(x) for x in pair]
            sums[piece] = [a + b for a, b in zip(sums[piece], pair, strict=True)] if piece in sums else pair
    if sums:
        cols = [list(sums), [0] * len(sums), [c.tobytes() for c, _ in sums.values()], [w.tobytes() for _, w in sums.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _CHANGES, strict=True)], schema=_CHANGES)


def train(encoded: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Parameters learnt from all rows of ``encoded`` (a column codes)."""
    spark = encoded.sparkSession
    parameters = first_parameters(vocabulary)
    ddl = "piece int, salt int, change binary, weight binary"
    for k in range(rounds):
        own = encoded.select("codes").filter(F.pmod(F.xxhash64("codes"), F.lit(rounds)) == k)
        changes = own.mapInArrow(_train(spark.sparkContext.broadcast(parameters)), ddl)
        some = changes.repartition(shuffle_partitions(spark), "piece", "salt").mapInArrow(_add_up, ddl)
        sums = some.repartition(shuffle_partitions(spark), "piece").mapInArrow(_add_up, ddl).orderBy("piece").toArrow()
        if not sums.num_rows:
            continue
        change, weight = (np.concatenate([np.frombuffer(x) for x in sums.column(c).to_pylist()]) for c in ("change", "weight"))
        parameters = _shaped(_flat(parameters) + change / np.maximum(weight, 1))
    return parameters


# ------------------------------------------------------------------ scoring
_ENCODED = "codes binary, n_tokens long, n_known long, base double, fixed double, rest array<struct<key: binary, n: long>>"


def _encode(shared):
    """Codes of every text, sums over the words that every task knows, and the other words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = None
        for batch in batches:
            for part in text_slices(batch, 2):
                if t is None:
                    t = shared.value.tables()
                tokens = t.read(part.column(2).cast(pa.binary()).to_pylist())
                many, near, cls = part.num_rows, ~tokens.new, class_of(tokens.codes.astype(np.int32))
                ids, of = tokens.ids[near], tokens.text[near]
                known = np.bincount(of, weights=t.known[ids], minlength=many)
                base = np.bincount(of, weights=t.log_count[ids], minlength=many)
                rest = cls >= CLASSES  # what the counts add to the model's probability
                fixed = -np.bincount(tokens.text[rest], weights=t.log_rest[cls[rest] - CLASSES], minlength=many).astype(float)
                outer = near & rest
                fixed += np.bincount(tokens.text[outer], weights=t.log_count[tokens.ids[outer]], minlength=many)
                # the words that the tables lack: (text, word, occurrences)
                width = len(tokens.keys) + 1
                pairs, times = np.unique(tokens.text[tokens.new] * width + tokens.ids[tokens.new] - tokens.size, return_counts=True)
                texts, at = np.divmod(pairs, width)
                keys = pa.array(tokens.keys, pa.binary()).take(pa.array(at, pa.int64()))
                offsets = pa.array(np.searchsorted(texts, np.arange(many + 1)), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([keys, pa.array(times, pa.int64())], names=["key", "n"]))
                data, ends = tokens.codes.tobytes(), np.cumsum(2 * tokens.lengths).tolist()
                codes = pa.array([data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], pa.binary())
                cols = [part.column(0), part.column(1), codes, pa.array(tokens.lengths), pa.array(known.astype(np.int64)), pa.array(base.astype(float)), pa.array(fixed), lists]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "held_out", "codes", "n_tokens", "n_known", "base", "fixed", "rest"])

    return run


def _score(parameters):
    """The model's part of each row's score, in place of its codes, the last column."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = None
        for batch in _by_length(batches, 6):
            if net is None:
                net = Network(parameters.value)
            score = net.run(*_codes(batch.column(6)), learn=False)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(score)], names=[*batch.schema.names[:6], "score"])

    return run


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", mod: int = MOD, held_out: int = HELD_OUT, head: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """``key``, held_out, n_tokens, n_known, train_tokens, base_score and score (log10), one row per row."""
    spark = docs.sparkSession
    out = (crc_mod(F.col(f"`{key}`"), mod) == held_out).alias("held_out")
    src = docs.select(F.col(f"`{key}`").alias("id"), out, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    counts = count_tokens(src.filter(~F.col("held_out")).select("text"))
    vocabulary = Vocabulary.of(counts, head)
    kind = src.dtypes[0][1]
    encoded = src.mapInArrow(_encode(spark.sparkContext.broadcast(vocabulary)), f"id {kind}, held_out boolean, {_ENCODED}")
    encoded = staged(encoded.withColumn("row", F.monotonically_increasing_id()), "lm-codes")
    parameters = spark.sparkContext.broadcast(train(encoded.filter(~F.col("held_out")), vocabulary, rounds))
    sums = f"row long, id {kind}, n_tokens long, n_known long, base double, fixed double, score double"
    scored = encoded.select("row", "id", "n_tokens", "n_known", "base", "fixed", "codes").mapInArrow(_score(parameters), sums)
    looked_up = encoded.select("row", F.explode("rest").alias("w")).select("row", "w.key", F.col("w.n").alias("times")).join(counts, "key", "left")
    c = F.coalesce("n", F.lit(0))
    rest = looked_up.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rest_known"),
        F.sum(F.col("times") * F.log10(c + 1)).alias("rest_log"),
    )
    both = scored.join(rest, "row", "left")
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    under = float(np.log10(vocabulary.total + vocabulary.distinct + 1))
    return both.select(
        F.col("id").alias(key),
        (crc_mod(F.col("id"), mod) == held_out).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + rest_log - F.col("n_tokens") * under).alias("base_score"),
        (F.col("score") + F.col("fixed") + rest_log).alias("score"),
    )


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
