"""Document quality by a linear-chain conditional random field over lines.

Every line of a text (split at newlines; the empty text is one empty line) is
a position of a chain with labels bad (0) and good (1).  Features describe the
line and its neighbours before and after; none of them reads labels, lang,
source or doc_id.  Training lines carry the label of their document; weights
and transitions maximise the regularised conditional likelihood (gradient from
forward-backward, on a bounded sample of ``MAX_DOCS`` labelled documents with
``MAX_LINES`` lines in all, taken in the order of a hash of the id).  A
document's quality is the mean of its lines' marginals weighted by their
length, put through a logistic curve fitted on the same sample.

Scoring is one pass of Arrow batches over all rows and whole texts; the model
(a few hundred numbers) goes with the task.  Null texts count as empty.
Repeated rows get equal scores.  Without labels of both kinds every score is
the share of label 1 (1.0 without labels).  Extra columns are ignored by
``scores`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, materialize, prefix_hash, remainder, segment_reduce, slices, span_hash, utf8_buffer

MAX_DOCS = 6000
MAX_LINES = 150_000
THRESHOLD = 0.7
SLICE_BYTES = 512 << 10  # a step works in some 60 times that

# Byte classes, each a 21-bit field of one of three packed tables; lines of
# FIELD bytes or more are counted in pieces.
FIELD = 1 << 21
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789",
            b" \t\n\v\f\r", b"#*$%&<>", b"|", b"!", b".,;:?'\"()-", bytes(range(0x80, 0x100)))
_PACKED = np.zeros((3, 256), np.uint64)
for _k, _members in enumerate(_CLASSES):
    for _b in _members:
        _PACKED[_k // 3, _b] += np.uint64(1 << (21 * (_k % 3)))
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True


def split_lines(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every line, in order."""
    nl = np.flatnonzero(raw == 10)
    row = np.concatenate([np.arange(len(off) - 1), np.searchsorted(off, nl, side="right") - 1])
    start = np.concatenate([off[:-1], nl + 1])
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    end = np.where(last, off[row + 1], np.append(start[1:], 0) - 1)
    return start, end, row


def line_features(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x features), row and weight of every line of these texts."""
    start, end, row = split_lines(raw, off)
    n, length = len(start), end - start
    size = np.maximum(length, 1).astype(np.float64)
    share = np.empty((n, len(_CLASSES)))
    for t in range(3):
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_PACKED[t][raw], out=total[1:])
        packed = total[end] - total[start]
        for k in range(3):
            share[:, 3 * t + k] = ((packed >> np.uint64(21 * k)) & np.uint64(FIELD - 1)) / size
    for i in np.flatnonzero(length >= FIELD):
        count = sum(np.bincount(raw[a: min(a + FIELD, end[i])], minlength=256) for a in range(start[i], end[i], FIELD))
        share[i] = [count[list(members)].sum() / length[i] for members in _CLASSES]
    prefix = prefix_hash(raw)
    space = _SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off[:-1]] = True
    opens = ~space
    opens[1:] &= space[:-1] | edge[1:-1]
    w_start = np.flatnonzero(opens)
    closes = ~space
    closes[:-1] &= space[1:] | edge[1:-1]
    w_end = np.flatnonzero(closes) + 1
    w_hash = span_hash(prefix, w_start, w_end)
    first_word = np.searchsorted(w_start, start)
    words = np.searchsorted(w_start, end) - first_word
    line_of = np.repeat(np.arange(n), words)
    again = np.zeros(len(w_hash), np.float64)
    again[1:] = (w_hash[1:] == w_hash[:-1]) & (line_of[1:] == line_of[:-1])
    n_again = segment_reduce(np.add, again, first_word, words, 0.0)
    distinct = np.unique(w_hash ^ (line_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    n_distinct = np.bincount(line_of[distinct], minlength=n)
    count = np.maximum(words, 1)
    l_hash = span_hash(prefix, start, end) ^ (row.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    is_first = np.zeros(n, bool)
    is_first[np.unique(l_hash, return_index=True)[1]] = True
    padded = np.append(raw, 0)
    tail = padded[np.maximum(end - 1, 0)]
    head = padded[np.minimum(start, len(raw))]
    lines = np.bincount(row, minlength=len(off) - 1)[row]
    own = np.column_stack([
        share, np.sqrt(share), np.log1p(length), np.minimum(length / count, 40.0) / 10, np.log1p(words),
        n_again / count, n_distinct / count, (words > 4) & (n_distinct < 0.5 * count),
        ~is_first & (words > 0), (tail == 46) | (tail == 33) | (tail == 63), (head >= 65) & (head <= 90),
        words == 0, words < 4, np.log1p(lines), share[:, 0] > 0.5, share[:, 4] > 0.03, share[:, 5] > 0.02,
        share[:, 6] > 0.02])
    blank = np.zeros((1, own.shape[1]))
    inner = np.append(row[1:] == row[:-1], False)[:n] if n else np.zeros(0, bool)
    after = np.where(inner[:, None], np.vstack([own[1:], blank]), 0.0)
    before = np.where(np.roll(inner, 1)[:, None] & (np.arange(n) > 0)[:, None], np.vstack([blank, own[:-1]]), 0.0)
    x = np.column_stack([own, before, after, ~inner, ~np.roll(inner, 1)]).astype(np.float32)
    return x, row, (length + 1).astype(np.float64)


def chains(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and length of each run of equal rows."""
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(row)))


def forward_backward(unary: np.ndarray, move: np.ndarray, first: np.ndarray, length: np.ndarray):
    """Marginals P(good) of all positions, expected transitions, log-likelihood terms.

    unary: score of good over bad at each position; move: 2x2 log potentials.
    Chains advance together, longest first, scaled at each step.
    """
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    pot = np.exp(move - move.max())
    emit = np.empty((len(unary), 2))
    emit[:, 1] = 1 / (1 + np.exp(-np.clip(unary, -60, 60)))
    emit[:, 0] = 1 - emit[:, 1]
    emit = np.maximum(emit, 1e-26)
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    steps = int(length[0]) if len(length) else 0
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(steps + 1)]
    log_z = 0.0
    for t in range(steps):
        at = first[:active[t]] + t
        a = emit[at] if t == 0 else (alpha[at - 1] @ pot) * emit[at]
        total = a.sum(1, keepdims=True)
        log_z += float(np.log(total).sum())
        alpha[at] = a / total
    pairs = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        at = first[:active[t + 1]] + t
        nxt = emit[at + 1] * beta[at + 1]
        b = nxt @ pot.T
        joint = alpha[at][:, :, None] * pot[None] * nxt[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        beta[at] = b / b.sum(1, keepdims=True)
    both = alpha * beta
    return both[:, 1] / both.sum(1), pairs, log_z


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    move: np.ndarray
    slope: float
    shift: float
    constant: float | None = None

    def quality(self, x: np.ndarray, row: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """The score of each of n texts from its lines."""
        if self.constant is not None:
            return np.full(n, self.constant)
        mean = self.raw_quality(x, row, weight, n)
        return 1 / (1 + np.exp(-(self.slope * _logit(mean) + self.shift)))

    def raw_quality(self, x, row, weight, n) -> np.ndarray:
        return self.mean_marginal((x - self.mean) / self.scale, row, weight, n)

    def mean_marginal(self, z, row, weight, n) -> np.ndarray:
        """From standardised features."""
        good, _, _ = forward_backward(z @ self.weight + self.bias, self.move, *chains(row))
        return np.bincount(row, good * weight, n) / np.maximum(np.bincount(row, weight, n), 1e-9)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(x: np.ndarray, row: np.ndarray, weight: np.ndarray, label: np.ndarray,
        steps: int = 150, penalty: float = 1e-3) -> Model:
    """Weights and transitions by Adam on the whole sample; label: one of each text.

    x (float64) is standardised in place, so that one copy of it is held.
    """
    n = len(label)
    if n == 0 or label.min() == label.max():
        return Model(*[np.zeros(0)] * 3, 0.0, np.zeros((2, 2)), 1.0, 0.0,
                     constant=float(label.mean()) if n else 1.0)
    mean, z = x.mean(0), x
    z -= mean
    scale = np.sqrt(np.concatenate([np.square(z[:, k:k + 8]).mean(0) for k in range(0, z.shape[1], 8)])) + 1e-3
    z /= scale
    y = label[row].astype(np.float64)
    first, length = chains(row)
    seen = np.zeros((2, 2))
    inner = np.flatnonzero(row[1:] == row[:-1])
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = np.sum((y[inner] == a) & (y[inner + 1] == b))
    par = np.zeros(z.shape[1] + 1 + 4)
    m, v = np.zeros_like(par), np.zeros_like(par)
    for step in range(1, steps + 1):
        w, bias, move = par[:-5], par[-5], par[-4:].reshape(2, 2)
        good, pairs, _ = forward_backward(z @ w + bias, move, first, length)
        err = (y - good) / n
        grad = np.concatenate([z.T @ err - penalty * w, [err.sum()],
                               ((seen - pairs) / n - 0.05 * move).ravel()])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        par = par + 0.08 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    model = Model(mean, scale, par[:-5], float(par[-5]), par[-4:].reshape(2, 2), 1.0, 0.0)
    u = _logit(model.mean_marginal(z, row, weight, n))
    a, c = 1.0, 0.0
    for _ in range(50):  # Newton steps of a two-parameter logistic curve
        p = 1 / (1 + np.exp(-(a * u + c)))
        h = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((label - p) * u).sum() - 1e-2 * (a - 1), (label - p).sum() - 1e-2 * c])
        hess = np.array([[(h * u * u).sum() + 1e-2, (h * u).sum()], [(h * u).sum(), h.sum() + 1e-2]])
        d = np.linalg.solve(hess, g)
        a, c = a + float(np.clip(d[0], -1, 1)), c + float(np.clip(d[1], -1, 1))
    model.slope, model.shift = max(a, 0.05), c
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          mod: int = 4, held: int = 2, max_docs: int = MAX_DOCS, max_lines: int = MAX_LINES) -> Model:
    """Fit on labelled rows whose crc32(key) mod ``mod`` is not ``held``, up to the documented bounds."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).where(remainder(key, mod) != held) \
        .groupBy(key).agg(F.max(label).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64(key), key).limit(max_docs)
    sample = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(
        F.broadcast(known.select(F.col(key).alias("k"), "y")), "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t", SLICE_BYTES):
            x, row, weight = line_features(*utf8_buffer(part.column(1)))
            first, length = chains(row)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(length.astype(np.int64)),
                 pa.array([x[a:a + k].tobytes() for a, k in zip(first, length)], pa.binary()),
                 pa.array([weight[a:a + k].tobytes() for a, k in zip(first, length)], pa.binary())],
                names=["k", "y", "n", "x", "w"])

    key_t = docs.schema[key].dataType.simpleString()
    rows = sample.select("k", "t", "y").mapInArrow(run, f"k {key_t}, y int, n bigint, x binary, w binary")
    rows = materialize(rows.where(F.col("n") <= max_lines // 10).withColumn("row", F.monotonically_increasing_id()), "features")
    # Keep documents in hash order while their lines stay within the bound, and fetch the features of these, one by one.
    got = sorted(rows.select("k", "y", "n", "row").collect(), key=lambda r: (hash_order(r["k"]), r["k"]))
    take, lines = [], 0
    for r in got:
        if lines + r["n"] <= max_lines:
            take.append(r)
            lines += r["n"]
    sample = rows
    if len(take) < len(got):
        sample = rows.join(F.broadcast(docs.sparkSession.createDataFrame([(r["row"],) for r in take], "row bigint")), "row", "left_semi")
    n = np.array([r["n"] for r in take], np.int64)
    first = dict(zip((r["row"] for r in take), (np.cumsum(n) - n).tolist()))
    x, weight = np.zeros((0, 1)), np.zeros(lines)
    for r in sample.select("n", "x", "w", "row").toLocalIterator():
        part = np.frombuffer(r["x"], np.float32).reshape(r["n"], -1)
        if not len(x):
            x = np.empty((lines, part.shape[1]))
        at = first[r["row"]]
        x[at:at + r["n"]] = part
        weight[at:at + r["n"]] = np.frombuffer(r["w"], np.float64)
    drop(rows)
    return fit(x, np.repeat(np.arange(len(take)), n), weight, np.array([r["y"] for r in take], np.float64))


def hash_order(key) -> int:
    import zlib
    return zlib.crc32(str(key).encode())


def scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score of every row."""
    key_t = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, SLICE_BYTES):
            q = model.quality(*line_features(*utf8_buffer(part.column(1))), part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(q)], names=[key, "score"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {key_t}, score double")


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, columns unchanged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, SLICE_BYTES):
            at = part.schema.get_field_index(text)
            q = model.quality(*line_features(*utf8_buffer(part.column(at))), part.num_rows)
            yield part.filter(pa.array(q >= threshold))

    return docs.mapInArrow(run, docs.schema)
