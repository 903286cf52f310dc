"""Shared helpers: reading tables, Arrow text buffers, written intermediates."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, hadoop_delete, scratch_path

#: The six ASCII white-space characters that end a word, as SQL and as Python.
WORD_RE = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage in a way that survives the loss of executors.
    """
    spark = df.sparkSession
    release(spark)
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these, after their last reader has run."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
            hadoop_delete(df.sparkSession, path)
    if tables:
        release(tables[0].sparkSession)


def remainder(col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def text_array(column) -> pa.Array:
    """A string column as one Arrow array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null("") if column.null_count else column


def utf8_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and the n+1 offsets of its rows."""
    arr = text_array(column)
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    off = np.frombuffer(arr.buffers()[1], np.int64 if wide else np.int32)
    off = off[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)
    data = arr.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Split Arrow batches so that each holds about ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        _, off = utf8_buffer(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and multiply), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def segment_reduce(ufunc, values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, empty):
    """``ufunc`` over consecutive segments; ``empty`` for segments of length 0."""
    out = np.full(len(starts), empty, dtype=values.dtype)
    full = lengths > 0
    if full.any():
        out[full] = ufunc.reduceat(values, starts[full])
    return out


# --- hashes of any byte span, from prefix sums modulo 2**64 ----------------

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A random-looking 64-bit value for each byte, made by the mixer.
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(1 << 16, n + n // 16)
        for name, r in (("up", _BASE), ("down", _INVERSE)):
            row = np.full(size, np.uint64(r), np.uint64)
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """S with S[j]-S[i] = hash of raw[i:j] times base**i, modulo 2**64."""
    up, _ = _powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:len(raw)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each span raw[start:end], the same wherever the bytes stand."""
    _, down = _powers(len(prefix) + 1)
    x = (prefix[end] - prefix[start]) * down[start]
    return mix64(x ^ np.uint64(salt)) if salt else mix64(x)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of these texts, and the number of words of each text."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(off) - 1, np.int64)
    solid = ~_BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    end[:-1] &= ~solid[1:] | edge[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return start, end, np.diff(np.searchsorted(start, off))


def shingle_sets(raw: np.ndarray, off: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles.

    A-Z count as a-z.  A text of fewer words gives its whole sequence as one
    shingle, a text without words none.
    """
    raw = lower_ascii(raw)
    start, end, count = word_spans(raw, off)
    h = span_hash(prefix_hash(raw), start, end)
    n = max(len(h) - width + 1, 0)
    many = np.zeros(n, np.uint64)
    for k in range(width):
        many = many * np.uint64(_BASE) + h[k: n + k]
    many = mix64(many)
    first = np.concatenate([[0], np.cumsum(count)])
    out = []
    for i, c in enumerate(count.tolist()):
        a = int(first[i])
        if c >= width:
            out.append(np.unique(many[a: a + c - width + 1]))
        elif c:
            x = np.uint64(c)
            with np.errstate(over="ignore"):
                for v in h[a: a + c]:
                    x = x * np.uint64(_BASE) + v
            out.append(mix64(np.array([x], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
