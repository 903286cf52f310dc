"""Exact substring de-duplication by prefix-free parsing and suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
anywhere else in the corpus (overlaps and the same text included; strings
never cross texts).

1. Triggers.  Rolling hashes of ``GRAM`` bytes; of each run of ``REACH``
   positions the smallest hash (the rightmost of equals) is its trigger, so
   every LENGTH-byte string has one, at the same place wherever it stands.
2. Phrases.  The strings with the same trigger form one phrase: the text from
   the first of them to the end of the last.  Neighbouring phrases overlap by
   LENGTH-1 bytes, so every string lies whole in one phrase of the parse.
3. Dictionary and parse.  Equal phrases are counted with partial aggregation.
   A phrase that the parse holds twice is repeated in all its strings.  One
   whose core (trigger and the bytes that all its strings share) is in no
   other phrase repeats nothing.  Only what is left - different phrases around
   one core - is fetched and sorted.
4. Order.  The suffixes of those dictionary phrases are sorted by prefix
   doubling; equal neighbours over LENGTH bytes, weighed by how often the
   parse holds their phrases, are the repeated strings.  As a string never
   reaches beyond its phrase, the parse enters the corpus order by these
   weights alone.  Phrases around a core with more than ``HOT`` different
   phrases (a passage that a large part of all texts shares, followed by
   different text) aren't brought together: their strings are counted by
   64-bit hashes within their core, with partial aggregation.
5. The repeated starts of each text come back to it by a digest of the text,
   and one pass over all rows cuts their union.

Null texts count as empty.  Texts shorter than LENGTH keep all bytes.  Rows
with equal texts get equal results, repeated rows too.  A null id is kept as
it is.  Memory of a task is bounded by the longest text and by a part of about
``PART_ROWS`` phrases.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, materialize, prefix_hash, slices, span_hash, utf8_buffer


LENGTH = 200
GRAM = 16
REACH = 150
SLICE_BYTES = 1 << 20
PART_ROWS = 3000
HOT = 10_000  # at about 275 bytes each, a few hundred MB of arrays in the task that sorts them
_CORE = LENGTH - REACH + 1


def phrases(raw: np.ndarray, off: np.ndarray):
    """row, lo, n, core hash, phrase hash of every phrase; lo counts from the text's start.

    The phrase holds the n strings starting at lo, lo+1, ...
    """
    n = len(raw)
    starts = np.maximum(np.diff(off) - LENGTH + 1, 0)
    if not starts.sum():
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    prefix = prefix_hash(raw)
    pos = np.arange(n - GRAM + 1)
    key = (span_hash(prefix, pos, pos + GRAM) & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - pos.astype(np.uint64))
    # sliding minimum from running minima of blocks, forwards and backwards
    blocks = -(-len(key) // REACH) + 1
    full = np.full(blocks * REACH, np.uint64(0xFFFFFFFFFFFFFFFF))
    full[:len(key)] = key
    grid = full.reshape(blocks, REACH)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    row = np.repeat(np.arange(len(starts)), starts)
    at = np.arange(len(row)) + np.repeat(off[:-1] - (np.cumsum(starts) - starts), starts)
    trigger = (np.uint64(0xFFFFFFFF) - (np.minimum(back[at], ahead[at + REACH - 1]) & np.uint64(0xFFFFFFFF))).astype(np.int64)
    first = np.flatnonzero(np.append(True, (trigger[1:] != trigger[:-1]) | (row[1:] != row[:-1])))
    count = np.diff(np.append(first, len(at)))
    lo, t = at[first], trigger[first]
    core = span_hash(prefix, t, t + _CORE, salt=0x6A09E667F3BCC908)
    whole = span_hash(prefix, lo, lo + count + LENGTH - 1)
    r = row[first]
    return r, lo - off[r], count, core, whole


def repeated_starts(strings: list[bytes], weight: np.ndarray) -> list[np.ndarray]:
    """For each phrase the starts whose LENGTH bytes occur more than once in the parse.

    The suffix array of all phrases of a part, weighed by occurrences.
    """
    size = np.array([len(s) for s in strings], np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    raw = np.frombuffer(b"".join(strings), np.uint8)
    # eight bytes at a time; a phrase's end sorts first
    pad = np.append(raw, np.zeros(7, np.uint8)).astype(np.uint64)
    word = np.zeros(len(raw), np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | pad[k: k + len(raw)]
    row = np.repeat(np.arange(len(size)), size)
    room = off[row + 1] - np.arange(len(raw))
    rank = _rank_bytes(word, room)
    at = np.flatnonzero(room >= LENGTH)
    # equal over LENGTH bytes: the same rank here and LENGTH-128 bytes on
    code = rank[at] * np.int64(len(raw) + 1) + rank[at + LENGTH - 128]
    _, inv = np.unique(code, return_inverse=True)
    total = np.bincount(inv, weight[row[at]])
    again = total[inv] >= 2
    hit, hit_row = at[again], row[at[again]]
    cut = np.searchsorted(hit_row, np.arange(len(size) + 1))
    return [hit[cut[i]: cut[i + 1]] - off[i] for i in range(len(size))]


def _rank_bytes(word: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Order of the suffixes by their first 128 bytes, by prefix doubling from 8 bytes."""
    n = len(word)
    order = np.argsort(word, kind="stable")
    start = np.maximum.accumulate(np.where(np.append(True, word[order][1:] != word[order][:-1]), np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    active = np.flatnonzero(np.bincount(start, minlength=n)[rank] > 1)
    for k in (8, 16, 32, 64):
        active = active[room[active] > k]
        if not len(active):
            break
        code = rank[active] * np.int64(n + 1) + rank[active + k]
        by = np.argsort(code, kind="stable")
        pos, code = active[by], code[by]
        old = rank[pos]
        idx = np.arange(len(pos))
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), idx, 0))
        run = np.maximum.accumulate(np.where(np.append(True, code[1:] != code[:-1]), idx, 0))
        rank = rank.copy()
        rank[pos] = old + (run - group)
        active = np.sort(pos[np.bincount(run, minlength=len(pos))[run] > 1])
    return rank


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending numbers as (first, count) runs."""
    if not len(at):
        return at, at
    first = np.flatnonzero(np.append(True, np.diff(at) > 1))
    return at[first], np.diff(np.append(first, len(at)))


def repeated_ranges(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """digest, ranges array<struct<lo, n>>: the repeated starts of every text that has some.

    ``digest`` is the md5 of the text, as bytes.
    """
    digest = F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    base = docs.select(F.col(key).cast("string").alias("id"), digest.alias("digest"), F.col(text).alias("t"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t", SLICE_BYTES):
            row, lo, n, core, whole = phrases(*utf8_buffer(part.column(2)))
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(at), part.column(1).take(at), pa.array(lo), pa.array(n),
                 pa.array(core.view(np.int64)), pa.array(whole.view(np.int64))],
                names=["id", "digest", "lo", "n", "core", "phrase"])

    parsed = materialize(base.mapInArrow(
        parse, "id string, digest binary, lo bigint, n bigint, core bigint, phrase bigint"), "parse")
    shared = parsed.groupBy("core").agg(F.count(F.lit(1)).alias("k"), F.min("phrase").alias("x"),
                                        F.max("phrase").alias("y")).where("k > 1") \
        .select("core", (F.col("x") != F.col("y")).alias("multi"))
    left = materialize(parsed.join(shared, "core"), "shared")
    drop(parsed)
    entry = materialize(left.groupBy("core", "phrase", "multi").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("id", "digest", "lo", "n")).alias("one")), "dictionary")
    # phrases that the parse holds twice are repeated whole
    twice = left.join(entry.where("times > 1").select("core", "phrase"), ["core", "phrase"]) \
        .select("digest", "lo", "n")

    # the phrases to be sorted, fetched from one of their places each
    wanted = entry.where("multi").select("core", "phrase", "times", "one.*") \
        .groupBy("id", "digest").agg(F.collect_list(F.struct("core", "phrase", "times", "lo", "n")).alias("want"))
    source = base.join(wanted.withColumnRenamed("id", "w_id"),
                       F.col("id").eqNullSafe(F.col("w_id")) & (base["digest"] == wanted["digest"]))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t", SLICE_BYTES):
            out = ([], [], [], [])
            for t, want in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                raw = (t or "").encode("utf-8")
                for w in want:
                    for col, x in zip(out, (w["core"], w["phrase"], w["times"],
                                            raw[w["lo"]: w["lo"] + w["n"] + LENGTH - 1])):
                        col.append(x)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary())],
                names=["core", "phrase", "times", "bytes"])

    width = entry.where("multi").groupBy("core").agg(F.count(F.lit(1)).alias("width"))
    fetched = source.select("t", "want").mapInArrow(
        fetch, "core bigint, phrase bigint, times bigint, bytes binary") \
        .dropDuplicates(["core", "phrase"])  # rows that share an id
    fetched = materialize(fetched.join(width, "core"), "phrases")
    sorted_rows = fetched.where(F.col("width") <= HOT)
    parts = max(1, -(-sorted_rows.count() // PART_ROWS))

    def order(table: pa.Table) -> pa.Table:
        core, phrase = table.column("core").to_numpy(), table.column("phrase").to_numpy()
        hits = repeated_starts(table.column("bytes").to_pylist(), table.column("times").to_numpy())
        runs = [_runs(h) for h in hits]
        count = [len(f) for f, _ in runs]
        return pa.table({"core": np.repeat(core, count), "phrase": np.repeat(phrase, count),
                         "s": np.concatenate([f for f, _ in runs]).astype(np.int64),
                         "k": np.concatenate([c for _, c in runs]).astype(np.int64)})

    out = "core bigint, phrase bigint, s bigint, k bigint"
    found = sorted_rows.withColumn("part", F.pmod(F.xxhash64("core"), F.lit(parts))) \
        .select("part", "core", "phrase", "times", "bytes").groupBy("part").applyInArrow(order, out)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "bytes", SLICE_BYTES // 2):
            raw, off = utf8_buffer(part.column(3))
            count = np.diff(off) - LENGTH + 1
            row = np.repeat(np.arange(len(count)), count)
            s = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            prefix, at = prefix_hash(raw), pa.array(row)
            a = off[row] + s
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(at), part.column(1).take(at), part.column(2).take(at), pa.array(s),
                 pa.array(span_hash(prefix, a, a + LENGTH).view(np.int64))],
                names=["core", "phrase", "times", "s", "h"])

    hot = fetched.where(F.col("width") > HOT).select("core", "phrase", "times", "bytes").mapInArrow(
        strings, "core bigint, phrase bigint, times bigint, s bigint, h bigint")
    again = hot.groupBy("core", "h").agg(F.sum("times").alias("all")).where("all > 1").select("core", "h")
    found = found.unionByName(hot.join(again, ["core", "h"]).select("core", "phrase", "s", F.lit(1).cast("bigint").alias("k")))

    once = entry.where("times = 1 and multi").select("core", "phrase", "one.digest", "one.lo")
    partly = found.join(once, ["core", "phrase"]).select("digest", (F.col("lo") + F.col("s")).alias("lo"),
                                                         F.col("k").alias("n"))
    return twice.unionByName(partly).distinct().groupBy("digest") \
        .agg(F.collect_list(F.struct("lo", "n")).alias("ranges"))


def covered(size: int, ranges) -> np.ndarray:
    """Which bytes of a text the strings starting in these ranges cover."""
    edge = np.zeros(size + 1, np.int64)
    for r in ranges:
        edge[r["lo"]] += 1
        edge[min(r["lo"] + r["n"] + LENGTH - 1, size)] -= 1
    return np.cumsum(edge[:-1]) > 0


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256, removed (array of struct start, end) of every row."""
    ranges = materialize(repeated_ranges(docs, key, text), "ranges")
    key_t = docs.schema[key].dataType.simpleString()
    digest = F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("t"), digest.alias("digest")) \
        .join(ranges, "digest", "left").select("id", "t", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t", SLICE_BYTES):
            raw, off = utf8_buffer(part.column(1))
            size, gone, spans, sha, where = np.diff(off), [], [], [], []
            for i, r in enumerate(part.column(2).to_pylist()):
                mine = raw[off[i]: off[i + 1]]
                cov = covered(len(mine), r) if r else np.zeros(len(mine), bool)
                first, count = _runs(np.flatnonzero(cov))
                gone.append(int(cov.sum()))
                spans.append(len(first))
                where.append([{"start": int(a), "end": int(a + c)} for a, c in zip(first, count)])
                sha.append(hashlib.sha256(mine[~cov].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(sha, pa.string()),
                 pa.array(where, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    return rows.mapInArrow(cut, f"`{key}` {key_t}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                "kept_sha256 string, removed array<struct<start: bigint, end: bigint>>")
