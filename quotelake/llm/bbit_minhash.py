"""Near-duplicate documents by b-bit MinHash.

Each document's set of word shingles gets ``HASHES`` minima.  Runs of ``rows``
minima are hashed to band buckets (candidate generation); of each minimum the
low ``BITS`` bits are kept and packed into 64-bit words.  For a candidate pair
the packed words are XORed and matching positions counted by ``bit_count``;
with chance matches corrected this estimates the similarity, and pairs well
below the threshold (four standard errors) are dropped without their texts.
The others are confirmed on the full sets, and components are joined by a
distributed union-find (``components.py``).

Documents with equal sets are collapsed first (partial aggregation), so a
group of copies costs one row however large it is.  A text of fewer words than
a shingle is one shingle; empty and null texts have no shingles and are linked
with nothing.  Rows with a null id are linked with nothing (component null,
kept).  Rows that share an id count as one document.  Extra columns of any
name are left alone.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, shingle_sets, slices, utf8_buffer
from .components import similarity_components

HASHES = 256
BITS = 2
SLICE_BYTES = 512 << 10  # a step works in some 60 times that
_SEEDS = mix64(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XOR = (_SEEDS[:HASHES] >> np.uint64(32)).astype(np.uint32)
_ODD = (_SEEDS[HASHES:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minima(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """The minima of each (non-empty) set under so many hashes, one row for each."""
    n = np.array([len(s) for s in sets])
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    out = np.empty((hashes, len(sets)), np.uint32)
    tmp = np.empty_like(flat)
    for k in range(hashes):
        np.bitwise_xor(flat, _XOR[k], out=tmp)
        np.multiply(tmp, _ODD[k], out=tmp)
        out[k] = np.minimum.reduceat(tmp, starts)
    return out.T


def band_buckets(low: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit bucket for each band of ``rows`` minima."""
    bands = HASHES // rows
    out = np.empty((len(low), bands), np.uint64)
    for b in range(bands):
        x = np.full(len(low), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + low[:, k])
        out[:, b] = x
    return out


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima, BITS each, in 64-bit words."""
    per = 64 // BITS
    bits = ((low >> np.uint32(7)) & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(low), -1, per)
    return (bits << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))).sum(2, dtype=np.uint64)


def estimate(x: str, y: str, hashes: int = HASHES) -> Column:
    """Collision-corrected similarity of two packed signatures, by bit counts."""
    words = hashes * BITS // 64
    odd = F.lit(0x5555555555555555)
    differ = F.lit(0)
    for k in range(words):
        z = F.col(x)[k].bitwiseXOR(F.col(y)[k])
        differ = differ + F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(odd))
    chance = 1 / (1 << BITS)
    return (1 - differ / hashes - chance) / (1 - chance)


def lowest(percent: int, hashes: int = HASHES) -> float:
    """The estimate below which a pair at ``percent`` falls only beyond four standard errors."""
    chance = 1 / (1 << BITS)
    p = percent / 100 * (1 - chance) + chance
    return percent / 100 - 4 * math.sqrt(p * (1 - p) / hashes) / (1 - chance)


def features(docs: DataFrame, width: int, rows: int, key: str, text: str) -> DataFrame:
    """key, n_shingles, set_key, buckets, sig of every row (nulls for empty sets)."""
    key_t = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, SLICE_BYTES):
            sets = shingle_sets(*utf8_buffer(part.column(1)), width)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys, buckets, sig = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if full:
                low = minima([sets[i] for i in full])
                b, p = band_buckets(low, rows).view(np.int64), packed(low).view(np.int64)
                for j, i in enumerate(full):
                    keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    buckets[i], sig[i] = b[j], p[j]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(buckets, pa.list_(pa.int64())), pa.array(sig, pa.list_(pa.int64()))],
                names=["_id", "n_shingles", "set_key", "buckets", "sig"])

    return docs.select(F.col(key).alias("_id"), F.col(text).alias(text)).mapInArrow(
        run, f"_id {key_t}, n_shingles bigint, set_key binary, buckets array<bigint>, sig array<bigint>")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """node, set, size of the documents whose id is in ``wanted`` (column node)."""
    node_t = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", SLICE_BYTES):
            sets = shingle_sets(*utf8_buffer(part.column(1)), width)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([s.tobytes() for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64())], names=["node", "set", "size"])

    return docs.select(F.col(key).alias("node"), F.col(text).alias("_text")).join(wanted, "node", "left_semi") \
        .mapInArrow(run, f"node {node_t}, set binary, size bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, rows: int = 6,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id, kept of every row."""
    feats = materialize(features(docs, width, rows, key, text), "minhash")
    groups = materialize(
        feats.where("set_key is not null and _id is not null").groupBy("set_key").agg(
            F.min("_id").alias("node"), F.first("buckets").alias("buckets"), F.first("sig").alias("sig")), "sets")
    cut = lowest(percent)
    comp = similarity_components(
        groups.select("node", "buckets", "sig"), lambda ids: full_sets(docs, ids, width, key, text), percent,
        likely=lambda x, y: estimate(x, y) >= cut)
    label = groups.select("set_key", "node").join(comp.dropDuplicates(["node"]), "node", "left") \
        .select("set_key", F.coalesce("component", "node").alias("_comp"))
    out = feats.select("_id", "n_shingles", "set_key").join(label, "set_key", "left")
    comp_id = F.when(F.col("_id").isNotNull(), F.coalesce("_comp", "_id"))
    return out.select(F.col("_id").alias(key), "n_shingles", comp_id.alias("component_id"),
                      F.coalesce(comp_id == F.col("_id"), F.lit(True)).alias("kept"))
