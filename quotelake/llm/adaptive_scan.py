"""Approximate nearest neighbours by cosine with an adaptive dimension scan.

Vectors are normalised, turned by a fixed random rotation and dealt to the
inverted lists of a coarse k-means (fitted on a bounded sample: the
``SAMPLE_PER_LIST * lists`` vectors smallest by a hash of the id; every vector
is indexed).  A list longer than ``BLOCK_ROWS`` is split into parts, so no
list is gathered in one task.  Each query probes its nearest lists first and
then every other list that can hold a nearer vector than the last of its best
so far: the angles between a list's centre and its members lie in a known
range, so by the triangle inequality all members are at least so far from the
query.  Vectors without clusters rule out few lists, and most are probed.
Inside a part a query reads the rotated vectors column block by column block,
and after each block drops the candidates whose partial distance, by the
hypothesis test ``partial * D/d > bound * (1 + EPSILON/sqrt(d))**2``, would
hardly come below its current bound; only that test can lose a neighbour.
Survivors get the exact cosine of the original vectors in double precision;
the best of all parts are merged with a window.

Equal vectors are searched once: of each only the k+1 smallest ids are kept,
which is all that any answer can contain, so a third of all rows with the same
vector costs one vector.  Rows with null, zero, null-holding or non-finite
vectors, null ids, or another dimension than the commonest take no part.
Repeated rows count once.  An empty table gives no rows; with fewer
candidates than k all are returned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

BLOCK_ROWS = 4096
SAMPLE_PER_LIST = 50
MAX_LISTS = 2048
COLUMNS = 16
EPSILON = 2.1
FIRST_PROBES = 12
SLACK = 1e-3  # on angles in single precision
_EMPTY = "query_id bigint, rank int, vec_id bigint, score double"


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(20240229).normal(size=(dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def fit_lists(x: np.ndarray, k: int, steps: int = 8) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(steps):
        near = np.concatenate([np.argmax(x[a:a + 8192] @ c.T, 1) for a in range(0, len(x), 8192)])
        for j in np.unique(near):
            m = x[near == j].sum(0)
            c[j] = m / max(float(np.linalg.norm(m)), 1e-12)
    return c


def _matrix(column) -> np.ndarray:
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(arr), -1) if len(arr) else np.zeros((0, 0))


def scan(x: np.ndarray, q: np.ndarray, keep: int, within: float = math.inf) -> np.ndarray:
    """Indices of x (rotated, column-blocked) that survive the adaptive scan for q; within: known bound on the distance."""
    n, dim = x.shape
    if n <= keep:
        return np.arange(n)
    head = min(n, max(4 * keep, 32))
    first = ((x[:head] - q) ** 2).sum(1)
    bound = min(np.partition(first, keep - 1)[keep - 1], within)
    alive, part = np.arange(n), np.zeros(n, np.float32)
    for a in range(0, dim, COLUMNS):
        b = min(a + COLUMNS, dim)
        part = part + ((x[alive, a:b] - q[a:b]) ** 2).sum(1)
        limit = bound * (1 + EPSILON / math.sqrt(b)) ** 2 * b / dim if b < dim else bound * (1 + 1e-5) + 1e-9
        ok = part <= limit
        alive, part = alive[ok], part[ok]
    if len(alive) > keep:
        cut = np.partition(part, keep - 1)[keep - 1]
        alive = alive[part <= cut * (1 + 1e-5) + 1e-9]
    return alive


def neighbours(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", every: int = 50, k: int = 5,
               probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row whose id is divisible by ``every``.

    probes: how many lists to probe first.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(column).cast("array<double>").alias("v"))
    v = v.where("id is not null and v is not null").where(
        ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0))
    dims = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not dims:
        return spark.createDataFrame([], _EMPTY)
    dim = dims[0]["d"]
    v = v.where(F.size("v") == dim)
    # one row for each different vector, with its k+1 smallest ids
    few = v.distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    base = materialize(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                       .withColumn("vid", F.col("ids")[0]), "vectors")
    asked = materialize(v.where(F.col("id") % every == 0).distinct().join(base.select("v", "vid"), "v")
                        .select("id", "vid"), "queries")
    n = base.count()
    lists = max(1, min(MAX_LISTS, round(math.sqrt(n))))
    probes = min(lists, probes or FIRST_PROBES)
    sample = _matrix(base.orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE_PER_LIST * lists).select("v").toArrow().column(0))
    turn = rotation(dim)

    def prepared(raw: np.ndarray) -> np.ndarray:
        unit = raw / np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-300)
        return unit.astype(np.float32) @ turn

    centres = fit_lists(prepared(sample), lists)

    def angles(x: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(x @ centres.T, -1, 1))

    def assign(batches):
        for b in batches:
            x = prepared(_matrix(b.column(0)))
            away = angles(x) if len(x) else np.zeros((0, lists), np.float32)
            near = np.argmin(away, 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(near), pa.array(away[np.arange(len(x)), near].astype(np.float64))],
                names=["v", "ids", "vid", "list", "away"])

    indexed = materialize(base.select("v", "ids", "vid").mapInArrow(
        assign, "v array<double>, ids array<bigint>, vid bigint, list int, away double"), "index")
    spread = indexed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts"),
                                         F.min("away").alias("low"), F.max("away").alias("high"))
    parts = spread.select("list", "parts")
    low, high = np.full(lists, np.inf), np.full(lists, -np.inf)
    for r in spread.collect():
        low[r["list"]], high[r["list"]] = r["low"] - SLACK, r["high"] + SLACK
    rows = indexed.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("vid"), F.col("parts")).cast("int"))

    def lists_of(batches, choose):
        for b in batches:
            x = prepared(_matrix(b.column(0)))
            if not len(x):
                continue
            at, near = np.nonzero(choose(angles(x), b.column(2).to_numpy()))
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([*(c.take(take) for c in b.columns), pa.array(near.astype(np.int32))],
                                             names=["v", "vid", "least", "list"])

    def nearest(away: np.ndarray, least: np.ndarray) -> np.ndarray:
        chosen = np.zeros(away.shape, bool)
        np.put_along_axis(chosen, np.argpartition(away, probes - 1, axis=1)[:, :probes], True, 1)
        return chosen

    def possible(away: np.ndarray, least: np.ndarray) -> np.ndarray:
        return np.maximum(away - high, low - away) <= np.arccos(np.clip(least, -1, 1))[:, None] + SLACK

    probed_t = "v array<double>, vid bigint, least double, list int"
    wanted = base.join(asked.select("vid").distinct(), "vid").select("v", "vid")
    first = materialize(wanted.withColumn("least", F.lit(-1.0)).mapInArrow(lambda b: lists_of(b, nearest), probed_t), "probes")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        query, near, score = [], [], []
        if left.num_rows and right.num_rows:
            raw, asks = _matrix(left.column("v")), _matrix(right.column("v"))
            x, q = prepared(raw), prepared(asks)
            norm = np.linalg.norm(raw, axis=1)
            ids = left.column("ids").to_pylist()
            least = right.column("least").to_numpy()
            for j, qid in enumerate(right.column("vid").to_pylist()):
                alive = scan(x, q[j], k + 1, (2 - 2 * least[j]) * (1 + 1e-5) + 1e-5)
                s = raw[alive] @ asks[j] / (norm[alive] * np.linalg.norm(asks[j]))
                best = sorted((-float(c), i) for c, a in zip(s, alive) for i in ids[a])[:k + 1]
                query += [qid] * len(best)
                near += [i for _, i in best]
                score += [-c for c, _ in best]
        return pa.table({"qvid": pa.array(query, pa.int64()), "vec_id": pa.array(near, pa.int64()),
                         "score": pa.array(score, pa.float64())})

    def best_of(found: DataFrame) -> DataFrame:
        by = Window.partitionBy("qvid").orderBy(F.desc("score"), F.asc("vec_id"))
        return found.withColumn("r", F.row_number().over(by)).where(F.col("r") <= k + 1).drop("r")

    def probe(queries: DataFrame) -> DataFrame:
        queries = queries.join(parts, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return best_of(rows.select("list", "part", "v", "ids").groupBy("list", "part").cogroup(
            queries.select("list", "part", "v", "vid", "least").groupBy("list", "part")).applyInArrow(
            search, "qvid bigint, vec_id bigint, score double"))

    near = materialize(probe(first), "near")
    # the last of the best so far, or -1 while there are fewer than k+1
    least = near.groupBy(F.col("qvid").alias("vid")).agg(
        F.when(F.count(F.lit(1)) > k, F.min("score")).otherwise(F.lit(-1.0)).alias("least"))
    rest = wanted.join(least, "vid", "left").select("v", "vid", F.coalesce("least", F.lit(-1.0)).alias("least")) \
        .mapInArrow(lambda b: lists_of(b, possible), probed_t).join(first.select("vid", "list"), ["vid", "list"], "left_anti")
    best = best_of(near.unionByName(probe(rest)))
    answer = asked.join(best, F.col("vid") == F.col("qvid")).where("vec_id <> id")
    final = Window.partitionBy("id").orderBy(F.desc("score"), F.asc("vec_id"))
    return answer.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select(
        F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
