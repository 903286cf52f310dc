"""Filter interaction audit by the potential of the removal game (operator 13).

Five filters judge every document by itself, so a document is known by the
set of filters it fails.  A coalition's worth v(S) is the number of documents
that some filter of S fails.  The Hart-Mas-Colell potential obeys P({}) = 0 and

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|

and a filter's Shapley value is P(all) - P(all without it).  ``|S|! P(S)`` is
whole, so 120 P is kept in longs and the sums over the 120 orders are exact.
What a step of an order removes is v(before and it) - v(before).

A document that fails E has the text of a smaller doc_id.  The documents that
do not fail it are the rows of rank 1 by doc_id among equal texts, a rank that
Spark cuts in every map task first, so a text held by a third of all rows
reaches its task as one row of each map task.  Texts are compared by SHA-256.

Nulls: a null text is empty; a null source is the part of the empty string; a
row without doc_id never fails E and makes no other row fail it, and has no
label.  Rows that repeat a doc_id are counted each, share that id's labels,
and never make each other fail E.  Several label rows of an id count as the
greatest of them.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialize, slices, text_array

#: The filters in the order of their bits (A is bit 0).
FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]

#: Thresholds of the filters, and the characters of D.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
SYMBOLS = b"#$%&*|"

_UPPER = bytes(range(65, 91))
#: Bytes that continue a code point.
_CONTINUED = bytes(range(0x80, 0xC0))
#: Texts looked at together.
SLICE_BYTES = 8 << 20


def fails(raw: bytes) -> int:
    """Bits of the filters A to D that this UTF-8 text fails.

    ``bytes.split`` parts at just the six blanks of the contract.
    """
    words = raw.split()
    n = len(words)
    points = len(raw.translate(None, _CONTINUED))
    mask = 1 if n < MIN_WORDS else 0
    if 100 * len(set(words)) < MIN_DISTINCT_PERCENT * n:
        mask |= 2
    if 100 * (len(raw) - len(raw.translate(None, _UPPER))) > MAX_UPPER_PERCENT * points:
        mask |= 4
    if len(raw) != len(raw.translate(None, SYMBOLS)):
        mask |= 8
    return mask


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        mask, digest = [], []
        for text in text_array(batch.column("text")):
            raw = text.as_buffer().to_pybytes()
            mask.append(fails(raw))
            digest.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(mask, pa.int32()), pa.array(digest, pa.binary())],
            ["doc_id", "part", "mask", "digest"])


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, part, mask of A to D, digest, good, toxic of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.col("text").cast("string").alias("text")) \
        .mapInArrow(_judge, "doc_id bigint, part string, mask int, digest binary")
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # an id is one document's, so this join has no hot key; rows without an id spread by their digest
    numbered = rows.where("doc_id is not null").join(known, "doc_id", "left")
    blank = rows.where("doc_id is null").select("*", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))
    return numbered.unionByName(blank).fillna(0, ["good", "toxic"])


def cells(rows: DataFrame) -> DataFrame:
    """part, mask of all five filters, n, good, toxic: documents by what they fail."""
    def count(df):
        return df.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"),
                                              F.sum("toxic").alias("toxic"))

    firsts = rows.where("doc_id is not null") \
        .withColumn("_rank", F.rank().over(Window.partitionBy("digest").orderBy("doc_id"))).where("_rank = 1").drop("_rank")
    passed = count(firsts.unionByName(rows.where("doc_id is null")))
    minus = passed.select("part", "mask", *[(-F.col(c)).alias(c) for c in ("n", "good", "toxic")])
    failed = count(rows).unionByName(minus).withColumn("mask", F.col("mask").bitwiseOR(16))
    return failed.unionByName(passed).groupBy("part", "mask").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).where("n > 0")


def _worth(name: str):
    """v(S) for S = 0 … 31, from the at most 32 cells of a part."""
    return F.transform(F.sequence(F.lit(0), F.lit(ALL)), lambda s: F.aggregate(
        F.filter("cells", lambda c: c["mask"].bitwiseAND(s) != 0), F.lit(0).cast("bigint"), lambda a, c: a + c[name]))


def _potentials(v):
    """120 P(S) for S = 0 … 31: every coalition after those it contains."""
    def step(p, s):
        # F.get is by zero-based place; without i, a coalition has a smaller number
        smaller = sum((F.when(s.bitwiseAND(1 << i) != 0, F.get(p, s.bitwiseXOR(F.lit(1 << i)))).otherwise(F.lit(0))
                       for i in range(len(FILTERS))), F.lit(0).cast("bigint"))
        total = F.lit(120) * F.get(v, s) + smaller
        return F.concat(p, F.array((total / F.bit_count(s)).cast("bigint")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("bigint")), step)


def _steps():
    """All (filter_order, step, coalition before, the filter's bit)."""
    out = []
    for order in ORDERS:
        before = 0
        for k, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append(F.struct(F.lit(order).alias("filter_order"), F.lit(k).alias("step"),
                                F.lit(before).alias("before"), F.lit(bit).alias("bit")))
            before |= bit
    return F.explode(F.array(*out)).alias("s")


def report(found: DataFrame) -> DataFrame:
    """The 600 rows of every part, from ``cells``."""
    parts = found.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    parts = parts.select(
        "part", *[_worth(c).alias(c) for c in ("n", "good", "toxic")],
        F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, c: a + c["n"]).alias("total"))
    parts = parts.withColumn("p", _potentials(F.col("n")))
    rows = parts.select("*", _steps()).select("*", "s.*").withColumn("after", F.col("before").bitwiseOR(F.col("bit")))

    def gain(c):
        return F.get(c, "after") - F.get(c, "before")

    alone = F.get("n", "bit")
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - F.get("n", "after")).alias("kept"), gain("n").alias("removed"),
        (alone - gain("n")).alias("redundant"),
        (F.get("n", F.lit(ALL)) - F.get("n", F.lit(ALL).bitwiseXOR(F.col("bit")))).alias("unique_fails"),
        gain("good").alias("good_lost"), gain("toxic").alias("toxic_lost"),
        (F.get("p", F.lit(ALL)) - F.get("p", F.lit(ALL).bitwiseXOR(F.col("bit")))).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of the step, zeros included."""
    rows = materialize(judged(docs, labels), "audit-rows")
    found = materialize(cells(rows), "audit-cells")
    drop(rows)
    return report(found)
