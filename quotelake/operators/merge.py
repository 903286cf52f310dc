"""Idempotent insert-only merge of new ticks into a curated table.

The key of a tick is ``(DateTime, symbol)``.  The source is read once: its
distinct rows are written to the shared checkpoint folder, and everything
below works on them.  Then the target is cut to what they can match, before
any of it is shuffled:

* the partitions the source touches — a literal partition filter when
  they are few (static partition pruning, nothing of the other partitions
  is listed or read), else a size-checked semi join;
* the source's key-time range — a plain range filter that Parquet uses to
  skip row groups, so an ingest of recent ticks does not read history;
* a bitmap of the source's keys (``sketch``), bounded in bytes and broadcast:
  of the target rows only those that may match reach the shuffle.

The anti join on the full key is exact, needs no distinct target, and spreads
a symbol that holds a third of all rows over many tasks.  The aggregates on
the source are materialised, and their size is checked before anything of them
reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .joins import checkpointed, fits

TICK_KEY = ("DateTime", "symbol")

# Touched partitions up to which the target is cut with a literal filter.
MAX_STATIC_PARTITIONS = 1000


def split_null_keys(source: DataFrame, keys=TICK_KEY):
    """``(good, quarantined)``: rows with a null key never match, so set them aside (D-4)."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return source.filter(~any_null), source.filter(any_null)


def _literal(value, dtype: str):
    if value is None:
        return F.lit(None).cast(dtype)
    if dtype == "timestamp_ntz":  # via text, so no session zone is applied
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def _eq(col: str, value, dtype: str):
    return F.col(col).eqNullSafe(_literal(value, dtype)) if value is None \
        else F.col(col) == _literal(value, dtype)


def prune_target(target: DataFrame, source: DataFrame, partition_cols=(),
                 range_col: str | None = None) -> DataFrame:
    """Target restricted to the source's partitions and ``range_col`` range."""
    keys = list(partition_cols)
    if not keys and not range_col:
        return target
    types = dict(target.dtypes)
    aggs = [F.min(range_col).alias("_lo"), F.max(range_col).alias("_hi")] if range_col \
        else [F.count(F.lit(1)).alias("_n")]
    touched = checkpointed(source.groupBy(*keys).agg(*aggs) if keys else source.agg(*aggs))
    # Bounded: at most MAX_STATIC_PARTITIONS + 1 small rows reach the driver.
    rows = touched.limit(MAX_STATIC_PARTITIONS + 1).collect()
    static = len(rows) <= MAX_STATIC_PARTITIONS
    out = target
    if range_col:
        if static and keys:  # every partition with its own range
            t = types[range_col]
            cond = reduce(lambda a, b: a | b,
                          [reduce(lambda a, b: a & b, [_eq(k, r[k], types[k]) for k in keys])
                           & F.col(range_col).between(_literal(r["_lo"], t), _literal(r["_hi"], t))
                           for r in rows if r["_lo"] is not None], F.lit(False))
            return target.filter(cond)
        if static:
            los = [r["_lo"] for r in rows if r["_lo"] is not None]
            lo, hi = (min(los), max(r["_hi"] for r in rows if r["_hi"] is not None)) if los else (None, None)
        else:
            lo, hi = touched.agg(F.min("_lo"), F.max("_hi")).first()
        if lo is None:  # no source key at all: nothing can match
            return target.filter(F.lit(False))
        t = types[range_col]
        out = out.filter(F.col(range_col).between(_literal(lo, t), _literal(hi, t)))
    if not keys:
        return out
    if static:
        cond = reduce(lambda a, b: a | b,
                      [reduce(lambda a, b: a & b, [_eq(k, r[k], types[k]) for k in keys]) for r in rows],
                      F.lit(False))
        return out.filter(cond)
    small = touched.select(*keys)
    return out.join(F.broadcast(small) if fits(small) else small, keys, "left_semi")


def matchable(target: DataFrame, source: DataFrame, keys=TICK_KEY, partition_cols=(), range_col: str | None = None,
              max_bytes: int = sketch.MAX_BYTES) -> DataFrame:
    """The keys of target rows that may equal a key of ``source``, which should be materialised."""
    bits = sketch.bitmap_bits(source.count(), max_bytes)
    bitmap = checkpointed(sketch.key_bitmap(source, keys, bits))
    types = dict(source.dtypes)
    rows = prune_target(target, source, partition_cols, range_col).select(*[F.col(k).cast(types[k]).alias(k) for k in keys])
    return sketch.may_match(rows, bitmap, keys, bits)


def new_keys(source: DataFrame, target: DataFrame, keys=TICK_KEY, partition_cols=(),
             range_col: str | None = None, max_bytes: int = sketch.MAX_BYTES) -> DataFrame:
    """Distinct source keys absent from the target (A2 + J1)."""
    cols = dict.fromkeys([*keys, *partition_cols, *([range_col] if range_col else [])])
    src = checkpointed(source.select(*cols).distinct())
    new = src.join(matchable(target, src, keys, partition_cols, range_col, max_bytes), list(keys), "left_anti")
    return new.select(*keys).distinct()  # on the join's partitioning: no further shuffle


def new_key_count(source: DataFrame, target: DataFrame, keys=TICK_KEY, by="symbol",
                  partition_cols=(), range_col: str | None = None) -> DataFrame:
    """Number of new distinct keys per ``by`` (A3), one aggregate for all symbols."""
    return new_keys(source, target, keys, partition_cols, range_col).groupBy(by) \
        .agg(F.count(F.lit(1)).alias("new_count"))


def ingest_summary(symbols: DataFrame, counts: DataFrame, by="symbol",
                   count_col="new_count") -> DataFrame:
    """Every symbol with its new-row count, 0 when it has none (A3 summary)."""
    return symbols.select(by).distinct().join(counts, by, "left") \
        .select(by, F.coalesce(F.col(count_col), F.lit(0)).cast("long").alias(count_col))


def rows_to_insert(source: DataFrame, target: DataFrame, cols, keys=TICK_KEY, partition_cols=(),
                   range_col: str | None = None, max_bytes: int = sketch.MAX_BYTES) -> DataFrame:
    """MERGE … WHEN NOT MATCHED THEN INSERT with a DISTINCT source (A1 + J2).

    Distinct is over whole rows, as in the reference: one key with two
    prices inserts two rows (see ``key_conflicts``).  Null keys are kept
    out (D-4); use ``split_null_keys`` to get them.
    """
    good, _ = split_null_keys(source, keys)
    src = checkpointed(good.select(*cols).distinct())
    return src.join(matchable(target, src, keys, partition_cols, range_col, max_bytes), list(keys), "left_anti").select(*cols)


def merge_insert_new(source: DataFrame, target: DataFrame, cols, keys=TICK_KEY,
                     partition_cols=()) -> DataFrame:
    """Target after the merge: target rows plus the inserted rows."""
    return target.select(*cols).unionByName(rows_to_insert(source, target, cols, keys, partition_cols))


def key_conflicts(source: DataFrame, keys=TICK_KEY, payload=("Bid", "Ask")) -> DataFrame:
    """One row: distinct rows, distinct keys and keys with more than one payload (D-3)."""
    per_key = source.select(*keys, *payload).distinct().groupBy(*keys) \
        .agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").cast("long").alias("distinct_rows"),
                       F.count(F.lit(1)).alias("distinct_keys"),
                       F.count_if(F.col("n") > 1).alias("conflicting_keys"))
