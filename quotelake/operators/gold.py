"""Curated ("gold") tick tables: idempotent ingest from raw ticks.

One versioned table holds all symbols, partitioned by ``symbol, year``;
per-symbol names ``ticks_<symbol>`` (and ``ticks_<symbol>_spread``) are
views over it (``catalog``).  Each ingest is one anti join of the new rows against the
current table (cut to the partitions the new rows touch) and one appended
batch, for every symbol at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from . import merge as M
from .versions import VersionedRows

GOLD_SCHEMA = "DateTime timestamp_ntz, Bid double, Ask double, symbol string, year int"
SPREAD_SCHEMA = "DateTime timestamp_ntz, Bid double, Ask double, Spread double, symbol string, year int"
PARTITION_BY = ("symbol", "year")


def gold_table(spark: SparkSession, root: str, spread: bool = False) -> VersionedRows:
    """Open (creating if absent) a gold table at ``root``."""
    t = VersionedRows(spark, root)
    t.create(SPREAD_SCHEMA if spread else GOLD_SCHEMA, partition_by=PARTITION_BY)
    return t


def gold_rows(raw: DataFrame, spread: bool = False) -> DataFrame:
    """Raw ticks (DateTime, Bid, Ask, symbol) → gold columns."""
    cols = [F.col("DateTime").cast("timestamp_ntz").alias("DateTime"), "Bid", "Ask"]
    if spread:
        cols.append(C.spread().alias("Spread"))
    cols += [F.upper("symbol").alias("symbol"), C.year_of("DateTime").alias("year")]
    return raw.select(*cols)


def _current(table: VersionedRows) -> DataFrame:
    return table.read()


def ingest(table: VersionedRows, raw: DataFrame, spread: bool = False, committed_at=None) -> dict:
    """MERGE new ticks into the gold table: insert rows whose key is absent.

    Returns ``snapshot_id``, the table's version (unchanged when nothing was
    new, E3), and the rows set aside for a null key (D-4) as a DataFrame.
    """
    src = gold_rows(raw, spread)
    good, null_keys = M.split_null_keys(src, M.TICK_KEY)
    cols = src.columns
    ins = M.rows_to_insert(good, _current(table), cols, M.TICK_KEY, partition_cols=PARTITION_BY,
                           range_col="DateTime")
    sid = table.append(ins, committed_at=committed_at)
    return {"snapshot_id": sid, "null_keys": null_keys}


def ingest_report(table: VersionedRows, raw: DataFrame, spread: bool = False) -> DataFrame:
    """Per symbol: ``new_keys`` (distinct new keys) and ``inserted_rows`` an ingest would insert (D-3)."""
    src = gold_rows(raw, spread)
    good, _ = M.split_null_keys(src, M.TICK_KEY)
    cur = _current(table)
    keys = M.new_key_count(good, cur, partition_cols=PARTITION_BY, range_col="DateTime")
    rows = M.rows_to_insert(good, cur, src.columns, M.TICK_KEY, PARTITION_BY, "DateTime") \
        .groupBy("symbol").agg(F.count(F.lit(1)).alias("inserted_rows"))
    return M.ingest_summary(good.select("symbol"), keys).join(rows, "symbol", "left") \
        .select("symbol", F.col("new_count").alias("new_keys"),
                F.coalesce("inserted_rows", F.lit(0)).cast("long").alias("inserted_rows"))


def partitions(table: VersionedRows, spread: bool = False, snapshot_id=None) -> DataFrame:
    """Per-symbol table name, partition (symbol, year) and rows, like SHOW PARTITIONS.

    Counted from the partition columns, so only the partition directories'
    row counts are aggregated (partial aggregation before the shuffle).
    """
    name = F.concat(F.lit(K.TABLE_PREFIX), F.lower("symbol"), F.lit("_spread" if spread else ""))
    return table.read(snapshot_id).groupBy("symbol", "year") \
        .agg(F.count(F.lit(1)).alias("n_rows")) \
        .select(name.alias("table_name"), "symbol", "year", "n_rows")
