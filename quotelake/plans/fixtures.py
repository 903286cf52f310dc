"""Tick-shaped inputs derived from the provided test tables.

``events`` has no prices, so ticks are derived from it by fixed rules
(``ticks``); version history is derived from ``orders``; key conflicts come
from ``lineitem``.  Every derived input is a lazy DataFrame over the given
parquet tables, so all registered queries grow with the data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C

# ---- fixed values of the fixtures ------------------------------------------
# Symbols treated as crypto (collected on weekends) in the fixtures.
FIXTURE_CRYPTO = ["CLICK", "VIEW"]
# Instruments: one per symbol; ERROR is closed (trade_mode 0); PURCHASE is missing.
FIXTURE_CLOSED = ["ERROR"]
FIXTURE_MISSING = ["PURCHASE"]
# Rows already in the curated table: event_id % 3 = 0.
EXISTING_MOD = 3
# Cursor per symbol: earliest existing tick time plus ten days (ms).
CURSOR_OFFSET_MS = 864_000_000
# Cap used by the cap fixture so that it bites on the small data.
FIXTURE_CAP = 1
# Job start (local) for skipping windows already begun.
FIXTURE_JOB_START = _dt.datetime(2024, 1, 15, 8, 30, 0)
# The landed files of the stream queries are in no order of time: any window may still get ticks.
FIXTURE_GRACE = _dt.timedelta(days=3650)
# History: snapshot v = year(o_orderdate) - 1994, one append per year.
HISTORY_BASE_YEAR = 1994
# ---- end of fixed values ----------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks from events: symbol, DateTime (UTC ntz), time_msc, flags, Bid, Ask."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.upper("event_type").alias("symbol"),
        F.col("ts").cast("timestamp_ntz").alias("DateTime"),
        C.epoch_ms(F.col("ts").cast("timestamp_ntz")).alias("time_msc"),
        (F.col("event_id") % 8).cast("int").alias("flags"),
        F.col("value").alias("Bid"),
        (F.col("value") + ((F.col("event_id") % 7) - 1).cast("double") / 100).alias("Ask"),
    )


def existing_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows assumed already merged: event_id % 3 = 0."""
    return ticks(spark, sf_dir).filter(F.col("event_id") % EXISTING_MOD == 0)


def cursor_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-symbol cursor: earliest existing tick time + ten days."""
    return existing_gold(spark, sf_dir).groupBy("symbol") \
        .agg((F.min("time_msc") + CURSOR_OFFSET_MS).alias("cursor_ms"))


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument metadata per symbol (name, trade_mode, visible, digits, spread)."""
    syms = ticks(spark, sf_dir).select("symbol").distinct() \
        .filter(~F.col("symbol").isin(FIXTURE_MISSING))
    return syms.select(
        "symbol",
        F.when(F.col("symbol").isin(FIXTURE_CLOSED), 0).otherwise(4).alias("trade_mode"),
        F.lit(True).alias("visible"),
        F.lit(2).alias("digits"),
        F.lit(0).alias("spread"),
    )


def history_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the snapshot they arrive in: v = year(o_orderdate) - 1994."""
    o = table(spark, sf_dir, "orders")
    return o.withColumn("v", (F.year("o_orderdate") - HISTORY_BASE_YEAR).cast("long"))


def lineitem_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key (l_orderkey, l_linenumber) with payload l_extendedprice."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
