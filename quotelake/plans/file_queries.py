"""File-based queries: CSV landing, conversion, Parquet scans, config, catalog, gold ingest.

Each query writes the derived ticks to a fresh folder below the shared
checkpoint folder (the Parquet area's prefix holds a space), then runs the
operator on what was written, so the work grows with the input tables.
The landing has one file per symbol and UTC day and one malformed row
(the tick with ``event_id = 0`` gets unparsable time text).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import catalog as CT
from ..operators import gold as G
from ..operators import ticks as T
from ..session import scratch_path
from ..sources import convert as V
from ..sources import files as S
from ..sources import named_files as N
from ..sources import sinks as W
from . import fixtures as X
from .registry import TK, WIN, WKEY, register

# ---- fixed values of the file fixtures --------------------------------------
BAD_TEXT = "not-a-time"
BAD_EVENT_ID = 0
# Files landed before this UTC day are converted by an earlier run.
EARLIER_RUN_BEFORE = "20240115"
# ---- end of fixed values ----------------------------------------------------

FILE_KEY_SQL = "symbol || '_' || strftime(DateTime, '%Y%m%d')"
PARSED_SQL = f"CASE WHEN event_id = {BAD_EVENT_ID} THEN NULL ELSE date_trunc('millisecond', DateTime) END"


def land(spark, sf) -> str:
    """Write derived ticks as CSV below ``<bucket>/raw``; return the bucket folder."""
    bucket = scratch_path(spark, "bucket")
    tk = X.ticks(spark, sf)
    rows = tk.select(
        "symbol",
        F.when(F.col("event_id") == BAD_EVENT_ID, F.lit(BAD_TEXT))
         .otherwise(C.ts_text("DateTime")).alias("DateTime"),
        "Bid", "Ask",
        F.concat_ws("_", "symbol", F.date_format("DateTime", "yyyyMMdd")).alias("file_key"))
    W.write_tick_csv(rows, bucket, K.RAW_PREFIX, key_col="file_key")
    return bucket


def file_key(path_col="path"):
    return F.regexp_extract(F.col(path_col), r"file_key=([^/]+)/", 1)


def converted(spark, sf):
    bucket = land(spark, sf)
    statuses = V.csv_to_parquet(spark, bucket, bucket, fail_on_error=False)
    return bucket, statuses


@register("file_listing", f"SELECT DISTINCT symbol, {FILE_KEY_SQL} AS file_key FROM {TK}")
def q_file_listing(spark, sf):
    lst = S.list_files(spark, f"{land(spark, sf)}/{K.RAW_PREFIX}", "*.csv")
    return lst.select(F.upper(C.path_symbol("path", K.RAW_PREFIX, encoded=False)).alias("symbol"),
                      file_key().alias("file_key"))


@register("discover_symbols", f"SELECT DISTINCT symbol FROM {TK}")
def q_discover_symbols(spark, sf):
    lst = S.list_files(spark, f"{land(spark, sf)}/{K.RAW_PREFIX}", "*.csv")
    return A.discover_symbols(lst.select(C.path_symbol("path", K.RAW_PREFIX, encoded=False).alias("symbol")))


@register("csv_scan", f"""
SELECT symbol, CASE WHEN event_id = {BAD_EVENT_ID} THEN '{BAD_TEXT}'
                    ELSE strftime(DateTime, '%Y-%m-%d %H:%M:%S.%g') END AS DateTime, Bid, Ask
FROM {TK}""")
def q_csv_scan(spark, sf):
    return S.csv_scan(spark, f"{land(spark, sf)}/{K.RAW_PREFIX}").select("symbol", "DateTime", "Bid", "Ask")


@register("csv_sink_roundtrip", f"SELECT symbol, {PARSED_SQL} AS DateTime, Bid, Ask FROM {TK}")
def q_csv_sink_roundtrip(spark, sf):
    return S.csv_scan(spark, f"{land(spark, sf)}/{K.RAW_PREFIX}") \
        .select("symbol", F.col("DateTime_ts").alias("DateTime"), "Bid", "Ask")


@register("named_csv_sink", f"""
SELECT 'raw/' || symbol || '/' || symbol || '_' || {WKEY} || '.csv' AS output_key, count(*) AS n_ticks,
       min(Bid) AS min_bid, max(Ask) AS max_ask
FROM {WIN} GROUP BY ALL""")
def q_named_csv_sink(spark, sf):
    """One file per symbol and window under the collector's name; written twice, it stays one."""
    bucket = scratch_path(spark, "bucket")
    ticks = T.in_windows(X.ticks(spark, sf))
    for part in (ticks.filter("event_id % 2 = 0"), ticks):   # the second write replaces the files of the first
        N.write_named_csv(part, bucket, K.RAW_PREFIX)
    key = F.regexp_extract("source_file", f"({K.RAW_PREFIX}/[^/]+/[^/]+)$", 1)
    return S.csv_scan(spark, f"{bucket}/{K.RAW_PREFIX}").groupBy(key.alias("output_key")).agg(
        F.count(F.lit(1)).alias("n_ticks"), F.min("Bid").alias("min_bid"), F.max("Ask").alias("max_ask"))


@register("parquet_sink_roundtrip", f"SELECT symbol, DateTime, Bid, Ask FROM {TK}")
def q_parquet_sink_roundtrip(spark, sf):
    bucket = scratch_path(spark, "bucket")
    W.write_tick_parquet(X.ticks(spark, sf), bucket, K.PARQUET_PREFIX, key_cols=("symbol",))
    return S.raw_scan(spark, bucket, K.PARQUET_PREFIX).select("symbol", "DateTime", "Bid", "Ask")


@register("raw_scan_symbol", f"SELECT symbol, DateTime, Bid, Ask FROM {TK} WHERE symbol = 'CLICK'")
def q_raw_scan_symbol(spark, sf):
    """Equality on the symbol of the path (F6): Spark reads that symbol's files only."""
    bucket = scratch_path(spark, "bucket")
    W.write_tick_parquet(X.ticks(spark, sf), bucket, K.PARQUET_PREFIX, key_cols=("symbol",))
    return S.raw_scan(spark, bucket, K.PARQUET_PREFIX).filter("symbol = 'CLICK'") \
        .select("symbol", "DateTime", "Bid", "Ask")


@register("csv_to_parquet", f"""
SELECT {FILE_KEY_SQL} AS file_key,
       CASE WHEN count(*) FILTER (WHERE event_id = {BAD_EVENT_ID}) > 0 THEN 'failed' ELSE 'converted' END AS status,
       count(*) AS n_rows, count(*) FILTER (WHERE event_id = {BAD_EVENT_ID}) AS n_bad
FROM {TK} GROUP BY 1""")
def q_csv_to_parquet(spark, sf):
    _, statuses = converted(spark, sf)
    return statuses.select(file_key().alias("file_key"), "status", "n_rows", "n_bad")


@register("csv_to_parquet_stream", f"""
SELECT {FILE_KEY_SQL} AS file_key,
       CASE WHEN count(*) FILTER (WHERE event_id = {BAD_EVENT_ID}) > 0 THEN 'failed' ELSE 'converted' END AS status,
       count(*) AS n_rows, count(*) FILTER (WHERE event_id = {BAD_EVENT_ID}) AS n_bad
FROM {TK} GROUP BY 1""")
def q_csv_to_parquet_stream(spark, sf):
    bucket = land(spark, sf)
    ck = scratch_path(spark, "convert-ckpt")
    V.csv_to_parquet_stream(spark, bucket, bucket, ck, max_files_per_trigger=64)
    V.csv_to_parquet_stream(spark, bucket, bucket, ck)   # second run: nothing new, nothing written
    return V.read_ledger(spark, bucket).select(file_key("source_file").alias("file_key"), "status",
                                               "n_rows", "n_bad")


@register("stream_readmission", f"""
SELECT symbol, {FILE_KEY_SQL} AS file_key, 'converted' AS status, date_trunc('millisecond', DateTime) AS DateTime, Bid, Ask
FROM {TK}""")
def q_stream_readmission(spark, sf):
    """The stream converts all files, one of them fails; it is corrected in place and the next run takes it again."""
    bucket, ck = scratch_path(spark, "bucket"), scratch_path(spark, "convert-ckpt")
    tk = X.ticks(spark, sf).withColumn("window_key", F.date_format("DateTime", "yyyyMMdd_0000"))
    bad = F.when(F.col("event_id") == BAD_EVENT_ID, F.lit(BAD_TEXT)).otherwise(C.ts_text("DateTime"))
    N.write_named_csv(tk.withColumn("DateTime", bad), bucket)
    V.csv_to_parquet_stream(spark, bucket, bucket, ck, max_files_per_trigger=256)
    failed = V.last_versions(V.read_ledger(spark, bucket)).where("status = 'failed'").select(
        F.regexp_extract("source_file", r"([^/]+)_(\d{8}_\d{4})\.csv$", 1).alias("symbol"),
        F.regexp_extract("source_file", r"([^/]+)_(\d{8}_\d{4})\.csv$", 2).alias("window_key"))
    N.write_named_csv(tk.join(failed, ["symbol", "window_key"], "left_semi"), bucket)
    V.csv_to_parquet_stream(spark, bucket, bucket, ck)
    status = V.last_versions(V.read_ledger(spark, bucket)).select("source_file", "status")
    return V.read_converted(spark, bucket).join(status, "source_file").select(
        "symbol", F.regexp_extract("source_file", r"([^/]+_\d{8})_\d{4}\.csv$", 1).alias("file_key"), "status",
        "DateTime", "Bid", "Ask")


@register("raw_scan", f"""
SELECT symbol, DateTime, Bid, Ask FROM (SELECT symbol, {PARSED_SQL} AS DateTime, Bid, Ask FROM {TK})
WHERE DateTime IS NOT NULL""")
def q_raw_scan(spark, sf):
    bucket, _ = converted(spark, sf)
    return S.raw_scan(spark, bucket, K.PARQUET_PREFIX).select("symbol", "DateTime", "Bid", "Ask")


@register("path_symbol", f"SELECT DISTINCT symbol FROM {TK}")
def q_path_symbol(spark, sf):
    bucket, _ = converted(spark, sf)
    return S.raw_scan(spark, bucket, K.PARQUET_PREFIX).select("symbol").distinct()


@register("quarantine", f"""
SELECT symbol, '{BAD_TEXT}' AS DateTime_text, Bid, Ask FROM {TK} WHERE event_id = {BAD_EVENT_ID}""")
def q_quarantine(spark, sf):
    bucket, _ = converted(spark, sf)
    return V.read_quarantine(spark, bucket).select("symbol", "DateTime_text", "Bid", "Ask")


@register("conversion_summary", f"""
SELECT coalesce(status, 'total') AS status, count(*) AS n_files FROM (
  SELECT CASE WHEN count(*) FILTER (WHERE event_id = {BAD_EVENT_ID}) > 0 THEN 'failed' ELSE 'converted' END AS status
  FROM {TK} GROUP BY {FILE_KEY_SQL}) GROUP BY ROLLUP (status)""")
def q_conversion_summary(spark, sf):
    _, statuses = converted(spark, sf)
    return V.conversion_summary(statuses)


@register("unconverted_files", f"""
SELECT DISTINCT {FILE_KEY_SQL} AS file_key FROM {TK}
WHERE strftime(DateTime, '%Y%m%d') >= '{EARLIER_RUN_BEFORE}'""")
def q_unconverted_files(spark, sf):
    bucket = land(spark, sf)
    listing = S.list_files(spark, f"{bucket}/{K.RAW_PREFIX}", "*.csv")
    earlier = listing.filter(F.regexp_extract("path", r"file_key=[^/]*_(\d{8})/", 1) < EARLIER_RUN_BEFORE)
    V.csv_to_parquet(spark, bucket, bucket, listing=earlier, fail_on_error=False)
    todo = V.unconverted_files(listing, V.read_ledger(spark, bucket))
    return todo.select(file_key().alias("file_key"))


@register("target_key", f"""
SELECT DISTINCT 'raw/' || symbol || '/' || symbol || '_' || {WKEY} || '.csv' AS key,
       'Training Batch/' || symbol || '/' || symbol || '_' || {WKEY} || '.parquet' AS target_key
FROM {WIN}""")
def q_target_key(spark, sf):
    keys = T.in_windows(X.ticks(spark, sf)) \
        .select(C.output_key("symbol", "local_date", "win_start_min").alias("key")).distinct()
    return V.target_keys(keys, "key")


@register("config_scan", f"""
SELECT DISTINCT symbol, 'raw' AS s3_prefix, 500 AS poll_interval_ms, 10 AS file_duration_mins FROM {TK}""")
def q_config_scan(spark, sf):
    path = scratch_path(spark, "config")
    syms = X.ticks(spark, sf).select("symbol").distinct()
    syms.agg(F.sort_array(F.collect_list("symbol")).alias("symbols")).select(
        "symbols",
        F.struct(F.lit("raw").alias("s3_prefix"), F.lit(500).alias("poll_interval_ms"),
                 F.lit(10).alias("file_duration_mins")).alias("settings"),
    ).coalesce(1).write.json(path)
    return S.config_scan(spark, path)


# ------------------------------------------------------------- gold tables --

GOLD_SQL = f"""SELECT symbol, DateTime, Bid, Ask,
       greatest(Ask - Bid, CAST(0 AS DOUBLE)) AS Spread, CAST(year(DateTime) AS INTEGER) AS year FROM {TK}"""


@register("spread_merge", GOLD_SQL)
def q_spread_merge(spark, sf):
    t = G.gold_table(spark, scratch_path(spark, "gold-spread"), spread=True)
    raw = X.ticks(spark, sf)
    G.ingest(t, raw.filter(F.col("event_id") % 3 == 0), spread=True)
    G.ingest(t, raw, spread=True)
    G.ingest(t, raw, spread=True)  # second full run inserts nothing
    return t.read().select("symbol", "DateTime", "Bid", "Ask", "Spread", "year")


@register("catalog_setup", f"""
SELECT 'ticks_' || lower(symbol) AS table_name, symbol, CAST(year(DateTime) AS INTEGER) AS year,
       count(*) AS n_rows
FROM {TK} GROUP BY ALL""")
def q_catalog_setup(spark, sf):
    root = scratch_path(spark, "catalog")
    for _ in range(2):  # both steps are idempotent: the second pass changes nothing
        CT.create_database(spark, "quotelake_demo", f"{root}/db")
        t = G.gold_table(spark, f"{root}/gold")
    G.ingest(t, X.ticks(spark, sf))
    return G.partitions(t)


@register("list_tick_tables", f"""
SELECT tableName FROM (SELECT DISTINCT 'ticks_' || lower(symbol) AS tableName FROM {TK}
                       UNION ALL SELECT DISTINCT 'ticks_' || lower(symbol) || '_spread' FROM {TK})""")
def q_list_tick_tables(spark, sf):
    db, ticks = _database(), X.ticks(spark, sf)
    # one row a symbol is enough to name its table: the views are made from the partitions
    symbols = ticks.groupBy("symbol").agg(F.min(F.struct("DateTime", "Bid", "Ask")).alias("t")).select("symbol", "t.*")
    for spread in (False, True):
        t = G.gold_table(spark, scratch_path(spark, "gold"), spread=spread)
        G.ingest(t, symbols, spread=spread)
        CT.publish(t, db, "gold_spread" if spread else "gold", spread, scratch_path(spark, "db"))
    return CT.tick_tables(spark.newSession(), db)


def _database() -> str:
    return f"quotelake_{uuid.uuid4().hex[:12]}"


@register("catalog_views", f"SELECT 'ticks_' || lower(symbol) AS table_name, symbol, DateTime, Bid, Ask FROM {TK}")
def q_catalog_views(spark, sf):
    """The rows of every symbol's lasting view, as another session of the catalog reads them."""
    db, ticks = _database(), X.ticks(spark, sf)
    t = G.gold_table(spark, scratch_path(spark, "gold"))
    for part in (ticks.filter("event_id % 3 = 0"), ticks):   # the second pass adds partitions to what is there
        G.ingest(t, part)
        CT.publish(t, db, location=scratch_path(spark, "db"))
    other = spark.newSession()
    views = [r[0] for r in CT.tick_tables(other, db).collect()]
    rows = [other.table(f"{db}.{v}").select(F.lit(v).alias("table_name"), "symbol", "DateTime", "Bid", "Ask") for v in views]
    return reduce(DataFrame.unionByName, rows)


@register("ingest_report", f"""
SELECT s.symbol, coalesce(n.c, 0) AS new_keys, coalesce(n.c, 0) AS inserted_rows
FROM (SELECT DISTINCT symbol FROM {TK}) s
LEFT JOIN (SELECT symbol, count(*) AS c FROM {TK} WHERE event_id % 3 <> 0 GROUP BY symbol) n
  ON s.symbol = n.symbol""")
def q_ingest_report(spark, sf):
    t = G.gold_table(spark, scratch_path(spark, "gold"))
    raw = X.ticks(spark, sf)
    G.ingest(t, raw.filter(F.col("event_id") % 3 == 0))
    return G.ingest_report(t, raw)
