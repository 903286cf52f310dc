"""Streaming queries: derived ticks are landed as files, a stream drains them
(``availableNow``) into an exactly-once sink, and the sink is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gold as G
from ..session import scratch_path
from ..sources import polls as P
from ..streaming import ticks as R
from ..streaming.collector import Collector
from . import fixtures as X
from .registry import CAL, TK, WIN, WKEY, register

#: Polls a micro-batch takes while a backlog of landed ticks is drained.
BACKLOG_POLLS = 64


def landed(spark, sf) -> str:
    path = scratch_path(spark, "landing")
    X.ticks(spark, sf).select(*R.TICK_STREAM_SCHEMA.fieldNames()).write.parquet(path)
    return path


def _run(spark, df, name, mode="append", with_query=False):
    sink, ck = scratch_path(spark, name), scratch_path(spark, name + "-ckpt")
    q = R.run_to_parquet(df, sink, ck, mode=mode)
    return (sink, q) if with_query else sink


@register("stream_source", f"SELECT event_id, symbol, time_msc, flags, Bid, Ask FROM {TK} WHERE (flags & 6) <> 0")
def q_stream_source(spark, sf):
    s = R.tick_stream(spark, landed(spark, sf), max_files_per_trigger=2)
    sink = _run(spark, R.changes_only(s), "stream-source")
    return spark.read.parquet(sink).select("event_id", "symbol", "time_msc", "flags", "Bid", "Ask")


@register("stream_source_bounded", f"""
SELECT event_id, symbol, time_msc, flags, Bid, Ask,
       CAST((row_number() OVER (PARTITION BY symbol ORDER BY time_msc, event_id) - 1) // 5000 AS BIGINT) AS poll
FROM {TK}""")
def q_stream_source_bounded(spark, sf):
    """Every tick with the poll that took it: at most 5,000 a symbol and poll, in order of time.

    Files are dealt out by range and have small row groups, so that a poll reads little beside its own ticks.
    """
    land, sink = scratch_path(spark, "landing"), scratch_path(spark, "polls")
    X.ticks(spark, sf).repartitionByRange("symbol", "time_msc").sortWithinPartitions("symbol", "time_msc") \
        .write.option("parquet.block.size", 1 << 20).partitionBy("symbol").parquet(land)

    def each(batch, epoch):
        # every poll but a symbol's last is full, so a micro-batch before this one took BACKLOG_POLLS of them
        batch.withColumn("poll", F.lit(epoch).cast("bigint") * BACKLOG_POLLS + F.col("poll")) \
            .write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    R.run_batches(P.tick_polls(spark, land, polls=BACKLOG_POLLS), each, scratch_path(spark, "polls-ckpt"), "drain")
    return spark.read.parquet(sink).select("event_id", "symbol", "time_msc", "flags", "Bid", "Ask", "poll")


@register("stream_first_per_second", f"""
SELECT event_id, symbol, DateTime, Bid, Ask FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date_trunc('second', DateTime)
                               ORDER BY DateTime, event_id) AS rn FROM {TK}) f
WHERE rn = 1""")
def q_stream_first_per_second(spark, sf):
    sink = scratch_path(spark, "stream-fps")
    R.first_per_second_to(R.tick_stream(spark, landed(spark, sf), max_files_per_trigger=3), sink,
                          scratch_path(spark, "stream-fps-ckpt"))
    return R.read_first_per_second(spark, sink).select("event_id", "symbol", "DateTime", "Bid", "Ask")


def scattered(spark, sf) -> str:
    """Landed ticks in files of no order of time or symbol, so a stream takes them over several micro-batches."""
    path = scratch_path(spark, "landing")
    X.ticks(spark, sf).select(*R.TICK_STREAM_SCHEMA.fieldNames()).repartition(9, F.xxhash64("event_id")) \
        .write.parquet(path)
    return path


def collected(spark, sf, **kwargs) -> Collector:
    """A collector that has taken all ticks and was shut down."""
    c = Collector(spark, scratch_path(spark, "collected"), grace=X.FIXTURE_GRACE, **kwargs)
    c.run(R.tick_stream(spark, scattered(spark, sf), max_files_per_trigger=3), scratch_path(spark, "collected-ckpt"))
    c.flush()
    return c


def guarded(spark, sf) -> Collector:
    """The same, run from a config with the instrument list, weekend rule and job start of the fixtures."""
    config, listed = scratch_path(spark, "config"), scratch_path(spark, "instruments")
    X.ticks(spark, sf).select("symbol").distinct().agg(F.sort_array(F.collect_set("symbol")).alias("symbols")) \
        .coalesce(1).write.json(config)
    X.instruments(spark, sf).select("symbol", "trade_mode").write.parquet(listed)
    c = Collector.from_config(spark, scratch_path(spark, "collected"), config, instruments=listed,
                              weekend_symbols=X.FIXTURE_CRYPTO, since=X.FIXTURE_JOB_START, grace=X.FIXTURE_GRACE)
    c.run(R.tick_stream(spark, scattered(spark, sf), max_files_per_trigger=3), scratch_path(spark, "collected-ckpt"))
    c.flush()
    return c


def first_sql(cap: int, where: str = "true") -> str:
    """The first ``cap`` ticks of each window, one a second, of the changed ticks that satisfy ``where``."""
    return f"""(SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, window_key ORDER BY DateTime, event_id) AS nth FROM (
    SELECT *, {WKEY} AS window_key,
           row_number() OVER (PARTITION BY symbol, date_trunc('second', DateTime) ORDER BY DateTime, event_id) AS rn
    FROM {WIN} WHERE (flags & 6) <> 0 AND {where}) f
  WHERE rn = 1) g WHERE nth <= {cap})"""


FILE_ROWS = """symbol, window_key, strftime(DateTime, '%Y-%m-%d %H:%M:%S.%g') AS "DateTime", Bid, Ask"""
#: What the guards let through: open instruments, crypto on weekends, windows that start after the job.
GUARDS = """symbol IN ('CLICK', 'VIEW', 'SIGNUP') AND (isodow(loc) < 6 OR symbol IN ('CLICK', 'VIEW'))
  AND CAST(CAST(loc AS DATE) AS TIMESTAMP) + to_minutes(ws) > TIMESTAMP '2024-01-15 08:30:00'"""


@register("stream_collector", f"SELECT {FILE_ROWS} FROM {first_sql(600)} c")
def q_stream_collector(spark, sf):
    return collected(spark, sf).read()


@register("stream_window_flush", f"""
SELECT symbol, window_key, count(*) AS n_ticks, 'ok' AS status FROM {first_sql(600)} c GROUP BY ALL""")
def q_stream_window_flush(spark, sf):
    return collected(spark, sf).coverage()


@register("stream_cap", f"SELECT {FILE_ROWS} FROM {first_sql(3)} c")
def q_stream_cap(spark, sf):
    return collected(spark, sf, cap=3).read()


@register("stream_guards", f"SELECT {FILE_ROWS} FROM {first_sql(600, GUARDS)} c")
def q_stream_guards(spark, sf):
    """Weekend, market, configured symbol and begun window, as guards of the running collector."""
    return guarded(spark, sf).read()


@register("stream_coverage", f"""
SELECT s.symbol, k.window_key, coalesce(n.n, 0) AS n_ticks,
       CASE WHEN n.n > 0 THEN 'ok' WHEN isodow(k.local_date) >= 6 AND s.symbol NOT IN ('CLICK', 'VIEW') THEN 'expected_empty'
            ELSE 'missing' END AS status
FROM (SELECT DISTINCT symbol FROM {TK} WHERE symbol <> 'PURCHASE') s, {CAL} k
LEFT JOIN (SELECT symbol, window_key, count(*) AS n FROM {first_sql(600, GUARDS)} c GROUP BY ALL) n
  ON s.symbol = n.symbol AND k.window_key = n.window_key
WHERE k.win_start > TIMESTAMP '2024-01-15 08:30:00'
  AND (n.n > 0 OR k.win_start + INTERVAL 11 MINUTE <= (SELECT max(DateTime) + INTERVAL 2 HOUR FROM {TK}))""")
def q_stream_coverage(spark, sf):
    """Windows the collector reported: with ticks, empty as expected, or missing (A10)."""
    return guarded(spark, sf).coverage()


@register("stream_tallies", f"""
SELECT CAST(count(*) AS BIGINT) AS total_ticks, CAST(count(DISTINCT symbol || window_key) AS BIGINT) AS total_files
FROM {first_sql(600)} c""")
def q_stream_tallies(spark, sf):
    """Ticks and files that the collector counted while it ran."""
    return collected(spark, sf).tallies()


@register("stream_merge", f"SELECT symbol, DateTime, Bid, Ask FROM {TK}")
def q_stream_merge(spark, sf):
    t = G.gold_table(spark, scratch_path(spark, "gold-stream"))
    G.ingest(t, X.ticks(spark, sf).filter(F.col("event_id") % 3 == 0))
    s = R.tick_stream(spark, landed(spark, sf), max_files_per_trigger=4)
    R.merge_stream_into_gold(s, t, scratch_path(spark, "gold-stream-ckpt"))
    return t.read().select("symbol", "DateTime", "Bid", "Ask")
