"""Registry of queries: one Spark plan and (where SQL can say it) one DuckDB oracle.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads the provided
tables (or data Spark derives from them).  ``ORACLES`` holds the matching
ANSI SQL for DuckDB over the same tables; column names agree on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import merge as M
from ..operators import ticks as T
from . import fixtures as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


# ----------------------------------------------------------- SQL fragments --

TK = """(SELECT event_id, upper(event_type) AS symbol, ts AS DateTime,
        epoch_us(ts) // 1000 AS time_msc, CAST(event_id % 8 AS INTEGER) AS flags,
        value AS Bid, value + CAST((event_id % 7) - 1 AS DOUBLE) / 100 AS Ask
      FROM events)"""

WIN = f"""(SELECT t.*, t.DateTime + INTERVAL 2 HOUR AS loc, w.ws, w.we
      FROM {TK} t JOIN (VALUES (470, 480), (830, 840)) w(ws, we)
        ON hour(t.DateTime + INTERVAL 2 HOUR) * 60 + minute(t.DateTime + INTERVAL 2 HOUR) >= w.ws
       AND hour(t.DateTime + INTERVAL 2 HOUR) * 60 + minute(t.DateTime + INTERVAL 2 HOUR) < w.we)"""

HHMM = "lpad(CAST((ws // 60) * 100 + ws % 60 AS VARCHAR), 4, '0')"
WKEY = f"strftime(loc, '%Y%m%d') || '_' || {HHMM}"

CAL = f"""(SELECT d.local_date, w.ws,
             strftime(d.local_date, '%Y%m%d') || '_' || {HHMM} AS window_key,
             CAST(d.local_date AS TIMESTAMP) + to_minutes(w.ws) AS win_start
      FROM (SELECT CAST(unnest(generate_series(min(CAST(DateTime + INTERVAL 2 HOUR AS DATE)),
                                               max(CAST(DateTime + INTERVAL 2 HOUR AS DATE)),
                                               INTERVAL 1 DAY)) AS DATE) AS local_date
            FROM {TK}) d,
           (VALUES (470), (830)) w(ws))"""


def _ticks(spark, sf):
    return X.ticks(spark, sf)


def _win(spark, sf):
    return T.in_windows(_ticks(spark, sf))


# ------------------------------------------------------------ tick queries --

@register("flag_filter", f"SELECT event_id, flags FROM {TK} WHERE (flags & 6) <> 0")
def q_flag_filter(spark, sf):
    return T.flag_filter(_ticks(spark, sf)).select("event_id", "flags")


@register("epoch_to_text", f"""
SELECT event_id, strftime(make_timestamp(time_msc * 1000), '%Y-%m-%d %H:%M:%S.%g') AS DateTime_text
FROM {TK}""")
def q_epoch_to_text(spark, sf):
    return _ticks(spark, sf).select("event_id", C.ts_text(C.ms_to_ts("time_msc")).alias("DateTime_text"))


@register("first_per_second", f"""
SELECT event_id, symbol, DateTime, Bid, Ask FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date_trunc('second', DateTime)
                               ORDER BY DateTime, event_id) AS rn FROM {TK}) WHERE rn = 1""")
def q_first_per_second(spark, sf):
    return T.first_per_second(_ticks(spark, sf), order=("DateTime", "event_id")) \
        .select("event_id", "symbol", "DateTime", "Bid", "Ask")


@register("window_membership", f"SELECT event_id, symbol, {WKEY} AS window_key FROM {WIN}")
def q_window_membership(spark, sf):
    return _win(spark, sf).select("event_id", "symbol", "window_key")


@register("cap_per_window", f"""
SELECT event_id, symbol, window_key FROM (
  SELECT event_id, symbol, {WKEY} AS window_key,
         row_number() OVER (PARTITION BY symbol, CAST(loc AS DATE), ws ORDER BY DateTime, event_id) AS rn
  FROM {WIN}) WHERE rn <= 1""")
def q_cap_per_window(spark, sf):
    return T.cap_per_window(_win(spark, sf), cap=X.FIXTURE_CAP, order=("DateTime", "event_id")) \
        .select("event_id", "symbol", "window_key")


@register("weekend_filter", f"""
SELECT event_id, symbol FROM {TK}
WHERE NOT (isodow(DateTime + INTERVAL 2 HOUR) >= 6 AND symbol NOT IN ('CLICK', 'VIEW'))""")
def q_weekend_filter(spark, sf):
    return T.weekend_filter(_ticks(spark, sf), crypto=X.FIXTURE_CRYPTO).select("event_id", "symbol")


@register("cursor_filter", f"""
SELECT t.event_id, t.symbol FROM {TK} t
JOIN (SELECT symbol, min(time_msc) + 864000000 AS h FROM {TK} WHERE event_id % 3 = 0 GROUP BY symbol) m
  ON t.symbol = m.symbol
WHERE t.time_msc > m.h""")
def q_cursor_filter(spark, sf):
    return T.cursor_filter(_ticks(spark, sf), X.cursor_marks(spark, sf)).select("event_id", "symbol")


@register("cursor_advance", f"""
SELECT t.event_id, t.symbol FROM {TK} t
LEFT JOIN (SELECT symbol, max(time_msc) AS h FROM {TK} WHERE DateTime < TIMESTAMP '2024-01-15 08:30:00'
           GROUP BY symbol) m ON t.symbol = m.symbol
WHERE m.h IS NULL OR t.time_msc > m.h""")
def q_cursor_advance(spark, sf):
    """What a poll takes after all ticks before the job start were taken."""
    t = _ticks(spark, sf)
    start = F.lit(X.FIXTURE_JOB_START.isoformat(sep=" ")).cast("timestamp_ntz")
    return T.cursor_filter(t, T.high_water_marks(t.filter(F.col("DateTime") < start))).select("event_id", "symbol")


@register("market_open_semi", f"SELECT event_id FROM {TK} WHERE symbol IN ('CLICK', 'VIEW', 'SIGNUP')")
def q_market_open_semi(spark, sf):
    return T.market_open(_ticks(spark, sf), X.instruments(spark, sf)).select("event_id")


@register("symbol_validation", f"""
SELECT DISTINCT symbol, CASE WHEN symbol = 'PURCHASE' THEN 'missing' ELSE 'valid' END AS status
FROM {TK}""")
def q_symbol_validation(spark, sf):
    configured = _ticks(spark, sf).select("symbol").distinct()
    return T.validate_symbols(configured, X.instruments(spark, sf))


@register("skip_started_windows", f"""
SELECT event_id FROM {WIN}
WHERE CAST(CAST(loc AS DATE) AS TIMESTAMP) + to_minutes(ws) > TIMESTAMP '2024-01-15 08:30:00'""")
def q_skip_started_windows(spark, sf):
    return T.skip_started_windows(_win(spark, sf), X.FIXTURE_JOB_START).select("event_id")


@register("output_key", f"""
SELECT DISTINCT 'raw/' || symbol || '/' || symbol || '_' || {WKEY} || '.csv' AS output_key FROM {WIN}""")
def q_output_key(spark, sf):
    return _win(spark, sf).select(C.output_key("symbol", "local_date", "win_start_min").alias("output_key")) \
        .distinct()


@register("window_coverage", f"""
SELECT c.symbol, c.window_key, coalesce(n.n, 0) AS n_ticks,
       CASE WHEN coalesce(n.n, 0) > 0 THEN 'ok'
            WHEN isodow(c.local_date) >= 6 AND c.symbol NOT IN ('CLICK', 'VIEW') THEN 'expected_empty'
            ELSE 'missing' END AS status
FROM (SELECT s.symbol, k.* FROM (SELECT DISTINCT symbol FROM {TK}) s, {CAL} k) c
LEFT JOIN (SELECT symbol, CAST(loc AS DATE) AS local_date, ws, count(*) AS n FROM {WIN} GROUP BY ALL) n
  ON c.symbol = n.symbol AND c.local_date = n.local_date AND c.ws = n.ws""")
def q_window_coverage(spark, sf):
    return T.window_coverage(T.tag_windows(_ticks(spark, sf)), crypto=X.FIXTURE_CRYPTO)


@register("uncompleted_windows", f"""
SELECT window_key, win_start FROM {CAL} k
WHERE NOT EXISTS (SELECT 1 FROM {WIN} w WHERE CAST(w.loc AS DATE) = k.local_date AND w.ws = k.ws)""")
def q_uncompleted_windows(spark, sf):
    return T.uncompleted_windows(T.tag_windows(_ticks(spark, sf)))


@register("next_uncompleted_window", f"""
SELECT strftime(d, '%Y%m%d') || '_' || {HHMM} AS window_key, d + to_minutes(ws) AS win_start
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-22', INTERVAL 1 DAY))
                  AS TIMESTAMP) AS d) days, (VALUES (470), (830)) k(ws)
WHERE d + to_minutes(ws) > TIMESTAMP '2024-01-15 08:30:00'
  AND NOT EXISTS (SELECT 1 FROM {WIN} w WHERE CAST(w.loc AS DATE) = CAST(d AS DATE) AND w.ws = k.ws)
ORDER BY win_start LIMIT 1""")
def q_next_uncompleted_window(spark, sf):
    return T.next_uncompleted_window(T.tag_windows(_ticks(spark, sf)), X.FIXTURE_JOB_START)


@register("table_sample", f"SELECT * FROM {TK} ORDER BY DateTime, event_id LIMIT 10")
def q_table_sample(spark, sf):
    return _ticks(spark, sf).orderBy("DateTime", "event_id").limit(10)


@register("spread", f"""
SELECT event_id, Bid, Ask,
       CASE WHEN Ask IS NULL OR Bid IS NULL THEN NULL ELSE greatest(Ask - Bid, CAST(0 AS DOUBLE)) END AS Spread
FROM {TK}""")
def q_spread(spark, sf):
    return _ticks(spark, sf).select("event_id", "Bid", "Ask", C.spread().alias("Spread"))


@register("window_tick_counts", f"""
SELECT symbol, window_key, count(*) AS n_ticks, min(DateTime) AS first_tick, max(DateTime) AS last_tick,
       avg(Bid) AS avg_bid, avg(Ask) AS avg_ask
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, CAST(loc AS DATE), ws ORDER BY DateTime, event_id) AS rn_cap
      FROM (SELECT *, {WKEY} AS window_key,
                   row_number() OVER (PARTITION BY symbol, date_trunc('second', DateTime)
                                      ORDER BY DateTime, event_id) AS rn_sec
            FROM {WIN} WHERE (flags & 6) <> 0) WHERE rn_sec = 1)
WHERE rn_cap <= 600
GROUP BY symbol, window_key""")
def q_window_tick_counts(spark, sf):
    """The flagship (``entry``): F1 → J3 → W1 → W2 → counts per symbol-window."""
    from . import flagship
    return flagship.window_tick_counts(spark, sf)


# ----------------------------------------------------------- merge queries --

@register("new_key_count", f"""
SELECT s.symbol, count(*) AS new_count
FROM (SELECT DISTINCT DateTime, symbol FROM {TK}) s
LEFT JOIN (SELECT DateTime, symbol FROM {TK} WHERE event_id % 3 = 0) t
  ON s.DateTime = t.DateTime AND s.symbol = t.symbol
WHERE t.DateTime IS NULL GROUP BY s.symbol""")
def q_new_key_count(spark, sf):
    return M.new_key_count(_ticks(spark, sf), X.existing_gold(spark, sf))


@register("ingest_summary", f"""
SELECT s.symbol, coalesce(n.new_count, 0) AS new_count
FROM (SELECT DISTINCT symbol FROM {TK}) s
LEFT JOIN (SELECT symbol, count(*) AS new_count FROM {TK}
           WHERE event_id % 3 <> 0 AND symbol <> 'VIEW' GROUP BY symbol) n ON s.symbol = n.symbol""")
def q_ingest_summary(spark, sf):
    tk = _ticks(spark, sf)
    src = tk.filter(F.col("symbol") != "VIEW")
    counts = M.new_key_count(src, X.existing_gold(spark, sf))
    return M.ingest_summary(tk.select("symbol"), counts)


@register("merge_insert_new", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_orderkey % 3 = 0
UNION ALL
SELECT * FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_extendedprice FROM lineitem) s
WHERE NOT EXISTS (SELECT 1 FROM lineitem t WHERE t.l_orderkey % 3 = 0
                  AND t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)""")
def q_merge_insert_new(spark, sf):
    li = X.lineitem_prices(spark, sf)
    target = li.filter(F.col("l_orderkey") % 3 == 0)
    return M.merge_insert_new(li, target, cols=("l_orderkey", "l_linenumber", "l_extendedprice"),
                              keys=("l_orderkey", "l_linenumber"))


@register("key_conflicts", """
SELECT CAST(sum(n) AS BIGINT) AS distinct_rows, count(*) AS distinct_keys,
       count(*) FILTER (WHERE n > 1) AS conflicting_keys
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n
      FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_extendedprice FROM lineitem)
      GROUP BY l_orderkey, l_linenumber)""")
def q_key_conflicts(spark, sf):
    return M.key_conflicts(X.lineitem_prices(spark, sf), keys=("l_orderkey", "l_linenumber"),
                           payload=("l_extendedprice",))


# ------------------------------------------------------------- aggregates --

@register("year_counts", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS cnt FROM orders GROUP BY 1""")
def q_year_counts(spark, sf):
    return A.year_counts(X.table(spark, sf, "orders"), ts_col="o_orderdate")


@register("year_counts_total", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS cnt FROM orders
GROUP BY ROLLUP (year(o_orderdate))""")
def q_year_counts_total(spark, sf):
    return A.year_counts_total(X.table(spark, sf, "orders"), ts_col="o_orderdate")


# Query modules that register themselves on import.
from . import history_queries  # noqa: E402,F401
from . import file_queries  # noqa: E402,F401
from . import stream_queries  # noqa: E402,F401
