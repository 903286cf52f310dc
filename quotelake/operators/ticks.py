"""Tick selection: filters, window membership, per-second and per-window picks.

Input ticks carry at least ``symbol`` and ``DateTime`` (UTC, timestamp_ntz);
polled ticks also ``time_msc`` and ``flags``.  Every function is a lazy
DataFrame transformation; none collects data (``window_coverage`` fetches two dates).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from .joins import checkpointed, join_dimension


# ---------------------------------------------------------------- filters ---

def flag_filter(ticks: DataFrame, flags_col: str = "flags") -> DataFrame:
    """Keep ticks that changed the bid or the ask (F1)."""
    return ticks.filter(C.flag_change(flags_col))


def weekend_filter(ticks: DataFrame, crypto=K.CRYPTO_SYMBOLS, ts_col: str = "DateTime",
                   zone: str = K.LOCAL_ZONE) -> DataFrame:
    """Drop non-crypto ticks that fall on a local Saturday or Sunday."""
    weekend = C.local_weekday(ts_col, zone) >= 5
    return ticks.filter(~weekend | C.is_crypto("symbol", crypto))


def high_water_marks(seen: DataFrame, ms_col: str = "time_msc") -> DataFrame:
    """Cursor per symbol: the largest tick time already taken (F2)."""
    return seen.groupBy("symbol").agg(F.max(ms_col).alias("cursor_ms"))


def cursor_filter(ticks: DataFrame, marks: DataFrame, ms_col: str = "time_msc") -> DataFrame:
    """Keep ticks strictly after their symbol's cursor; no cursor keeps all (F2).

    ``marks`` has one row per symbol (``symbol, cursor_ms``); it is
    broadcast after a size check, so a hot symbol never lands in one task.
    """
    joined = join_dimension(ticks, marks.select("symbol", "cursor_ms"), "symbol", "left")
    return joined.filter(F.col("cursor_ms").isNull() | (F.col(ms_col) > F.col("cursor_ms"))) \
        .drop("cursor_ms")


def market_open(ticks: DataFrame, instruments: DataFrame) -> DataFrame:
    """Drop ticks of unknown symbols and of symbols with trade_mode 0."""
    open_ = instruments.filter(F.col("trade_mode") != 0).select(F.upper("symbol").alias("symbol"))
    return join_dimension(ticks, open_.distinct(), "symbol", "left_semi")


def validate_symbols(configured: DataFrame, instruments: DataFrame) -> DataFrame:
    """Configured symbols with ``status`` = valid | missing.

    One left join to the (size-checked, broadcast) instrument list: a match
    means the instrument exists (valid), no match means missing.
    """
    inst = instruments.select(F.upper("symbol").alias("symbol"), F.lit(True).alias("_found")).distinct()
    cfg = configured.select(F.upper("symbol").alias("symbol")).distinct()
    return join_dimension(cfg, inst, "symbol", "left").select(
        "symbol", F.when(F.col("_found"), F.lit("valid")).otherwise(F.lit("missing")).alias("status"))


# --------------------------------------------------------------- windows ---

def tag_windows(ticks: DataFrame, ts_col: str = "DateTime", windows=K.COLLECTION_WINDOWS,
                zone: str = K.LOCAL_ZONE) -> DataFrame:
    """Add local time, local date, window start minute and window key.

    Ticks outside every window get null window columns.
    """
    t = ticks.withColumn("local_ts", C.to_local(ts_col, zone))
    t = t.withColumn("local_date", F.to_date("local_ts"))
    t = t.withColumn("win_start_min", C.window_start_min("local_ts", windows))
    return t.withColumn("window_key",
                        F.when(F.col("win_start_min").isNotNull(),
                               C.window_key("local_date", "win_start_min")))


def in_windows(ticks: DataFrame, ts_col: str = "DateTime", windows=K.COLLECTION_WINDOWS,
               zone: str = K.LOCAL_ZONE) -> DataFrame:
    """Ticks inside a half-open local window, tagged with the window."""
    return tag_windows(ticks, ts_col, windows, zone).filter(F.col("win_start_min").isNotNull())


def skip_started_windows(tagged: DataFrame, job_start_local: _dt.datetime) -> DataFrame:
    """Keep ticks of windows that start strictly after the job start."""
    start = C.window_start_ts("local_date", "win_start_min")
    return tagged.filter(start > F.lit(job_start_local.strftime("%Y-%m-%d %H:%M:%S"))
                         .cast("timestamp_ntz"))


# ------------------------------------------------------ per-group picks ---

def first_per_second(ticks: DataFrame, order=("DateTime",), ts_col: str = "DateTime") -> DataFrame:
    """First tick of each (symbol, UTC second).

    ``order`` must make the pick deterministic (add a tie-break column).
    ``row_number() = 1`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so at most one row per group and map task is shuffled: even
    a hot second reaches its reducer as one row per map task.
    """
    w = Window.partitionBy("symbol", C.second_key(ts_col)).orderBy(*order)
    return ticks.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


# Sub-groups per window in the first level of ``cap_per_window``.
CAP_SALT_BUCKETS = 32


def cap_per_window(tagged: DataFrame, cap: int = K.MAX_TICKS_PER_WINDOW,
                   order=("DateTime",), salt_buckets: int = CAP_SALT_BUCKETS) -> DataFrame:
    """Keep the first ``cap`` ticks of each (symbol, local date, window).

    Two levels, so a hot window is never sorted by one task: first the top
    ``cap`` of each (window, salt) sub-group, the salt being a hash of the
    ordering columns; then the top ``cap`` of the at most
    ``cap × salt_buckets`` survivors per window.  The overall first ``cap``
    rows are among the first ``cap`` of their sub-group, so the result is
    exact.  Each level gets Spark's partial per-map-task limit before its
    shuffle.  ``salt_buckets=1`` gives one level, for inputs whose windows
    are bounded already (e.g. after ``first_per_second``: ≤ 600 per window).
    """
    group = ["symbol", "local_date", "win_start_min"]
    if salt_buckets > 1:
        sub = Window.partitionBy(*group, "_salt").orderBy(*order)
        tagged = tagged.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salt_buckets))) \
            .withColumn("_rn", F.row_number().over(sub)).filter(F.col("_rn") <= cap) \
            .drop("_rn", "_salt")
    w = Window.partitionBy(*group).orderBy(*order)
    return tagged.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= cap).drop("_rn")


# -------------------------------------------------------------- calendar ---

def _window_starts(windows):
    return F.array(*[F.lit(sh * 60 + sm) for sh, sm, _, _ in windows])


def window_calendar(tagged: DataFrame, windows=K.COLLECTION_WINDOWS, extra_days: int = 0) -> DataFrame:
    """Every (local date, window) between the first and last local date seen.

    The date range comes from one global aggregate (one row); dates and
    windows are generated with ``sequence``/``explode``, no join.
    """
    rng = tagged.agg(F.min("local_date").alias("d0"), F.max("local_date").alias("d1"))
    days = rng.select(F.explode(F.sequence("d0", F.date_add("d1", extra_days))).alias("local_date"))
    cal = days.select("local_date", F.explode(_window_starts(windows)).alias("win_start_min"))
    return cal.withColumn("window_key", C.window_key("local_date", "win_start_min")) \
        .withColumn("win_start", C.window_start_ts("local_date", "win_start_min"))


def window_coverage(tagged: DataFrame, crypto=K.CRYPTO_SYMBOLS, windows=K.COLLECTION_WINDOWS,
                    zone: str = K.LOCAL_ZONE) -> DataFrame:
    """Ticks per symbol and window over the whole calendar, zeros included (A10).

    ``status``: ok (ticks present), expected_empty (weekend, non-crypto),
    missing (no ticks where some were due).  The ticks are read once, into
    counts per symbol, date and window (null: outside all windows), which
    give the symbols and the date range (fetched as two dates) too; each
    symbol row then generates its calendar with ``sequence``/``explode``.
    """
    every = checkpointed(tagged.groupBy("symbol", "local_date", "win_start_min").agg(F.count(F.lit(1)).alias("n_ticks")))
    counts = every.filter(F.col("win_start_min").isNotNull())
    d0, d1 = every.agg(F.min("local_date"), F.max("local_date")).first()
    symbols = every.select("symbol").distinct()
    if d0 is None:
        days = F.array().cast("array<date>")
    else:
        days = F.sequence(F.lit(d0.isoformat()).cast("date"), F.lit(d1.isoformat()).cast("date"))
    cal = symbols.select("symbol", F.explode(days).alias("local_date")) \
        .select("symbol", "local_date", F.explode(_window_starts(windows)).alias("win_start_min"))
    out = cal.join(counts, ["symbol", "local_date", "win_start_min"], "left") \
        .withColumn("n_ticks", F.coalesce("n_ticks", F.lit(0)).cast("long"))
    weekend = F.weekday("local_date") >= 5
    status = F.when(F.col("n_ticks") > 0, "ok") \
        .when(weekend & ~C.is_crypto("symbol", crypto), "expected_empty").otherwise("missing")
    return out.select("symbol", C.window_key("local_date", "win_start_min").alias("window_key"),
                      "n_ticks", status.alias("status"))


def uncompleted_windows(tagged: DataFrame, completed: DataFrame | None = None,
                        windows=K.COLLECTION_WINDOWS, extra_days: int = 0) -> DataFrame:
    """Calendar windows not yet completed.

    ``completed`` holds ``window_key`` values; by default a window counts as
    completed when it holds any tick.
    """
    cal = window_calendar(tagged, windows, extra_days)
    if completed is None:
        completed = tagged.filter(F.col("window_key").isNotNull()).select("window_key").distinct()
    return cal.join(completed, "window_key", "left_anti").select("window_key", "win_start")


def next_uncompleted_window(tagged: DataFrame, now_local: _dt.datetime, days_ahead: int = 7,
                            completed: DataFrame | None = None,
                            windows=K.COLLECTION_WINDOWS) -> DataFrame:
    """Earliest window starting after ``now_local`` within ``days_ahead`` days."""
    spark = tagged.sparkSession
    day0 = now_local.date()
    days = spark.range(0, days_ahead + 1).select(
        F.date_add(F.lit(day0.isoformat()).cast("date"), F.col("id").cast("int")).alias("local_date"))
    cal = days.select("local_date", F.explode(_window_starts(windows)).alias("win_start_min")) \
        .withColumn("window_key", C.window_key("local_date", "win_start_min")) \
        .withColumn("win_start", C.window_start_ts("local_date", "win_start_min"))
    if completed is None:
        completed = tagged.filter(F.col("window_key").isNotNull()).select("window_key").distinct()
    now = F.lit(now_local.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    cand = cal.filter(F.col("win_start") > now).join(completed, "window_key", "left_anti")
    return cand.orderBy("win_start").limit(1).select("window_key", "win_start")
