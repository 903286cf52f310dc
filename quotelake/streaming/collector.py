"""The tick collector as a stream: one named CSV per symbol and collection window.

ticks → guards → first per second and Arrow batch → state per symbol
(``windows.WindowProcessor``) → ``foreachBatch``: the files of the windows
that were published, window reports, late ticks.

Below ``root`` lie, besides ``<prefix>/SYM/SYM_yyyyMMdd_HHmm.csv``:

* ``_windows/epoch=N``: one row for each report of a window (ticks in it,
  ticks at its last publication, status);
* ``_late/epoch=N``: ticks that came after their window's grace.

Files are replaced as a whole and each epoch overwrites its own folders, so a
replayed epoch changes nothing.  Nothing of earlier epochs is read: the ticks
of open windows lie in the checkpoint's state.  A new checkpoint needs a new
root.
"""

from __future__ import annotations

import datetime as _dt
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..operators import ticks as TK
from ..operators.joins import checkpointed
from ..session import hadoop_exists
from ..sources import files as S
from ..sources import named_files as N
from ..sources.instruments import instruments as instrument_list
from . import windows as WS
from .ticks import run_batches

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REPORT = "symbol string, win_ms bigint, n bigint, before bigint, status string"
LATE = "symbol string, win_ms bigint, at_us bigint, tie bigint, Bid double, Ask double"


@contextmanager
def _conf(spark: SparkSession, **values):
    """Session settings that a query takes over when it starts, restored afterwards."""
    old = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in values}
    for k, v in values.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class Collector:
    """Collect the changed ticks of collection windows into one file per symbol and window.

    Symbols count in upper case.  Ticks without a symbol or a time are not
    collected; ties within a second go to the smaller ``tiebreak``.

    * ``weekend_symbols``: with a list, only these are collected on local
      Saturdays and Sundays (F3); ``None`` collects all.
    * ``instruments``: folder of the instrument list, read anew in every
      micro-batch; unknown symbols and those of trade mode 0 yield nothing (F4).
    * ``symbols``: the configured symbols; others yield nothing.
    * ``since``: local time of the job's start; windows begun by then yield
      nothing (F9).  With ``symbols``, windows without ticks are reported.
    * ``grace``: how long a window can be published again.
    * ``lag``: how far the stream's time must be past a window to report it empty.
    """

    def __init__(self, spark: SparkSession, root: str, cap: int = K.MAX_TICKS_PER_WINDOW, windows=K.COLLECTION_WINDOWS,
                 zone: str = K.LOCAL_ZONE, tiebreak: str = "event_id", prefix: str = K.RAW_PREFIX,
                 symbols: DataFrame | None = None, instruments: str | None = None, weekend_symbols=None,
                 since: _dt.datetime | None = None, grace: _dt.timedelta = _dt.timedelta(days=1),
                 lag: _dt.timedelta = _dt.timedelta(minutes=1)):
        self.spark, self.root, self.cap, self.prefix = spark, root.rstrip("/"), cap, prefix
        self.windows, self.zone, self.tiebreak = tuple(map(tuple, windows)), zone, tiebreak
        self.symbols = None if symbols is None else symbols.select(F.upper("symbol").alias("symbol")).distinct()
        self.instruments, self.weekend_symbols, self.since = instruments, weekend_symbols, since
        self.grace, self.lag = grace, lag
        self.checkpoint = None

    @classmethod
    def from_config(cls, spark: SparkSession, root: str, config: str, **kwargs) -> Collector:
        """A collector of the symbols and prefix of a config file.

        With ``instruments``, configured symbols that the list does not hold
        at the start are left out, open or not (F5).
        """
        rows = S.config_scan(spark, config)
        prefix, symbols = rows.select("s3_prefix").first()[0], rows.select("symbol")
        if kwargs.get("instruments"):
            status = TK.validate_symbols(symbols, instrument_list(spark, kwargs["instruments"]))
            symbols = checkpointed(status.where("status = 'valid'").select("symbol"))
        return cls(spark, root, symbols=symbols, prefix=prefix, **kwargs)

    # ------------------------------------------------------------ the plan --

    def guarded(self, ticks: DataFrame) -> DataFrame:
        """symbol, win_ms, at_us, tie, Bid, Ask: win_ms is null where a tick is not to be collected."""
        t = ticks.where("symbol is not null and DateTime is not null").withColumn("symbol", F.upper("symbol"))
        if self.symbols is not None:
            t = t.join(F.broadcast(self.symbols), "symbol", "left_semi")  # one config file's list
        if self.instruments is not None:
            listed = instrument_list(self.spark, self.instruments).where("trade_mode <> 0").select("symbol").distinct()
            t = t.join(F.broadcast(listed), "symbol", "left_semi")  # the list bounds its own length
        t = TK.tag_windows(t, "DateTime", self.windows, self.zone)
        start = C.window_start_ts("local_date", "win_start_min")
        take = F.col("win_start_min").isNotNull() & C.flag_change("flags")
        if self.weekend_symbols is not None:
            take &= (F.weekday("local_date") < 5) | C.is_crypto("symbol", self.weekend_symbols)
        if self.since is not None:
            take &= start > F.lit(self.since.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
        return t.select(
            "symbol", F.when(F.coalesce(take, F.lit(False)), C.epoch_ms(C.to_utc(start, self.zone))).alias("win_ms"),
            F.timestamp_diff("MICROSECOND", C.epoch_ntz(), F.col("DateTime")).alias("at_us"),
            F.col(self.tiebreak).cast("bigint").alias("tie"), F.col("Bid").cast("double").alias("Bid"),
            F.col("Ask").cast("double").alias("Ask"))

    def plan(self, stream: DataFrame) -> DataFrame:
        """The stream of published ticks, reports and late ticks (``windows.OUTPUT``)."""
        calendar = WS.Calendar(self.windows, self.zone)
        ms = _dt.timedelta(milliseconds=1)
        processor = WS.WindowProcessor(self.cap, calendar, self.grace // ms, self.lag // ms,
                                       frozenset(s.upper() for s in self.weekend_symbols or ()))
        # The common time only drives the reports' timers.  It is dropped from the rows, so none is late by it.
        timed = stream.withColumn("_clock", C.utc_instant("DateTime")).withWatermark("_clock", "0 seconds")
        rows = self.guarded(timed)
        rows = rows.mapInPandas(WS.reduce_batches, rows.schema)
        first = None
        if self.symbols is not None and self.since is not None:
            since = F.lit(WS.ms_of(self._utc(self.since)) + 1).cast("bigint")  # windows that start later
            first = self.symbols.select("symbol", since.alias("since_ms")).groupBy("symbol")
        return rows.groupBy("symbol").transformWithStateInPandas(
            processor, WS.OUTPUT, "Append", "EventTime", initialState=first)

    def _utc(self, local: _dt.datetime) -> _dt.datetime:
        from zoneinfo import ZoneInfo
        return local.replace(tzinfo=ZoneInfo(self.zone))

    # ------------------------------------------------------------- running --

    def run(self, stream: DataFrame, checkpoint: str, trigger: str | None = None):
        """Collect a tick stream; ``trigger`` as in ``run_to_parquet``."""
        self.checkpoint = checkpoint
        with _conf(self.spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
            return run_batches(self.plan(stream), self._each, checkpoint, trigger)

    def _each(self, batch: DataFrame, epoch: int) -> None:
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write(rows, str(epoch))
        finally:
            rows.unpersist()

    def _write(self, rows: DataFrame, epoch: str) -> None:
        N.write_named_csv(self._ticks(rows.where("kind = 'tick'")), self.root, self.prefix, job=f"epoch-{epoch}", tiebreak="tie")
        rows.where("kind = 'late'").select("symbol", "win_ms", "at_us", "tie", "Bid", "Ask") \
            .write.mode("overwrite").parquet(f"{self.root}/_late/epoch={epoch}")
        # last, so that a report says its file is there
        rows.where("kind = 'window'").select("symbol", "win_ms", "n", "before", "status") \
            .write.mode("overwrite").parquet(f"{self.root}/_windows/epoch={epoch}")

    def _window_key(self):
        local = C.to_local(C.ms_to_ts("win_ms"), self.zone)
        return C.window_key(F.to_date(local), C.minute_of_day(local))

    def _ticks(self, rows: DataFrame) -> DataFrame:
        return rows.select("symbol", self._window_key().alias("window_key"),
                           F.timestamp_add("MICROSECOND", F.col("at_us"), C.epoch_ntz()).alias("DateTime"), "Bid", "Ask", "tie")

    def flush(self, checkpoint: str | None = None) -> None:
        """Publish the windows still open, at shutdown (R6); any number of times.

        They are read from the state that the last finished micro-batch left
        in the checkpoint (by default that of ``run``).  A resumed stream
        publishes such a window again once it has passed.
        """
        checkpoint = checkpoint or self.checkpoint
        if checkpoint is None:
            raise ValueError("flush needs the checkpoint of a run")
        if not hadoop_exists(self.spark, f"{checkpoint}/state"):
            return
        state = self.spark.read.format("statestore").option("stateVarName", "windows").load(checkpoint)
        open_ = state.select(F.col("key.symbol").alias("symbol"), F.col("user_map_key.win_ms").alias("win_ms"),
                             F.col("user_map_value.rows").alias("rows"), F.col("user_map_value.sent").alias("sent")) \
            .where("sent is null and length(rows) > 0")

        def open_up(batches):
            for pdf in batches:
                for symbol, win, blob in zip(pdf["symbol"], pdf["win_ms"], pdf["rows"]):
                    ticks = WS.unpacked(blob)
                    yield WS.tick_frame(symbol, win, "tick", ticks)
                    yield WS.report_frame(symbol, win, len(ticks), None, "open")

        self._each(open_.mapInPandas(open_up, WS.OUTPUT), "flush")

    # ------------------------------------------------------------- reading --

    def read(self) -> DataFrame:
        """symbol, window_key, DateTime (text), Bid, Ask of all published files."""
        rows = self.spark.read.schema(S.TICK_CSV_SCHEMA).option("header", "true").option("recursiveFileLookup", "true") \
            .csv(f"{self.root}/{self.prefix}")
        name = F.regexp_extract(C.normalize_path(F.col("_metadata.file_path")), r"/([^/]+)_(\d{8}_\d{4})\.csv$", 1)
        key = F.regexp_extract(C.normalize_path(F.col("_metadata.file_path")), r"/([^/]+)_(\d{8}_\d{4})\.csv$", 2)
        return rows.select(name.alias("symbol"), key.alias("window_key"), "DateTime", "Bid", "Ask")

    def reports(self) -> DataFrame:
        """symbol, win_ms, n, before, status, epoch of every report of a window."""
        return self.spark.read.schema(REPORT + ", epoch string").parquet(f"{self.root}/_windows")

    def coverage(self) -> DataFrame:
        """symbol, window_key, n_ticks, status of every window reported, as of its last report (A10).

        A window flushed at shutdown counts as flushed until the stream publishes it.
        """
        order = F.coalesce(F.expr("try_cast(epoch as bigint)"), F.lit(-1))
        # an empty report never overrides ticks: its timer may fire in the same epoch
        last = self.reports().groupBy("symbol", "win_ms").agg(
            F.max(F.struct(F.col("n") > 0, order, "n", "status")).alias("r"))
        return last.select("symbol", self._window_key().alias("window_key"), F.col("r.n").alias("n_ticks"),
                           F.when(F.col("r.n") > 0, F.lit("ok")).otherwise(F.col("r.status")).alias("status"))

    def tallies(self) -> DataFrame:
        """One row: total_ticks and total_files that lie in the sink, over all epochs and restarts.

        A window published again counts for the ticks it gained.
        """
        done = self.reports().where("epoch <> 'flush' and n > 0")
        flushed = self.reports().where("epoch = 'flush'").join(done.select("symbol", "win_ms").distinct(),
                                                               ["symbol", "win_ms"], "left_anti")
        every = done.unionByName(flushed)
        return every.agg(F.coalesce(F.sum(F.col("n") - F.coalesce("before", F.lit(0))), F.lit(0)).alias("total_ticks"),
                         F.count_if(F.col("before").isNull()).alias("total_files"))

    def late(self) -> DataFrame:
        """Ticks that came after their window's grace: symbol, window_key, DateTime, Bid, Ask, tie."""
        return self._ticks(self.spark.read.schema(LATE).parquet(f"{self.root}/_late"))
