"""Ticks as a stream of polls: per symbol what came after its cursor, at most so many rows.

The landing holds Parquet files below ``symbol=…`` folders, each symbol's ticks
landing in order of time.  The offset maps every symbol to the (time_msc, tie)
it has come to, so a busy symbol never holds up a quiet one, ticks of one
millisecond may fall into different polls, and nothing is taken twice.  Spark
keeps the offsets in the query's checkpoint.

A micro-batch takes up to ``polls`` polls of each symbol, one after the other
and each with its own bound, so that a long backlog does not cost a micro-batch
for every ``max_rows`` ticks.  The column ``poll`` is the poll's number in its
micro-batch, from 0.

Planning a micro-batch reads footers and, of each symbol, the two cursor
columns of the row groups that hold its next ``polls * max_rows`` ticks.  Tasks,
one for ``TASK_POLLS`` polls of a symbol, read the rows.  Like the terminal it stands for, a poll never goes back: a tick
that lands behind its symbol's cursor is not taken.  Rows without a time are
not taken.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .. import constants as K
from .storage import open_store

FORMAT = "tick_polls"
SCHEMA = "event_id bigint, symbol string, DateTime timestamp_ntz, time_msc bigint, flags int, Bid double, Ask double, poll int"
_ARROW = pa.schema([("event_id", pa.int64()), ("symbol", pa.string()), ("DateTime", pa.timestamp("us")), ("time_msc", pa.int64()),
                    ("flags", pa.int32()), ("Bid", pa.float64()), ("Ask", pa.float64()), ("poll", pa.int32())])
#: Symbols whose next ticks are looked up at the same time.
LOOKUPS = 16
#: Polls of a symbol that one task reads.
TASK_POLLS = 16


class TickPolls(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        o = self.options
        return PollReader(o["path"], int(o.get("max_rows", K.MAX_TICKS_PER_POLL)), int(o.get("from_ms", -1)), int(o.get("polls", 1)))


class Span(InputPartition):
    """A symbol's ticks after ``lo`` up to the last of ``ends``, where polls end; the first is poll ``poll``."""

    def __init__(self, symbol: str, lo: tuple, ends: list[tuple], poll: int):
        self.symbol, self.lo, self.ends, self.poll = symbol, lo, ends, poll


def _after(lo: tuple):
    ms, tie = ds.field("time_msc"), ds.field("event_id")
    return (ms > lo[0]) | ((ms == lo[0]) & (tie > lo[1]))


def _upto(hi: tuple):
    ms, tie = ds.field("time_msc"), ds.field("event_id")
    return (ms < hi[0]) | ((ms == hi[0]) & (tie <= hi[1]))


def _rank(end: tuple) -> tuple:
    """An order of cursors in which a missing tie comes last."""
    return end[0], end[1] is None, end[1] or 0


class PollReader(DataSourceStreamReader):
    def __init__(self, root: str, max_rows: int, from_ms: int, polls: int = 1):
        self.root, self.max_rows, self.from_ms, self.polls, self.at = root, max_rows, from_ms, polls, None
        self.planned: dict[str, tuple[tuple, list[tuple]]] = {}  # by symbol: the cursor at the start, where polls end

    def initialOffset(self) -> dict:
        return {}

    def _start(self, offset: dict, symbol: str) -> tuple:
        at = offset.get(symbol)
        return (at["ms"], at["tie"]) if at else (self.from_ms, -(1 << 63))

    def _symbols(self) -> list[str]:
        store, root = open_store(self.root)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(f.base_name[len("symbol="):] for f in found if f.base_name.startswith("symbol="))

    def _files(self, symbol: str) -> ds.Dataset:
        """``symbol`` as its folder spells it (percent-encoded), here and in the offsets."""
        store, root = open_store(self.root)
        return ds.dataset(f"{root}/symbol={symbol}", filesystem=store, format="parquet")

    def _cut(self, near: pa.Table) -> tuple[list[tuple], int, bool]:
        """Where the next polls of sorted ticks end, the rows they take, and whether all of them are full."""
        ms, tie = near["time_msc"].to_numpy(), near["event_id"]
        ends, row, used, full = [], 0, 0, False
        while row < len(ms) and len(ends) < self.polls:
            used = min(row + self.max_rows, len(ms))
            full = used - row == self.max_rows
            ends.append((int(ms[used - 1]), tie[used - 1].as_py()))
            row = used
            while row < len(ms) and (int(ms[row]), tie[row].as_py()) == ends[-1]:  # repeats of its last tick go with a poll
                row += 1
        return ends, used, full and len(ends) == self.polls

    def _next(self, symbol: str, lo: tuple) -> list[tuple]:
        """The cursors after each of the next ``polls`` polls of a symbol (none if there are no ticks)."""
        groups = []
        for file in self._files(symbol).get_fragments():
            file.ensure_complete_metadata()
            for group in file.row_groups:
                seen = (group.statistics or {}).get("time_msc")
                if seen is None or seen["max"] >= lo[0]:
                    groups.append((seen["min"] if seen else -1, file, group.id))
        groups.sort(key=lambda g: g[0])
        order = [("time_msc", "ascending"), ("event_id", "ascending")]
        near = pa.table({"time_msc": pa.array([], pa.int64()), "event_id": pa.array([], pa.int64())})
        last = None  # the time of the last poll's end, if all polls are full
        for first, file, group in groups:
            if last is not None and first > last:
                break
            more = file.subset(row_group_ids=[group]).to_table(columns=["time_msc", "event_id"], filter=_after(lo))
            near = pa.concat_tables([near, more])
            if near.num_rows >= self.max_rows * self.polls:
                near = near.sort_by(order)
                ends, used, full = self._cut(near)
                if full:
                    near, last = near[:used], ends[-1][0]
        return self._cut(near.sort_by(order))[0]

    def latestOffset(self) -> dict:
        at = self.at if self.at is not None else self.initialOffset()
        symbols = self._symbols()
        starts = [self._start(at, s) for s in symbols]
        with ThreadPoolExecutor(LOOKUPS) as pool:
            found = list(pool.map(self._next, symbols, starts))
        self.planned = {s: (lo, ends) for s, lo, ends in zip(symbols, starts, found) if ends}
        return at | {s: {"ms": ends[-1][0], "tie": ends[-1][1]} for s, (_, ends) in self.planned.items()}

    def _ends(self, symbol: str, lo: tuple, hi: tuple) -> list[tuple]:
        """Where the polls from ``lo`` to ``hi`` end: as planned, or found again (after a restart)."""
        start, ends = self.planned.get(symbol, (None, []))
        if start == lo and ends[-1] == hi:
            return ends
        if self.polls == 1:
            return [hi]
        ends, at = [], lo
        while True:
            more = self._next(symbol, at)
            inner = [e for e in more if _rank(e) < _rank(hi)]
            ends += inner
            if not more or len(inner) < len(more):
                return [*ends, hi]
            at = more[-1]

    def partitions(self, start: dict, end: dict) -> list[Span]:
        self.at = end  # after a restart Spark names the offset it had come to by an empty range
        spans = []
        for s in sorted(end):
            lo, hi = self._start(start, s), self._start(end, s)
            if lo == hi:
                continue
            ends = self._ends(s, lo, hi)
            for k in range(0, len(ends), TASK_POLLS):
                spans.append(Span(s, ends[k - 1] if k else lo, ends[k: k + TASK_POLLS], k))
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        starts = [partition.lo, *partition.ends[:-1]]
        rows = self._files(partition.symbol).scanner(
            columns=[n for n in _ARROW.names if n not in ("symbol", "poll")],
            filter=_after(partition.lo) & _upto(partition.ends[-1]))
        for batch in rows.to_batches():
            if not batch.num_rows:
                continue
            reach = pc.min_max(batch.column("time_msc"))
            for k, (lo, hi) in enumerate(zip(starts, partition.ends)):
                if lo[0] > reach["max"].as_py() or hi[0] < reach["min"].as_py():
                    continue
                part = batch.filter(_after(lo) & _upto(hi)) if len(starts) > 1 else batch
                if part.num_rows:
                    same = {"symbol": unquote(partition.symbol), "poll": partition.poll + k}
                    cols = [pa.array([same[f.name]] * part.num_rows, f.type) if f.name in same
                            else pc.cast(part.column(f.name), f.type, safe=False) for f in _ARROW]
                    yield pa.RecordBatch.from_arrays(cols, schema=_ARROW)


def tick_polls(spark: SparkSession, landing: str, max_rows: int = K.MAX_TICKS_PER_POLL, live: bool = False,
               polls: int = 1) -> DataFrame:
    """Stream of polls of the ticks landed below ``landing/symbol=…``.

    With ``live`` a new query starts a moment before now, as a terminal's
    first poll does; otherwise at the earliest tick.  A micro-batch takes up
    to ``polls`` polls, numbered in its column ``poll``.
    """
    spark.dataSource.register(TickPolls)
    start = int(time.time() * 1000) - K.FIRST_POLL_LOOKBACK_MS if live else -1
    return spark.readStream.format(FORMAT).option("max_rows", max_rows).option("from_ms", start) \
        .option("polls", polls).load(landing)
