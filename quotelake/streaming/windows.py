"""Collection windows as state of a stream, kept per symbol.

A ``StatefulProcessor`` keyed by symbol holds the windows a symbol has ticks
in: per window at most ``cap`` ticks, the first of each second.  A window is
published when its own symbol's ticks pass its end, so a slow symbol holds up
only itself; a tick that comes later publishes the window again, from state.
``grace`` after its end (by the symbol's own time) a window leaves the state;
ticks that still come for it are handed out as ``late``, not lost.

Timers run on the stream's common event time and only report: a window whose
end that time has passed while its symbol brought nothing is reported with no
ticks, ``expected_empty`` on weekends for symbols not traded then, else
``missing``.  They fire for symbols without any rows too, since the configured
symbols are the operator's initial state.

State lies in RocksDB and is read and written per window, so a micro-batch
touches only the windows its rows fall into.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from dataclasses import dataclass
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = ("symbol string, win_ms bigint, kind string, at_us bigint, tie bigint, Bid double, Ask double, "
          "n bigint, before bigint, status string")
COLUMNS = [c.split(" ")[0] for c in OUTPUT.split(", ")]
WINDOW_STATE = "rows binary, sent long"
MARK_STATE = "latest long, due long"

_TICK = np.dtype([("at", "<i8"), ("tie", "<i8"), ("bid", "<f8"), ("ask", "<f8")])
_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)


def ms_of(t: _dt.datetime) -> int:
    return (t - _EPOCH) // _dt.timedelta(milliseconds=1)


@dataclass(frozen=True)
class Calendar:
    """The local windows of every day, as UTC milliseconds; a window belongs to the date it starts on."""

    windows: tuple
    zone: str

    def after(self, ms: int) -> Iterator[tuple[int, int, int]]:
        """(start, end, weekday) of all windows that start at ``ms`` or later, in order, without end."""
        zone = ZoneInfo(self.zone)
        day = (_EPOCH + _dt.timedelta(milliseconds=ms)).astimezone(zone).date()
        while True:
            midnight = _dt.datetime(day.year, day.month, day.day, tzinfo=zone)
            for sh, sm, eh, em in sorted(self.windows):
                start = ms_of(midnight + _dt.timedelta(hours=sh, minutes=sm))  # by the local clock
                if start >= ms:
                    yield start, ms_of(midnight + _dt.timedelta(hours=eh, minutes=em)), day.weekday()
            day += _dt.timedelta(days=1)

    def ends(self, start: int) -> tuple[int, int]:
        """End and weekday of the window that starts here."""
        _, end, weekday = next(self.after(start))
        return end, weekday


def packed(pdf: pd.DataFrame) -> np.ndarray:
    out = np.empty(len(pdf), _TICK)
    for name, col in (("at", "at_us"), ("tie", "tie"), ("bid", "Bid"), ("ask", "Ask")):
        out[name] = pdf[col].to_numpy()
    return out


def firsts(ticks: np.ndarray, cap: int) -> np.ndarray:
    """The first tick of each second, by time then tie; the first ``cap`` of these.

    Ticks beyond the cap can't come back: more ticks only push others out.
    """
    ticks = ticks[np.lexsort((ticks["tie"], ticks["at"]))]
    second = ticks["at"] // 1_000_000
    return ticks[np.concatenate([[True], second[1:] != second[:-1]])[:len(ticks)]][:cap]


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, _TICK)


def tick_frame(symbol: str, win_ms: int, kind: str, ticks: np.ndarray) -> pd.DataFrame:
    out = pd.DataFrame({"at_us": ticks["at"], "tie": ticks["tie"], "Bid": ticks["bid"], "Ask": ticks["ask"]})
    out.insert(0, "kind", kind)
    out.insert(0, "win_ms", win_ms)
    out.insert(0, "symbol", symbol)
    for name in ("n", "before", "status"):
        out[name] = None
    return out[COLUMNS]


def report_frame(symbol: str, win_ms: int, n: int, before, status: str) -> pd.DataFrame:
    row = {c: None for c in COLUMNS} | {"symbol": symbol, "win_ms": win_ms, "kind": "window", "n": n,
                                        "before": before, "status": status}
    return pd.DataFrame([row], columns=COLUMNS)


class WindowProcessor(StatefulProcessor):
    """Rows ``symbol, win_ms, at_us, tie, Bid, Ask`` (win_ms null: only the time counts) → ``OUTPUT``."""

    def __init__(self, cap: int, calendar: Calendar, grace_ms: int, lag_ms: int, weekend_symbols: frozenset):
        self.cap, self.calendar, self.grace, self.lag = cap, calendar, grace_ms, lag_ms
        self.weekend_symbols = weekend_symbols

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "win_ms long", WINDOW_STATE)
        self.mark = handle.getValueState("mark", MARK_STATE)

    def _mark(self) -> tuple[int, int]:
        """Latest time of the symbol (us), and the start of the next window to report (ms; -1: reports are off)."""
        return self.mark.get() if self.mark.exists() else (-1, -1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        symbol = key[0]
        latest, due = self._mark()
        closed = latest // 1000 - self.grace  # windows that ended by then have left the state
        touched: dict[int, np.ndarray] = {}
        for pdf in rows:
            latest = max(latest, int(pdf["at_us"].max()))
            for win, part in pdf[pdf["win_ms"].notna()].groupby("win_ms"):
                win, ticks = int(win), packed(part)
                if self.calendar.ends(win)[0] <= closed:
                    yield tick_frame(symbol, win, "late", ticks)
                    continue
                if win in touched:
                    ticks = np.concatenate([touched[win], ticks])
                touched[win] = firsts(ticks, self.cap)
        self.mark.update((latest, due))

        for win, ticks in touched.items():
            blob, sent = self.windows.getValue((win,)) if self.windows.containsKey((win,)) else (b"", None)
            merged = firsts(np.concatenate([unpacked(blob), ticks]), self.cap)
            changed = merged.tobytes() != bytes(blob)
            touched[win] = merged
            if changed:
                self.windows.updateValue((win,), (merged.tobytes(), sent))
            elif sent is not None:
                touched[win] = None  # published like this already
        yield from self._publish(symbol, latest // 1000, due, touched)

    def _publish(self, symbol: str, now: int, due: int, touched: dict) -> Iterator[pd.DataFrame]:
        """Publish what the symbol has passed and what changed since, and let go of what is past its grace."""
        for (win,), (blob, sent) in list(self.windows.iterator()):
            end = self.calendar.ends(win)[0]
            if end > now:
                continue
            fresh = sent is None or touched.get(win) is not None
            ticks = unpacked(blob)
            if fresh and len(ticks):
                yield tick_frame(symbol, win, "tick", ticks)
                yield report_frame(symbol, win, len(ticks), sent, "ok")
                sent = len(ticks)
            if end + self.grace > now:
                if fresh:
                    self.windows.updateValue((win,), (blob, sent))
            elif 0 <= due <= win:
                self.windows.updateValue((win,), (b"", sent))  # only so that the timer knows it had ticks
            else:
                self.windows.removeKey((win,))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        start, end, _ = next(self.calendar.after(int(initialState["since_ms"].iloc[0])))
        self.mark.update((-1, start))
        self.handle.registerTimer(end + self.lag)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        latest, due = self._mark()
        clock = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        for start, end, weekday in self.calendar.after(due):
            if end + self.lag > clock:
                self.mark.update((latest, start))
                self.handle.registerTimer(end + self.lag)
                return
            if self.windows.containsKey((start,)):
                if not self.windows.getValue((start,))[0]:
                    self.windows.removeKey((start,))
            else:
                yield report_frame(key[0], start, 0, None, empty_status(key[0], weekday, self.weekend_symbols))


def empty_status(symbol: str, weekday: int, weekend_symbols) -> str:
    return "expected_empty" if weekday >= 5 and symbol not in weekend_symbols else "missing"


def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Before the shuffle: of each Arrow batch, the first tick per symbol and second, and each symbol's last time."""
    for pdf in batches:
        if not len(pdf):
            continue
        ticks = pdf[pdf["win_ms"].notna()].sort_values(["at_us", "tie"], kind="stable")
        ticks = ticks[~ticks.assign(second=ticks["at_us"] // 1_000_000).duplicated(["symbol", "second"])]
        last = pdf.groupby("symbol", as_index=False)["at_us"].max()
        yield pd.concat([ticks, last.reindex(columns=pdf.columns)], ignore_index=True)[list(pdf.columns)] \
            .astype({"win_ms": "Int64", "tie": "Int64"})
