"""The streaming collector: windows as state per symbol, guards, reports, tallies, restarts."""

import collections
import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest

from quotelake.session import local_path
from quotelake.sources import files as S
from quotelake.streaming import ticks as R
from quotelake.streaming import windows as WS
from quotelake.streaming.collector import Collector

BASE = dt.datetime(2024, 1, 2, 5, 50, 0)                      # a Tuesday, 07:50 local


def tick(i, symbol, at, flags=6, bid=1.0):
    return (i, symbol, at, 0, flags, bid, bid + 0.1)


def ticks(n=400):
    return [tick(i, "A" if i % 2 else "B", BASE + dt.timedelta(milliseconds=250 * i + (i % 3)), bid=1.0 + i / 1000)
            for i in range(n)]


class Feed:
    """A landing folder and a collector on it; every call lands one file and drains the stream."""

    def __init__(self, spark, scratch, **kwargs):
        self.spark, self.land, self.ck, self.kwargs = spark, scratch("landing"), scratch("ck"), kwargs
        self.root, self.every = scratch("root"), []

    def collector(self) -> Collector:
        kwargs = dict(self.kwargs)
        if "config" in kwargs:
            return Collector.from_config(self.spark, self.root, kwargs.pop("config"), **kwargs)
        return Collector(self.spark, self.root, **kwargs)

    def __call__(self, *files) -> Collector:
        for rows in files:
            self.every += rows
            if rows:
                self.spark.createDataFrame(rows, R.TICK_STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(self.land)
        c = self.collector()                                  # a new one each time: nothing is kept outside the checkpoint
        c.run(R.tick_stream(self.spark, self.land, max_files_per_trigger=1), self.ck)
        return c


def published(c):
    return sorted(tuple(r) for r in c.read().select("symbol", "window_key", "DateTime", "Bid").collect())


def expected(rows, window_key, cap=600):
    """First changed tick of each second by (time, id), the first ``cap`` of a symbol, as the files hold them."""
    first = {}
    for r in sorted((r for r in rows if r[1] and r[2] and r[4] & 6), key=lambda r: (r[2], r[0])):
        first.setdefault((r[1].upper(), r[2].replace(microsecond=0)), r)
    out = collections.defaultdict(list)
    for (symbol, _), r in first.items():
        out[symbol].append((symbol, window_key, r[2].strftime("%Y-%m-%d %H:%M:%S.") + f"{r[2].microsecond // 1000:03d}", r[5]))
    return sorted(sum((v[:cap] for v in out.values()), []))


def tally(c):
    return tuple(c.tallies().first())


def in_sink(spark, c):
    return c.read().count(), S.list_files(spark, f"{c.root}/{c.prefix}", "*.csv").count()


def test_slow_symbol_late_ticks_cap_and_flush(spark, scratch):
    feed = Feed(spark, scratch, cap=30, windows=((7, 45, 8, 15), (13, 50, 14, 0)))
    end = [tick(5000, "A", BASE + dt.timedelta(hours=7))]                              # A passes all windows
    c = feed([r for r in ticks(200) if r[1] == "A"])
    c = feed(end)
    c = feed([r for r in ticks(200) if r[1] == "B"])
    c = feed([tick(6000, "A", BASE - dt.timedelta(seconds=1), bid=9.0),                # late, in a published window
              tick(6001, "A", BASE, flags=1), tick(6002, None, BASE), tick(6003, "A", None)])
    assert {r[:2] for r in published(c)} == {("A", "20240102_0745")}                   # B has not passed its window
    c.flush()
    c.flush()
    c = feed()                                                                         # resumed, nothing new
    want = expected([r for r in feed.every if r[0] != 5000], "20240102_0745", 30)
    assert published(c) == want and c.late().count() == 0
    assert tally(c) == (len(want), 2) == in_sink(spark, c)
    assert {tuple(r) for r in c.coverage().collect()} == {("A", "20240102_0745", 30, "ok"), ("B", "20240102_0745", 30, "ok")}


def test_symbols_in_mixed_case_are_one(spark, scratch):
    """A published window keeps its ticks when more come under another spelling."""
    feed = Feed(spark, scratch)
    feed([tick(i, "A", BASE + dt.timedelta(seconds=i)) for i in range(50)] + [tick(99, "A", BASE + dt.timedelta(hours=1))])
    c = feed([tick(200 + i, "a", BASE + dt.timedelta(seconds=100 + i)) for i in range(3)])
    assert published(c) == expected([r for r in feed.every if r[0] != 99], "20240102_0750")
    assert len(published(c)) == 53 and tally(c) == (53, 1)


def test_ticks_after_the_grace_are_set_aside(spark, scratch):
    feed = Feed(spark, scratch, grace=dt.timedelta(hours=2))
    feed(ticks(40) + [tick(900, s, BASE + dt.timedelta(days=1)) for s in "AB"])
    c = feed([tick(901, "A", BASE + dt.timedelta(seconds=500), bid=7.0), tick(902, "A", BASE + dt.timedelta(days=1, hours=1))])
    assert [(r.symbol, r.window_key, r.Bid, r.tie) for r in c.late().collect()] == [("A", "20240102_0750", 7.0, 901)]
    want = expected(ticks(40), "20240102_0750") + [("A", "20240103_0750", "2024-01-03 05:50:00.000", 1.0)]
    assert published(c) == sorted(want) and tally(c) == (len(want), 3)


def test_replayed_epoch_changes_nothing(spark, scratch):
    feed = Feed(spark, scratch)
    feed(ticks(100))
    c = feed([tick(9000, s, BASE + dt.timedelta(hours=1)) for s in "AB"])
    once, reports = published(c), sorted(map(str, c.reports().collect()))
    commits = os.path.join(local_path(feed.ck), "commits")
    for name in sorted((n for n in os.listdir(commits) if n.isdigit()), key=int)[-2:]:  # as if it had died before it was done
        os.remove(os.path.join(commits, name))
        os.remove(os.path.join(commits, f".{name}.crc"))
    c = feed()
    assert published(c) == once and len(once) == len(expected(ticks(100), "x"))
    assert sorted(map(str, c.reports().collect())) == reports
    assert tally(c) == in_sink(spark, c)


def _config(scratch, symbols):
    path = os.path.join(local_path(scratch("config")), "symbols.json")
    os.makedirs(os.path.dirname(path))
    with open(path, "w") as f:
        f.write('{"symbols": [%s], "settings": {"s3_prefix": "landing zone"}}' % ", ".join(f'"{s}"' for s in symbols))
    return path


def _instruments(spark, path, modes):
    spark.createDataFrame(list(modes.items()), "symbol string, trade_mode int").coalesce(1).write.mode("overwrite").parquet(path)


def test_guards_and_empty_windows(spark, scratch):
    """Saturday, closed, unknown, not configured and begun windows yield nothing; empty windows are reported."""
    listed = scratch("instruments")
    _instruments(spark, listed, {"eurusd": 4, "BTCUSD": 4, "CLOSED": 0, "OTHER": 4})
    feed = Feed(spark, scratch, config=_config(scratch, ["EURUSD", "btcusd", "CLOSED", "UNKNOWN"]), instruments=listed,
                weekend_symbols=["BTCUSD"], since=dt.datetime(2024, 1, 5, 7, 55))       # a Friday, inside a window
    friday, saturday = dt.datetime(2024, 1, 5, 5, 50), dt.datetime(2024, 1, 6, 5, 50)
    names = ["EURUSD", "BTCUSD", "CLOSED", "UNKNOWN", "OTHER"]
    rows = [tick(100 * k + i, s, day + dt.timedelta(hours=h, seconds=i)) for k, s in enumerate(names) for i in range(3)
            for day, h in ((friday, 0), (friday, 6), (saturday, 0))]
    c = feed(rows, [tick(9000, "BTCUSD", saturday + dt.timedelta(hours=8))])
    assert c.prefix == "landing zone"
    c.flush()
    got = collections.Counter(r[:2] for r in published(c))
    assert got == {("EURUSD", "20240105_1350"): 3, ("BTCUSD", "20240105_1350"): 3, ("BTCUSD", "20240106_0750"): 3}
    cover = {(r.symbol, r.window_key): (r.n_ticks, r.status) for r in c.coverage().collect()}
    assert cover == {
        ("EURUSD", "20240105_1350"): (3, "ok"), ("EURUSD", "20240106_0750"): (0, "expected_empty"),
        ("EURUSD", "20240106_1350"): (0, "expected_empty"), ("BTCUSD", "20240105_1350"): (3, "ok"),
        ("BTCUSD", "20240106_0750"): (3, "ok"), ("BTCUSD", "20240106_1350"): (0, "missing"),
        ("CLOSED", "20240105_1350"): (0, "missing"), ("CLOSED", "20240106_0750"): (0, "expected_empty"),
        ("CLOSED", "20240106_1350"): (0, "expected_empty")}
    assert tally(c) == (9, 3) == in_sink(spark, c)


def test_instruments_are_read_anew_in_each_batch(spark, scratch):
    """A market that closes while the query runs yields nothing from the next batch on."""
    listed = scratch("instruments")
    _instruments(spark, listed, {"A": 4, "B": 4})

    class Closing(Collector):
        def _write(self, rows, epoch):
            super()._write(rows, epoch)
            if epoch == "0":
                _instruments(spark, listed, {"A": 4, "B": 0})

    land = scratch("landing")
    for k in range(2):                                        # two files, a micro-batch each
        spark.createDataFrame([tick(10 * k + i, s, BASE + dt.timedelta(seconds=10 * k + i)) for i in range(4) for s in "AB"],
                              R.TICK_STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(land)
    c = Closing(spark, scratch("root"), instruments=listed)
    c.run(R.tick_stream(spark, land, max_files_per_trigger=1), scratch("ck"))
    c.flush()
    assert collections.Counter(r[0] for r in published(c)) == {"A": 8, "B": 4}


def test_instrument_list_is_bounded(spark, scratch):
    from quotelake.sources.instruments import instruments
    listed = scratch("instruments")
    _instruments(spark, listed, {f"S{k}": 4 for k in range(20)})
    assert instruments(spark, listed).count() == 20
    with pytest.raises(Exception, match="more than 10 instruments"):
        instruments(spark, listed, max_rows=10).count()


def test_flush_before_any_run(spark, scratch):
    with pytest.raises(ValueError):
        Collector(spark, scratch("root")).flush()
    Collector(spark, scratch("root")).flush(scratch("ck"))    # nothing was collected: nothing to publish


# -------------------------------------------------------- without a stream --

def test_first_of_each_second_and_cap():
    rng = np.random.default_rng(1)
    t = np.empty(500, WS._TICK)
    t["at"], t["tie"], t["bid"], t["ask"] = rng.integers(0, 60_000_000, 500), np.arange(500), 1.0, 2.0
    t[400:]["at"] = t[:100]["at"]                             # equal times: the smaller tie stays
    best = {}
    for x in sorted(t.tolist()):
        best.setdefault(x[0] // 1_000_000, x)
    want = [best[k] for k in sorted(best)]
    for cap in (5, 1000):
        assert WS.firsts(t, cap).tolist() == want[:cap]
        halves = np.concatenate([WS.firsts(t[:250], cap), WS.firsts(t[250:], cap)])
        assert WS.firsts(halves, cap).tolist() == want[:cap]  # taken in pieces
    assert len(WS.firsts(t[:0], 5)) == 0


def test_batches_keep_firsts_and_the_last_time():
    pdf = pd.DataFrame({"symbol": ["A", "A", "A", "B"], "win_ms": [1000, 1000, None, None], "at_us": [5, 3, 9_000_000, 7],
                        "tie": [1, 2, 3, 4], "Bid": [1.0] * 4, "Ask": [2.0] * 4}).astype({"win_ms": "Int64"})
    out = pd.concat(WS.reduce_batches(iter([pdf, pdf[:0]])))
    kept = out[out["win_ms"].notna()]
    assert kept["tie"].tolist() == [2]
    assert out[out["win_ms"].isna()].set_index("symbol")["at_us"].to_dict() == {"A": 9_000_000, "B": 7}


def test_calendar_follows_the_local_clock():
    berlin = WS.Calendar(((1, 0, 1, 30), (23, 30, 24, 0)), "Europe/Berlin")
    at = WS.ms_of(dt.datetime(2024, 3, 30, 12, tzinfo=dt.timezone.utc))
    days = berlin.after(at)
    got = [next(days) for _ in range(4)]
    hours = [(dt.datetime.fromtimestamp(s / 1000, dt.timezone.utc).strftime("%d %H:%M"), (e - s) // 60_000, w) for s, e, w in got]
    assert hours == [("30 22:30", 30, 5), ("31 00:00", 30, 6), ("31 21:30", 30, 6), ("31 23:00", 30, 0)]
    assert berlin.ends(got[0][0]) == got[0][1:]
