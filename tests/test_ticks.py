import datetime as dt


from quotelake.operators import ticks as T
from quotelake.plans import flagship

SCHEMA = "event_id long, symbol string, DateTime timestamp_ntz, time_msc long, flags int, Bid double, Ask double"


def tick(i, sym, ts, flags=6, bid=1.0, ask=1.1):
    t = dt.datetime.fromisoformat(ts)
    ms = int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    return (i, sym, t, ms, flags, bid, ask)


def test_flag_filter(spark):
    df = spark.createDataFrame([tick(i, "A", "2024-01-01 00:00:00", flags=f) for i, f in enumerate(range(8))], SCHEMA)
    assert sorted(r.flags for r in T.flag_filter(df).collect()) == [2, 3, 4, 5, 6, 7]


def test_weekend_filter_local_day(spark):
    rows = [tick(1, "US30", "2026-03-06 22:30:00"),    # Saturday local → dropped
            tick(2, "US30", "2026-03-08 22:30:00"),    # Monday local → kept
            tick(3, "btcusd", "2026-03-06 22:30:00"),  # crypto, lower case → kept
            tick(4, "US30", "2026-03-06 21:59:00")]    # Friday 23:59 local → kept
    out = T.weekend_filter(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.event_id for r in out.collect()) == [2, 3, 4]


def test_cursor_is_strict_and_missing_cursor_keeps_all(spark):
    rows = [tick(1, "A", "2024-01-01 00:00:01"), tick(2, "A", "2024-01-01 00:00:02"),
            tick(3, "B", "2024-01-01 00:00:01")]
    df = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame([("A", rows[0][3])], "symbol string, cursor_ms long")
    assert sorted(r.event_id for r in T.cursor_filter(df, marks).collect()) == [2, 3]


def test_market_open_and_validation(spark):
    rows = [tick(1, "A", "2024-01-01 00:00:01"), tick(2, "B", "2024-01-01 00:00:01"),
            tick(3, "C", "2024-01-01 00:00:01")]
    df = spark.createDataFrame(rows, SCHEMA)
    inst = spark.createDataFrame([("A", 4), ("B", 0)], "symbol string, trade_mode int")
    assert [r.event_id for r in T.market_open(df, inst).collect()] == [1]
    v = {r.symbol: r.status for r in T.validate_symbols(df.select("symbol"), inst).collect()}
    assert v == {"A": "valid", "B": "valid", "C": "missing"}


def test_first_per_second_tiebreak(spark):
    rows = [tick(5, "A", "2024-01-01 00:00:01.500"), tick(4, "A", "2024-01-01 00:00:01.500"),
            tick(6, "A", "2024-01-01 00:00:01.900"), tick(7, "A", "2024-01-01 00:00:02.000"),
            tick(8, "B", "2024-01-01 00:00:01.999")]
    out = T.first_per_second(spark.createDataFrame(rows, SCHEMA), order=("DateTime", "event_id"))
    assert sorted(r.event_id for r in out.collect()) == [4, 7, 8]


def test_window_edges_and_cap(spark):
    # 07:50:00.000 local is in, 08:00:00.000 local is out (UTC+2).
    rows = [tick(1, "A", "2024-01-02 05:50:00.000"), tick(2, "A", "2024-01-02 05:59:59.999"),
            tick(3, "A", "2024-01-02 06:00:00.000"), tick(4, "A", "2024-01-02 05:55:00.000")]
    tagged = T.in_windows(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.event_id for r in tagged.collect()) == [1, 2, 4]
    capped = T.cap_per_window(tagged, cap=2, order=("DateTime", "event_id"))
    assert sorted(r.event_id for r in capped.collect()) == [1, 4]


def test_skip_started_windows(spark):
    rows = [tick(1, "A", "2024-01-15 05:55:00"), tick(2, "A", "2024-01-15 11:55:00")]
    tagged = T.in_windows(spark.createDataFrame(rows, SCHEMA))
    out = T.skip_started_windows(tagged, dt.datetime(2024, 1, 15, 7, 55))
    assert [r.event_id for r in out.collect()] == [2]


def test_window_coverage_statuses(spark):
    # Sat 2024-01-06 and Fri 2024-01-05; crypto X has ticks on Saturday.
    rows = [tick(1, "X", "2024-01-06 05:55:00"), tick(2, "US30", "2024-01-05 05:55:00")]
    cov = T.window_coverage(T.tag_windows(spark.createDataFrame(rows, SCHEMA)), crypto=["X"])
    got = {(r.symbol, r.window_key): (r.n_ticks, r.status) for r in cov.collect()}
    assert got[("X", "20240106_0750")] == (1, "ok")
    assert got[("US30", "20240106_0750")] == (0, "expected_empty")
    assert got[("US30", "20240105_1350")] == (0, "missing")
    assert got[("X", "20240105_0750")] == (0, "missing")
    assert len(got) == 2 * 2 * 2


def test_next_uncompleted_window(spark):
    rows = [tick(1, "A", "2024-01-15 11:55:00")]
    tagged = T.tag_windows(spark.createDataFrame(rows, SCHEMA))
    nxt = T.next_uncompleted_window(tagged, dt.datetime(2024, 1, 15, 9, 0)).collect()
    # 13:50 on the 15th is completed (has a tick), so the next is 07:50 on the 16th.
    assert [r.window_key for r in nxt] == ["20240116_0750"]


def test_flagship_entry(spark):
    df = flagship.window_tick_counts(spark, "/root/testdata/sf0.001")
    rows = df.collect()
    assert rows and all(r.n_ticks <= 600 for r in rows)
    assert set(df.columns) == {"symbol", "window_key", "n_ticks", "first_tick", "last_tick", "avg_bid", "avg_ask"}


def test_salted_cap_equals_single_level(spark):
    base = dt.datetime(2024, 1, 1, 5, 50, 0)                  # 07:50 local: first window
    rows = []
    for i in range(3000):                                     # one hot window, many ticks per second
        t = base + dt.timedelta(milliseconds=(i * 7919) % 600_000)
        rows.append((i, "HOT", t, 0, 6, 1.0, 1.1))
    rows += [(10_000 + i, "COLD", base + dt.timedelta(seconds=i), 0, 6, 1.0, 1.1) for i in range(20)]
    tagged = T.in_windows(spark.createDataFrame(rows, SCHEMA))
    order = ("DateTime", "event_id")
    one = T.cap_per_window(tagged, cap=50, order=order, salt_buckets=1)
    two = T.cap_per_window(tagged, cap=50, order=order, salt_buckets=16)
    a = sorted(r.event_id for r in one.collect())
    assert a == sorted(r.event_id for r in two.collect())
    assert len(a) == 70
    hot = sorted(rows[:3000], key=lambda r: (r[2], r[0]))[:50]
    assert sorted(r[0] for r in hot) == [x for x in a if x < 10_000]
