import datetime as dt

from quotelake.operators import gold as G
from quotelake.operators import ticks as T
from quotelake.streaming import ticks as R

BASE = dt.datetime(2024, 1, 2, 5, 50, 0)                      # 07:50 local


def _ticks(n=400):
    rows = []
    for i in range(n):
        t = BASE + dt.timedelta(milliseconds=250 * i + (i % 3))
        ms = int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
        rows.append((i, "A" if i % 2 else "B", t, ms, 6, 1.0 + i / 1000, 1.1 + i / 1000))
    return rows


def _land(spark, scratch, rows, parts=4):
    path = scratch("landing")
    spark.createDataFrame(rows, R.TICK_STREAM_SCHEMA).repartition(parts).write.parquet(path)
    return path


def test_stream_merge_replay_inserts_nothing_twice(spark, scratch):
    rows = _ticks(100)
    land = _land(spark, scratch, rows)
    t = G.gold_table(spark, scratch("gold"))
    R.merge_stream_into_gold(R.tick_stream(spark, land, max_files_per_trigger=1), t, scratch("ck1"))
    n = t.read().count()
    R.merge_stream_into_gold(R.tick_stream(spark, land), t, scratch("ck2"))   # full replay
    assert n == 100 and t.read().count() == 100


def test_stream_merge_quarantines_null_keys(spark, scratch):
    rows = _ticks(20) + [(100, None, BASE, 0, 6, 1.0, 1.1), (101, "A", None, 0, 6, 1.0, 1.1)]
    t, bad = G.gold_table(spark, scratch("gold")), scratch("bad")
    R.merge_stream_into_gold(R.tick_stream(spark, _land(spark, scratch, rows)), t, scratch("ck"), quarantine=bad)
    assert t.read().count() == 20 and spark.read.parquet(bad).count() == 2


def test_first_per_second_over_epochs_equals_batch(spark, scratch):
    rows = _ticks()
    land, sink = _land(spark, scratch, rows), scratch("fps")
    R.first_per_second_to(R.tick_stream(spark, land, max_files_per_trigger=1), sink, scratch("ck"))
    batch = T.first_per_second(spark.createDataFrame(rows, R.TICK_STREAM_SCHEMA), order=("DateTime", "event_id"))
    assert {r.event_id for r in R.read_first_per_second(spark, sink).collect()} == \
        {r.event_id for r in batch.collect()}


def test_first_per_second_keeps_one_row_and_reads_touched_hours_only(spark, scratch):
    import os

    from quotelake.session import local_path
    land, sink, ck = scratch("landing"), scratch("fps"), scratch("ck")

    def feed(rows):
        spark.createDataFrame(rows, R.TICK_STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(land)
        R.first_per_second_to(R.tick_stream(spark, land), sink, ck)

    hour = lambda k, i, s, ms: (i, s, BASE + dt.timedelta(hours=k, milliseconds=ms), 0, 6, 1.0, 1.1)
    feed([hour(0, 1, "A", 500), hour(1, 2, "A", 500), hour(1, 3, "B", 0)])
    untouched = {f: os.path.getmtime(f) for f in _files(local_path(sink), "hour=2024010205")}
    feed([hour(1, 4, "A", 100), hour(1, 5, "A", 900), hour(1, 6, "B", 0), (7, "A", None, 0, 6, 1.0, 1.1)])
    assert sorted(r.event_id for r in R.read_first_per_second(spark, sink).collect()) == [1, 3, 4]
    assert untouched == {f: os.path.getmtime(f) for f in _files(local_path(sink), "hour=2024010205")} != {}


def _files(root, part):
    import os
    return [os.path.join(root, part, f) for f in os.listdir(os.path.join(root, part)) if f.endswith(".parquet")]
