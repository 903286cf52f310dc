"""The bounded per-symbol source: at most so many ticks a symbol and poll, nothing twice, offsets survive a restart."""

import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotelake.sources import polls as P
from quotelake.streaming import ticks as R

BASE = dt.datetime(2024, 1, 2, 5, 50, 0)


def land(spark, path, rows):
    df = spark.createDataFrame([(i, s, BASE + dt.timedelta(milliseconds=ms), ms, 6, 1.0, None) for i, s, ms in rows], R.TICK_STREAM_SCHEMA)
    df.coalesce(1).write.mode("append").partitionBy("symbol").parquet(path)


def polled(spark, path, sink, ck, max_rows, once=False):
    def each(batch, epoch):
        batch.withColumn("poll", F.lit(epoch)).write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    R.run_batches(P.tick_polls(spark, path, max_rows), each, ck, None if once else "drain")
    return [(r.symbol, r.time_msc, r.event_id, r.poll) for r in spark.read.parquet(sink).collect()]


def expected(rows, max_rows):
    out = []
    by = collections.defaultdict(list)
    for i, s, ms in rows:
        by[s].append((ms, i))
    for s, v in by.items():
        out += [(s, ms, i, k // max_rows) for k, (ms, i) in enumerate(sorted(v))]
    return sorted(out)


def test_polls_are_bounded_per_symbol(spark, scratch):
    path, sink, ck = scratch("landing"), scratch("polls"), scratch("ck")
    rows = [(k, "HOT.m", k // 4) for k in range(40)] + [(100 + k, "qui:et %", k * 1000) for k in range(3)] + \
        [(200 + k, "SAME", 7) for k in range(25)]              # a millisecond with more ticks than a poll takes
    land(spark, path, rows[:20] + rows[40:50])
    land(spark, path, rows[20:40] + rows[50:])
    assert sorted(polled(spark, path, sink, ck, 10)) == expected(rows, 10)


def test_offsets_survive_a_restart(spark, scratch):
    path, sink, ck = scratch("landing"), scratch("polls"), scratch("ck")
    first = [(k, "A", k) for k in range(25)] + [(50 + k, "B", k) for k in range(5)]
    land(spark, path, first)
    got = polled(spark, path, sink, ck, 10, once=True)          # one poll a run
    assert collections.Counter(r[0] for r in got) == {"A": 10, "B": 5}
    later = [(60 + k, "B", 10 + k) for k in range(4)] + [(70, "NEW", 1)]
    land(spark, path, later)
    land(spark, path, [(99, "B", 2)])                           # behind the cursor: a poll never goes back
    got = polled(spark, path, sink, ck, 10)
    assert sorted(r[:3] for r in got) == sorted((s, ms, i) for i, s, ms in first + later)
    assert max(collections.Counter((r[0], r[3]) for r in got).values()) == 10
    assert sorted(polled(spark, path, sink, ck, 10)) == sorted(got)


def test_cursor_reads_only_the_next_row_groups(spark, scratch, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from quotelake.session import local_path
    folder = local_path(scratch("landing")) + "/symbol=A"
    import os
    os.makedirs(folder)
    table = pa.table({"event_id": pa.array(range(10_000)), "time_msc": pa.array(range(10_000))})
    pq.write_table(table, f"{folder}/a.parquet", row_group_size=100)
    reader, read = P.PollReader(folder.rsplit("/", 1)[0], 250, -1), []
    real = P.pa.concat_tables
    monkeypatch.setattr(P.pa, "concat_tables", lambda t: read.append(t[1].num_rows) or real(t))
    assert reader.latestOffset() == {"A": {"ms": 249, "tie": 249}} and sum(read) == 300
    reader.partitions({}, {"A": {"ms": 8999, "tie": 8999}})
    read.clear()
    assert reader.latestOffset() == {"A": {"ms": 9249, "tie": 9249}} and sum(read) == 300


def test_live_start_looks_back_a_moment(spark, scratch):
    import time
    path, sink, ck = scratch("landing"), scratch("polls"), scratch("ck")
    now = int(time.time() * 1000)
    land(spark, path, [(1, "A", now - 60_000), (2, "A", now + 60_000)])
    R.run_batches(P.tick_polls(spark, path, live=True), lambda b, e: b.write.mode("append").parquet(sink), ck, "drain")
    assert [r.event_id for r in spark.read.parquet(sink).collect()] == [2]


def test_nothing_landed(spark, scratch):
    reader = P.PollReader(scratch("landing"), 10, -1)
    assert reader.latestOffset() == {} and reader.partitions({}, {}) == []
    with pytest.raises(KeyError):
        P.TickPolls({}).streamReader(None)


def test_a_micro_batch_takes_several_polls(spark, scratch):
    """A backlog of many polls costs few micro-batches, with the same bounds; a lost commit is made up with the same polls."""
    import os
    import shutil
    from quotelake.session import local_path
    path, sink, ck, polls = scratch("landing"), scratch("polls"), scratch("ck"), 20
    rows = [(k, "HOT", k // 4) for k in range(500)] + [(600 + k, "B", k) for k in range(35)]
    land(spark, path, rows[:250])
    land(spark, path, rows[250:])
    epochs = []

    def each(batch, epoch):
        epochs.append(epoch)
        batch.withColumn("poll", F.lit(epoch) * polls + F.col("poll")).write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    def got():
        R.run_batches(P.tick_polls(spark, path, 10, polls=polls), each, ck, "drain")
        return sorted((r.symbol, r.time_msc, r.event_id, r.poll) for r in spark.read.parquet(sink).collect())

    assert got() == expected(rows, 10) and epochs == [0, 1, 2]   # 50 polls of HOT
    commits = local_path(ck) + "/commits"
    os.remove(f"{commits}/2")
    if os.path.exists(f"{commits}/.2.crc"):
        os.remove(f"{commits}/.2.crc")
    shutil.rmtree(local_path(sink) + "/epoch=2")
    assert got() == expected(rows, 10) and epochs == [0, 1, 2, 2]


def test_repeated_ticks_stay_in_one_poll(scratch):
    """Several polls planned together end where polls planned one by one do."""
    import os
    import pyarrow as pa
    import pyarrow.parquet as pq
    from quotelake.session import local_path
    folder = local_path(scratch("landing")) + "/symbol=A"
    os.makedirs(folder)
    ids = [k // 7 for k in range(700)]                           # each tick seven times
    pq.write_table(pa.table({"event_id": ids, "time_msc": [i // 3 for i in ids]}), f"{folder}/a.parquet", row_group_size=50)
    root = folder.rsplit("/", 1)[0]
    one, at, ends = P.PollReader(root, 10, -1), {}, []
    while one.latestOffset() != at:
        at = one.latestOffset()
        one.partitions({}, at)
        ends.append((at["A"]["ms"], at["A"]["tie"]))
    many = P.PollReader(root, 10, -1, polls=1000)
    assert [e for s in many.partitions({}, many.latestOffset()) for e in s.ends] == ends
    few = P.PollReader(root, 10, -1, polls=8)
    few.partitions({}, few.latestOffset())
    assert few.at["A"] == {"ms": ends[7][0], "tie": ends[7][1]}
