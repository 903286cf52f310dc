import os

import pytest
from pyspark.sql import functions as F

from quotelake.session import local_path
from quotelake.sources import convert as V
from quotelake.sources import files as S

GOOD = "DateTime,Bid,Ask\n2026-03-06 05:50:01.123,1.5,1.6\n2026-03-06 05:50:02.000,1.7,1.8\n"
BAD = ("DateTime,Bid,Ask\n2026-03-06 05:50:01.123,2.5,2.6\n"
       "2026-03-06 05:50:02.000,2.5,2.6,9.9\n"      # too many fields
       "2026-03-06 05:50:03.000,abc,2.6\n"          # bad double
       "not-a-time,2.5,2.6\n")                      # bad timestamp text


def _put(root, rel, text):
    p = os.path.join(local_path(root), rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(text)


def _landing(scratch):
    root = scratch("bucket")
    _put(root, "raw/BTCUSD/BTCUSD_20260306_0750.csv", GOOD)
    _put(root, "raw/ETHUSD/ETHUSD_20260306_0750.csv", BAD)
    _put(root, "raw/ETHUSD/ignored.CSV", GOOD)          # suffix match is case-sensitive
    _put(root, "raw/ETHUSD/notes.txt", "x")
    return root


def test_listing_is_sorted_and_case_sensitive(spark, scratch):
    root = _landing(scratch)
    paths = [r.path for r in S.list_files(spark, f"{root}/raw").collect()]
    assert len(paths) == 2 and paths == sorted(paths)
    assert all(p.endswith(".csv") for p in paths)


def test_convert_quarantine_and_idempotence(spark, scratch):
    root = _landing(scratch)
    st = {r.path.rsplit("/", 1)[1]: (r.status, r.n_rows, r.n_bad)
          for r in V.csv_to_parquet(spark, root, root, fail_on_error=False).collect()}
    assert st == {"BTCUSD_20260306_0750.csv": ("converted", 2, 0),
                  "ETHUSD_20260306_0750.csv": ("failed", 4, 3)}
    raw = S.raw_scan(spark, root)                            # prefix "Training Batch" holds a space
    got = sorted((r.symbol, r.Bid) for r in raw.collect())
    assert got == [("BTCUSD", 1.5), ("BTCUSD", 1.7), ("ETHUSD", 2.5)]
    assert spark.read.parquet(V.quarantine_path(root)).count() == 3
    again = V.csv_to_parquet(spark, root, root, fail_on_error=False)
    # the second run converts nothing; the unchanged bad file is still failed
    assert {r.status for r in again.collect()} == {"skipped", "failed"}
    assert S.raw_scan(spark, root).count() == 3
    summary = {r.status: r.n_files for r in V.conversion_summary(again).collect()}
    assert summary == {"skipped": 1, "failed": 1, "total": 2}


def test_failed_file_fails_the_run_after_writing(spark, scratch):
    root = _landing(scratch)
    with pytest.raises(RuntimeError):
        V.csv_to_parquet(spark, root, root)
    assert S.raw_scan(spark, root).count() == 3              # the good rows were still converted


def test_empty_landing_exits_cleanly(spark, scratch):
    root = scratch("empty")
    assert V.csv_to_parquet(spark, root, root).count() == 0


def test_config_scan_defaults_and_empty_list(spark, scratch):
    ok, empty = scratch("cfg"), scratch("cfg-empty")
    _put(ok, "config.json", '{"symbols": ["BTCUSD", "US30"], "settings": {"file_duration_mins": 10}}')
    rows = S.config_scan(spark, ok).collect()
    assert [(r.symbol, r.s3_prefix, r.poll_interval_ms) for r in rows] == \
        [("BTCUSD", "raw", 200), ("US30", "raw", 200)]
    _put(empty, "config.json", '{"symbols": [], "settings": {}}')
    with pytest.raises(ValueError):
        S.config_scan(spark, empty)


def test_target_keys(spark):
    keys = spark.createDataFrame([("raw/BTCUSD/BTCUSD_20260307_0750.csv",)], "key string")
    assert V.target_keys(keys).first().target_key == "Training Batch/BTCUSD/BTCUSD_20260307_0750.parquet"


def test_csv_sink_one_file_per_key(spark, scratch):
    from quotelake.sources import sinks as W
    root = scratch("sink")
    df = spark.createDataFrame(
        [("2026-03-06 05:50:01.123", 1.0, 1.1, "btcusd", "20260306_0750"),
         ("2026-03-06 05:50:02.000", 1.0, 1.1, "BTCUSD", "20260306_0750"),
         ("2026-03-06 11:50:00.000", 1.0, 1.1, "BTCUSD", "20260306_1350")],
        "DateTime string, Bid double, Ask double, symbol string, window_key string")
    out = W.write_tick_csv(df, root)
    files = S.list_files(spark, out).select("path").collect()
    assert len(files) == 2
    back = S.csv_scan(spark, out).filter(F.col("DateTime_ts").isNotNull())
    assert back.count() == 3 and {r.symbol for r in back.collect()} == {"BTCUSD"}


def test_stream_conversion_converts_each_file_once(spark, scratch):
    root = _landing(scratch)
    ck = scratch("ck")
    V.csv_to_parquet_stream(spark, root, root, ck, max_files_per_trigger=1)
    led = {r.source_file.rsplit("/", 1)[1]: (r.status, r.n_rows, r.n_bad)
           for r in V.read_ledger(spark, root).collect()}
    assert led == {"BTCUSD_20260306_0750.csv": ("converted", 2, 0),
                   "ETHUSD_20260306_0750.csv": ("failed", 4, 3)}
    _put(root, "raw/US30/US30_20260306_0750.csv", GOOD)           # lands later
    V.csv_to_parquet_stream(spark, root, root, ck)
    assert V.read_ledger(spark, root).count() == 3                # only the new file was added
    got = sorted((r.symbol, r.Bid) for r in S.raw_scan(spark, root).collect())
    assert got == [("BTCUSD", 1.5), ("BTCUSD", 1.7), ("ETHUSD", 2.5), ("US30", 1.5), ("US30", 1.7)]


def test_conversion_in_small_chunks(spark, scratch):
    root = _landing(scratch)
    _put(root, "raw/US30/US30_20260306_0750.csv", GOOD)
    st = V.csv_to_parquet(spark, root, root, fail_on_error=False, max_files_per_job=1)
    assert sorted(r.status for r in st.collect()) == ["converted", "converted", "failed"]
    assert V.read_ledger(spark, root).count() == 3 and S.raw_scan(spark, root).count() == 5


def test_parquet_sink_both_write_modes(spark, scratch):
    import datetime as dt
    from quotelake.sources import sinks as W
    df = spark.createDataFrame(
        [(dt.datetime(2026, 3, 6, 5, 50, i), 1.0 + i, 1.1 + i, "BTCUSD" if i % 2 else "US30") for i in range(10)],
        "DateTime timestamp_ntz, Bid double, Ask double, symbol string").repartition(4)
    for distribute in (True, False):
        root = scratch("pq")
        W.write_tick_parquet(df, root, distribute=distribute)
        got = sorted((r.symbol, r.Bid) for r in S.raw_scan(spark, root).collect())
        assert got == sorted((r.symbol, r.Bid) for r in df.collect())


def test_corrected_file_is_converted_again(spark, scratch):
    import time
    root = _landing(scratch)
    V.csv_to_parquet(spark, root, root, fail_on_error=False)
    with pytest.raises(RuntimeError):                       # unchanged: still failed, not skipped
        V.csv_to_parquet(spark, root, root)
    time.sleep(1.1)
    _put(root, "raw/ETHUSD/ETHUSD_20260306_0750.csv", GOOD)
    st = {r.path.rsplit("/", 1)[1]: r.status for r in V.csv_to_parquet(spark, root, root).collect()}
    assert st == {"BTCUSD_20260306_0750.csv": "skipped", "ETHUSD_20260306_0750.csv": "converted"}
    # the corrected version stands in place of the good rows of the failed one
    assert sorted(r.Bid for r in V.read_converted(spark, root).filter("symbol = 'ETHUSD'").collect()) == [1.5, 1.7]
    assert V.read_quarantine(spark, root).count() == 0


def test_named_files_after_a_killed_and_repeated_write(spark, scratch):
    from quotelake.sources import named_files as N
    root = scratch("named")
    df = spark.createDataFrame([("2026-03-06 05:50:01.123", 1.0 + k, None if k == 1 else 1.1, s, key) for k in range(3)
                                for s in ("a", "A", "eurusd.m", None) for key in ("20260306_0750", "20260306_1350")],
                               "DateTime string, Bid double, Ask double, symbol string, window_key string")
    keys = [f"{s}/{s}_20260306_{h}.csv" for s in ("A", "EURUSD.M") for h in ("0750", "1350")]

    writer = N.TickFileWriter(root, "raw", "epoch-3")
    lines = [("A", "20260306_0750", "2026-03-06 05:50:09.000", 9.0, 9.0), ("A", "20260306_1350", "2026-03-06 11:50:09.000", 9.0, 9.0)]
    lost = writer.write(iter(lines))                          # a task that was run twice, then the job died
    writer.write(iter(lines))
    assert len(lost.moves) == 2 and S.list_files(spark, f"{root}/raw").count() == 0
    for _ in range(2):
        N.write_named_csv(df, root, job="epoch-3")
    paths = [r.path for r in S.list_files(spark, f"{root}/raw").collect()]
    assert [p.split("/raw/")[1] for p in paths] == keys
    assert not os.path.exists(os.path.join(local_path(root), "raw", "_staging"))
    back = S.csv_scan(spark, f"{root}/raw")
    rows = back.collect()
    assert len(rows) == 18 and not any(r._corrupt for r in rows)
    assert sorted(r.Bid for r in rows if r.symbol == "A") == sorted([1.0, 2.0, 3.0] * 4)
    with open(os.path.join(local_path(root), "raw", keys[0])) as f:
        assert f.readline() == "DateTime,Bid,Ask\n" and f.readline().count(",") == 2
    writer = N.TickFileWriter(root, "raw", "other")
    writer.abort([writer.write(iter(lines))])                 # an aborted job leaves the files as they were
    assert [r.path for r in S.list_files(spark, f"{root}/raw").collect()] == paths


def _ledger(spark, root):
    return {r.source_file.rsplit("/", 1)[1]: (r.status, r.n_rows, r.n_bad) for r in V.last_versions(V.read_ledger(spark, root)).collect()}


def test_stream_takes_a_corrected_file_again(spark, scratch):
    import time
    root, ck = _landing(scratch), scratch("ck")
    _put(root, "raw/US30/US30_20260306_0750.csv", "DateTime,Bid,Ask\n")                # a file without ticks
    V.csv_to_parquet_stream(spark, root, root, ck)
    assert _ledger(spark, root)["ETHUSD_20260306_0750.csv"] == ("failed", 4, 3)
    assert _ledger(spark, root)["US30_20260306_0750.csv"] == ("converted", 0, 0)
    with pytest.raises(RuntimeError):
        V.csv_to_parquet_stream(spark, root, root, ck, fail_on_error=True)             # nothing new, still failed
    time.sleep(0.05)
    _put(root, "raw/ETHUSD/ETHUSD_20260306_0750.csv", GOOD)
    V.csv_to_parquet_stream(spark, root, root, ck, fail_on_error=True)
    assert _ledger(spark, root)["ETHUSD_20260306_0750.csv"] == ("converted", 2, 0)
    got = sorted((r.symbol, r.Bid) for r in V.read_converted(spark, root).collect())
    assert got == [("BTCUSD", 1.5), ("BTCUSD", 1.7), ("ETHUSD", 1.5), ("ETHUSD", 1.7)]
    assert V.read_quarantine(spark, root).count() == 0 and V.read_ledger(spark, root).count() == 4


def test_replayed_conversion_changes_nothing(spark, scratch):
    root, ck = _landing(scratch), scratch("ck")
    V.csv_to_parquet_stream(spark, root, root, ck, max_files_per_trigger=1)
    data = lambda: (sorted(map(str, S.raw_scan(spark, root).collect())), sorted(map(str, V.read_converted(spark, root).collect())),
                    sorted(map(str, V.read_quarantine(spark, root).collect())), _ledger(spark, root),
                    V.read_ledger(spark, root).count(), spark.read.parquet(V.quarantine_path(root)).count())
    once = data()
    assert len(once[0]) == 3 and len(once[2]) == 3
    commits = os.path.join(local_path(ck), "commits")
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):                      # as if the last micro-batch had died before its commit
        os.remove(os.path.join(commits, name))
    V.csv_to_parquet_stream(spark, root, root, ck)
    assert data() == once
    # a batch that died before its ledger row: its rows lie there and are not seen
    rows = S.csv_scan(spark, f"{root}/raw").withColumn("modified", F.lit(1).cast("bigint"))
    good, _ = V.split_quarantine(rows)
    good.select(F.col("DateTime_ts").alias("DateTime"), "Bid", "Ask", "source_file", "modified", "symbol", F.lit("died-7").alias("batch")) \
        .write.mode("append").partitionBy("symbol", "batch").parquet(f"{root}/Training Batch")
    assert S.raw_scan(spark, root).count() > 3 and data()[1:] == once[1:]


def test_stream_lines_are_parsed_like_the_file_scan(spark, scratch):
    root = scratch("bucket")
    odd = BAD + '2026-03-06 05:50:05.000,,\n\n  \n"2026-03-06 05:50:06.000",1.0,2.0\r\n2026-03-06 05:50:07.000,1.0\nlast,3.0,4.0'
    _put(root, "raw/A%20 B+c/A_20260306_0750.csv", odd)
    V.csv_to_parquet_stream(spark, root, root, scratch("ck"))
    scan = S.csv_scan(spark, f"{root}/raw").persist()
    good, bad = V.split_quarantine(scan)
    cols = ["DateTime", "Bid", "Ask", "symbol", "source_file"]
    want = good.withColumn("DateTime", F.col("DateTime_ts")).select(*cols)
    assert sorted(map(str, V.read_converted(spark, root).select(*cols).collect())) == sorted(map(str, want.collect()))
    assert V.read_quarantine(spark, root).count() == bad.count() > 3
    assert {r.source_file for r in V.read_ledger(spark, root).collect()} == {r.path for r in S.list_files(spark, f"{root}/raw").collect()}


def test_landed_offsets_and_limits(tmp_path):
    from quotelake.sources.landing import LandedReader
    for k in range(5):
        p = tmp_path / f"s{k % 2}" / f"f{k}.csv"
        p.parent.mkdir(exist_ok=True)
        p.write_text("DateTime,Bid,Ask\n" + f"t,{k},1\n" * 3)
        os.utime(p, ns=(1_700_000_000_000_000_000 + (k // 2) * 1_000_000_000,) * 2)     # pairs of equal time
    (tmp_path / "_staging").mkdir()
    (tmp_path / "_staging" / "x.csv").write_text("h\nhidden\n")
    reader, seen, at = LandedReader(str(tmp_path), ".csv", 2, 0, 10), [], None
    start = reader.initialOffset()
    for _ in range(4):
        end = reader.latestOffset()
        for part in reader.partitions(start, end):
            for b in reader.read(part):
                seen += [(r["path"][-6:], r["line"]) for r in b.to_pylist() if r["line"]]
        reader, start = LandedReader(str(tmp_path), ".csv", 2, 0, 10), end
        assert reader.partitions(end, end) == []              # how a restarted query tells its offset
    assert seen == [(f"f{k}.csv", f"t,{k},1") for k in (0, 1, 2, 3, 4) for _ in range(3)]
    assert reader.latestOffset() == end
    waiting = LandedReader(str(tmp_path), ".csv", 9, 10 ** 12, 10)
    assert waiting.latestOffset() == waiting.initialOffset()  # nothing has settled
