import datetime as dt

from pyspark.sql import functions as F

from quotelake.functions import columns as C


def one(spark, expr, value=None, ddl="x string"):
    df = spark.createDataFrame([(value,)], ddl)
    return df.select(expr.alias("r")).first()["r"]


def test_epoch_roundtrip_and_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 7, 50, 1, 123987),)], "t timestamp_ntz")
    r = df.select(C.epoch_ms("t").alias("ms"), C.ts_text("t").alias("txt"),
                  C.ts_text(C.ms_to_ts(C.epoch_ms("t"))).alias("back")).first()
    assert r["ms"] == 1704095401123          # floored, not rounded
    assert r["txt"] == "2024-01-01 07:50:01.123"
    assert r["back"] == r["txt"]


def test_parse_bad_text_is_null(spark):
    df = spark.createDataFrame([("2026-03-07 07:50:01.123",), ("garbage",), (None,)], "x string")
    out = [r["t"] for r in df.select(C.parse_ts_text("x").alias("t")).collect()]
    assert out[0] == dt.datetime(2026, 3, 7, 7, 50, 1, 123000)
    assert out[1] is None and out[2] is None


def test_local_zone_and_windows(spark):
    rows = [("2024-01-01 05:50:00.000",), ("2024-01-01 05:59:59.999",), ("2024-01-01 06:00:00.000",),
            ("2024-01-01 05:49:59.999",), ("2024-01-01 11:50:00.000",)]
    df = spark.createDataFrame(rows, "x string").select(C.parse_ts_text("x").alias("t"))
    loc = C.to_local("t")
    got = [(r["m"], r["k"]) for r in df.select(
        C.window_start_min(loc).alias("m"),
        C.window_key(F.to_date(loc), C.window_start_min(loc)).alias("k")).collect()]
    assert got == [(470, "20240101_0750"), (470, "20240101_0750"), (None, None), (None, None),
                   (830, "20240101_1350")]


def test_weekday_uses_local_date(spark):
    # Friday 22:30 UTC is Saturday 00:30 local; Sunday 22:30 UTC is Monday local.
    df = spark.createDataFrame([(dt.datetime(2026, 3, 6, 22, 30),), (dt.datetime(2026, 3, 8, 22, 30),)],
                               "t timestamp_ntz")
    assert [r[0] for r in df.select(C.local_weekday("t")).collect()] == [5, 0]


def test_spread(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (None, 1.0), (1.0, None)], "Bid double, Ask double")
    assert [r[0] for r in df.select(C.spread()).collect()] == [0.5, 0.0, None, None]


def test_is_crypto_case_insensitive(spark):
    df = spark.createDataFrame([("btcusd",), ("US30",)], "symbol string")
    assert [r[0] for r in df.select(C.is_crypto("symbol")).collect()] == [True, False]


def test_path_symbol_forms(spark):
    rows = [("s3://b/raw/BTCUSD/BTCUSD_20260306_0750.csv",),
            ("file:/tmp/x/Training%20Batch/symbol=XAUUSD/part-0.parquet",),
            ("file:/tmp/x/other/US30/f.csv",)]
    df = spark.createDataFrame(rows, "p string")
    raw = [r[0] for r in df.select(C.path_symbol("p", "raw")).collect()]
    tb = [r[0] for r in df.select(C.path_symbol("p", "Training Batch")).collect()]
    assert raw == ["BTCUSD", None, None]
    assert tb == [None, "XAUUSD", None]


def test_output_and_target_key(spark):
    df = spark.createDataFrame([("btcusd", dt.date(2026, 3, 6), 470)], "symbol string, d date, m int")
    k = df.select(C.output_key("symbol", "d", "m").alias("k")).first()["k"]
    assert k == "raw/BTCUSD/BTCUSD_20260306_0750.csv"
    t = spark.createDataFrame([(k,), ("raw/A/a.b.csv",), ("raw/A/noext",)], "k string") \
        .select(C.target_key("k")).collect()
    assert [r[0] for r in t] == ["Training Batch/BTCUSD/BTCUSD_20260306_0750.parquet",
                                 "Training Batch/A/a.b.parquet", "Training Batch/A/noext.parquet"]


def test_normalize_path(spark):
    df = spark.createDataFrame([("file:///tmp/Training%20Batch/a+b.csv",), ("file:/tmp/Training Batch/a+b.csv",)],
                               "p string")
    a, b = [r[0] for r in df.select(C.normalize_path("p")).collect()]
    assert a == b == "file:/tmp/Training Batch/a+b.csv"


def test_parse_ignores_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00.123",)], "t string")   # a DST gap in New York
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(C.parse_ts_text("t").alias("x")).first().x
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.datetime(2024, 3, 10, 2, 30, 0, 123000)
