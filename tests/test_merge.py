import datetime as dt

from quotelake.operators import catalog as CT
from quotelake.operators import gold as G
from quotelake.operators import merge as M

RAW = "DateTime timestamp_ntz, Bid double, Ask double, symbol string"
T0 = dt.datetime(2026, 3, 6, 5, 50, 1, 123000)
T1 = dt.datetime(2026, 3, 6, 5, 50, 2)


def test_key_conflict_inserts_rows_reports_keys(spark):
    src = spark.createDataFrame([(T0, 1.0, 1.1, "A"), (T0, 1.0, 1.2, "A"), (T0, 1.0, 1.1, "A")], RAW)
    tgt = spark.createDataFrame([], RAW)
    ins = M.rows_to_insert(src, tgt, cols=src.columns)
    assert ins.count() == 2                                   # distinct rows, not keys (D-3)
    assert M.new_key_count(src, tgt).first().new_count == 1
    kc = M.key_conflicts(src).first()
    assert (kc.distinct_rows, kc.distinct_keys, kc.conflicting_keys) == (2, 1, 1)


def test_null_keys_are_quarantined(spark):
    src = spark.createDataFrame([(None, 1.0, 1.1, "A"), (T0, 1.0, None, "A")], RAW)
    good, bad = M.split_null_keys(src)
    assert good.count() == 1 and bad.count() == 1
    assert M.rows_to_insert(src, spark.createDataFrame([], RAW), src.columns).count() == 1


def test_gold_ingest_is_idempotent(spark, scratch):
    t = G.gold_table(spark, scratch("gold"))
    raw = spark.createDataFrame([(T0, 1.0, 1.1, "btcusd"), (T1, 2.0, 1.9, "BTCUSD"), (None, 1.0, 1.0, "X")], RAW)
    r1 = G.ingest(t, raw)
    assert r1["null_keys"].count() == 1
    s1 = t.current_version()
    assert t.read().count() == 2
    r2 = G.ingest(t, raw)                                     # nothing new: no snapshot (E3)
    assert r2["snapshot_id"] == s1 == t.current_version()
    assert t.read().count() == 2
    assert {r.symbol for r in t.read().collect()} == {"BTCUSD"}   # upper-cased (D-10)


def test_spread_table(spark, scratch):
    t = G.gold_table(spark, scratch("spread"), spread=True)
    raw = spark.createDataFrame([(T0, 1.0, 1.1, "A"), (T1, 2.0, 1.9, "A")], RAW)
    G.ingest(t, raw, spread=True)
    got = sorted((r.Bid, r.Spread, r.year) for r in t.read().collect())
    assert got[0][0] == 1.0 and abs(got[0][1] - 0.1) < 1e-12 and got[0][2] == 2026
    assert got[1][1] == 0.0                                   # negative spread floored


def test_ingest_prunes_target_partitions(spark, scratch):
    t = G.gold_table(spark, scratch("gold"))
    G.ingest(t, spark.createDataFrame([(T0, 1.0, 1.1, "A"), (T0, 1.0, 1.1, "B")], RAW))
    src = G.gold_rows(spark.createDataFrame([(T1, 1.0, 1.1, "A")], RAW))
    plan = M.rows_to_insert(src, t.read(), src.columns, partition_cols=G.PARTITION_BY)
    assert plan.count() == 1


def _gold_with_two_years(spark, scratch):
    t = G.gold_table(spark, scratch("gold"))
    old = dt.datetime(2025, 12, 31, 23, 59, 59)
    G.ingest(t, spark.createDataFrame([(old, 1.0, 1.1, "A"), (T0, 1.0, 1.1, "A"), (T0, 2.0, 2.1, "B")], RAW))
    return t


def test_prune_static_filter_reaches_scan(spark, scratch):
    t = _gold_with_two_years(spark, scratch)
    src = G.gold_rows(spark.createDataFrame([(T0, 1.0, 1.1, "A"), (T1, 1.0, 1.1, "A")], RAW))
    pruned = M.prune_target(t.read(), src, G.PARTITION_BY, "DateTime")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    parts = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "(symbol" in parts and "= A)" in parts and "= 2026)" in parts
    assert "GreaterThanOrEqual(DateTime" in plan
    assert [r.DateTime for r in pruned.collect()] == [T0]      # other year and symbol cut away
    assert M.rows_to_insert(src, t.read(), src.columns, partition_cols=G.PARTITION_BY,
                            range_col="DateTime").collect()[0].DateTime == T1


def test_prune_semi_join_path_gives_same_rows(spark, scratch, monkeypatch):
    t = _gold_with_two_years(spark, scratch)
    src = G.gold_rows(spark.createDataFrame([(T0, 1.0, 1.1, "A"), (T1, 5.0, 5.1, "B")], RAW))
    static = M.rows_to_insert(src, t.read(), src.columns, partition_cols=G.PARTITION_BY, range_col="DateTime")
    monkeypatch.setattr(M, "MAX_STATIC_PARTITIONS", 0)
    joined = M.rows_to_insert(src, t.read(), src.columns, partition_cols=G.PARTITION_BY, range_col="DateTime")
    assert sorted(map(tuple, static.collect())) == sorted(map(tuple, joined.collect()))
    assert [(r.symbol, r.DateTime) for r in joined.collect()] == [("B", T1)]


def test_prune_with_empty_source(spark, scratch):
    t = _gold_with_two_years(spark, scratch)
    src = G.gold_rows(spark.createDataFrame([], RAW))
    assert M.prune_target(t.read(), src, G.PARTITION_BY, "DateTime").count() == 0
    assert G.ingest(t, spark.createDataFrame([], RAW))["snapshot_id"] == t.current_version()


def test_catalog_setup_is_idempotent(spark, scratch):
    root = scratch("cat")
    for _ in range(2):
        CT.create_database(spark, "quotelake_test_db", f"{root}/db")
        t = G.gold_table(spark, f"{root}/gold")
    G.ingest(t, spark.createDataFrame([(T0, 1.0, 1.1, "eurusd"), (T1, 1.0, 1.1, "EURUSD")], RAW))
    assert [tuple(r) for r in G.partitions(t).collect()] == [("ticks_eurusd", "EURUSD", 2026, 2)]
    assert spark.catalog.databaseExists("quotelake_test_db")


def test_target_is_cut_to_each_partitions_own_range(spark):
    import datetime as dt
    from quotelake.operators import merge as M
    day = lambda d: dt.datetime(2024, 1, d)
    schema = "DateTime timestamp_ntz, symbol string, year int"
    target = spark.createDataFrame([(day(d), s, 2024) for d in range(1, 31) for s in "AB"], schema)
    source = spark.createDataFrame([(day(1), "A", 2024), (day(30), "B", 2024)], schema)
    cut = M.prune_target(target, source, ("symbol", "year"), "DateTime")
    assert sorted((r.symbol, r.DateTime.day) for r in cut.collect()) == [("A", 1), ("B", 30)]


# ------------------------------------------------------------- key bitmap --

def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bitmap_size_is_bounded():
    from quotelake.operators import sketch as B
    assert B.bitmap_bits(0) == B.bitmap_bits(10) == B.BUCKET_BITS
    assert B.bitmap_bits(1_000_000) == 1 << 24 and B.bitmap_bits(10 ** 12) == B.MAX_BYTES * 8
    assert B.bitmap_bits(10 ** 12, 5000) == B.BUCKET_BITS


def test_bitmap_lets_every_match_through(spark):
    from pyspark.sql import functions as F

    from quotelake.operators import sketch as B
    rows = spark.range(60_000).select((F.col("id") * 7).alias("k"), F.concat(F.lit("s"), F.col("id") % 11).alias("s"))
    some = rows.where("k % 10 = 0")
    for bits in (B.BUCKET_BITS, B.bitmap_bits(6000)):
        bitmap = B.key_bitmap(some, ["k", "s"], bits)
        assert bitmap.agg(F.sum(F.length("_bits"))).first()[0] <= bits // 8
        left = B.may_match(rows, bitmap, ["k", "s"], bits)
        assert left.columns == ["k", "s"] and some.exceptAll(left).count() == 0
        extra = left.count() - some.count()
        assert extra < 54_000 * (0.25 if bits == B.BUCKET_BITS else 0.08)   # one in 5.5 and one in 22 by chance


def test_merge_is_exact_whatever_the_bitmap(spark):
    """With a bitmap of one bucket nearly every bit is set; the result is the same."""
    src = spark.range(40_000).selectExpr("id AS a", "cast(id % 3 AS string) AS b", "id * 1.5D AS v")
    tgt = spark.range(200_000).selectExpr("id * 2 AS a", "cast((id * 2) % 3 AS string) AS b", "0D AS v")
    tgt = tgt.unionByName(tgt.where("a < 100")).unionByName(spark.sql("SELECT null AS a, '1' AS b, 1D AS v"))
    for max_bytes in (4096, M.sketch.MAX_BYTES):
        ins = M.rows_to_insert(src.unionByName(src), tgt, ["a", "b", "v"], ("a", "b"), max_bytes=max_bytes)
        assert sorted(r.a for r in ins.collect()) == list(range(1, 40_000, 2))
        assert M.new_keys(src, tgt, ("a", "b"), max_bytes=max_bytes).count() == 20_000


def test_merge_reads_its_source_once_and_shuffles_few_target_rows(spark, scratch):
    import time

    from pyspark.sql import functions as F
    path = scratch("target")
    spark.range(100_000).selectExpr("id AS a", "id % 10 AS p", "rand() AS v").write.partitionBy("p").parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def seen(frames):
        for pdf in frames:
            reads.add(len(pdf))
            yield pdf

    src = spark.range(0, 500, 1, 4).select((F.col("id") * 10).alias("a"), F.lit(0).cast("long").alias("p"), F.lit(1.0).alias("v"))
    src = src.mapInPandas(seen, src.schema)
    ins = M.rows_to_insert(src, spark.read.parquet(path), ["a", "p", "v"], ("a",), partition_cols=("p",), range_col="a")
    assert ins.count() == 0
    time.sleep(0.2)
    assert reads.value == 500                                 # one pass
    plan = _plan(ins)
    assert "Aggregate" not in plan and plan.count("LeftSemi") == 1 and "LeftAnti" in plan   # no distinct target
    survivors = M.matchable(spark.read.parquet(path), M.checkpointed(src), ("a",), ("p",), "a")
    assert 500 <= survivors.count() <= 700                    # of 100,000 rows


# ---------------------------------------------------------------- catalog --

def test_views_last_and_follow_the_table(spark, scratch):
    db, t = "quotelake_views_test", G.gold_table(spark, scratch("gold"), spread=True)
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    one = spark.createDataFrame([(T0, 1.0, 1.1, "eurusd.m"), (T0, 1.0, 1.2, "EURUSD_M"), (T0, 1.0, 1.3, "o'neil")], RAW)
    first = G.ingest(t, one, spread=True)["snapshot_id"]
    names = CT.publish(t, db, spread=True, location=scratch("db"))
    dotted, quoted = CT.table_name("EURUSD.m", True), CT.table_name("O'NEIL", True)
    assert names == sorted([dotted, quoted, "ticks_eurusd_m_spread"]) and len(set(names)) == 3
    other = spark.newSession()                                # another session of the same catalog
    assert [r[0] for r in CT.tick_tables(other, db).collect()] == names
    assert [(r.symbol, r.Ask) for r in other.table(f"{db}.{dotted}").collect()] == [("EURUSD.M", 1.1)]
    assert [(r.symbol, r.Ask) for r in other.table(f"{db}.{quoted}").collect()] == [("O'NEIL", 1.3)]
    G.ingest(t, spark.createDataFrame([(T1, 2.0, 2.1, "EURUSD.m"), (T1, 2.0, 2.1, "NEW")], RAW), spread=True)
    for _ in range(2):                                        # again changes nothing
        assert CT.publish(t, db, spread=True) == sorted([*names, "ticks_new_spread"])
    other = spark.newSession()                                # one that has read the logs before has to refresh them
    assert other.sql(f"SELECT * FROM {db}.{dotted}").count() == 2 and other.table(f"{db}.gold").count() == 5
    plan = other.sql(f"SELECT Bid FROM {db}.{dotted}")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan
    t.rollback(first)                                         # the views are of the current version
    other.catalog.refreshTable(f"{db}.gold_current")
    other.catalog.refreshTable(f"{db}.gold")
    assert other.table(f"{db}.gold").count() == 3
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_publish_an_empty_and_an_evolved_table(spark, scratch):
    db, t = "quotelake_evolved_test", G.gold_table(spark, scratch("gold"))
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    assert CT.publish(t, db, location=scratch("db")) == [] and spark.table(f"{db}.gold").count() == 0
    G.ingest(t, spark.createDataFrame([(T0, 1.0, 1.1, "A")], RAW))
    t.add_column("note", "string")
    t.change_column("Bid", "bid_price")
    assert CT.publish(t, db) == ["ticks_a"]
    assert [(r.bid_price, r.note) for r in spark.newSession().table(f"{db}.ticks_a").collect()] == [(1.0, None)]
    spark.sql(f"DROP DATABASE {db} CASCADE")
