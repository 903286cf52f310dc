import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotelake.operators.versions import VersionedRows

SCHEMA = "k bigint, v double, ts timestamp_ntz, year int"


def rows(spark, ks, year=2024, v=1.0, when=None):
    when = when or dt.datetime(year, 1, 1)
    return spark.createDataFrame([(k, v * k, when, year) for k in ks], SCHEMA)


def table(spark, scratch):
    t = VersionedRows(spark, scratch("vt"))
    t.create(SCHEMA, partition_by=("year",))
    return t


def keys(df):
    return sorted(r.k for r in df.collect())


def test_laws(spark, scratch):
    t = table(spark, scratch)
    s1 = t.append(rows(spark, [1, 2]), committed_at=dt.datetime(2024, 1, 1))
    s2 = t.append(rows(spark, [3], 2025), committed_at=dt.datetime(2024, 2, 1))
    s3 = t.append(rows(spark, [4, 5], 2025), committed_at=dt.datetime(2024, 3, 1))
    assert keys(t.read(s1)) == [1, 2]                       # read(v) unchanged by later commits
    snaps = t.snapshots().collect()
    assert [s.total for s in snaps] == ["2", "3", "5"]      # total = previous + added
    assert [s.added for s in snaps] == ["2", "1", "2"] and snaps[0].deleted is None
    d = t.diff_counts(s1, s3).first()
    assert (d.count_a, d.count_b, d.delta) == (2, 5, 3)
    assert t.version_at(dt.datetime(2024, 2, 15)) == s2
    with pytest.raises(ValueError):
        t.version_at(dt.datetime(2023, 1, 1))
    with pytest.raises(ValueError):
        t.read(999)
    t.rollback(s2)
    assert keys(t.read()) == [1, 2, 3]                      # rollback then read = read(v)
    assert t.version_at(dt.datetime(2024, 2, 15)) == s2
    assert len(t.snapshots().collect()) == 3                # later snapshots stay listed
    s4 = t.compact(sort_cols=("ts",))
    assert t.read(s2).exceptAll(t.read()).count() == 0 and t.read().exceptAll(t.read(s2)).count() == 0
    assert t.version(s4)["operation"] == "replace"
    removed = t.expire(dt.datetime(2030, 1, 1))
    assert {r.valid_from for r in removed.collect()} == {s1, s2, s3}   # only the compacted commit is live
    assert [s.snapshot_id for s in t.snapshots().collect()] == [s4]
    assert keys(t.read()) == [1, 2, 3]                      # expiry keeps the current read


def test_pruned_read_plan(spark, scratch):
    t = table(spark, scratch)
    t.append(rows(spark, [1]))
    s2 = t.append(rows(spark, [2], 2025))
    plan = t.read(s2).filter(F.col("k") > 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "valid_from" in plan
    assert "PushedFilters" in plan


def test_schema_evolution(spark, scratch):
    t = VersionedRows(spark, scratch("evo"))
    t.create("k int, v double, year int", partition_by=("year",))
    s1 = t.append(spark.createDataFrame([(1, 1.0, 2024)], "k int, v double, year int"))
    t.add_column("note", "string")
    t.append(spark.createDataFrame([(2, 2.0, "x", 2024)], "k int, v double, note string, year int"))
    assert sorted((r.k, r.note) for r in t.read().collect()) == [(1, None), (2, "x")]
    t.change_column("k", "key", "bigint")
    assert dict(t.read().dtypes)["key"] == "bigint"
    assert sorted(r.key for r in t.read().collect()) == [1, 2]
    t.drop_column("v")
    assert "v" not in t.read().columns and "v" in t.read(s1).columns
    t.add_column("v", "double")                             # re-added: new id, old values not resurrected
    assert all(r.v is None for r in t.read().collect())
    with pytest.raises(ValueError):
        t.change_column("key", dtype="int")                 # narrowing refused before commit
    with pytest.raises(ValueError):
        t.drop_column("year")                               # partition column


def test_partition_spec_change(spark, scratch):
    t = table(spark, scratch)
    t.append(rows(spark, [1, 2]))
    t.set_partition_spec(["year", "m=month(ts)"])
    t.append(rows(spark, [3], 2025, when=dt.datetime(2025, 5, 1)))
    assert keys(t.read()) == [1, 2, 3]
    assert "m" not in t.read().columns


def test_row_diff_fast_path_and_fallback(spark, scratch):
    t = table(spark, scratch)
    s1 = t.append(rows(spark, [1, 2]))
    s2 = t.append(rows(spark, [2, 3], 2025))                # duplicate key 2: multiset semantics
    fast = t.row_diff(s1, s2)
    assert "Exchange" not in fast._jdf.queryExecution().executedPlan().toString()
    slow = t.read(s2).exceptAll(t.read(s1))
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    assert keys(fast) == [2, 3]
    s3 = t.compact()                                        # batches rewritten: fallback path
    assert keys(t.row_diff(s1, s3)) == [2, 3] and keys(t.row_diff(s3, s1)) == []
    t.drop_column("v")
    s5 = t.add_column("v", "double")                        # same name, new field id
    assert t.row_diff(s3, s5, cols=["k", "v"]).count() == 4   # old values vs nulls now


def test_import_after_commits_gets_fresh_ids_and_retry_is_clean(spark, scratch):
    t = table(spark, scratch)
    s0 = t.append(rows(spark, [1]))
    s1 = t.add_column("note", "string")
    src = spark.createDataFrame([(k, 1.0, dt.datetime(2024, 1, 1), 2024, None, v) for k, v in [(2, 1), (3, 2)]],
                                SCHEMA + ", note string, ver long")
    ids = t.import_history(src, "ver", "ts")
    assert ids == [s1 + 1, s1 + 2] and len(set(ids) | {s0, s1}) == 4   # no id reused
    assert keys(t.read()) == [1, 2, 3] and keys(t.read(ids[0])) == [1, 2]
    # A write that crashed before its commit leaves a batch folder; the retry replaces it.
    nxt = t._next()
    t._write(rows(spark, [9]).withColumn("note", F.lit("lost")).withColumn("valid_from", F.lit(nxt)), t.version())
    t.append(rows(spark, [4]).withColumn("note", F.lit(None)))
    assert keys(t.read()) == [1, 2, 3, 4]


def test_compact_empty_table(spark, scratch):
    t = table(spark, scratch)
    t.append(rows(spark, [1]))
    t.append(rows(spark, []))                                 # nothing new: no snapshot
    assert len(t.snapshots().collect()) == 1
    u = table(spark, scratch)
    u.add_column("x", "int")
    s = u.compact()
    assert u.read(s).count() == 0 and u.visible(s).count() == 0


def test_a_compaction_that_is_left_behind_hides_nothing(spark, scratch):
    t = table(spark, scratch)
    s1, s2 = t.append(rows(spark, [1])), t.append(rows(spark, [2]))
    s3 = t.compact()
    s4 = t.append(rows(spark, [3]))
    t.rollback(s2)                                          # before the compaction
    s5 = t.append(rows(spark, [4]))
    want = {s1: [1], s2: [1, 2], s3: [1, 2], s4: [1, 2, 3], s5: [1, 2, 4]}
    assert {v: keys(t.read(v)) for v in want} == want and t.version()["total"] == 3
    with pytest.raises(ValueError):
        t.rollback(s4)                                      # left behind: no ancestor
    s6 = t.compact()
    t.rollback(s2)                                          # an ancestor, though its rows were rewritten since
    s7 = t.append(rows(spark, [5]))
    want |= {s6: [1, 2, 4], s7: [1, 2, 5]}
    assert {v: keys(t.read(v)) for v in want} == want
    assert tuple(t.diff_counts(s4, s7).first()) == (3, 3, 0)


def test_expiry_keeps_rows_that_kept_versions_see(spark, scratch):
    t = table(spark, scratch)
    day = lambda d: dt.datetime(2024, 1, d)
    for k in range(1, 5):
        t.append(rows(spark, [k]), committed_at=day(k))
    assert t.expire(day(3)).count() == 0                    # their rows are still seen
    assert [r.snapshot_id for r in t.snapshots().collect()] == [3, 4] and keys(t.read(3)) == [1, 2, 3]
    with pytest.raises(ValueError):
        t.read(2)
    t.compact(committed_at=day(6))
    assert sorted(r[0] for r in t.expire(day(5)).collect()) == [1, 2, 3, 4] and keys(t.read()) == [1, 2, 3, 4]
    t.append(rows(spark, [9]), committed_at=day(7))
    assert keys(t.read()) == [1, 2, 3, 4, 9] and t.version()["total"] == 5


def test_many_commits_are_joined_not_listed(spark, scratch, monkeypatch):
    from quotelake.operators import versions as V
    t = table(spark, scratch)
    src = spark.createDataFrame([(k, 1.0, dt.datetime(2024, 1, 1), 2024, 1 + k % 5) for k in range(20)], SCHEMA + ", ver long")
    t.import_history(src, "ver", "ts")
    want = keys(t.read(3))
    monkeypatch.setattr(V, "MAX_STATIC_COMMITS", 2)
    assert keys(t.read(3)) == want and len(want) == 12


def test_reports_samples_and_defaults(spark, scratch):
    t = table(spark, scratch)
    s1 = t.append(rows(spark, [3, 1, 2]), committed_at=dt.datetime(2024, 1, 1))
    t.add_column("note", "string", committed_at=dt.datetime(2024, 2, 1))
    t.append(rows(spark, [0]).withColumn("note", F.lit("n")), committed_at=dt.datetime(2024, 3, 1))
    assert [(r.added, r.deleted, r.total) for r in t.listing().collect()] == [("3", "0", "3"), ("0", "0", "?"), ("1", "0", "4")]
    assert keys(t.sample(2, order=("k",))) == [0, 1] and keys(t.sample(2, version=s1, order=("k",))) == [1, 2]
    assert keys(t.sample(2, at=dt.datetime(2024, 2, 15), order=("k",))) == [1, 2]
    with pytest.raises(ValueError):
        t.sample(at=dt.datetime(2023, 1, 1))
