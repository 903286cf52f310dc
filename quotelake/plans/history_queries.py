"""Version-history queries over a table whose snapshots are built from ``orders``.

Snapshot v holds every order with ``year(o_orderdate) - 1994 <= v``; each
snapshot appends one year and is committed at the latest order date of
that year.  Every query builds its table in a fresh folder below the
shared checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..operators.versions import VersionedRows
from ..session import scratch_path
from . import fixtures as X
from .registry import register

H = "(SELECT *, year(o_orderdate) - 1994 AS v FROM orders)"
ORDER_COLS = ("o_orderkey", "o_totalprice", "o_orderdate")
SCHEMA = "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz, year int"


def build(spark, sf, upto=7, schema=SCHEMA, spec=None, source_filter=None) -> VersionedRows:
    """Table with snapshots 1..upto imported in one write."""
    t = VersionedRows(spark, scratch_path(spark, "orders-history"))
    t.create(schema, partition_by=("year",), spec=spec)
    src = X.history_source(spark, sf).filter(F.col("v") <= upto)
    if source_filter is not None:
        src = src.filter(source_filter)
    names = [c.split()[0] for c in schema.split(",")]
    cols = [F.year("o_orderdate").cast("int").alias("year") if n == "year" else F.col(n) for n in names]
    t.import_history(src.select(*cols, "v"), version_col="v", committed_at_col="o_orderdate")
    return t


def _pairs(df):
    return df.select("o_orderkey", "o_totalprice")


@register("snapshot_list", """
SELECT v AS snapshot_id, ts AS committed_at, 'append' AS operation, CAST(n AS VARCHAR) AS added,
       CAST(NULL AS VARCHAR) AS deleted, CAST(sum(n) OVER (ORDER BY v) AS VARCHAR) AS total
FROM (SELECT year(o_orderdate) - 1994 AS v, count(*) AS n, max(o_orderdate) AS ts FROM orders GROUP BY 1)""")
def q_snapshot_list(spark, sf):
    return build(spark, sf).snapshots()


@register("snapshot_report", """
SELECT v AS snapshot_id, ts AS committed_at, op AS operation, coalesce(CAST(n AS VARCHAR), '0') AS added,
       '0' AS deleted, CASE WHEN n IS NULL THEN '?' ELSE CAST(sum(n) OVER (ORDER BY v) AS VARCHAR) END AS total
FROM (SELECT year(o_orderdate) - 1994 AS v, count(*) AS n, max(o_orderdate) AS ts, 'append' AS op FROM orders GROUP BY 1
      UNION ALL SELECT max(year(o_orderdate)) - 1993, NULL, max(o_orderdate) + INTERVAL 1 DAY, 'add column' FROM orders) x""")
def q_snapshot_report(spark, sf):
    """Versions as a report shows them, with defaults for what a commit does not count."""
    t = build(spark, sf)
    last = t.version()["committed_at"]
    t.add_column("note", "string", committed_at=last + _dt.timedelta(days=1))
    return t.listing()


@register("sample_at_version", f"""
SELECT o_orderkey, o_totalprice, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year FROM {H} WHERE v <= 3
ORDER BY o_orderdate DESC, o_orderkey LIMIT 10""")
def q_sample_at_version(spark, sf):
    return build(spark, sf).sample(10, version=3, order=(F.col("o_orderdate").desc(), "o_orderkey"))


@register("sample_at_timestamp", f"""
SELECT o_orderkey, o_totalprice, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year FROM {H}
WHERE v <= (SELECT max(v) FROM (SELECT year(o_orderdate) - 1994 AS v, max(o_orderdate) AS c
                                FROM orders GROUP BY 1) WHERE c <= TIMESTAMP '1998-06-01')
ORDER BY o_orderdate DESC, o_orderkey LIMIT 10""")
def q_sample_at_timestamp(spark, sf):
    return build(spark, sf).sample(10, at=_dt.datetime(1998, 6, 1), order=(F.col("o_orderdate").desc(), "o_orderkey"))


@register("read_at_version", f"SELECT o_orderkey, o_totalprice FROM {H} WHERE v <= 3")
def q_read_at_version(spark, sf):
    return _pairs(build(spark, sf).read(3))


@register("read_at_timestamp", f"""
SELECT o_orderkey, o_totalprice FROM {H}
WHERE v <= (SELECT max(v) FROM (SELECT year(o_orderdate) - 1994 AS v, max(o_orderdate) AS c
                                FROM orders GROUP BY 1) WHERE c <= TIMESTAMP '1998-06-01')""")
def q_read_at_timestamp(spark, sf):
    return _pairs(build(spark, sf).read_at(_dt.datetime(1998, 6, 1)))


@register("diff_counts", f"""
SELECT count(*) FILTER (WHERE v <= 2) AS count_a, count(*) FILTER (WHERE v <= 5) AS count_b,
       count(*) FILTER (WHERE v <= 5) - count(*) FILTER (WHERE v <= 2) AS delta
FROM {H} WHERE v <= 5""")
def q_diff_counts(spark, sf):
    return build(spark, sf).diff_counts(2, 5)


@register("row_diff", f"""
SELECT o_orderkey, o_totalprice FROM {H} WHERE v <= 5
EXCEPT ALL SELECT o_orderkey, o_totalprice FROM {H} WHERE v <= 2""")
def q_row_diff(spark, sf):
    return build(spark, sf).row_diff(2, 5, cols=["o_orderkey", "o_totalprice"])


@register("year_counts_at_version", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS cnt FROM {H} WHERE v <= 3 GROUP BY 1""")
def q_year_counts_at_version(spark, sf):
    from ..operators.aggregates import year_counts
    return year_counts(build(spark, sf).read(3), year_expr=F.col("year"))


@register("add_column", f"""
SELECT o_orderkey, CASE WHEN v = 4 THEN o_totalprice END AS o_totalprice FROM {H} WHERE v <= 4""")
def q_add_column(spark, sf):
    t = build(spark, sf, upto=3, schema="o_orderkey bigint, o_orderdate timestamp_ntz, year int")
    t.add_column("o_totalprice", "double")
    v4 = X.history_source(spark, sf).filter("v = 4") \
        .select("o_orderkey", "o_orderdate", "o_totalprice", F.year("o_orderdate").cast("int").alias("year"))
    t.append(v4)
    return _pairs(t.read())


@register("drop_column", f"""
SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year FROM {H} WHERE v <= 4""")
def q_drop_column(spark, sf):
    t = build(spark, sf, upto=4)
    t.drop_column("o_totalprice")
    return t.read()


@register("change_column", f"""
SELECT CAST(o_orderkey AS BIGINT) AS order_id, o_totalprice FROM {H} WHERE v <= 4""")
def q_change_column(spark, sf):
    t = build(spark, sf, upto=4, schema="o_orderkey int, o_totalprice double, o_orderdate timestamp_ntz, year int")
    t.change_column("o_orderkey", "order_id", "bigint")
    return t.read().select("order_id", "o_totalprice")


@register("rollback_read", f"SELECT o_orderkey, o_totalprice FROM {H} WHERE v <= 3")
def q_rollback_read(spark, sf):
    t = build(spark, sf)
    t.rollback(3)
    return _pairs(t.read())


@register("compact_rows_equal", f"SELECT o_orderkey, o_totalprice FROM {H} WHERE v <= 3")
def q_compact_rows_equal(spark, sf):
    t = build(spark, sf)
    t.rollback(3)
    t.compact(sort_cols=("o_orderdate",))
    return _pairs(t.read())


@register("expire_snapshots", f"SELECT DISTINCT v AS snapshot_id FROM {H} WHERE v >= 5")
def q_expire_snapshots(spark, sf):
    t = build(spark, sf)
    t.expire(t.version(5)["committed_at"])
    return t.snapshots().select("snapshot_id")


@register("repartition_spec", f"""
SELECT CAST(month(o_orderdate) AS INTEGER) AS mon, count(*) AS cnt FROM {H} GROUP BY 1""")
def q_repartition_spec(spark, sf):
    t = build(spark, sf, upto=3)
    t.set_partition_spec(["year", "o_month=month(o_orderdate)"])
    later = X.history_source(spark, sf).filter("v > 3") \
        .select("o_orderkey", "o_totalprice", "o_orderdate", F.year("o_orderdate").cast("int").alias("year"), "v")
    t.import_history(later, version_col="v", committed_at_col="o_orderdate")
    return t.read().groupBy(F.month("o_orderdate").cast("int").alias("mon")) \
        .agg(F.count(F.lit(1)).alias("cnt"))
