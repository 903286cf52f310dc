"""Small reporting aggregates over tick tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def year_counts(df: DataFrame, year_expr=None, ts_col: str = "DateTime") -> DataFrame:
    """Rows per year, ordered (A4).

    On a table partitioned by ``year`` pass ``year_expr=F.col("year")`` so the
    count is answered per partition (D-8) instead of from each timestamp.
    """
    y = year_expr if year_expr is not None else F.year(ts_col)
    return df.groupBy(y.cast("int").alias("yr")).agg(F.count(F.lit(1)).alias("cnt")).orderBy("yr")


def year_counts_total(df: DataFrame, year_expr=None, ts_col: str = "DateTime",
                      flag_total: bool = False) -> DataFrame:
    """Yearly counts plus a grand-total row with null ``yr``, last.

    With ``flag_total`` an ``is_total`` column tells the total apart from a
    genuine null year (``grouping_id``).
    """
    y = year_expr if year_expr is not None else F.year(ts_col)
    out = df.select(y.cast("int").alias("yr")).rollup("yr") \
        .agg(F.count(F.lit(1)).alias("cnt"), (F.grouping_id() == 1).alias("is_total")) \
        .orderBy("is_total", "yr")
    return out if flag_total else out.drop("is_total")


def discover_symbols(files: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """Distinct symbols found in a file listing or scan."""
    return files.select(symbol_col).filter(F.col(symbol_col).isNotNull()).distinct()
