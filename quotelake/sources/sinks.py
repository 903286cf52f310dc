"""Sinks: tick CSV and Parquet files, one output per key.

Spark's file committer stages task output and publishes it on job commit,
which replaces the write-to-temp-then-copy dance of a single-machine
uploader (S9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C


def write_tick_csv(df: DataFrame, root: str, prefix: str = K.RAW_PREFIX, key_col: str = "window_key",
                   mode: str = "append") -> str:
    """CSV with header ``DateTime,Bid,Ask`` under ``root/prefix/symbol=…/<key_col>=…``.

    Rows are rebalanced on (symbol, key), so every key gets one file, like
    one upload per symbol-window (window keys hold at most 600 ticks after
    the cap).  Should one key hold far more, AQE splits it over several
    tasks and files rather than sending it to one task.  ``mode='overwrite'``
    replaces the keys written and leaves the others.
    """
    out = f"{root.rstrip('/')}/{prefix}"
    text = F.col("DateTime") if dict(df.dtypes)["DateTime"] == "string" else C.ts_text("DateTime")
    df.select(text.alias("DateTime"), "Bid", "Ask", F.upper("symbol").alias("symbol"), key_col) \
        .hint("rebalance", "symbol", key_col) \
        .write.mode(mode).option("partitionOverwriteMode", "dynamic") \
        .partitionBy("symbol", key_col).option("header", "true") \
        .option("lineSep", "\n").csv(out)
    return out


def write_tick_parquet(df: DataFrame, root: str, prefix: str = K.PARQUET_PREFIX,
                       key_cols=("symbol",), extra_cols=(), mode: str = "append",
                       distribute: bool = True) -> str:
    """Tick Parquet partitioned by ``key_cols``.

    With ``distribute`` the rows are rebalanced on the keys first (AQE
    sizes files and splits a hot key over tasks); without it each task
    writes its own rows, one file per task and key, with no shuffle.  With
    ``mode='overwrite'`` and dynamic partition overwrite only the partitions
    written are replaced.
    """
    out = f"{root.rstrip('/')}/{prefix}"
    cols = ["DateTime", "Bid", "Ask", *extra_cols, *key_cols]
    rows = df.select(*cols)
    if distribute:
        rows = rows.hint("rebalance", *key_cols)
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*key_cols).parquet(out)
    return out
