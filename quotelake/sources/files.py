"""Scans: config JSON, file listings, tick CSV and raw tick Parquet.

Schemas are always explicit (never inferred).  The CSV schema binds by
position with the header skipped, as the tick CSV files have the fixed
header ``DateTime,Bid,Ask``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import columns as C

CORRUPT_COL = "_corrupt"

TICK_CSV_SCHEMA = T.StructType([
    T.StructField("DateTime", T.StringType()),
    T.StructField("Bid", T.DoubleType()),
    T.StructField("Ask", T.DoubleType()),
])

RAW_TICK_SCHEMA = T.StructType([
    T.StructField("DateTime", T.TimestampNTZType()),
    T.StructField("Bid", T.DoubleType()),
    T.StructField("Ask", T.DoubleType()),
])

CONFIG_SCHEMA = T.StructType([
    T.StructField("symbols", T.ArrayType(T.StringType())),
    T.StructField("settings", T.StructType([
        T.StructField("s3_prefix", T.StringType()),
        T.StructField("poll_interval_ms", T.IntegerType()),
        T.StructField("file_duration_mins", T.IntegerType()),
    ])),
])


def config_scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per configured symbol with its settings, defaults filled.

    Raises when the ``symbols`` list is missing or empty.  ``file_duration_mins``
    is read but, as in the source behaviour, used by nothing (D-6).
    """
    cfg = spark.read.option("multiLine", "true").schema(CONFIG_SCHEMA).json(path)
    rows = cfg.select(
        F.explode_outer("symbols").alias("symbol"),
        F.coalesce(F.col("settings.s3_prefix"), F.lit(K.DEFAULT_PREFIX)).alias("s3_prefix"),
        F.coalesce(F.col("settings.poll_interval_ms"), F.lit(K.DEFAULT_POLL_INTERVAL_MS)).alias("poll_interval_ms"),
        F.col("settings.file_duration_mins").alias("file_duration_mins"),
    ).filter(F.col("symbol").isNotNull())
    if rows.limit(1).count() == 0:
        raise ValueError(f"config {path} must contain a non-empty 'symbols' list")
    return rows


def list_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Files below ``root`` matching ``glob`` (case-sensitive), ordered by path (S3, L4).

    Only ``path``, ``length`` and ``modificationTime`` are selected, so the
    ``content`` column is pruned and no file body is read.  ``path`` compares
    equal to the scans' ``source_file``.
    """
    try:
        df = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
            .option("pathGlobFilter", glob).load(root)
    except Exception as e:  # nothing landed yet
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
        raise
    return df.select(C.normalize_path("path", encoded=False).alias("path"), "length", "modificationTime").orderBy("path")


def csv_scan(spark: SparkSession, paths, prefix: str = K.RAW_PREFIX) -> DataFrame:
    """Tick CSV rows with ``_corrupt`` text, parsed time, symbol and source file.

    PERMISSIVE mode keeps malformed lines (too few/many fields, bad
    numbers) as rows with ``_corrupt`` set; a bad timestamp string shows up
    as a null ``DateTime_ts`` instead, so callers test both.
    """
    schema = T.StructType(TICK_CSV_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    df = spark.read.schema(schema).option("header", "true").option("enforceSchema", "true") \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL) \
        .option("recursiveFileLookup", "true").csv(paths)
    return tick_rows(df, prefix)


def tick_rows(df: DataFrame, prefix: str = K.RAW_PREFIX) -> DataFrame:
    """Raw CSV columns plus parsed time, path symbol and source file (batch or stream)."""
    fp = F.col("_metadata.file_path")
    return df.select(
        "DateTime", "Bid", "Ask", CORRUPT_COL,
        C.parse_ts_text("DateTime").alias("DateTime_ts"),
        F.upper(C.path_symbol(C.normalize_path(fp), prefix, encoded=False)).alias("symbol"),
        C.normalize_path(fp).alias("source_file"),
    )


def raw_scan(spark: SparkSession, root: str, prefix: str = K.PARQUET_PREFIX) -> DataFrame:
    """External-table view of tick Parquet below ``root/prefix``.

    Recursive lookup (the folders are not ``k=v`` only), explicit schema,
    and the symbol taken from each file's path.
    """
    df = spark.read.schema(RAW_TICK_SCHEMA).option("recursiveFileLookup", "true") \
        .parquet(f"{root.rstrip('/')}/{prefix}")
    return df.select("DateTime", "Bid", "Ask",
                     F.upper(C.path_symbol(C.normalize_path(F.col("_metadata.file_path")), prefix, encoded=False)).alias("symbol"))
