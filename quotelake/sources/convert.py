"""CSV → Parquet conversion with quarantine and a ledger of converted files
(S3, S4, S8, S9, S11, J4, E1, E2, A9).

Both forms write batches.  A batch is a micro-batch of the stream or a chunk
of the batch form's backlog, and has a name:

* good rows below ``<parquet prefix>/symbol=…/batch=…``,
* bad rows below ``_quarantine/batch=…``,
* last, one row for each file version below ``_ledger/batch=…``: the commit.

A batch replaces its own folders, so a replayed micro-batch changes nothing.
``read_converted`` and ``read_quarantine`` show what a committed batch wrote
for the latest version of each file: rows of a batch that died before its
commit, or of a file that was corrected since, are not seen.
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..operators.joins import checkpointed, join_dimension
from . import files as S
from .landing import MAX_FILES, landed_lines

LEDGER_SCHEMA = ("source_file string, modified bigint, status string, n_rows bigint, n_bad bigint, "
                 "run_at timestamp_ntz, batch string")
CONVERTED_SCHEMA = ("DateTime timestamp_ntz, Bid double, Ask double, source_file string, modified bigint, "
                    "symbol string, batch string")
QUARANTINE_SCHEMA = ("DateTime_text string, Bid double, Ask double, _corrupt string, symbol string, source_file string, "
                     "modified bigint, batch string")

# Most file paths converted by one Spark job of the batch conversion.
MAX_FILES_PER_JOB = 10_000


def ledger_path(out_root: str) -> str:
    return f"{out_root.rstrip('/')}/_ledger"


def quarantine_path(out_root: str) -> str:
    return f"{out_root.rstrip('/')}/_quarantine"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_ledger(spark: SparkSession, out_root: str) -> DataFrame:
    """Every version of a file that a committed batch took."""
    return _read(spark, ledger_path(out_root), LEDGER_SCHEMA)


def last_versions(ledger: DataFrame) -> DataFrame:
    """The ledger's last row of each file."""
    cols = ["modified", "run_at", "batch", "status", "n_rows", "n_bad"]
    return ledger.groupBy("source_file").agg(F.max(F.struct(*cols)).alias("v")).select("source_file", "v.*")


def _committed(spark: SparkSession, rows: DataFrame, out_root: str) -> DataFrame:
    """Rows of the last committed version of their file; the file list is broadcast if it is small."""
    last = last_versions(read_ledger(spark, out_root)).select("source_file", "modified", "batch")
    return join_dimension(rows, last, ["source_file", "modified", "batch"], "left_semi")


def read_converted(spark: SparkSession, out_root: str, parquet_prefix: str = K.PARQUET_PREFIX) -> DataFrame:
    """DateTime, Bid, Ask, symbol, source_file of the converted ticks, each file's last version once."""
    rows = _read(spark, f"{out_root.rstrip('/')}/{parquet_prefix}", CONVERTED_SCHEMA)
    return _committed(spark, rows, out_root).select("DateTime", "Bid", "Ask", "symbol", "source_file")


def read_quarantine(spark: SparkSession, out_root: str) -> DataFrame:
    """The bad rows of each file's last version."""
    rows = _read(spark, quarantine_path(out_root), QUARANTINE_SCHEMA)
    return _committed(spark, rows, out_root).drop("modified", "batch")


def unconverted_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files with no ledger entry (J4); both sides use normalised paths.

    A failed file counts as done only as long as it has not changed since:
    a corrected file at the same path is converted again.
    """
    last = last_versions(ledger).select(F.col("source_file").alias("path"), F.col("modified").alias("_then"), "status")
    if "modificationTime" not in listing.columns:
        return listing.join(last.select("path"), "path", "left_anti")
    changed = (F.col("status") == "failed") & (F.unix_micros("modificationTime") > F.col("_then"))
    return listing.join(last, "path", "left").where(F.col("status").isNull() | changed).drop("_then", "status")


def split_quarantine(rows: DataFrame):
    """``(good, bad)``: bad = malformed line or unparsable timestamp."""
    bad = F.col(S.CORRUPT_COL).isNotNull() | F.col("DateTime_ts").isNull()
    return rows.filter(~bad), rows.filter(bad)


def write_converted(rows: DataFrame, files: DataFrame, out_root: str, parquet_prefix: str, run_at: str, batch: str) -> None:
    """Write one batch: good rows, bad rows, then its ledger rows.

    ``rows`` (as from ``csv_scan``, with ``modified``) is read three times, so
    it should be persisted; ``files`` has ``source_file, modified`` of every
    file version of the batch, also of those without rows.
    """
    def replace(df, path, *keys):
        df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(*keys, "batch").parquet(path)

    good, bad = split_quarantine(rows)
    replace(good.select(F.col("DateTime_ts").alias("DateTime"), "Bid", "Ask", "source_file", "modified", "symbol")
            .hint("rebalance", "symbol"), f"{out_root.rstrip('/')}/{parquet_prefix}", "symbol")
    replace(bad.select(F.col("DateTime").alias("DateTime_text"), "Bid", "Ask", S.CORRUPT_COL, "symbol", "source_file",
                       "modified"), quarantine_path(out_root))
    is_bad = F.col(S.CORRUPT_COL).isNotNull() | F.col("DateTime_ts").isNull()
    per_file = rows.groupBy("source_file", "modified").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(is_bad).alias("n_bad"))
    zero = F.lit(0).cast("bigint")
    done = files.select("source_file", "modified").distinct().join(per_file, ["source_file", "modified"], "left").select(
        "source_file", "modified", F.when(F.coalesce("n_bad", zero) > 0, "failed").otherwise("converted").alias("status"),
        F.coalesce("n_rows", zero).alias("n_rows"), F.coalesce("n_bad", zero).alias("n_bad"),
        F.lit(run_at).cast("timestamp_ntz").alias("run_at"))
    replace(done, ledger_path(out_root))


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")


def line_rows(lines: DataFrame, raw_prefix: str = K.RAW_PREFIX) -> DataFrame:
    """``landed_lines`` → the columns of ``csv_scan`` and ``modified``; lines are parsed by Spark's CSV parser."""
    schema = "DateTime string, Bid double, Ask double, _corrupt string"
    parsed = F.from_csv(F.col("line"), F.lit(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COL})
    rows = lines.where("line is not null").select("path", "modified", parsed.alias("r")).select("path", "modified", "r.*")
    return rows.select("DateTime", "Bid", "Ask", S.CORRUPT_COL, C.parse_ts_text("DateTime").alias("DateTime_ts"),
                       F.upper(C.path_symbol("path", raw_prefix, encoded=False)).alias("symbol"),
                       C.normalize_path("path", encoded=False).alias("source_file"), "modified")


def csv_to_parquet_stream(spark: SparkSession, landing_root: str, out_root: str, checkpoint: str,
                          raw_prefix: str = K.RAW_PREFIX, parquet_prefix: str = K.PARQUET_PREFIX,
                          max_files_per_trigger: int = MAX_FILES, settle_ms: int = 0,
                          fail_on_error: bool = False) -> None:
    """Convert landed CSV files as a stream of file versions, each version once.

    Takes what has landed since the checkpoint and stops.  A file that was
    corrected in place is a new version and is converted again, in place of
    its old rows.  No path list passes through the driver beyond the source's
    listing.  With ``fail_on_error`` a run raises after writing if the last
    version of any file is failed.
    """
    from ..streaming.ticks import run_batches

    # batch names are the checkpoint's own, so a new checkpoint never writes over another's batches
    name = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def each(batch: DataFrame, epoch: int) -> None:
        lines = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            files = lines.where("line is null").select(C.normalize_path("path", encoded=False).alias("source_file"), "modified")
            rows = line_rows(lines, raw_prefix)
            write_converted(rows, files, out_root, parquet_prefix, _now(), f"{name}-{epoch}")
        finally:
            lines.unpersist()

    lines = landed_lines(spark, f"{landing_root.rstrip('/')}/{raw_prefix}", max_files=max_files_per_trigger, settle_ms=settle_ms)
    run_batches(lines, each, checkpoint, "drain")
    if fail_on_error:
        _raise_failed(last_versions(read_ledger(spark, out_root)), out_root)


def _raise_failed(statuses: DataFrame, out_root: str) -> None:
    n_failed = statuses.filter(F.col("status") == "failed").count()
    if n_failed:
        raise RuntimeError(f"{n_failed} file(s) failed; bad rows are in {quarantine_path(out_root)}")


def csv_to_parquet(spark: SparkSession, landing_root: str, out_root: str,
                   raw_prefix: str = K.RAW_PREFIX, parquet_prefix: str = K.PARQUET_PREFIX,
                   listing: DataFrame | None = None, fail_on_error: bool = True,
                   max_files_per_job: int = MAX_FILES_PER_JOB) -> DataFrame:
    """Convert every not-yet-converted CSV file; return one status row per listed file.

    ``status`` is ``converted``, ``failed`` (some rows quarantined; the good
    rows are still converted) or ``skipped`` (already in the ledger).  With
    ``fail_on_error`` the run raises after writing if any file failed.

    The landing is listed once (checkpointed).  New files are converted in
    jobs of at most ``max_files_per_job`` paths, so the driver never holds
    more than one chunk of names, however large the backlog.
    """
    if listing is None:
        listing = S.list_files(spark, f"{landing_root.rstrip('/')}/{raw_prefix}", "*.csv")
    listing = checkpointed(listing.select(*[c for c in ("path", "modificationTime") if c in listing.columns]))
    timed = "modificationTime" in listing.columns
    run_at = _now()
    prev, chunk = None, 0
    while True:
        todo = unconverted_files(listing, read_ledger(spark, out_root)).limit(max_files_per_job)
        found = sorted((r[0], r[1]) for r in todo.select(                    # bounded by max_files_per_job
            "path", F.unix_micros("modificationTime") if timed else F.lit(0).cast("bigint")).collect())
        if not found:
            break
        if found == prev:
            raise RuntimeError("converted files were not recorded in the ledger; stopping")
        files = spark.createDataFrame(found, "source_file string, modified bigint")
        rows = S.csv_scan(spark, [p for p, _ in found], raw_prefix).join(F.broadcast(files), "source_file") \
            .persist(StorageLevel.MEMORY_AND_DISK)                            # the bounded list just made
        name = f"run-{hashlib.sha256(f'{run_at} {chunk}'.encode()).hexdigest()[:12]}"
        write_converted(rows, files, out_root, parquet_prefix, run_at, name)
        rows.unpersist()
        if len(found) < max_files_per_job:
            break
        prev, chunk = found, chunk + 1
    # With nothing new every listed file is reported as skipped.
    led = last_versions(read_ledger(spark, out_root)).withColumnRenamed("source_file", "path")
    # a failed file that has not changed is still failed
    this_run = (F.col("run_at") == F.lit(run_at).cast("timestamp_ntz")) | (F.col("status") == "failed")
    result = listing.join(led, "path", "left").select(
        "path",
        F.when(this_run, F.col("status")).otherwise(F.lit("skipped")).alias("status"),
        F.when(this_run, F.col("n_rows")).alias("n_rows"),
        F.when(this_run, F.col("n_bad")).alias("n_bad"))
    if fail_on_error:
        _raise_failed(result, out_root)
    return result


def conversion_summary(statuses: DataFrame) -> DataFrame:
    """Files per status plus a ``total`` row."""
    return statuses.select("status").rollup("status") \
        .agg(F.count(F.lit(1)).alias("n_files")) \
        .select(F.coalesce("status", F.lit("total")).alias("status"), "n_files")


def target_keys(keys: DataFrame, key_col: str = "key", raw_prefix: str = K.RAW_PREFIX,
                parquet_prefix: str = K.PARQUET_PREFIX) -> DataFrame:
    """Source key → Parquet key."""
    return keys.select(key_col, C.target_key(key_col, raw_prefix, parquet_prefix).alias("target_key"))
