"""Structured Streaming form of the tick pipeline.

The terminal poll loop becomes a file-source stream over a landing folder:
offsets in the checkpoint replace the per-symbol cursor (R2) and the trigger
replaces the poll interval (R1).  Sinks are the exactly-once file sink or
``foreachBatch`` with an idempotent merge (R8).  Windows, the cap and late
ticks (R4–R7) are state of ``collector.Collector``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gold as G
from ..operators import ticks as TK
from ..operators.joins import checkpointed, join_dimension
from ..session import hadoop_exists

TICK_STREAM_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("DateTime", T.TimestampNTZType()),
    T.StructField("time_msc", T.LongType()),
    T.StructField("flags", T.IntegerType()),
    T.StructField("Bid", T.DoubleType()),
    T.StructField("Ask", T.DoubleType()),
])


def tick_stream(spark: SparkSession, landing: str, schema: T.StructType = TICK_STREAM_SCHEMA,
                fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Ticks landed as files, read incrementally.

    ``max_files_per_trigger`` bounds each micro-batch like the per-poll
    fetch limit; new files are picked up exactly once via the checkpoint.
    """
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(landing)


def _trigger(w, trigger):
    if trigger in (None, "availableNow"):
        return w.trigger(availableNow=True)
    return w.trigger(processingTime=trigger)


def run_to_parquet(df: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                   trigger: str | None = None):
    """Run a stream into an exactly-once Parquet sink (R1); return the query.

    ``trigger=None`` drains what has landed and stops (``availableNow``);
    otherwise a processing-time interval such as ``"500 milliseconds"``.
    """
    q = _trigger(df.writeStream.format("parquet").outputMode(mode)
                 .option("path", sink).option("checkpointLocation", checkpoint), trigger).start()
    if trigger in (None, "availableNow"):
        q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def run_batches(stream: DataFrame, each, checkpoint: str, trigger: str | None = None):
    """Run ``each(batch, epoch)`` on every micro-batch; return the query.

    ``trigger="drain"`` polls until nothing new comes and stops: the way to
    drain a source that hands out a bounded poll at a time.
    """
    if trigger == "drain":
        q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint) \
            .trigger(processingTime="0 seconds").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        if q.exception():
            raise q.exception()
        return q
    q = _trigger(stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint), trigger).start()
    if trigger in (None, "availableNow"):
        q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


# ------------------------------------------------------------ operators ---

def changes_only(stream: DataFrame) -> DataFrame:
    """Bid/ask-change filter on a stream (F1 on R1)."""
    return TK.flag_filter(stream)


def first_per_second_to(stream: DataFrame, sink: str, checkpoint: str, tiebreak: str = "event_id",
                        trigger: str | None = None):
    """Keep the first tick per (symbol, UTC second) in ``sink``, one row each, whatever order ticks come in.

    The sink is partitioned by hour.  A micro-batch reads the hours it has
    ticks of, takes the first of old and new ticks, and replaces these hours;
    no other hour is read, and nothing is dropped by a watermark.  The first
    of a second does not change when a batch is repeated, so a replay changes
    nothing.  Ticks without a time are not taken.
    """
    sink = sink.rstrip("/")

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        new = TK.first_per_second(batch.where("DateTime is not null"), order=("DateTime", tiebreak))
        new = checkpointed(new.withColumn("hour", F.date_format("DateTime", "yyyyMMddHH")))
        if hadoop_exists(spark, sink):
            hours = new.select("hour").distinct()
            old = spark.read.schema(new.schema).parquet(sink)
            new = checkpointed(TK.first_per_second(new.unionByName(join_dimension(old, hours, "hour", "left_semi")),
                                                   order=("DateTime", tiebreak)))
        new.hint("rebalance", "hour").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("hour").parquet(sink)

    return run_batches(stream, each, checkpoint, trigger)


def read_first_per_second(spark: SparkSession, sink: str, schema: T.StructType = TICK_STREAM_SCHEMA) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("hour", T.StringType())])).parquet(sink).drop("hour")


def merge_stream_into_gold(stream: DataFrame, table, checkpoint: str, spread: bool = False,
                           trigger: str | None = None, quarantine: str | None = None) -> None:
    """Idempotent merge of each micro-batch into a gold table.

    A replayed batch after a failure inserts nothing twice, because the
    merge only inserts keys the table does not hold yet.  Rows with a null
    key can't be merged; with ``quarantine`` they are written there (D-4).
    """
    def each(batch: DataFrame, epoch: int) -> None:
        # The ingest reads its source twice (pruning bounds, then the anti
        # join); keep the micro-batch so the landed files are read once.
        rows = batch.select("DateTime", "Bid", "Ask", "symbol").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            done = G.ingest(table, rows, spread=spread)
            if quarantine is not None:
                # one folder for each epoch: a replayed epoch replaces its own
                done["null_keys"].write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/epoch={epoch}")
        finally:
            rows.unpersist()

    run_batches(stream, each, checkpoint, trigger)
