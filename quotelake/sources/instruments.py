"""Instrument list that is read anew each time it is scanned.

A stream joined to an ordinary file scan keeps the file listing of its start.
This data source lists and reads when a micro-batch is planned, so a symbol
whose market closes or opens counts from the next batch on.  The list is a
dimension: it refuses to grow beyond ``max_rows``, which bounds its broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .storage import listed, open_store

FORMAT = "instruments"
SCHEMA = "symbol string, trade_mode int"
#: Most instruments of a list.
MAX_ROWS = 100_000


class Instruments(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return InstrumentReader(self.options["path"], int(self.options.get("max_rows", MAX_ROWS)))


class InstrumentReader(DataSourceReader):
    def __init__(self, path: str, max_rows: int):
        self.path, self.max_rows = path, max_rows

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(None)]

    def read(self, partition) -> Iterator[tuple]:
        import pyarrow.parquet as pq

        store, root = open_store(self.path)
        left = self.max_rows
        for info in listed(store, root, ".parquet"):
            table = pq.read_table(info.path, columns=["symbol", "trade_mode"], filesystem=store)
            left -= table.num_rows
            if left < 0:
                raise ValueError(f"{self.path} holds more than {self.max_rows} instruments")
            for symbol, mode in zip(table.column("symbol").to_pylist(), table.column("trade_mode").to_pylist()):
                if symbol is not None:
                    yield symbol.upper(), mode


def instruments(spark: SparkSession, path: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """symbol (upper case), trade_mode of the Parquet files in ``path`` at the time of each scan."""
    spark.dataSource.register(Instruments)
    return spark.read.format(FORMAT).option("max_rows", max_rows).load(path)
