"""Named-file sink: exactly ``prefix/SYM/SYM_yyyyMMdd_HHmm.csv``, each replaced as a whole.

A Python data source.  Every task writes the files of its keys below
``prefix/_staging`` and reports them; the job's commit moves them to their
names, an abort removes them.  A task that is run again writes its own copy,
so only files of the successful attempts are moved.  A job that dies leaves at
most a staging folder, which readers skip and the next commit of the same job
name removes; repeating it replaces the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .. import constants as K
from ..functions import columns as C
from .storage import open_store

FORMAT = "tick_files"
HEADER = ",".join(K.CSV_COLUMNS) + "\n"


@dataclass
class Staged(WriterCommitMessage):
    """What one task wrote: (staged path, final path) and the rows of all its files."""

    moves: list = field(default_factory=list)
    rows: int = 0


class TickFiles(DataSource):
    """Rows ``symbol, window_key, DateTime, Bid, Ask`` (texts, doubles), sorted by the first three."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "symbol string, window_key string, DateTime string, Bid double, Ask double"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return TickFileWriter(self.options["path"], self.options.get("prefix", K.RAW_PREFIX),
                              self.options.get("job", "write"))


def _text(value) -> str:
    return "" if value is None else repr(value)


class TickFileWriter(DataSourceWriter):
    def __init__(self, root: str, prefix: str, job: str):
        self.root = f"{root.rstrip('/')}/{prefix}"
        self.staging = f"{self.root}/_staging"
        self.job = f"{job}~{uuid.uuid4().hex[:12]}"

    def write(self, iterator: Iterator) -> Staged:
        store, root = open_store(self.root)
        attempt = f"{open_store(self.staging)[1]}/{self.job}/{uuid.uuid4().hex[:12]}"
        store.create_dir(attempt, recursive=True)
        done, key, out = Staged(), None, None
        try:
            for symbol, window_key, at, bid, ask in iterator:
                if (symbol, window_key) != key:
                    if out is not None:
                        out.close()
                    key = symbol, window_key
                    name = f"{symbol}_{window_key}.csv"
                    staged = f"{attempt}/{len(done.moves)}-{name}"
                    out = store.open_output_stream(staged)
                    out.write(HEADER.encode())
                    done.moves.append((staged, f"{root}/{symbol}/{name}"))
                out.write(f"{at},{_text(bid)},{_text(ask)}\n".encode())
                done.rows += 1
        finally:
            if out is not None:
                out.close()
        return done

    def commit(self, messages: list) -> None:
        store, root = open_store(self.root)
        moves = [m for message in messages if message is not None for m in message.moves]
        for folder in {final.rsplit("/", 1)[0] for _, final in moves}:
            store.create_dir(folder, recursive=True)
        for staged, final in moves:
            store.move(staged, final)
        self._clear(store)

    def abort(self, messages: list) -> None:
        self._clear(open_store(self.root)[0])

    def _clear(self, store) -> None:
        """Remove this job's staging, also what earlier runs under its name left."""
        from pyarrow import fs

        name = self.job.split("~")[0]
        folder = open_store(self.staging)[1]
        for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if info.base_name.split("~")[0] == name:
                store.delete_dir(info.path)
        if not store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if store.get_file_info(folder).type == fs.FileType.Directory:
                store.delete_dir(folder)


def write_named_csv(ticks: DataFrame, root: str, prefix: str = K.RAW_PREFIX, job: str = "write",
                    tiebreak: str | None = None) -> None:
    """One CSV for each symbol (in upper case) and ``window_key``, its ticks in order of time.

    ``ticks`` has symbol, window_key, DateTime (timestamp or text), Bid, Ask.
    All ticks of a key go to one task, as one file needs; it writes them from
    a sorted stream, so a long window costs time but no memory.  Rows without
    a symbol or key have no file and are left out.
    """
    ticks.sparkSession.dataSource.register(TickFiles)
    text = F.col("DateTime") if dict(ticks.dtypes)["DateTime"] == "string" else C.ts_text("DateTime")
    rows = ticks.where("symbol is not null and window_key is not null").select(
        F.upper("symbol").alias("symbol"), "window_key", text.alias("DateTime"), F.col("Bid").cast("double").alias("Bid"),
        F.col("Ask").cast("double").alias("Ask"), (F.col(tiebreak) if tiebreak else F.lit(0)).alias("_tie"))
    rows.repartition("symbol", "window_key").sortWithinPartitions("symbol", "window_key", "DateTime", "_tie").drop("_tie") \
        .write.format(FORMAT).option("prefix", prefix).option("job", job).mode("append").save(root)
