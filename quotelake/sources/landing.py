"""Landed CSV files as a stream of their lines, by modification time.

Spark's own file stream takes a path once, so a file that is corrected in place
never comes again.  The offset of this source is the (modification time, path)
it has come to: a file that changes gets a later time and is a new version,
which the stream takes like a new file.  Offsets lie in the query's checkpoint.

Files are listed where the query is planned, as Spark's file stream does, at
most ``max_files`` a micro-batch are taken, and tasks read about ``task_bytes``
each.  A file becomes visible ``settle_ms`` after its last change, so writers
whose clocks differ by less can't slip a file in behind the offset.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .storage import listed, open_store

FORMAT = "landed_lines"
SCHEMA = "path string, modified bigint, line string"
MAX_FILES = 10_000
TASK_BYTES = 64 << 20
#: Bytes of a file read and split together.
CHUNK = 4 << 20


class LandedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        o = self.options
        return LandedReader(o["path"], o.get("suffix", ".csv"), int(o.get("max_files", MAX_FILES)),
                            int(o.get("settle_ms", 0)), int(o.get("task_bytes", TASK_BYTES)))


class Files(InputPartition):
    def __init__(self, files: list):
        self.value = files


class LandedReader(DataSourceStreamReader):
    def __init__(self, root: str, suffix: str, max_files: int, settle_ms: int, task_bytes: int):
        self.root, self.suffix, self.max_files = root, suffix, max_files
        self.settle, self.task_bytes, self.at = settle_ms, task_bytes, None

    def initialOffset(self) -> dict:
        return {"modified": -1, "path": ""}

    def _between(self, start: dict, end: dict | None) -> list[tuple[int, str, int]]:
        """(modified in us, path, bytes) of the file versions after ``start``, in order."""
        store, root = open_store(self.root)
        lo = (start["modified"], start["path"])
        hi = (end["modified"], end["path"]) if end else (int((time.time() * 1000 - self.settle) * 1000), "\U0010ffff")
        found = sorted((f.mtime_ns // 1000, f.path, f.size) for f in listed(store, root, self.suffix))
        return [f for f in found if lo < f[:2] <= hi]

    def latestOffset(self) -> dict:
        at = self.at or self.initialOffset()
        taken = self._between(at, None)[: self.max_files]
        return {"modified": taken[-1][0], "path": taken[-1][1]} if taken else at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = end  # after a restart Spark names the offset it had come to by an empty range
        out, size = [], self.task_bytes
        for modified, path, length in self._between(start, end) if start != end else []:
            if size >= self.task_bytes:
                out.append(Files([]))
                size = 0
            out[-1].value.append((path, modified))
            size += length + 1
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.root)
        for path, modified in partition.value:
            # one row without a line, so that a file without ticks is known too
            yield _rows(path, modified, [None])
            for lines in _lines(store, path):
                if lines:
                    yield _rows(path, modified, lines)


def _rows(path: str, modified: int, lines: list) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array([modified] * n, pa.int64()),
                                       pa.array(lines, pa.string())], ["path", "modified", "line"])


def _lines(store, path: str) -> Iterator[list[str]]:
    """The lines after the header that are not blank, some at a time."""
    rest, header = b"", True
    with store.open_input_stream(path) as f:
        while True:
            data = f.read(CHUNK)
            parts = (rest + data).split(b"\n")
            rest = parts.pop() if data else b""
            if header and parts:
                parts, header = parts[1:], False
            yield [t for t in (p.decode("utf-8", "replace").rstrip("\r") for p in parts) if t.strip()]
            if not data:
                return


def landed_lines(spark: SparkSession, root: str, suffix: str = ".csv", max_files: int = MAX_FILES,
                 settle_ms: int = 0) -> DataFrame:
    """Stream of path, modified (us), line; a row with a null line opens each version of a file."""
    spark.dataSource.register(LandedLines)
    return spark.readStream.format(FORMAT).option("suffix", suffix).option("max_files", max_files) \
        .option("settle_ms", settle_ms).load(root)
