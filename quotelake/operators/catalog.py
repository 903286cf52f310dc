"""Lasting catalog objects of a curated tick table.

``publish`` puts a versioned table into a database of the session catalog:

* ``<name>_rows_<layout>``: an external Parquet table, partitioned by ``valid_from`` and the layout's columns;
* ``<name>_versions``, ``<name>_ends``, ``<name>_current``: its logs;
* ``<name>``: a view of the rows the current version sees, worked out from the
  logs when it is read, so an ingest or a rollback shows without a new view;
* ``ticks_<symbol>[_spread]``: a view for each symbol, a filter on the partition
  column that Spark prunes by.

All of them are plain SQL over catalog tables: any session of the catalog reads
them, without this library.  (As with any file table, a session that has read
them before sees files that another one added after ``REFRESH TABLE``.)  After an ingest ``publish`` adds the new
partitions and the views of new symbols; what is there already stays.

The catalog allows letters, digits and ``_`` in names.  A symbol with other
characters has them replaced by ``_`` and a short hash added, so that
``EURUSD.m`` and ``EURUSD_m`` keep views of their own.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..session import hadoop_exists
from . import versions as V

LOGS = {"versions": V.VERSIONS, "ends": V.ENDS, "current": V.CURRENT}


def table_name(symbol: str, spread: bool = False) -> str:
    """``ticks_<lower symbol>[_spread]``, as the catalog takes it."""
    low = symbol.lower()
    plain = re.sub(r"\W", "_", low, flags=re.ASCII)
    if plain != low:
        plain += "_" + hashlib.sha256(low.encode()).hexdigest()[:8]
    return K.TABLE_PREFIX + plain + ("_spread" if spread else "")


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (S12); ``location`` keeps it off the local warehouse."""
    loc = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}{loc}")


def _name(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _external(spark: SparkSession, database: str, name: str, columns: list[str], path: str, keys=()) -> str:
    """An external Parquet table, made again only if its columns have changed; returns its quoted name."""
    full = _name(database, name)
    wanted = [c.replace("`", "") for c in columns]
    if spark.catalog.tableExists(f"{database}.{name}"):
        have = [f"{f.name} {f.dataType.simpleString()}" for f in spark.table(f"{database}.{name}").schema.fields]
        if sorted(have) == sorted(wanted):
            spark.catalog.refreshTable(f"{database}.{name}")
            return full
        spark.sql(f"DROP TABLE {full}")  # external: the files stay
    by = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
    spark.sql(f"CREATE TABLE {full} ({', '.join(columns)}) USING parquet{by} LOCATION {_text(path)}")
    return full


def _types(schema: str) -> list[str]:
    from pyspark.sql.types import _parse_datatype_string

    return [f"`{f.name}` {f.dataType.simpleString()}" for f in _parse_datatype_string(f"struct<{schema}>").fields]


def publish(table: V.VersionedRows, database: str, name: str = "gold", spread: bool = False, location: str | None = None) -> list:
    """Create or bring up to date the objects of a table; returns the names of the symbols' views."""
    spark, at = table.spark, table.version()
    create_database(spark, database, location)
    for log, schema in LOGS.items():
        path = f"{table.root}/{log}"
        if not hadoop_exists(spark, path):  # nothing ended, or nothing current yet
            spark.createDataFrame([], schema).write.parquet(path)
        _external(spark, database, f"{name}_{log}", _types(schema), path)
    columns = [(c["name"], c["stored"], c["type"]) for c in at["columns"]]
    specs = {r["layout"]: r["spec"] for r in table.versions().select("layout", "spec").distinct().collect()}
    selects = []
    for layout in sorted(specs):
        path = f"{table.root}/rows_{layout}"
        if not hadoop_exists(spark, path):
            continue
        keys = ["valid_from", *[s.split("=")[0] for s in specs[layout]]]
        typed = {"valid_from": "bigint"} | {stored: kind for _, stored, kind in columns}
        typed |= {k: "string" for k in keys if k not in typed}
        full = _external(spark, database, f"{name}_rows_{layout}", [f"`{n}` {t}" for n, t in typed.items()], path, keys)
        spark.sql(f"MSCK REPAIR TABLE {full} ADD PARTITIONS")
        selects.append(f"SELECT valid_from, {', '.join(f'`{stored}` AS `{n}`' for n, stored, _ in columns)} FROM {full}")
    log = {n: _name(database, f"{name}_{n}") for n in LOGS}
    rows = " UNION ALL ".join(selects) or "SELECT CAST(NULL AS BIGINT) AS valid_from, " + ", ".join(
        f"CAST(NULL AS {kind}) AS `{n}`" for n, _, kind in columns) + " WHERE false"
    spark.sql(f"""
        CREATE OR REPLACE VIEW {_name(database, name)} AS
        WITH now AS (SELECT max_by(version, seq) AS v FROM {log['current']}),
             gone AS (SELECT e.valid_from FROM (SELECT valid_from, valid_to, max(until) AS until FROM {log['ends']}
                                                GROUP BY valid_from, valid_to) e
                      JOIN now ON e.valid_to <= now.v AND (e.until IS NULL OR e.until > now.v)),
             seen AS (SELECT c.version FROM {log['versions']} c JOIN now ON c.version <= now.v LEFT ANTI JOIN gone ON c.version = gone.valid_from)
        SELECT {', '.join(f'r.`{n}`' for n, _, _ in columns)} FROM ({rows}) r LEFT SEMI JOIN seen ON r.valid_from = seen.version""")
    return _symbol_views(spark, database, name, spread)


def _symbol_views(spark: SparkSession, database: str, name: str, spread: bool) -> list:
    """A view for each symbol that has none; symbols are read from the partition column."""
    there = {r["viewName"] for r in spark.sql(f"SHOW VIEWS IN {_name(database)}").collect()}
    names = []
    for (symbol,) in spark.table(_name(database, name)).select("symbol").distinct().toLocalIterator():
        if symbol is None:
            continue
        view = table_name(symbol, spread)
        names.append(view)
        if view not in there:  # one catalog entry a symbol
            spark.sql(f"CREATE VIEW {_name(database, view)} AS SELECT * FROM {_name(database, name)} WHERE symbol = {_text(symbol)}")
    return sorted(names)


def tick_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names in the database that start with ``ticks_``, in order."""
    return spark.sql(f"SHOW TABLES IN {_name(database)}").where(F.col("tableName").startswith(K.TABLE_PREFIX)) \
        .select("tableName").orderBy("tableName")
