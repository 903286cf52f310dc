"""Tables whose rows carry a version interval.

A commit adds rows; they are visible from its version on (``valid_from``) until
the version that ends them (``valid_to``), if any.  So a read at a version is a
range filter on plain Parquet rows, and what was current at a time is a lookup
in the log of current versions.  Four plain tables lie below the root:

* ``rows_<layout>``: the data, partitioned by ``valid_from`` and the layout's columns;
* ``versions``: one row a commit (parent, time, operation, rows added, total, columns, layout);
* ``ends``: ``valid_from, valid_to`` of commits that are visible no longer: those
  a rollback left behind end with the next commit, a compaction ends all before
  it.  If that compaction is itself left behind, they are visible again from
  ``until`` on;
* ``current``: which version was made current when (a rollback adds a row).

Columns are listed per version with the name they are stored under, so a column
can be renamed, widened or dropped and comes back empty when added again.

A commit writes rows, then ends, then its version, then makes it current; what a
writer left that died in between is not visible and is replaced by the next.
One writer at a time.  Only single rows and bounded id lists reach the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import hadoop_delete, hadoop_exists
from .joins import checkpointed, fits

COLUMNS = "array<struct<name: string, stored: string, type: string>>"
VERSIONS = (f"version bigint, parent bigint, committed_at timestamp_ntz, operation string, added bigint, deleted bigint, "
            f"total bigint, layout int, spec array<string>, columns {COLUMNS}")
ENDS = "valid_from bigint, valid_to bigint, until bigint"
CURRENT = "seq bigint, at timestamp_ntz, version bigint"

#: Commits up to which a read names its partitions one by one.
MAX_STATIC_COMMITS = 1000

#: Types a column may be widened to without rewriting rows.
WIDER = {("int", "bigint"), ("float", "double"), ("int", "double")}


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _type(text: str) -> str:
    return T._parse_datatype_string(text).simpleString()


def _ntz(t: _dt.datetime | str) -> Column:
    return F.lit(t if isinstance(t, str) else t.isoformat(sep=" ")).cast("timestamp_ntz")


class VersionedRows:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -------------------------------------------------------- its tables --

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path) if hadoop_exists(self.spark, path) \
            else self.spark.createDataFrame([], schema)

    def _log(self, name: str, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def versions(self) -> DataFrame:
        return self._table("versions", VERSIONS)

    def ends(self) -> DataFrame:
        return self._table("ends", ENDS).groupBy("valid_from", "valid_to").agg(F.max("until").alias("until"))

    def hidden(self, version: int) -> DataFrame:
        """``ends`` rows of the commits whose rows a version does not see any more."""
        return self.ends().where((F.col("valid_to") <= version) & (F.col("until").isNull() | (F.col("until") > version)))

    def exists(self) -> bool:
        return hadoop_exists(self.spark, f"{self.root}/versions")

    def create(self, schema: str, partition_by=(), spec=None) -> None:
        """Create the table if it is absent; ``spec`` entries are columns or ``name=expression``."""
        if self.exists():
            return
        fields = T._parse_datatype_string(f"struct<{schema}>" if not schema.startswith("struct") else schema).fields
        columns = [(f.name, f.name, f.dataType.simpleString()) for f in fields]
        self._log("versions", self.spark.createDataFrame(
            [(0, None, None, "create", None, None, 0, 0, list(spec or partition_by), columns)], VERSIONS))

    # ------------------------------------------------------------ versions --

    def version(self, version: int | None = None):
        """The row of a version (default: the current one); an unknown version raises."""
        if version is None:
            found = self._table("current", CURRENT).agg(F.max_by("version", "seq")).first()[0]
            version = 0 if found is None else found
        row = self.versions().where((F.col("version") == version) & (F.col("operation") != "forgotten")).first()
        if row is None:
            raise ValueError(f"{self.root} has no version {version}")
        return row

    def current_version(self) -> int:
        return self.version()["version"]

    def version_at(self, ts) -> int:
        """The version that was current at ``ts`` (V3); a time before the first raises."""
        found = self._table("current", CURRENT).where(F.col("at") <= _ntz(ts)).agg(F.max_by("version", "seq")).first()[0]
        if found is None:
            raise ValueError(f"no version of {self.root} was current at {ts}")
        return found

    def visible(self, version: int) -> DataFrame:
        """valid_from of the commits whose rows are visible at a version."""
        commits = self.versions().where((F.col("version") <= version) & (F.col("added") > 0))
        gone = self.hidden(version).select(F.col("valid_from").alias("version"))
        return commits.join(gone, "version", "left_anti").select(F.col("version").alias("valid_from"), "layout")

    def snapshots(self) -> DataFrame:
        """Commits with rows added, deleted and in total as text, oldest first."""
        return self.versions().where("version > 0 and operation <> 'forgotten'").select(
            F.col("version").alias("snapshot_id"), "committed_at", "operation",
            *[F.col(c).cast("string").alias(c) for c in ("added", "deleted", "total")]).orderBy("committed_at", "snapshot_id")

    def listing(self) -> DataFrame:
        """The same as a report shows it: no count of added rows is ``0``, no total is ``?``."""
        return self.snapshots().select("snapshot_id", "committed_at", "operation", F.coalesce("added", F.lit("0")).alias("added"),
                                       F.coalesce("deleted", F.lit("0")).alias("deleted"), F.coalesce("total", F.lit("?")).alias("total"))

    # --------------------------------------------------------------- reading --

    def _scan(self, columns, commits: DataFrame) -> DataFrame:
        """Rows of these commits (``valid_from, layout``) under the columns' names, with ``valid_from``."""
        commits = checkpointed(commits)
        few = fits(commits, MAX_STATIC_COMMITS)
        layouts = commits.select("layout").distinct().collect()  # as many as the layout was changed
        specs = {r["layout"]: r["spec"] for r in self.versions().select("layout", "spec").distinct().collect()}
        stored = [f"`{c['stored']}` {c['type']}" for c in columns]
        parts = []
        for (layout,) in sorted(layouts):
            base, mine = f"{self.root}/rows_{layout}", commits.where(F.col("layout") == layout).select("valid_from")
            extra = [f"`{s.split('=')[0]}` string" for s in specs[layout] if "=" in s]
            read = self.spark.read.schema(", ".join(["valid_from bigint", *stored, *extra])).option("basePath", base)
            if few:  # only the folders of these commits are listed
                ids = sorted(r[0] for r in mine.collect())
                rows = read.parquet(*[f"{base}/valid_from={i}" for i in ids]).where(F.col("valid_from").isin(ids))
            else:
                rows = read.parquet(base).join(F.broadcast(mine) if fits(mine) else mine, "valid_from", "left_semi")
            parts.append(rows.select("valid_from", *[F.col(f"`{c['stored']}`").alias(c["name"]) for c in columns]))
        if not parts:
            schema = ", ".join(["valid_from bigint", *[f"`{c['name']}` {c['type']}" for c in columns]])
            return self.spark.createDataFrame([], schema)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def read(self, version: int | None = None) -> DataFrame:
        """The rows visible at a version (default: the current one) with that version's columns (V2)."""
        v = self.version(version)
        return self._scan(v["columns"], self.visible(v["version"])).drop("valid_from")

    def read_at(self, ts) -> DataFrame:
        return self.read(self.version_at(ts))

    def sample(self, n: int = 10, version: int | None = None, at=None, order=("DateTime", "symbol")) -> DataFrame:
        """The first ``n`` rows by ``order``: now, at a version or at a time (F8, L1)."""
        rows = self.read_at(at) if at is not None else self.read(version)
        return rows.orderBy(*order).limit(n)

    def diff_counts(self, a: int, b: int) -> DataFrame:
        """Rows at two versions and the signed difference, in one pass over the rows."""
        in_a = self.visible(self.version(a)["version"]).withColumn("in_a", F.lit(1))
        in_b = self.visible(self.version(b)["version"]).withColumn("in_b", F.lit(1))
        both = checkpointed(in_a.join(in_b, ["valid_from", "layout"], "full"))
        side = both.select("valid_from", "in_a", "in_b")
        rows = self._scan([], both.select("valid_from", "layout")).join(F.broadcast(side) if fits(side) else side, "valid_from")
        return rows.agg(F.count("in_a").alias("count_a"), F.count("in_b").alias("count_b")) \
            .withColumn("delta", F.col("count_b") - F.col("count_a"))

    def row_diff(self, a: int, b: int, cols=None) -> DataFrame:
        """Rows at ``b`` that are not at ``a``, with multiplicity.

        If nothing of ``a`` ended by ``b`` and the columns are stored alike,
        these are the rows of the commits visible only at ``b``: no shuffle.
        """
        va, vb = self.version(a), self.version(b)
        at_a, at_b = ({c["name"]: (c["stored"], c["type"]) for c in v["columns"]} for v in (va, vb))
        cols = list(cols or [n for n in at_b if n in at_a])
        seen_a, seen_b = self.visible(a), self.visible(b)
        if all(at_a[c] == at_b[c] for c in cols) and not seen_a.join(seen_b, "valid_from", "left_anti").limit(1).count():
            return self._scan(vb["columns"], seen_b.join(seen_a.select("valid_from"), "valid_from", "left_anti")).select(*cols)
        return self.read(b).select(*cols).exceptAll(self.read(a).select(*cols))

    # --------------------------------------------------------------- writing --

    def _write(self, rows: DataFrame, at: dict, layout=None) -> None:
        """Rows (with ``valid_from``) below the layout's folder; each commit has a folder of its own there."""
        keys = [s.split("=")[0] for s in at["spec"]]
        for s in at["spec"]:
            if "=" in s:
                rows = rows.withColumn(s.split("=")[0], F.expr(s.split("=", 1)[1]).cast("string"))
        stored = {c["name"]: c["stored"] for c in at["columns"]}
        rows = rows.withColumnsRenamed({n: s for n, s in stored.items() if n != s})
        rows = layout(rows, keys) if layout else rows.hint("rebalance", "valid_from", *keys)
        rows.write.mode("append").partitionBy("valid_from", *keys).parquet(f"{self.root}/rows_{at['layout']}")

    def _typed(self, df: DataFrame, at: dict) -> list[Column]:
        return [F.col(f"`{c['name']}`").cast(c["type"]).alias(c["name"]) for c in at["columns"]]

    def _next(self) -> int:
        return self.versions().agg(F.max("version")).first()[0] + 1

    def _clear(self, layout: int, version: int) -> None:
        """Remove what a writer that died left under the version to be written."""
        hadoop_delete(self.spark, f"{self.root}/rows_{layout}/valid_from={version}")

    def _commit(self, versions: DataFrame, parent: int, replace: bool = False) -> None:
        """Log commits (rows of ``VERSIONS``, in a line from ``parent``), end what they leave behind, make them current."""
        new = checkpointed(versions)
        first = new.agg(F.min("version")).first()[0]
        ends = self.ends().where("until is null")
        back = checkpointed(ends.where((F.col("valid_to") > parent) & (F.col("valid_to") < first))  # ended by what is left behind
                            .withColumn("until", F.lit(first).cast("bigint")))
        if back.limit(1).count():
            self._log("ends", back)
        left = self.versions().where((F.col("version") < first) & (F.lit(replace) | (F.col("version") > parent)))
        left = left.join(self.hidden(first).select(F.col("valid_from").alias("version")), "version", "left_anti")
        left = checkpointed(left.select(F.col("version").alias("valid_from"), F.lit(first).cast("bigint").alias("valid_to"),
                                        F.lit(None).cast("bigint").alias("until")))
        if left.limit(1).count():
            self._log("ends", left)
        self._log("versions", new)
        seq = self._table("current", CURRENT).agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0]
        order = F.row_number().over(Window.orderBy("version"))  # one row a commit
        self._log("current", new.select((order + seq).cast("bigint").alias("seq"), F.col("committed_at").alias("at"), "version"))

    def _row(self, version, parent, operation, added, deleted, total, at, committed_at, **changes) -> DataFrame:
        at = {"layout": at["layout"], "spec": at["spec"], "columns": at["columns"]} | changes
        return self.spark.createDataFrame([(version, parent, committed_at or _now(), operation, added, deleted, total,
                                            at["layout"], at["spec"], at["columns"])], VERSIONS)

    def append(self, df: DataFrame, committed_at=None) -> int:
        """Add rows as one commit and return its version; nothing to add is no commit."""
        at, version = self.version(), self._next()
        self._clear(at["layout"], version)
        self._write(df.select(*self._typed(df, at), F.lit(version).cast("bigint").alias("valid_from")), at)
        added = self._count(at, version)
        if not added:
            return at["version"]
        self._commit(self._row(version, at["version"], "append", added, None, self._total(at) + added, at, committed_at), at["version"])
        return version

    def _count(self, at: dict, version: int) -> int:
        path = f"{self.root}/rows_{at['layout']}/valid_from={version}"
        return self.spark.read.schema("x int").parquet(path).count() if hadoop_exists(self.spark, path) else 0

    def _total(self, at) -> int:
        """Rows visible at a version; a change of columns does not log its total."""
        if at["total"] is not None:
            return at["total"]
        seen = self.visible(at["version"]).select(F.col("valid_from").alias("version"))
        return self.versions().join(seen, "version", "left_semi").agg(F.coalesce(F.sum("added"), F.lit(0))).first()[0]

    def import_history(self, df: DataFrame, version_col: str, committed_at_col: str) -> list:
        """Load many versions in one write: rows of ``version_col`` v become one commit, in order of v.

        Commit times are the latest ``committed_at_col`` of each, totals a
        windowed sum.  On a fresh table v is the version, else all are shifted
        past the last one.
        """
        at = self.version()
        v, when = F.col(version_col).cast("bigint"), F.max(F.col(committed_at_col).cast("timestamp_ntz"))
        stats = checkpointed(df.groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("added"), when.alias("committed_at")))
        first = stats.agg(F.min("v")).first()[0]
        if first is None:
            return []
        shift = max(0, self._next() - first)
        ids = [r[0] + shift for r in stats.select("v").orderBy("v").collect()]  # the commits, as the caller gets them
        for i in ids:
            self._clear(at["layout"], i)
        self._write(df.select(*self._typed(df, at), (v + shift).alias("valid_from")), at)
        line = Window.orderBy("v")  # one row a commit
        rows = stats.select(
            (F.col("v") + shift).alias("version"), F.coalesce(F.lag("v").over(line) + shift, F.lit(at["version"])).alias("parent"),
            "committed_at", F.lit("append").alias("operation"), "added", F.lit(None).cast("bigint").alias("deleted"),
            (F.sum("added").over(line) + self._total(at)).alias("total"), F.lit(at["layout"]).alias("layout"),
            F.lit(at["spec"]).cast("array<string>").alias("spec"), self._columns(at["columns"]))
        self._commit(rows, at["version"])
        return ids

    def _columns(self, columns) -> Column:
        return F.array(*[F.struct(*[F.lit(c[k]).alias(k) for k in ("name", "stored", "type")]) for c in columns]) \
            .cast(COLUMNS).alias("columns")

    def rollback(self, version: int, at=None) -> None:
        """Make an earlier version current again (V5); later ones stay listed and readable."""
        if not self._is_ancestor(version):
            raise ValueError(f"version {version} is no ancestor of the current one")
        seq = self._table("current", CURRENT).agg(F.max("seq")).first()[0]
        self._log("current", self.spark.createDataFrame([(seq + 1, at or _now(), version)], CURRENT))

    def _is_ancestor(self, version: int) -> bool:
        """Whether the current version descends from this one: it sees its rows, or those a compaction made of them."""
        now = self.current_version()
        self.version(version)
        end = self.hidden(now).where(F.col("valid_from") == version).first()
        if end is None:
            return version <= now
        by = self.version(end["valid_to"])
        return by["operation"] == "replace" and by["parent"] >= version

    def compact(self, sort_cols=(), committed_at=None) -> int:
        """Rewrite the visible rows as one commit, range-partitioned by layout and ``sort_cols``; rows are unchanged."""
        at, version = self.version(), self._next()
        self._clear(at["layout"], version)

        def layout(rows, keys):
            order = [*keys, *sort_cols]
            return rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows.coalesce(1)

        self._write(self.read().withColumn("valid_from", F.lit(version).cast("bigint")), at, layout)
        n = self._count(at, version)
        self._commit(self._row(version, at["version"], "replace", n, n, n, at, committed_at), at["version"], replace=True)
        return version

    def expire(self, older_than) -> DataFrame:
        """Forget versions committed before a time, but for the current one, and drop rows no kept version sees.

        Returns the valid_from of the commits whose rows were dropped.
        """
        now = self.current_version()
        log = checkpointed(self.versions())
        kept = checkpointed(log.where((F.col("version") == now) | (F.col("version") == 0) |
                                      ((F.col("committed_at") >= _ntz(older_than)) & (F.col("operation") != "forgotten"))))
        oldest = kept.where("version > 0").agg(F.coalesce(F.min("version"), F.lit(now))).first()[0]
        gone = self.ends().where((F.col("valid_to") <= oldest) & F.col("until").isNull()).select("valid_from")
        drop = log.where("added > 0").select(F.col("version").alias("valid_from"), "layout").join(gone, "valid_from", "left_semi")
        drop = checkpointed(drop.join(kept.select(F.col("version").alias("valid_from")), "valid_from", "left_anti"))
        # commits that kept versions still see stay in the log, marked as forgotten
        held = log.join(kept.select("version"), "version", "left_anti") \
            .join(drop.select(F.col("valid_from").alias("version")), "version", "left_anti").where("added > 0") \
            .withColumn("operation", F.lit("forgotten"))
        self._replace("versions", kept.unionByName(held))
        for r in drop.toLocalIterator():
            self._clear(r["layout"], r["valid_from"])
        return drop.select("valid_from")

    def _replace(self, name: str, rows: DataFrame) -> None:
        checkpointed(rows).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{name}")

    # --------------------------------------------------------------- columns --

    def _change(self, operation: str, columns, committed_at=None, **changes) -> int:
        at, version = self.version(), self._next()
        columns = [tuple(c[k] for k in ("name", "stored", "type")) if not isinstance(c, tuple) else c for c in columns]
        self._commit(self._row(version, at["version"], operation, None, None, None, at, committed_at, columns=columns, **changes), at["version"])
        return version

    def add_column(self, name: str, dtype: str, committed_at=None) -> int:
        """A new column; rows of before read null, also if a column of this name was dropped (V6)."""
        columns = self.version()["columns"]
        if name in {c["name"] for c in columns}:
            raise ValueError(f"column {name} exists")
        used = self.versions().select(F.explode("columns.stored").alias("s")).distinct().where(F.col("s").startswith(name))
        taken = {r[0] for r in used.collect()}  # columns that had this name
        stored = next(s for s in [name, *(f"{name}~{k}" for k in range(2, len(taken) + 3))] if s not in taken)
        return self._change("add column", [*columns, (name, stored, _type(dtype))], committed_at)

    def drop_column(self, name: str, committed_at=None) -> int:
        """A column less; earlier versions still show it (V7)."""
        self._column(name)
        return self._change("drop column", [c for c in self.version()["columns"] if c["name"] != name], committed_at)

    def change_column(self, old: str, new: str | None = None, dtype: str | None = None, committed_at=None) -> int:
        """Rename a column, widen its type, or both (V8)."""
        col = self._column(old)
        kind = _type(dtype) if dtype else col["type"]
        if kind != col["type"] and (col["type"], kind) not in WIDER:
            raise ValueError(f"{old}: {col['type']} can't become {kind}")
        if new and new != old and new in {c["name"] for c in self.version()["columns"]}:
            raise ValueError(f"column {new} exists")
        return self._change("change column", [c if c["name"] != old else (new or old, c["stored"], kind)
                                              for c in self.version()["columns"]], committed_at)

    def _column(self, name: str):
        at = self.version()
        col = next((c for c in at["columns"] if c["name"] == name), None)
        if col is None:
            raise ValueError(f"no column {name}")
        laid = self.versions().select(F.explode("spec").alias("s")).where(F.col("s") == col["stored"]).limit(1).count()
        if laid:
            raise ValueError(f"{name} lays out the table")
        return col

    def set_partition_spec(self, spec, committed_at=None) -> int:
        """Lay out later rows by other columns or expressions; earlier ones stay as they are (V9)."""
        layout = self.versions().agg(F.max("layout")).first()[0] + 1
        return self._change("layout", self.version()["columns"], committed_at, layout=layout, spec=list(spec))
