"""Publishing a load at once: a partition-level commit log (SNK-2, SNK-4, MRG-3).

A load writes every table into folders of its own, ``{root}/{table}/load={id}[/partition]``, and nothing that it
writes is visible before its commit.  A commit is one new folder ``{root}/_published/{k}`` with the whole state: which loads
make up each appended table, and which load holds each replaced run date.  It counts once its ``_SUCCESS`` file is there,
so a crash between any two writes leaves the previous state in force, and all tables of a load appear together.  Nothing is
deleted or written over before the commit; ``clean`` then removes the run dates it replaced, ``expire`` what old commits alone
refer to, and ``compact`` unites many small loads.

One writer at a time: of two loads that commit after the same state, the second fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import delete, exists, names
from .writers import observed_rows

#: Folder of the commits, below the root of the tables.
LOG = "_published"

_STATE = "name string, partition string, load string, rows long, note string"


class ConcurrentLoad(RuntimeError):
    """Another load was committed since this one began."""


def last_commit(spark: SparkSession, root: str) -> int:
    """Number of the newest valid commit (0 if none): newest first, so one question as a rule."""
    base = f"{root.rstrip('/')}/{LOG}"
    for k in sorted((int(n) for n in names(spark, base) if n.isdigit()), reverse=True):
        if exists(spark, f"{base}/{k}/_SUCCESS"):
            return k
    return 0


def published(spark: SparkSession, root: str, commit: int | None = None) -> list[dict]:
    """The state of a commit (default: the newest): a row per load of a table and per replaced run date."""
    k = last_commit(spark, root) if commit is None else commit
    if not k:
        return []
    rows = spark.read.schema(_STATE).json(f"{root.rstrip('/')}/{LOG}/{k}").collect()
    if any(r["name"] is None or r["load"] is None for r in rows):
        raise ValueError(f"commit {k} of {root} cannot be read")
    return [r.asDict() for r in rows]


def is_published(spark: SparkSession, root: str) -> bool:
    """Are the tables below ``root`` governed by a commit log?"""
    return exists(spark, f"{root.rstrip('/')}/{LOG}")


def _read(spark: SparkSession, root: str, name: str, state: list[dict], schema: T.StructType,
          partitions: list[str] | None = None, partition_col: str = "run_date") -> DataFrame:
    base = f"{root.rstrip('/')}/{name}"
    paths = []
    for s in state:
        if s["name"] == name and (s["partition"] is None or partitions is None or s["partition"] in partitions):
            paths.append(f"{base}/load={s['load']}" + ("" if s["partition"] is None else f"/{partition_col}={s['partition']}"))
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def read_published(spark: SparkSession, root: str, name: str, schema: T.StructType,
                   partitions: list[str] | None = None, partition_col: str = "run_date") -> DataFrame:
    """A table as of the newest commit (empty, typed, if it has no rows); ``partitions`` names run dates of a
    table whose run dates are replaced, and only their folders are listed."""
    return _read(spark, root, name, published(spark, root), schema, partitions, partition_col)


class Load:
    """One load: writes that become visible together, by ``commit``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.id = "a" + uuid.uuid4().hex
        self.base = last_commit(spark, root)
        self.state = published(spark, root, self.base)
        self.superseded: list[str] = []

    def append(self, name: str, df: DataFrame, partition_by: str | None = None) -> int:
        """SNK-4: rows on top of a table's earlier ones; returns their number, counted during the write."""
        rows = self._write(name, df, partition_by)
        if rows:
            self.state.append({"name": name, "partition": None, "load": self.id, "rows": rows, "note": None})
        return rows

    def replace(self, name: str, df: DataFrame, run_dates: list[str], partition_col: str = "run_date") -> int:
        """SNK-2: the rows of the named run dates, also of those without a row now; other run dates stay."""
        rows = self._write(name, df, partition_col)
        old = [s for s in self.state if s["name"] == name and s["partition"] in run_dates]
        self.superseded += [f"{self.root}/{name}/load={s['load']}/{partition_col}={s['partition']}" for s in old]
        self.state = [s for s in self.state if s not in old]
        for folder in names(self.spark, f"{self.root}/{name}/load={self.id}"):
            if folder.startswith(f"{partition_col}="):
                day = folder.split("=", 1)[1]
                if day not in run_dates:
                    raise ValueError(f"{name}: rows of {day}, which the load does not replace")
                self.state.append({"name": name, "partition": day, "load": self.id, "rows": None, "note": None})
        return rows

    def overwrite(self, name: str, df: DataFrame, partition_by: str | None = None) -> int:
        """A whole table anew."""
        rows = self._write(name, df, partition_by)
        self.state = [s for s in self.state if s["name"] != name]
        if rows:
            self.state.append({"name": name, "partition": None, "load": self.id, "rows": rows, "note": None})
        return rows

    def note(self, key: str, value: str) -> None:
        """A fact that is committed with the load (a finished range of a backfill)."""
        self.state.append({"name": f"#{key}", "partition": None, "load": self.id, "rows": None, "note": value})

    def notes(self, key: str) -> list[str]:
        return [s["note"] for s in self.state if s["name"] == f"#{key}"]

    def forget(self, key: str) -> None:
        """Drop the notes of a key with the next commit."""
        self.state = [s for s in self.state if s["name"] != f"#{key}"]

    def rows(self, name: str) -> int:
        """Rows of an appended table, as counted when they were written."""
        return sum(s["rows"] or 0 for s in self.state if s["name"] == name)

    def read(self, name: str, schema: T.StructType, partitions: list[str] | None = None, partition_col: str = "run_date") -> DataFrame:
        """A table as it will be after the commit of what this load has written so far."""
        return _read(self.spark, self.root, name, self.state, schema, partitions, partition_col)

    def commit(self) -> int:
        """Make all of it visible; the state must not have moved on since the load began."""
        if last_commit(self.spark, self.root) != self.base:
            raise ConcurrentLoad(f"{self.root}: committed by another load after {self.base}")
        taken = [int(n) for n in names(self.spark, f"{self.root}/{LOG}") if n.isdigit()]
        k = max(taken, default=0) + 1
        rows = [tuple(s[c] for c in ("name", "partition", "load", "rows", "note")) for s in self.state]
        self.spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("errorifexists").json(f"{self.root}/{LOG}/{k}")
        self.base = k
        self.id = "a" + uuid.uuid4().hex
        return k

    def clean(self) -> None:
        """After a commit: delete the run dates that it replaced (a reader of the commit before loses them)."""
        for path in self.superseded:
            delete(self.spark, path)
        self.superseded = []

    def _write(self, name: str, df: DataFrame, partition_by: str | None) -> int:
        path = f"{self.root}/{name}/load={self.id}"
        seen = Observation(f"load_{uuid.uuid4().hex}")
        out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        # few, evenly sized files per partition value; AQE splits a hot one over several tasks
        writer = (out.hint("rebalance", partition_by).write.partitionBy(partition_by) if partition_by else out.write)
        writer.mode("errorifexists").parquet(path)
        return observed_rows(seen, lambda: self.spark.read.schema(df.schema).parquet(path).count())


def compact(spark: SparkSession, root: str, name: str, schema: T.StructType, partition_by: str | None = None) -> int:
    """Unite the loads of an appended table into one, in a commit of its own; returns its rows."""
    load = Load(spark, root)
    rows = load.overwrite(name, load.read(name, schema), partition_by)
    load.commit()
    return rows


def expire(spark: SparkSession, root: str, keep: int = 10) -> int:
    """Delete commits older than the newest ``keep`` valid ones and the load folders that none of those refers to.

    Readers of an older state lose it; a load in progress must not run.  Returns the folders deleted."""
    root = root.rstrip("/")
    every = sorted((int(n) for n in names(spark, f"{root}/{LOG}") if n.isdigit()), reverse=True)
    valid = [k for k in every if exists(spark, f"{root}/{LOG}/{k}/_SUCCESS")][:max(1, keep)]
    live, tables, gone = set(), set(), 0
    for k in every:
        if k in valid:
            live |= {(s["name"], s["load"]) for s in published(spark, root, k)}
    tables = {n for k in every if exists(spark, f"{root}/{LOG}/{k}/_SUCCESS") for n in {s["name"] for s in published(spark, root, k)} if not n.startswith("#")}
    for name in tables:
        for folder in names(spark, f"{root}/{name}"):
            if folder.startswith("load=") and (name, folder[5:]) not in live:
                delete(spark, f"{root}/{name}/{folder}")
                gone += 1
    for k in every:
        if valid and k < valid[-1]:
            delete(spark, f"{root}/{LOG}/{k}")
            gone += 1
    return gone
