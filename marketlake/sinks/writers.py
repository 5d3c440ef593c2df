"""Sinks (SNK-1, SNK-2, SNK-4, SNK-5, SNK-6) and snapshot versioning.

Plain parquet has no transactions, so tables are never overwritten while
being read: a reference table is a set of immutable snapshot directories
``{root}/{name}/v={n}`` named by commits, and facts are append-only per
``time_id``/``run_date`` partition (a re-run replaces the run dates it names).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..storage import delete, exists, is_missing_path, names


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-1 / SNK-5: JSON Lines, one object per row (splittable on read)."""
    df.write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-1 in the vendors' form: every task writes one file that holds one JSON array, an element a line."""
    def lines(batches):
        opened = False
        for b in batches:
            text = [t for t in b.column(0).to_pylist() if t is not None]
            if text:
                marks = ["," if opened else "[", *[","] * (len(text) - 1)]
                opened = True
                yield pa.RecordBatch.from_arrays([pa.array([m + t for m, t in zip(marks, text)])], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if opened else "[]"])], ["value"])

    rows = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    rows = rows.unionByName(df.sparkSession.range(1).select(F.lit(None).cast("string").alias("value")))  # no rows: still an array
    rows.mapInArrow(lines, "value string").write.mode(mode).text(path)


def write_run_date(df: DataFrame, root: str, prefix: str, run_date_col: str = "run_date",
                   fmt: str = "parquet", run_dates: list[str] | None = None) -> None:
    """SNK-2: write a batch into ``{root}/{prefix}/run_date=…``.

    Dynamic partition overwrite replaces the run dates present in the batch,
    other days are untouched.  ``run_dates`` names the days the batch stands
    for: those are replaced even where the batch has no row for them (a day
    corrected to empty), so a re-run is idempotent (jobs publish run dates by
    ``publish.Load.replace`` instead, which deletes nothing before its commit).  Their old partitions go
    just before the write (``df`` must not read them); a failed write is
    repaired by running it again.
    The ``rebalance`` hint clusters rows by the partition column, so each
    date gets few files (no small-file storm), and lets AQE split a hot date
    over several tasks and files (no single straggler writing a third of the
    data)."""
    path = f"{root.rstrip('/')}/{prefix}"
    for day in run_dates or []:
        delete(df.sparkSession, f"{path}/{run_date_col}={day}")
    (df.hint("rebalance", run_date_col)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(run_date_col).format(fmt).save(path))


def append_rows(df: DataFrame, path: str, columns: list[str],
                partition_by: str | None = None) -> None:
    """SNK-4: ``INSERT INTO t(cols) SELECT cols`` — append with an explicit
    column list (after an insert-if-new anti-join, MRG-3).  A partitioned
    append is rebalanced on the partition column: few, evenly sized files per
    day, a hot day split by AQE over several tasks."""
    rows = df.select(*columns)
    if partition_by:
        rows.hint("rebalance", partition_by).write.mode("append") \
            .partitionBy(partition_by).parquet(path)
    else:
        rows.write.mode("append").parquet(path)


# ---- versioned snapshots (reference tables) --------------------------------
#
# ``{root}/{name}/v={n}`` are immutable; ``{root}/_commits/{k}`` holds the version of
# every table as of commit k.  A commit is one new folder, valid once it has its
# ``_SUCCESS`` file, and is never rewritten: a crash leaves the previous commit in force,
# and readers see all tables of a load or none.

def versions(spark: SparkSession, root: str) -> dict[str, int]:
    """The version of every table in the newest valid commit (one row a table); commits are asked newest first."""
    base = f"{root.rstrip('/')}/_commits"
    for k in sorted((int(n) for n in names(spark, base) if n.isdigit()), reverse=True):
        if exists(spark, f"{base}/{k}/_SUCCESS"):
            break
    else:
        return {}
    rows = spark.read.schema("name string, version long").json(f"{base}/{k}").collect()
    if not rows or any(r["name"] is None or r["version"] is None for r in rows):
        raise ValueError(f"commit {k} of {root} cannot be read")
    return {r["name"]: r["version"] for r in rows}


def current_version(spark: SparkSession, root: str, name: str) -> int | None:
    return versions(spark, root).get(name)


def read_snapshot(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame | None:
    """The committed snapshot of a reference table (None if never written)."""
    v = current_version(spark, root, name)
    if v is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return spark.read.parquet(f"{root.rstrip('/')}/{name}/v={v}")


def write_snapshots(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Write the next version of each table, in order, then commit them all at once.

    Version numbers go on from the folders that exist, committed or not, so
    nothing is ever written over; an aborted load leaves unused folders."""
    root = root.rstrip("/")
    new = {}
    for name, df in tables.items():
        taken = [int(n[2:]) for n in names(spark, f"{root}/{name}") if n.startswith("v=") and n[2:].isdigit()]
        new[name] = max(taken, default=0) + 1
        df.write.mode("errorifexists").parquet(f"{root}/{name}/v={new[name]}")
    state = versions(spark, root) | new
    taken = [int(n) for n in names(spark, f"{root}/_commits") if n.isdigit()]
    (spark.createDataFrame(list(state.items()), "name string, version long").coalesce(1)
     .write.mode("errorifexists").json(f"{root}/_commits/{max(taken, default=0) + 1}"))
    return new


def write_snapshot(spark: SparkSession, df: DataFrame, root: str, name: str) -> int:
    """One table's next snapshot, committed alone."""
    return write_snapshots(spark, {name: df}, root)[name]


# ---- export bundle (SNK-6) ---------------------------------------------------

def export_tables(spark: SparkSession, tables: dict[str, DataFrame], out: str,
                  fmt: str = "json", compression: str = "gzip", file_rows: int = 1_000_000) -> DataFrame:
    """SNK-6: write each table to ``{out}/{name}`` (csv/json/parquet) and
    return a manifest ``(name, rows, status)``.

    The bundle is compressed, as the workbook it stands for is (a zip): text
    repeats its column names in every row, so plain it is over ten times the
    size of the tables.  ``compression`` names the codec of csv and json
    (``none``: plain text); compressed text is read whole by one task, so a
    file holds ``file_rows`` rows at most.

    A table that fails to write is recorded with status ``failed: …`` and
    skipped; the others are still exported.  Row counts are observed while
    the rows are written (``DataFrame.observe``: accumulated on the
    executors, one pass) — only the per-table scalars reach the driver.
    """
    manifest = []
    for name, df in tables.items():
        path = f"{out.rstrip('/')}/{name}"
        if fmt == "csv":
            df = flatten_for_csv(df)
        seen = Observation(f"export_{name}")
        try:
            writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
            if fmt == "csv":
                writer = writer.option("header", "true")
            if fmt != "parquet":
                writer = writer.option("compression", compression).option("maxRecordsPerFile", file_rows)
            writer.format(fmt).save(path)
            manifest.append((name, observed_rows(seen, lambda: _count_back(spark, path, fmt)),
                             "ok"))
        except Exception as exc:  # noqa: BLE001 — report and continue, as specified
            manifest.append((name, None, f"failed: {type(exc).__name__}"))
    return spark.createDataFrame(manifest, "name string, rows long, status string")


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """CSV holds only flat values: arrays, structs and maps are written as
    their JSON text (the way a spreadsheet export shows them)."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, nested) else F.col(f.name)
                       for f in df.schema.fields])


def observed_rows(seen: Observation, fallback) -> int:
    """Row count an ``Observation`` collected during a write.  When the
    optimizer removed the whole plan (an input known to be empty) no metric
    arrives; ``fallback()`` then counts what was written."""
    try:
        return int(seen.get["rows"])
    except Exception:  # noqa: BLE001 — metric missing for a collapsed plan
        return int(fallback())


def _count_back(spark: SparkSession, path: str, fmt: str) -> int:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("multiLine", "true")
    try:
        return reader.load(path).count()
    except AnalysisException as exc:
        if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA" or is_missing_path(exc):
            return 0  # an empty table wrote no file
        raise
