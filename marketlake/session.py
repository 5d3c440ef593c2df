"""Spark session set-up and the shared scratch location.

The engine never picks a machine-local folder on a cluster: every
intermediate table (exports, stream checkpoints, lineage cuts) lives under
the shared folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (tests, local runs) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from .storage import delete

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every job relies on.  Session-level SQL confs only; cluster sizing
# (executors, memory) belongs to spark-submit.  UTC matters for results
# (epoch-ms <-> timestamp_ntz conversions follow the session zone).  Dynamic
# partition overwrite is passed per write by the writers, not set here, so a
# caller's own overwrites keep their meaning.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "marketlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the engine's defaults.

    ``master`` is only set for local runs; on a cluster spark-submit decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Structured Streaming state (dedupe keys) goes to RocksDB, off the JVM heap.
    builder = builder.config(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """The one setting results depend on, on a session made by someone else: the UTC time zone."""
    spark.conf.set("spark.sql.session.timeZone", SQL_DEFAULTS["spark.sql.session.timeZone"])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only for a local master.

    ``spark.checkpoint.dir`` is read from the session (the cluster's shared
    folder).  Where it is absent a local folder is created only when driver
    and executors are one process (``local[...]``: tests, a bare session); on
    a cluster that is an error, as executors would not see the files."""
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="marketlake-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/marketlake/{purpose}/{uuid.uuid4().hex}"


_OPEN: ContextVar[list[str] | None] = ContextVar("open_scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the tables that :func:`materialise` writes inside the block when it ends, also by an error.

    For jobs whose results are stored by then; a frame read from scratch must not leave the block."""
    written: list[str] = []
    token = _OPEN.set(written)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in written:
            delete(spark, path)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once into the shared scratch folder and read it back: what
    comes after does not run it again, not even after losing an executor."""
    path, schema = scratch_path(df.sparkSession, purpose), df.schema
    if (written := _OPEN.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
