"""Table reads (SRC-5, QRY-17 / FLT-9) and the driver-table catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sinks.publish import is_published, read_published
from .landing import day_range

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``{sf_dir}/{name}.parquet``)."""
    if name not in DRIVER_TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, d).lineitem`` is a plain scan of that table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._cache = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = driver_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def read_table(spark: SparkSession, root: str, name: str, time_id=None,
               time_col: str = "time_id") -> DataFrame:
    """Full read of a warehouse table by name, optionally one ``time_id``.

    Unknown names raise; ``time_id`` is coerced to an integer (an empty value
    means "all rows", a non-integer raises ``ValueError``).  The filter is a
    plain equality, so it reaches the parquet scan (and the ``time_id``
    partition directory when the table is partitioned by it).  A warehouse
    with a commit log is read as of its newest commit.
    """
    if name not in schemas.WAREHOUSE_TABLES:
        raise KeyError(f"unknown warehouse table {name!r}")
    if is_published(spark, root):
        df = read_published(spark, root, name, schemas.WAREHOUSE_DDL[name])
    else:
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
    return filter_time_id(df, time_id, time_col)


def filter_time_id(df: DataFrame, time_id=None, time_col: str = "time_id",
                   date_col: str | None = None) -> DataFrame:
    """FLT-9: optional point filter with integer coercion.  Where the table
    stores a date or timestamp instead of the id, ``date_col`` names it and
    the filter is that day's range on the raw column, which reaches the scan."""
    if time_id is None or (isinstance(time_id, str) and time_id.strip() == ""):
        return df
    if date_col:
        text = f"{int(time_id):08d}"
        return df.where(day_range(date_col, f"{text[:4]}-{text[4:6]}-{text[6:]}"))
    return df.where(F.col(time_col) == F.lit(int(time_id)))


def read_jdbc_extract(spark: SparkSession, url: str, query: str, partition_column: str,
                      lower_bound: int, upper_bound: int, num_partitions: int,
                      properties: dict | None = None) -> DataFrame:
    """SRC-4 where the reference tables live in a relational store: the
    extract query read over JDBC as ``num_partitions`` parallel range reads
    on ``partition_column`` (a numeric id), instead of one connection.

    Not exercised by the tests (no database may be started here); the same
    extract over the snapshot tables is :func:`marketlake.plans.dims.company_extract`.
    """
    reader = (spark.read.format("jdbc").option("url", url)
              .option("dbtable", f"({query}) AS extract")
              .option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions)))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()
