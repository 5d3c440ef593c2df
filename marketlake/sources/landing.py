"""Landing-zone and lake scans (SRC-1, SRC-2, SRC-3, SRC-7, SRC-8).

Vendor drops are JSON arrays named ``{prefix}-{YYYYMMDD}.json``.  Arrays are
read by many tasks per file (:mod:`json_array`); raw response bodies
(``{"feed": […]}``) are one task per file.  The landing reader is only the
first hop: jobs convert a drop once into the parquet lake
(``run_date=YYYY-MM-DD`` partitions), and every later read is a
partition-pruned parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .. import schemas
from ..storage import is_missing_path, names
from .json_array import read_array


class MissingRunDate(FileNotFoundError):
    """No landed file / lake partition exists for the requested run date."""


def run_date_token(run_date: str | dt.date) -> str:
    """'2025-07-10' or a date -> '20250710' (the file-name suffix)."""
    if isinstance(run_date, dt.date):
        return run_date.strftime("%Y%m%d")
    return dt.datetime.strptime(run_date, "%Y-%m-%d").strftime("%Y%m%d")


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Typed, empty DataFrame: an empty day flows through every operator."""
    return spark.createDataFrame([], schema)


def read_landing(spark: SparkSession, directory: str, run_date: str, schema: T.StructType,
                 missing: str = "error", multiline: bool = True) -> DataFrame:
    """Read the landed JSON array(s) of one run date with a fixed schema.

    ``missing='error'`` raises :class:`MissingRunDate` when no file matches
    (the monthly flow); ``missing='skip'`` returns an empty typed frame (the
    daily flow, where a source may publish nothing).  A file holding ``[]``
    yields zero rows with the full schema; a truncated or malformed file, or
    one that is no array (a raw response body), fails the read: it never
    passes for a short or an empty day.  ``multiline=False`` reads JSON Lines.
    """
    pattern = f"{directory.rstrip('/')}/*-{run_date_token(run_date)}.json"
    try:
        return _read_json(spark, pattern, schema, multiline).select(*schema.names)
    except AnalysisException as exc:
        if not is_missing_path(exc):
            raise
        if missing == "skip":
            return empty_frame(spark, schema)
        raise MissingRunDate(pattern) from exc


def _read_json(spark: SparkSession, pattern: str, schema: T.StructType, multiline: bool) -> DataFrame:
    """Rows of JSON arrays or of JSON Lines, with the path of their file (``_path``)."""
    if multiline:
        return read_array(spark, pattern, schema)
    lines = spark.read.schema(schema).option("mode", "FAILFAST").json(pattern)
    return lines.select("*", F.col("_metadata.file_path").alias("_path"))


def unwrap_envelope(df: DataFrame, body_col: str, key: str, payload: T.StructType,
                    required: bool = True) -> DataFrame:
    """Take the payload array ``key`` out of a raw response body (JSON text).

    One output row per payload element.  ``_envelope_error`` is true on the
    one row that stands for a body that is null or malformed, or that lacks a
    required key (callers quarantine or raise on it); an optional key that is
    absent contributes no rows.
    """
    env = T.StructType([T.StructField(key, T.ArrayType(payload)),
                        T.StructField("_malformed", T.StringType())])
    parsed = df.withColumn("_env", F.from_json(F.col(body_col), env,
                                               {"columnNameOfCorruptRecord": "_malformed"}))
    arr = F.col(f"_env.{key}")
    wrong = (F.col("_env").isNull() | F.col("_env._malformed").isNotNull()
             | (F.trim(F.col(body_col)) == ""))
    if required:
        wrong = wrong | arr.isNull()
    items = F.when(~wrong, arr)
    return (parsed.select(*[c for c in df.columns if c != body_col],
                          F.explode_outer(items).alias("_item"),
                          wrong.alias("_envelope_error"))
            .where(F.col("_item").isNotNull() | F.col("_envelope_error"))
            .select(*[c for c in df.columns if c != body_col], "_envelope_error", "_item.*"))


def read_lake(spark: SparkSession, root: str, prefix: str, run_dates=None,
              required: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """Partition-pruned scan of ``{root}/{prefix}/run_date=…``.

    ``run_dates`` is one date, a (start, end) tuple (inclusive), a list, or
    None for every partition.  The filter is on the partition column, so only
    the matching directories are listed and read.  ``required`` also raises
    :class:`MissingRunDate` for a named date (or a date of the range) whose
    partition is not there.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    path = f"{root.rstrip('/')}/{prefix}"
    try:
        df = reader.parquet(path)
    except AnalysisException as exc:
        if not is_missing_path(exc):
            raise
        if required:
            raise MissingRunDate(path) from exc
        if schema is None:
            raise
        return empty_frame(spark, schema)
    if required and run_dates is not None:
        wanted = (run_dates_between(*map(str, run_dates)) if isinstance(run_dates, tuple)
                  else [str(d) for d in (run_dates if isinstance(run_dates, (list, set)) else [run_dates])])
        there = set(names(spark, path))
        if absent := sorted(d for d in wanted if f"run_date={d}" not in there):
            raise MissingRunDate(f"{path}: no run date {', '.join(absent)}")
    return df.where(run_date_filter("run_date", run_dates))


def run_date_filter(col: str, run_dates) -> F.Column:
    """Predicate on a date column for one date, an inclusive range, or a list."""
    c = F.col(col)
    if run_dates is None:
        return F.lit(True)
    if isinstance(run_dates, tuple):
        start, end = run_dates
        return (c >= F.lit(start).cast("date")) & (c <= F.lit(end).cast("date"))
    if isinstance(run_dates, (list, set)):
        return c.isin([F.lit(d).cast("date") for d in run_dates])
    return c == F.lit(run_dates).cast("date")


def day_range(col: str, day) -> F.Column:
    """``col`` falls on calendar day ``day`` — written as a half-open range so
    parquet min/max statistics and partition filters can use it (a
    ``date_trunc(col) = day`` test wraps the column and defeats pushdown)."""
    start = F.lit(day).cast("date")
    c = F.col(col)
    return (c >= start.cast("timestamp_ntz")) & (c < F.date_add(start, 1).cast("timestamp_ntz"))


def rename_bars(bar) -> F.Column:
    """PRJ-2: vendor bar struct (T, v, vw, o, c, h, l, t, n, otc) → our names.

    Positional struct cast: ``T`` and ``t`` differ only in case, which Spark's
    case-insensitive name resolution cannot tell apart."""
    bar = F.col(bar) if isinstance(bar, str) else bar
    return bar.cast(schemas.OHLC)


def read_bars(spark: SparkSession, directory: str, run_date: str,
              missing: str = "skip") -> DataFrame:
    """SRC-2 + SRC-7 + SRC-8 for daily bars: the landed ``{results: [...]}``
    response (or a bare ``[...]`` array) of one run date, one row per bar
    under our column names.  ``[]``, ``{}`` and a missing file give 0 rows; an
    empty, truncated or malformed file fails the read.

    The file is read whole as text (a JSON document is one task either way)
    and parsed with ``from_json``: a flat JSON scan would reject a schema
    holding both ``T`` and ``t``."""
    pattern = f"{directory.rstrip('/')}/*-{run_date_token(run_date)}.json"
    try:
        raw = spark.read.option("wholetext", True).text(pattern)
    except AnalysisException as exc:
        if missing == "skip" and is_missing_path(exc):
            return empty_frame(spark, schemas.OHLC)
        raise
    return (raw.select(F.explode(_bars_of("value")).alias("bar"))
            .select(rename_bars("bar").alias("bar")).select("bar.*"))


def _bars_of(col: str) -> F.Column:
    """The bars of one response body; a body that is no JSON fails the read."""
    body, strict = F.trim(F.col(col)), {"mode": "FAILFAST"}
    return (F.when(body == "", F.raise_error(F.lit("empty response body")))
            .when(body.startswith("["), F.from_json(body, T.ArrayType(schemas.OHLC_RAW), strict))
            .otherwise(F.from_json(body, schemas.OHLC_ENVELOPE, strict).getField("results")))


def run_dates_between(start: str, end: str) -> list[str]:
    """Inclusive list of run dates (parameters, bounded by the range length)."""
    a = dt.date.fromisoformat(start)
    b = dt.date.fromisoformat(end)
    return [(a + dt.timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]


def _range_glob(directory: str, run_dates: list[str]) -> str:
    tokens = ",".join(run_date_token(d) for d in run_dates)
    return f"{directory.rstrip('/')}/*-{{{tokens}}}.json"


def _file_run_date(path: str = "_metadata.file_name") -> F.Column:
    """Run date of the file (or the folder of files) a row came from (``…-YYYYMMDD.json``)."""
    return F.to_date(F.regexp_extract(F.col(path), r"-(\d{8})\.json(?:/[^/]*)?$", 1), "yyyyMMdd")


def read_landing_range(spark: SparkSession, directory: str, run_dates: list[str],
                       schema: T.StructType, multiline: bool = True) -> DataFrame:
    """SRC-1/2 over many run dates in ONE scan: every landed file of the
    dates, each row tagged with the ``run_date`` of its file name.  Dates
    without a file contribute nothing; bad files fail the read, as in
    :func:`read_landing`."""
    try:
        df = _read_json(spark, _range_glob(directory, run_dates), schema, multiline)
    except AnalysisException as exc:
        if not is_missing_path(exc):
            raise
        return empty_frame(spark, T.StructType(schema.fields + [
            T.StructField("run_date", T.DateType())]))
    return df.select(*schema.names, _file_run_date("_path").alias("run_date"))


def read_bodies_range(spark: SparkSession, directory: str, run_dates: list[str], name: str = "*") -> DataFrame:
    """(run_date, path, body): whole response bodies ``{name}-{YYYYMMDD}.json`` of the dates, in one scan
    (one task per file: a body is bounded by what the vendor returns at once).  Dates without a file contribute nothing."""
    tokens = ",".join(run_date_token(d) for d in run_dates)
    try:
        raw = spark.read.option("wholetext", True).text(f"{directory.rstrip('/')}/{name}-{{{tokens}}}.json")
    except AnalysisException as exc:
        if not is_missing_path(exc):
            raise
        return empty_frame(spark, T.StructType([T.StructField("run_date", T.DateType()), T.StructField("path", T.StringType()), T.StructField("body", T.StringType())]))
    path = raw.select("value", F.col("_metadata.file_path").alias("path"))
    return path.select(_file_run_date("path").alias("run_date"), "path", F.col("value").alias("body"))


def read_bars_range(spark: SparkSession, directory: str, run_dates: list[str]) -> DataFrame:
    """:func:`read_bars` over many run dates in one scan, with ``run_date``."""
    raw = read_bodies_range(spark, directory, run_dates)
    return (raw.select(F.explode(_bars_of("body")).alias("bar"), "run_date")
            .select(rename_bars("bar").alias("bar"), "run_date").select("bar.*", "run_date"))
