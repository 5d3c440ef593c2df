"""File-system questions through Spark's own file systems (any store Spark reads)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.utils import AnalysisException


def is_missing_path(exc: AnalysisException) -> bool:
    """Does the error say that the path does not exist (and nothing else)?"""
    return exc.getCondition() == "PATH_NOT_FOUND"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def file_sizes(spark: SparkSession, pattern: str | list[str]) -> list[tuple[str, int]]:
    """(path, bytes) of the files of a pattern, or below the folders that it names."""
    out = []
    for one in [pattern] if isinstance(pattern, str) else pattern:
        fs, p = _fs(spark, one)
        for s in fs.globStatus(p) or []:
            found = [s] if s.isFile() else [f for f in fs.listStatus(s.getPath()) if f.isFile()]
            out += [(f.getPath().toString(), f.getLen()) for f in found if f.getPath().getName()[0] not in "._"]
    return out
