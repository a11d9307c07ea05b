"""Presence, schema and volume checks of the inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingSource(FileNotFoundError):
    """One or more required inputs are absent."""


def _matches(spark: SparkSession, path: str) -> list:
    """Status entries of the path (or glob) on whatever file system it names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(fs.globStatus(hadoop_path) or [])


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(_matches(spark, path))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Full names of everything that matches a glob."""
    return [status.getPath().toString() for status in _matches(spark, pattern)]


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time of change) of a file, or of the files right inside a folder."""
    inside = _matches(spark, f"{path}/*")
    return sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in (inside or _matches(spark, path)))


def is_file(spark: SparkSession, path: str) -> bool:
    found = _matches(spark, path)
    return len(found) == 1 and found[0].isFile()


def require_sources(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail once, naming every missing input."""
    missing = [f"{name} ({path})" for name, path in paths.items() if not path_exists(spark, path)]
    if missing:
        raise MissingSource("missing raw sources: " + ", ".join(missing))


def present_sources(spark: SparkSession, paths: dict[str, str]) -> dict[str, str]:
    """The subset of inputs that exist, for loads where a table is optional."""
    return {name: path for name, path in paths.items() if path_exists(spark, path)}


def check_schema(name: str, df: DataFrame, expected: T.StructType) -> None:
    """Column names must be present with the expected types; extra columns are allowed."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: {actual.get(f.name, 'absent')}"
        for f in expected.fields
        if actual.get(f.name) != f.dataType
    ]
    if wrong:
        raise TypeError(f"{name} does not match its schema: {', '.join(wrong)}")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(source, n_rows) for every table; each count reads no column."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
