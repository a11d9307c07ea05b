"""Scans of the three raw sources and of stored tables, all with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskmeter import schemas
from deskmeter.sources.json_array import read_json_array


def read_tickets(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, read by column name in whatever order the file has them.

    An absent column or a value that does not fit its type fails the job; further columns are left out.
    """
    options = dict(header=True, quote='"', escape='"', encoding="UTF-8")
    found = spark.read.options(**options).csv(path).columns
    known = {f.name: f for f in schemas.TICKETS}
    if absent := [name for name in known if name not in found]:
        raise ValueError(f"columns missing in {path}: {', '.join(absent)}")
    layout = T.StructType([known.get(name, T.StructField(name, T.StringType())) for name in found])
    rows = spark.read.schema(layout).options(mode="FAILFAST", enforceSchema=False, **options).csv(path)
    return rows.select(*known)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line, so the file splits."""
    return spark.read.schema(schemas.MESSAGES).option("mode", "FAILFAST").json(path)


def check_keys(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Fail if a field of ``schema`` is a key of no record: it would be read as missing everywhere."""
    keys = F.json_object_keys("value")
    found = spark.read.text(path).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.max(F.array_contains(keys, f.name)).alias(f.name) for f in schema.fields]).first()
    if found["_rows"] and (absent := [f.name for f in schema.fields if not found[f.name]]):
        raise ValueError(f"keys missing in {path}: {', '.join(absent)}")


def read_events(spark: SparkSession, path: str, indent: int | None = None) -> DataFrame:
    """One row per element of a top-level JSON array.

    A file of any layout is read in byte ranges, in two passes. When the
    file is pretty-printed with a known ``indent``, one pass is enough: the line break plus brace between two
    top-level elements is a safe record separator (a line break inside a JSON string is
    always escaped and nested objects sit deeper), so the text scan splits the file like
    any other. A file laid out differently fails to parse instead of losing rows.
    """
    if indent is None:
        return read_json_array(spark, path, schemas.TICKET_EVENTS)
    pad = " " * indent
    pieces = spark.read.option("lineSep", f"\n{pad}}},\n{pad}{{").text(path)
    # only the file's first and last piece still carry the outer brackets
    body = F.regexp_replace(F.col("value"), rf"^\[\r?\n{pad}\{{", "")
    body = F.regexp_replace(body, rf"\n{pad}\}}\r?\n\]\s*$", "")
    # parsed as a list, so that records joined by another separator are kept as well
    records = F.from_json(
        F.concat(F.lit("[{"), body, F.lit("}]")),
        T.ArrayType(schemas.TICKET_EVENTS),
        {"mode": "FAILFAST"},
    )
    return pieces.where(F.regexp_replace("value", r"[\s\[\]]+", "") != "").select(F.inline(records))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PREDICTIONS).parquet(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A stored table of any built-in format; CSV and JSON need a schema."""
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"{fmt} needs an explicit schema")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; for a plain scan that is the size of the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
