"""Dialect and column types of delimited text, found from all rows.

Types form a lattice: a whole number is also a double, a date also a timestamp, everything is text. A
cell is reduced to the set of types it can be read as (bits), a column to the sets' intersection. ``bit_and`` merges
over any split of the file, so one scan with partial aggregates types all columns, and every row counts.
The delimiter is the one that gives every line the same number of fields, quoted text aside.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELIMITERS = (",", ";", "\t", "|")
NULL_WORDS = ("", "NULL", "null", "NA", "N/A")
#: From the narrowest type to the widest.
LATTICE: dict[str, T.DataType] = {
    "boolean": T.BooleanType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp": T.TimestampNTZType(), "string": T.StringType(),
}
WHOLE = r"^[+-]?[0-9]{1,18}$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$"


@dataclass(frozen=True)
class Dialect:
    delimiter: str
    header: bool
    nulls: tuple[str, ...]
    schema: T.StructType


def kinds(cell: Column, nulls: tuple[str, ...] = NULL_WORDS) -> Column:
    """The bits of the types that a cell's text can be read as; all of them for a missing value."""
    # the patterns exclude one another but for a whole number, which is a number; most cells need one or two of them
    def bits(*names: str) -> int:
        return sum(1 << list(LATTICE).index(n) for n in (*names, "string"))

    start = F.left(cell, F.lit(1))
    found = (
        F.when(start.between("0", "9") | start.isin("+", "-", "."),
               F.when(cell.rlike(WHOLE), bits("bigint", "double")).when(cell.rlike(NUMBER), bits("double"))
               .when(start.between("0", "9") & (F.substring(cell, 5, 1) == "-"),
                     F.when(cell.rlike(DAY) & cell.try_cast("date").isNotNull(), bits("date", "timestamp"))
                     .when(cell.rlike(MOMENT) & cell.try_cast("timestamp_ntz").isNotNull(), bits("timestamp")).otherwise(bits()))
               .otherwise(bits()))
        .when(F.length(cell).between(4, 5) & F.lower(cell).isin("true", "false"), bits("boolean"))
        .otherwise(bits()))
    return F.when(cell.isNull() | cell.isin(*nulls), (1 << len(LATTICE)) - 1).otherwise(found)


def narrowest(bits: int | None) -> str:
    """The first type all cells agree on; text for a column without values."""
    names = list(LATTICE)
    if bits is None or bits == (1 << len(names)) - 1:
        return "string"
    return next(name for i, name in enumerate(names) if bits >> i & 1)


def field_counts(lines: DataFrame, delimiters: tuple[str, ...] = DELIMITERS) -> DataFrame:
    """One row: least and most delimiters per line, of each kind, in lines whose quotes are closed."""
    bare = F.regexp_replace("value", '"[^"]*"', "")
    closed = lines.select(bare.alias("value")).where((F.col("value") != "") & ~F.col("value").contains('"'))
    count = {d: F.length("value") - F.length(F.replace(F.col("value"), F.lit(d), F.lit(""))) for d in delimiters}
    return closed.agg(*[f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(count.values()) for f in (F.min, F.max)])


def find_delimiter(lines: DataFrame, delimiters: tuple[str, ...] = DELIMITERS) -> str:
    """The delimiter that all lines have equally often (the most of it); the first one where there is none."""
    found = field_counts(lines, delimiters).first()
    same = [(found[f"min_{i}"] or 0, -i, d) for i, d in enumerate(delimiters) if found[f"min_{i}"] == found[f"max_{i}"]]
    return max(same)[2] if same and max(same)[0] else delimiters[0]


def _reader(spark: SparkSession, delimiter: str, header: bool):
    return spark.read.options(sep=delimiter, header=header, quote='"', escape='"', encoding="UTF-8", nullValue="", emptyValue="")


def sniff(spark: SparkSession, path: str, delimiter: str | None = None, header: bool | None = None,
          nulls: tuple[str, ...] = NULL_WORDS) -> Dialect:
    """The dialect and schema of the delimited text at ``path``; what is given is not looked for.

    There is a header unless the first line's cells have the types of the columns below them.
    """
    delimiter = delimiter or find_delimiter(spark.read.text(path))
    first = _reader(spark, delimiter, False).csv(path).limit(1)
    names = _reader(spark, delimiter, True).csv(path).columns
    body = _reader(spark, delimiter, header is not False).csv(path)
    places = [f"_{i}" for i in range(len(body.columns))]
    body = body.toDF(*places)
    bits = body.agg(*[F.bit_and(kinds(F.col(p), nulls)).alias(p) for p in places]).first()
    types = [narrowest(bits[p]) for p in places]
    if header is None:
        top = first.toDF(*places).select(*[kinds(F.col(p), nulls).alias(p) for p in places]).first()
        fits = top is not None and all(top[p] >> list(LATTICE).index(t) & 1 for p, t in zip(places, types, strict=True))
        header = not fits or all(t == "string" for t in types)
        if not header:
            names = [f"column{i}" for i in range(len(places))]
    elif not header:
        names = [f"column{i}" for i in range(len(places))]
    return Dialect(delimiter, header, nulls, T.StructType(
        [T.StructField(n, LATTICE[t]) for n, t in zip(names, types, strict=True)]))


def read_sniffed(spark: SparkSession, path: str, dialect: Dialect | None = None) -> DataFrame:
    """The rows at ``path`` with the types found. A later value that does not fit fails the job."""
    dialect = dialect or sniff(spark, path)
    texts = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(dialect.schema))])
    rows = _reader(spark, dialect.delimiter, dialect.header).schema(texts).csv(path)
    cells = {f"_{i}": f for i, f in enumerate(dialect.schema.fields)}
    return rows.select(*[
        F.when(~F.col(p).isin(*dialect.nulls), F.col(p)).cast(f.dataType).alias(f.name) for p, f in cells.items()])


def schema_rows(spark: SparkSession, dialects: dict[str, Dialect]) -> DataFrame:
    """(table_name, position, column_name, type_name) of every column."""
    names = {kind: name for name, kind in LATTICE.items()}
    rows = [(table, i, f.name, names[f.dataType]) for table, d in dialects.items() for i, f in enumerate(d.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, position bigint, column_name string, type_name string")
