"""Reading, storing and batching helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskmeter.session import shared_dir, without_shuffles

_MMAP_THRESHOLD, _ARENA_MAX = -3, -8  # numbers of glibc's mallopt
_owner: ContextVar[list[str] | None] = ContextVar("owner", default=None)


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the stored rows, which cuts the lineage."""
    path = f"{shared_dir(df.sparkSession)}/deskmeter-tables/{uuid.uuid4().hex}"
    if (mine := _owner.get()) is not None:
        mine.append(path)
    with without_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def owning() -> Iterator[list[str]]:
    """The folders of the tables that ``store`` writes meanwhile, in this thread of control."""
    token = _owner.set(mine := [])
    try:
        yield mine
    finally:
        _owner.reset(token)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``store`` wrote, once nothing reads them any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ranked(rows: DataFrame, *order: str, keep: tuple[str, ...], name: str = "name") -> DataFrame:
    """The ``keep`` columns and the rank of each row (from 0) by ``order``, the same for any number of partitions.

    Rows are dealt out by ranges, sorted and stored; only the number of rows per range meets in one task.
    """
    placed = store(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *keep, F.monotonically_increasing_id().alias("_at")))
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")).select(
        "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(starts, "_range").select(*keep, (F.col("_at") + F.col("_shift")).alias(name))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name = "_" + name
    return name


def with_rows(docs: DataFrame, id_col: str) -> tuple[DataFrame, str, str]:
    """``docs`` with a key of its own for every row, ordered by id: (rows, name of the key, name of the row's mark).

    A row read from Parquet is known by its file and place there; other rows are stored with a number first, so that
    the mark is the same however often they are read.
    """
    row = fresh(docs, "_row")
    try:
        place = [F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")]
        rows = docs.select("*", F.concat_ws(":", *place).alias(row))
        rows.schema  # noqa: B018  resolves the columns
    except AnalysisException:
        rows = store(docs.withColumn(row, F.monotonically_increasing_id()))
    key = fresh(rows, "_key")
    return rows.withColumn(key, F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(row).alias("row"))), key, row


#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The named columns and ``text`` as a string that is never null; other columns go."""
    return docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(-1))


def lean() -> None:
    """Let this worker take large pieces of memory from the system one by one, so that they go back when freed.

    Workers outlive their tasks, and what one keeps is missing in the next stage. Without glibc only Arrow's part is done.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    with suppress(AttributeError, OSError):
        libc = ctypes.CDLL(None)
        libc.mallopt(_MMAP_THRESHOLD, 1 << 20)
        libc.mallopt(_ARENA_MAX, 2)


def give_back() -> None:
    """At the end of a task: return what is free to the system."""
    gc.collect()
    with suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` has about ``size`` bytes in each; one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(lengths(batch.column(column)))
        begin = 0
        while begin < batch.num_rows:
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def lengths(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each string of an Arrow column without nulls."""
    return np.diff(offsets(column))


def offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of the strings of a column (int64, one more than rows)."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], dtype=kind) if column.buffers()[1] else np.zeros(1, kind)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows in them."""
    at = offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]
