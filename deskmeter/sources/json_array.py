"""Top-level JSON arrays of any layout, read in byte ranges.

A JSON document has no line that would be safe to split at, so the usual reader gives a whole file to one
task. Here the text reader deals out byte ranges, cut behind closing braces, wherever these are. One
pass sums up what each range does to an automaton of (inside a string, depth), for both states it may
be entered in; composing the ranges of a file in order gives the state and depth at which each begins.
A second pass, knowing these, cuts the elements; elements that reach over ranges are put together from their
fragments. Both passes take a batch of pieces at a time.

Elements must be objects. Anything else, a truncated file or brackets that don't match fail the job (a stray brace
behind the very end is not noticed).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskmeter.session import reliable_checkpoint

#: A row of some 100 bytes for every range is broadcast; more ranges ask for a larger spark.sql.files.maxPartitionBytes.
MAX_RANGES = 1 << 18
WHOLE, HEAD, TAIL, MIDDLE = range(4)
_BLANK = np.isin(np.arange(256), [*b" \t\r\n"])
_STEP = np.zeros(256, np.int8)
_STEP[[*b"{["]], _STEP[[*b"}]"]] = 1, -1


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"))


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
    """((file, begin, further columns), bytes) of each batch's rows of one range, closing braces put back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column(1).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        begins = batch.column(2).to_numpy(zero_copy_only=False)
        change = np.flatnonzero((np.diff(files) != 0) | (np.diff(begins) != 0)) + 1
        for first, last in zip([0, *change], [*change, batch.num_rows], strict=True):
            key = tuple(batch.column(c)[int(first)].as_py() for c in range(1, batch.num_columns))
            column = batch.column(0).slice(first, last - first)
            kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
            ends = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] else np.zeros(0, np.uint8)
            text = np.empty(len(data) + len(column), np.uint8)
            braces = ends[1:] - ends[0] + np.arange(len(column))
            kept = np.ones(len(text), bool)
            kept[braces] = False
            text[braces], text[kept] = 125, data
            yield key, text


def _structure(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: the parity of the quotes so far, and +1 or -1 at brackets."""
    quotes = raw == 34
    if (slashes := raw == 92).any():
        at = np.arange(len(raw))
        last_other = np.maximum.accumulate(np.where(slashes, -1, at))
        quotes[1:] &= (at[:-1] - last_other[:-1]) % 2 == 0
    step = _STEP[raw]
    # sums modulo 256 keep the parity
    return (np.cumsum(quotes, dtype=np.uint8) & 1).astype(np.int8), step


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, begin, parity, outside, inside): what each range does, entered outside or inside a string."""
    key, parity, depth = None, 0, [0, 0]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"file": [key[0]], "begin": [key[1]], "parity": [parity], "outside": [depth[0]], "inside": [depth[1]]})

    for found, raw in _by_range(batches):
        if found != key:
            if key:
                yield row()
            key, parity, depth = found, 0, [0, 0]
        odd, step = _structure(raw)
        sums = [int(step[odd == 0].sum()), int(step[odd == 1].sum())]
        depth = [depth[s] + sums[s ^ parity] for s in (0, 1)]
        parity ^= int(odd[-1])
    if key:
        yield row()


def entries(spark: SparkSession, path: str) -> DataFrame:
    """(file, begin, state, depth, complete): how each byte range is entered, and whether its file is a whole array."""
    ranges = _pieces(spark, path).mapInArrow(
        _summaries, "file string, begin bigint, parity bigint, outside bigint, inside bigint")
    order = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    state = (F.coalesce(F.sum("parity").over(order), F.lit(0)) % 2).cast("int")
    placed = ranges.withColumn("state", state).withColumn(
        "step", F.when(F.col("state") == 0, F.col("outside")).otherwise(F.col("inside")))
    # the closing bracket, and the brace put behind it, take the depth to -1
    complete = (F.sum("parity").over(whole) % 2 == 0) & (F.sum("step").over(whole) == -1)
    return placed.select("file", "begin", "state", F.coalesce(F.sum("step").over(order), F.lit(0)).alias("depth"), complete.alias("complete"))


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, begin, kind, text): the elements of each range, and the fragments at its ends."""
    key, state, depth, carry, kind = None, 0, 0, [], WHOLE

    def rows(kinds: list[int], texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"file": [key[0]] * len(kinds), "begin": [key[1]] * len(kinds), "kind": kinds, "text": [t.decode() for t in texts]})

    def rest() -> Iterator[pa.RecordBatch]:
        if carry:
            yield rows([MIDDLE if kind == TAIL else HEAD], [b"".join(carry)])

    for found, raw in _by_range(batches):
        if found != key:
            yield from rest()
            key, carry = found, []
            _, _, state, depth, complete = key
            if state is None:
                raise RuntimeError(f"the ranges of {key[0]} have changed while it was read")
            if not complete:
                raise ValueError(f"{key[0]} is no complete JSON array")
            kind = TAIL if state or depth > 1 else WHOLE
        odd, step = _structure(raw)
        outside = odd == state
        after = np.cumsum(step * outside, dtype=np.int32)
        after += np.int32(depth)
        before = np.concatenate([np.array([depth], np.int32), after[:-1]])
        opens = np.flatnonzero(outside & (before == 1) & (raw == 123))
        closes = np.flatnonzero(outside & (after == 1) & (raw == 125) & (before == 2))
        between = outside & (before <= 1) & ~_BLANK[raw]
        between[opens] = False
        odd_ones = between & ~np.where(before == 1, (raw == 44) | (raw == 93), (before == 0) & ((raw == 91) | (raw >= 128)) | ((before == 0) & (after == -1)))
        if odd_ones.any():
            raise ValueError(f"{key[0]} has something else than objects in its array")
        data, kinds, texts = raw.tobytes(), [], []
        open_now = state or depth > 1
        first = 0 if open_now else None
        starts = ([0] if open_now else []) + opens.tolist()
        for i, start in enumerate(starts):
            end = int(closes[i]) + 1 if i < len(closes) else None
            if end is None:
                carry.append(data[start:])
            else:
                joined = b"".join([*carry, data[start:end]]) if start == first and carry else data[start:end]
                kinds.append(kind if start == first and i == 0 else WHOLE)
                texts.append(joined)
                carry = []
                kind = WHOLE
        if kinds:
            yield rows(kinds, texts)
        state, depth = state ^ int(odd[-1]), int(after[-1])
    yield from rest()


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, record): the text of each element, stored."""
    ranges = reliable_checkpoint(entries(spark, path))
    if ranges.count() > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} byte ranges: raise spark.sql.files.maxPartitionBytes")
    pieces = _pieces(spark, path).join(F.broadcast(ranges), ["file", "begin"], "left").select(
        "value", "file", "begin", "state", "depth", "complete")
    cut = reliable_checkpoint(pieces.mapInArrow(_elements, "file string, begin bigint, kind bigint, text string"))
    # a range's first fragment ends an earlier element, its last one begins a new one
    parts = cut.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("begin", F.when(F.col("kind") == HEAD, 1).otherwise(0))
    numbered = parts.withColumn("element", F.sum((F.col("kind") == HEAD).cast("int")).over(order))
    joined = numbered.groupBy("file", "element").agg(F.array_sort(F.collect_list(F.struct("begin", "text"))).alias("parts"))
    return cut.where(F.col("kind") == WHOLE).select("file", F.col("text").alias("record")).unionByName(
        joined.select("file", F.array_join("parts.text", "").alias("record")))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per element of the arrays in ``path`` (a file, folder or glob)."""
    parsed = F.from_json("record", schema, {"mode": "FAILFAST"}).alias("r")
    return elements(spark, path).select(parsed).select("r.*")
