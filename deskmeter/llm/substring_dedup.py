"""Passages that occur earlier already, by prefix-partitioned suffix trees.

A repeat is a window of ``window`` consecutive words that also starts earlier: in a document
with a smaller id, or earlier in the same one. Every word that such a window covers is removed.

1. Candidates. In each window the k-gram with the smallest hash is its anchor; equal windows have
   equal anchors. Anchors are counted over the corpus; only windows whose anchor
   occurs twice can repeat. (About one gram in eight is an anchor.)
2. Suffixes. Each candidate start is a suffix, cut off at the depth of a window. Suffixes are split
   by a prefix of 5, 10 or 15 words: the shortest whose count is at most ``group_rows``, so a group
   fits in memory. Suffixes of prefixes that are still too frequent share (almost) a whole window
   and go by the window itself.
3. Subtrees. Groups are packed into tasks; a task sorts its suffixes below their prefixes. The
   leaves below an internal node of window depth are one repeated window; all but the earliest are
   repeats. Windows of frequent prefixes are settled by an aggregate of the earliest start and a join,
   which adaptive execution splits.
4. Words under repeated windows go; overlapping windows unite into maximal spans.

Documents with equal words are one class first: all but the earliest consist of repeats if they
have a window at all. The tables of counts and of the anchors' bits have a fixed size
(``slot_bits``, ``filter_bits``) and are the only things broadcast; where they fill up they let more
rows pass and lengthen prefixes, with the same result. Words are compared by 128 bits of hashes.

Null texts have no words; texts shorter than a window are kept. Ids are integers; null ids come
first, and rows that repeat an id and a text are copies in the order of reading. Further columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter.llm.bitfilter import BITS, build, passes
from deskmeter.llm.common import owning, release, slices, store, texts, utf8
from deskmeter.llm.words import grams, hashes, mix, spans

WINDOW, ANCHOR, STEP = 20, 6, 5
SLOT_BITS = 18
GROUP_ROWS, TASK_ROWS = 20_000, 200_000
BATCH_BYTES = 2 << 20
_DEPTHS = (1, 2, 3)  # prefixes in steps of five words


class _Words:
    """The hashed words of a batch of texts."""

    def __init__(self, column: pa.Array):
        self.raw, ends = utf8(column)
        self.begin, self.stop, self.before = spans(self.raw, ends)
        self.each = hashes(self.raw, self.begin, self.stop)
        self.count = np.diff(self.before)
        # starts of the windows that lie in one text
        n = np.maximum(self.count - WINDOW + 1, 0)
        self.owner = np.repeat(np.arange(len(n)), n)
        self.start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.at = self.before[:-1][self.owner] + self.start

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """For each window, the hash of its anchor and the anchor's place."""
        least = grams(self.each, ANCHOR)
        place = np.arange(len(least))
        span, wanted = 1, WINDOW - ANCHOR + 1
        while span < wanted:  # the leftmost minimum of span grams, doubled until it covers a window
            reach = min(span, wanted - span)
            left, right = least[:-reach], least[reach:]
            later = right < left
            place = np.where(later, place[reach:], place[:-reach])
            least = np.where(later, right, left)
            span += reach
        return least[self.at], place[self.at]

    def joined(self, text: int, kept: np.ndarray | None = None) -> bytes:
        """The (kept) words of a text, joined by one blank."""
        low, high = self.before[text], self.before[text + 1]
        words = range(low, high) if kept is None else (np.flatnonzero(kept) + low).tolist()
        data = self.raw.data
        b, s = self.begin, self.stop
        return b" ".join([data[b[w] : s[w]] for w in words])


def _count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, BATCH_BYTES):
        found, place = _Words(batch.column("text")).anchors()
        _, first = np.unique(place, return_index=True)
        key, n = np.unique(found[first], return_counts=True)
        for at in range(0, len(key), 1 << 17):
            part = slice(at, at + (1 << 17))
            yield pa.RecordBatch.from_arrays([pa.array(key[part].view(np.int64)), pa.array(n[part], pa.int64())], ["key", "n"])


def _scan(anchors):
    """Each document with its counts and digest, and its text where it has a candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = anchors.value
        for batch in slices(batches, BATCH_BYTES):
            column = batch.column("text")
            words = _Words(column)
            found, _ = words.anchors()
            hit = np.zeros(len(column), bool)
            hit[words.owner[passes(table, found)]] = True
            digest = [hashlib.sha256(words.joined(i)).hexdigest() for i in range(len(column))]
            kept = [t if h else None for t, h in zip(column.to_pylist(), hit.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words.count, pa.int64()), pa.array(digest), pa.array(kept, pa.string())],
                ["id", "n_words", "digest", "text"])

    return run


def _prefixes(words: _Words, chosen: np.ndarray) -> list[np.ndarray]:
    """Hashes of the four steps of each chosen window."""
    step = grams(words.each, STEP)
    at = words.at[chosen]
    return [step[at + STEP * i] for i in range(WINDOW // STEP)]


def _chain(parts: list[np.ndarray], seed: int) -> np.ndarray:
    out = np.full(len(parts[0]) if parts else 0, seed, np.uint64)
    for p in parts:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + p)
    return out


def _count_prefixes(anchors, slot_bits: int, least: int):
    """Candidates by depth and slot of their prefix, those of a task together; depth 0 has their number.

    Counts below ``least`` are left out: with as many tasks as ``least`` allows for, that adds up to a quarter of a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {d: np.zeros(1 << slot_bits, np.int64) for d in _DEPTHS}
        total = 0
        for batch in slices(batches, BATCH_BYTES):
            words = _Words(batch.column("text"))
            chosen = np.flatnonzero(passes(anchors.value, words.anchors()[0]))
            total += len(chosen)
            parts = _prefixes(words, chosen)
            for depth in _DEPTHS:
                slot = (_chain(parts[:depth], depth) & np.uint64((1 << slot_bits) - 1)).astype(np.int64)
                counts[depth] += np.bincount(slot, minlength=1 << slot_bits)
        for depth, n in [(0, np.array([total])), *counts.items()]:
            slot = np.flatnonzero(n >= (least if depth else 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slot), depth), pa.int32()), pa.array(slot, pa.int64()), pa.array(n[slot], pa.int64())],
                ["depth", "slot", "n"])

    return run


def _suffixes(anchors, frequent, slot_bits: int, wanted: bool):
    """Candidate starts below the shortest prefix that is rare enough; or, ``wanted``, those for which none is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_BYTES):
            words = _Words(batch.column("text"))
            chosen = np.flatnonzero(passes(anchors.value, words.anchors()[0]))
            parts = _prefixes(words, chosen)
            key, tail = _chain(parts, 7), _chain(parts[::-1], 8)
            whole = np.ones(len(chosen), bool)
            for depth in reversed(_DEPTHS):
                prefix = _chain(parts[:depth], depth)
                rare = ~frequent.value[depth][(prefix & np.uint64((1 << slot_bits) - 1)).astype(np.int64)]
                key = np.where(rare, prefix, key)
                tail = np.where(rare, _chain(parts[depth:], 9), tail)
                whole &= ~rare
            out = whole if wanted else ~whole
            key, tail, owner, start = key[out], tail[out], words.owner[chosen][out], words.start[chosen][out]
            number = batch.column("no").to_numpy(zero_copy_only=False)
            for at in range(0, len(key), 1 << 16):
                p = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[p].view(np.int64)), pa.array(tail[p].view(np.int64)), pa.array(number[owner[p]], pa.int64()),
                     pa.array(start[p], pa.int32())], ["key", "tail", "no", "start"])

    return run


def _subtrees(rows: pd.DataFrame) -> pd.DataFrame:
    """The suffixes of some groups in tree order; leaves below a node of window depth, but the earliest."""
    columns = [rows[c].to_numpy() for c in ("start", "no", "tail", "key")]
    order = np.lexsort(columns)
    key, tail = columns[3][order], columns[2][order]
    repeat = np.zeros(len(order), bool)
    repeat[1:] = (key[1:] == key[:-1]) & (tail[1:] == tail[:-1])
    at = order[repeat]
    return pd.DataFrame({"no": columns[1][at], "start": columns[0][at]})


def _clean(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_BYTES):
            words = _Words(batch.column("text"))
            removed, digest, found, texts_left = [], [], [], []
            for i, starts in enumerate(batch.column("starts").to_pylist()):
                change = np.zeros(words.count[i] + 1, np.int64)
                at = np.array(starts or [], np.int64)
                np.add.at(change, at, 1)
                np.add.at(change, at + WINDOW, -1)
                covered = np.cumsum(change)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
                found.append([{"begin": int(b), "end": int(e)} for b, e in zip(edges[::2], edges[1::2], strict=True)])
                left = words.joined(i, ~covered)
                removed.append(int(covered.sum()))
                digest.append(hashlib.sha256(left).hexdigest())
                texts_left.append(left.decode() if with_text else None)
            spans_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("no"), pa.array(removed, pa.int64()), pa.array(digest), pa.array(found, spans_type),
                 pa.array(texts_left, pa.string())], ["no", "n_removed", "kept_sha256", "spans", "kept"])

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
            group_rows: int = GROUP_ROWS, task_rows: int = TASK_ROWS, filter_bits: int = BITS,
            slot_bits: int = SLOT_BITS) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256, spans of removed words (all of a copy
    is one span) and, if asked for, the kept words of the documents that lost some but not all."""
    context = docs.sparkSession.sparkContext
    rows = texts(docs, F.col(id_col).cast("bigint").alias("id"), text=text_col)
    counts = rows.select("text").mapInArrow(_count_anchors, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    anchors = context.broadcast(build(counts.where("n > 1").select("key"), filter_bits))

    scanned = rows.mapInArrow(_scan(anchors), "id bigint, n_words bigint, digest string, text string")
    with owning() as first_tables:
        scanned = store(scanned.withColumn("rid", F.monotonically_increasing_id()))
    # numbers in the order of ids stand for documents from here on
    plain = scanned.select("rid", "id", "n_words", "digest").repartitionByRange(F.col("id").asc_nulls_first(), "rid")
    plain = store(plain.sortWithinPartitions(F.col("id").asc_nulls_first(), "rid").withColumn("no", F.monotonically_increasing_id()))
    first = store(plain.groupBy("n_words", "digest").agg(F.min("no").alias("first")))
    earliest = plain.join(first.select(F.col("first").alias("no")), "no", "left_semi").select("rid", "no")
    chosen = store(scanned.where(F.col("text").isNotNull()).select("rid", "text").join(store(earliest), "rid").select("no", "text"))
    release(docs.sparkSession, first_tables)  # its texts are in ``chosen`` now, its other columns in ``plain``

    least = group_rows // (4 * max(1, chosen.rdd.getNumPartitions()))
    known = store(chosen.select("text").mapInArrow(_count_prefixes(anchors, slot_bits, max(1, least)), "depth int, slot bigint, n bigint")
                  .groupBy("depth", "slot").agg(F.sum("n").alias("n")))
    candidates = known.where("depth = 0").agg(F.sum("n")).first()[0] or 0
    table = {d: np.zeros(1 << slot_bits, bool) for d in _DEPTHS}  # fixed in size, as the number of slots is
    found = known.where((F.col("depth") > 0) & (F.col("n") > group_rows)).toArrow()
    depths, slots = found.column("depth").to_numpy(), found.column("slot").to_numpy()
    for d in _DEPTHS:
        table[d][slots[depths == d]] = True
    frequent = context.broadcast(table)

    def suffixes(whole: bool) -> DataFrame:
        return chosen.mapInArrow(_suffixes(anchors, frequent, slot_bits, whole), "key bigint, tail bigint, no bigint, start int")

    tasks = max(1, -(-candidates // task_rows))
    low = (suffixes(False).withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks))).groupBy("task")
           .applyInPandas(_subtrees, "no bigint, start int"))
    whole = store(suffixes(True))
    before = store(whole.groupBy("key", "tail").agg(F.min(F.struct("no", "start")).alias("e")))
    high = whole.join(before, ["key", "tail"]).where(F.struct("no", "start") != F.col("e")).select("no", "start")
    starts = low.unionByName(high).groupBy("no").agg(F.collect_list("start").alias("starts"))
    cleaned = store(chosen.join(starts, "no").mapInArrow(
        _clean(with_text), "no bigint, n_removed bigint, kept_sha256 string, spans array<struct<begin:int,end:int>>, kept string"))

    nothing = hashlib.sha256(b"").hexdigest()
    copy = (F.col("no") != F.col("first")) & (F.col("n_words") >= WINDOW)
    every = F.array(F.struct(F.lit(0).alias("begin"), F.col("n_words").cast("int").alias("end")))
    return (
        plain.join(first, ["n_words", "digest"]).join(cleaned, "no", "left")
        .select(
            F.col("id").alias(id_col), "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
            F.when(copy, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
            F.when(copy, every).otherwise(F.coalesce("spans", F.filter(every, lambda s: F.lit(False)))).alias("spans"),
            *([F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept")] if with_text else []),
        )
    )
