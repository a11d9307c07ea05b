"""Exact top-k search by inner product, with block-at-a-time pruning.

A vector is a document with one term per dimension, of integer weight floor(1024 * x). Vectors in
the order of their ids are cut into blocks (document ranges), each with its forward index (the
weights), and the least and largest weight of every term. For a query, the sum over its terms of the larger of
weight * largest and weight * least bounds every score in a block. Blocks are visited from the highest bound on
and scored whole; a query stops when the bound falls below its k-th best score so far.

Scale: queries go in chunks of at most ``chunk_rows``, which are collected and broadcast one after the
other (a proven bound: chunk_rows * dimensions * 8 bytes); each chunk is one pass over the
stored blocks without an exchange of vectors. Tasks hold ``group`` blocks at a time and hand on k rows per query.
Products are exact: float64 where they can't pass 2**53, and whole numbers of any size else.

Vectors that are null or hold null or non-finite components take no part, nor do null ids. Rows that
repeat an id are candidates (and queries) one by one, told apart by a number stored with them; a query's own row alone is not its
candidate. Missing components of shorter vectors count as 0. Equal scores go to the smaller id. An empty table, or one without queries, gives an empty result. Scores outside of
the long range are held at its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmeter.llm.common import store

BLOCK_ROWS, GROUP, CHUNK_ROWS = 256, 64, 8192
_BLOCK = "ids array<bigint>, rids array<bigint>, weights array<bigint>, least array<bigint>, largest array<bigint>"


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, factor: int = 1024) -> DataFrame:
    """(rid, id, v): the whole-number vector of every row that can take part."""
    x = F.col("v")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)))
        .select(F.monotonically_increasing_id().alias("rid"), "id",
                F.transform("v", lambda c: F.floor(c * factor).cast("bigint")).alias("v"))
    )


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column, filled with zeros to the longest."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _cut(block_rows: int):
    """Blocks of consecutive vectors; a partition's last one may be short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                weights = _matrix(part.column("v"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.list_(pa.int64())) for x in (
                        part.column("id").to_numpy(zero_copy_only=False), part.column("rid").to_numpy(zero_copy_only=False),
                        weights.ravel(), weights.min(axis=0), weights.max(axis=0))],
                    ["ids", "rids", "weights", "least", "largest"])

    return run


def _wide(a: np.ndarray, columns: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, columns - a.shape[1])))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exactly."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1] < 2**52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class _Best:
    """The k best (score, id) of each query so far; ``queries`` are the numbers of their rows."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.score = np.full((len(queries), k), -(2**63), np.int64)
        self.id = np.full((len(queries), k), -1, np.int64)
        self.found = np.zeros((len(queries), k), bool)

    def floor(self) -> np.ndarray:
        return np.where(self.found[:, -1], self.score[:, -1], -(2**63))

    def offer(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray, rids: np.ndarray) -> None:
        own = self.queries[at][:, None] == rids[None, :]
        scores = np.concatenate([self.score[at], score], axis=1)
        names = np.concatenate([self.id[at], np.broadcast_to(ids, own.shape)], axis=1)
        found = np.concatenate([self.found[at], ~own], axis=1)
        # absent last, then high scores, then small ids; ~x is order-reversing without overflow
        order = np.lexsort((names, ~scores, ~found), axis=1)[:, : self.k]
        for name, values in (("score", scores), ("id", names), ("found", found)):
            getattr(self, name)[at] = np.take_along_axis(values, order, axis=1)


def search_blocks(best: _Best, queries: np.ndarray, blocks: list[tuple[np.ndarray, ...]]) -> int:
    """Visit blocks (ids, rids, weights, least, largest) in the order of their bounds; returns the pairs scored."""
    width = max([queries.shape[1], *(b[2].shape[1] for b in blocks)])
    q = _wide(queries, width)
    # a missing component is 0, so bounds of narrower blocks stay true
    least = np.concatenate([_wide(b[3][None, :], width) for b in blocks])
    largest = np.concatenate([_wide(b[4][None, :], width) for b in blocks])
    bound = _product(np.maximum(q, 0), largest) + _product(np.minimum(q, 0), least)
    order = np.argsort(-bound.astype(float), axis=1, kind="stable")
    active, scored = np.arange(len(q)), 0
    for turn in range(len(blocks)):
        block = order[active, turn]
        keep = bound[active, block] >= best.floor()[active]
        active, block = active[keep], block[keep]
        if not len(active):
            break
        for b in np.unique(block):
            at = active[block == b]
            ids, rids, weights = blocks[b][:3]
            best.offer(at, _product(q[at], _wide(weights, width)), ids, rids)
            scored += len(at)
    return scored


def _search(chunk, k: int, group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rids, queries = chunk.value
        best, waiting = _Best(rids, k), []
        for batch in batches:
            names = [batch.column(i) for i in range(5)]
            for r in range(batch.num_rows):
                own, own_rids, flat, least, largest = (c[r].values.to_numpy(zero_copy_only=False) for c in names)
                waiting.append((own, own_rids, flat.reshape(len(own), len(least)), least, largest))
                if len(waiting) == group:
                    search_blocks(best, queries, waiting)
                    waiting = []
        if waiting:
            search_blocks(best, queries, waiting)
        q, place = np.nonzero(best.found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rids[q]), pa.array(ids[q]), pa.array(best.id[q, place]), pa.array(best.score[q, place])],
            ["query_rid", "query_id", "vec_id", "score"])

    return run


def top_k(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          block_rows: int = BLOCK_ROWS, group: int = GROUP, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score); ``is_query`` is a condition on column ``id``."""
    spark = rows.sparkSession
    vectors = store(integer_vectors(rows, id_col, vector_col))
    ranges = max(1, vectors.count() // (block_rows * group))
    blocks = store(vectors.repartitionByRange(ranges, "id").sortWithinPartitions("id").mapInArrow(_cut(block_rows), _BLOCK))
    asked = store(vectors.where(is_query))
    chunks = asked.repartition(max(1, -(-asked.count() // chunk_rows))).mapInArrow(_cut(chunk_rows), _BLOCK).select("ids", "rids", "weights")
    found = None
    for row in store(chunks).toLocalIterator():
        ids = np.array(row["ids"], np.int64)
        weights = np.array(row["weights"], np.int64).reshape(len(ids), -1)
        chunk = spark.sparkContext.broadcast((ids, np.array(row["rids"], np.int64), weights))
        part = blocks.mapInArrow(_search(chunk, k, group), "query_rid bigint, query_id bigint, vec_id bigint, score bigint")
        first = Window.partitionBy("query_rid").orderBy(F.col("score").desc(), "vec_id")
        part = store(part.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).drop("query_rid"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "query_id bigint, vec_id bigint, score bigint, rank int")
    return found.select("query_id", "rank", "vec_id", "score")
