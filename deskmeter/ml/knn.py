"""Exact k nearest neighbours as Spark joins of bounded blocks.

Inputs are ``query(id, features)`` and ``train(id, label, features)`` with unique ids and
equally long ``array<double>`` features. Distances are squared Euclidean, resolved to nine
decimals; equal distances are ordered by neighbour id, so results do not depend on
partitioning.

Two routes give the same neighbours:

* ``knn_blocked`` compares every query with every training row, block by block;
* ``knn_pruned`` assigns training rows to the cell of their nearest pivot, searches each
  query's own cells first and then only those other cells that the triangle inequality
  cannot rule out (the scheme of Lu et al., PVLDB 2012).

In both, a task sees one block of training rows and one block of queries, whose sizes are
set by counts beforehand however skewed the cells are, and returns at most k rows per
query. No pair of rows leaves a task.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from deskmeter import domain
from deskmeter.session import reliable_checkpoint

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGITS = 9
QUERY_ROWS = 8192
TRAIN_ROWS = 16384
MAX_PIVOTS = 1024
_SLICE = 65536
#: Entries of a matrix of distances that are looked at together, and rows that are sent on together.
_ENTRIES = 1 << 19
_ROUTED = 4096


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    """The list column as a matrix."""
    n = len(column)
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    values = flat.flatten().to_numpy(zero_copy_only=False)
    if n and (flat.null_count or len(values) % n):
        raise ValueError("feature vectors must be present and equally long")
    return values.reshape(n, -1).astype(np.float64, copy=False)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    cross = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(cross, 0.0)


def _rounding(squares: np.ndarray, dimensions: int) -> np.ndarray:
    """A bound of the error of ``_squared`` for vectors whose squared norms add up to ``squares``."""
    return 16.0 * np.finfo(float).eps * (dimensions + 4) * squares


def block_neighbours(query: np.ndarray, train: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, train row, squared distance) of the k best per query inside one block.

    ``train`` is sorted by id, so the row number breaks ties. The matrix product only
    preselects, from vectors moved to the middle of the block and with room for its rounding
    error, which grows with their norms; what it keeps is measured again directly.
    """
    middle = train.mean(0) if len(train) else 0.0
    moved, norms = train - middle, ((train - middle) ** 2).sum(1).max(initial=0.0)
    out_q, out_t, out_d = [], [], []
    take = min(k, len(train))
    step = max(1, _ENTRIES // max(1, len(train)))
    for start in range(0, len(query), step):
        part = query[start:start + step]
        near = part - middle
        rough = _squared(near, moved)
        kth = np.partition(rough, take - 1, axis=1)[:, take - 1]
        room = 2.0 * 10.0**-DIGITS + _rounding((near * near).sum(1) + norms, train.shape[1])
        rows, cols = np.nonzero(rough <= (kth + room)[:, None])
        exact = np.empty(len(rows))
        for lo in range(0, len(rows), _SLICE):
            r, c = rows[lo:lo + _SLICE], cols[lo:lo + _SLICE]
            exact[lo:lo + _SLICE] = ((part[r] - train[c]) ** 2).sum(1)
        exact = np.round(exact, DIGITS)
        order = np.lexsort((cols, exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        first = np.searchsorted(rows, np.arange(len(part)))
        keep = np.arange(len(rows)) - first[rows] < take
        out_q.append(rows[keep] + start)
        out_t.append(cols[keep])
        out_d.append(exact[keep])
    return np.concatenate(out_q), np.concatenate(out_t), np.concatenate(out_d)


def _pair_search(queries: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """Match both sides on (cell, train part, query part) and search inside each block pair.

    Both inputs carry ``cell``, ``t_parts`` and ``q_parts``, the numbers of parts their cell
    is cut into.
    """
    key = ["cell", "t_part", "q_part"]
    # fresh column names: both sides may stem from the same table
    left = queries.select(
        F.col("id").alias("query_id"), F.col("features").alias("query_features"),
        F.col("cell").alias("cell"),
        F.pmod(F.xxhash64("id"), "q_parts").cast("int").alias("q_part"),
        F.explode(F.sequence(F.lit(0), F.col("t_parts") - 1)).alias("t_part"),
    )
    right = train.select(
        "id", "label", "features", "cell",
        F.pmod(F.xxhash64("id", "features"), "t_parts").cast("int").alias("t_part"),
        F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q_part"),
    )
    id_type, neighbour_type = queries.schema["id"].dataType, train.schema["id"].dataType
    schema = T.StructType([
        T.StructField("id", id_type),
        T.StructField("neighbour", neighbour_type),
        T.StructField("label", T.IntegerType()),
        T.StructField("d2", T.DoubleType()),
    ])

    def search(q: pa.Table, t: pa.Table) -> pa.Table:
        if not len(q) or not len(t):
            return pa.table({
                "id": q["query_id"].slice(0, 0),
                "neighbour": t["id"].slice(0, 0),
                "label": pa.array([], pa.int32()),
                "d2": pa.array([], pa.float64()),
            })
        t = t.take(pc.sort_indices(t, sort_keys=[("id", "ascending"), ("label", "ascending")]))
        at, to, d2 = block_neighbours(_rows(q["query_features"]), _rows(t["features"]), k)
        return pa.table({
            "id": q["query_id"].take(pa.array(at)),
            "neighbour": t["id"].take(pa.array(to)),
            "label": t["label"].take(pa.array(to)).cast(pa.int32()),
            "d2": pa.array(d2),
        })

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, schema)


def _best(partial: DataFrame, k: int) -> DataFrame:
    """Merge block results: the k first per query, already limited to k before the exchange."""
    order = Window.partitionBy("id").orderBy("d2", "neighbour")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _without_copies(train: DataFrame, k: int) -> DataFrame:
    """At most k rows per identical vector, those with the smallest ids.

    Exact: copies are equally far from any query, so later ones can never be among the k
    nearest. The rank limit is applied in each task before the exchange, so a vector that
    makes up a large share of the rows sends k rows per task.
    """
    order = Window.partitionBy("features").orderBy("id", "label")
    return (
        train.select("id", F.col("label").cast("int").alias("label"), F.col("features").cast("array<double>").alias("features"))
        .withColumn("_copy", F.row_number().over(order))
        .where(F.col("_copy") <= k)
        .drop("_copy")
    )


def _queries(query: DataFrame) -> DataFrame:
    return query.select("id", F.col("features").cast("array<double>").alias("features"))


def _parts(rows: int, block: int) -> int:
    return max(1, math.ceil(rows / block))


def _splits(spark, train_counts: dict[int, int], query_counts: dict[int, int]) -> DataFrame:
    """(cell, t_parts, q_parts), one row per cell in use: at most ``MAX_PIVOTS`` rows."""
    rows = [
        (cell, _parts(train_counts[cell], TRAIN_ROWS), _parts(n, QUERY_ROWS))
        for cell, n in query_counts.items()
        if train_counts.get(cell)
    ]
    return F.broadcast(spark.createDataFrame(rows, "cell int, t_parts int, q_parts int"))


def _counts(df: DataFrame) -> dict[int, int]:
    """Rows per cell; at most ``MAX_PIVOTS`` cells."""
    return {r["cell"]: r["n"] for r in df.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}


def knn_blocked(query: DataFrame, train: DataFrame, k: int = domain.NEIGHBOURS) -> DataFrame:
    """(id, neighbour, label, d2, rank) by comparing everything, in bounded blocks."""
    # upper bounds are enough to size the blocks, so the copies need not be counted again
    cut = {
        "cell": F.lit(0),
        "t_parts": F.lit(_parts(train.count(), TRAIN_ROWS)),
        "q_parts": F.lit(_parts(query.count(), QUERY_ROWS)),
    }
    queries, rows = _queries(query), _without_copies(train, k)
    return _best(_pair_search(queries.withColumns(cut), rows.withColumns(cut), k), k)


def choose_pivots(train: DataFrame) -> np.ndarray:
    """A bounded, reproducible sample of distinct training vectors (about sqrt(n) / 2)."""
    wanted = min(MAX_PIVOTS, max(8, math.isqrt(train.count()) // 2))
    order = F.xxhash64("id", "features")
    rows = train.select(order.alias("h"), "id", "features").orderBy("h", "id").limit(2 * wanted).collect()
    distinct = dict.fromkeys(tuple(r["features"]) for r in rows)
    return np.array(list(distinct)[:wanted], dtype=np.float64)


def _pieces(batches, columns: int):
    """Tables of so few rows that a matrix of ``columns`` columns beside them stays within ``_ENTRIES``."""
    step = max(1, _ENTRIES // max(1, columns))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield pa.Table.from_batches([batch.slice(start, step)])


def _assign(train: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot's cell and the distance to it."""
    schema = T.StructType([
        *train.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("radius", T.DoubleType()),
    ])

    def nearest(batches):
        for table in _pieces(batches, len(pivots)):
            d2 = _squared(_rows(table["features"]), pivots)
            cell = d2.argmin(1)
            table = table.append_column("cell", pa.array(cell, pa.int32()))
            table = table.append_column("radius", pa.array(np.sqrt(d2[np.arange(len(cell)), cell])))
            yield from table.to_batches()

    return train.mapInArrow(nearest, schema)


def _home_cells(queries: DataFrame, pivots: np.ndarray, sizes: np.ndarray, k: int) -> DataFrame:
    """Add ``homes``: the nearest cells that together hold at least k training rows."""
    schema = T.StructType([*queries.schema.fields, T.StructField("homes", T.ArrayType(T.IntegerType()))])

    def home(batches):
        for table in _pieces(batches, len(pivots)):
            order = _squared(_rows(table["features"]), pivots).argsort(1, kind="stable")
            reached = sizes[order].cumsum(1)
            need = np.minimum((reached < k).sum(1) + 1, len(pivots))
            homes = [[int(c) for c in row[:n] if sizes[c]] for row, n in zip(order, need)]
            table = table.append_column("homes", pa.array(homes, pa.list_(pa.int32())))
            yield from table.to_batches()

    return queries.mapInArrow(home, schema)


def _other_cells(
    queries: DataFrame, pivots: np.ndarray, sizes: np.ndarray, low: np.ndarray, high: np.ndarray
) -> DataFrame:
    """(id, features, cell) for the cells that may still hold something within ``limit``.

    A cell is ruled out when the query's distance to its shell (between the smallest and
    largest pivot distance of its members), or to the plane halfway between its pivot and
    the query's nearest one, exceeds the distance of the k-th neighbour known so far.
    """
    schema = T.StructType([
        queries.schema["id"], queries.schema["features"], T.StructField("cell", T.IntegerType()),
    ])
    between = np.sqrt(_squared(pivots, pivots))
    norms = (np.sqrt((pivots**2).sum(1)) + high).max(initial=0.0) ** 2  # no training row is longer

    def route(batches):
        for table in _pieces(batches, len(pivots)):
            d2 = _squared(_rows(table["features"]), pivots)
            d = np.sqrt(d2)
            limit = np.sqrt(table["limit"].to_numpy())
            shell = np.maximum(d - high[None, :], low[None, :] - d)
            gap = between[d2.argmin(1)]
            # distances are resolved to DIGITS decimals of their squares and computed with rounding errors
            squares = (_rows(table["features"]) ** 2).sum(1) + norms
            error = _rounding(squares, pivots.shape[1])
            reach = (np.sqrt(limit * limit + 2.0 * 10.0**-DIGITS) + 2.0 * np.sqrt(error))[:, None]
            with np.errstate(invalid="ignore"):
                beyond = np.where(gap > 0, 2.0 * gap * reach + 4.0 * error[:, None], np.inf)
            wanted = (shell <= reach) & (d2 - d2.min(1)[:, None] <= beyond) & (sizes > 0)[None, :]
            homes = table["homes"].combine_chunks()
            wanted[np.repeat(np.arange(len(table)), pc.list_value_length(homes)), pc.list_flatten(homes)] = False
            at, cell = np.nonzero(wanted)
            for start in range(0, len(at), _ROUTED):
                part = slice(start, start + _ROUTED)
                routed = table.select(["id", "features"]).take(pa.array(at[part]))
                yield from routed.append_column("cell", pa.array(cell[part], pa.int32())).to_batches()

    return queries.mapInArrow(route, schema)


def knn_pruned(query: DataFrame, train: DataFrame, k: int = domain.NEIGHBOURS) -> DataFrame:
    """(id, neighbour, label, d2, rank), skipping cells that cannot matter.

    The cell assignments and the first-round neighbours are checkpointed in the shared
    folder: they are read several times, and a recomputed matrix product may differ in the
    last bit, which must not move a row to another cell between two readings.
    """
    spark = query.sparkSession
    rows = _without_copies(train, k)
    pivots = choose_pivots(rows)
    assigned = reliable_checkpoint(_assign(rows, pivots))
    shells = assigned.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("radius").alias("low"), F.max("radius").alias("high")
    ).collect()
    sizes = np.zeros(len(pivots), dtype=np.int64)
    low, high = np.zeros(len(pivots)), np.zeros(len(pivots))
    for s in shells:
        sizes[s["cell"]], low[s["cell"]], high[s["cell"]] = s["n"], s["low"], s["high"]
    train_counts = {s["cell"]: s["n"] for s in shells}
    members = assigned.drop("radius")

    queries = reliable_checkpoint(_home_cells(_queries(query), pivots, sizes, k))
    at_home = queries.select("id", "features", F.explode("homes").alias("cell"))
    splits = _splits(spark, train_counts, _counts(at_home))
    found = _pair_search(at_home.join(splits, "cell"), members.join(splits, "cell"), k)
    near = reliable_checkpoint(_best(found, k).drop("rank"))

    limits = near.groupBy("id").agg(
        F.when(F.count(F.lit(1)) == k, F.max("d2")).otherwise(F.lit(float("inf"))).alias("limit")
    )
    bounded = queries.join(limits, "id")
    elsewhere = reliable_checkpoint(_other_cells(bounded, pivots, sizes, low, high))
    counts = _counts(elsewhere)
    if not counts:
        return _best(near, k)
    splits = _splits(spark, train_counts, counts)
    far = _pair_search(elsewhere.join(splits, "cell"), members.join(splits, "cell"), k)
    return _best(near.unionByName(far), k)


def vote(neighbours: DataFrame, cut: float = 0.5) -> DataFrame:
    """(id, score, y_pred): the share of positive neighbours, positive from ``cut`` on."""
    share = neighbours.groupBy("id").agg(F.avg("label").alias("score"))
    return share.withColumn("y_pred", (F.col("score") >= cut).cast("int"))


def knn_scores(query: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Votes joined to the queries' true labels: (id, y_true, score, y_pred)."""
    truth = query.select("id", F.col("label").cast("int").alias("y_true"))
    return truth.join(vote(neighbours), "id")
