"""Connected components by contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter.llm.common import store


def relabel(labels: DataFrame | None, rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with the ids in ``columns`` replaced by their labels, where they have one."""
    if labels is None:
        return rows
    for c in columns:
        known = labels.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
        rows = rows.join(known, F.col(c) == F.col("_id"), "left").withColumn(c, F.coalesce("_label", c)).drop("_id", "_label")
    return rows


def contract(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame | None:
    """Labels (id, label) of the ids that ``edges`` (u, v) connect, on top of earlier ``labels``.

    Every id moves to that neighbour (or itself) which comes first in an order hashed anew each
    round; then edges between the new places are the next round's. The expected number of rounds
    is logarithmic, whatever the shape. Ids without a label are components of their own.
    """
    level = 0
    edges = store(relabel(labels, edges, "u", "v").where("u <> v").distinct())
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        here = F.struct(F.xxhash64("u", F.lit(level)).alias("p"), F.col("u").alias("i"))
        there = F.min(F.struct(F.xxhash64("v", F.lit(level)).alias("p"), F.col("v").alias("i")))
        moves = both.groupBy("u").agg(there.alias("there")).select(
            F.col("u").alias("id"), F.least(here, F.col("there"))["i"].alias("label"))
        moves = store(moves)
        if labels is None:
            labels = moves
        else:
            fresh = moves.join(labels.select("id"), "id", "left_anti")
            labels = store(relabel(moves, labels, "label").unionByName(fresh))
        edges = store(relabel(moves, edges, "u", "v").where("u <> v").distinct())
        level += 1
    return labels
