"""Global orderings without a single-task window.

``Window.orderBy`` without a partition sends every row to one task. Both helpers here rank
or accumulate inside range buckets in parallel and add the totals of the buckets that come
before; only the bucket totals, whose number is bounded, meet in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmeter.session import reliable_checkpoint

BUCKETS = 64


def surrogate_key(df: DataFrame, column: str, key: str) -> DataFrame:
    """Distinct values of ``column`` numbered 1..n in binary string order, NULL last.

    The distinct values are dealt out by ranges, sorted and stored with their range and place, so
    nothing but the number of values per range meets in one task, whatever prefixes they share.
    """
    order = F.col(column).asc_nulls_last()
    values = df.select(column).distinct().repartitionByRange(order).sortWithinPartitions(order)
    placed = reliable_checkpoint(values.withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.select(
        column, F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    joined = placed.join(offsets, "_range")
    return joined.select((F.col("_offset") + F.col("_place") + 1).cast("bigint").alias(key), column)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (all different in ``order``) with their number from 0 in that order, NULL first.

    They are dealt out by ranges, sorted and stored; only the number of rows per range meets in one task.
    """
    placed = reliable_checkpoint(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")).select(
        "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(starts, "_range").withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def cumulative_desc(
    df: DataFrame, by: list[str], key: str, sums: list[str], buckets: int | None = None
) -> DataFrame:
    """Running totals from the highest ``key`` down, per group, plus the group totals.

    ``df`` holds one row per (``by``, ``key``). For each name in ``sums`` the result gains
    ``cum_<name>`` (this row included) and ``all_<name>``. The cut points are quantiles over
    all rows, one short list whatever the number of groups. Rows and bucket totals meet on
    (``by``, bucket), the partitioning the window already has. There are as many buckets as shuffle partitions,
    ``BUCKETS`` at least.
    """
    buckets = buckets or max(BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    fractions = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = df.agg(F.percentile_approx(key, fractions, F.lit(16 * buckets)).alias("cuts")).scalar()
    placed = df.withColumn("_cuts", cuts).withColumn(
        "_bucket", F.size(F.filter("_cuts", lambda cut: cut < F.col(key)))
    ).drop("_cuts")

    within = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(F.col(key).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = placed.withColumns({f"cum_{s}": F.sum(s).over(within) for s in sums})

    # at most ``buckets`` rows per group from here on
    above = (
        Window.partitionBy(*by)
        .orderBy(F.col("_bucket").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*by)
    totals = placed.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(f"_in_{s}") for s in sums])
    offsets = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_in_{s}").over(above), F.lit(0)).alias(f"_above_{s}") for s in sums],
        *[F.sum(f"_in_{s}").over(whole).alias(f"all_{s}") for s in sums],
    )
    merged = local.join(offsets, [*by, "_bucket"])
    return merged.withColumns(
        {f"cum_{s}": F.col(f"cum_{s}") + F.col(f"_above_{s}") for s in sums}
    ).drop("_bucket", *[f"_above_{s}" for s in sums])


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The n first rows; each task keeps only its own n candidates."""
    return df.orderBy(*order).limit(n)
