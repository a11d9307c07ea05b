"""Reproducible train/test splits that do not depend on row order or partitioning.

Every row gets a seeded digest of its id; small digests are test rows. The same ids land
on the same side in every run, on every engine that has MD5, and stay there when rows are
appended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmeter import domain

MAX_LABELS = 1000


def digest(key: Column, seed: int = domain.SEED) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def threshold(fraction: float) -> str:
    """Hex digest below which a row is a test row (fixed width, so text order is numeric order)."""
    if not 0.0 <= fraction < 1.0:
        raise ValueError("fraction must be in [0, 1)")
    return format(int(fraction * 2**128), "032x")


def is_test(key: Column, fraction: float = domain.TEST_FRACTION, seed: int = domain.SEED) -> Column:
    """Row-wise split: no shuffle, the size is approximately ``fraction``."""
    return digest(key, seed) < threshold(fraction)


def hash_split(
    df: DataFrame, key: str = "ticket_id", fraction: float = domain.TEST_FRACTION, seed: int = domain.SEED
) -> DataFrame:
    return df.withColumn("is_test", is_test(F.col(key), fraction, seed).cast("int"))


def test_quota(counts: DataFrame, label: str, fraction: float) -> DataFrame:
    """Adds ``n_test`` to (label, n_rows): ceil(fraction * n) rows shared out in proportion.

    Each label gets the floor of its share; the rows left over go to the largest
    remainders (lower label first). One row per label, so the small windows are bounded.
    """
    everything = Window.partitionBy(F.lit(0))
    share = counts.withColumn("_all", F.sum("n_rows").over(everything)).withColumn(
        "_test", F.ceil(F.col("_all") * F.lit(float(fraction)))
    ).withColumn("_share", F.col("n_rows") * F.col("_test") / F.col("_all"))
    floored = share.withColumn("_floor", F.floor("_share").cast("bigint")).withColumn(
        "_left", F.col("_test") - F.sum("_floor").over(everything)
    )
    by_remainder = everything.orderBy(F.desc(F.col("_share") - F.col("_floor")), F.asc(label))
    rank = F.row_number().over(by_remainder)
    return floored.withColumn("_rank", rank).select(
        label,
        "n_rows",
        (F.col("_floor") + (F.col("_rank") <= F.col("_left")).cast("int")).cast("bigint").alias("n_test"),
    )


def _bounded(rows: DataFrame, label: str) -> list:
    """One row per label on the driver; a column with more labels than that is no label."""
    found = rows.limit(MAX_LABELS + 1).collect()
    if len(found) > MAX_LABELS:
        raise ValueError(f"{label} has more than {MAX_LABELS} values, too many to stratify by")
    return found


def _by_label(label: str, values: dict) -> Column:
    """A literal per label, NULL for labels that have none."""
    chosen = F.lit(None)
    for name, value in values.items():
        chosen = F.when(F.col(label).eqNullSafe(F.lit(name)), F.lit(value)).otherwise(chosen)
    return chosen


def stratified_split(
    df: DataFrame,
    label: str,
    key: str = "ticket_id",
    fraction: float = domain.TEST_FRACTION,
    seed: int = domain.SEED,
) -> DataFrame:
    """Exact stratified split: per label the ``n_test`` smallest digests are test rows.

    A window over each label would put a whole label in one task. Instead the digests are
    counted in 65 536 prefix buckets; the counts tell in which bucket the quota is reached,
    and only that bucket's rows are ranked to find the label's last test digest. What comes
    back is one digest per label, so the split itself is a row-wise comparison without join
    or exchange. ``key`` must be unique. Reads ``df`` twice before returning.
    """
    df = df.withColumn("_digest", digest(F.col(key), seed)).withColumn(
        "_bucket", F.substring("_digest", 1, 4)
    )
    counts = df.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    quota = test_quota(counts.groupBy(label).agg(F.sum("_n").alias("n_rows")), label, fraction)
    running = Window.partitionBy(label).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # the first bucket that reaches the quota, and how many of its rows are needed
    reached = counts.withColumn("_upto", F.sum("_n").over(running)).join(
        quota.withColumnRenamed(label, "_label"), F.col(label).eqNullSafe(F.col("_label"))
    ).where((F.col("_upto") >= F.col("n_test")) & (F.col("n_test") > 0))
    take = F.col("n_test") - F.col("_upto") + F.col("_n")
    edges = _bounded(
        reached.groupBy(label).agg(F.min(F.struct("_bucket", take.alias("_take"))).alias("e")), label
    )
    bucket_of = _by_label(label, {r[label]: r["e"]["_bucket"] for r in edges})
    take_of = _by_label(label, {r[label]: r["e"]["_take"] for r in edges})
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_digest"))
    last = (
        df.where(F.col("_bucket") == bucket_of)
        .select(label, "_digest")
        .withColumn("_rank", rank)
        .where(F.col("_rank") == take_of)
    )
    last_of = _by_label(label, {r[label]: r["_digest"] for r in _bounded(last, label)})
    chosen = F.coalesce((F.col("_digest") <= last_of).cast("int"), F.lit(0))
    return df.withColumn("is_test", chosen).drop("_digest", "_bucket")
