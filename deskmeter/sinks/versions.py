"""Incremental publishing: only partitions whose rows have changed are written, readers see whole versions.

A partition's digest is the count of its rows and the sum of their hashes, twice with different seeds: it does not depend on the
rows' order and comes from one aggregate. A version is a manifest (partition, digest, rows, folder); unchanged
partitions keep the folder of an earlier version. The manifest is written behind the data, and a version counts from
the moment its manifest is complete; a run that dies before leaves the last version as it is, and its folders are never read.
Two writers of one table at a time are not supported.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskmeter.session import reliable_checkpoint
from deskmeter.sources.inventory import matching


def versions(spark: SparkSession, place: str) -> list[int]:
    """The complete versions of the table at ``place``."""
    return sorted(int(p.split("version=")[1].split("/")[0]) for p in matching(spark, f"{place}/manifests/version=*/_SUCCESS"))


def manifest(spark: SparkSession, place: str, version: int | None = None) -> DataFrame:
    """(part, n_rows, first_sum, second_sum, folder) of a version, the last one by default."""
    known = versions(spark, place)
    return spark.read.parquet(f"{place}/manifests/version={known[-1] if version is None else version}")


def digests(df: DataFrame, partition: str) -> DataFrame:
    """(part, n_rows, first_sum, second_sum) of each value of ``partition``."""
    columns = [F.col(c) for c in sorted(df.columns)]
    nulls = F.array(*[c.isNull() for c in columns])  # a hash passes nulls over

    def total(seed: int):
        return F.sum(F.xxhash64(F.lit(seed), nulls, *columns).cast("decimal(38,0)"))

    return df.groupBy(F.col(partition).cast("string").alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"), total(1).alias("first_sum"), total(2).alias("second_sum"))


def publish_changed(df: DataFrame, place: str, partition: str) -> tuple[int, int]:
    """Publish ``df`` as a new version; returns its number and how many partitions were written.

    Without any change there is no new version. Partitions that have no rows any more are left out of the manifest.
    """
    spark, known = df.sparkSession, versions(df.sparkSession, place)
    now = reliable_checkpoint(digests(df, partition))
    names = ["part", "n_rows", "first_sum", "second_sum"]
    if known:
        old = manifest(spark, place)
        kept = reliable_checkpoint(now.alias("n").join(old.alias("o"), F.expr(
            "n.part <=> o.part AND n.n_rows = o.n_rows AND n.first_sum = o.first_sum AND n.second_sum = o.second_sum")
        ).select(*[F.col(f"n.{c}").alias(c) for c in names], "o.folder"))
        changed = now.join(kept.select(F.col("part").alias("_p")), F.expr("part <=> _p"), "left_anti")
        written = changed.count()
        if not written and kept.count() == old.count():
            return known[-1], 0
    else:
        kept, changed = None, now
        written = changed.count()
    version, folder = (known[-1] + 1 if known else 0), f"data/{uuid.uuid4().hex}"
    if written:
        parts = changed.select(F.col("part").alias("_p"))
        rows = df.join(parts, F.col(partition).cast("string").eqNullSafe(F.col("_p")), "left_semi")
        rows.hint("rebalance", partition).withColumn("_part", F.col(partition).cast("string")).write.partitionBy("_part").parquet(f"{place}/{folder}")
    listed = changed.select(*names, F.lit(folder).alias("folder"))
    listed = listed if kept is None else listed.unionByName(kept)
    listed.write.parquet(f"{place}/manifests/version={version}")
    return version, written


def read_version(spark: SparkSession, place: str, schema, version: int | None = None) -> DataFrame:
    """The rows of a version: its partitions, each from the folder that the manifest names."""
    parts = manifest(spark, place, version).select("part", "folder")
    folders = [r["folder"] for r in parts.select("folder").distinct().collect()]  # one per version that still holds a partition
    stored = T.StructType([*schema.fields, T.StructField("_part", T.StringType())])
    out = spark.createDataFrame([], schema)
    for folder in folders:
        here = parts.where(F.col("folder") == folder).select(F.col("part").alias("_p"))
        rows = spark.read.schema(stored).parquet(f"{place}/{folder}")
        out = out.unionByName(rows.join(here, F.col("_part").eqNullSafe(F.col("_p")), "left_semi").drop("_part"))
    return out
