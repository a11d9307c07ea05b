"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "deskmeter", **extra: str) -> SparkSession:
    """Build (or reuse) a session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_test_folder: str | None = None
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session that names none (a local test) gets a temporary folder of its own.
    """
    global _test_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _test_folder = _test_folder or tempfile.mkdtemp(prefix="deskmeter-")
        named = _test_folder
    return named.rstrip("/")


def at_least(df: DataFrame, parts: int | None) -> DataFrame:
    """``df`` in ``parts`` tasks at least; unchanged where it has as many, or none are asked for."""
    if parts is None or df.rdd.getNumPartitions() >= parts:
        return df
    return df.repartition(parts)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from the stored rows.

    Cuts the lineage like a checkpoint, but is columnar: readers load only the columns they
    need. Every call has its own folder, so a repeated run never meets older files.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/deskmeter-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs meanwhile go as soon as it has ended, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
