"""Incremental event feeds with Structured Streaming.

Both queries use ``availableNow``: a scheduled run takes what arrived since the last
checkpoint, in bounded micro-batches, and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deskmeter.operators.log_features import finish_partials, log_partials, merge_partials
from deskmeter.sources.inventory import is_file, matching


def stream_files(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """New Parquet files of a folder (or one file) as a stream, with the files' own schema."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option(
        "maxFilesPerTrigger", files_per_trigger
    )
    if is_file(spark, path):
        # a stream watches folders: take the parent and only this file name
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def start_log_partials(events: DataFrame, state: str, key: str = "ticket_id") -> StreamingQuery:
    """Aggregate each micro-batch on its own and keep the partial result.

    Counts and maxima merge over any split of the log, so no state has to be held between
    batches. A batch that is replayed after a failure overwrites its own folder.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        log_partials(batch, key).write.mode("overwrite").parquet(f"{state}/partials/batch={batch_id}")

    return (
        events.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the finished ``prefix=<n>`` folders below ``path``."""
    done = matching(spark, f"{path}/{prefix}=*/_SUCCESS")
    return sorted(int(name.split(f"{prefix}=")[1].split("/")[0]) for name in done)


def _stored_partials(spark: SparkSession, state: str) -> tuple[DataFrame, int]:
    """The newest snapshot and the batches after it, and the number of the last batch."""
    snapshots = _folders(spark, f"{state}/snapshots", "upto")
    upto = snapshots[-1] if snapshots else -1
    batches = [b for b in _folders(spark, f"{state}/partials", "batch") if b > upto]
    paths = [f"{state}/partials/batch={b}" for b in batches]
    if snapshots:
        paths.append(f"{state}/snapshots/upto={upto}")
    return spark.read.parquet(*paths), max([upto, *batches])


def compact_partials(spark: SparkSession, state: str, key: str = "ticket_id") -> int:
    """Fold all partials so far into one snapshot, one row per ticket.

    Readers use a snapshot only when it is complete and skip the batches inside it, so the
    cost of reading follows the number of tickets instead of the number of runs.
    """
    stored, last = _stored_partials(spark, state)
    merge_partials(stored, key).write.mode("overwrite").parquet(f"{state}/snapshots/upto={last}")
    return last


def read_log_features(spark: SparkSession, state: str, key: str = "ticket_id") -> DataFrame:
    """Log features over everything streamed so far."""
    return finish_partials(_stored_partials(spark, state)[0], key)


def _by_day(rows: DataFrame, by: str | None, **sums) -> DataFrame:
    return rows.groupBy("day", *([by] if by else [])).agg(*[e.alias(n) for n, e in sums.items()])


def start_daily_counts(events: DataFrame, state: str, ts: str, flag: str, by: str | None = None) -> StreamingQuery:
    """Rows and flagged rows per day (and group) of each micro-batch, kept as partial counts.

    Counts add up whatever the order in which days arrive, so no watermark is needed and no row is
    ever late. A replayed batch overwrites its own folder.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        flagged = F.sum(F.col(flag).cast("bigint"))
        rows = batch.withColumn("day", F.to_date(F.col(ts).cast("timestamp")))
        counts = _by_day(rows, by, n_rows=F.count(F.lit(1)), n_flagged=flagged)
        counts.write.mode("overwrite").parquet(f"{state}/partials/batch={batch_id}")

    return (
        events.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def read_daily_counts(spark: SparkSession, state: str, by: str | None = None) -> DataFrame:
    """The counts of everything streamed so far, the open days included."""
    stored = _stored_partials(spark, state)[0]
    return _by_day(stored, by, n_rows=F.sum("n_rows"), n_flagged=F.sum("n_flagged"))
