"""Daily figures by event time: a day is announced once, when it is final, and later rows as signed corrections.

A day is final when the latest event seen lies ``delay`` behind its end. State is what is still open, one row per day
and group, and the first day that is not final: it is bounded by the delay and not by the history. A micro-batch reads the state of the batch
before, and writes its own state and announcements to its own folder; replayed, it overwrites them with the
same. A watermark of the engine would drop late rows, so finality is kept here, and every row counts.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deskmeter.sources.inventory import matching

FINAL, CORRECTION = "final", "correction"


def _batches(spark: SparkSession, state: str) -> list[int]:
    """Batches whose state, written last, is complete."""
    return sorted(int(p.split("batch=")[1].split("/")[0]) for p in matching(spark, f"{state}/batch=*/open/_SUCCESS"))


def _sums(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy("day", by).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_flagged").alias("n_flagged"))


def take_batch(batch: DataFrame, batch_id: int, state: str, ts: str, flag: str, by: str, delay_days: int) -> None:
    """Announce what has become final with these rows, and correct what was final before."""
    spark = batch.sparkSession
    before = [b for b in _batches(spark, state) if b < batch_id]
    counted = _sums(batch.where(F.col(ts).isNotNull()).select(
        F.to_date(ts).alias("day"), by, F.lit(1).cast("bigint").alias("n_rows"),
        F.coalesce(F.col(flag).cast("bigint"), F.lit(0)).alias("n_flagged")), by)
    place, begin, latest = f"{state}/batch={batch_id}", date(1900, 1, 1), None
    if before:
        row = spark.read.parquet(f"{state}/batch={before[-1]}/mark").first()
        begin, latest = row["begin"], row["latest"]
    seen = batch.agg(F.max(F.to_date(ts)).alias("d"), F.max(F.col(ts).cast("timestamp_ntz")).alias("t")).first()
    latest = max((t for t in (latest, seen["t"]) if t is not None), default=None)
    # the first day that is not final after this batch
    reached = max(begin, latest.date() - timedelta(days=delay_days)) if latest else begin
    counted.write.mode("overwrite").parquet(f"{place}/counts")
    counted = spark.read.parquet(f"{place}/counts")
    late = counted.where(F.col("day") < F.lit(begin)).withColumn("kind", F.lit(CORRECTION))
    current = counted.where(F.col("day") >= F.lit(begin))
    if before:
        current = _sums(current.unionByName(spark.read.parquet(f"{state}/batch={before[-1]}/open")), by)
    done = current.where(F.col("day") < F.lit(reached)).withColumn("kind", F.lit(FINAL))
    done.unionByName(late).write.mode("overwrite").parquet(f"{place}/announced")
    spark.createDataFrame([(reached, latest)], "begin date, latest timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(f"{place}/mark")
    current.where(F.col("day") >= F.lit(reached)).write.mode("overwrite").parquet(f"{place}/open")


def start_daily_final(events: DataFrame, state: str, ts: str, flag: str, by: str, delay_days: int = 1) -> StreamingQuery:
    """Announce final days of a stream. A day is final ``delay_days`` whole days after its end."""
    return (
        events.writeStream.foreachBatch(lambda rows, n: take_batch(rows, n, f"{state}/days", ts, flag, by, delay_days))
        .option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    )


def announcements(spark: SparkSession, state: str) -> DataFrame:
    """(day, group, n_rows, n_flagged, kind, batch): everything announced so far, in any order."""
    done = _batches(spark, f"{state}/days")
    parts = [spark.read.parquet(f"{state}/days/batch={b}/announced").withColumn("batch", F.lit(b)) for b in done]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def open_days(spark: SparkSession, state: str) -> DataFrame:
    """(day, group, n_rows, n_flagged) of the days that are not final."""
    return spark.read.parquet(f"{state}/days/batch={_batches(spark, f'{state}/days')[-1]}/open")
