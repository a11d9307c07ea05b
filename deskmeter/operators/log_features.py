"""Event-log features, for nested records and for flat event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def log_features_nested(df: DataFrame, key: str = "ticket_id", events: str = "events") -> DataFrame:
    """One row per record, no shuffle. A missing list counts as empty."""
    items = F.col(events)
    statuses = F.filter(items, lambda e: F.coalesce(e["to_status"], F.lit("")) != "")
    return df.select(
        key,
        F.coalesce(F.array_size(items), F.lit(0)).alias("n_events"),
        F.greatest(F.lit(0), F.coalesce(F.array_size(statuses), F.lit(0)) - 1).alias("n_status_changes"),
        F.coalesce(F.exists(items, lambda e: F.coalesce(e["event"], F.lit("")) == "reopened"), F.lit(False))
        .cast("int")
        .alias("reopened_from_log"),
    )


def log_partials(df: DataFrame, key: str = "ticket_id") -> DataFrame:
    """Mergeable counts per ticket: all three add up (or max) over any split of the log."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.coalesce("to_status", F.lit("")) != "").alias("n_statuses"),
        F.max((F.coalesce("event", F.lit("")) == "reopened").cast("int")).alias("reopened_from_log"),
    )


def merge_partials(df: DataFrame, key: str = "ticket_id") -> DataFrame:
    """Several partial rows of a ticket as one partial row."""
    return df.groupBy(key).agg(
        F.sum("n_events").alias("n_events"),
        F.sum("n_statuses").alias("n_statuses"),
        F.max("reopened_from_log").alias("reopened_from_log"),
    )


def finish_partials(df: DataFrame, key: str = "ticket_id") -> DataFrame:
    """Merged partials with the status count turned into changes."""
    return _changes(merge_partials(df, key), key)


def log_features_flat(df: DataFrame, key: str = "ticket_id") -> DataFrame:
    """One row per ticket; counts are combined map-side, so a hot ticket costs one row per task."""
    return _changes(log_partials(df, key), key)


def _changes(df: DataFrame, key: str) -> DataFrame:
    return df.select(
        key,
        "n_events",
        F.greatest(F.lit(0).cast("bigint"), F.col("n_statuses") - 1).alias("n_status_changes"),
        "reopened_from_log",
    )
