"""One interface for every target; the format is an argument, never global state.

All writes overwrite, so a repeated run gives the same result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

INSERT_BATCH = 5000
LAYERS = ("raw", "processed", "curated")
LAKE_PARTITION = "created_date"


class NothingPublished(RuntimeError):
    """A publish without a single table is an error, not a success."""


@dataclass
class Target:
    """Where tables go: ``fmt`` is parquet, orc, csv, json, table, jdbc or a connector name."""

    fmt: str = "parquet"
    location: str = ""
    options: dict[str, str] = field(default_factory=dict)


def _files(df: DataFrame, name: str, target: Target, partition: str | None) -> None:
    writer = df.write.mode("overwrite").format(target.fmt).options(**target.options)
    if target.fmt == "csv":
        writer = writer.option("header", True)
    if partition:
        writer = writer.partitionBy(partition)
    writer.save(f"{target.location.rstrip('/')}/{name}")


def _table(df: DataFrame, name: str, target: Target, bucket: tuple[str, int] | None) -> None:
    """``location`` is the database; bucketed tables later join on the key without exchange."""
    database = target.location or "default"
    df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`")
    writer = df.write.mode("overwrite").format(target.options.get("provider", "parquet"))
    if bucket:
        column, count = bucket
        # one task per bucket, else every task writes a file for every bucket
        shuffled = df.repartition(count, column)
        writer = shuffled.write.mode("overwrite").format(target.options.get("provider", "parquet"))
        writer = writer.bucketBy(count, column).sortBy(column)
    writer.saveAsTable(f"`{database}`.`{name}`")


def jdbc_options(name: str, target: Target) -> dict[str, str]:
    """Overwrite by TRUNCATE keeps dependent views alive; rows go in batches."""
    schema = target.options.get("schema", "raw")
    rest = {k: v for k, v in target.options.items() if k != "schema"}
    return {
        "url": target.location,
        "dbtable": f"{schema}.{name}",
        "batchsize": str(INSERT_BATCH),
        "truncate": "true",
        **rest,
    }


def _jdbc(df: DataFrame, name: str, target: Target) -> None:
    df.write.mode("overwrite").format("jdbc").options(**jdbc_options(name, target)).save()


def _connector(df: DataFrame, name: str, target: Target) -> None:
    """Any other registered data source, e.g. a cloud warehouse connector."""
    df.write.mode("overwrite").format(target.fmt).options(
        **{"dbtable": name.upper(), **target.options}
    ).save()


def publish(
    df: DataFrame,
    name: str,
    target: Target,
    partition: str | None = None,
    bucket: tuple[str, int] | None = None,
) -> int:
    """Write one table and return its row count, observed during the write itself."""
    seen = Observation(f"publish_{name}")
    observed = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
    if target.fmt == "table":
        _table(observed, name, target, bucket)
    elif target.fmt == "jdbc":
        _jdbc(observed, name, target)
    elif target.fmt in ("parquet", "orc", "csv", "json", "text"):
        _files(observed, name, target, partition)
    else:
        _connector(observed, name, target)
    return seen.get["n_rows"]


def materialise_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def publish_layers(tables: dict[str, dict[str, DataFrame]], lake: str) -> dict[str, int]:
    """Write ``{layer: {table: df}}`` below ``lake``; any Hadoop file system URI works.

    Tables that carry a creation date are partitioned by it, so date filters prune files.
    """
    unknown = set(tables) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    written = {}
    for layer in LAYERS:
        target = Target("parquet", f"{lake.rstrip('/')}/{layer}")
        for name, df in tables.get(layer, {}).items():
            dated = LAKE_PARTITION in df.columns
            if dated:
                # rows of a day meet in few files; AQE splits a day that is too large
                df = df.hint("rebalance", LAKE_PARTITION)
            written[f"{layer}/{name}"] = publish(
                df, name, target, LAKE_PARTITION if dated else None
            )
    if not written:
        raise NothingPublished(f"no table was written to {lake}")
    return written


def write_document(document: DataFrame, path: str) -> None:
    """A one-row JSON document as a text file."""
    document.coalesce(1).write.mode("overwrite").text(path)


def write_json_array(df: DataFrame, path: str, options: dict[str, str] | None = None) -> None:
    """Every partition as one file that holds one JSON array; ``options`` are those of ``to_json``."""

    def frame(batches):
        opened = False
        for batch in batches:
            if batch.num_rows:
                text = ("," if opened else "[") + ",".join(batch.column(0).to_pylist())
                opened = True
                yield pa.RecordBatch.from_pydict({"value": [text]})
        yield pa.RecordBatch.from_pydict({"value": ["]" if opened else "[]"]})

    records = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", **(options or {})}).alias("value"))
    records.mapInArrow(frame, "value string").write.mode("overwrite").option("lineSep", " ").text(path)


def read_layer(spark: SparkSession, lake: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{lake.rstrip('/')}/{layer}/{name}")
