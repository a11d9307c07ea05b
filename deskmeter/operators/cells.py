"""Dashboard figures kept as mergeable cells, and cards answered from them.

A cell holds the sums and counts behind every figure for one combination of priority, category, channel and month. All
sixteen levels (subsets of the four) come from one scan of the fact, combined map-side, and each is a folder of its
own. Cells add up: every batch of tickets adds a folder of cells, a replayed batch overwrites its own, and
``compact`` folds them into one. A card reads only the level of the columns it filters and groups by, the smallest that
can answer it; the number of cells does not grow with the tickets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deskmeter.functions.numeric import round_scaled
from deskmeter.operators.cards import BREAKDOWNS
from deskmeter.operators.filters import apply_filters
from deskmeter.sources.inventory import matching

COLUMNS = tuple(BREAKDOWNS.values())
#: Column of the fact -> names of its sum and of the count of its values.
MEASURES = {
    "sla_breach": ("breaches", "breach_n"), "resolution_minutes": ("resolution", "resolution_n"),
    "first_response_minutes": ("response", "response_n"), "reopened": ("reopens", "reopen_n"), "csat_score": ("csat", "csat_n"),
}


def level_of(columns) -> int:
    """The number of a level: a bit for every column it has."""
    return sum(1 << i for i, c in enumerate(COLUMNS) if c in columns)


def build_cells(fct: DataFrame) -> DataFrame:
    """(level, the four columns, n, sums and counts) at all levels; columns that a level lacks are null."""
    sums = [F.count(F.lit(1)).alias("n")]
    for column, (total, count) in MEASURES.items():
        sums += [F.coalesce(F.sum(F.col(column).cast("double")), F.lit(0.0)).alias(total), F.count(column).alias(count)]
    level = sum((F.when(F.grouping(c) == 0, 1 << i).otherwise(0) for i, c in enumerate(COLUMNS)), F.lit(0))
    return fct.select(*COLUMNS, *MEASURES).cube(*COLUMNS).agg(level.alias("level"), *sums)


def merged(cells: DataFrame) -> DataFrame:
    names = ["n", *(name for pair in MEASURES.values() for name in pair)]
    return cells.groupBy("level", *COLUMNS).agg(*[F.sum(name).alias(name) for name in names])


def add_batch(fct: DataFrame, folder: str, batch: int) -> None:
    """Store the cells of one batch of tickets; the same batch again overwrites them."""
    build_cells(fct).repartition("level").write.mode("overwrite").partitionBy("level").parquet(f"{folder}/batches/batch={batch}")


def start_cells(tickets: DataFrame, folder: str) -> StreamingQuery:
    """Keep the cells of a stream of fact rows."""
    return (
        tickets.writeStream.foreachBatch(lambda rows, batch: add_batch(rows, folder, batch))
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.rsplit("=", 1)[1].split("/")[0]) for name in matching(spark, f"{path}=*/_SUCCESS"))


def _folders(spark: SparkSession, folder: str) -> tuple[list[str], int]:
    """The newest finished snapshot and the batches after it, and the number of the last batch."""
    snapshots = _numbers(spark, f"{folder}/snapshots/upto")
    upto = snapshots[-1] if snapshots else -1
    after = [b for b in _numbers(spark, f"{folder}/batches/batch") if b > upto]
    paths = [f"{folder}/batches/batch={b}" for b in after] + [f"{folder}/snapshots/upto={upto}"] * bool(snapshots)
    return paths, max([upto, *after])


def compact(spark: SparkSession, folder: str) -> int:
    """Fold all batches so far into one snapshot; returns the last batch in it."""
    paths, last = _folders(spark, folder)
    whole = None
    for path in paths:
        part = spark.read.parquet(path)
        whole = part if whole is None else whole.unionByName(part)
    merged(whole).repartition("level").write.mode("overwrite").partitionBy("level").parquet(f"{folder}/snapshots/upto={last}")
    return last


def read_level(spark: SparkSession, folder: str, level: int) -> DataFrame:
    """The cells of one level, from the folders of this level alone."""
    return spark.read.parquet(*[f"{path}/level={level}" for path in _folders(spark, folder)[0]])


def summary(spark: SparkSession, folder: str, by: str | None = None, **selected) -> DataFrame:
    """One row (or one per value of ``by``): the figures of the cards ``kpi_global`` and ``breach_by_...``.

    ``selected`` are the filters of the dashboard; those not chosen need no column.
    """
    chosen = {name: values for name, values in selected.items() if values is not None and values != []}
    columns = {BREAKDOWNS[name] for name in chosen} | ({BREAKDOWNS[by]} if by else set())
    cells = apply_filters(read_level(spark, folder, level_of(columns)), **chosen)
    group = [F.col(BREAKDOWNS[by]).alias("valor")] if by else []

    def mean(column: str):
        total, count = MEASURES[column]
        return F.try_divide(F.sum(total), F.sum(count))

    return cells.groupBy(*group).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("chamados"),
        round_scaled(mean("sla_breach") * 100, 1).alias("taxa_violacao_pct"),
        round_scaled(mean("resolution_minutes"), 1).alias("tempo_medio_resolucao_min"),
        round_scaled(mean("first_response_minutes"), 1).alias("tempo_medio_1a_resposta_min"),
        round_scaled(mean("reopened") * 100, 1).alias("taxa_reabertura_pct"),
        round_scaled(mean("csat_score"), 2).alias("csat_medio"))
