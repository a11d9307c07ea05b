"""Declarative data tests: not_null, unique, accepted_values, relationships."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter import domain


@dataclass(frozen=True)
class Check:
    """One data test; it passes when no row fails."""

    kind: str
    model: str
    column: str
    values: tuple = field(default=())
    parent: str = ""
    parent_column: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"


STAGING_CHECKS = [
    Check("not_null", "stg_tickets", "ticket_id"),
    Check("unique", "stg_tickets", "ticket_id"),
    Check("not_null", "stg_predictions", "ticket_id"),
]
MART_CHECKS = [
    Check("not_null", "fct_tickets", "ticket_id"),
    Check("unique", "fct_tickets", "ticket_id"),
    Check("accepted_values", "fct_tickets", "priority", tuple(domain.PRIORITIES)),
    Check("accepted_values", "fct_tickets", "sla_breach", (0, 1)),
    Check("not_null", "fct_predictions", "ticket_id"),
    Check("relationships", "fct_predictions", "ticket_id", (), "fct_tickets", "ticket_id"),
    Check("not_null", "mart_ticket_decision", "ticket_id"),
]
CHECKS = STAGING_CHECKS + MART_CHECKS


class QualityError(RuntimeError):
    """At least one data test found failing rows."""


def duplicated_keys(df: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once; missing keys are not duplicates."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where("n_rows > 1")
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent; a missing child key passes.

    The parent key must be unique (it has its own test), so the anti join needs no distinct.
    """
    keys = parent.select(F.col(parent_column).alias("_parent"))
    return child.where(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("_parent"), "left_anti"
    )


def _row_failures(check: Check):
    column = F.col(check.column)
    if check.kind == "not_null":
        return F.count_if(column.isNull())
    return F.count_if(column.isNotNull() & ~column.isin(list(check.values)))


def scalar_report(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-wise checks of one model in a single aggregate pass."""
    counted = df.agg(*[_row_failures(c).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(
            F.lit(c.kind).alias("test"),
            F.lit(c.model).alias("model"),
            F.lit(c.column).alias("column"),
            F.col(f"c{i}").cast("bigint").alias("failures"),
        )
        for i, c in enumerate(checks)
    ])
    return counted.select(F.inline(rows))


def _counted(failing: DataFrame, check: Check) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check.kind).alias("test"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column"),
        "failures",
    )


def report(models: dict[str, DataFrame], checks: list[Check] = CHECKS) -> DataFrame:
    """(test, model, column, failures, status) for every check."""
    parts, scalar = [], {}
    for check in checks:
        df = models[check.model]
        if check.kind in ("not_null", "accepted_values"):
            scalar.setdefault(check.model, []).append(check)
        elif check.kind == "unique":
            parts.append(_counted(duplicated_keys(df, check.column), check))
        elif check.kind == "relationships":
            parent = models[check.parent]
            parts.append(_counted(orphans(df, check.column, parent, check.parent_column), check))
        else:
            raise ValueError(f"unknown kind of check: {check.kind}")
    parts += [scalar_report(models[m], group) for m, group in scalar.items()]
    united = reduce(DataFrame.unionByName, parts)
    return united.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("ERROR"))


def totals(quality_report: DataFrame) -> DataFrame:
    """One row: how many checks passed and failed."""
    return quality_report.agg(
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "ERROR").alias("errors"),
    )


def enforce(quality_report: DataFrame) -> list:
    """Run the checks and raise when one fails. One row per check reaches the driver."""
    rows = quality_report.collect()
    failed = [r for r in rows if r["status"] != "PASS"]
    if failed:
        raise QualityError(
            "; ".join(f"{r['test']} {r['model']}.{r['column']}: {r['failures']}" for r in failed)
        )
    return rows
