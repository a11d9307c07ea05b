"""Ticket cleaning: trimmed categories, csat flag, date parts, SLA and target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter import domain
from deskmeter.functions import ticket


# everything Unicode counts as white space, not only blanks
_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def trim_categoricals(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Strip white space around every categorical. A missing value stays NULL."""
    columns = columns or [c for c in domain.CATEGORICAL if c in df.columns]
    return df.withColumns({c: F.btrim(F.col(c), F.lit(_SPACE)) for c in columns})


def add_date_parts(df: DataFrame, column: str = "created_at") -> DataFrame:
    return df.withColumns(ticket.date_parts(F.col(column)))


def add_sla(df: DataFrame) -> DataFrame:
    return df.withColumn("sla_minutes", ticket.sla_minutes(F.col("priority")))


def add_breach(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "sla_breach", ticket.breach_flag(F.col("resolution_minutes"), F.col("sla_minutes"))
    )


def clean_tickets(df: DataFrame) -> DataFrame:
    """The 22-column silver table: 15 raw columns and 7 derived ones. Purely row-wise."""
    df = trim_categoricals(df)
    df = df.withColumn("csat_missing", F.col("csat_score").isNull().cast("int"))
    return add_breach(add_sla(add_date_parts(df)))
