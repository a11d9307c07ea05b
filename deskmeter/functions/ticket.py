"""Ticket-domain expressions: date parts, SLA lookup, target, risk band, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskmeter import domain


def sla_minutes(priority: Column) -> Column:
    """SLA in minutes; NULL for an unknown or missing priority."""
    table = F.create_map(*[F.lit(x) for pair in domain.SLA_MINUTES.items() for x in pair])
    return F.try_element_at(table, priority)


def breach_flag(resolution_minutes: Column, sla: Column) -> Column:
    """1 when resolution exceeds the SLA (strictly); 0 when either side is missing."""
    return F.coalesce((resolution_minutes > sla).cast("int"), F.lit(0))


def date_parts(created_at: Column) -> dict[str, Column]:
    """Weekday counts from Monday = 0; month keeps no year."""
    return {
        "created_date": F.to_date(created_at),
        "created_hour": F.hour(created_at),
        "created_weekday": F.weekday(created_at),
        "created_month": F.month(created_at),
    }


def risk_band(score: Column) -> Column:
    high, medium, low = domain.RISK_BANDS
    return (
        F.when(score >= domain.HIGH_RISK, high)
        .when(score >= domain.MEDIUM_RISK, medium)
        .when(score.isNotNull(), low)
        .otherwise(domain.NO_SCORE)
    )


def severity_rank(priority: Column) -> Column:
    """1 for the most severe known priority; the lowest level and anything else rank last."""
    rank = F.when(priority == "Crítica", 1).when(priority == "Alta", 2).when(priority == "Média", 3)
    return rank.otherwise(4)


def band_rank(band: Column) -> Column:
    return F.when(band == "Alto", 1).when(band == "Médio", 2).otherwise(3)


def outcome_label(flag: Column, suffix: str) -> Column:
    return F.when(flag == 1, f"Violou ({suffix})").otherwise(f"Não violou ({suffix})")
