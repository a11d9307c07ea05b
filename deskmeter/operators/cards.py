"""Aggregates behind the dashboard cards and the exported document.

Every aggregate here combines map-side; what is exchanged is one row per group and task.
Each function takes the filters of :mod:`deskmeter.operators.filters` as keywords.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter import domain
from deskmeter.functions import ticket
from deskmeter.functions.numeric import percent, round_scaled
from deskmeter.operators.filters import apply_filters
from deskmeter.operators.ordering import top_n

BREAKDOWNS = {
    "priority": "priority",
    "category": "category",
    "channel": "channel",
    "month": "created_month",
}


def kpi_global(fct: DataFrame, **selected) -> DataFrame:
    """Headline figures with times in minutes. Missing csat values are left out of the mean."""
    return apply_filters(fct, **selected).agg(
        F.count(F.lit(1)).alias("total_chamados"),
        percent("sla_breach").alias("taxa_violacao_pct"),
        round_scaled(F.avg("resolution_minutes"), 1).alias("tempo_medio_resolucao_min"),
        round_scaled(F.avg("first_response_minutes"), 1).alias("tempo_medio_1a_resposta_min"),
        percent("reopened").alias("taxa_reabertura_pct"),
        round_scaled(F.avg("csat_score"), 2).alias("csat_medio"),
    )


def kpi_global_hours(fct: DataFrame, **selected) -> DataFrame:
    return apply_filters(fct, **selected).agg(
        F.count(F.lit(1)).alias("chamados"),
        percent("sla_breach").alias("taxa_violacao_sla_pct"),
        round_scaled(F.avg("resolution_minutes") / 60, 1).alias("tempo_medio_resolucao_h"),
        round_scaled(F.avg("first_response_minutes"), 0).alias("tempo_medio_1a_resposta_min"),
        round_scaled(F.avg("csat_score"), 2).alias("csat_medio"),
        percent("reopened").alias("taxa_reabertura_pct"),
    )


def ticket_count(fct: DataFrame, **selected) -> DataFrame:
    return apply_filters(fct, **selected).agg(F.count(F.lit(1)).alias("chamados"))


def breach_rate(fct: DataFrame, **selected) -> DataFrame:
    return apply_filters(fct, **selected).agg(percent("sla_breach").alias("taxa_violacao_pct"))


def resolution_hours(fct: DataFrame, **selected) -> DataFrame:
    return apply_filters(fct, **selected).agg(
        round_scaled(F.avg("resolution_minutes") / 60, 1).alias("horas")
    )


def _breach_by(fct: DataFrame, column: str, selected: dict) -> DataFrame:
    return (
        apply_filters(fct, **selected)
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("chamados"), percent("sla_breach").alias("taxa_violacao_pct"))
    )


def breach_by_category(fct: DataFrame, **selected) -> DataFrame:
    return _breach_by(fct, "category", selected).orderBy(
        F.desc("taxa_violacao_pct"), F.col("category").asc_nulls_last()
    )


def breach_by_priority(fct: DataFrame, order: str = "severity", **selected) -> DataFrame:
    """``order='severity'`` for the document, ``'rate'`` for the card."""
    df = _breach_by(fct, "priority", selected).withColumn(
        "ordem", ticket.severity_rank(F.col("priority"))
    )
    first = F.col("ordem").asc() if order == "severity" else F.desc("taxa_violacao_pct")
    return df.orderBy(first, F.col("priority").asc_nulls_last())


def breach_by_channel(fct: DataFrame, order: str = "volume", **selected) -> DataFrame:
    """``order='volume'`` for the document, ``'rate'`` for the card."""
    first = F.desc("chamados") if order == "volume" else F.desc("taxa_violacao_pct")
    return _breach_by(fct, "channel", selected).orderBy(first, F.col("channel").asc_nulls_last())


def breach_by_month(fct: DataFrame, **selected) -> DataFrame:
    """Month of year; years fall together."""
    return _breach_by(fct, "created_month", selected).withColumnRenamed("created_month", "mes").orderBy("mes")


def _all_dims(fct: DataFrame, selected: dict, *measures) -> DataFrame:
    """Every breakdown and the total in one scan; ``dimensao`` names the grouping set.

    The expanded rows are combined map-side, so only group rows are exchanged.
    """
    df = apply_filters(fct, **selected)
    columns = list(BREAKDOWNS.values())
    sets = [[F.col(c)] for c in columns] + [[]]
    grouped = df.groupingSets(sets, *[F.col(c) for c in columns]).agg(
        F.grouping_id(*columns).alias("_gid"),
        F.count(F.lit(1)).alias("chamados"),
        percent("sla_breach").alias("taxa_violacao_pct"),
        *measures,
    )
    # the bit of a column is 0 in the grouping set that contains it
    name = F.lit("total")
    full = 2 ** len(columns) - 1
    for i, label in enumerate(BREAKDOWNS):
        here = F.col("_gid") == full - 2 ** (len(columns) - 1 - i)
        name = F.when(here, F.lit(label)).otherwise(name)
    return grouped.withColumn("dimensao", name).drop("_gid")


def breach_by_all_dims(fct: DataFrame, **selected) -> DataFrame:
    """(dimensao, valor, chamados, taxa_violacao_pct) for all four breakdowns and the total."""
    value = F.coalesce(*[F.col(c).cast("string") for c in BREAKDOWNS.values()])
    return _all_dims(fct, selected).select(
        "dimensao", value.alias("valor"), "chamados", "taxa_violacao_pct"
    )


def fact_summary(fct: DataFrame, **selected) -> DataFrame:
    """One row: the KPIs and the four sorted breakdowns of the document, from one scan.

    Lists hold one entry per category, priority, channel or month, never tickets.
    """
    grouped = _all_dims(
        fct,
        selected,
        round_scaled(F.avg("resolution_minutes"), 1).alias("tempo_medio_resolucao_min"),
        round_scaled(F.avg("first_response_minutes"), 1).alias("tempo_medio_1a_resposta_min"),
        percent("reopened").alias("taxa_reabertura_pct"),
        round_scaled(F.avg("csat_score"), 2).alias("csat_medio"),
    )
    rate = F.col("taxa_violacao_pct")

    def section(label: str, column, *ranks):
        order = [r.alias(f"r{i}") for i, r in enumerate([*ranks, column.isNull(), column])]
        row = F.struct(column, F.col("chamados"), rate)
        entry = F.when(F.col("dimensao") == label, F.struct(*order, row.alias("row")))
        return F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["row"])

    kpis = F.struct(
        F.col("chamados").alias("total_chamados"), rate, "tempo_medio_resolucao_min",
        "tempo_medio_1a_resposta_min", "taxa_reabertura_pct", "csat_medio",
    )
    priority = F.col("priority")
    return grouped.agg(
        F.first(F.when(F.col("dimensao") == "total", kpis), ignorenulls=True).alias("kpis"),
        section("category", F.col("category"), -rate).alias("por_categoria"),
        section("priority", priority, ticket.severity_rank(priority)).alias("por_prioridade"),
        section("channel", F.col("channel"), -F.col("chamados")).alias("por_canal"),
        section("month", F.col("created_month").alias("mes")).alias("por_mes"),
    )


def risk_distribution(mart: DataFrame, **selected) -> DataFrame:
    df = apply_filters(mart, **selected).where(F.col("faixa_risco") != domain.NO_SCORE)
    return (
        df.groupBy("faixa_risco")
        .agg(F.count(F.lit(1)).alias("chamados"))
        .withColumn("ordem", ticket.band_rank(F.col("faixa_risco")))
        .orderBy("ordem")
    )


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy(
            F.col("sla_breach_real").alias("real"), F.col("sla_breach_previsto").alias("previsto")
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("real", "previsto")
    )


def confusion_matrix_labeled(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("sla_breach_real", "sla_breach_previsto")
        .agg(F.count(F.lit(1)).alias("chamados"))
        .select(
            ticket.outcome_label(F.col("sla_breach_real"), "real").alias("real"),
            ticket.outcome_label(F.col("sla_breach_previsto"), "previsto").alias("previsto"),
            "chamados",
        )
        .groupBy("real", "previsto")
        .agg(F.sum("chamados").alias("chamados"))
        .orderBy("real", "previsto")
    )


def _high_risk(mart: DataFrame, selected: dict) -> DataFrame:
    return apply_filters(mart, **selected).where(F.col("faixa_risco") == domain.RISK_BANDS[0])


def _queue_heads(mart: DataFrame, n: int, selected: dict) -> DataFrame:
    """The n high-risk rows with the highest scores; equal scores go by ticket id."""
    high = _high_risk(mart, selected)
    return top_n(high, n, F.desc("proba_breach"), F.asc("ticket_id")).withColumn(
        "prob_violacao", round_scaled(F.col("proba_breach"), 3)
    )


_TOP_COLUMNS = (
    "ticket_id", "priority", "category", "channel", "product", "customer_tier", "prob_violacao",
)


def top_risk(mart: DataFrame, n: int = 12, **selected) -> DataFrame:
    return _queue_heads(mart, n, selected).select(*_TOP_COLUMNS)


def top_risk_list(mart: DataFrame, n: int = 12, **selected) -> DataFrame:
    """The same rows as one array of n structs, in queue order."""
    rows = _queue_heads(mart, n, selected).select(
        F.struct(
            -F.col("proba_breach"), "ticket_id", F.struct(*_TOP_COLUMNS).alias("row")
        ).alias("entry")
    )
    return rows.agg(
        F.transform(F.array_sort(F.collect_list("entry")), lambda x: x["row"]).alias("top_risco")
    )


def risk_queue(mart: DataFrame, n: int = 50, **selected) -> DataFrame:
    return _queue_heads(mart, n, selected).select(
        "ticket_id",
        F.col("priority").alias("prioridade"),
        F.col("category").alias("categoria"),
        F.col("product").alias("produto"),
        F.col("customer_tier").alias("tier"),
        "prob_violacao",
        "faixa_risco",
    )


# The card titles. Title -> (model it reads, query); all but the confusion
# matrix take filters.
CARDS = {
    "Chamados no período": ("fct_tickets", ticket_count),
    "Taxa de violação de SLA (%)": ("fct_tickets", breach_rate),
    "Tempo médio de resolução (h)": ("fct_tickets", resolution_hours),
    "Violação de SLA por prioridade": (
        "fct_tickets",
        lambda fct, **f: breach_by_priority(fct, order="rate", **f).select(
            F.col("priority").alias("prioridade"), "taxa_violacao_pct"
        ),
    ),
    "Violação de SLA por categoria": (
        "fct_tickets",
        lambda fct, **f: breach_by_category(fct, **f).select(
            F.col("category").alias("categoria"), "taxa_violacao_pct"
        ),
    ),
    "Evolução mensal da violação de SLA": (
        "fct_tickets",
        lambda fct, **f: breach_by_month(fct, **f).select("mes", "taxa_violacao_pct"),
    ),
    "Violação de SLA por canal": (
        "fct_tickets",
        lambda fct, **f: breach_by_channel(fct, order="rate", **f).select(
            F.col("channel").alias("canal"), "chamados", "taxa_violacao_pct"
        ),
    ),
    "Fila priorizada por risco previsto": ("mart_ticket_decision", risk_queue),
    "Distribuição da fila por faixa de risco": (
        "mart_ticket_decision",
        lambda mart, **f: risk_distribution(mart, **f).select("faixa_risco", "chamados"),
    ),
    "Matriz de confusão do modelo": (
        "fct_predictions",
        lambda pred, **f: confusion_matrix_labeled(pred),
    ),
}


def card(models: dict[str, DataFrame], title: str, **selected) -> DataFrame:
    """Answer one dashboard card over the built models."""
    model, query = CARDS[title]
    return query(models[model], **selected)
