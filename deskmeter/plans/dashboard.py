"""The exported dashboard document: ten keys, built from aggregates only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmeter.functions import ticket
from deskmeter.operators import cards


def _listed(df: DataFrame, *order: Column) -> Column:
    """The rows of a small grouped result as one sorted array, as a scalar subquery."""
    ranks = [o.alias(f"r{i}") for i, o in enumerate(order)]
    entry = F.struct(*ranks, F.struct(*df.columns).alias("row"))
    items = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["row"])
    return df.agg(items).scalar()


def dashboard_document(
    fct: DataFrame,
    mart: DataFrame,
    predictions: DataFrame,
    metrics: DataFrame | None = None,
    champion: str | None = None,
) -> DataFrame:
    """One row, one column ``document`` holding the JSON text.

    The fact is scanned once for the KPIs and all breakdowns; only grouped results and the
    twelve queue heads are gathered, tickets never are.
    """
    bands = cards.risk_distribution(mart).select("faixa_risco", "chamados")
    keys = {
        "distribuicao_risco": _listed(bands, ticket.band_rank(F.col("faixa_risco"))),
        "matriz_confusao": _listed(
            cards.confusion_matrix(predictions), F.col("real"), F.col("previsto")
        ),
        "top_risco": cards.top_risk_list(mart).scalar(),
    }
    if metrics is not None:
        keys["metricas_modelo"] = _listed(metrics, F.col("model"))
    if champion is not None:
        keys["modelo_producao"] = F.lit(champion)
    facts = cards.fact_summary(fct)
    document = F.struct(
        *[F.col(c) for c in facts.columns], *[value.alias(name) for name, value in keys.items()]
    )
    return facts.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))
