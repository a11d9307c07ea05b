"""Staging views, dimensions, facts and marts as functions of DataFrames.

Every model is lazy; asking for several of them builds one graph and Catalyst prunes what
is not used. Joins are plain equi-joins on ``ticket_id``: small sides are broadcast by
their measured size, large ones are shuffled once (or not at all when the raw tables are
stored bucketed on the key).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter import domain
from deskmeter.functions import ticket
from deskmeter.operators.ordering import surrogate_key

# fixed values: the columns of the published models
TICKET_COLUMNS = [
    "ticket_id", "created_at", "created_date", "created_hour", "created_weekday", "created_month",
    "channel", "product", "category", "priority", "customer_tier", "region",
    "customer_id", "agent_id", "backlog_at_creation", "first_response_minutes",
    "resolution_minutes", "reopened", "csat_score", "csat_missing", "sla_minutes", "sla_breach",
]
PREDICTION_ATTRIBUTES = [
    "priority", "category", "product", "customer_tier", "channel",
    "resolution_minutes", "sla_minutes",
]


def stg_tickets(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "created_at": F.col("created_at").cast("timestamp_ntz"),
        "created_date": F.col("created_date").cast("date"),
    }).select(*TICKET_COLUMNS)


def stg_text_features(raw: DataFrame) -> DataFrame:
    return raw.select("ticket_id", *domain.TEXT_FEATURES)


def stg_log_features(raw: DataFrame) -> DataFrame:
    return raw.select("ticket_id", *domain.LOG_FEATURES)


def stg_predictions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ticket_id",
        F.col("y_true").cast("int").alias("sla_breach_real"),
        F.col("proba_breach").cast("double").alias("proba_breach"),
        F.col("y_pred").cast("int").alias("sla_breach_previsto"),
        "modelo",
    )


def dim_date(stg: DataFrame) -> DataFrame:
    """One row per day; ``dia_semana`` counts from Sunday = 0."""
    day = F.col("created_date")
    return stg.select("created_date").distinct().select(
        day.alias("date_key"),
        F.year(day).alias("ano"),
        F.month(day).alias("mes"),
        F.dayofmonth(day).alias("dia"),
        (F.dayofweek(day) - 1).alias("dia_semana"),
    )


def dim_product(stg: DataFrame) -> DataFrame:
    return surrogate_key(stg, "product", "product_key")


def dim_category(stg: DataFrame) -> DataFrame:
    return surrogate_key(stg, "category", "category_key")


def dim_channel(stg: DataFrame) -> DataFrame:
    return surrogate_key(stg, "channel", "channel_key")


def fct_tickets(tickets: DataFrame, text: DataFrame, logs: DataFrame) -> DataFrame:
    """One row per ticket; tickets without message or log keep NULL features."""
    return (
        tickets.join(text, "ticket_id", "left")
        .join(logs, "ticket_id", "left")
        .select(*TICKET_COLUMNS, *domain.TEXT_FEATURES, *domain.LOG_FEATURES)
    )


def fct_predictions(predictions: DataFrame, fct: DataFrame) -> DataFrame:
    return predictions.join(fct.select("ticket_id", *PREDICTION_ATTRIBUTES), "ticket_id").select(
        "ticket_id", "sla_breach_real", "sla_breach_previsto", "proba_breach", "modelo",
        *PREDICTION_ATTRIBUTES,
    )


def mart_ticket_decision(fct: DataFrame, predictions: DataFrame) -> DataFrame:
    """The fact plus score, predicted class and risk band; unscored tickets are kept."""
    scored = predictions.select("ticket_id", "proba_breach", "sla_breach_previsto")
    return fct.join(scored, "ticket_id", "left").withColumn(
        "faixa_risco", ticket.risk_band(F.col("proba_breach"))
    )


def mart_ml_features(fct: DataFrame) -> DataFrame:
    """Decision-time features and target from the left-joined fact."""
    return fct.select(
        *domain.DECISION_COLUMNS, *domain.TEXT_FEATURES, *domain.LOG_FEATURES, domain.TARGET
    )


def ml_features_inner(clean: DataFrame, text: DataFrame, logs: DataFrame) -> DataFrame:
    """Training table: only tickets that have a message and a log, without outcome columns."""
    return (
        clean.select(*domain.DECISION_COLUMNS, domain.TARGET)
        .join(text, "ticket_id")
        .join(logs, "ticket_id")
    )


# model -> (models it reads, function); "raw.*" are stored tables. Order is build order.
GRAPH: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "stg_tickets": (("raw.tickets_clean",), stg_tickets),
    "stg_text_features": (("raw.text_features",), stg_text_features),
    "stg_log_features": (("raw.log_features",), stg_log_features),
    "stg_predictions": (("raw.predictions",), stg_predictions),
    "dim_date": (("stg_tickets",), dim_date),
    "dim_product": (("stg_tickets",), dim_product),
    "dim_category": (("stg_tickets",), dim_category),
    "dim_channel": (("stg_tickets",), dim_channel),
    "fct_tickets": (("stg_tickets", "stg_text_features", "stg_log_features"), fct_tickets),
    "fct_predictions": (("stg_predictions", "fct_tickets"), fct_predictions),
    "mart_ticket_decision": (("fct_tickets", "stg_predictions"), mart_ticket_decision),
    "mart_ml_features": (("fct_tickets",), mart_ml_features),
}
STAGING = [name for name in GRAPH if name.startswith("stg_")]
MARTS = [name for name in GRAPH if not name.startswith("stg_")]


# read by four other models and all cards, so it is worth storing
SHARED = ("fct_tickets",)


def build_all(
    raw: dict[str, DataFrame], store: Callable[[DataFrame], DataFrame] | None = None
) -> dict[str, DataFrame]:
    """All twelve models from the four raw tables, lazily.

    With ``store`` (for example a reliable checkpoint) the shared fact is materialised once
    and its readers start from the stored rows.
    """
    built = {f"raw.{name}": df for name, df in raw.items()}
    for name, (inputs, function) in GRAPH.items():
        built[name] = function(*[built[i] for i in inputs])
        if store and name in SHARED:
            built[name] = store(built[name])
    return {name: built[name] for name in GRAPH}
