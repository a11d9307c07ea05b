"""Ticket-domain tables derived from a star schema of orders, line items and documents.

Lets every operator run on existing warehouse data: an order plays the ticket, its line
items the event log, a document the ticket's message. All of it is plain projections,
equi-joins and one pre-aggregated group-by.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmeter.ml.split import is_test
from deskmeter.operators.clean import clean_tickets
from deskmeter.operators.log_features import log_features_flat
from deskmeter.operators.text_features import text_features

# --- fixed values ------------------------------------------------------------
CHANNELS = ["Email", "Chat", "Telefone", "Formulário Web", "Redes Sociais"]
PRODUCTS = ["Plataforma Web", "App Mobile", "API", "Integrações", "Faturamento", "Relatórios"]
CATEGORIES = [
    "Acesso e Conta", "Problema Técnico", "Bug / Defeito", "Faturamento",
    "Dúvida / Como Fazer", "Solicitação de Recurso", "Cancelamento",
]
ORDER_PRIORITIES = {"1-URGENT": "Crítica", "2-HIGH": "Alta", "3-MEDIUM": "Média"}
# -----------------------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _padded(value: Column) -> Column:
    """Some values arrive with stray blanks, as in hand-typed exports."""
    return F.when(F.col("o_orderkey") % 10 == 3, F.concat(F.lit("  "), value, F.lit(" "))).otherwise(value)


def _priority() -> Column:
    known = F.lit("Baixa")
    for code, name in ORDER_PRIORITIES.items():
        known = F.when(F.col("o_orderpriority") == code, name).otherwise(known)
    rest = F.col("o_orderkey") % 97
    return F.when(rest == 5, F.lit(None)).when(rest == 6, "Urgente").otherwise(known)


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    """The 15 raw ticket columns; orders without line items have no response times."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("q"),
            F.min("l_quantity").alias("mq"),
            F.max((F.col("l_returnflag") == "R").cast("int")).alias("ro"),
        )
    )
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    price = F.floor("o_totalprice").cast("bigint")
    return (
        orders.join(customer, cust == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(lines, key == F.col("l_orderkey"), "left")
        .select(
            key.alias("ticket_id"),
            F.timestamp_add("MINUTE", (price % 1440).cast("int"), F.col("o_orderdate")).alias("created_at"),
            _padded(_pick(cust % 5, CHANNELS)).alias("channel"),
            _pick(key % 6, PRODUCTS).alias("product"),
            _padded(_pick((key * 31 + cust) % 7, CATEGORIES)).alias("category"),
            _padded(_priority()).alias("priority"),
            F.col("c_mktsegment").alias("customer_tier"),
            cust.alias("customer_id"),
            (cust % 40).alias("agent_id"),
            F.col("r_name").alias("region"),
            (price % 100).alias("backlog_at_creation"),
            (F.col("mq") * 6).alias("first_response_minutes"),
            (F.col("q") * 8).alias("resolution_minutes"),
            F.coalesce("ro", F.lit(0)).alias("reopened"),
            F.when(F.col("o_orderstatus") != "P", 1 + key % 5).alias("csat_score"),
        )
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("ticket_id"), F.col("text").alias("body"), "lang"
    )


def lines_as_events(lines: DataFrame) -> DataFrame:
    """One event per line item; some statuses are missing, some empty."""
    number = F.col("l_linenumber")
    return lines.select(
        F.col("l_orderkey").alias("ticket_id"),
        F.col("l_shipdate").alias("ts"),
        F.when(F.col("l_returnflag") == "R", "reopened")
        .when(F.col("l_returnflag") == "A", "resolved")
        .otherwise("first_response")
        .alias("event"),
        F.when(number == 5, F.lit(None))
        .when(number == 6, "")
        .when(F.col("l_linestatus") == "O", "open")
        .otherwise("closed")
        .alias("to_status"),
    )


def events_flat(spark: SparkSession, folder: str) -> DataFrame:
    return lines_as_events(table(spark, folder, "lineitem"))


def events_nested(spark: SparkSession, folder: str) -> DataFrame:
    """A list per record without grouping: every word of a document is one event."""
    words = F.split(F.col("text"), " ")
    return table(spark, folder, "documents").select("doc_id", "text").select(
        F.col("doc_id").alias("ticket_id"),
        F.transform(
            words,
            lambda w: F.struct(
                F.when(F.length(w) == 13, "reopened").otherwise("resolved").alias("event"),
                F.when(F.length(w) % 3 == 0, F.lit(None))
                .when(F.length(w) % 3 == 1, "")
                .otherwise(w)
                .alias("to_status"),
            ),
        ).alias("events"),
    )


def tickets_clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_tickets(tickets(spark, folder))


def text(spark: SparkSession, folder: str) -> DataFrame:
    return text_features(messages(spark, folder), parts=spark.sparkContext.defaultParallelism)


def logs(spark: SparkSession, folder: str) -> DataFrame:
    return log_features_flat(events_flat(spark, folder))


def predictions(spark: SparkSession, folder: str, keep: tuple[str, ...] = (), clean: DataFrame | None = None) -> DataFrame:
    """A score for the holdout tickets, in the layout the training step writes.

    ``keep`` adds ticket columns that come from the same scan; ``clean`` are the clean tickets, where they are at hand.
    """
    clean = tickets_clean(spark, folder) if clean is None else clean
    df = clean.where(is_test(F.col("ticket_id")))
    key = F.col("ticket_id")
    score = (key * 37) % 1000 * F.lit(0.0006) + F.col("sla_breach") * F.lit(0.35)
    return df.select(
        key,
        F.col("sla_breach").alias("y_true"),
        (F.rint(score * 10000.0) / 10000.0).alias("proba_breach"),
        *keep,
    ).select(
        "ticket_id", "y_true", "proba_breach",
        (F.col("proba_breach") >= 0.5).cast("int").alias("y_pred"),
        F.lit("svm").alias("modelo"),
        *keep,
    )


def raw_tables(spark: SparkSession, folder: str, store: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, DataFrame]:
    """The four raw tables; with ``store`` each is materialised, and the tickets are joined together once."""
    clean = store(tickets_clean(spark, folder))
    return {
        "tickets_clean": clean,
        "text_features": store(text(spark, folder)),
        "log_features": store(logs(spark, folder)),
        "predictions": store(predictions(spark, folder, clean=clean)),
    }


__all__ = [
    "table", "tickets", "messages", "lines_as_events", "events_flat", "events_nested", "tickets_clean",
    "text", "logs", "predictions", "raw_tables",
]
