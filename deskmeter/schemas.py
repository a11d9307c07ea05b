"""Explicit schemas of the raw sources; nothing is inferred."""

from pyspark.sql import types as T

TICKETS = T.StructType([
    T.StructField("ticket_id", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("channel", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("customer_tier", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("agent_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("backlog_at_creation", T.IntegerType()),
    T.StructField("first_response_minutes", T.DoubleType()),
    T.StructField("resolution_minutes", T.DoubleType()),
    T.StructField("reopened", T.IntegerType()),
    T.StructField("csat_score", T.IntegerType()),
])

MESSAGES = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("ticket_id", "subject", "body", "agent_note", "lang")
])

EVENT = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("event", T.StringType()),
    T.StructField("actor", T.StringType()),
    T.StructField("from_status", T.StringType()),
    T.StructField("to_status", T.StringType()),
])

TICKET_EVENTS = T.StructType([
    T.StructField("ticket_id", T.StringType()),
    T.StructField("events", T.ArrayType(EVENT)),
])

PREDICTIONS = T.StructType([
    T.StructField("ticket_id", T.StringType()),
    T.StructField("y_true", T.IntegerType()),
    T.StructField("proba_breach", T.DoubleType()),
    T.StructField("y_pred", T.IntegerType()),
    T.StructField("modelo", T.StringType()),
])
