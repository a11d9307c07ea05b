import datetime as dt

import pytest
from pyspark.sql import functions as F

from deskmeter import domain, schemas
from deskmeter.functions import ticket
from deskmeter.operators.clean import clean_tickets
from deskmeter.operators.log_features import (
    finish_partials, log_features_flat, log_features_nested, log_partials,
)
from deskmeter.plans import models


def raw(spark, **changes):
    base = dict(
        ticket_id="T1", created_at=dt.datetime(2024, 3, 4, 23, 59), channel="Chat", product="API",
        category="Faturamento", priority="Alta", customer_tier="Free", customer_id="C", agent_id="A",
        region="Sul", backlog_at_creation=3, first_response_minutes=5.0, resolution_minutes=481.0,
        reopened=0, csat_score=4,
    )
    row = {**base, **changes}
    return spark.createDataFrame([tuple(row[f.name] for f in schemas.TICKETS)], schemas.TICKETS)


def cleaned(spark, **changes):
    return clean_tickets(raw(spark, **changes)).first()


def test_clean_has_22_columns_and_date_parts(spark):
    df = clean_tickets(raw(spark))
    assert len(df.columns) == 22
    row = df.first()
    assert (row["created_date"], row["created_hour"], row["created_weekday"], row["created_month"]) == (
        dt.date(2024, 3, 4), 23, 0, 3,
    )


def test_padded_priority_is_trimmed_before_the_lookup(spark):
    row = cleaned(spark, priority="  Alta \t")
    assert (row["priority"], row["sla_minutes"], row["sla_breach"]) == ("Alta", 480, 1)


@pytest.mark.parametrize("priority", ["Urgente", None])
def test_unknown_priority_never_breaches(spark, priority):
    row = cleaned(spark, priority=priority)
    assert (row["priority"], row["sla_minutes"], row["sla_breach"]) == (priority, None, 0)


@pytest.mark.parametrize("minutes, breach", [(480.0, 0), (480.01, 1), (None, 0)])
def test_breach_is_strict(spark, minutes, breach):
    assert cleaned(spark, resolution_minutes=minutes)["sla_breach"] == breach


def test_csat_flag(spark):
    assert cleaned(spark, csat_score=None)["csat_missing"] == 1
    assert cleaned(spark)["csat_missing"] == 0


def test_risk_band_edges(spark):
    df = spark.createDataFrame([(0.7,), (0.69999,), (0.4,), (0.39999,), (0.0,), (None,)], "p double")
    got = [r[0] for r in df.select(ticket.risk_band(F.col("p"))).collect()]
    assert got == ["Alto", "Médio", "Médio", "Baixo", "Baixo", "Sem score"]


EVENTS = [
    ("a", [("created", "open"), ("reopened", None), ("resolved", "closed")]),
    ("b", [("created", ""), ("resolved", None)]),
    ("c", []),
    ("d", None),
    ("e", [(None, "open"), ("resolved", "open"), ("resolved", "open")]),
]
NESTED = "ticket_id string, events array<struct<event string, to_status string>>"


def test_nested_log_features(spark):
    got = {r[0]: tuple(r)[1:] for r in log_features_nested(spark.createDataFrame(EVENTS, NESTED)).collect()}
    assert got == {"a": (3, 1, 1), "b": (2, 0, 0), "c": (0, 0, 0), "d": (0, 0, 0), "e": (3, 2, 0)}


def test_flat_and_merged_partials_equal_nested(spark):
    nested = spark.createDataFrame(EVENTS, NESTED)
    flat = nested.select("ticket_id", F.inline("events"))
    want = {tuple(r) for r in log_features_nested(nested).where("n_events > 0").collect()}
    assert {tuple(r) for r in log_features_flat(flat).collect()} == want
    halves = [flat.where(F.col("to_status") == "open"), flat.where(~F.col("to_status").eqNullSafe("open"))]
    merged = finish_partials(log_partials(halves[0]).unionByName(log_partials(halves[1])))
    assert {tuple(r) for r in merged.collect()} == want


def tables(spark):
    clean = clean_tickets(raw(spark).unionByName(raw(spark, ticket_id="T2")).unionByName(raw(spark, ticket_id="T3")))
    text = spark.createDataFrame([("T1", 1, 1, 0, 0, 0.5, 0, 0, 0, 0), ("T2", 2, 1, 0, 0, 0.0, 1, 0, 0, 0)],
                                 "ticket_id string, " + ", ".join(f"{c} {'double' if c == 'upper_ratio' else 'int'}" for c in domain.TEXT_FEATURES))
    logs = spark.createDataFrame([("T1", 3, 2, 0)], "ticket_id string, n_events int, n_status_changes int, reopened_from_log int")
    predictions = spark.createDataFrame([("T1", 1, 0.8, 1, "svm"), ("T2", 1, 0.1, 0, "svm")], schemas.PREDICTIONS)
    return {"tickets_clean": clean, "text_features": text, "log_features": logs, "predictions": predictions}


def test_fact_keeps_and_training_table_drops_incomplete_tickets(spark):
    raw_tables = tables(spark)
    built = models.build_all(raw_tables)
    fct = {r["ticket_id"]: r for r in built["fct_tickets"].collect()}
    assert len(built) == 12 and len(built["fct_tickets"].columns) == 34
    assert set(fct) == {"T1", "T2", "T3"} and fct["T3"]["body_len"] is None and fct["T2"]["n_events"] is None
    inner = models.ml_features_inner(raw_tables["tickets_clean"], raw_tables["text_features"], raw_tables["log_features"])
    assert len(inner.columns) == 26 and [r["ticket_id"] for r in inner.collect()] == ["T1"]
    assert not {"resolution_minutes", "csat_score"} & set(inner.columns)
    mart = {r["ticket_id"]: r["faixa_risco"] for r in built["mart_ticket_decision"].collect()}
    assert mart == {"T1": "Alto", "T2": "Baixo", "T3": "Sem score"}
    assert len(built["mart_ticket_decision"].columns) == 37 and len(built["fct_predictions"].columns) == 12
    assert len(built["mart_ml_features"].columns) == 26


def test_dimensions_number_values_in_byte_order(spark):
    names = ["Ça", "alpha", "Zeta", "Z", "Ze", None, "Zeta", "alpine", "", "é"] + [f"v{i}" for i in range(50)]
    df = spark.createDataFrame([(n,) for n in names], "product string")
    got = [(r["product_key"], r["product"]) for r in models.dim_product(df).collect()]
    want = sorted({n for n in names if n is not None}, key=lambda n: n.encode()) + [None]
    assert sorted(got) == list(enumerate(want, 1))


def test_dim_date_counts_days_from_sunday(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 3),), (dt.date(2024, 3, 3),), (dt.date(2024, 3, 9),)], "created_date date")
    assert sorted(tuple(r) for r in models.dim_date(df).collect()) == [
        (dt.date(2024, 3, 3), 2024, 3, 3, 0), (dt.date(2024, 3, 9), 2024, 3, 9, 6),
    ]
