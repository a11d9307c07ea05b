import json

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from deskmeter.operators import cards, quality
from deskmeter.operators.filters import apply_filters
from deskmeter.plans.dashboard import dashboard_document


@pytest.fixture(scope="module")
def fct(spark):
    rows = [
        ("1", "Crítica", "A", "Chat", "P", "F", 1, 1, 600.0, 10.0, 0, 5),
        ("2", "Crítica", "B", "Chat", "P", "F", 1, 0, 30.0, 20.0, 1, None),
        ("3", "Baixa", "A", "Email", "P", "F", 2, 0, 60.0, 30.0, 0, 4),
        ("4", None, "A", "Email", "P", "F", 2, 0, None, None, 0, None),
    ]
    return spark.createDataFrame(
        rows,
        "ticket_id string, priority string, category string, channel string, product string, customer_tier string, "
        "created_month int, sla_breach int, resolution_minutes double, first_response_minutes double, reopened int, csat_score int",
    )


@pytest.fixture(scope="module")
def mart(spark, fct):
    scores = spark.createDataFrame([("1", 0.91), ("2", 0.91), ("3", 0.1)], "ticket_id string, proba_breach double")
    band = F.when(F.col("proba_breach") > 0.7, "Alto").when(F.col("proba_breach").isNotNull(), "Baixo").otherwise("Sem score")
    return fct.join(scores, "ticket_id", "left").withColumn("faixa_risco", band)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_kpis_ignore_missing_values(fct):
    assert rows(cards.kpi_global(fct)) == [(4, 25.0, 230.0, 20.0, 25.0, 4.5)]
    assert rows(cards.kpi_global_hours(fct)) == [(4, 25.0, 3.8, 20.0, 4.5, 25.0)]


def test_order_of_breakdowns(fct):
    assert [r[0] for r in rows(cards.breach_by_priority(fct))] == ["Crítica", "Baixa", None]
    assert [r[0] for r in rows(cards.breach_by_priority(fct, order="rate"))][0] == "Crítica"
    assert rows(cards.breach_by_month(fct)) == [(1, 2, 50.0), (2, 2, 0.0)]


def test_one_scan_equals_the_single_cards(fct):
    got = {(d, v): (n, r) for d, v, n, r in rows(cards.breach_by_all_dims(fct))}
    assert got[("total", None)] == (4, 25.0) and got[("priority", None)] == (1, 0.0)
    for c, n, r in rows(cards.breach_by_category(fct)):
        assert got[("category", c)] == (n, r)
    assert len(got) == 1 + 3 + 2 + 2 + 2


@pytest.mark.parametrize(
    "chosen, n",
    [({}, 4), ({"priority": None}, 4), ({"priority": []}, 4), ({"priority": "Crítica"}, 2), ({"channel": ["Email", "Chat"]}, 4),
     ({"priority": "Crítica", "category": "A"}, 1), ({"month": 2}, 2)],
)
def test_filters(fct, chosen, n):
    assert rows(cards.ticket_count(fct, **chosen)) == [(n,)]


def test_absent_filter_adds_no_predicate_and_unknown_fails(fct):
    assert apply_filters(fct, priority=None) is fct
    with pytest.raises(ValueError):
        apply_filters(fct, agent="x")


def test_filter_reaches_the_scan(spark, small):
    df = spark.read.parquet(f"{small}/orders.parquet").withColumnRenamed("o_orderpriority", "priority")
    plan = plan_of(apply_filters(df, priority="1-URGENT").select("priority"))
    assert "PushedFilters: [In" in plan or "EqualTo(o_orderpriority,1-URGENT)" in plan
    assert "ReadSchema: struct<o_orderpriority:string>" in plan


def test_queue_breaks_ties_by_id_and_uses_top_k(mart):
    assert [r[0] for r in rows(cards.top_risk(mart, 1))] == ["1"]
    assert [r[0] for r in rows(cards.risk_queue(mart))] == ["1", "2"]
    assert "TakeOrderedAndProject" in plan_of(cards.risk_queue(mart))


def test_every_card_answers_with_and_without_filters(fct, mart):
    predictions = mart.where("proba_breach is not null").select(
        F.col("sla_breach").alias("sla_breach_real"), F.lit(1).alias("sla_breach_previsto")
    )
    built = {"fct_tickets": fct, "mart_ticket_decision": mart, "fct_predictions": predictions}
    assert len(cards.CARDS) == 10
    for title in cards.CARDS:
        assert cards.card(built, title).collect()
        cards.card(built, title, priority="Crítica").collect()
    assert rows(cards.card(built, "Taxa de violação de SLA (%)", priority="Crítica")) == [(50.0,)]
    assert ("Violou (real)", "Violou (previsto)", 1) in rows(cards.card(built, "Matriz de confusão do modelo"))


def test_document_has_ten_keys(spark, fct, mart):
    predictions = fct.select(F.col("sla_breach").alias("sla_breach_real"), F.lit(0).alias("sla_breach_previsto"))
    metrics = spark.createDataFrame([("svm", 0.9), ("mlp", 0.8)], "model string, f1 double")
    text = dashboard_document(fct, mart, predictions, metrics, "svm").first()["document"]
    doc = json.loads(text)
    assert list(doc) == [
        "kpis", "por_categoria", "por_prioridade", "por_canal", "por_mes", "distribuicao_risco",
        "matriz_confusao", "top_risco", "metricas_modelo", "modelo_producao",
    ]
    assert doc["kpis"]["total_chamados"] == 4 and doc["modelo_producao"] == "svm"
    assert [p["priority"] for p in doc["por_prioridade"]] == ["Crítica", "Baixa", None]
    assert [t["ticket_id"] for t in doc["top_risco"]] == ["1", "2"]


# -- data tests -----------------------------------------------------------------
def test_checks_count_failures(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 0), ("b", None)], "ticket_id string, v int")
    parent = spark.createDataFrame([("a",)], "ticket_id string")
    checks = [
        quality.Check("not_null", "m", "ticket_id"),
        quality.Check("unique", "m", "ticket_id"),
        quality.Check("accepted_values", "m", "v", (0, 1)),
        quality.Check("relationships", "m", "ticket_id", (), "p", "ticket_id"),
    ]
    report = quality.report({"m": df, "p": parent}, checks)
    assert {r["test"]: r["failures"] for r in report.collect()} == {
        "not_null": 1, "unique": 1, "accepted_values": 1, "relationships": 1,
    }
    assert tuple(quality.totals(report).first()) == (0, 4)
    with pytest.raises(quality.QualityError, match="unique m.ticket_id: 1"):
        quality.enforce(report)


def test_ten_checks_like_the_declared_ones():
    assert len(quality.CHECKS) == 10


def test_row_checks_share_one_pass(spark):
    df = spark.createDataFrame([("a", 1)], "ticket_id string, v int")
    checks = [quality.Check("not_null", "m", "ticket_id"), quality.Check("accepted_values", "m", "v", (1,))]
    assert plan_of(quality.scalar_report(df, checks)).count("Scan") == 1
