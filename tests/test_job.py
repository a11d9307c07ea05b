import json

import pytest
from pyspark.sql import functions as F

from deskmeter import domain, schemas
from deskmeter.operators.quality import QualityError
from deskmeter.plans.job import Job
from deskmeter.sinks.publish import Target
from deskmeter.sources import derived
from deskmeter.sources.inventory import MissingSource

STORED = ["tickets_clean", "text_features", "log_features", "ml_features", "predictions", "model_metrics",
          "model_comparison", "run_summary", "roc_curve", "fct_tickets", "fct_predictions",
          "mart_ticket_decision", "mart_ml_features", "dim_date", "dim_product", "dim_category", "dim_channel"]


@pytest.fixture(scope="module")
def raw(spark, small, tmp_path_factory):
    """Raw files in the three source layouts, written from the warehouse tables."""
    folder = tmp_path_factory.mktemp("raw")
    tickets = derived.tickets(spark, small)
    known = tickets.where(F.trim("priority").isin(domain.PRIORITIES))
    known.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TICKETS]).write.csv(
        str(folder / "tickets.csv"), header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    derived.messages(spark, small).withColumn("ticket_id", F.col("ticket_id").cast("string")).write.json(
        str(folder / "ticket_messages.jsonl")
    )
    events = {}
    for row in derived.events_flat(spark, small).collect():
        event = {"ts": str(row["ts"]), "event": row["event"], "actor": "x", "from_status": None, "to_status": row["to_status"]}
        events.setdefault(str(row["ticket_id"]), []).append(event)
    records = [{"ticket_id": k, "events": v} for k, v in events.items()]
    (folder / "ticket_events.json").write_text(json.dumps(records, indent=1), encoding="utf-8")
    return folder


def test_end_to_end(spark, raw, tmp_path, small):
    job = Job(spark, str(raw), str(tmp_path), lake=str(tmp_path / "lake"))
    spark.sql("DROP SCHEMA IF EXISTS raw CASCADE")
    report = {(r["stage"], r["table"]): r["n_rows"] for r in job.run("all").collect()}
    assert set(STORED) <= {t for _, t in report}
    n = report[("process", "tickets_clean")]
    assert report[("models", "fct_tickets")] == report[("models", "mart_ticket_decision")] == n
    assert report[("load", "tickets_clean")] == n == spark.table("raw.tickets_clean").count()
    logs = derived.logs(spark, small)
    assert report[("process", "log_features")] == logs.count()
    got = spark.read.parquet(str(tmp_path / "processed" / "log_features")).agg(F.sum("n_events"), F.sum("n_status_changes")).first()
    assert tuple(got) == tuple(logs.agg(F.sum("n_events"), F.sum("n_status_changes")).first())
    doc = json.loads(next((tmp_path / "curated" / "dashboard").glob("part-*")).read_text(encoding="utf-8"))
    assert len(doc) == 10 and doc["kpis"]["total_chamados"] == n
    by_name = {m["model"]: m for m in doc["metricas_modelo"]}
    assert set(by_name) == {"baseline_majoritaria", "baseline_regra_prioridade", *domain.CANDIDATE_MODELS}
    assert by_name["knn_hardcode"]["f1"] == by_name["knn_sklearn"]["f1"]
    assert doc["modelo_producao"] == max(domain.CANDIDATE_MODELS, key=lambda m: by_name[m]["f1"])
    comparison = spark.read.parquet(str(tmp_path / "processed" / "model_comparison")).first()
    assert (comparison["agreement"], comparison["diff_f1"], comparison["k"]) == (1.0, 0.0, 15)
    assert report[("validate", "tickets")] == n + 1  # with the header
    assert report[("lake", "curated/fct_tickets")] == spark.read.parquet(str(tmp_path / "lake" / "curated" / "fct_tickets")).count() == n
    measured = json.loads(next((tmp_path / "processed" / "metrics").glob("part-*")).read_text(encoding="utf-8"))
    assert measured["champion"] == doc["modelo_producao"] and measured["models"]["svm"]["f1"] == by_name["svm"]["f1"]
    assert measured["n_train"] + measured["n_test"] == report[("process", "ml_features")] and measured["knn_comparison"]["k"] == 15
    # a repeated stage overwrites and gives the same table
    again = Job(spark, str(raw), str(tmp_path))
    before = {tuple(r) for r in spark.read.parquet(str(tmp_path / "curated" / "fct_tickets")).collect()}
    again.models()
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "curated" / "fct_tickets")).collect()} == before
    spark.sql("DROP SCHEMA raw CASCADE")


def test_load_to_files_skips_absent_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "processed" / "log_features"))
    job = Job(spark, "unused", str(tmp_path))
    assert job.load(Target("csv", str(tmp_path / "csv"))) == {"log_features": 3}


def test_missing_input_stops_the_job(spark, tmp_path):
    with pytest.raises(MissingSource, match="events"):
        Job(spark, str(tmp_path), str(tmp_path)).run("validate")


def test_failing_data_test_stops_before_the_marts(spark, small, tmp_path):
    tables = derived.raw_tables(spark, small)
    tables["predictions"] = tables["predictions"].withColumn("ticket_id", F.lit(None).cast("bigint"))
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / "processed" / name))
    with pytest.raises(QualityError, match="not_null stg_predictions.ticket_id"):
        Job(spark, "unused", str(tmp_path)).models()
    assert not (tmp_path / "curated").exists()


def test_a_stopped_job_goes_on_where_it_stopped(spark, raw, tmp_path, monkeypatch):
    spark.sql("DROP SCHEMA IF EXISTS raw CASCADE")

    def job(**changes):
        return Job(spark, str(raw), str(tmp_path), target=Target("parquet", str(tmp_path / "loaded")), resume=True, **changes)

    def states(report):
        return {r["stage"]: r["table"] for r in report.collect() if r["table"] in ("*", "skipped")}

    with monkeypatch.context() as broken:
        broken.setattr(Job, "load", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job().run("all")
    resumed = states(job().run("all"))
    assert [k for k, v in resumed.items() if v == "skipped"] == ["validate", "process", "ml"]
    assert spark.read.parquet(str(tmp_path / "loaded" / "log_features")).count() > 0
    assert set(states(job().run("all")).values()) == {"skipped"}
    assert states(job(buckets=3).run("all"))["process"] == "*"  # another parameter: nothing can be taken over


def test_messages_without_bodies_stop_the_job(spark, raw, tmp_path):
    import shutil

    shutil.copytree(raw, tmp_path / "raw", ignore=lambda d, names: [n for n in names if n.startswith("ticket_messages")])
    (tmp_path / "raw" / "ticket_messages.jsonl").write_text('{"ticket_id": "1", "text": "renamed"}\n')
    with pytest.raises(ValueError, match="body"):
        Job(spark, str(tmp_path / "raw"), str(tmp_path)).run("validate")
