import json

import pytest
from conftest import plan_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from deskmeter import schemas, sources
from deskmeter.operators.log_features import log_features_flat
from deskmeter.plans import models
from deskmeter.session import shared_dir
from deskmeter.sinks import publish as sink
from deskmeter.sinks.publish import Target
from deskmeter.sources import inventory
from deskmeter.streaming import incremental


@pytest.fixture()
def raw_dir(tmp_path):
    (tmp_path / "tickets.csv").write_text(
        ",".join(f.name for f in schemas.TICKETS) + "\n"
        'TCK-1,2024-01-02 03:04:05,Chat,API,"Bug, Defeito",Crítica,Free,C1,A1,Sul,5,1.5,300,0,\n'
        'TCK-2,2024-01-02 03:04:05,Email,API,"diz ""oi""",Baixa,Free,C1,A1,Sul,5,1.5,300,1,4\n',
        encoding="utf-8",
    )
    (tmp_path / "m.jsonl").write_text(
        '{"ticket_id":"TCK-1","subject":"s","body":"olá\\n!","agent_note":"","lang":"pt"}\n', encoding="utf-8"
    )
    return tmp_path


def test_csv_quotes_nulls_and_types(spark, raw_dir):
    rows = sources.read_tickets(spark, str(raw_dir / "tickets.csv")).orderBy("ticket_id").collect()
    assert [r["category"] for r in rows] == ["Bug, Defeito", 'diz "oi"']
    assert rows[0]["csat_score"] is None and rows[0]["resolution_minutes"] == 300.0
    assert sources.read_messages(spark, str(raw_dir / "m.jsonl")).first()["body"] == "olá\n!"


def test_bad_values_fail(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(f.name for f in schemas.TICKETS) + "\nT,not a date" + "," * 13 + "\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        sources.read_tickets(spark, str(bad)).collect()


RECORDS = [
    {"ticket_id": f"T{i}", "events": [
        {"ts": "2024-01-02 03:04:05", "event": "created", "actor": "a },\n  { b", "from_status": None, "to_status": "open"}
    ] * (i % 3)}
    for i in range(200)
]


@pytest.mark.parametrize("indent", [1, 2, 4])
def test_event_array_splits_at_its_indent(spark, tmp_path, indent):
    path = tmp_path / "events.json"
    path.write_text(json.dumps(RECORDS, indent=indent), encoding="utf-8")
    whole = sources.read_events(spark, str(path))
    split = sources.read_events(spark, str(path), indent=indent)
    assert split.schema == whole.schema
    key = lambda rows: sorted((r["ticket_id"], str(r["events"])) for r in rows)
    assert key(split.collect()) == key(whole.collect()) and split.count() == 200
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        parts = sources.read_events(spark, str(path), indent=indent)
        assert parts.rdd.getNumPartitions() > 3 and key(parts.collect()) == key(whole.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_wrong_indent_fails_instead_of_losing_rows(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text(json.dumps(RECORDS, indent=2), encoding="utf-8")
    with pytest.raises((PySparkException, Py4JJavaError)):
        sources.read_events(spark, str(path), indent=4).collect()


def test_inventory(spark, raw_dir):
    paths = {"tickets": str(raw_dir / "tickets.csv"), "events": str(raw_dir / "none.json")}
    with pytest.raises(inventory.MissingSource, match="events"):
        inventory.require_sources(spark, paths)
    assert list(inventory.present_sources(spark, paths)) == ["tickets"]
    df = sources.read_tickets(spark, paths["tickets"])
    assert [tuple(r) for r in inventory.row_counts({"t": df}).collect()] == [("t", 2)]
    inventory.check_schema("t", df, schemas.TICKETS)
    with pytest.raises(TypeError, match="csat_score"):
        inventory.check_schema("t", df.drop("csat_score"), schemas.TICKETS)



@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_file_formats_round_trip_and_overwrite(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    for _ in range(2):
        assert sink.publish(df, "t", Target(fmt, str(tmp_path))) == 2
    back = sources.read_table(spark, str(tmp_path / "t"), fmt, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_bucketed_raw_tables_join_without_exchange(spark):
    ids = spark.range(2000).select(F.col("id").cast("string").alias("ticket_id"))
    for name in ("one", "two"):
        sink.publish(ids.withColumn(name, F.lit(1)), name, Target("table", "rawtest"), bucket=("ticket_id", 4))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("rawtest.one").join(spark.table("rawtest.two"), "ticket_id", "left")
        assert "Exchange" not in plan_of(joined) and joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP SCHEMA rawtest CASCADE")


def test_jdbc_options_follow_the_contract():
    options = sink.jdbc_options("t", Target("jdbc", "jdbc:postgresql://h/db", {"schema": "raw", "user": "u"}))
    assert options == {"url": "jdbc:postgresql://h/db", "dbtable": "raw.t", "batchsize": "5000", "truncate": "true", "user": "u"}


def test_lake_layers(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "k string, created_date string")
    written = sink.publish_layers({"curated": {"fct": df}, "raw": {"k": df.select("k")}}, str(tmp_path))
    assert written == {"raw/k": 2, "curated/fct": 2}
    assert (tmp_path / "curated" / "fct" / "created_date=2024-01-01").is_dir()
    assert sink.read_layer(spark, str(tmp_path), "curated", "fct").count() == 2
    with pytest.raises(sink.NothingPublished):
        sink.publish_layers({}, str(tmp_path))


def test_stream_over_several_batches_equals_batch_and_resumes(spark, tmp_path):
    feed, state = tmp_path / "feed", str(tmp_path / "state")
    schema = "ticket_id string, event string, to_status string"
    rows = [(f"T{i % 5}", "reopened" if i == 7 else "created", ["open", "", None][i % 3]) for i in range(60)]
    whole = spark.createDataFrame(rows, schema)

    def drop(part, name):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(feed / name))

    def run():
        stream = incremental.stream_files(spark, str(feed) + "/*", files_per_trigger=1)
        incremental.start_log_partials(stream, state).awaitTermination()

    def streamed():
        return {tuple(r) for r in incremental.read_log_features(spark, state).collect()}

    drop(rows[:20], "1")
    drop(rows[20:40], "2")
    run()
    before = streamed()
    assert incremental.compact_partials(spark, state) == 1 and streamed() == before
    drop(rows[40:], "3")
    run()
    whole_log = {tuple(r) for r in log_features_flat(whole).collect()}
    assert streamed() == whole_log
    assert incremental.compact_partials(spark, state) == 2 and streamed() == whole_log
    assert len(list((tmp_path / "state" / "partials").glob("batch=*"))) == 3


def test_models_as_views(spark):
    sink.materialise_view(spark.range(3), "stg_probe")
    assert spark.table("stg_probe").count() == 3 and models.STAGING[0] == "stg_tickets"


class _Session:
    """A session that names no checkpoint folder."""

    def __init__(self, master):
        self.sparkContext = self
        self.conf = self
        self.master = master

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return None


def test_scratch_folder_is_the_named_one_and_never_guessed_on_a_cluster(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark)).rstrip("/")
    local = _Session("local[2]")
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(RuntimeError):
        shared_dir(_Session("yarn"))
