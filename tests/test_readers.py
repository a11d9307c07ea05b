"""JSON arrays of any layout in byte ranges, and delimited text of unknown dialect."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from deskmeter import schemas
from deskmeter.sinks import publish as sink
from deskmeter.sources import raw, sniff
from deskmeter.sources.json_array import entries, read_json_array

EVENT = {"ts": "2024-01-02 03:04:05", "event": "c\\\\", "actor": 'a },\n  { b "q" \\ é [[ ]', "from_status": None}
RECORDS = [
    {"ticket_id": f"T{i}", "events": [{**EVENT, "to_status": "}" * (i % 4) + "\\"}] * (i % 3 if i != 30 else 60)} for i in range(60)
]
LAYOUTS = {
    "minified": dict(separators=(",", ":")), "indented": dict(indent=3), "tabs": dict(indent="\t", ensure_ascii=False),
    "escaped": dict(ensure_ascii=True, indent=0),
}


def by_id(rows):
    return sorted((r["ticket_id"], str(r["events"])) for r in rows)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_ranges_give_the_records_of_the_whole_file(spark, tmp_path, layout):
    path = tmp_path / "events.json"
    path.write_text(json.dumps(RECORDS, **LAYOUTS[layout]), encoding="utf-8")
    whole = spark.read.schema(schemas.TICKET_EVENTS).options(multiLine=True, mode="FAILFAST").json(str(path))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    # with 997 bytes the long record reaches over ranges that hold no other
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    try:
        assert entries(spark, str(path)).count() > 8
        split = raw.read_events(spark, str(path))
        assert split.schema == whole.schema and by_id(split.collect()) == by_id(whole.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("text, rows", [("[]", 0), (" [ ]\n", 0), ("", 0), ("[{}]", 1), ('[{"ticket_id":"x"}, \n{"events":[]}]', 2)])
def test_small_arrays(spark, tmp_path, text, rows):
    (tmp_path / "e.json").write_text(text)
    assert read_json_array(spark, str(tmp_path / "e.json"), schemas.TICKET_EVENTS).count() == rows


@pytest.mark.parametrize("text", ['[{"a":1},', '[{"a":1}', '[1,{"a":1}]', '{"a":1}', '[{"a":1}] x', '[["a"]]', '[{"a":"}]'])
def test_anything_else_fails(spark, tmp_path, text):
    (tmp_path / "e.json").write_text(text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_json_array(spark, str(tmp_path / "e.json"), schemas.TICKET_EVENTS).collect()


def test_written_arrays_are_arrays(spark, tmp_path):
    df = spark.createDataFrame([("a\n", 1), ("b", None)], "k string, v int")
    sink.write_json_array(df.coalesce(1), str(tmp_path / "t"))
    (file,) = (tmp_path / "t").glob("part-*")
    assert json.loads(file.read_text()) == [{"k": "a\n", "v": 1}, {"k": "b", "v": None}]
    sink.write_json_array(df.limit(0).coalesce(1), str(tmp_path / "none"))
    assert read_json_array(spark, str(tmp_path / "none"), df.schema).count() == 0


def test_renamed_key_fails(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"ticket_id":"1","text":"x"}\n')
    with pytest.raises(ValueError, match="subject, body"):
        raw.check_keys(spark, str(tmp_path / "m.jsonl"), schemas.MESSAGES)


def test_sniffed_types_and_dialect(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id;flag;amount;day;at;mixed;empty;"odd;name"\n'
        '1;true;1;2024-01-02;2024-01-02 03:04:05;1;NA;"x;y"\n'
        '-2;FALSE;2.5e3;2024-02-29;2024-01-02;2024-01-01;;"say ""hi"""\n'
        ';NULL;.5;NA;2024-01-02T03:04:05.25;x;NULL;z\n')
    found = sniff.sniff(spark, str(tmp_path / "a.csv"))
    assert (found.delimiter, found.header) == (";", True)
    assert [(f.name, f.dataType) for f in found.schema.fields] == [
        ("id", T.LongType()), ("flag", T.BooleanType()), ("amount", T.DoubleType()), ("day", T.DateType()),
        ("at", T.TimestampNTZType()), ("mixed", T.StringType()), ("empty", T.StringType()), ("odd;name", T.StringType())]
    rows = sniff.read_sniffed(spark, str(tmp_path / "a.csv"), found).collect()
    assert [r["id"] for r in rows] == [1, -2, None] and rows[1]["odd;name"] == 'say "hi"' and rows[1]["amount"] == 2500.0


def test_types_merge_over_files_and_a_late_text_counts(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("k,v\n" + "\n".join(f"{i},{i}" for i in range(500)) + "\n")
    (tmp_path / "t" / "b.csv").write_text("k,v\n7,no number\n")
    assert [f.dataType for f in sniff.sniff(spark, str(tmp_path / "t")).schema.fields] == [T.LongType(), T.StringType()]


def test_no_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,a\n2,b\n")
    found = sniff.sniff(spark, str(tmp_path / "a.csv"))
    assert not found.header and [f.name for f in found.schema.fields] == ["column0", "column1"]
    assert sniff.read_sniffed(spark, str(tmp_path / "a.csv")).count() == 2


def test_impossible_dates_are_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("d,n\n2023-02-29,12345678901234567890\n")
    assert [f.dataType for f in sniff.sniff(spark, str(tmp_path / "a.csv")).schema.fields] == [T.StringType(), T.DoubleType()]
