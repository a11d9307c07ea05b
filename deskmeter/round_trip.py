"""Readers and sinks as queries: tables are written in a format, read back and compared with where they came from.

Every query has a folder (or database) of its own in the shared folder.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter import schemas
from deskmeter.operators import cells
from deskmeter.plans import models
from deskmeter.queries import query
from deskmeter.session import reliable_checkpoint, shared_dir
from deskmeter.sinks import publish as sink
from deskmeter.sinks import versions
from deskmeter.sinks.publish import Target
from deskmeter.sources import derived as src
from deskmeter.sources import raw, sniff
from deskmeter.sources.json_array import read_json_array

#: Layouts of a JSON array, and the share of orders (by key modulo 3) that is written in each.
LAYOUTS = {"minified": {}, "indented": {"pretty": "true"}, "escaped": {"writeNonAsciiCharacterAsCodePoint": "true"}}
#: Delimiter and word for a missing value of each table's text.
DIALECTS = {"customer": (",", ""), "part": (";", "NULL"), "orders": ("\t", "NA"), "lineitem": ("|", ""), "events": (",", "N/A")}
#: Filters that a manager might set.
FILTERS = [
    {}, *({"priority": p} for p in ("Crítica", "Alta", "Média", "Baixa")), *({"channel": c} for c in ("Email", "Chat", "Redes Sociais")),
    *({"month": m} for m in (1, 6, 12, [1, 2, 3])), {"category": "Cancelamento"}, {"category": ["Faturamento", "Bug / Defeito"]},
    {"priority": ["Alta", "Crítica"], "channel": "Email"}, {"priority": "Baixa", "month": 7}, {"category": "Cancelamento", "channel": "Chat"},
    {"priority": "Média", "category": "Faturamento", "month": [4, 5]}, {"priority": [], "channel": None}, {"priority": "Urgente"},
    {"priority": "Alta", "category": "Cancelamento", "channel": "Email", "month": 3}, {"priority": "absent"},
]
FORMATS = ("parquet", "orc", "json", "csv", "table")


def scratch(spark) -> str:
    return f"{shared_dir(spark)}/deskmeter-files/{uuid.uuid4().hex}"


def awkward_events(spark, folder) -> DataFrame:
    """Ticket events whose texts are full of what a JSON layout is made of."""
    actor = F.concat(F.lit('é },\n  { "'), F.col("l_returnflag"), F.lit('" \\" [['), F.col("l_linestatus"), F.lit("}"))
    events = src.table(spark, folder, "lineitem").select("l_orderkey", F.struct(
        F.col("l_linenumber").alias("n"), F.col("l_shipdate").cast("timestamp_ntz").alias("ts"), F.col("l_returnflag").alias("event"), actor.alias("actor"),
        F.lit(None).cast("string").alias("from_status"), F.col("l_linestatus").alias("to_status")).alias("e"))
    lists = events.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("e")).alias("events"))
    return lists.select(
        F.col("l_orderkey").cast("string").alias("ticket_id"),
        F.transform("events", lambda e: e.dropFields("n")).alias("events"), (F.col("l_orderkey") % 3).alias("layout"))


@query
def events_any_layout(spark, folder):
    place, rows = scratch(spark), awkward_events(spark, folder)
    read = []
    for i, (layout, options) in enumerate(LAYOUTS.items()):
        sink.write_json_array(rows.where(F.col("layout") == i).drop("layout"), f"{place}/{layout}", options)
        read.append(raw.read_events(spark, f"{place}/{layout}").withColumn("layout", F.lit(layout)))
    found = reduce(DataFrame.unionByName, read)
    return found.select(
        "layout", F.col("ticket_id").cast("bigint").alias("ticket_id"), F.size("events").alias("n_events"),
        F.array_max("events.ts").alias("last_ts"), F.md5(F.array_join("events.actor", "|").cast("binary")).alias("actors_md5"))


def _written_as_text(spark, folder) -> dict[str, str]:
    place, paths = scratch(spark), {}
    for name, (delimiter, missing) in DIALECTS.items():
        paths[name] = f"{place}/{name}"
        src.table(spark, folder, name).write.options(
            header=True, sep=delimiter, nullValue=missing, escape='"', timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
            timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS").csv(paths[name])
    return paths


@query
def sniffed_schema(spark, folder):
    """Five tables as delimited text in five dialects: names, places and types of their columns."""
    found = {name: sniff.sniff(spark, path) for name, path in _written_as_text(spark, folder).items()}
    return sniff.schema_rows(spark, found)


@query
def sniffed_rows(spark, folder):
    """Events by way of delimited text of an unknown dialect."""
    return sniff.read_sniffed(spark, _written_as_text(spark, folder)["events"])


@query
def csv_tickets(spark, folder):
    """Tickets by way of CSV, with its columns in another order and one too many."""
    path, rows = scratch(spark), src.tickets(spark, folder)
    shuffled = rows.select(*reversed(rows.columns), F.lit("x").alias("further"))
    shuffled.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return raw.read_tickets(spark, path)


@query
def jsonl_messages(spark, folder):
    path = scratch(spark)
    rows = src.messages(spark, folder).select(
        F.col("ticket_id").cast("string"), F.concat(F.lit("re: "), F.left("body", F.lit(20))).alias("subject"), "body",
        F.lit("").alias("agent_note"), "lang")
    rows.write.json(path)
    raw.check_keys(spark, path, schemas.MESSAGES)
    return raw.read_messages(spark, path).select(
        "ticket_id", "subject", F.md5(F.col("body").cast("binary")).alias("body_md5"), "agent_note", "lang")


@query
def published_formats(spark, folder):
    """Customers published in every file format and as a catalogue table, and read back, with the rows counted on the way."""
    place, database, read = scratch(spark), f"published_{uuid.uuid4().hex[:12]}", []
    rows = src.table(spark, folder, "customer")
    spark.sql(f"CREATE SCHEMA `{database}` LOCATION '{place}/{database}'")
    for fmt in FORMATS:
        written = sink.publish(rows, "customer", Target(fmt, database if fmt == "table" else f"{place}/{fmt}"),
                               bucket=("c_custkey", 4) if fmt == "table" else None)
        back = spark.table(f"{database}.customer") if fmt == "table" else raw.read_table(spark, f"{place}/{fmt}/customer", fmt, rows.schema)
        read.append(back.select(F.lit(fmt).alias("fmt"), F.lit(written).alias("n_written"), *rows.columns))
    return reduce(DataFrame.unionByName, read)


@query
def lake_layers(spark, folder):
    """Two layers published to a lake, the dated table (by month) read back from its partitions."""
    place, month = scratch(spark), F.concat(F.left(F.col("created_date").cast("string"), F.lit(7)), F.lit("-01"))
    clean = src.tickets_clean(spark, folder).withColumn("created_date", month)
    counts = sink.publish_layers({"raw": {"events": src.events_flat(spark, folder)}, "curated": {"tickets": clean}}, place)
    return sink.read_layer(spark, place, "curated", "tickets").select(
        "ticket_id", F.col("created_date").cast("string").alias("created_date"), "priority",
        F.lit(counts["raw/events"]).alias("n_raw"), F.lit(counts["curated/tickets"]).alias("n_curated"))


@query
def stored_predictions(spark, folder):
    place = scratch(spark)
    sink.publish(src.predictions(spark, folder).withColumn("ticket_id", F.col("ticket_id").cast("string")), "predictions", Target("parquet", place))
    return raw.read_predictions(spark, f"{place}/predictions")


@query
def staging_view(spark, folder):
    """A staging model as a view that is found by its name."""
    name = f"stg_tickets_{uuid.uuid4().hex[:12]}"
    sink.materialise_view(src.tickets_clean(spark, folder).where(F.col("priority") == "Alta"), name)
    return spark.table(name).groupBy("category").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def cards_from_cells(spark, folder):
    """The figures under every filter, from cells kept over three batches, one of them replayed; the fact is read for the batches alone."""
    place = scratch(spark)
    fact = reliable_checkpoint(models.fct_tickets(
        src.tickets_clean(spark, folder), src.text(spark, folder), src.logs(spark, folder)))
    for batch in (0, 1, 1, 2):
        cells.add_batch(fact.where(F.col("ticket_id") % 3 == batch), place, batch)
        if batch == 1:
            cells.compact(spark, place)
    answers = []
    for i, selected in enumerate(FILTERS):
        for by in (None, "priority"):
            found = cells.summary(spark, place, by, **selected)
            found = found if by else found.withColumn("valor", F.lit(None).cast("string"))
            answers.append(found.select(F.lit(i).alias("filter"), F.lit(by or "total").alias("dimensao"), "valor", *found.drop("valor").columns))
    return reduce(DataFrame.unionByName, answers)


@query
def lake_versions(spark, folder):
    """Tickets published by month in versions: as they are, once more, and with June's reopened."""
    place = scratch(spark)
    rows = reliable_checkpoint(src.tickets_clean(spark, folder).select(
        "ticket_id", F.left(F.col("created_date").cast("string"), F.lit(7)).alias("month"), "priority", "reopened"))
    reopened = rows.withColumn("reopened", F.when(F.col("month").endswith("-06"), 2).otherwise(F.col("reopened")).cast("int"))
    rows = rows.withColumn("reopened", F.col("reopened").cast("int"))
    told = [versions.publish_changed(df, place, "month") for df in (rows, rows, reopened)]
    final = versions.read_version(spark, place, rows.schema)
    return final.select("*", *[F.lit(n).alias(f"written_{i}") for i, (_, n) in enumerate(told)])
