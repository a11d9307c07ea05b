"""Cards from cells against the same cards from the fact."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from deskmeter.operators import cards, cells

SCHEMA = """ticket_id long, priority string, category string, channel string, created_month int, sla_breach int,
resolution_minutes double, first_response_minutes double, reopened int, csat_score int"""


@pytest.fixture(scope="module")
def fact(spark):
    rows = [(i, ["Alta", "Baixa", None][i % 3], ["A", "B"][i % 2], ["Email", "Chat", None][i % 7 % 3], 1 + i % 12, int(i % 4 == 0),
             float(i % 90) if i % 5 else None, float(i % 11), i % 2, i % 5 or None) for i in range(300)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, fact, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("cells"))
    for batch in (0, 1, 1, 2, 0):
        cells.add_batch(fact.where(F.col("ticket_id") % 3 == batch), place, batch)
    return place


@pytest.mark.parametrize("selected", [{}, {"priority": "Alta"}, {"month": [1, 2]}, {"channel": "Chat", "category": "A"}, {"priority": "none"},
                                      {"priority": None, "month": []}])
def test_figures_as_from_the_fact(spark, fact, folder, selected):
    assert tuple(cells.summary(spark, folder, **selected).first()) == tuple(cards.kpi_global(fact, **selected).first())
    for by, card in (("channel", cards.breach_by_channel), ("month", cards.breach_by_month)):
        found = cells.summary(spark, folder, by, **selected).select("valor", "chamados", "taxa_violacao_pct")
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, card(fact, **selected).collect()), key=str)


def test_a_card_reads_one_level(spark, folder):
    plan = plan_of(cells.summary(spark, folder, "channel", priority="Alta"))
    assert f"level={cells.level_of(['priority', 'channel'])}" in plan and "level=15" not in plan
    level = cells.read_level(spark, folder, 0)
    assert level.count() == 3  # one total per batch


def test_snapshots_replace_the_batches_inside(spark, fact, tmp_path):
    place = str(tmp_path / "c")
    for batch in (0, 1):
        cells.add_batch(fact.where(F.col("ticket_id") % 3 == batch), place, batch)
    assert cells.compact(spark, place) == 1
    cells.add_batch(fact.where(F.col("ticket_id") % 3 == 2), place, 2)
    assert cells.read_level(spark, place, 0).count() == 2
    assert tuple(cells.summary(spark, place).first()) == tuple(cards.kpi_global(fact).first())
    assert cells.compact(spark, place) == 2 and cells.read_level(spark, place, 0).count() == 1


def test_streamed_cells(spark, fact, tmp_path):
    fact.repartition(3).write.parquet(str(tmp_path / "fact"))
    stream = spark.readStream.schema(fact.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "fact"))
    cells.start_cells(stream, str(tmp_path / "c")).awaitTermination()
    assert tuple(cells.summary(spark, str(tmp_path / "c")).first()) == tuple(cards.kpi_global(fact).first())


def test_days_are_told_once_and_corrected(spark, tmp_path):
    from datetime import date, datetime

    from deskmeter.streaming import daily

    def take(batch, rows):
        frame = spark.createDataFrame([(datetime(2024, 1, d, 12), g, f) for d, g, f in rows], "ts timestamp_ntz, g string, f boolean")
        daily.take_batch(frame, batch, str(tmp_path / "days"), "ts", "f", "g", 1)

    def told(batch):
        found = daily.announcements(spark, str(tmp_path)).where(F.col("batch") == batch).collect()
        return sorted((r["kind"], r["day"].day, r["g"], r["n_rows"], r["n_flagged"]) for r in found)

    take(0, [(1, "a", True), (1, "a", None), (2, "a", False)])
    assert told(0) == []
    take(1, [(3, "b", True), (1, "b", False)])
    assert told(1) == [("final", 1, "a", 2, 1), ("final", 1, "b", 1, 0)]
    for _ in range(2):  # a replayed batch says the same
        take(2, [(1, "a", True), (2, "a", True), (6, "a", True)])
        assert told(2) == [("correction", 1, "a", 1, 1), ("final", 2, "a", 2, 1), ("final", 3, "b", 1, 1)]
    take(3, [])
    assert told(3) == [] and [(r["day"], r["n_rows"]) for r in daily.open_days(spark, str(tmp_path)).collect()] == [(date(2024, 1, 6), 1)]


def test_sparse_one_hot_of_many_values(spark):
    from deskmeter.ml import features

    n = 20_000
    df = spark.range(n).select(
        "id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("b"))
    values = features.dictionary(df, ["a", "b"]).collect()
    assert sorted(r["index"] for r in values) == list(range(len(values)))
    by_place = {(r["place"], r["value"]): r["index"] for r in values}
    assert max(i for (p, _), i in by_place.items() if p == 0) < min(i for (p, _), i in by_place.items() if p == 1)
    order = sorted(by_place, key=lambda k: (k[0], k[1].encode()))
    assert [by_place[k] for k in order] == list(range(len(order)))
    found = {r["id"]: r["indices"] for r in features.one_hot_sparse(df, "id", ["a", "b"]).collect()}
    assert len(found) == n
    for r in df.collect():
        assert found[r["id"]] == [by_place[p, str(r[c])] for p, c in enumerate("ab") if r[c] is not None]
