"""Cases in which results once depended on rounding, order of arrival, column order or key prefixes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskmeter.ml.knn import DIGITS, knn_blocked, knn_pruned
from deskmeter.operators.ordering import surrogate_key
from deskmeter.sources.raw import read_tickets
from deskmeter.streaming import incremental


def clouds(kind):
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(400, 6))
    if kind == "near copies":
        rows[:200] = rows[0] + rng.normal(size=(200, 6)) * 1e-5
    elif kind == "far from zero":
        rows += 1e6
    elif kind == "mixed norms":
        rows[::3] *= 1e4
    return rows


@pytest.mark.parametrize("kind", ["near copies", "far from zero", "mixed norms"])
@pytest.mark.parametrize("search", [knn_blocked, knn_pruned])
def test_neighbours_as_brute_force(spark, kind, search):
    rows, k = clouds(kind), 5
    frame = spark.createDataFrame([(i, i % 2, r.tolist()) for i, r in enumerate(rows)], "id long, label int, features array<double>")
    query, train = frame.where("id % 20 = 0"), frame.where("id % 20 <> 0")
    ids = [i for i in range(len(rows)) if i % 20]
    want = {}
    for q in range(0, len(rows), 20):
        d = np.round(((rows[q] - rows[ids]) ** 2).sum(1), DIGITS)
        want[q] = [ids[i] for i in np.lexsort((ids, d))[:k]]
    found: dict[int, dict[int, int]] = {}
    for r in search(query, train, k).collect():
        found.setdefault(r["id"], {})[r["rank"]] = r["neighbour"]
    assert {q: [n for _, n in sorted(ranks.items())] for q, ranks in found.items()} == want


def test_days_in_any_order_over_many_batches(spark, tmp_path):
    days = [20, 21, 10, 25, 28]
    for n, day in enumerate(days):
        rows = spark.range(100).select(F.lit(f"2024-01-{day:02d} 10:00:00").alias("ts"), (F.col("id") % 4 == 0).alias("bad"))
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    events = incremental.stream_files(spark, f"{tmp_path}/in", files_per_trigger=1)
    incremental.start_daily_counts(events, f"{tmp_path}/state", "ts", "bad").awaitTermination()
    found = incremental.read_daily_counts(spark, f"{tmp_path}/state").collect()
    assert sorted((r["day"].day, r["n_rows"], r["n_flagged"]) for r in found) == [(d, 100, 25) for d in sorted(days)]


HEADER = ("ticket_id,created_at,channel,product,category,priority,customer_tier,customer_id,agent_id,region,"
          "backlog_at_creation,first_response_minutes,resolution_minutes,reopened,csat_score").split(",")


def ticket_file(path, names):
    values = dict.fromkeys(HEADER, "") | {
        "ticket_id": "T1", "created_at": "2024-01-01 00:00:00", "category": "Acesso", "priority": "Alta",
        "backlog_at_creation": "3", "first_response_minutes": "1.5", "resolution_minutes": "2.5", "reopened": "0", "more": "x"}
    path.write_text(",".join(names) + "\n" + ",".join(values[n] for n in names) + "\n")
    return str(path)


def test_tickets_are_read_by_name(spark, tmp_path):
    swapped = [{"category": "priority", "priority": "category"}.get(n, n) for n in HEADER] + ["more"]
    row = read_tickets(spark, ticket_file(tmp_path / "a.csv", swapped)).first()
    assert (row["category"], row["priority"]) == ("Acesso", "Alta") and "more" not in row.asDict()
    with pytest.raises(ValueError, match="priority"):
        read_tickets(spark, ticket_file(tmp_path / "b.csv", [n for n in HEADER if n != "priority"]))


def test_keys_of_values_with_one_prefix(spark):
    names = [f"TCK-{i:06d}" for i in range(500)]
    frame = spark.createDataFrame([(n,) for n in [*names, None, *names[:9]]], "name string")
    found = {r["name"]: r["k"] for r in surrogate_key(frame, "name", "k").collect()}
    assert found == {n: i for i, n in enumerate(names, 1)} | {None: 501}
