"""Exact dedup and mixing: the queries against their SQL, edge cases, and the shape of the plans."""

import pytest
from pyspark.sql import functions as F

from deskmeter.llm.exact_dedup import drop_copies, exact_groups, name_blocks
from deskmeter.llm.common import texts
from deskmeter.llm.mixing import mix, plan, targets
from deskmeter.llm.queries import ORACLE, QUERIES

from .conftest import same_as_sql

ODD = [
    (1, "a b c"), (2, "a b c"), (3, None), (4, ""), (5, "x" * 9000), (6, "x" * 9000), (7, "x" * 8999 + "y"),
    (8, "é" * 5000), (9, " \t\n"), (10, "a b c "), (11, "x" * 4096), (12, "x" * 8192),
]


@pytest.mark.parametrize("name", ["op10_exact_dedup", "op9_mixing"])
def test_same_as_sql(spark, small, name):
    same_as_sql(QUERIES[name], ORACLE[name], spark, small)


@pytest.mark.parametrize("name", ["op10_exact_dedup", "op9_mixing"])
def test_odd_texts_as_sql(spark, documents, folder, name):
    rows = [(i, t, "en", s) for (i, t), s in zip(ODD, ["b", "a", None, "c"] * 3, strict=True)]
    path = folder(documents=documents(*rows, extra=("text_sha256", "bucket", "class", "rid")))
    same_as_sql(QUERIES[name], ORACLE[name], spark, path)


@pytest.mark.parametrize("name", ["op10_exact_dedup", "op9_mixing"])
def test_empty_table(spark, documents, folder, name):
    assert QUERIES[name](spark, folder(documents=documents())).collect() == []


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_block_size_changes_nothing(documents, block):
    texts_ = ["abab", "ababab", "abab", "", None, "aba", "b" * 50, "b" * 51, "b" * 50]
    found = {r["doc_id"]: r for r in exact_groups(documents(*enumerate(texts_)), block_bytes=block).collect()}
    for i, t in enumerate(texts_):
        same = [j for j, u in enumerate(texts_) if (u or "") == (t or "")]
        assert (found[i]["keep_id"], found[i]["group_size"], found[i]["kept"]) == (max(same), len(same), i == max(same))


def test_names_are_of_contents(documents):
    names, _ = name_blocks(texts(documents(*ODD)), 1000)
    assert names.select("name").distinct().count() == names.count()


def test_names_are_the_same_for_any_number_of_partitions(spark, documents):
    frame, seen = documents(*[(i, f"{i % 37} " * (i % 5)) for i in range(200)]), []
    for n in ("3", "8"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            names, _ = name_blocks(texts(frame), 3)
            seen.append({(r["a"], r["b"]): r["name"] for r in names.collect()})
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert seen[0] == seen[1] and sorted(seen[0].values()) == list(range(len(seen[0])))


def test_copies_go_whatever_their_other_columns(documents):
    frame = documents((1, "t", "en"), (1, "t", "de"), (None, "t"), (None, "u"), (None, "u", "fr"), (4, None), (3, ""), extra=("_row", "_key"))
    kept = drop_copies(frame)
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == [("1", "t"), ("4", ""), ("None", "u")]
    assert kept.columns == frame.columns


@pytest.mark.parametrize("order", [1, 2, 3])
def test_mixing_reruns_agree_for_repeated_ids(spark, documents, folder, order):
    import random

    rows = [(7, "w " * (20 + i % 4) + str(i % 9), None, "s" if i % 3 else "t") for i in range(200)]
    random.Random(order).shuffle(rows)
    path = folder(documents=documents(*rows).repartition(order))
    same_as_sql(QUERIES["op9_mixing"], ORACLE["op9_mixing"], spark, path)


def test_repeated_rows_and_null_ids(documents):
    frame = documents((1, "t"), (1, "t"), (None, "t"), (None, "u"), extra=("kept",))
    kept = [r["kept"] for r in exact_groups(frame).collect()]
    assert sum(kept) == 2
    assert sorted((r["doc_id"] or -1, r["text"]) for r in drop_copies(frame).collect()) == [(-1, "u"), (1, "t")]


def test_targets_fill_up_to_the_cap(spark):
    rows = [("a", 100, 5), ("b", 10, 2), ("c", 1000, 1), (None, 0, 5)]
    found = {r["source"]: r["target"] for r in targets(spark.createDataFrame(rows, "source string, source_size long, weight long")).collect()}
    assert found["a"] == 300 and found["b"] == 30 and found[None] == 0
    assert found["c"] == pytest.approx(1110 - 330)


def test_mix_follows_the_plan(documents):
    frame = documents(*[(i, "w " * (1 + i % 40), None, "abc"[i % 3]) for i in range(600)], extra=("copies", "n"))
    planned = {r["doc_id"]: r["copies"] for r in plan(frame).collect()}
    taken = {r["doc_id"]: r["count"] for r in mix(frame).groupBy("doc_id").count().collect()}
    assert taken == {i: c for i, c in planned.items() if c}
    assert mix(frame).columns == frame.columns
    sums = plan(frame).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r["t"] - r["g"]) < 0.03 * r["g"] for r in sums)
    assert max(planned.values()) <= 3


def test_mix_with_repeated_rows(documents):
    frame = documents((1, "a b", None, "s"), (1, "a b", None, "s"), (2, "c", None, "s"))
    assert mix(frame).count() == sum(r["copies"] for r in plan(frame).collect())


def test_mix_keeps_texts_of_repeated_and_null_ids(documents):
    rows = [(None, f"a b {i}", None, "s") for i in range(12)] + [(7, f"c {i} d", None, "s") for i in range(12)]
    frame = documents(*rows, extra=("_row",))
    texts_ = [r["text"] for r in mix(frame).collect()]
    assert len(texts_) == sum(r["copies"] for r in plan(frame).collect())
    assert set(texts_) == {t for _, t, *_ in rows} and max(map(texts_.count, texts_)) <= 3
    assert mix(frame).columns == frame.columns
