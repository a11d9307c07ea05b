"""Versions of a published table."""

import pytest
from pyspark.sql import functions as F

from deskmeter.sinks import versions


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_only_changed_partitions_are_written(spark, tmp_path):
    place = str(tmp_path)
    df = spark.range(40).select("id", F.when(F.col("id") % 4 > 0, (F.col("id") % 4).cast("string")).alias("part"), F.lit(None).cast("string").alias("x"))
    assert versions.publish_changed(df, place, "part") == (0, 4)
    assert versions.publish_changed(df.orderBy(F.rand(1)).repartition(3), place, "part") == (0, 0)
    changed = df.withColumn("x", F.when(F.col("id") == 5, "new")).where("part is null or part <> '2'")
    assert versions.publish_changed(changed, place, "part") == (1, 1)
    assert rows(versions.read_version(spark, place, df.schema)) == rows(changed)
    assert rows(versions.read_version(spark, place, df.schema, 0)) == rows(df)
    assert versions.publish_changed(changed.where("id > 3"), place, "part") == (2, 3)
    assert rows(versions.read_version(spark, place, df.schema)) == rows(changed.where("id > 3"))


def test_a_run_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    place, df = str(tmp_path), spark.range(10).withColumn("part", F.col("id") % 2)
    versions.publish_changed(df, place, "part")

    class Killed(Exception):
        pass

    def die(*_, **__):
        raise Killed

    more = spark.range(20).withColumn("part", F.col("id") % 2)
    with monkeypatch.context() as broken:
        broken.setattr(versions.F, "lit", die)
        with pytest.raises(Killed):
            versions.publish_changed(more, place, "part")
    (tmp_path / "manifests" / "version=1").mkdir()  # a manifest that was never finished
    assert rows(versions.read_version(spark, place, df.schema)) == rows(df)


def test_swapped_values_and_copies_change_a_digest(spark):
    base = spark.createDataFrame([(1, "a", None), (2, None, "a")], "p int, x string, y string")
    swapped = spark.createDataFrame([(1, None, "a"), (2, "a", None)], "p int, x string, y string")
    double = base.unionByName(base)
    found = [{r["part"]: tuple(r)[1:] for r in versions.digests(d, "p").collect()} for d in (base, swapped, double)]
    assert all(found[0][p] != found[1][p] and found[0][p] != found[2][p] for p in "12")
