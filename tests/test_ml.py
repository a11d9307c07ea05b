import math
import random

import numpy as np
import pytest
from conftest import plan_of
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from deskmeter.ml import features, knn, learners, metrics
from deskmeter.ml.split import hash_split, stratified_split
from deskmeter.operators.ordering import cumulative_desc


# -- feature matrix -----------------------------------------------------------------
def test_one_hot_keeps_every_category_and_zeroes_missing(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "y")], "c string, d string")
    fitted = features.fit_categories(df, ["c", "d"])
    assert fitted == {"c": ["a", "b"], "d": ["x", "y"]}
    got = [tuple(r)[2:] for r in features.one_hot(df, fitted).collect()]
    assert got == [(0, 1, 1, 0), (1, 0, 1, 0), (0, 0, 0, 1)]


def test_too_many_categories_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(features, "MAX_CATEGORIES", 5)
    with pytest.raises(ValueError):
        features.fit_categories(spark.range(20).select(F.col("id").cast("string").alias("c")), ["c"])


def test_zscore_uses_training_moments_and_unit_divisor_for_constants(spark):
    train = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    test = spark.createDataFrame([(5.0, 9.0)], "a double, b double")
    a, b = features.zscore(test, train, ["a", "b"]).first()
    assert math.isclose(a, 3 / math.sqrt(2)) and b == 2.0


# -- splits ----------------------------------------------------------------------------
@pytest.mark.parametrize("positives", [0, 1, 7, 333])
def test_exact_split_sizes(spark, positives):
    n = 1001
    df = spark.range(n).select(F.col("id").alias("ticket_id"), (F.col("id") < positives).cast("int").alias("y"))
    got = {(r["y"], r["is_test"]): r["count"] for r in stratified_split(df, "y").groupBy("y", "is_test").count().collect()}
    total = sum(c for (_, t), c in got.items() if t == 1)
    assert total == math.ceil(n * 0.25) and sum(got.values()) == n
    for y, size in ((0, n - positives), (1, positives)):
        assert abs(got.get((y, 1), 0) - size * total / n) < 1


def test_splits_do_not_depend_on_partitioning_or_appends(spark):
    df = spark.range(500).select(F.col("id").alias("ticket_id"), (F.col("id") % 3 == 0).cast("int").alias("y"))

    def side(split):
        return {r["ticket_id"]: r["is_test"] for r in split.collect()}

    assert side(stratified_split(df, "y")) == side(stratified_split(df.repartition(7), "y"))
    more = spark.range(900).select(F.col("id").alias("ticket_id"), F.lit(0).alias("y"))
    first, second = side(hash_split(df)), side(hash_split(more))
    assert all(second[k] == v for k, v in first.items())
    assert 90 < sum(first.values()) < 160


# -- metrics -------------------------------------------------------------------------------
def scores(spark, rows):
    return spark.createDataFrame([("m", *r) for r in rows], "model string, y_true int, score double, y_pred int")


def test_zero_denominators(spark):
    row = metrics.evaluate(scores(spark, [(1, 0.0, 0), (0, 0.0, 0), (0, 0.0, 0)])).first()
    assert tuple(row)[1:] == (0.6667, 0.0, 0.0, 0.0, 0.5)
    assert metrics.roc_auc(scores(spark, [(1, 0.3, 1)])).first()["roc_auc"] is None


def test_auc_equals_the_library_and_the_pair_count(spark):
    rng = random.Random(3)
    rows = [(int(rng.random() < 0.4), round(rng.random() ** 3, 2), 0) for _ in range(3000)]
    df = scores(spark, rows)
    auc = metrics.roc_auc(df, digits=12).first()["roc_auc"]
    vectors = df.select(F.col("y_true").cast("double").alias("label"), array_to_vector(F.array(1 - F.col("score"), "score")).alias("rawPrediction"))
    assert math.isclose(auc, BinaryClassificationEvaluator(numBins=0).evaluate(vectors), abs_tol=1e-9)
    pos = np.array([s for y, s, _ in rows if y])
    neg = np.array([s for y, s, _ in rows if not y])
    pairs = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert math.isclose(auc, pairs / (len(pos) * len(neg)), abs_tol=1e-9)


def test_roc_curve_ends_at_one_and_never_falls(spark):
    rng = random.Random(4)
    df = scores(spark, [(rng.randint(0, 1), rng.random(), 0) for _ in range(2000)])
    curve = [tuple(r) for r in metrics.roc_curve(df).select("threshold", "tpr", "fpr").collect()]
    curve.sort(reverse=True)
    assert len(curve) == 2000 and curve[-1][1:] == (1.0, 1.0)
    assert all(a[1] <= b[1] and a[2] <= b[2] for a, b in zip(curve, curve[1:]))


@pytest.mark.parametrize("buckets", [2, 64])
def test_cumulative_sums_over_buckets(spark, buckets):
    rng = random.Random(5)
    values = [(g, k * 0.5, rng.randint(0, 9)) for g in "ab" for k in range(500)]
    df = spark.createDataFrame(values, "g string, k double, v long")
    got = {(r["g"], r["k"]): (r["cum_v"], r["all_v"]) for r in cumulative_desc(df, ["g"], "k", ["v"], buckets).collect()}
    for g in "ab":
        total, run = sum(v for x, _, v in values if x == g), 0
        for _, k, v in sorted((r for r in values if r[0] == g), key=lambda r: -r[1]):
            run += v
            assert got[(g, k)] == (run, total)


def test_champion_order_and_baselines(spark):
    df = spark.createDataFrame([("rule", 0.99), ("mlp", 0.8), ("svm", 0.8), ("knn_sklearn", 0.7)], "model string, f1 double")
    assert metrics.champion(df).first()["model"] == "svm"


def test_minmax_constant_and_majority_tie(spark):
    df = spark.createDataFrame([(1, 5.0), (0, 5.0)], "label int, s double")
    assert {r["score"] for r in metrics.minmax(df, "s").collect()} == {0.0}
    assert metrics.majority_class(df).first()["majority"] == 0


def test_agreement(spark):
    a = spark.createDataFrame([(1, 1, 0.9, 1), (2, 0, 0.2, 0), (3, 1, 0.4, 0)], "id int, y_true int, score double, y_pred int")
    b = spark.createDataFrame([(1, 1, 0.9, 1), (2, 0, 0.2, 0), (3, 1, 0.6, 1)], "id int, y_true int, score double, y_pred int")
    row = metrics.agreement(a, b).first()
    assert (row["agreement"], row["diff_f1"], row["diff_roc_auc"]) == (0.6667, 0.3333, 0.0)


# -- neighbours --------------------------------------------------------------------------------
def brute(query, train, k):
    out = {}
    for qid, q in query:
        ranked = sorted((round(float(((np.array(q) - np.array(t)) ** 2).sum()), 9), tid) for tid, _, t in train)
        out[qid] = [tid for _, tid in ranked[:k]]
    return out


def neighbours(df):
    got = {}
    for r in df.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    return got


def points(seed, n_train, n_query, kind):
    rng = np.random.default_rng(seed)
    if kind == "grid":  # many equal distances
        make = lambda n: rng.integers(0, 3, (n, 4)).astype(float)
    elif kind == "clusters":
        make = lambda n: rng.normal(0, 0.1, (n, 5)) + rng.integers(0, 4, (n, 1)) * 10.0
    else:  # a third of the rows is one and the same point
        make = lambda n: np.where(rng.random((n, 1)) < 0.34, 1.0, rng.normal(size=(n, 3)))
    train = [(i, i % 2, list(map(float, v))) for i, v in enumerate(make(n_train))]
    query = [(i, list(map(float, v))) for i, v in enumerate(make(n_query))]
    return query, train


@pytest.mark.parametrize("route", [knn.knn_blocked, knn.knn_pruned])
@pytest.mark.parametrize("kind", ["grid", "clusters", "copies"])
def test_neighbours_are_exact_with_many_small_blocks(spark, monkeypatch, route, kind):
    monkeypatch.setattr(knn, "TRAIN_ROWS", 50)
    monkeypatch.setattr(knn, "QUERY_ROWS", 40)
    query, train = points(1, 400, 90, kind)
    q = spark.createDataFrame(query, "id long, features array<double>")
    t = spark.createDataFrame(train, "id long, label int, features array<double>")
    assert neighbours(route(q, t, 7)) == brute(query, train, 7)


def test_fewer_training_rows_than_k_and_text_ids(spark):
    q = spark.createDataFrame([("q", [0.0])], "id string, features array<double>")
    t = spark.createDataFrame([("b", 1, [1.0]), ("a", 0, [-1.0]), ("c", 1, [5.0])], "id string, label int, features array<double>")
    for route in (knn.knn_blocked, knn.knn_pruned):
        assert neighbours(route(q, t, 15)) == {"q": ["a", "b", "c"]}
        assert knn.vote(route(q, t, 2)).first()["y_pred"] == 1  # one half is enough


def test_no_cross_join_and_ranks_limited_before_the_exchange(spark):
    query, train = points(2, 50, 5, "grid")
    q = spark.createDataFrame(query, "id long, features array<double>")
    t = spark.createDataFrame(train, "id long, label int, features array<double>")
    plan = plan_of(knn.knn_blocked(q, t, 3))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("WindowGroupLimit") == 4


# -- learners ---------------------------------------------------------------------------------------
def test_kernel_approximation(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 6))
    df = spark.createDataFrame([(i, 0, list(map(float, v))) for i, v in enumerate(x)], "id long, label int, features array<double>")
    gamma, dimensions = learners.scale_gamma(df)
    assert dimensions == 6 and math.isclose(gamma, 1 / (6 * x.var()), rel_tol=1e-9)
    z = np.array([r["features"] for r in learners.fourier_features(df, gamma, 6, 4096).orderBy("id").collect()])
    kernel = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - kernel).max() < 0.1


def test_svm_separates_a_ring(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 2)) * 1.5
    y = ((x**2).sum(1) > 2.5).astype(int)
    df = spark.createDataFrame([(i, int(b), list(map(float, v))) for i, (v, b) in enumerate(zip(x, y))], "id long, label int, features array<double>")
    scored = learners.svm_scores(df.where("id < 450"), df.where("id >= 450"), components=256, iterations=20)
    row = metrics.evaluate(scored.withColumn("model", F.lit("svm"))).first()
    assert row["f1"] > 0.9 and row["roc_auc"] > 0.97


def test_cosine_of_turns():
    turns = np.random.default_rng(2).normal(size=(50, 7)) * 20
    turns[0] = [0, 0.25, 0.5, 0.75, 1, -0.5, -3.25]
    found = turns.copy()
    learners._cosine(found)
    assert np.abs(found - np.cos(2 * np.pi * (turns - np.rint(turns)))).max() < 1e-15


@pytest.mark.parametrize("parts, c", [(1, 1.0), (5, 0.1)])
def test_linear_machine_ends_near_the_optimum_after_some_passes(spark, monkeypatch, parts, c):
    from pyspark.ml.classification import LinearSVC

    passes, sums = [], learners._sums
    monkeypatch.setattr(learners, "_sums", lambda *a: passes.append(1) or sums(*a))
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 4))
    y = ((x[:, 0] ** 2 + x[:, 1] + rng.normal(size=900)) > 1).astype(int)
    rows = [(i, int(b), list(map(float, v))) for i, (v, b) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id long, label int, features array<double>").repartition(parts, "id")
    w, b, objective = learners.linear_machine(df, 0.3, 4, c, 64)
    z = learners.fourier_features(df, 0.3, 4, 64).collect()
    a, sign = np.array([r["features"] for r in z]), np.array([2 * r["label"] - 1 for r in z])

    def value(w, b):
        return w @ w / 2 + c * np.maximum(0, 1 - sign * (a @ w + b)).sum()

    other = LinearSVC(maxIter=1000, regParam=1 / (c * 900), standardization=False).fit(learners._vectors(learners.fourier_features(df, 0.3, 4, 64)))
    assert objective == pytest.approx(value(w, b)) and objective <= value(other.coefficients.toArray(), other.intercept) * (1 + learners.GAP)
    assert len(passes) < 60


def test_linear_machine_of_one_class(spark):
    df = spark.createDataFrame([(i, 1, [float(i % 5), 1.0]) for i in range(40)], "id long, label int, features array<double>")
    assert {r["y_pred"] for r in learners.svm_scores(df, df, components=16).collect()} == {1}
