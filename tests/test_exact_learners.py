"""The RBF machine against a dense solver, the network against finite differences and plain sequential training."""

import numpy as np
import pytest

from deskmeter.ml import network, svm


def table(spark, n, seed=0, parts=3, dims=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[: n // 10] = x[0]  # copies
    label = ((x[:, 0] ** 2 + x[:, 1] + 0.3 * rng.normal(size=n)) > 0.7).astype(int)
    rows = [(i, int(y), [float(v) for v in r]) for i, (r, y) in enumerate(zip(x, label, strict=True))]
    return spark.createDataFrame(rows, "id long, label int, features array<double>").repartition(parts), x, label


def dense_dual(x, label, gamma, c):
    """The dual optimum by steps on the most violating pair, over the whole kernel matrix."""
    y = np.where(label == 1, 1.0, -1.0)
    k = np.array([[np.exp(-gamma * np.sum((a - b) ** 2)) for b in x] for a in x])
    alpha, total = np.zeros(len(x)), np.zeros(len(x))
    while True:
        v = y - total
        up = np.flatnonzero(((y > 0) & (alpha < c)) | ((y < 0) & (alpha > 0)))
        low = np.flatnonzero(((y > 0) & (alpha > 0)) | ((y < 0) & (alpha < c)))
        i, j = up[np.argmax(v[up])], low[np.argmin(v[low])]
        if v[i] - v[j] < 1e-7:
            return alpha.sum() - 0.5 * np.sum(alpha * y * total), total + (v[i] + v[j]) / 2
        step = (v[i] - v[j]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        step = min(step, c - alpha[i] if y[i] > 0 else alpha[i], alpha[j] if y[j] > 0 else c - alpha[j])
        alpha[i] = min(max(alpha[i] + y[i] * step, 0.0), c)
        alpha[j] = min(max(alpha[j] - y[j] * step, 0.0), c)
        total += step * (k[i] - k[j])


@pytest.mark.parametrize("working, c", [(16, 1.0), (1024, 1.0), (32, 10.0)])
def test_machine_reaches_the_dense_optimum(spark, working, c):
    train, x, label = table(spark, 150)
    found = svm.fit(train, train.limit(20), c=c, gamma=0.4, working=working)
    objective, values = dense_dual(x, label, 0.4, c)
    state = svm.optimality(found).first()
    assert (state["violators"], state["out_of_bounds"], state["n_train"]) == (0, 0, 150) and abs(state["balance"]) < 1e-9
    assert state["objective"] == pytest.approx(objective, rel=1e-3)
    assert found.rounds == 1 if working > 150 else found.rounds > 1
    for r in svm.scores(found).collect():
        assert r["score"] == pytest.approx(values[r["id"]], abs=5e-3)


def test_machine_with_one_class_or_no_rows_to_score(spark):
    train, _, _ = table(spark, 30)
    one = svm.fit(train.where("label = 1"), train, gamma=0.5)
    assert one.rounds == 0 and {r["y_pred"] for r in svm.scores(one).collect()} == {1}
    assert svm.scores(svm.fit(train, train.limit(0), gamma=0.5)).count() == 0


def test_gradient_is_that_of_finite_differences():
    rng = np.random.default_rng(1)
    layers = network.shapes(5, (4, 3))
    weights, x, y = network.initial(layers, 3), rng.normal(size=(9, 5)), rng.integers(0, 2, 9).astype(float)
    _, gradient = network.loss_and_gradient(weights, layers, x, y, 0.1)
    for i in range(len(weights)):
        step = np.zeros_like(weights)
        step[i] = 1e-6
        up, down = (network.loss_and_gradient(weights + s, layers, x, y, 0.1)[0] for s in (step, -step))
        assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_one_task_trains_like_a_plain_loop(spark):
    train, _, _ = table(spark, 90, parts=1)
    settings = network.Settings(hidden=(6,), epochs=23, epochs_per_round=5, batch=20)
    found = network.fit(train, settings)
    rows = train.collect()
    x, y = np.array([r["features"] for r in rows]), np.array([float(r["label"]) for r in rows])
    weights = network.initial(found.layers, settings.seed)
    state, losses, step = network.train_rows(
        np.concatenate([weights, np.zeros(2 * len(weights))]), 0, found.layers, x, y, settings, range(23), 0)
    assert found.losses == pytest.approx(losses) and found.weights == pytest.approx(state[: len(weights)])


def test_tasks_are_averaged_and_a_stopped_run_goes_on(spark, tmp_path):
    train, _, label = table(spark, 200, parts=4)
    train.write.parquet(str(tmp_path / "train"))
    train = spark.read.parquet(str(tmp_path / "train"))
    folder = str(tmp_path / "state")
    settings = network.Settings(hidden=(8,), epochs=60, rate=0.01, batch=25)
    whole = network.fit(train, settings)
    network.fit(train, network.Settings(hidden=(8,), epochs=20, rate=0.01, batch=25), folder)
    resumed = network.fit(train, settings, folder)
    assert resumed.losses == whole.losses and np.array_equal(resumed.weights, whole.weights)
    assert whole.losses[-1] < 0.6 * whole.losses[0]
    scored = network.scores(whole, train).collect()
    assert np.mean([r["y_pred"] == r["y_true"] for r in scored]) > 0.85


def test_training_ends_when_the_loss_stands_still():
    settings = network.Settings()
    assert network.settled([1.0] * 11, settings) and not network.settled([1.0 - i / 100 for i in range(30)], settings)
