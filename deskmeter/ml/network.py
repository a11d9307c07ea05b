"""Perceptron with ReLU units and Adam, trained where the rows are.

Every task goes through its own rows in mini-batches, from the same weights and Adam moments; after a round of
epochs these are averaged, weighted by rows, in two steps (tasks to groups of tasks, groups to the driver),
so that no place adds up more than the square root of the number of tasks. With one task this is the usual
sequential training. The state is stored after every round; a run with the same folder goes on from the last one.

Training ends when the loss has not improved by ``tolerance`` for ``patience`` epochs, or after ``epochs``.
The order of the rows in an epoch follows from the seed, the epoch and the task.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter import domain
from deskmeter.session import reliable_checkpoint
from deskmeter.sources.inventory import matching

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HIDDEN = (64, 32)
_BETA1, _BETA2, _EPSILON = 0.9, 0.999, 1e-8


@dataclass(frozen=True)
class Settings:
    hidden: tuple[int, ...] = HIDDEN
    epochs: int = 500
    epochs_per_round: int = 10
    batch: int = 200
    rate: float = 1e-3
    penalty: float = 1e-4
    tolerance: float = 1e-4
    patience: int = 10
    seed: int = domain.SEED


def shapes(dimensions: int, hidden: tuple[int, ...]) -> list[tuple[int, int]]:
    sizes = [dimensions, *hidden, 1]
    return list(zip(sizes[:-1], sizes[1:], strict=True))


def unpack(weights: np.ndarray, layers: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(matrix, bias) of each layer, as views of one vector."""
    out, at = [], 0
    for rows, cols in layers:
        out.append((weights[at : at + rows * cols].reshape(rows, cols), weights[at + rows * cols : at + (rows + 1) * cols]))
        at += (rows + 1) * cols
    return out


def initial(layers: list[tuple[int, int]], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for rows, cols in layers:
        bound = math.sqrt(6.0 / (rows + cols))
        parts += [rng.uniform(-bound, bound, rows * cols), rng.uniform(-bound, bound, cols)]
    return np.concatenate(parts)


def forward(weights: np.ndarray, layers, x: np.ndarray) -> list[np.ndarray]:
    """The activations of every layer; the last are log-odds."""
    out = [x]
    for i, (matrix, bias) in enumerate(unpack(weights, layers)):
        z = out[-1] @ matrix + bias
        out.append(np.maximum(z, 0.0) if i < len(layers) - 1 else z)
    return out


def loss_and_gradient(weights: np.ndarray, layers, x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Mean log loss with half the squared matrices times ``penalty`` per row, and its gradient."""
    active = forward(weights, layers, x)
    z, n = active[-1][:, 0], len(x)
    loss = float(np.mean(np.logaddexp(0.0, z) - y * z))
    gradient = np.zeros_like(weights)
    delta = ((1.0 / (1.0 + np.exp(-z)) - y) / n)[:, None]
    own, views = unpack(weights, layers), unpack(gradient, layers)
    for i in reversed(range(len(layers))):
        matrix, into = own[i][0], views[i]
        loss += 0.5 * penalty / n * float((matrix * matrix).sum())
        into[0][:] = active[i].T @ delta + penalty / n * matrix
        into[1][:] = delta.sum(axis=0)
        if i:
            delta = (delta @ matrix.T) * (active[i] > 0)
    return loss, gradient


def train_rows(state: np.ndarray, step: int, layers, x: np.ndarray, y: np.ndarray, settings: Settings, epochs: range, task: int):
    """``state`` (weights, both moments) after the epochs over these rows, and the loss of each epoch."""
    weights, first, second = (part.copy() for part in np.split(state, 3))
    losses = []
    for epoch in epochs:
        order = np.random.default_rng([settings.seed, epoch, task]).permutation(len(x))
        total = 0.0
        for begin in range(0, len(x), settings.batch):
            rows = order[begin : begin + settings.batch]
            loss, gradient = loss_and_gradient(weights, layers, x[rows], y[rows], settings.penalty)
            step += 1
            first = _BETA1 * first + (1 - _BETA1) * gradient
            second = _BETA2 * second + (1 - _BETA2) * gradient * gradient
            rate = settings.rate * math.sqrt(1 - _BETA2**step) / (1 - _BETA1**step)
            weights -= rate * first / (np.sqrt(second) + _EPSILON)
            total += loss * len(rows)
        losses.append(total / len(x))
    return np.concatenate([weights, first, second]), losses, step


def _round(train: DataFrame, state: np.ndarray, step: int, layers, settings: Settings, epochs: range):
    """The averaged state, losses and steps after one round."""
    width = len(epochs)

    def own(batches):
        x, y = [], []
        for batch in batches:
            if batch.num_rows:
                x.append(batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
                y.append(batch.column("label").to_numpy(zero_copy_only=False).astype(float))
        if x:
            task = TaskContext.get().partitionId()
            x, y = np.concatenate(x), np.concatenate(y)
            new, losses, steps = train_rows(state, step, layers, x, y, settings, epochs, task)
            values = np.concatenate([new, losses, [float(steps)]]) * len(x)
            yield pa.RecordBatch.from_pydict({"task": [task], "n": [len(x)], "sums": [values]},
                                             pa.schema([("task", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.float64()))]))

    def merged(key, table):
        # in the order of the tasks, so that the sums are the same on every run
        table = table.sort_by("task")
        rows = table["sums"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        return pa.Table.from_pydict(
            {"grp": [key[0].as_py()], "n": [sum(table["n"].to_pylist())], "sums": [rows.sum(axis=0)]},
            pa.schema([("grp", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.float64()))]))

    parts = train.select("label", "features").mapInArrow(own, "task bigint, n bigint, sums array<double>")
    groups = max(1, math.isqrt(train.rdd.getNumPartitions()))
    rows = parts.withColumn("grp", F.col("task") % groups).groupBy("grp").applyInArrow(
        merged, "grp bigint, n bigint, sums array<double>").collect()
    rows.sort(key=lambda r: r["grp"])
    total = sum(np.array(r["sums"]) for r in rows) / sum(r["n"] for r in rows)
    return total[: len(state)], total[len(state) : len(state) + width].tolist(), round(total[-1])


@dataclass
class Network:
    weights: np.ndarray
    layers: list[tuple[int, int]]
    losses: list[float]

    @property
    def epochs(self) -> int:
        return len(self.losses)


def _saved(spark, folder: str) -> list[int]:
    return sorted(int(p.split("round=")[1].split("/")[0]) for p in matching(spark, f"{folder}/round=*/_SUCCESS"))


def fit(train: DataFrame, settings: Settings = Settings(), folder: str | None = None) -> Network:
    """``train`` holds (label 0/1, features), stored. With a ``folder`` the state is kept there after each round."""
    spark = train.sparkSession
    layers = shapes(train.select(F.size("features").alias("d")).first()["d"], settings.hidden)
    weights = initial(layers, settings.seed)
    state, losses, step, done = np.concatenate([weights, np.zeros(2 * len(weights))]), [], 0, 0
    if folder and (rounds := _saved(spark, folder)):
        row = spark.read.parquet(f"{folder}/round={rounds[-1]}").first()
        state, losses, step, done = np.array(row["state"]), list(row["losses"]), row["step"], rounds[-1]
    while len(losses) < settings.epochs and not settled(losses, settings):
        epochs = range(len(losses), min(settings.epochs, len(losses) + settings.epochs_per_round))
        state, new, step = _round(train, state, step, layers, settings, epochs)
        losses, done = [*losses, *new], done + 1
        if folder:
            spark.createDataFrame([(state.tolist(), losses, step)], "state array<double>, losses array<double>, step bigint").coalesce(
                1).write.mode("overwrite").parquet(f"{folder}/round={done}")
    return Network(state[: len(weights)], layers, losses)


def settled(losses: list[float], settings: Settings) -> bool:
    """Whether the best loss has not fallen by the tolerance for ``patience`` epochs."""
    best, still = math.inf, 0
    for loss in losses:
        still = still + 1 if loss > best - settings.tolerance else 0
        best = min(best, loss)
        if still >= settings.patience:
            return True
    return False


def scores(found: Network, test: DataFrame) -> DataFrame:
    """(id, y_true, score, y_pred): probability, class at 0.5."""
    weights, layers = found.weights, found.layers

    def run(batches):
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, layers[0][0])
            score = 1.0 / (1.0 + np.exp(-forward(weights, layers, x)[-1][:, 0]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y_true"), pa.array(score)], ["id", "y_true", "score"])

    rows = test.select("id", F.col("label").alias("y_true"), "features")
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    scored = rows.mapInArrow(run, f"id {kind['id']}, y_true {kind['y_true']}, score double")
    return scored.withColumn("y_pred", (F.col("score") >= 0.5).cast("int"))


def mlp_scores(train: DataFrame, test: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return scores(fit(reliable_checkpoint(train), settings), test)
