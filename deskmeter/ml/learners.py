"""Kernel SVM by random features, and multilayer perceptron on Spark ML.

The RBF kernel is approximated by random Fourier features
(Rahimi and Recht, 2007): cos(w.x + b) with Gaussian w, so that a linear model on the
projected columns behaves like the kernel machine.
"""

from __future__ import annotations

import sys
import uuid
from math import factorial, pi

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskmeter import domain
from deskmeter.session import shared_dir, without_shuffles

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMPONENTS = 1024
#: The linear machine's objective is this share above its lower bound at most.
GAP = 5e-4
_STEPS = (*(0.5**i for i in range(9)), 0.0)
_PIECE = 1 << 14
#: Of -sin(2 pi x), by odd powers of x.
_SERIES = tuple(-((-1.0) ** k) * (2.0 * pi) ** (2 * k + 1) / factorial(2 * k + 1) for k in range(11))


def scale_gamma(train: DataFrame) -> tuple[float, int]:
    """(gamma, dimensions): 1 / (dimensions * variance of all matrix entries).

    Three sums per row, one aggregate; the matrix is never gathered.
    """
    f = F.col("features")
    total = F.aggregate(f, F.lit(0.0), lambda acc, x: acc + x)
    square = F.aggregate(f, F.lit(0.0), lambda acc, x: acc + x * x)
    row = train.agg(
        F.sum(total).alias("s"), F.sum(square).alias("q"), F.sum(F.size(f)).alias("n"), F.max(F.size(f)).alias("d")
    ).first()
    mean = row["s"] / row["n"]
    variance = row["q"] / row["n"] - mean * mean
    return (1.0 / (row["d"] * variance) if variance > 0 else 1.0), row["d"]


def _cosine(turns: np.ndarray) -> None:
    """In place, the cosine of so many turns, to 1e-15; numpy's own takes three times as long.

    The angle is folded to a quarter turn, where the sine's series needs eleven terms.
    """
    turns -= np.rint(turns)
    np.abs(turns, out=turns)
    turns -= 0.25
    square = turns * turns
    series = np.full_like(turns, _SERIES[-1])
    for term in _SERIES[-2::-1]:
        series *= square
        series += term
    turns *= series


def _projection(gamma: float, dimensions: int, components: int, seed: int):
    """The seeded map from raw rows to cosines, as a function on a batch's matrix."""
    rng = np.random.default_rng(seed)
    weights = rng.normal(0.0, np.sqrt(2.0 * gamma), (dimensions, components)) / (2.0 * np.pi)
    shift = rng.uniform(0.0, 2.0 * np.pi, components) / (2.0 * np.pi)
    factor = np.sqrt(2.0 / components)

    def cosines(part: pa.Table) -> np.ndarray:
        rows = part["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
        out = np.empty((len(rows), components))
        for at in range(0, len(rows), 64):
            some = out[at : at + 64]
            np.matmul(rows[at : at + 64], weights, out=some)
            some += shift
            _cosine(some)
            some *= factor
        return out

    return cosines


def _map_features(df: DataFrame, name: str, kind: T.DataType, build) -> DataFrame:
    """Replace ``features`` by ``build(part)``, in slices that keep a batch to some megabytes."""
    others = [f for f in df.schema.fields if f.name != "features"]
    names = [f.name for f in others]

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = pa.Table.from_batches([batch.slice(start, 1024)])
                yield from part.select(names).append_column(name, build(part)).to_batches()

    return df.mapInArrow(run, T.StructType([*others, T.StructField(name, kind)]))


def fourier_features(
    df: DataFrame, gamma: float, dimensions: int, components: int = COMPONENTS, seed: int = domain.SEED
) -> DataFrame:
    """Replace ``features`` by ``components`` cosines; one matrix product per slice."""
    cosines = _projection(gamma, dimensions, components, seed)

    def build(part: pa.Table) -> pa.Array:
        values = cosines(part)
        offsets = pa.array(np.arange(0, values.size + 1, components, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))

    return _map_features(df, "features", T.ArrayType(T.DoubleType()), build)


def decision_values(
    df: DataFrame, gamma: float, dimensions: int, coefficients: np.ndarray, intercept: float, seed: int = domain.SEED
) -> DataFrame:
    """Replace ``features`` by the signed ``score`` of a fitted linear model on the cosines.

    The wide projection never leaves the batch.
    """
    cosines = _projection(gamma, dimensions, len(coefficients), seed)

    def build(part: pa.Table) -> pa.Array:
        return pa.array(cosines(part) @ coefficients + intercept)

    return _map_features(df, "score", T.DoubleType(), build)


def _vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector("features"))


def _smooth(slack: np.ndarray, width: float) -> np.ndarray:
    """The hinge with its corner rounded off within ``width``; above it by a quarter of that at most."""
    return np.where(slack >= width, slack, np.where(slack <= -width, 0.0, (slack + width) ** 2 / (4 * width)))


def _sums(train: DataFrame, gamma: float, dimensions: int, components: int, seed: int, w: np.ndarray, step: np.ndarray, width: float) -> np.ndarray:
    """Over all rows z (cosines and a one) with margin slacks u at ``w``: smoothed losses at w + (t - 1) step for each t of _STEPS,
    the hinge losses, the weights a of the rows, a y z, and the upper triangle of z z over the rows within ``width`` of the corner.

    A task goes over its rows in slices and sends its sums in pieces, which are added up in the order of tasks.
    """
    cosines, upper = _projection(gamma, dimensions, components, seed), np.triu_indices(components + 1)

    def run(batches):
        lines, hinge, weight = np.zeros(len(_STEPS)), 0.0, 0.0
        towards, square = np.zeros(components + 1), np.zeros((components + 1, components + 1))
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = pa.Table.from_batches([batch.slice(start, 2048)])
                z = np.column_stack([cosines(part), np.ones(part.num_rows)])
                if part["label"].null_count or not np.isfinite(z).all():
                    raise ValueError("labels and features must be numbers")
                y = np.where(part["label"].to_numpy() > 0, 1.0, -1.0)
                slack, slope = 1.0 - y * (z @ w), y * (z @ step)
                lines += [_smooth(slack - (t - 1.0) * slope, width).sum() for t in _STEPS]
                a = np.clip((slack + width) / (2 * width), 0.0, 1.0)
                near = z[np.abs(slack) < width]
                hinge, weight = hinge + np.maximum(slack, 0.0).sum(), weight + a.sum()
                towards, square = towards + (a * y) @ z, square + near.T @ near
        flat = np.concatenate([lines, [hinge, weight], towards, square[upper]])
        pieces = [flat[at : at + _PIECE] for at in range(0, len(flat), _PIECE)]
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array(range(len(pieces)), pa.int32()), "task": pa.array([TaskContext.get().partitionId()] * len(pieces), pa.int32()),
            "sums": pa.array([x.tolist() for x in pieces], pa.list_(pa.float64()))})

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        each = rows["sums"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        return pa.table({"piece": rows["piece"][:1], "sums": pa.array([each.sum(axis=0).tolist()], pa.list_(pa.float64()))})

    found = train.select("features", "label").mapInArrow(run, "piece int, task int, sums array<double>")
    with without_shuffles(train.sparkSession):
        rows = found.groupBy("piece").applyInArrow(add, "piece int, sums array<double>").toArrow().sort_by("piece")
    return rows["sums"].combine_chunks().flatten().to_numpy()


def linear_machine(
    train: DataFrame, gamma: float, dimensions: int, c: float = 1.0, components: int = COMPONENTS, seed: int = domain.SEED, gap: float = GAP,
    iterations: int = 1000,
) -> tuple[np.ndarray, float, float]:
    """(coefficients, intercept, objective) that minimise |w|^2 / 2 + c * hinge losses over all rows' cosines.

    Newton's method on losses whose corner is rounded off, ever less. The weights of the rows are a point of the dual problem, whose value is a
    lower bound: it ends when the objective is within ``gap`` of it, after some tens of passes over the table.
    """
    size = components + 1
    upper, free = np.triu_indices(size), np.append(np.ones(components), 0.0)
    w, step, width, bound, objective = np.zeros(size), np.zeros(size), 2.0, -np.inf, np.inf
    for _ in range(iterations):
        sums = _sums(train, gamma, dimensions, components, seed, w, step, width)
        lines, (hinge, weight), rest = sums[: len(_STEPS)], sums[len(_STEPS) : len(_STEPS) + 2], sums[len(_STEPS) + 2 :]
        if step.any():
            tried = [w + (t - 1.0) * step for t in _STEPS]
            best = int(np.argmin([c * loss + (free * x * x).sum() / 2 for loss, x in zip(lines, tried, strict=True)]))
            if best:  # a shorter step is better; the last one is none at all
                w, step = tried[best], np.zeros(size)
                width *= 0.25 if _STEPS[best] == 0 else 1.0
                continue
        towards, square = c * rest[:size], np.zeros((size, size))
        square[upper] = c * rest[size:] / (2 * width)
        square = np.triu(square) + np.triu(square, 1).T + np.diag(free)
        square[-1, -1] += 1e-9
        objective = (free * w * w).sum() / 2 + c * hinge
        bound = max(bound, c * weight - (free * towards * towards).sum() / 2 - abs(towards[-1] * w[-1]))
        if objective - bound <= gap * max(objective, c) or width < 1e-6:
            break
        slope = free * w - towards
        step = -np.linalg.solve(square, slope)
        if -slope @ step <= 0.1 * c * (lines[0] - hinge):  # what is left is due to the rounded corner
            width, step = width / 4, np.zeros(size)
        w = w + step
    return w[:-1], float(w[-1]), float(objective)


def svm_scores(
    train: DataFrame, test: DataFrame, c: float = 1.0, components: int = COMPONENTS, iterations: int = 1000
) -> DataFrame:
    """(id, y_true, score, y_pred): signed decision value, class by its sign.

    Training ends by the machine's own bound; ``iterations`` is far beyond what it takes.
    """
    gamma, dimensions = scale_gamma(train)
    coefficients, intercept, _ = linear_machine(train, gamma, dimensions, c, components, iterations=iterations)
    scored = decision_values(test, gamma, dimensions, coefficients, intercept)
    return scored.select(
        "id", F.col("label").alias("y_true"), "score", (F.col("score") > 0).cast("int").alias("y_pred")
    )


def mlp_scores(
    train: DataFrame, test: DataFrame, hidden: tuple[int, ...] = (64, 32), iterations: int = 500, seed: int = domain.SEED
) -> DataFrame:
    """(id, y_true, score, y_pred): probability of a breach, class at 0.5."""
    dimensions = train.select(F.size("features").alias("d")).first()["d"]
    model = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="label", layers=[dimensions, *hidden, 2], maxIter=iterations, seed=seed
    ).fit(_vectors(train))
    # the stored model carries no training summary, hence no reference to this session
    path = f"{shared_dir(train.sparkSession)}/deskmeter-models/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    scored = MultilayerPerceptronClassificationModel.load(path).transform(_vectors(test))
    return scored.select(
        "id",
        F.col("label").alias("y_true"),
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("y_pred"),
    )
