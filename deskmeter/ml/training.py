"""Train and evaluate all candidates on one split and pick the champion."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter import domain
from deskmeter.ml import features, knn, metrics, network, svm
from deskmeter.ml.split import hash_split, stratified_split
from deskmeter.session import reliable_checkpoint

# fixed values: the published names of the baselines
BASELINE_MAJORITY = "baseline_majoritaria"
BASELINE_RULE = "baseline_regra_prioridade"
#: Rows of the matrix that are worth a task of their own.
ROWS_PER_TASK = 2048


@dataclass
class Prepared:
    """The split feature matrix; ``train`` and ``test`` hold (id, label, features, priority)."""

    train: DataFrame
    test: DataFrame
    names: list[str]
    split: DataFrame


def tasks(rows: DataFrame) -> int:
    """The tasks that a learner is worth: as many as the session has cores, each with ``ROWS_PER_TASK`` rows or more.

    Learners go over the stored matrix hundreds of times with one task per file, and a join's coalesced result may be one file.
    """
    return max(1, min(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // ROWS_PER_TASK))


def prepare(ml: DataFrame, exact: bool = True, seed: int = domain.SEED, stored: bool = False) -> Prepared:
    """Split, fit the encoders and build the matrix.

    The intermediate tables are checkpointed because each is read several times: the input
    unless it is ``stored`` already, the split (all learners must see the same rows on the
    same side) and the matrix.
    """
    if not stored:
        ml = reliable_checkpoint(ml)
    if exact:
        split = stratified_split(ml, domain.TARGET, seed=seed)
    else:
        split = hash_split(ml, seed=seed)
    split = reliable_checkpoint(split)
    categories = features.fit_categories(split)
    side = F.col("is_test")
    train_rows = split.where(side == 0)
    full = features.matrix(split, train_rows, categories, keep=("priority", "is_test"))
    full = reliable_checkpoint(full.repartition(tasks(split), "id"))
    return Prepared(
        full.where(side == 0).drop("is_test"),
        full.where(side == 1).drop("is_test"),
        features.feature_names(categories),
        split,
    )


def baseline_scores(data: Prepared) -> dict[str, DataFrame]:
    test = data.test.select("id", F.col("label").alias("y_true"), "priority")
    columns = ["id", "y_true", "score", "y_pred"]
    return {
        BASELINE_MAJORITY: metrics.majority_baseline(test, data.train).select(*columns),
        BASELINE_RULE: metrics.priority_baseline(test).select(*columns),
    }


def candidate_scores(data: Prepared, k: int = domain.NEIGHBOURS) -> dict[str, DataFrame]:
    """Scores of the four models; both neighbour searches are exact and must agree."""
    return {
        "knn_hardcode": knn.knn_scores(data.test, knn.knn_blocked(data.test, data.train, k)),
        "knn_sklearn": knn.knn_scores(data.test, knn.knn_pruned(data.test, data.train, k)),
        "svm": svm.svm_scores(data.train, data.test),
        "mlp": network.mlp_scores(data.train, data.test),
    }


def long_scores(scores: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [df.withColumn("model", F.lit(name)) for name, df in scores.items()]
    )


@dataclass
class Outcome:
    metrics: DataFrame
    comparison: DataFrame
    summary: DataFrame
    champion: str
    predictions: DataFrame
    roc: DataFrame


def train_evaluate(
    ml: DataFrame, exact: bool = True, seed: int = domain.SEED, stored: bool = False
) -> Outcome:
    """The whole training step. Only the winner's name reaches the driver."""
    data = prepare(ml, exact, seed, stored)
    candidates = candidate_scores(data)
    scores = reliable_checkpoint(long_scores({**baseline_scores(data), **candidates}))
    measured = reliable_checkpoint(metrics.evaluate(scores))

    def of(name: str) -> DataFrame:
        return scores.where(F.col("model") == name).drop("model")

    winner = metrics.champion(measured).first()["model"]
    best = of(winner)
    if winner == "svm":
        best = metrics.minmax(best, "score")
    curves = scores.where(F.col("model").isin(domain.CANDIDATE_MODELS))
    return Outcome(
        metrics=measured,
        comparison=metrics.agreement(of("knn_hardcode"), of("knn_sklearn")).withColumn("k", F.lit(domain.NEIGHBOURS)),
        summary=metrics.run_summary(data.split, domain.TARGET, len(data.names)),
        champion=winner,
        predictions=metrics.predictions_table(best, winner),
        roc=metrics.roc_curve(curves),
    )


def metrics_document(model_metrics: DataFrame, model_comparison: DataFrame, run_summary: DataFrame) -> DataFrame:
    """One row, one column: the stored metrics of a run as one JSON text, with the split's sizes, the comparison and the winner."""
    figures = [c for c in model_metrics.columns if c not in ("model", "champion")]
    by_model = F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", F.struct(*figures)))))
    models = model_metrics.agg(by_model.alias("m")).scalar()
    winner = model_metrics.agg(F.max("champion").alias("c")).scalar()
    comparison = model_comparison.select(F.struct("*").alias("s")).scalar()
    document = F.struct(*run_summary.columns, models.alias("models"), comparison.alias("knn_comparison"), winner.alias("champion"))
    return run_summary.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))
