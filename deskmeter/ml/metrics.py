"""Classification metrics over long score tables (model, id, y_true, score, y_pred).

Several models are evaluated in one pass by grouping on ``model``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter import domain
from deskmeter.functions.numeric import ratio, round_binary, round_even
from deskmeter.operators.ordering import cumulative_desc
from deskmeter.session import reliable_checkpoint


def confusion_counts(scores: DataFrame, by: list[str]) -> DataFrame:
    real, predicted = F.col("y_true") == 1, F.col("y_pred") == 1
    return scores.groupBy(*by).agg(
        F.count_if(real & predicted).alias("tp"),
        F.count_if(~real & predicted).alias("fp"),
        F.count_if(real & ~predicted).alias("fn"),
        F.count_if(~real & ~predicted).alias("tn"),
    )


def collapsed(scores: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """(by, score, y_pred, pos, neg): rows of each true class, stored once; all metrics follow from these."""
    return reliable_checkpoint(scores.groupBy(*by, "score", "y_pred").agg(
        F.count_if(F.col("y_true") == 1).alias("pos"), F.count_if(F.col("y_true") != 1).alias("neg")))


def classification_metrics(scores: DataFrame, by: tuple[str, ...] = ("model",), digits: int = 4) -> DataFrame:
    """accuracy, precision, recall and f1; a zero denominator gives 0."""
    return _rates(confusion_counts(scores, list(by)), digits)


def _rates(counts: DataFrame, digits: int) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    raw = {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }
    return counts.withColumns(raw).withColumns(
        {name: round_binary(F.col(name), digits) for name in raw}
    )


def score_steps(scores: DataFrame, by: list[str], counted: DataFrame | None = None) -> DataFrame:
    """One row per distinct score with running positives and negatives from the top down.

    The classes per score are counted once and stored (``counted``, if they are already), however often they are read.
    """
    counted = collapsed(scores, tuple(by)) if counted is None else counted
    grouped = counted.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return cumulative_desc(grouped, by, "score", ["pos", "neg"])


def roc_curve(scores: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """(threshold, tpr, fpr) for every distinct score; an absent class gives NULL rates."""
    steps = score_steps(scores, list(by))
    return steps.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("all_pos").cast("double")).alias("tpr"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("all_neg").cast("double")).alias("fpr"),
    )


def roc_auc(scores: DataFrame, by: tuple[str, ...] = ("model",), digits: int = 4, counted: DataFrame | None = None) -> DataFrame:
    """Exact area: share of (positive, negative) pairs ranked correctly, ties count half."""
    steps = score_steps(scores, list(by), counted)
    below = F.col("all_neg") - F.col("cum_neg") + F.col("neg") / 2.0
    area = F.sum(F.col("pos") * below)
    pairs = F.max("all_pos").cast("double") * F.max("all_neg").cast("double")
    return steps.groupBy(*by).agg(round_binary(F.try_divide(area, pairs), digits).alias("roc_auc"))


def evaluate(scores: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """All five metrics, one row per model, from one reading of the scores."""
    counted, hit = collapsed(scores, by), F.col("y_pred") == 1
    counts = counted.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(side, F.col(name))), F.lit(0)).alias(label)
        for label, side, name in (("tp", hit, "pos"), ("fp", hit, "neg"), ("fn", ~hit, "pos"), ("tn", ~hit, "neg"))])
    return _rates(counts, 4).drop("tp", "fp", "fn", "tn").join(roc_auc(scores, by, counted=counted), list(by))


def minmax(df: DataFrame, column: str, name: str = "score") -> DataFrame:
    """Scale to [0, 1] by the column's own range; a constant column becomes 0."""
    span = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("s")).scalar()
    low, high = F.col("_span")["lo"], F.col("_span")["hi"]
    scaled = F.when(high > low, (F.col(column) - low) / (high - low)).otherwise(F.lit(0.0))
    return df.withColumn("_span", span).withColumn(name, scaled).drop("_span")


def agreement(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """One row: share of rows two models label alike, F1 and AUC of both, and right - left. Either side is computed once."""
    columns = [key, "y_true", "score", "y_pred"]
    left, right = reliable_checkpoint(left.select(*columns)), reliable_checkpoint(right.select(*columns))
    both = left.select(key, F.col("y_pred").alias("_a")).join(
        right.select(key, F.col("y_pred").alias("_b")), key
    )
    same = both.agg(round_binary(F.avg((F.col("_a") == F.col("_b")).cast("int")), 4).alias("agreement"))
    columns = ["y_true", "score", "y_pred"]
    scores = left.select(*columns, F.lit("left").alias("model")).unionByName(
        right.select(*columns, F.lit("right").alias("model"))
    )
    sides = evaluate(scores).agg(*[
        F.max(F.when(F.col("model") == side, F.col(name))).alias(f"{name}_{side}")
        for name in ("f1", "roc_auc")
        for side in ("left", "right")
    ])
    return sides.select(
        same.scalar().alias("agreement"),
        "*",
        *[
            round_binary(F.col(f"{name}_right") - F.col(f"{name}_left"), 4).alias(f"diff_{name}")
            for name in ("f1", "roc_auc")
        ],
    )


def champion(metrics: DataFrame, order: list[str] = domain.CANDIDATE_MODELS) -> DataFrame:
    """The model with the highest F1; equal values go to the earlier name in ``order``.

    Names outside ``order`` (the baselines) do not compete.
    """
    position = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return metrics.where(position > 0).orderBy(F.desc("f1"), position).limit(1)


def majority_class(train: DataFrame, label: str = "label") -> DataFrame:
    """The most frequent label, the smallest on ties: one row."""
    counts = train.groupBy(F.col(label).alias("majority")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), F.asc("majority")).limit(1)


def majority_baseline(test: DataFrame, train: DataFrame, label: str = "label") -> DataFrame:
    """Every test row gets the training majority."""
    winner = majority_class(train, label).select("majority").scalar()
    return test.withColumn("y_pred", winner.cast("int")).withColumn(
        "score", F.col("y_pred").cast("double")
    )


def priority_baseline(test: DataFrame, priority: str = "priority") -> DataFrame:
    """The rule of thumb: urgent priorities breach."""
    rule = F.coalesce(F.col(priority).isin(domain.URGENT_PRIORITIES).cast("int"), F.lit(0))
    return test.withColumn("y_pred", rule).withColumn("score", rule.cast("double"))


def predictions_table(scores: DataFrame, name: str) -> DataFrame:
    """Holdout predictions in their stored layout; the score keeps four decimals."""
    return scores.select(
        F.col("id").alias("ticket_id"),
        F.col("y_true").cast("int").alias("y_true"),
        round_even(F.col("score"), 4).alias("proba_breach"),
        F.col("y_pred").cast("int").alias("y_pred"),
        F.lit(name).alias("modelo"),
    )


def run_summary(split: DataFrame, label: str, n_features: int) -> DataFrame:
    """One row: sizes of both sides, feature count and the target share among test rows."""
    test = F.col("is_test") == 1
    return split.agg(
        F.count_if(~test).alias("n_train"),
        F.count_if(test).alias("n_test"),
        round_binary(F.avg(F.when(test, F.col(label))), 4).alias("test_prevalence"),
    ).withColumn("n_features", F.lit(n_features))


__all__ = [
    "agreement", "champion", "classification_metrics", "collapsed", "confusion_counts", "evaluate",
    "majority_baseline", "majority_class", "minmax", "predictions_table", "priority_baseline",
    "roc_auc", "roc_curve", "run_summary", "score_steps",
]
