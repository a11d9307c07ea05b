"""Every operator as a named query over a folder of warehouse tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskmeter import domain
from deskmeter.functions import ticket
from deskmeter.functions.numeric import round_scaled
from deskmeter.ml import features, knn, learners, metrics, network, svm, training
from deskmeter.ml.split import hash_split, is_test, stratified_split
from deskmeter.operators import cards, quality
from deskmeter.operators.clean import add_breach, add_date_parts, add_sla, trim_categoricals
from deskmeter.operators.log_features import log_features_flat, log_features_nested
from deskmeter.operators.text_features import text_features
from deskmeter.plans import models
from deskmeter.plans.dashboard import dashboard_document
from deskmeter.session import reliable_checkpoint, shared_dir
from deskmeter.sources import derived as src
from deskmeter.sources.inventory import row_counts
from deskmeter.streaming import daily, incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ENGLISH_TERMS = ["the", "and", "ing", "data", "on the"]
#: Stated before any result was seen: area under the ROC curve that a learner of priorities must pass.
AUC_FLOOR = 0.75
CUTS = ["cut_050", "cut_070", "backlog", "priority"]


def portable(df: DataFrame) -> DataFrame:
    """Types that compare alike on every engine: bigint, double, ISO text for dates."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, folder: portable(function(spark, folder))
    return function


def register(name: str, function: Query) -> None:
    QUERIES[name] = lambda spark, folder: portable(function(spark, folder))


# -- inputs -------------------------------------------------------------------
def _fct(spark, folder):
    return models.fct_tickets(
        src.tickets_clean(spark, folder), src.text(spark, folder), src.logs(spark, folder)
    )


def _predictions(spark, folder):
    return models.stg_predictions(src.predictions(spark, folder))


def _mart(spark, folder):
    # fact and scores both read the tickets, whose joins are worth doing once
    clean = reliable_checkpoint(src.tickets_clean(spark, folder))
    fct = models.fct_tickets(clean, src.text(spark, folder), src.logs(spark, folder))
    return models.mart_ticket_decision(fct, models.stg_predictions(src.predictions(spark, folder, clean=clean)))


def _models(spark, folder):
    # in the job these are stored tables, written by the steps before
    return models.build_all(src.raw_tables(spark, folder, reliable_checkpoint), store=reliable_checkpoint)


def _ml(spark, folder):
    return models.ml_features_inner(
        src.tickets_clean(spark, folder), src.text(spark, folder), src.logs(spark, folder)
    )


def _vectors(spark, folder):
    return src.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        (F.col("label") == 1).cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def _knn_sides(spark, folder):
    df = _vectors(spark, folder)
    return df.where(is_test(F.col("id"))), df.where(~is_test(F.col("id")))


def _scores(spark, folder):
    """Four simple classifiers on the holdout: (model, id, y_true, score, y_pred)."""
    held = src.predictions(spark, folder, keep=("priority", "backlog_at_creation"))
    proba, backlog = F.col("proba_breach"), F.col("backlog_at_creation") / F.lit(100.0)
    urgent = F.coalesce(F.col("priority").isin(domain.URGENT_PRIORITIES), F.lit(False))
    rules = {
        "cut_050": (proba, proba >= 0.5),
        "cut_070": (proba, proba >= 0.7),
        "backlog": (backlog, backlog >= 0.5),
        "priority": (urgent.cast("double"), urgent),
    }
    entries = F.array(*[
        F.struct(F.lit(m).alias("model"), score.alias("score"), hit.cast("int").alias("y_pred"))
        for m, (score, hit) in rules.items()
    ])
    return held.select(F.col("ticket_id").alias("id"), "y_true", F.inline(entries))


# -- sources and cleaning --------------------------------------------------------
@query
def source_row_counts(spark, folder):
    return row_counts({
        "tickets": src.tickets(spark, folder),
        "messages": src.messages(spark, folder),
        "events": src.events_flat(spark, folder),
    })


@query
def clean_categoricals(spark, folder):
    return trim_categoricals(src.tickets(spark, folder)).select("ticket_id", *domain.CATEGORICAL)


@query
def ticket_date_parts(spark, folder):
    return add_date_parts(src.tickets(spark, folder)).select(
        "ticket_id", "created_at", "created_date", "created_hour", "created_weekday", "created_month"
    )


@query
def event_date_parts(spark, folder):
    return add_date_parts(src.table(spark, folder, "events"), "ts").select(
        "event_id", "created_date", "created_hour", "created_weekday", "created_month"
    )


@query
def sla_minutes_lookup(spark, folder):
    return add_sla(trim_categoricals(src.tickets(spark, folder))).select(
        "ticket_id", "priority", "sla_minutes"
    )


@query
def sla_breach_flag(spark, folder):
    return add_breach(add_sla(trim_categoricals(src.tickets(spark, folder)))).select(
        "ticket_id", "resolution_minutes", "sla_minutes", "sla_breach"
    )


# -- text and logs ----------------------------------------------------------------
def _text_columns(*columns):
    return lambda spark, folder: src.text(spark, folder).select("ticket_id", *columns)


register("text_lengths", _text_columns("body_len", "word_count"))
register("text_punctuation", _text_columns("num_question", "num_exclam"))
register("text_upper_ratio", _text_columns("upper_ratio"))
register("text_urgency_hits", _text_columns("urgency_hits"))
register("text_keyword_flags", _text_columns("kw_refund", "kw_cancel", "kw_error"))
register("text_features", src.text)


@query
def text_custom_terms(spark, folder):
    """The same features with other word lists, here words that do occur in the texts."""
    return text_features(
        src.messages(spark, folder),
        urgency=ENGLISH_TERMS, refund=["pay"], cancel=["stop"], error=["fail", "miss"],
        parts=spark.sparkContext.defaultParallelism,
    ).select("ticket_id", "urgency_hits", "kw_refund", "kw_cancel", "kw_error")


register("log_features_flat", lambda s, f: log_features_flat(src.events_flat(s, f)))
register("log_features_nested", lambda s, f: log_features_nested(src.events_nested(s, f)))

# -- models -------------------------------------------------------------------------
register("stg_tickets", lambda s, f: models.stg_tickets(src.tickets_clean(s, f)))
register("stg_text_features", lambda s, f: models.stg_text_features(src.text(s, f)))
register("stg_log_features", lambda s, f: models.stg_log_features(src.logs(s, f)))
register("stg_predictions", _predictions)
register("dim_date", lambda s, f: models.dim_date(src.tickets_clean(s, f)))
register("dim_product", lambda s, f: models.dim_product(src.tickets_clean(s, f)))
register("dim_category", lambda s, f: models.dim_category(src.tickets_clean(s, f)))
register("dim_channel", lambda s, f: models.dim_channel(src.tickets_clean(s, f)))
register("fct_tickets", _fct)
register("fct_predictions", lambda s, f: models.fct_predictions(_predictions(s, f), _fct(s, f)))
register("mart_ticket_decision", _mart)
register("mart_ml_features", lambda s, f: models.mart_ml_features(_fct(s, f)))
register("ml_features_inner", _ml)


@query
def risk_band(spark, folder):
    return _predictions(spark, folder).select(
        "ticket_id", "proba_breach", ticket.risk_band(F.col("proba_breach")).alias("faixa_risco")
    )


# -- cards ----------------------------------------------------------------------------
register("kpi_global", lambda s, f: cards.kpi_global(_fct(s, f)))
register("kpi_global_hours", lambda s, f: cards.kpi_global_hours(_fct(s, f)))
register("card_ticket_count", lambda s, f: cards.ticket_count(_fct(s, f)))
register("card_breach_rate", lambda s, f: cards.breach_rate(_fct(s, f)))
register("card_resolution_hours", lambda s, f: cards.resolution_hours(_fct(s, f)))
register("breach_by_category", lambda s, f: cards.breach_by_category(_fct(s, f)))
register("breach_by_priority", lambda s, f: cards.breach_by_priority(_fct(s, f)))
register("breach_by_channel", lambda s, f: cards.breach_by_channel(_fct(s, f)))
register("breach_by_month", lambda s, f: cards.breach_by_month(_fct(s, f)))
register("breach_by_all_dims", lambda s, f: cards.breach_by_all_dims(_fct(s, f)))
register("risk_distribution", lambda s, f: cards.risk_distribution(_mart(s, f)))
register("top_risk_12", lambda s, f: cards.top_risk(_mart(s, f)))
register("risk_queue_50", lambda s, f: cards.risk_queue(_mart(s, f)))
register(
    "risk_queue_50_filtered",
    lambda s, f: cards.risk_queue(_mart(s, f), priority=["Alta", "Crítica"], channel="Email"),
)
register(
    "kpi_rate_filtered_priority", lambda s, f: cards.breach_rate(_fct(s, f), priority="Crítica")
)
register(
    "kpi_rate_filtered_category",
    lambda s, f: cards.breach_rate(_fct(s, f), category=["Cancelamento", "Bug / Defeito"]),
)
register(
    "kpi_rate_filtered_channel",
    lambda s, f: cards.breach_rate(_fct(s, f), channel="Redes Sociais", priority=None),
)
register("kpi_rate_filtered_month", lambda s, f: cards.breach_rate(_fct(s, f), month=[1, 2]))


@query
def confusion_matrix(spark, folder):
    return cards.confusion_matrix(models.fct_predictions(_predictions(spark, folder), _fct(spark, folder)))


@query
def confusion_matrix_labeled(spark, folder):
    return cards.confusion_matrix_labeled(
        models.fct_predictions(_predictions(spark, folder), _fct(spark, folder))
    )


@query
def dashboard_document_json(spark, folder):
    built = _models(spark, folder)
    return dashboard_document(
        built["fct_tickets"], built["mart_ticket_decision"], built["fct_predictions"]
    )


# -- data quality -----------------------------------------------------------------------
@query
def dq_not_null(spark, folder):
    checks = [
        quality.Check("not_null", "fct_tickets", c)
        for c in ("ticket_id", "priority", "body_len", "n_events", "csat_score")
    ]
    return quality.scalar_report(_fct(spark, folder), checks)


@query
def dq_unique(spark, folder):
    return quality.duplicated_keys(src.events_flat(spark, folder), "ticket_id")


@query
def dq_accepted_values(spark, folder):
    checks = [c for c in quality.MART_CHECKS if c.kind == "accepted_values"]
    return quality.scalar_report(_fct(spark, folder), checks)


@query
def dq_relationships(spark, folder):
    return quality.orphans(
        src.logs(spark, folder), "ticket_id", src.messages(spark, folder), "ticket_id"
    ).select("ticket_id", "n_events")


@query
def dq_report(spark, folder):
    return quality.report(_models(spark, folder))


@query
def dq_totals(spark, folder):
    return quality.totals(quality.report(_models(spark, folder)))


# -- feature matrix and splits -------------------------------------------------------------
@query
def onehot_categories(spark, folder):
    df = reliable_checkpoint(src.tickets_clean(spark, folder).select("ticket_id", *domain.CATEGORICAL))
    return features.one_hot(df, features.fit_categories(df)).drop(*domain.CATEGORICAL)


WIDE = [*domain.CATEGORICAL, "customer_id", "agent_id"]


@query
def onehot_sparse(spark, folder):
    """One-hot vectors as places of ones, of columns with any number of values."""
    df = reliable_checkpoint(src.tickets_clean(spark, folder).select("ticket_id", *WIDE))
    return features.one_hot_sparse(df, "ticket_id", WIDE).select("ticket_id", F.array_join("indices", ",").alias("indices"))


@query
def feature_moments(spark, folder):
    df = _ml(spark, folder)
    fitted = features.moments(df.where(~is_test(F.col("ticket_id"))))
    return fitted.select(*[round_scaled(F.col(c), 6).alias(c) for c in fitted.columns])


@query
def zscore_numeric(spark, folder):
    df = reliable_checkpoint(_ml(spark, folder).select("ticket_id", *domain.NUMERIC))
    scaled = features.zscore(df, df.where(~is_test(F.col("ticket_id"))))
    return scaled.select("ticket_id", *[round_scaled(F.col(c), 6).alias(c) for c in domain.NUMERIC])


@query
def split_hash(spark, folder):
    return hash_split(src.tickets_clean(spark, folder)).select("ticket_id", "is_test")


@query
def split_exact(spark, folder):
    df = reliable_checkpoint(src.tickets_clean(spark, folder).select("ticket_id", domain.TARGET))
    return stratified_split(df, domain.TARGET)


@query
def split_counts(spark, folder):
    return split_exact(spark, folder).groupBy(domain.TARGET, "is_test").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def run_summary(spark, folder):
    clean = reliable_checkpoint(src.tickets_clean(spark, folder).select("ticket_id", domain.TARGET, *domain.CATEGORICAL))
    encoded = clean.agg(*[F.count_distinct(c) for c in domain.CATEGORICAL]).first()
    split = stratified_split(clean.select("ticket_id", domain.TARGET), domain.TARGET)
    return metrics.run_summary(split, domain.TARGET, len(domain.NUMERIC) + sum(encoded))


@query
def holdout_lookup(spark, folder):
    """Attributes of the holdout tickets, looked up by id."""
    held = src.predictions(spark, folder).select("ticket_id")
    clean = src.tickets_clean(spark, folder)
    return clean.join(held, "ticket_id", "left_semi").select(
        "ticket_id", "priority", (F.col("priority").isin(domain.URGENT_PRIORITIES)).cast("int").alias("urgent")
    )


# -- metrics ------------------------------------------------------------------------------------
@query
def majority_class(spark, folder):
    train = src.tickets_clean(spark, folder).where(~is_test(F.col("ticket_id")))
    return metrics.majority_class(train, domain.TARGET)


def _baseline(spark, folder):
    df = src.tickets_clean(spark, folder).select(
        F.col("ticket_id").alias("id"), F.col(domain.TARGET).alias("y_true"), "priority"
    )
    return df.where(is_test(F.col("id"))), df.where(~is_test(F.col("id")))


@query
def baseline_majority(spark, folder):
    test, train = _baseline(spark, folder)
    scored = metrics.majority_baseline(test, train, "y_true")
    return metrics.evaluate(scored.withColumn("model", F.lit(training.BASELINE_MAJORITY)))


@query
def baseline_priority_rule(spark, folder):
    test, _ = _baseline(spark, folder)
    scored = metrics.priority_baseline(test)
    return metrics.evaluate(scored.withColumn("model", F.lit(training.BASELINE_RULE)))


register("classification_metrics", lambda s, f: metrics.classification_metrics(_scores(s, f)))
register("roc_auc_exact", lambda s, f: metrics.roc_auc(_scores(s, f)))
register("champion_model", lambda s, f: metrics.champion(metrics.evaluate(_scores(s, f)), CUTS))


@query
def label_metrics(spark, folder):
    """The two label columns of the documents as truth and prediction."""
    scored = src.table(spark, folder, "labels").select(
        F.col("quality").alias("y_true"), F.col("toxic").alias("y_pred"),
        F.col("toxic").cast("double").alias("score"), F.lit("toxic").alias("model"),
    )
    return metrics.evaluate(scored)


@query
def roc_curve(spark, folder):
    curve = metrics.roc_curve(_scores(spark, folder))
    return curve.withColumns({c: round_scaled(F.col(c), 9) for c in ("tpr", "fpr")})


@query
def minmax_score(spark, folder):
    df = src.table(spark, folder, "events").select("event_id", "value")
    scaled = metrics.minmax(df, "value")
    return scaled.select("event_id", round_scaled(F.col("score"), 9).alias("score"))


@query
def predictions(spark, folder):
    """Stored layout of a champion whose raw score is no probability."""
    best = _scores(spark, folder).where(F.col("model") == "backlog")
    return metrics.predictions_table(metrics.minmax(best, "score"), "backlog")


# -- neighbours and learners -----------------------------------------------------------------------
@query
def knn_topk(spark, folder):
    test, train = _knn_sides(spark, folder)
    return knn.knn_pruned(test, train).select("id", "rank", "neighbour", "d2")


@query
def knn_topk_blocked(spark, folder):
    test, train = _knn_sides(spark, folder)
    return knn.knn_blocked(test, train).select("id", "rank", "neighbour", "d2")


@query
def knn_vote(spark, folder):
    test, train = _knn_sides(spark, folder)
    votes = knn.vote(knn.knn_pruned(test, train))
    return votes.select("id", round_scaled(F.col("score"), 6).alias("score"), "y_pred")


@query
def knn_predict(spark, folder):
    test, train = _knn_sides(spark, folder)
    scored = knn.knn_scores(test, knn.knn_pruned(test, train))
    return metrics.evaluate(scored.withColumn("model", F.lit("knn_sklearn")))


@query
def model_agreement(spark, folder):
    """Both neighbour searches on the same split: they must label every row alike."""
    test, train = _knn_sides(spark, folder)
    return metrics.agreement(
        knn.knn_scores(test, knn.knn_blocked(test, train)),
        knn.knn_scores(test, knn.knn_pruned(test, train)),
    )


@query
def rule_agreement(spark, folder):
    """Two rules that do differ, so that the comparison itself is tested."""
    scores = _scores(spark, folder)

    def of(name):
        return scores.where(F.col("model") == name).drop("model")

    return metrics.agreement(of("cut_050"), of("priority"))


def _learned(name: str, scored: Callable) -> Query:
    def run(spark, folder):
        data = training.prepare(_ml(spark, folder), exact=False)
        return metrics.evaluate(scored(data.train, data.test).withColumn("model", F.lit(name)))

    return run


register("svm_rff_metrics", _learned("svm", learners.svm_scores))
register("mlp_metrics", _learned("mlp", learners.mlp_scores))


def _holdout(data, scored):
    """One row: sizes of both sides and whether the scores order the holdout better than the rule of thumb's level."""
    measured = metrics.evaluate(scored.withColumn("model", F.lit("m"))).select((F.col("roc_auc") >= AUC_FLOOR).alias("above_floor"))
    return measured.select(
        data.train.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_train"),
        data.test.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_test"),
        data.test.agg(F.count_if(F.col("label") == 1).alias("n")).scalar().alias("n_positive"), "above_floor")


@query
def svm_exact(spark, folder):
    """The RBF machine's optimality over all training rows, and its holdout."""
    data = training.prepare(_ml(spark, folder), exact=False)
    found = svm.fit(data.train, data.test)
    conditions = svm.optimality(found).select(
        "violators", "out_of_bounds", (F.abs("balance") < 1e-6).alias("balanced"), (F.col("objective") > 0).alias("improved"))
    return conditions.crossJoin(_holdout(data, svm.scores(found)))


@query
def network_trained(spark, folder):
    """The ReLU network's training, which ends by its own rule or after 500 epochs, and its holdout."""
    data = training.prepare(_ml(spark, folder), exact=False)
    found = network.fit(data.train)
    ended = network.settled(found.losses, network.Settings()) or found.epochs == 500
    return _holdout(data, network.scores(found, data.test)).select(
        "*", F.lit(ended).alias("ended"), F.lit(found.losses[-1] < found.losses[0]).alias("improved"))


# -- streams ----------------------------------------------------------------------------------------
def _state(spark) -> str:
    return f"{shared_dir(spark)}/deskmeter-streams/{uuid.uuid4().hex}"


@query
def stream_log_features(spark, folder):
    state = _state(spark)
    lines = incremental.stream_files(spark, f"{folder}/lineitem.parquet")
    incremental.start_log_partials(src.lines_as_events(lines), state).awaitTermination()
    return incremental.read_log_features(spark, state)


@query
def stream_daily_final(spark, folder):
    """Events in seven files in no order of time: days announced once, and corrected by what came later."""
    state, place = _state(spark), f"{shared_dir(spark)}/deskmeter-files/{uuid.uuid4().hex}"
    rows = src.table(spark, folder, "events").select("ts", "event_type", (F.col("value") > 10).alias("flagged"), "event_id")
    rows.repartition(7, F.col("event_id") * 31 % 7, F.dayofmonth("ts") % 3).write.parquet(place)
    stream = incremental.stream_files(spark, place, files_per_trigger=1)
    daily.start_daily_final(stream, state, "ts", "flagged", "event_type", delay_days=2).awaitTermination()
    told = daily.announcements(spark, state).drop("batch")
    every = told.unionByName(daily.open_days(spark, state).withColumn("kind", F.lit("open")))
    return every.groupBy("day", "event_type").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_flagged").alias("n_flagged"),
        (F.count_if(F.col("kind") == "final") <= 1).alias("told_once"), (F.count_if(F.col("kind") == "open") == 0).alias("closed"))


@query
def stream_daily_breach(spark, folder):
    state = _state(spark)
    events = incremental.stream_files(spark, f"{folder}/events.parquet").withColumn(
        "flagged", F.col("value") > 10
    )
    incremental.start_daily_counts(events, state, "ts", "flagged", by="event_type").awaitTermination()
    return incremental.read_daily_counts(spark, state, by="event_type")

from deskmeter import round_trip  # noqa: E402, F401  registers its queries
