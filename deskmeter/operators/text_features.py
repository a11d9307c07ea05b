"""Nine text features per message, computed before any join so the body never shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmeter import domain
from deskmeter.functions import text as tx
from deskmeter.functions.numeric import ratio, round_binary
from deskmeter.session import at_least


def length_features(body: Column) -> dict[str, Column]:
    return {"body_len": F.length(body), "word_count": tx.word_count(body)}


def punctuation_features(body: Column) -> dict[str, Column]:
    return {"num_question": tx.occurrences(body, "?"), "num_exclam": tx.occurrences(body, "!")}


def urgency_feature(folded: Column, terms: list[str]) -> dict[str, Column]:
    hits = F.lit(0)
    for term in terms:
        hits = hits + tx.occurrences(folded, term)
    return {"urgency_hits": hits}


def keyword_features(
    folded: Column,
    refund: list[str] = domain.REFUND_TERMS,
    cancel: list[str] = domain.CANCEL_TERMS,
    error: list[str] = domain.ERROR_TERMS,
) -> dict[str, Column]:
    return {
        "kw_refund": tx.contains_any(folded, refund),
        "kw_cancel": tx.contains_any(folded, cancel),
        "kw_error": tx.contains_any(folded, error),
    }


def text_features(
    messages: DataFrame,
    key: str = "ticket_id",
    body: str = "body",
    urgency: list[str] = domain.URGENCY_TERMS,
    refund: list[str] = domain.REFUND_TERMS,
    cancel: list[str] = domain.CANCEL_TERMS,
    error: list[str] = domain.ERROR_TERMS,
    parts: int | None = None,
) -> DataFrame:
    """One row per message. A missing body counts as empty text.

    The work is all in the scan's tasks, and a file of one row group is one task: ``parts`` asks for that many
    tasks at least, at the price of an exchange where the scan has fewer.
    """
    terms = [*urgency, *refund, *cancel, *error]
    messages = at_least(messages.select(key, body), parts)
    base = messages.select(
        F.col(key), F.coalesce(F.col(body), F.lit("")).alias("_body")
    )
    folded = tx.add_folded(base, "_body", terms, "_folded")
    # the ratio is reused many times by its rounding rule, so it gets its own projection
    measured = folded.select(
        key,
        *[c.alias(n) for n, c in length_features(F.col("_body")).items()],
        *[c.alias(n) for n, c in punctuation_features(F.col("_body")).items()],
        ratio(tx.upper_count(F.col("_body")), tx.letter_count(F.col("_body"))).alias("_upper"),
        *[c.alias(n) for n, c in urgency_feature(F.col("_folded"), urgency).items()],
        *[
            c.alias(n)
            for n, c in keyword_features(F.col("_folded"), refund, cancel, error).items()
        ],
    )
    return measured.withColumn("upper_ratio", round_binary(F.col("_upper"), 4)).select(
        key, *domain.TEXT_FEATURES
    )
