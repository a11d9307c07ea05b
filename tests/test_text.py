import random
import re
import unicodedata

import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskmeter import domain
from deskmeter.functions.numeric import round_binary, round_even, round_scaled
from deskmeter.functions.text import add_folded
from deskmeter.operators.text_features import text_features

TERMS = [*domain.URGENCY_TERMS, *domain.REFUND_TERMS, *domain.CANCEL_TERMS, *domain.ERROR_TERMS]


def expected(body):
    """Row-at-a-time definition of the nine features."""
    body = body or ""
    low = body.lower()
    folded = "".join(c for c in unicodedata.normalize("NFKD", low) if not unicodedata.combining(c))
    letters = sum(c.isalpha() for c in body)
    return (
        len(body), len(re.findall(r"\w+", low)), body.count("?"), body.count("!"),
        round(sum(c.isupper() for c in body) / letters, 4) if letters else 0.0,
        sum(folded.count(t) for t in domain.URGENCY_TERMS),
        *(int(any(t in folded for t in ts)) for ts in (domain.REFUND_TERMS, domain.CANCEL_TERMS, domain.ERROR_TERMS)),
    )


def run(spark, bodies):
    rows = [(str(i), b) for i, b in enumerate(bodies)]
    got = text_features(spark.createDataFrame(rows, "ticket_id string, body string")).collect()
    by_id = {r["ticket_id"]: tuple(r)[1:] for r in got}
    return [by_id[str(i)] for i in range(len(bodies))]


BODIES = [
    "Não FUNCIONA! Já, cobraram 2x?? ação_1 ﬁm ÇÉ", "seja ja janela", "", None, "12 34 ...", "ABC", "x" * 31 + "Y",
    "não funciona", "NÃO FUNCIONA; ＥＲＲＯ; 𝐞𝐫𝐫𝐨; ⒠rro; cancelarcancel", "O sistema caiurgente", "agoragora",
    "Ⅷ Ⓐ ǅ ß İ ΑΣ", "reembolsó não; prejuízo já", "日本語 テキスト 漢字！？", "naïve_tok١٢٣ x²",
]


def test_features_match_the_row_definition(spark):
    assert run(spark, BODIES) == [expected(b) for b in BODIES]


def test_random_unicode_matches_the_row_definition(spark):
    rng = random.Random(7)
    # characters both Unicode tables (Python's and the JVM's) know
    old = unicodedata.ucd_3_2_0
    pool = [c for c in map(chr, range(32, 0x2FFF)) if old.category(c) not in ("Cn", "Cs", "Co")]
    pieces = TERMS + ["é", "ﬁ", "?", "!", " ", "ＪＡ", "á"]
    bodies = [
        "".join(rng.choice(pieces) if rng.random() < 0.4 else rng.choice(pool) for _ in range(rng.randint(0, 60)))
        for _ in range(400)
    ]
    assert run(spark, bodies) == [expected(b) for b in bodies]


def test_fold_finds_exactly_the_same_terms(spark):
    bodies = [f"{a}{b}" for a in TERMS for b in ("", "ﬂ", "ĳ", "№")]
    df = spark.createDataFrame([(b,) for b in bodies], "t string")
    for row in add_folded(df, "t", TERMS, "f").collect():
        want = "".join(c for c in unicodedata.normalize("NFKD", row["t"].lower()) if not unicodedata.combining(c))
        assert [row["f"].count(t) for t in TERMS] == [want.count(t) for t in TERMS]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4000), st.integers(1, 4000)), min_size=200, max_size=300))
def test_round_binary_is_python_round(spark, pairs):
    values = [(u / a,) for u, a in pairs] + [(k / 32,) for k in range(64)] + [(0.00005,), (0.12345,), (2.675,)]
    df = spark.createDataFrame(values, "x double")
    for row in df.select("x", round_binary(F.col("x"), 4).alias("r")).collect():
        assert row["r"] == round(row["x"], 4)


def test_the_three_rounding_rules_differ_on_ties(spark):
    row = spark.createDataFrame([(0.03125,)], "x double").select(
        round_scaled(F.col("x"), 4), round_even(F.col("x"), 4), round_binary(F.col("x"), 4)
    ).first()
    assert tuple(row) == (0.0313, 0.0312, 0.0312)


def test_other_word_lists(spark):
    df = spark.createDataFrame([("1", "ready steady GO go")], "ticket_id string, body string")
    row = text_features(df, urgency=["go", "ady"], refund=["stead"], cancel=["zzz"], error=["a.y"]).first()
    assert (row["urgency_hits"], row["kw_refund"], row["kw_cancel"], row["kw_error"]) == (4, 1, 0, 0)


@pytest.mark.parametrize("node", ["Python", "Exchange", "Sort"])
def test_plan_is_narrow_and_native(spark, node):
    df = spark.createDataFrame([("1", "x")], "ticket_id string, body string")
    assert node not in plan_of(text_features(df))
