"""The stages of the corpus pipeline against brute force of their rules."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
import __spark_entry__ as contract  # noqa: E402

from .test_pairs import components, sets_of  # noqa: E402


def test_stages_follow_one_another(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before, docs)
        if name != "bpe":
            assert docs.columns == columns
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in seen["exact_dedup"])
    last = {}
    for i, t in before.items():
        last[t] = max(i, last.get(t, i))
    assert set(after) == set(last.values())
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in seen["jaccard_join"])
    assert set(after) == set(components(sets_of(before.items(), 5), 80, 100).values())
    assert docs.count() == seen["mixing"][1].count() > 0
    kept = seen["toxicity"][1].count()
    assert 0.75 * before.__len__() <= kept <= seen["toxicity"][0].count()


def test_run_is_registered(spark, small):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, small).columns == ["doc_id", "source", "n_tokens", "ids"]


def test_stages_on_odd_rows(spark, documents, folder, tmp_path):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "a b c d e f", "en", "x"), (1, "a b c d e f", "de", "x"), (None, "a b c d e f", None, "y"), (2, None, None, None),
            (None, None, None, "x"), (3, "", "en", "y"), (None, near, "en", "x"), (None, near + " more", "en", "y"), (5, near + " end", "fr", None),
            (6, "one two", "en", "x"), (6, "one three", "en", "x"), (8, "q " * 30_000, "en", "z")]
    frame = documents(*rows, extra=("_row", "_key", "score", "copies"))
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(9)], "doc_id long, quality int, toxic int")
    path = folder(documents=frame, labels=labels)
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[1:]:
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = sorted((str(r["doc_id"]), r["text"] or "") for r in docs.collect()) if name != "bpe" else docs.count()
        if name != "bpe":
            assert docs.columns == frame.columns
    # one row of each text, the largest id first; null and empty texts are equal
    assert seen["exact_dedup"] == sorted(
        [("1", rows[0][1]), ("3", ""), ("None", near), ("None", near + " more"), ("5", near + " end"), ("6", "one two"), ("6", "one three"), ("8", rows[-1][1])])
    assert seen["jaccard_join"] == sorted(
        [("1", rows[0][1]), ("3", ""), ("5", near + " end"), ("6", "one two"), ("6", "one three"), ("8", rows[-1][1])])
    assert set(seen["mixing"]) <= set(seen["jaccard_join"]) and seen["bpe"] == len(seen["mixing"])
    scored = corpus_pipeline.STAGES[0][1](spark, frame, path)
    assert scored.columns == frame.columns and {tuple(r) for r in scored.collect()} <= {tuple(r) for r in frame.collect()}


def test_empty_table_goes_through(spark, documents, folder):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = corpus_pipeline.run(spark, folder(documents=documents(), labels=labels))
    assert found.collect() == [] and found.columns == ["doc_id", "source", "n_tokens", "ids"]


def test_stages_that_are_not_written_between_keep_what_they_read(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    chained = corpus_pipeline.mixing(spark, corpus_pipeline.jaccard_join(spark, docs, small), small)
    assert corpus_pipeline.bpe(spark, chained, small).count() == chained.count()
