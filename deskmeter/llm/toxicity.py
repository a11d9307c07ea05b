"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon is learned: words and word beginnings that labelled toxic documents have far more
often than others (log-likelihood ratio above the logarithm of the number of terms tried).
Features of a text: density, number, variety and weight of lexicon hits; hits with a
second-person word near; hits that show only after obfuscation (digits for letters, at the edges of
words too, one or more signs inside words) is undone in words that hold a letter; capitals, exclamation and question marks; signs inside words; length.

Fitting: of the labelled rows allowed for learning, the ``max_labelled`` first by a hash of the
id are used (a documented bound, so they may be broadcast). A part gives the lexicon, another the
trees, a third the isotonic calibration, so that none is fitted on what another has memorised.
Scoring reads every whole text once, without an exchange; trees and calibration run in the JVM.

Results: score in [0, 1], predicted = score >= 0.5. Null and empty texts have zero features and
are scored like any other. Without usable labels (none, or one class only) the score is the
share of toxic rows among them, or 0. Null labels and ids are left out of learning, rows of one id
count once (toxic if any says so). Repeated documents are scored one by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmeter.llm.common import give_back, lean, slices, store, utf8

MAX_LABELLED, MAX_TERMS, STEMS = 20_000, 2000, range(4, 9)
BATCH_BYTES = 4 << 20
_WORD = re.compile(r"[^\W\d_]+")
_NEAR = 40  # characters

# fixed values: second-person words of the languages at hand
_YOU = re.compile(r"\b(?:you|your|yours|yourself|ya|u|du|dich|dir|dein|deine|ihr|euch|tu|te|toi|ton|ta|tes|vous|votre|tú|ti|tus|usted|ustedes|vosotros)\b")
# fixed values: signs written for letters
_LEET = str.maketrans("0134578@$", "oieastbas")
_INNER = re.compile(r"(?<=[^\W_])[.*_\-]+(?=[^\W_])")
_RUN = re.compile(r"(?<![^\t\n\v\f\r ])[^\t\n\v\f\r 0-9@$*_.\-]*+[0-9@$*_.\-][^\t\n\v\f\r ]*+")

FEATURES = (
    "lexicon_density", "lexicon_hits", "lexicon_variety", "lexicon_weight", "you_hits", "you_density",
    "hidden_hits", "capitals", "exclamations", "questions", "signs_in_words", "log_words",
)


# -- the lexicon ------------------------------------------------------------------------------
def _terms(text: str) -> set[str]:
    """Words ending in a blank, and word beginnings."""
    words = set(_WORD.findall(text.lower()))
    return {w + " " for w in words} | {w[:n] for w in words for n in STEMS if len(w) >= n}


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lean()
    for batch in slices(batches, BATCH_BYTES):
        toxic, clean = Counter(), Counter()
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            (toxic if label else clean).update(_terms(text))
        names = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([toxic[t] for t in names], pa.int64()),
             pa.array([clean[t] for t in names], pa.int64())], ["term", "toxic", "clean"])


def learn_lexicon(labelled: DataFrame, max_terms: int = MAX_TERMS) -> dict[str, float]:
    """term -> log odds, from rows (text, toxic). At most ``max_terms``, the strongest."""
    totals = labelled.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    positive, rows = totals[0] or 0, totals[1]
    if not 0 < positive < rows:
        return {}
    base = positive / rows
    counts = store(
        labelled.select("text", F.col("toxic").cast("int").alias("toxic"))
        .mapInArrow(_count_terms, "term string, toxic bigint, clean bigint")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 0")
    )
    tried = max(2, counts.count())
    n = F.col("toxic") + F.col("clean")

    def part(k, share):
        return F.when(k > 0, k * F.log(k / (n * F.lit(share)))).otherwise(F.lit(0.0))

    gain = part(F.col("toxic"), base) + part(F.col("clean"), 1 - base)
    strong = (
        counts.withColumn("gain", gain).where((F.col("toxic") / n > base) & (F.col("gain") > math.log(tried)))
        .orderBy(F.col("gain").desc(), F.length("term").desc(), "term").limit(max_terms).collect()
    )
    lexicon, gains = {}, {}
    for r in strong:
        bare = r["term"].rstrip(" ")
        covered = any(bare[:k] in lexicon for k in range(1, len(bare) + 1)) or bare + " " in lexicon
        # a beginning of chosen terms must add evidence of its own
        known = sum(g for t, g in gains.items() if t.startswith(bare))
        if not covered and r["gain"] > 1.2 * known:
            odds = (r["toxic"] + 0.5) / (r["clean"] + 0.5) * (rows - positive + 0.5) / (positive + 0.5)
            lexicon[r["term"]], gains[r["term"]] = math.log(odds), r["gain"]
    return lexicon


# -- the features -----------------------------------------------------------------------------
@lru_cache(maxsize=1)
def _automaton(lexicon: tuple[tuple[str, float], ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for term, weight in lexicon:
        found.add_word(term.rstrip(" "), (term, weight))
    found.make_automaton()
    return found


def _hits(automaton, text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, term, weight) of the lexicon's terms at word beginnings, the whole word if asked."""
    out = []
    for last, (term, weight) in automaton.iter(text):
        end = last + 1
        start = end - len(term.rstrip(" "))
        if start and text[start - 1].isalpha():
            continue
        if term[-1] == " " and end < len(text) and text[end].isalpha():
            continue
        out.append((start, end, term, weight))
    return out


def _hidden(automaton, text: str) -> int:
    """Hits that show only when signs in runs of non-blanks that hold a letter are undone."""
    total = 0
    for m in _RUN.finditer(text):
        run = m[0]
        plain = _INNER.sub("", run.translate(_LEET))
        if plain != run and any(map(str.isalpha, run)):
            total += max(0, len(_hits(automaton, plain)) - len(_hits(automaton, run)))
    return total


_UPPER, _BANG, _ASK, _LETTER, _FOR_LETTER, _JOINT, _SPACE = (np.zeros(256, bool) for _ in range(7))
_UPPER[65:91] = True
_BANG[33] = True
_ASK[63] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_FOR_LETTER[[*b"0123456789@$"]] = True
_JOINT[[*b"*_.-"]] = True
_SPACE[[*b"\t\n\v\f\r "]] = True


def _signs(raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Places of signs in runs of non-blanks that hold a letter: those written for letters anywhere, others between letters or such.

    ``begins`` are the places where runs begin. Only the places of signs are listed, not all bytes.
    """
    if not len(begins):
        return begins
    lettered = np.add.reduceat(_LETTER[raw], begins, dtype=np.int32) > 0

    def run(at: np.ndarray) -> np.ndarray:
        return np.searchsorted(begins, at, side="right") - 1

    written = np.flatnonzero(_FOR_LETTER[raw])
    written = written[lettered[run(written)]]
    joints = np.flatnonzero(_JOINT[raw])
    group = np.cumsum(np.diff(joints, prepend=-2) > 1) - 1  # joints in a row have the same neighbours
    firsts = np.flatnonzero(np.diff(joints, prepend=-2) > 1)
    left = joints[firsts] - 1
    right = joints[np.append(firsts[1:], len(joints)) - 1] + 1 if len(joints) else joints
    inside = (left >= 0) & (right < len(raw))
    left, right = np.maximum(left, 0), np.minimum(right, len(raw) - 1)
    solid = _LETTER | _FOR_LETTER
    here = run(joints)
    same = inside[group] & solid[raw[left]][group] & solid[raw[right]][group] & lettered[here]
    same &= (run(left)[group] == here) & (run(right)[group] == here)
    return np.union1d(written, joints[same])


def feature_rows(column: pa.Array, lexicon: tuple[tuple[str, float], ...]) -> np.ndarray:
    """One row of ``FEATURES`` per text of an Arrow column without nulls."""
    raw, ends = utf8(column)

    def per_text(places: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(places, ends)).astype(float)

    size = np.maximum(np.diff(ends), 1)
    space = _SPACE[raw]
    starts = ~space
    starts[1:] &= space[:-1]
    inner = ends[:-1][ends[:-1] < len(raw)]
    starts[inner] = ~space[inner]
    begins = np.flatnonzero(starts)
    del space, starts
    words = per_text(begins)
    signs = per_text(_signs(raw, begins))
    out = np.zeros((len(column), len(FEATURES)))
    for i, mask in ((7, _UPPER), (8, _BANG), (9, _ASK)):
        out[:, i] = per_text(np.flatnonzero(mask[raw])) / size
    out[:, 10], out[:, 11] = signs / np.maximum(words, 1), np.log1p(words)
    if lexicon:
        automaton = _automaton(lexicon)
        for i, text in enumerate(column.to_pylist()):
            text = text.lower()
            hits = _hits(automaton, text)
            n = max(words[i], 1.0)
            if hits:
                near = sum(bool(_YOU.search(text, max(0, s - _NEAR), e + _NEAR)) for s, e, _, _ in hits)
                weights = [w for _, _, _, w in hits]
                out[i, :6] = len(hits) / n, len(hits), len({t for _, _, t, _ in hits}), max(weights), near, near / n
            if signs[i]:
                out[i, 6] = _hidden(automaton, text)
    return out


def _fresh(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = "_" + name
    return name


def with_features(docs: DataFrame, lexicon: dict[str, float], name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with an array of features as column ``name``."""
    frozen = tuple(sorted(lexicon.items()))
    work = _fresh(docs, "_text_of_features")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, BATCH_BYTES, work):
            rows = feature_rows(batch.column(work), frozen)
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1) * len(FEATURES), pa.int32()), pa.array(rows.ravel()))
            kept = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n != work]
            yield pa.RecordBatch.from_arrays([*(c for _, c in kept), flat], [*(n for n, _ in kept), name])
        give_back()

    ready = docs.withColumn(work, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return ready.mapInArrow(run, f"{schema}, `{name}` array<double>")


# -- the model --------------------------------------------------------------------------------
class ToxicityModel:
    def __init__(self, lexicon: dict[str, float], trees: GBTClassificationModel | None,
                 calibration: IsotonicRegressionModel | None, share: float):
        self.lexicon, self.trees, self.calibration, self.share = lexicon, trees, calibration, share

    def score(self, docs: DataFrame, keep: list[str] | None = None, name: str = "score", text_col: str = "text") -> DataFrame:
        """The kept columns (all of them, if none are named) and the score."""
        keep = docs.columns if keep is None else keep
        if self.trees is None:
            return docs.select(*keep, F.lit(self.share).alias(name))
        found = _fresh(docs, "_features")
        rows = docs.select(*dict.fromkeys([*keep, text_col]))
        rows = with_features(rows if text_col in keep else rows.withColumnRenamed(text_col, "_text"), self.lexicon,
                             found, text_col if text_col in keep else "_text").select(*keep, found)
        return self._calibrated(rows, found, name).select(*keep, name)

    def _calibrated(self, rows: DataFrame, found: str, name: str) -> DataFrame:
        rated = self.trees.transform(rows.withColumn("_vector", array_to_vector(found)))
        rated = rated.withColumn("_rate", vector_to_array("_probability")[1])
        if self.calibration is None:
            return rated.withColumn(name, F.col("_rate"))
        fitted = self.calibration.transform(rated)
        return fitted.withColumn(name, F.least(F.greatest("_fitted", F.lit(0.0)), F.lit(1.0)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", label_col: str = "toxic",
                 text_col: str = "text", max_labelled: int = MAX_LABELLED, rounds: int = 15, depth: int = 3) -> ToxicityModel:
    """Learn from the rows of ``labels`` for which ``learn`` (on its columns) holds."""
    known = labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    picked = store(
        known.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    )
    fold = F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(10))
    # at most max_labelled rows of an id and a label: a proven bound for the broadcast
    rows = store(
        docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
        .select("text", "toxic", fold.alias("fold"))
    )
    share = rows.agg(F.avg("toxic")).first()[0] or 0.0
    lexicon = learn_lexicon(rows.where("fold < 4"))
    rest = store(with_features(rows.where("fold >= 4"), lexicon, "_features").select("_features", "toxic", "fold"))
    rest = rest.coalesce(8).withColumn("_vector", array_to_vector("_features"))
    training, held = rest.where("fold < 8"), rest.where("fold >= 8")
    if training.select("toxic").distinct().count() < 2:
        return ToxicityModel(lexicon, None, None, share)
    trees = GBTClassifier(
        featuresCol="_vector", labelCol="toxic", predictionCol="_class", maxIter=rounds, maxDepth=depth,
        stepSize=0.3, seed=1,
    ).setRawPredictionCol("_raw").setProbabilityCol("_probability").fit(training)
    calibration = None
    if held.select("toxic").distinct().count() == 2:
        rated = trees.transform(held).select(vector_to_array("_probability")[1].alias("_rate"), F.col("toxic").cast("double").alias("toxic"))
        calibration = IsotonicRegression(featuresCol="_rate", labelCol="toxic", predictionCol="_fitted").fit(rated)
    return ToxicityModel(lexicon, trees, calibration, share)
