"""Language of a text by cross-parsing entropy (Ziv and Merhav).

For each language a suffix automaton is built from labelled text. A text is parsed against it
greedily: a phrase is the longest match that starts where the last one ended. The more alike
the languages, the longer the phrases, so the language that needs the fewest, normalised
to bits per letter (phrases * log2(training length) / length), wins.

Letters are lower-cased; all else is one symbol. Long texts are parsed in stretches of
``stretch`` symbols (a phrase ends with its stretch), all of the text: the stretches of a batch
advance together, one symbol a step, in numpy.

Fitting uses a bounded sample of the labelled documents: per language the ``sample_docs``
different texts first by a hash of the text, ``sample_chars`` characters of each in the mean, and fewer where there
are so many languages that ``total_chars`` would be passed. Whole texts are used where they fit together;
else pieces of ``PIECE`` characters from all over them, first by a hash and equal ones once,
so neither a common beginning nor copies fill the sample. Only the sample (not the automata) is sent to the
executors. Predictions cover every whole text and need no exchange.

Results: ``und`` with score 0 for null and empty texts and texts without a letter, and where nothing
could be learned. The score is second / (best + second) of the bits, 0.5 (a tie, won by the smaller
label) to 1 (also with one language only). Repeated rows are predicted one by one; further
columns are dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmeter.llm.common import slices, store, texts

SAMPLE_DOCS, SAMPLE_CHARS, TOTAL_CHARS = 32, 1000, 2_000_000
STRETCH, PIECE = 1024, 250
BATCH_BYTES = 2 << 20
_GAP, _OTHER, _FIRST = 0, 1, 2  # not a letter, a letter without a symbol of its own
_DENSE = 256  # the commonest symbols have a column each in the table of transitions, all others a sorted list


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions (symbol to state) of the smallest automaton of all substrings, by state; state 0 is the start."""
    follow, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = state
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return follow


class Parser:
    """The automata of all languages in one table."""

    def __init__(self, sample: dict[str, str]):
        self.labels = sorted(sample)
        seen = Counter(c for text in sample.values() for c in text.lower() if c.isalpha())
        own = {c: i for i, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0])), _FIRST)}
        self.code = np.full(0x110000, _GAP, np.int32)
        for point in range(0x110000):
            if (c := chr(point)).isalpha():
                self.code[point] = own.get(c.lower(), _OTHER)
        self.size = len(own) + _FIRST
        self.dense = min(self.size, _DENSE)
        tables, self.roots, at, rare = [], [], 0, {}
        for label in self.labels:
            follow = suffix_automaton(self.symbols(sample[label]).tolist())
            table = np.full((len(follow), self.dense), -1, np.int32)
            for state, arcs in enumerate(follow):
                for c, to in arcs.items():
                    if c < self.dense:
                        table[state, c] = to + at
                    else:
                        rare[(state + at) * self.size + c] = to + at
            table[:, _OTHER] = -1  # a letter that no sample has is never matched
            tables.append(table)
            self.roots.append(at)
            at += len(follow)
        self.table = np.concatenate(tables).ravel()
        self.rare = np.array(sorted(rare), np.int64)
        self.rare_to = np.array([rare[k] for k in self.rare.tolist()], np.int32)
        self.bits = np.log2([max(2, len(sample[label])) for label in self.labels])

    def symbols(self, text: str) -> np.ndarray:
        return self.code[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def next(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The states behind symbols ``c`` (one per column), -1 where there is none."""
        if self.size <= self.dense:
            return self.table[state * self.dense + c]
        to = self.table[state * self.dense + np.minimum(c, self.dense - 1)]
        if len(some := np.flatnonzero(c >= self.dense)):
            key = np.broadcast_to(state, to.shape)[:, some].astype(np.int64) * self.size + c[some]
            at = np.minimum(np.searchsorted(self.rare, key), len(self.rare) - 1)
            to[:, some] = np.where(self.rare[at] == key, self.rare_to[at], -1)
        return to

    def phrases(self, symbols: np.ndarray, ends: np.ndarray, stretch: int) -> np.ndarray:
        """Phrases of each text (rows) in each language; ``ends`` are the texts' ends."""
        sizes = np.diff(ends, prepend=0)
        lanes = -(-sizes // stretch)
        owner = np.repeat(np.arange(len(sizes)), lanes)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = (ends - sizes)[owner] + nth * stretch
        length = np.minimum(ends[owner] - begin, stretch)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        root = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(root, len(owner), axis=1)
        count = np.ones((len(root), len(owner)), np.int32)  # the last phrase of a stretch
        active = len(owner) - np.searchsorted(length[::-1], np.arange(length[0] if len(length) else 0), side="right")
        for step, n in enumerate(active):
            c = symbols[begin[:n] + step]
            to = self.next(state[:, :n], c)
            miss = to < 0
            again = np.broadcast_to(self.next(root, c), to.shape)
            # a letter that is nowhere in the sample is a phrase of its own, behind the one that it ends
            alone = miss & (again < 0)
            count[:, :n] += miss
            count[:, :n] += alone & (state[:, :n] != root)
            state[:, :n] = np.where(miss, np.where(again < 0, root, again), to)
        count -= state == root  # no phrase is open at the end
        total = np.zeros((len(sizes), len(root)), np.int64)
        np.add.at(total, owner, count.T)
        return total

    def predict(self, column: list[str], stretch: int) -> tuple[list[str], np.ndarray]:
        parts = [self.symbols(t) for t in column]
        ends = np.cumsum([len(p) for p in parts])
        symbols = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        letters = np.concatenate([[0], np.cumsum(symbols != _GAP)])
        known = np.diff(letters[np.concatenate([[0], ends])]) > 0
        bits = self.phrases(symbols, ends, stretch) * self.bits
        best = np.argmin(bits, axis=1)
        ranked = np.sort(bits, axis=1)
        first = ranked[:, 0]
        second = ranked[:, 1] if len(self.labels) > 1 else np.full(len(first), np.inf)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(np.isinf(second), 1.0, second / (first + second))
        names = [self.labels[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
        return names, np.where(known, score, 0.0)


@lru_cache(maxsize=1)
def _parser(sample: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(dict(sample))


def training_sample(docs: DataFrame, learn: Column, lang_col: str = "lang", text_col: str = "text",
                    sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
                    total_chars: int = TOTAL_CHARS) -> dict[str, str]:
    """Language -> text, from a bounded number of characters of labelled documents."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("digest"), "digest")
    picked = store(rows.select("lang", "digest").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample_docs))
    share = max(1, min(sample_docs * (sample_chars + 1), total_chars // max(1, picked.select("lang").distinct().count())))
    # sample_docs rows a language: a bound for the broadcast; copies of a text meet as partial aggregates
    whole = rows.join(F.broadcast(picked), ["lang", "digest"]).groupBy("lang", "n").agg(F.first("text").alias("text"))
    fits = F.sum(F.length("text") + 1).over(Window.partitionBy("lang")) <= share
    pieces = whole.withColumn("fits", fits).select("lang", "n", "fits", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int")),
        lambda i: F.substring("text", i * PIECE + 1, F.lit(PIECE)))).alias("pos", "piece"))
    place = F.when(F.col("fits"), F.struct("n", "pos"))
    once = pieces.groupBy("lang", "piece", place.alias("place")).agg(F.min(F.struct("n", "pos")).alias("at"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("at.n", "at.pos"), "at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("piece") + 1).over(order), F.lit(0))
    chosen = once.withColumn("before", before).where(F.col("before") < share)
    gathered = chosen.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("parts"))
    found = {}
    for r in gathered.toLocalIterator():
        text, last = "", None
        for at, piece in r["parts"]:
            text += piece if last in (None, (at["n"], at["pos"] - 1)) else "\n" + piece
            last = (at["n"], at["pos"])
        found[r["lang"]] = text[:share]
    return found


def identify(docs: DataFrame, sample: dict[str, str], id_col: str = "doc_id", text_col: str = "text",
             stretch: int = STRETCH) -> DataFrame:
    """One row per document: id, lang_pred, score."""
    frozen = tuple(sorted(sample.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_BYTES):
            if frozen:
                names, score = _parser(frozen).predict(batch.column("text").to_pylist(), stretch)
            else:
                names, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score)], [id_col, "lang_pred", "score"])

    rows = texts(docs, id_col, text=text_col)
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
