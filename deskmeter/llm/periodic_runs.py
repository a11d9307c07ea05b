"""Runs of repeated words: maximal stretches of a small period, found tile by tile and stitched.

A run of period q is a maximal stretch of words in which words q apart are identical, q being its
smallest period, at least ``max(12, 2 q)`` words long. Periods are taken by octave [P, 2P). In an
octave, boundaries stand every P / 2 words (closer for the first three), so that every run crosses
some boundary with enough words on its right. The tile at a boundary c is solved by itself:
for every period q of the octave, how far the words from c on agree with those from c + q on (the Z
values of the boundary), and how far back they do, both within the tile. Only places where a hash
of the next words agrees are compared, word by word. Tiles give fragments (period, first, last) of
words that agree with the word a period on; touching fragments are combined, first in the task, then
by a shuffle on (document, period), and long enough unions are the runs.

Distribution: a document is exploded into overlapping stretches of ``tile_words`` words for the
octaves that are small beside them, and into one longer stretch for each octave above. Documents of a single
stretch are solved where they are read. Stretches of longer ones are dealt out to other tasks, and their fragments
overlap by more than a run's least length, so that nothing is lost at the seams.

Scale: the text is read once. What is stored is a row per document, with the words only of
documents that have fragments. Fragments of one document and period meet in one window, after those of a
task have been combined: these are few, as equal periods overlap by less than the period. The work is
n log n comparisons for n words. A task holds one batch (or one long stretch), about 60 bytes a word.

Multiples of a run's period are no runs of their own: they are left out where a run whose period
divides theirs covers them.

Nulls and empty texts have no words and no runs. Repeated rows (and ids) are rows of their own, as rows
are numbered when they are stored. Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskmeter.llm.common import slices, store, texts, utf8
from deskmeter.llm.words import mix, spans

SHORTEST = 12
BATCH_BYTES = 4 << 20
TILE_WORDS = 1 << 16
#: By octave: words between boundaries, words hashed behind a boundary. Together less than the shortest agreement.
_FIRST = {0: (4, 8), 1: (4, 4), 2: (2, 4)}
_CELLS = 1 << 21
_FRAGMENT = pa.struct([("period", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
FRAGMENTS = "array<struct<period: bigint, first: bigint, last: bigint>>"


def tile(octave: int) -> tuple[int, int]:
    """Words between boundaries, and words hashed behind each."""
    half = 1 << max(octave - 1, 0)
    return _FIRST.get(octave, (half, half))


def least(period):
    """How many words in a row must equal the word a period on."""
    return np.maximum(SHORTEST - period, period)


def octaves(words: int) -> int:
    """The number of octaves that runs in a text of so many words can have."""
    return (words // 2).bit_length() if words >= SHORTEST else 0


def word_codes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A number per word, equal for equal words only; begin and end byte of words; words before each text."""
    begin, stop, before = spans(raw, ends)
    data = raw[np.repeat(begin - np.concatenate([[0], np.cumsum(stop - begin)[:-1]]), stop - begin) + np.arange((stop - begin).sum())] \
        if len(begin) else raw[:0]
    at = np.concatenate([[0], np.cumsum(stop - begin)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), begin, stop, before


def _agree(code: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int, step: int) -> np.ndarray:
    """For each pair of places, how many words in a row agree from them on (or back), up to ``limit``."""
    out = np.zeros(len(a), np.int64)
    active, done, width = np.arange(len(a)), 0, 8
    while len(active) and done < limit:
        width = min(width, limit - done)
        on = []
        for part in np.array_split(active, len(active) * width // _CELLS + 1):
            t = (done + np.arange(width)) * step
            # the first and last code are met once only, so places held there never agree
            same = code[np.clip(a[part, None] + t, 0, len(code) - 1)] == code[np.clip(b[part, None] + t, 0, len(code) - 1)]
            full = same.all(axis=1)
            out[part] = done + np.where(full, width, np.argmin(same, axis=1))
            on.append(part[full])
        active, done, width = np.concatenate(on), done + width, width * 2
    return out


def combine(group: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite touching stretches [first, last) of each group."""
    if not len(group):
        return group, first, last
    order = np.lexsort((first, group))
    group, first, last = group[order], first[order], last[order]
    new_group = np.concatenate([[True], group[1:] != group[:-1]])
    lift = np.cumsum(new_group) * (int(last.max()) + 1)
    reach = np.maximum.accumulate(last + lift) - lift
    begins = new_group.copy()
    begins[1:] |= first[1:] > reach[:-1]
    at = np.flatnonzero(begins)
    return group[at], first[at], np.maximum.reduceat(last, at)


def _covered(q: np.ndarray, c: np.ndarray, found: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Which places lie in a run whose period is a proper divisor of theirs."""
    out = np.zeros(len(q), bool)
    for p, (first, last) in found.items():
        some = np.flatnonzero((q % p == 0) & (q > p))
        if len(some):
            at = np.searchsorted(first, c[some], side="right") - 1
            out[some] |= (at >= 0) & (last[at] + p >= c[some] + q[some] + p)
    return out


def _tiles(code: np.ndarray, names: np.ndarray, own: np.ndarray, octave: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Boundaries and periods of the octave where the words behind both places have the same hash."""
    low, (every, _) = 1 << octave, tile(octave)
    padded = np.concatenate([names, np.zeros(len(code) + 2 * low - len(names), np.uint64)])
    shifted = np.lib.stride_tricks.sliding_window_view(padded[low:], low)
    grid = np.arange(0, len(names), every)
    for part in np.array_split(grid, len(grid) * low // _CELLS + 1):
        rows, cols = np.nonzero(shifted[part] == padded[part, None])
        c, q = part[rows], cols + low
        inside = c + q < len(code)
        c, q = c[inside], q[inside]
        same = own[c] == own[c + q]
        if same.any():
            yield c[same], q[same]


def fragments(codes: np.ndarray, before: np.ndarray, begin_octave: int = 0, end_octave: int = 64):
    """(text, period, first, last) of the agreeing stretches of texts, whose words' numbers stand in a row.

    ``before`` has the number of words before each text, and of all words. ``first`` counts from the
    text's first word. Octaves below ``begin_octave`` are only looked at.
    """
    sizes = np.diff(before)
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    out = []
    last_octave = min(end_octave, octaves(int(sizes.max(initial=0))))
    alive, names, span = None, None, 0
    for octave in range(last_octave):
        low, (every, hashed) = 1 << octave, tile(octave)
        keep = np.flatnonzero(sizes >= max(SHORTEST, 2 * low))
        if alive is None or len(keep) < len(alive):  # texts too short for the octave go
            if alive is None:
                # a code of its own before every text and behind the last, so that nothing agrees across
                code = np.insert(codes, before[:-1], 0) if len(codes) else np.zeros(len(sizes), np.int64)
                own = np.repeat(np.arange(len(sizes)), sizes + 1)
                code[before[:-1] + np.arange(len(sizes))] = -1 - np.arange(len(sizes))
                code, own = np.append(code, -1 - len(sizes)), np.append(own, -1)
                place = np.arange(len(code))
            chosen = np.isin(own, keep)
            chosen[-1] = True
            if names is not None:
                names = names[chosen[: len(names)]]
            code, own, place, alive = code[chosen], own[chosen], place[chosen], keep
            if names is None or len(names) < len(code):
                names, span = mix(code.astype(np.uint64)), 1
                while span < (4 if octave < 4 else hashed):
                    names, span = _doubled(names, span), span * 2
        while octave > 2 and span < hashed:
            names, span = _doubled(names, span), span * 2
        hashes = _doubled(names, span) if octave == 0 else names
        pieces = []
        for c, q in _tiles(code, hashes, own, octave):
            if known:
                fresh = ~_covered(q, place[c], known)
                c, q = c[fresh], q[fresh]
            ahead = _agree(code, c, c + q, hashed + every, 1)
            true = ahead >= hashed
            c, q, ahead = c[true], q[true], ahead[true]
            back = _agree(code, c - 1, c + q - 1, every, -1)
            pieces.append(combine(q, place[c] - back, place[c] + ahead))
        if not pieces:
            continue
        q, first, last = combine(*(np.concatenate(x) for x in zip(*pieces, strict=True)))
        long = last - first >= least(q)
        q, first, last = q[long], first[long], last[long]
        for p in np.unique(q):
            found[int(p)].append((first[q == p], last[q == p]))
            known[int(p)] = found[int(p)][-1]
        if octave >= begin_octave and len(q):
            text = np.searchsorted(before[:-1] + np.arange(len(sizes)), first, side="right") - 1
            out.append((text, q, first - before[text] - text - 1, last - before[text] - text - 1))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _doubled(names: np.ndarray, span: int) -> np.ndarray:
    """Hashes of 2 ``span`` words in a row from those of ``span`` words."""
    if len(names) <= span:
        return names[:0]
    return mix(names[:-span] * np.uint64(0x2545F4914F6CDD1D) + names[span:])


def _lists(rows: int, text, period, first, last) -> pa.Array:
    order = np.argsort(text, kind="stable")
    at = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=rows))]).astype(np.int32)
    parts = [pa.array(x[order].astype(np.int64)) for x in (period, first, last)]
    return pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(parts, names=["period", "first", "last"]))


def _joined(raw, begin, stop) -> bytes:
    """Words joined by one space."""
    data = memoryview(raw)
    return b" ".join([data[b:s] for b, s in zip(begin.tolist(), stop.tolist(), strict=True)])


def stretches(words: int, tile_words: int) -> list[tuple[int, int, int, int]]:
    """(first octave, octave behind the last, first word, word behind the last) that together show every run."""
    small = max(1, (tile_words // 8).bit_length())
    out = []
    for low, high in [(0, small), *((k, k + 1) for k in range(small, octaves(words)))]:
        reach = max(3 << high, 2 * SHORTEST)
        step = max(tile_words, 1 << high)
        out += [(low, high, first, min(words, first + step + reach)) for first in range(0, max(words - reach, 1), step)]
    return out


def agreeing(docs: DataFrame, id_col: str, text_col: str, tile_words: int, batch_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Stored rows (rid, id, plain, text where needed), and (rid, period, first, last) of all tiles."""
    rows = texts(docs, F.col(id_col).alias("id"), text=text_col).select(F.monotonically_increasing_id().alias("rid"), "id", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, batch_bytes):
            column = batch.column("text")
            raw, ends = utf8(column)
            codes, begin, stop, before = word_codes(raw, ends)
            sizes = np.diff(before)
            long = sizes > tile_words
            if long.any():  # their stretches go to other tasks
                codes = codes[np.repeat(~long, sizes)]
            found = fragments(codes, np.concatenate([[0], np.cumsum(np.where(long, 0, sizes))]))
            lists = _lists(len(column), *found)
            told = long.copy()
            told[found[0]] = True
            plain = [None if told[i] else hashlib.sha256(_joined(raw, begin[before[i]:before[i + 1]], stop[before[i]:before[i + 1]])).hexdigest()
                     for i in range(len(column))]
            kept = pa.array([t if told[i] else None for i, t in enumerate(column.to_pylist())], pa.string()) if told.any() else pa.nulls(len(column), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("id"), pa.array(plain, pa.string()), kept, lists, pa.array(long)],
                ["rid", "id", "plain", "text", "fragments", "long"])

    kind = rows.schema["id"].dataType.simpleString()
    listed = store(rows.mapInArrow(
        read, f"rid bigint, id {kind}, plain string, text string, fragments {FRAGMENTS}, long boolean"))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = np.frombuffer(text.as_buffer(), np.uint8)
                begin, stop, _ = spans(raw, np.array([0, len(raw)]))
                for low, high, first, last in stretches(len(begin), tile_words):
                    yield pa.RecordBatch.from_pydict({
                        "rid": [rid], "low": [low], "high": [high], "first": [first],
                        "words": [_joined(raw, begin[first:last], stop[first:last])]})

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = np.frombuffer(row["words"], np.uint8)
                codes, _, _, before = word_codes(raw, np.array([0, len(raw)]))
                _, period, first, last = fragments(codes, before, row["low"], row["high"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(period), row["rid"])), pa.array(period), pa.array(first + row["first"]), pa.array(last + row["first"])],
                    ["rid", "period", "first", "last"])

    tiles = listed.where("long").select("rid", "text").mapInArrow(
        explode, "rid bigint, low bigint, high bigint, first bigint, words binary")
    dealt = tiles.repartition("rid", "low", "first").mapInArrow(solve, "rid bigint, period bigint, first bigint, last bigint")
    near = listed.select("rid", F.explode("fragments").alias("f")).select("rid", "f.period", "f.first", "f.last")
    return listed, near.unionByName(dealt)


def stitched(parts: DataFrame) -> DataFrame:
    """(rid, start, length, period) of stretches that are long enough, from fragments that touch."""
    within = Window.partitionBy("rid", "period").orderBy("first", "last")
    reach = F.max("last").over(within.rowsBetween(Window.unboundedPreceding, -1))
    islands = parts.withColumn("_new", F.when(reach >= F.col("first"), 0).otherwise(1)).withColumn("_island", F.sum("_new").over(within))
    whole = islands.groupBy("rid", "period", "_island").agg(F.min("first").alias("start"), F.max("last").alias("last"))
    length = F.col("last") - F.col("start") + F.col("period")
    return whole.select("rid", "start", length.alias("length"), "period").where(
        F.col("length") >= F.greatest(F.lit(SHORTEST), 2 * F.col("period")))


def smallest_only(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) without those that a run of a divisor of their period covers."""
    by_period: dict[int, list[tuple[int, int]]] = defaultdict(list)
    out = []
    for start, length, period in sorted(runs, key=lambda r: (r[2], r[0])):
        covered = False
        for p, known in by_period.items():
            if p < period and period % p == 0:
                at = bisect_right(known, (start, 1 << 62)) - 1
                if at >= 0 and known[at][1] >= start + length:
                    covered = True
                    break
        if not covered:
            by_period[period].append((start, start + length))
            out.append((start, length, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _checked(codes: np.ndarray, runs: list[tuple[int, int, int]]) -> None:
    for start, length, period in runs:
        if not np.array_equal(codes[start : start + length - period], codes[start + period : start + length]):
            raise AssertionError(f"no run of period {period} at word {start}")


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile_words: int = TILE_WORDS,
                  batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, runs (array of start, length, period), collapsed (text whose repeats are gone;
    null where there is no run), collapsed_sha256."""
    listed, parts = agreeing(docs, id_col, text_col, tile_words, batch_bytes)
    runs = stitched(parts).groupBy("rid").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    kind = listed.schema["id"].dataType.simpleString()
    run_list = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, batch_bytes):
            all_runs, collapsed, digests = [], [], []
            for text, found in zip(batch.column("text"), batch.column("runs").to_pylist(), strict=True):
                raw = np.frombuffer(text.as_buffer(), np.uint8)
                codes, begin, stop, _ = word_codes(raw, np.array([0, len(raw)]))
                chosen = smallest_only([(r["start"], r["length"], r["period"]) for r in found or []])
                _checked(codes, chosen)
                kept = np.ones(len(begin), bool)
                for start, length, period in chosen:
                    kept[start + period : start + length] = False
                joined = _joined(raw, begin[kept], stop[kept])
                all_runs.append([{"start": s, "length": n, "period": p} for s, n, p in chosen])
                collapsed.append(joined.decode())
                digests.append(hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(all_runs, run_list), pa.array(collapsed, pa.string()), pa.array(digests, pa.string())],
                [id_col, "runs", "collapsed", "collapsed_sha256"])

    shape = f"`{id_col}` {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string, collapsed_sha256 string"
    some = listed.where("text is not null").select("rid", "id", "text").join(runs, "rid", "left").select("id", "text", "runs")
    none = listed.where("text is null").select(
        F.col("id").alias(id_col), F.array().cast("array<struct<start: bigint, length: bigint, period: bigint>>").alias("runs"),
        F.lit(None).cast("string").alias("collapsed"), F.col("plain").alias("collapsed_sha256"))
    return some.mapInArrow(collapse, shape).unionByName(none)


def run_digest(runs) -> object:
    """The hash of ``start,length,period`` lines of a column of runs."""
    line = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return F.sha2(F.array_join(line, "").cast("binary"), 256)


def longest(runs) -> object:
    """The longest run; the first one, then the one of the smallest period, of equally long ones."""
    order = F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(order)
