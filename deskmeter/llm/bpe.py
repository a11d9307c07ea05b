"""Byte-level byte-pair encoding and decoding, by recursive queries in DuckDB inside each partition.

A text is split by the pattern of the vocabulary; every match is a word, encoded by itself. The words of a
batch become rows (word, position, id), one per byte. The recursive query joins neighbours with
the merge table, contracts in each word the leftmost pair of the smallest rank, and repeats until no
word has a pair left; a word that is a token itself is that token. Decoding joins ids with the
vocabulary and puts the bytes together by an ordered aggregate.

Scale: no exchange; Spark deals out the rows, and DuckDB (one thread, in memory, no files) sees the
distinct words of one batch of ``BATCH_BYTES``. Known words are remembered in Arrow and numpy arrays, ``REMEMBERED`` words
in ``REMEMBERED_BYTES`` at most, whatever the number of tasks of a worker.
The rounds of the query grow with a word's length, so words over ``LONG`` bytes (which
natural text hardly has) are contracted by the same rule with a heap. Long texts are
worked through in stretches of ``STRETCH`` words. What is sent to the executors is the vocabulary file.

Null and empty texts have no tokens. Special tokens' strings are ordinary text. Repeated rows are
encoded one by one; an empty table gives an empty result. Decoding ids that the vocabulary lacks
is an error; null ids count as none. Bytes that are not UTF-8 decode to bytes (``decoded``), not to text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter.llm.common import give_back, lean, lengths, slices, texts

BATCH_BYTES, STRETCH, LONG, QUERY_WORDS = 2 << 20, 400_000, 256, 20_000
REMEMBERED, REMEMBERED_BYTES = 1_500_000, 48 << 20

# fixed values: code points that the pattern engine here counts as letters or numbers and the tokenizer's
# library, with an older Unicode version, does not
_NEWER = (
    "\\u0558\\u058b-\\u058c\\u088f\\u0c5c\\u0cdc\\u208f\\u209d-\\u209f\\ua7ce-\\ua7cf\\ua7d2\\ua7d4\\ua7dd\\ua7e2\\ua7f1\\uab6c-\\uab6d"
    "\\U000107bb-\\U000107bf\\U00010940-\\U00010959\\U00010ec5-\\U00010ec7\\U00010ed9-\\U00010eee\\U00011b0a\\U00011db0-\\U00011ddb"
    "\\U00011de0-\\U00011de9\\U00011df1\\U0001246f\\U00012475-\\U0001247f\\U00012550-\\U00012686\\U00016ea0-\\U00016eb8"
    "\\U00016ebb-\\U00016ed3\\U00016ff2-\\U00016ff6\\U000187f8-\\U000187ff\\U00018cd6-\\U00018cda\\U00018d09-\\U00018d20"
    "\\U00018d80-\\U00018df2\\U00018e00-\\U00019191\\U000191a0-\\U000191d2\\U0001b123-\\U0001b128\\U0001b168\\U0001d6a6"
    "\\U0001df1f-\\U0001df24\\U0001df2b-\\U0001df81\\U0001df90-\\U0001df96\\U0001dfcd-\\U0001dfff\\U0001e6c0-\\U0001e6de"
    "\\U0001e6e0-\\U0001e6e2\\U0001e6e4-\\U0001e6e5\\U0001e6e7-\\U0001e6ed\\U0001e6f0-\\U0001e6f4\\U0001e6fe-\\U0001e6ff"
    "\\U0002b73a-\\U0002b73f\\U0002b81e\\U0002cea2-\\U0002cead\\U000323b0-\\U00033479\\U0003d000-\\U0003fc3f"
)

#: All of them are from here on; the search for this range is many times faster than for the list.
_LATE = re.compile("[\u0558-\U0010ffff]")

_CONTRACT = """
WITH RECURSIVE step(word, pos, id, done) AS (
  SELECT word, pos, id, false FROM bytes_of_words
  UNION ALL (
    WITH neighbours AS (  -- one order of all rows; the neighbour must be of the same word
      SELECT word, pos, id, CASE WHEN lead(word) OVER w = word THEN lead(id) OVER w END AS next_id,
             CASE WHEN lag(word) OVER w = word THEN lag(pos) OVER w END AS before
      FROM step WHERE NOT done WINDOW w AS (ORDER BY word, pos)),
    ranked AS (
      SELECT n.*, m.id AS merged FROM neighbours n LEFT JOIN merges m ON m.l = n.id AND m.r = n.next_id),
    best AS (  -- smallest rank first, then leftmost; none: the word is done
      SELECT word, min(merged::BIGINT * 65536 + pos) % 65536 AS spot FROM ranked GROUP BY word)
    SELECT word, pos, CASE WHEN pos = spot THEN merged ELSE id END, spot IS NULL
    FROM ranked JOIN best USING (word) WHERE spot IS NULL OR before IS DISTINCT FROM spot))
SELECT word, pos, id FROM step WHERE done ORDER BY word, pos
"""
_DECODE = """
SELECT row, array_to_string(list(digits ORDER BY pos), '') AS bytes
FROM id_rows LEFT JOIN vocabulary USING (id) GROUP BY row ORDER BY row
"""


class Coder:
    def __init__(self, vocabulary: bytes, pattern: str):
        import regex

        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.newer = regex.compile(f"[{_NEWER}]")
        self.usual = regex.compile(pattern)
        older = [(f"\\p{{{c}}}", f"[\\p{{{c}}}--[{_NEWER}]]") for c in "LN"]
        for plain, without in older:
            pattern = pattern.replace(plain, without)
        self.careful = regex.compile(pattern, regex.V1)
        self.written = [str(i) for i in range(max(self.tokens) + 1)]
        self.forget()
        merges = [
            (a, b, i) for token, i in self.ranks.items() for k in range(1, len(token))
            if (a := self.ranks.get(token[:k])) is not None and (b := self.ranks.get(token[k:])) is not None
        ]
        self.merges = {n: np.array(c, np.int32) for n, c in zip(("l", "r", "id"), zip(*merges, strict=True), strict=True)}
        self._db = None

    @property
    def db(self):
        """The database, with the merge table and the vocabulary; it is there from its first use to the task's end."""
        import duckdb

        if self._db is None:
            self._db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
            self._load("merges", self.merges)
            self._load("vocabulary", {"id": np.array(list(self.tokens), np.int32), "digits": [t.hex() for t in self.tokens.values()]})
        return self._db

    def rest(self) -> None:
        """At the end of a task: all goes but the vocabulary and the remembered words."""
        if self._db is not None:
            self._db.close()
            self._db = None
        give_back()

    def _load(self, name: str, columns: dict) -> None:
        self.db.register("_given", pa.table({k: pa.array(v) for k, v in columns.items()}))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM _given")
        self.db.unregister("_given")

    def pattern(self, text: str):
        """The pattern as the tokenizer's library reads it."""
        newer = not text.isascii() and _LATE.search(text) and self.newer.search(text)
        return self.careful if newer else self.usual

    # -- words ---------------------------------------------------------------------------------
    def contract(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, by the recursive query."""
        sizes = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        pos = (np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        self._load("bytes_of_words", {"word": word, "pos": pos, "id": self.single[np.frombuffer(b"".join(words), np.uint8)]})
        out = self.db.execute(_CONTRACT).fetchnumpy()
        return np.split(np.asarray(out["id"]), np.searchsorted(np.asarray(out["word"]), np.arange(1, len(words))))

    def contract_long(self, word: bytes) -> list[int]:
        """The same rule for one long word: pairs wait in a heap by (rank, position)."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        parts: list[bytes | None] = [bytes([b]) for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        waiting: list[tuple[int, int, bytes]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(ids):
                both = parts[i] + parts[after[i]]
                if (rank := self.ranks.get(both)) is not None:
                    heapq.heappush(waiting, (rank, i, both))

        for i in range(len(ids)):
            offer(i)
        while waiting:
            rank, i, both = heapq.heappop(waiting)
            if parts[i] is None or after[i] >= len(ids) or parts[i] + parts[after[i]] != both:
                continue  # the pair has changed meanwhile
            gone = after[i]
            ids[i], parts[i], parts[gone] = rank, both, None
            after[i] = after[gone]
            if after[i] < len(ids):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [x for x, p in zip(ids, parts, strict=True) if p is not None]

    def decode(self, rows: list[Iterable[int]]) -> list[bytes]:
        """The bytes of each list of ids, by the ordered aggregate."""
        flat = [np.asarray(r, np.int32) for r in rows]
        sizes = np.array([len(r) for r in flat])
        row = np.repeat(np.arange(len(flat), dtype=np.int32), sizes)
        pos = (np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        ids = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        if unknown := set(ids.tolist()) - self.tokens.keys():
            raise ValueError(f"ids that the vocabulary lacks: {sorted(unknown)[:5]}")
        self._load("id_rows", {"row": row, "pos": pos, "id": ids})
        out = [b""] * len(flat)
        for r, text in self.db.execute(_DECODE).fetchall():
            out[r] = bytes.fromhex(text)
        return out

    # -- remembered words ----------------------------------------------------------------------
    def forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.begin, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.byte, self.bytes = np.zeros(1, np.int64), np.zeros(0, np.uint8)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where each of these different words stands among those remembered; new ones are encoded and decoded first."""
        size = self.words.nbytes + self.ids.nbytes + self.bytes.nbytes + self.begin.nbytes * 2
        if len(self.words) > REMEMBERED or size > REMEMBERED_BYTES:
            self.forget()
        found = pc.index_in(words, value_set=self.words)
        missing = found.is_null()
        out = found.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        out[missing.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(found.null_count)
        fresh = words.filter(missing)
        for at in range(0, len(fresh), QUERY_WORDS):
            raw = [w.encode() for w in fresh.slice(at, QUERY_WORDS).to_pylist()]
            ids: list = [[self.ranks[w]] if w in self.ranks else None for w in raw]
            todo = [i for i, w in enumerate(raw) if ids[i] is None and len(w) <= LONG]
            for i, own in zip(todo, self.contract([raw[i] for i in todo]) if todo else [], strict=True):
                ids[i] = own
            ids = [np.asarray(self.contract_long(w) if x is None else x, np.int32) for x, w in zip(ids, raw, strict=True)]
            decoded = self.decode(ids)
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum([len(x) for x in ids])])
            self.byte = np.concatenate([self.byte, self.byte[-1] + np.cumsum([len(b) for b in decoded])])
            self.ids = np.concatenate([self.ids, *ids])
            self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(decoded), np.uint8)])
        self.words = pa.concat_arrays([self.words, fresh])
        return out

    # -- texts ---------------------------------------------------------------------------------
    def stretches(self, column: list[str]) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
        """(texts, places of their words, number of words of each) for all texts of a batch, in order."""
        if sum(map(len, column)) <= 2 * BATCH_BYTES:
            found = [self.pattern(t).findall(t) for t in column]
            yield range(len(column)), *self._placed(list(chain.from_iterable(found)), [len(x) for x in found])
            return
        for i, text in enumerate(column):
            matches = (m[0] for m in self.pattern(text).finditer(text))
            while words := list(islice(matches, STRETCH)):
                yield range(i, i + 1), *self._placed(words, [len(words)])

    def _placed(self, words: list[str], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        known = pa.array(words, pa.large_string()).dictionary_encode()
        return self.places(known.dictionary)[known.indices.to_numpy(zero_copy_only=False)], np.array(counts, np.int64)

    def _ids(self, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _gathered(self.ids, self.begin, places, counts)

    def encode(self, column: list[str]) -> list[np.ndarray]:
        parts: list[list[np.ndarray]] = [[] for _ in column]
        for rows, places, counts in self.stretches(column):
            ids, ends = self._ids(places, counts)
            for i, own in zip(rows, np.split(ids, ends[1:-1]), strict=True):
                parts[i].append(own)
        return [np.concatenate(p) if p else np.zeros(0, np.int32) for p in parts]

    def digests(self, column: list[str]) -> list[tuple[int, str, str]]:
        """Tokens, digest of the ids as text, digest of the decoded bytes."""
        totals, ids, decoded = [0] * len(column), [hashlib.sha256() for _ in column], [hashlib.sha256() for _ in column]
        for rows, places, counts in self.stretches(column):
            flat, ends = self._ids(places, counts)
            raw, byte_ends = _gathered(self.bytes, self.byte, places, counts)
            raw = memoryview(raw)
            written = [self.written[x] for x in flat.tolist()]
            for k, i in enumerate(rows):
                if counts[k]:
                    own = written[ends[k] : ends[k + 1]]
                    ids[i].update((" " * bool(totals[i]) + " ".join(own)).encode())
                    decoded[i].update(raw[byte_ends[k] : byte_ends[k + 1]])
                    totals[i] += len(own)
        return [(n, a.hexdigest(), b.hexdigest()) for n, a, b in zip(totals, ids, decoded, strict=True)]


def _gathered(values: np.ndarray, begin: np.ndarray, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the words at ``places`` one after another, and where each text's begin (and the last ends)."""
    size = np.diff(begin)[places] if len(places) else np.zeros(0, np.int64)
    done = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat((begin[places] - done[:-1]).astype(np.int32), size)
    at += np.arange(done[-1], dtype=np.int32)
    return values[at], done[np.concatenate([[0], np.cumsum(counts)])]


@lru_cache(maxsize=1)
def coder(vocabulary: bytes, pattern: str) -> Coder:
    return Coder(vocabulary, pattern)


def _kept(batch: pa.RecordBatch, *but: str) -> tuple[list[pa.Array], list[str]]:
    at = [i for i, n in enumerate(batch.schema.names) if n not in but]
    return [batch.column(i) for i in at], [batch.schema.names[i] for i in at]


def _schema(rows: DataFrame, *but: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in but)


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, *keep: str, text_col: str = "text") -> DataFrame:
    """The kept columns, n_tokens and ids."""
    vocabulary = Path(vocabulary_path).read_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, BATCH_BYTES):
            ids = coder(vocabulary, pattern).encode(batch.column("text").to_pylist())
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            arrays, names = _kept(batch, "text")
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.diff(ends), pa.int64()), column], [*names, "n_tokens", "ids"])
        coder(vocabulary, pattern).rest()

    rows = texts(docs, *keep, text=text_col)
    return rows.mapInArrow(run, f"{_schema(rows, 'text')}, n_tokens bigint, ids array<int>")


def decode(rows: DataFrame, vocabulary_path: str, pattern: str, *keep: str, ids_col: str = "ids") -> DataFrame:
    """The kept columns and the bytes of the ids, as ``decoded``."""
    vocabulary = Path(vocabulary_path).read_bytes()
    ready = rows.select(*keep, F.filter(F.coalesce(F.col(ids_col), F.array().cast("array<int>")), lambda x: x.isNotNull()).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                arrays, names = _kept(part, "ids")
                decoded = coder(vocabulary, pattern).decode(part.column("ids").to_pylist())
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(decoded, pa.binary())], [*names, "decoded"])
        coder(vocabulary, pattern).rest()

    return ready.mapInArrow(run, f"{_schema(ready, 'ids')}, decoded binary")


def encode_digests(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256 (ids joined by a blank), decoded_sha256, n_bytes."""
    vocabulary = Path(vocabulary_path).read_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, BATCH_BYTES):
            n, ids, decoded = zip(*coder(vocabulary, pattern).digests(batch.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded), pa.array(lengths(batch.column("text")))],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"])
        coder(vocabulary, pattern).rest()

    rows = texts(docs, id_col, text=text_col)
    return rows.mapInArrow(run, f"{_schema(rows, 'text')}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint")
