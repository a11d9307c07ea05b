"""Token ids in binary files: one array of ids, and the documents' boundaries in Elias-Fano code.

A file holds the ids of consecutive documents, as 16-bit integers where the vocabulary allows it (32-bit
otherwise), behind one another. Where documents begin is a rising sequence; it is kept as Elias-Fano code:
the low bits of every boundary packed side by side, the high bits in unary, and the places of every
256th boundary in the unary part. ``select`` finds boundary i from these without a table of 64-bit offsets:
about 2 + log2(mean length) bits a document. The documents' ids, which rise as well, are kept in the same code.

File: ``TOKENSEF``, the ids, the two codes (low bits, high bits, 32-bit samples each), then a footer
of twelve little-endian 64-bit integers and ``TOKENSEF`` again, so that it can be written in one go.

Order and faults: documents are dealt out by ranges of (id, hash of the text) and sorted, so that file after file holds
them by ascending id; rows of one id are ordered by text and may be in several files. A task
writes files of its own names and reports them; only reported files are in the manifest, so what a lost
task left behind is never read. Memory: a batch of texts, a bounded memory of words (about 20 MB), and 16 bytes for each document of
the file at hand, whose number is bounded, as the number of ids is.

Texts are cut where the tokenizer's own pattern always cuts (white space, and between ASCII letters, digits
and other signs, apostrophes aside), ASCII letters are put in lower case, which the tokenizer does as well, and the
library encodes every different part once in a task. Texts that hold a special token's string go to the library
whole. Folders are URIs that Arrow's file systems know (file, hdfs, s3, gs) or plain paths.

Nulls: a null text is empty, an empty text has the end id alone; null ids come first. Repeated rows are kept as
they are. Ids are integers. An empty table writes no files. Further columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskmeter.llm.common import lean, slices, texts, utf8

MAGIC = b"TOKENSEF"
FOOTER = struct.Struct("<12q")
EVERY = 256
BATCH_BYTES = 3 << 19
MEMORY_WORDS = 400_000
WORDS_AT_ONCE = 2048
IDS_PER_FILE = 1 << 26
DOCS_PER_FILE = 1 << 22
DOCS_PER_READ = 1 << 13

# kinds of ASCII bytes: 0 white space, 1 letter, 2 digit, 3 other; 4 may belong to either side
_KIND = np.full(256, 3, np.uint8)
_KIND[[*b"\t\n\v\f\r "]] = 0
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[*range(48, 58)]] = 2
_KIND[[39, *range(128, 256)]] = 4
# Words of ASCII and Latin-1 letters: composed, one letter each, and lower-cased alike everywhere. The model reads a byte above
# 160 as the character of that number (but 173), and those from 127 to 160 as characters from 289 on.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_AS_BYTES = {c: "".join(chr(b if b > 160 and b != 173 else 323 if b == 173 else 162 + b) for b in chr(c).encode()) for c in range(0xC0, 0x100)}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class EliasFano:
    """A rising sequence of ``n`` integers from 0 to ``top``."""

    def __init__(self, n: int, top: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.top, self.samples = n, top, samples
        self.bits = self.low_bits(n, top)
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)

    @staticmethod
    def low_bits(n: int, top: int) -> int:
        return max(0, (top // n).bit_length() - 1) if n else 0

    @classmethod
    def sizes(cls, n: int, top: int) -> tuple[int, int, int]:
        """Bytes of the low bits, of the high bits and of the samples."""
        bits = cls.low_bits(n, top)
        return (n * bits + 7) // 8, (n + (top >> bits) + 8) // 8, 4 * ((n + EVERY - 1) // EVERY)

    @classmethod
    def of(cls, values: np.ndarray, top: int) -> EliasFano:
        values, n = values.astype(np.uint64), len(values)
        bits = cls.low_bits(n, top)
        low = ((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        high = np.zeros(n + (top >> bits) + 1, np.uint8)
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high[places] = 1
        packed = [np.packbits(x, bitorder="little").tobytes() for x in (low.ravel(), high)]
        return cls(n, top, *packed, places[::EVERY].astype("<u4"))

    def tobytes(self) -> bytes:
        return self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def frombytes(cls, data: bytes, n: int, top: int) -> EliasFano:
        a, b, c = cls.sizes(n, top)
        return cls(n, top, data[:a], data[a : a + b], np.frombuffer(data[a + b : a + b + c], "<u4"))

    def select(self, i: int, count: int = 1) -> np.ndarray:
        """Places of ``count`` set high bits from the i-th on."""
        at, skip = int(self.samples[i // EVERY]), i % EVERY
        out, have, byte = [], 0, at // 8
        while have < skip + count:
            step = max(64, (skip + count - have) // 2)
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + step], bitorder="little")) + byte * 8
            ones = ones[ones >= at]
            out.append(ones)
            have, byte = have + len(ones), byte + step
            if byte > len(self.high) and have < skip + count:
                raise IndexError(i + count)
        return np.concatenate(out)[skip : skip + count]

    def get(self, i: int, count: int = 1) -> np.ndarray:
        """``count`` values from the i-th on, as unsigned 64-bit integers."""
        if not count:
            return np.zeros(0, np.uint64)
        high = (self.select(i, count) - np.arange(i, i + count)).astype(np.uint64) << np.uint64(self.bits)
        first = i * self.bits
        cut = np.unpackbits(self.low[first // 8 : ((i + count) * self.bits + 7) // 8], bitorder="little")
        cut = cut[first % 8 : first % 8 + count * self.bits].reshape(count, self.bits).astype(np.uint64)
        return high | (cut << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def find(self, value: int) -> int:
        """The first i whose value is not below ``value``."""
        begin, end = 0, self.n
        while begin < end:
            middle = (begin + end) // 2
            if int(self.get(middle)[0]) < value:
                begin = middle + 1
            else:
                end = middle
        return begin


def place(uri: str):
    """The Arrow file system and path of a URI."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


@lru_cache(maxsize=1)
def _tokenizer(vocabulary: bytes):
    from tokenizers import Tokenizer

    return Tokenizer.from_buffer(vocabulary)


class Encoder:
    """Ids of a batch of texts; every different part of them is encoded once."""

    def __init__(self, vocabulary: bytes, memory: int = MEMORY_WORDS):
        self.tokenizer = _tokenizer(vocabulary)
        self.memory, self.specials = memory, [t["content"] for t in json.loads(vocabulary)["added_tokens"]]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.forget()

    def forget(self) -> None:
        self.words = pa.array([], pa.large_binary())
        self.begin, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _encoded(self, words: list[str]) -> list[list[int]]:
        """The ids of each word. Words of plain letters go to the model directly, spelled as the library spells them for it."""
        plain = [_LETTERS.fullmatch(w) is not None for w in words]
        rest = iter(self.tokenizer.encode_batch_fast(
            [w for w, is_plain in zip(words, plain, strict=True) if not is_plain], add_special_tokens=False))
        tokenize = self.tokenizer.model.tokenize
        return [[t.id for t in tokenize(w if w.isascii() else w.lower().translate(_AS_BYTES))] if is_plain else next(rest).ids
                for w, is_plain in zip(words, plain, strict=True)]

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The place of each different word among those remembered; new ones are encoded first."""
        found = pc.index_in(words, value_set=self.words)
        if len(self.words) + found.null_count > self.memory:
            self.forget()
            found = pc.index_in(words, value_set=self.words)
        missing = found.is_null()
        if found.null_count:
            new, sizes, ids = words.filter(missing), array("q"), array("I")
            for i in range(0, len(new), WORDS_AT_ONCE):
                for own in self._encoded([w.decode() for w in new.slice(i, WORDS_AT_ONCE).to_pylist()]):
                    sizes.append(len(own))
                    ids.extend(own)
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.frombuffer(sizes, np.int64))])
            self.ids = np.concatenate([self.ids, np.frombuffer(ids, np.uint32)])
        places = found.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int32)
        places[missing.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(found.null_count)
        if found.null_count:
            self.words = pa.concat_arrays([self.words, new])
        return places

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and the number of each text's."""
        whole = np.zeros(len(column), bool)
        for special in self.specials:
            whole |= pc.match_substring(column, special).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_parts(column)
        out: list = [None] * len(column)
        for i in np.flatnonzero(whole):
            out[i] = np.array(self.tokenizer.encode(column[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
        rest = np.flatnonzero(~whole)
        ids, sizes = self._by_parts(column.take(pa.array(rest)))
        for i, part in zip(rest, np.split(ids, np.cumsum(sizes)[:-1]) if len(rest) else [], strict=True):
            out[i] = part
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def _by_parts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, ends = utf8(column)
        kind = _KIND[raw]
        cut = np.ones(len(raw), bool)
        # within a text a part goes on between bytes of one kind, and beside those that may belong to either
        cut[1:] = (kind[1:] == 0) | (kind[:-1] == 0) | ((kind[1:] != kind[:-1]) & (kind[1:] != 4) & (kind[:-1] != 4))
        cut[ends[ends < len(raw)]] = True
        ink = kind != 0
        begin = np.flatnonzero(cut[ink])
        data = _LOWER[raw[ink]]
        cut &= ink
        per_text = np.diff(np.searchsorted(np.flatnonzero(cut), ends))
        at = np.append(begin, len(data)).astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(at), pa.py_buffer(data)])
        parts = parts.dictionary_encode()
        number = self._numbers(parts.dictionary)[parts.indices.to_numpy(zero_copy_only=False)]
        size = np.diff(self.begin)[number] if len(number) else np.zeros(0, np.int64)
        done = np.concatenate([[0], np.cumsum(size)])
        from_ = np.repeat((self.begin[number] - done[:-1]).astype(np.int32), size)
        from_ += np.arange(done[-1], dtype=np.int32)
        return self.ids[from_], np.diff(done[np.concatenate([[0], np.cumsum(per_text)])])


class _Writer:
    """One file: ids are written as they come, the codes at the end."""

    def __init__(self, folder: str, name: str, width: int):
        files, path = place(folder)
        files.create_dir(path, recursive=True)
        self.name, self.width = name, width
        self.out = files.open_output_stream(f"{path}/{name}")
        self.out.write(MAGIC)
        self.sizes: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.docs = self.total = self.nulls = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray, doc_ids: pa.Array) -> None:
        self.out.write(np.ascontiguousarray(ids.astype(f"<u{self.width}")).data)
        self.nulls += doc_ids.null_count
        self.sizes.append(sizes)
        self.ids.append(doc_ids.drop_null().cast(pa.int64()).to_numpy())
        self.docs, self.total = self.docs + len(sizes), self.total + len(ids)

    def close(self) -> tuple[str, int, int]:
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(self.sizes))])
        known = np.concatenate(self.ids)
        first = int(known[0]) if len(known) else 0
        top = int(known[-1]) - first if len(known) else 0
        codes = [EliasFano.of(bounds, self.total), EliasFano.of(known.astype(np.uint64) - np.uint64(first % (1 << 64)), top)]
        for code in codes:
            self.out.write(code.tobytes())
        unsigned = top - (1 << 64) if top >= 1 << 63 else top
        self.out.write(FOOTER.pack(1, self.width, self.docs, self.total, self.nulls, first, unsigned, 0, 0, 0, 0, 0) + MAGIC)
        self.out.close()
        return self.name, self.docs, self.total


def write_tokens(docs: DataFrame, folder: str, vocabulary: bytes, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 ids_per_file: int = IDS_PER_FILE, docs_per_file: int = DOCS_PER_FILE, batch_bytes: int = BATCH_BYTES) -> None:
    """Write the files of ``docs`` and their manifest (a Parquet table) to ``folder``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        encoder, task, attempt = Encoder(vocabulary), TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        writer, part = None, 0

        def finished() -> pa.RecordBatch:
            name, n_docs, n_ids = writer.close()
            return pa.RecordBatch.from_pydict({"task": [task], "part": [part], "file": [name], "docs": [n_docs], "ids": [n_ids]},
                                              pa.schema([("task", pa.int64()), ("part", pa.int64()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

        for batch in slices(batches, batch_bytes):
            ids, sizes = encoder.encode(batch.column("text"))
            ends = np.cumsum(sizes)
            ids = np.insert(ids, ends, end_id)
            if writer and (writer.total + len(ids) > ids_per_file or writer.docs + len(sizes) > docs_per_file):
                yield finished()
                writer, part = None, part + 1
            writer = writer or _Writer(folder, f"{task:06d}-{part:05d}-{attempt}.tokens", encoder.width)
            writer.add(ids, sizes + 1, batch.column("id"))
        if writer:
            yield finished()

    rows = texts(docs, F.col(id_col).alias("id"), text=text_col)
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    ranged.mapInArrow(write, "task bigint, part bigint, file string, docs bigint, ids bigint").write.parquet(f"{folder}/manifest")


class TokenFile:
    """A file of token ids, open for reading: boundaries by ``select``, ids by ranges."""

    def __init__(self, folder: str, name: str):
        files, path = place(folder)
        self.source = files.open_input_file(f"{path}/{name}")
        size = self.source.size()
        tail = self.source.read_at(FOOTER.size + 8, size - FOOTER.size - 8)
        _, self.width, self.docs, self.total, self.nulls, self.first, top, *_ = FOOTER.unpack(tail[:-8])
        if tail[-8:] != MAGIC:
            raise ValueError(f"{name} is no file of token ids")
        at, known = 8 + self.total * self.width, self.docs - self.nulls
        codes = self.source.read_at(size - at - FOOTER.size - 8, at)
        after = sum(EliasFano.sizes(self.docs + 1, self.total))
        self.bounds = EliasFano.frombytes(codes[:after], self.docs + 1, self.total)
        self.known = EliasFano.frombytes(codes[after:], known, top % (1 << 64))

    def ids(self, begin: int, end: int) -> np.ndarray:
        raw = self.source.read_at((end - begin) * self.width, 8 + begin * self.width)
        return np.frombuffer(raw, f"<u{self.width}")

    def doc_ids(self, begin: int, end: int) -> pa.Array:
        """Ids of documents, null ones first."""
        nulls = max(0, min(end, self.nulls) - begin)
        count = end - begin - nulls
        known = self.known.get(max(begin - self.nulls, 0), count) + np.uint64(self.first % (1 << 64))
        return pa.concat_arrays([pa.nulls(nulls, pa.int64()), pa.array(known.astype(np.int64))])

    def document(self, doc_id: int) -> np.ndarray | None:
        """The ids of the first document of this id."""
        i = self.known.find(max(0, doc_id - self.first))
        if i == self.known.n or int(self.known.get(i)[0]) + self.first != doc_id:
            return None
        begin, end = self.bounds.get(i + self.nulls, 2).tolist()
        return self.ids(begin, end)

    def close(self) -> None:
        self.source.close()


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(file, docs, ids, start): the files in order, with the ids of all files before. A row per file."""
    rows = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("file", "docs", "ids", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))


def read_tokens(spark: SparkSession, folder: str, docs_per_read: int = DOCS_PER_READ, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids (32-bit little-endian integers).

    Files are read in stretches of documents, whose boundaries ``select`` gives.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(folder, row["file"])
                end = min(row["first"] + docs_per_read, file.docs)
                bounds = file.bounds.get(row["first"], end - row["first"] + 1).astype(np.int64)
                doc_ids, i = file.doc_ids(row["first"], end), 0
                while i < len(doc_ids):
                    j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + batch_bytes // 4, side="right")) - 1)
                    data = file.ids(int(bounds[i]), int(bounds[j])).astype("<u4")
                    at = ((bounds[i : j + 1] - bounds[i]) * 4).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids[i:j], pa.array(bounds[i:j] + row["start"]), pa.array(np.diff(bounds[i : j + 1])),
                         pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(at), pa.py_buffer(data)])],
                        ["doc_id", "start", "n_tokens", "ids"])
                    i = j
                file.close()

    reads = manifest(spark, folder).select(
        "file", "start", F.explode(F.sequence(F.lit(0), F.col("docs") - 1, F.lit(docs_per_read))).alias("first"))
    return reads.repartition("file", "first").mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
