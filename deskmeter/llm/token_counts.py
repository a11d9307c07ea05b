"""Token counts of a piece model, by batch encoding in Arrow functions that return lengths only.

A batch is a run of texts of about ``batch_bytes`` bytes, so that short and long texts cost a
task alike. Texts are split where no piece can reach across: before a blank that follows a
non-blank (no piece of the model holds a blank behind anything else; this is checked when the
model is loaded). Each part is encoded by itself, the model's own leading blank standing for the
blank at which the text was split, and equal parts of a batch are encoded once. Counts are those
of the library over the whole text.

Memory: a task holds one batch and its distinct parts. A single longer text is a batch of its
own. No exchange takes place, and a lost task is simply run again.

Null texts count as empty, with 0 bytes and 0 tokens. Repeated rows are counted one by one,
further columns are dropped, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from deskmeter.llm.common import lengths, slices, texts

BATCH_BYTES = 4 << 20
BLANK = "▁"
_SAFE = re.compile("(?<=[^ ]) ")


@lru_cache(maxsize=2)
def _processor(model: bytes):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    for i in range(len(processor)):
        if BLANK in processor.id_to_piece(i).lstrip(BLANK):
            raise ValueError("a piece reaches across a blank: texts of this model can't be split there")
    if [len(processor.encode(x)) for x in ("a", " a", "a ")] != [1, 2, 2]:
        raise ValueError("the model changes blanks at the ends of a text")
    return processor


def _parts(column: pa.Array) -> pa.ListArray:
    """The safe parts of each text. Parts behind the first lack the blank they begin with."""
    plain = pc.replace_substring(column, BLANK, " ")
    odd = pc.or_(pc.match_substring(plain, "  "), pc.or_(pc.starts_with(plain, " "), pc.ends_with(plain, " ")))
    if not pc.any(odd).as_py():
        return pc.split_pattern(plain, " ")
    # blanks in a row stay together with what follows them
    return pa.array([_SAFE.split(t) for t in plain.to_pylist()], pa.list_(pa.string()))


def count_tokens(column: pa.Array, model: bytes) -> np.ndarray:
    """Tokens of each text of an Arrow string column without nulls."""
    processor = _processor(model)
    parts = _parts(column)
    words = parts.flatten().dictionary_encode()
    each = np.array([len(ids) for ids in processor.encode(words.dictionary.to_pylist(), num_threads=1)], np.int64)
    each[lengths(words.dictionary) == 0] = 1  # a lone blank
    sums = np.concatenate([[0], np.cumsum(each[words.indices.to_numpy(zero_copy_only=False)])])
    ends = np.cumsum(np.concatenate([[0], pc.list_value_length(parts).to_numpy(zero_copy_only=False)]))
    tokens = np.diff(sums[ends])
    tokens[lengths(column) == 0] = 0
    return tokens


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    model = Path(model_path).read_bytes()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, batch_bytes):
            column = batch.column("text")
            tokens = count_tokens(column, model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths(column)), pa.array(tokens), pa.array(tokens > limit)],
                [id_col, "n_bytes", "n_tokens", "over_limit"])

    rows = texts(docs, id_col, text=text_col)
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(count, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
