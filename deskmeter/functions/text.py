"""Text scalars on whole strings, built from native expressions only."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# possessive runs never backtrack; a bare \w is ASCII-only in the JVM
WORD = r"[\p{L}\p{N}_]++"
LETTERS = r"\p{L}++"
UPPER = r"\p{IsUppercase}"


def fold_reference(text: str) -> str:
    """The folding rule itself: compatibility decomposition without combining marks."""
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(ch for ch in decomposed if not unicodedata.combining(ch))


@lru_cache(maxsize=16)
def _fold_rule(alphabet: frozenset[str]) -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Code points whose folded form matters when searching words over ``alphabet``.

    Derived from the Unicode database: one-to-one replacements and deletions go into a
    single ``translate``; ligatures and the like need a longer replacement.
    """
    source, target, removed, longer = [], [], [], []
    for code in range(128, sys.maxunicode + 1):
        ch = chr(code)
        if unicodedata.category(ch) in ("Cs", "Co", "Cn"):
            continue
        folded = fold_reference(ch)
        if folded == ch:
            continue
        if not folded:
            removed.append(ch)
        elif alphabet.intersection(folded):
            if len(folded) == 1:
                source.append(ch)
                target.append(folded)
            else:
                longer.append((ch, folded))
    return "".join(source + removed), "".join(target), tuple(longer)


def add_folded(df: DataFrame, column: str, terms: Iterable[str], name: str) -> DataFrame:
    """Lower-case and accent-fold ``column`` so that ``terms`` can be searched in it.

    Characters that cannot take part in any match are left as they are. The steps are
    separate projections, so each is computed once per row; pure ASCII text (as long in
    bytes as in characters) skips all of them.
    """
    source, target, longer = _fold_rule(frozenset("".join(terms)))
    folded = F.col(name)
    ascii_only = F.octet_length(folded) == F.length(folded)
    df = df.withColumn(name, F.lower(column))
    df = df.withColumn(name, F.when(ascii_only, folded).otherwise(F.translate(folded, source, target)))
    if not longer:
        return df
    rare = "".join(ch for ch, _ in longer)
    without = F.translate(folded, rare, "")
    table = F.create_map(*[F.lit(part) for pair in longer for part in pair])
    spelled_out = F.array_join(
        F.transform(F.split(folded, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""
    )
    plain = ascii_only | (F.length(without) == F.length(folded))
    return df.withColumn(name, F.when(plain, folded).otherwise(spelled_out))


def occurrences(text: Column, term: str) -> Column:
    """Non-overlapping substring count; also counts inside longer words. A search of bytes, without a pattern."""
    without = F.replace(text, F.lit(term), F.lit(""))
    return ((F.octet_length(text) - F.octet_length(without)) / F.lit(len(term.encode()))).cast("int")


def contains_any(text: Column, terms: Iterable[str]) -> Column:
    """1 when any term occurs."""
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(text, F.lit(term))
    return found.cast("int")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.lower(text), F.lit(WORD))


def letter_count(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, LETTERS, ""))


def upper_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(UPPER))
