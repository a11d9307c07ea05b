"""Personal data: patterns, and terms that give a protected entity away.

Patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers. Each distinct
value is a protected entity e. Hiding the value is not enough where another word of the document stands
for it as well, so the corpus is asked how strongly each such term t reveals e:

    information of e        IC(e)    = log2(N / df(e))
    shared with t           PMI(e,t) = log2(N * share(e, t) / df(t))
    disclosure                       = PMI(e,t) / IC(e)   (1: t occurs only with e, wherever e does)

All are counted in documents, of equal texts one: N, df(e) and df(t) in the corpus, share(e, t) = k / m in those of
e's m documents that are no near copies of one another (four min-hashes of five-word shingles all
differ), k of which hold t. Every term of a document that holds an entity is a candidate. That k of m documents
hold t by chance has probability exp(-m KL(k/m || df(t)/N)) at most; times the pairs tried (entities
times terms) this must be below 1. So two documents are enough for rare terms; one document shows no
term to recur, and copies of it prove nothing.
A term whose disclosure reaches ``generalise`` is replaced by its shape, from ``remove`` on it is
taken out: everywhere in the documents that hold the entity, and nowhere else.

Scale: texts without digit or @ never leave Arrow. The first pass stores a row per document, and the texts
of those with an entity. Pairs are counted by partial aggregates; only entities in two independent
documents can have terms and are paired. Candidates that their counts in these documents don't rule out
are counted in all documents, behind a filter of fixed size: a task adds up the texts it reads, but for those that may
repeat, of which one each is counted in a second step. Nothing is gathered by entity; the entities
of a document are held with it. 64-bit hashes stand for texts and shingles in counts.

Null and empty texts have no spans. Repeated rows each get their spans; equal texts are counted once.
Further columns are dropped; an empty table gives an empty result. Offsets are code points.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter.llm.bitfilter import build, passes
from deskmeter.llm.common import lean, slices, store, texts

KINDS = ("email", "ip", "card", "phone")
ADDED = ("generalise", "remove")
GENERALISE, REMOVE = 0.75, 0.9
HELD_TERMS = 500_000

# fixed values: the patterns of the contract
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TERM = re.compile(r"[^\W\d_]{3,}")
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)
_SHINGLE = 5


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the four patterns, sorted."""
    spans, taken = [], 0
    if "@" in text:
        for m in _AT.finditer(text):
            # the local part is the run of its characters before the @: the leftmost start
            start = m.start()
            while start > taken and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                spans.append((start, 0, taken := m.end()))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(KINDS + ADDED)[k]}:{s}:{e}" for s, k, e in spans)


def entities(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """The distinct protected values, as digests."""
    found = set()
    for start, kind, end in spans:
        value = text[start:end].lower() if kind == 0 else text[start:end] if kind == 1 else _digits(text[start:end])
        found.add(hashlib.sha256(f"{kind}:{value}".encode()).hexdigest()[:16])
    return sorted(found)


def sketch(text: str) -> list[int]:
    """Min-hashes of the shingles of words, one per multiplier."""
    words = text.lower().split()
    parts = [" ".join(words[i : i + _SHINGLE]) for i in range(max(1, len(words) - _SHINGLE + 1))]
    hashes = np.array([int.from_bytes(hashlib.blake2b(p.encode(), digest_size=8).digest(), "little") for p in parts], np.uint64)
    return [int(v) for v in (hashes[:, None] * _MIX).min(axis=0).view(np.int64)]


def _term_places(text: str, base: str) -> dict[str, list[tuple[int, int]]]:
    """term -> (start, end) of its occurrences outside of the spans in ``base``."""
    inside, out = np.zeros(len(text), bool), {}
    for _, s, e in (x.split(":") for x in base.split(",")):
        inside[int(s) : int(e)] = True
    for m in _TERM.finditer(text):
        if not inside[m.start() : m.end()].any():
            out.setdefault(m[0].lower(), []).append((m.start(), m.end()))
    return out


_FOUND = (
    "digest bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, base string, "
    "entities array<string>, sketch array<bigint>, text string"
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = hashlib.sha256(b"").hexdigest()
    for batch in slices(batches, 8 << 20):
        n, column = batch.num_rows, batch.column("text")
        counts = [[0] * n for _ in KINDS]
        digest, base, held, marks, kept = [empty] * n, [""] * n, [[] for _ in range(n)], [[] for _ in range(n)], [None] * n
        maybe = pc.indices_nonzero(pc.match_substring_regex(column, "[0-9@]"))
        for i, text in zip(maybe.to_pylist(), column.take(maybe).to_pylist(), strict=True):
            if spans := base_spans(text):
                for _, k, _ in spans:
                    counts[k][i] += 1
                base[i] = written(spans)
                digest[i] = hashlib.sha256(base[i].encode()).hexdigest()
                held[i], marks[i], kept[i] = entities(text, spans), sketch(text), text
        arrays = [batch.column("id"), batch.column("digest"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest), pa.array(base)]
        arrays += [pa.array(held, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.int64())), pa.array(kept, pa.string())]
        names = ["id", "digest", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "entities", "sketch", "text"]
        yield pa.RecordBatch.from_arrays(arrays, names)


_PLACES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1 << 20):
        at, terms, places = [], [], []
        for i, (text, base) in enumerate(zip(batch.column("text").to_pylist(), batch.column("base").to_pylist(), strict=True)):
            for term, spans in _term_places(text, base).items():
                at.append(i)
                terms.append(term)
                places.append([{"start": s, "end": e} for s, e in spans])
        rows = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid").take(rows), batch.column("chosen").take(rows), pa.array(terms, pa.string()), pa.array(places, _PLACES)],
            ["rid", "chosen", "term", "places"])


def term_places(found: DataFrame, chosen: DataFrame) -> DataFrame:
    """(rid, chosen, term, places) of all terms of the documents in ``chosen`` (rid, entity), their entities as a list."""
    lists = chosen.groupBy("rid").agg(F.collect_list("entity").alias("chosen"))
    rows = found.where(F.col("text").isNotNull()).select("rid", "text", "base").join(lists, "rid")
    return rows.mapInArrow(_places, "rid bigint, chosen array<string>, term string, places array<struct<start:int,end:int>>")


_COUNTS = pa.schema([("digest", pa.int64()), ("text", pa.string()), ("term", pa.string()), ("n", pa.int64())])


def _words(passing, repeated=None):
    """(digest, text, term, n): how many texts hold each term that passes the filter, counted by task.

    Texts that may repeat are handed on as they are, for each to be counted once.
    """

    def counts(found: Counter) -> pa.RecordBatch:
        n = len(found)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
            schema=_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        known: dict[str, bool] = {}
        found: Counter = Counter()
        for batch in slices(batches, 4 << 20):
            if repeated:
                again = passes(repeated.value, batch.column("digest").to_numpy().view(np.uint64))
                copies = batch.filter(pa.array(again))
                if copies.num_rows:
                    nothing = pa.nulls(copies.num_rows)
                    yield pa.RecordBatch.from_arrays(
                        [copies.column("digest"), copies.column("text"), nothing.cast(pa.string()), nothing.cast(pa.int64())], schema=_COUNTS)
                batch = batch.filter(pa.array(~again))
            lists = [{w.lower() for w in set(_TERM.findall(t))} for t in batch.column("text").to_pylist()]
            if len(known) > HELD_TERMS:
                known.clear()
            if new := list(set().union(*lists) - known.keys()):
                crc = np.array([zlib.crc32(w.encode()) for w in new], np.uint64)
                known.update(zip(new, passes(passing.value, crc).tolist(), strict=True))
            found.update(w for words in lists for w in words if known[w])
            if len(found) > HELD_TERMS:  # the next ones are added up by Spark
                yield counts(found)
                found.clear()
        if found:
            yield counts(found)

    return run


def independent(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity, rid) of documents that are no near copies of one another, and (entity, df_entity) in distinct texts."""
    held = found.where(F.size("entities") > 0)
    first = held.groupBy("digest").agg(F.min("rid").alias("rid")).select("rid")
    marks = store(held.select("rid", "entities", "sketch").join(first, "rid", "left_semi"))
    single = marks.select("rid", "sketch", F.explode("entities").alias("entity"))
    least = single.select("rid", "entity", F.posexplode("sketch")).groupBy("entity", "pos", "col").agg(F.min("rid").alias("rid"))
    alone = least.groupBy("entity", "rid").count().where(F.col("count") == len(_MIX)).select("entity", "rid")
    return store(alone), single.groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity"))


def disclosure(found: DataFrame, rows: DataFrame, least: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) of at least ``least``, for terms that recur with an entity beyond chance."""
    alone, counted = independent(found)
    recurring = store(
        alone.groupBy("entity").agg(F.count(F.lit(1)).alias("m")).where("m > 1").join(counted, "entity"))
    seen = term_places(found, alone.join(recurring.select("entity"), "entity", "left_semi"))
    # a row without an entity counts the term's documents
    seen = store(
        seen.select(F.explode(F.concat("chosen", F.array(F.lit(None).cast("string")))).alias("entity"), "term")
        .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("k")))
    beside = seen.where(F.col("entity").isNull()).select("term", F.col("k").alias("df_term"))
    tried = max(2, recurring.count() * beside.count())
    copies = store(found.groupBy("digest").count())
    n = float(copies.count())

    def rated(rows: DataFrame) -> DataFrame:
        share, chance = F.col("k") / F.col("m"), F.col("df_term") / F.lit(n)
        rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - chance))).otherwise(F.lit(0.0))
        # above the share, chance explains the pair
        proof = F.when(chance < share, F.col("m") * (share * F.log(share / chance) + rest)).otherwise(F.lit(0.0))
        known = F.log2(F.lit(n) / F.col("df_entity"))
        told = F.when(known > 0, F.least(F.log2(share / chance) / known, F.lit(1.0))).otherwise(F.lit(0.0))
        return rows.withColumn("disclosure", told).where((told >= least) & (proof > F.lit(float(np.log(tried)))))

    # a term has at least these documents, and more of them only lower both figures: common words go here
    pairs = seen.where(F.col("entity").isNotNull() & (F.col("k") > 1)).join(recurring, "entity")
    hopeful = store(rated(pairs.join(beside, "term")).drop("df_term", "disclosure"))
    if hopeful.isEmpty():
        return hopeful.select("entity", "term", F.lit(0.0).alias("disclosure"))
    keys = hopeful.select(F.crc32(F.col("term").cast("binary")).alias("key")).distinct()
    send = rows.sparkSession.sparkContext.broadcast
    passing, repeated = send(build(keys)), send(build(copies.where("count > 1").select(F.col("digest").alias("key"))))
    shape = "digest bigint, text string, term string, n bigint"
    words = store(rows.select("text", F.xxhash64("text").alias("digest")).mapInArrow(_words(passing, repeated), shape))
    # of texts that may repeat, one each
    once = words.where("text is not null").groupBy("digest").agg(F.first("text").alias("text")).select("text").mapInArrow(_words(passing), shape)
    terms = words.where("term is not null").select("term", "n").unionByName(once.select("term", "n")).groupBy("term").agg(F.sum("n").alias("df_term"))
    return store(rated(hopeful.join(terms, "term")).select("entity", "term", "disclosure"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """One row per document: id, counts by kind, base_sha256, spans, n_added."""
    rows = texts(docs, F.col(id_col).alias("id"), text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.withColumn("digest", F.xxhash64("text")).mapInArrow(_find, f"id {kind}, {_FOUND}")
    found = store(found.withColumn("rid", F.monotonically_increasing_id()))
    strong = disclosure(found, rows, generalise)
    holding = found.select("rid", F.explode("entities").alias("entity"))
    near = term_places(found, holding.join(strong.select("entity").distinct(), "entity", "left_semi"))
    action = F.when(F.col("disclosure") >= remove, F.lit(ADDED[1])).otherwise(F.lit(ADDED[0]))
    added = (
        near.select("rid", F.explode("chosen").alias("entity"), "term", "places").join(strong, ["entity", "term"])
        .select("rid", "disclosure", F.inline("places"))
        .groupBy("rid", "start", "end").agg(F.max("disclosure").alias("disclosure"))
        .groupBy("rid").agg(F.collect_list(F.struct("start", F.lit(len(KINDS) + 1).alias("k"), action.alias("kind"), "end")).alias("added"))
    )
    base = F.transform(
        F.filter(F.split("base", ","), lambda s: s != ""),
        lambda s: F.struct(
            F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("start"),
            F.array_position(F.lit(list(KINDS)), F.split_part(s, F.lit(":"), F.lit(1))).cast("int").alias("k"),
            F.split_part(s, F.lit(":"), F.lit(1)).alias("kind"),
            F.split_part(s, F.lit(":"), F.lit(3)).cast("int").alias("end"),
        ),
    )
    every = F.array_sort(F.concat(base, F.coalesce("added", F.filter(base, lambda s: F.lit(False)))))
    text = F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return found.join(added, "rid", "left").select(
        F.col("id").alias(id_col), *[f"n_{k}" for k in KINDS], "base_sha256",
        F.array_join(text, ",").alias("spans"), F.coalesce(F.size("added"), F.lit(0)).cast("bigint").alias("n_added"),
    )


def sanitise(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of ``find_pii`` replaced: ``[email]``, a shape such as ``Xxxx``, or nothing."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8 << 20, "_text"):
            out = []
            for text, spans in zip(batch.column("_text").to_pylist(), batch.column("_spans").to_pylist(), strict=True):
                parts, at = [], 0
                for kind, start, end in (s.split(":") for s in (spans or "").split(",") if s):
                    start, end = int(start), int(end)
                    if start >= at:
                        word = text[start:end]
                        shape = "".join("X" if c.isupper() else "x" for c in word)
                        parts += [text[at:start], {"generalise": shape, "remove": ""}.get(kind, f"[{kind}]")]
                    at = max(at, end)
                out.append("".join([*parts, text[at:]]))
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in ("_text", "_spans")]
            names = [n for n in batch.schema.names if n not in ("_text", "_spans")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.string())], [*names, text_col])

    spans = found.select(F.col(id_col).alias("_id"), F.col("spans").alias("_spans")).dropDuplicates(["_id"])
    both = docs.join(spans, docs[id_col].eqNullSafe(F.col("_id")), "left").drop("_id")
    ready = both.withColumn("_text", F.coalesce(F.col(text_col).cast("string"), F.lit(""))).drop(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema if f.name not in ("_text", "_spans"))
    return ready.mapInArrow(clean, f"{schema}, `{text_col}` string").select(*docs.columns)
