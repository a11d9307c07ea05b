"""The contracts' queries of this package, and their SQL where there is one."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmeter.llm.bpe import encode_digests
from deskmeter.llm.common import WORD, crc_mod, table
from deskmeter.llm.exact_dedup import exact_groups
from deskmeter.llm.jaccard_join import Rule, near_copies
from deskmeter.llm.language_id import identify, training_sample
from deskmeter.llm.merkle import FIELDS, leaf_digest, manifest
from deskmeter.llm.mixing import plan
from deskmeter.llm.periodic_runs import longest, periodic_runs, run_digest
from deskmeter.llm.pii import find_pii
from deskmeter.llm.substring_dedup import repeats
from deskmeter.llm.token_counts import token_counts
from deskmeter.llm.token_files import read_tokens, write_tokens
from deskmeter.llm.topk_search import top_k
from deskmeter.llm.toxicity import fit_toxicity
from deskmeter.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op10_exact_dedup(spark, folder):
    return exact_groups(table(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


ORACLE["op10_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@query
def op9_mixing(spark, folder):
    return plan(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op9_mixing"] = """
WITH RECURSIVE rows AS MATERIALIZED (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents),
sizes AS MATERIALIZED (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM rows GROUP BY source),
level(round, level, capped) AS (
  SELECT 0, 0.0::DOUBLE, -1::BIGINT
  UNION ALL
  SELECT round + 1,
         (SELECT (sum(source_size) - sum(CASE WHEN weight * level > source_size * 3 THEN source_size * 3 ELSE 0 END))::DOUBLE
                 / sum(CASE WHEN weight * level > source_size * 3 THEN 0 ELSE weight END) FROM sizes),
         (SELECT count(*) FILTER (WHERE weight * level > source_size * 3) FROM sizes)
  FROM level
  WHERE capped <> (SELECT count(*) FILTER (WHERE weight * level > source_size * 3) FROM sizes)),
aims AS (
  SELECT source, source_size,
         least(weight * (SELECT level FROM level ORDER BY round DESC LIMIT 1), source_size * 3.0::DOUBLE) AS target,
         ('0x' || substr(md5('mix-1' || coalesce('/' || source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM sizes),
ranked AS (
  SELECT doc_id, r.source, size, source_size, target, u,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY r.source ORDER BY
           length(bin(size)) * 4 + ((size >> greatest(length(bin(size)) - 3, 0)) & 3),
           substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || digest), 1, 2), doc_id NULLS FIRST, digest) AS i
  FROM rows r JOIN aims a ON r.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
       least(floor(i * rate + u) - floor((i - 1) * rate + u), 3)::BIGINT * size AS taken
FROM ranked
"""


@query
def op4_token_counts(spark, folder):
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op2_pii(spark, folder):
    return find_pii(table(spark, folder, "documents"))


@query
def op3_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    found = identify(docs, training_sample(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def toxicity_model(docs, labels):
    return fit_toxicity(docs, labels, crc_mod(F.col("doc_id"), 5) != 0)


@query
def op6_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    scored = toxicity_model(docs, table(spark, folder, "labels")).score(docs, ["doc_id"])
    return scored.select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op7_jaccard_join(spark, folder):
    found = near_copies(table(spark, folder, "documents"), Rule(words=3, p=90, q=100))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op8_substring_dedup(spark, folder):
    return repeats(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op5_topk_search(spark, folder):
    return top_k(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, k=10)


ORACLE["op5_topk_search"] = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.r <> q.r WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op1_byte_bpe(spark, folder):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return encode_digests(table(spark, folder, "documents"), path, pattern)


def _lower_ascii(text):
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


@query
def op11_merkle_manifest(spark, folder):
    docs = table(spark, folder, "documents")
    tampered = [_lower_ascii(F.col(f)) if f == "text" else F.col(f) for f in FIELDS]
    claimed = F.when(crc_mod(F.col("doc_id"), 3) == 0, leaf_digest(tampered))
    found = manifest(docs, claimed=claimed)
    names = ["leaf", "subroot", "root", "folded_root"]
    return found.select(
        "doc_id", *[F.lower(F.hex(c)).alias(c) for c in names],
        F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256).alias("proof_sha256"),
        (F.col("folded_root") == F.col("root")).alias("verified"))


#: crc32 of the id as text, bit by bit
_CRC = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, byte:
    list_reduce(range(0, 8), lambda x, bit: xor(x >> 1, (x & 1) * 3988292384), xor(crc, byte)), 4294967295), 4294967295)"""


def _sql_leaf(text):
    named = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(named)})"


ORACLE["op11_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, lang, leaf, coalesce(claimed, leaf) AS claimed,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_sql_leaf("text")} AS leaf,
               CASE WHEN {_CRC} % 3 = 0 THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS claimed
        FROM documents)),
nodes(lang, level, i, n, digest) AS (
  SELECT lang, 0, i, n, leaf FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 8, max((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY lang, level, i // 8),
subroots AS MATERIALIZED (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
above(level, i, n, digest) AS (
  SELECT 0, i, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, max((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY i)) FROM above WHERE n > 1 GROUP BY level, i // 8),
inner_fold(leaf, lang, first, level, i, n, folded, proof) AS (
  SELECT leaf, lang, i, 0, i, n, claimed, '' FROM leaves
  UNION ALL
  SELECT f.leaf, f.lang, f.first, f.level + 1, f.i // 8, max((f.n + 7) // 8),
         sha256(string_agg(CASE WHEN s.i = f.i THEN f.folded ELSE s.digest END, '' ORDER BY s.i)),
         f.proof || coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (WHERE s.i <> f.i), '')
  FROM inner_fold f JOIN nodes s ON s.lang IS NOT DISTINCT FROM f.lang AND s.level = f.level AND s.i // 8 = f.i // 8
  WHERE f.n > 1 GROUP BY f.leaf, f.lang, f.first, f.level, f.i, f.proof),
outer_fold(leaf, lang, first, level, i, n, folded, proof) AS (
  SELECT f.leaf, f.lang, f.first, 0, s.i, s.n, f.folded, f.proof FROM inner_fold f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
  UNION ALL
  SELECT f.leaf, f.lang, f.first, f.level + 1, f.i // 8, max((f.n + 7) // 8),
         sha256(string_agg(CASE WHEN s.i = f.i THEN f.folded ELSE s.digest END, '' ORDER BY s.i)),
         f.proof || coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (WHERE s.i <> f.i), '')
  FROM outer_fold f JOIN above s ON s.level = f.level AND s.i // 8 = f.i // 8
  WHERE f.n > 1 GROUP BY f.leaf, f.lang, f.first, f.level, f.i, f.proof)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(f.proof) AS proof_sha256, f.folded AS folded_root, f.folded = r.digest AS verified
FROM leaves l
JOIN outer_fold f ON f.n = 1 AND f.first = l.i AND f.lang IS NOT DISTINCT FROM l.lang
JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
CROSS JOIN (SELECT digest FROM above WHERE n = 1) r
"""


@query
def op12_token_files(spark, folder):
    place = f"{shared_dir(spark)}/deskmeter-tokens/{uuid.uuid4().hex}"
    vocabulary = Path(public_tokenizers.path("word_bpe_49k.json")).read_bytes()
    write_tokens(table(spark, folder, "documents"), place, vocabulary, end_id=2)
    return read_tokens(spark, place).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def repeat_tails(docs):
    """Every tenth document by hash with a tail that repeats its own first words."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(crc % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})")))
    rows = docs.select("doc_id", "text", words.alias("words"), F.floor(crc / 10).alias("g"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.transform(F.sequence("a", F.col("n") - 1), lambda i: F.get("words", F.col("a") + (i - F.col("a")) % F.col("p")))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark, folder):
    found = periodic_runs(repeat_tails(table(spark, folder, "documents").select("doc_id", "text")))
    best = longest(F.col("runs"))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.n")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.n") / F.col("best.period")).alias("exponent_milli"),
        run_digest(F.col("runs")).alias("runs_sha256"), "collapsed_sha256")


ORACLE["op13_periodic_runs"] = f"""
WITH given AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {_CRC} AS h FROM documents),
sized AS (SELECT r, doc_id, w, len(w) AS n, h, h // 10 AS g FROM given),
parts AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM sized),
docs AS MATERIALIZED (
  SELECT r, doc_id, n, CASE WHEN a < n THEN
    w[:a] || list_transform(range(a, n), lambda i: w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1]) ELSE w END AS w FROM parts),
words AS MATERIALIZED (SELECT r, unnest(w) AS word, unnest(range(0, n)) AS i FROM docs),
pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND x.i < y.i),
islands AS (SELECT r, q, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island, i FROM pairs),
stretches AS MATERIALIZED (
  SELECT r, q AS period, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, island HAVING count(*) + q >= greatest(12, 2 * q)),
runs AS MATERIALIZED (
  SELECT r, period, start, length FROM stretches x WHERE NOT EXISTS (
    SELECT 1 FROM stretches y WHERE y.r = x.r AND y.period < x.period AND x.period % y.period = 0
      AND y.start <= x.start AND y.start + y.length >= x.start + x.length)),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
longest AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, start, period) = 1),
dropped AS (
  SELECT DISTINCT r, i FROM (SELECT r, unnest(range(start + period, start + length)) AS i FROM runs)),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words x
  WHERE NOT EXISTS (SELECT 1 FROM dropped d WHERE d.r = x.r AND d.i = x.i) GROUP BY r)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
       sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l ON l.r = d.r LEFT JOIN longest b ON b.r = d.r LEFT JOIN kept k ON k.r = d.r
"""
