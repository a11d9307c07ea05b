"""Merkle manifest, token files and periodic runs, against brute force, the tokenizer's library and SQL."""

import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deskmeter.llm import merkle, periodic_runs, token_files
from deskmeter.llm.queries import ORACLE, QUERIES

from .conftest import same_as_sql

os.environ["TOKENIZERS_PARALLELISM"] = "false"
with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
    VOCABULARY = file.read()


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- manifest ---------------------------------------------------------------------------------
def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def others(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        out.append((i % 8, run[: i % 8] + run[i % 8 + 1 :]))
        i //= 8
    return out


def folded(leaf, proof):
    for at, siblings in proof:
        leaf = h("".join([*siblings[:at], leaf, *siblings[at:]]))
    return leaf


def expected_manifest(rows):
    def leaf(row, lower=False):
        i, text, lang, source, n = row
        text = text.translate({c: c + 32 for c in range(65, 91)}) if lower and text else text
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in groups[lang]])
    top = tree([trees[lang][-1][0] for lang in order])
    out = []
    for at, lang in enumerate(order):
        for i, row in enumerate(groups[lang]):
            proof = others(trees[lang], i) + others(top, at)
            claimed = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0)
            root = folded(claimed, proof)
            out.append((row[0], trees[lang][0][i], trees[lang][-1][0], top[-1][0], h("".join("".join(s) for _, s in proof)), root, root == top[-1][0]))
    return out


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_as_brute_force(spark, documents, folder, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BUILDER_LEVELS", levels)
    monkeypatch.setattr(merkle, "BUILDER_LEAVES", 8**levels)
    rng = random.Random(4)
    rows = [(i, rng.choice(["A b", "é", "", None, "x" * 5000]), rng.choice(["en", "de", "", "Ω"]), rng.choice(["w", None]), None) for i in range(150)]
    rows += [(900 + i, "T", f"l{i:03}", "s", None) for i in range(75)] + [(5, "again", "en", None, None), (5, "Twice", "en", None, None)]
    rows += [(None, "No Id", "en", None, None), (1000, "No Lang", None, None, None)]
    frame = documents(*[r[:4] for r in rows], extra=("tree", "digest", "leaf"))
    found = QUERIES["op11_merkle_manifest"](spark, folder(documents=frame))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted([tuple(r[n] for n in names) for r in found.collect()], key=repr) == sorted(expected_manifest(rows), key=repr)


@pytest.mark.parametrize("rows", [1, 2, 8, 9, 513])
def test_manifest_as_sql(spark, documents, folder, rows):
    frame = documents(*[(i * 7 % 1009, f"Text {i}", ["a", None][i % 5 == 4], "s") for i in range(rows)])
    same_as_sql(QUERIES["op11_merkle_manifest"], ORACLE["op11_merkle_manifest"], spark, folder(documents=frame))


def test_positions_are_those_of_the_log():
    for leaves in [*range(1, 80), 511, 512]:
        levels = tree([h(str(i)) for i in range(leaves)])
        log = merkle.append_log(levels[0], merkle.height(leaves))
        assert len(log) == sum(map(len, levels))
        for k, nodes in enumerate(levels):
            assert [log[merkle.position(k, j, leaves)] for j in range(len(nodes))] == nodes


def test_a_wrong_leaf_or_sibling_changes_the_root():
    levels = tree([h(str(i)) for i in range(20)])
    siblings = "".join("".join(s) for _, s in others(levels, 11))
    path = bytes([3, 8, 1, 3])
    assert merkle.fold(levels[0][11], siblings, path) == levels[-1][0]
    assert merkle.fold(levels[0][12], siblings, path) != levels[-1][0]
    assert merkle.fold(levels[0][11], siblings[:-1] + "x", path) != levels[-1][0]


# -- token files ------------------------------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 50), max_size=700), st.data())
def test_elias_fano_round_trip(values, data):
    values = np.sort(np.array(values, np.uint64))
    top = int(values[-1]) if len(values) else 0
    code = token_files.EliasFano.frombytes(token_files.EliasFano.of(values, top).tobytes(), len(values), top)
    assert (code.get(0, len(values)) == values).all()
    if len(values):
        i = data.draw(st.integers(0, len(values) - 1))
        assert code.get(i)[0] == values[i] and code.find(int(values[i])) == np.searchsorted(values, values[i])
        assert len(code.low) * 8 + len(code.high) * 8 <= len(values) * (3 + code.bits) + 32


PARTS = st.sampled_from([*"abAB'’sStreVE  \n\t12.,<|>_é日", "<|endoftext|>", "'s", "'LL", "İ", "Σ", "a̸", "≮", "\x1c", "\u0085", "٣", "²"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=25).map("".join), max_size=5))
def test_ids_are_those_of_the_library(given_texts):
    encoder = token_files.Encoder(VOCABULARY, memory=20)
    want = [e.ids for e in encoder.tokenizer.encode_batch(given_texts, add_special_tokens=False)]
    ids, sizes = encoder.encode(pa.array(given_texts, pa.string()))
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("per_file, docs_per_file, per_read", [(1 << 26, 1 << 22, 1 << 13), (40, 5, 3)])
def test_files_hold_all_documents_in_order(spark, documents, tmp_path, per_file, docs_per_file, per_read):
    rng = random.Random(3)
    rows = [(i * 3 - 50, " ".join(rng.choice(["Hello", "world's", "<|endoftext|>", "12", "é"]) for _ in range(rng.randrange(12)))) for i in range(90)]
    rows += [(None, "null id"), (None, ""), (7, None), (7, "seven"), (7, "seven"), (2**62, "w " * 40_000)]
    frame = documents(*rows, extra=("start", "ids", "file")).repartition(5)
    place = str(tmp_path / "out")
    token_files.write_tokens(frame, place, VOCABULARY, 2, ids_per_file=per_file, docs_per_file=docs_per_file, batch_bytes=300)
    found = token_files.read_tokens(spark, place, docs_per_read=per_read, batch_bytes=1000).collect()
    library = token_files.Encoder(VOCABULARY).tokenizer
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    found.sort(key=lambda r: r["start"])
    at, known = 0, [r["doc_id"] for r in found if r["doc_id"] is not None]
    assert known == sorted(known) and [r["doc_id"] for r in found[:2]] == [None, None] and len(found) == len(rows)
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        want[r["doc_id"]].remove(ids)
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        at += len(ids)
    names = [r["file"] for r in token_files.manifest(spark, place).collect()]
    single = [d for n in names if (f := token_files.TokenFile(place, n)) and (d := f.document(2**62)) is not None]
    assert len(single) == 1 and len(single[0]) == 40_001


def test_files_left_behind_are_not_read(spark, documents, tmp_path):
    place = str(tmp_path / "out")
    token_files.write_tokens(documents((1, "a b")), place, VOCABULARY, 2)
    (tmp_path / "out" / "000000-00000-lost.tokens").write_bytes(b"half a file")
    assert [r["doc_id"] for r in token_files.read_tokens(spark, place).collect()] == [1]


def test_token_query_and_empty_table(spark, small, documents, folder):
    rows = {r["doc_id"]: r for r in QUERIES["op12_token_files"](spark, small).collect()}
    library, at = token_files.Encoder(VOCABULARY).tokenizer, 0
    for r in sorted(spark.read.parquet(f"{small}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(rows[r["doc_id"]][c] for c in ("start", "n_tokens", "ids_crc32")) == (at, len(ids), crc)
        at += len(ids)
    assert QUERIES["op12_token_files"](spark, folder(documents=documents())).collect() == []


# -- runs -------------------------------------------------------------------------------------
def expected_runs(words):
    out = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                stretch = words[i : j + q]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


UNIT = st.lists(st.sampled_from("ab"), min_size=1, max_size=6)
REPEATED = st.builds(lambda u, n, tail: (u * n) + tail, UNIT, st.integers(1, 25), st.lists(st.sampled_from("abc"), max_size=8))
WORDS = st.lists(REPEATED, max_size=4).map(lambda x: sum(x, [])) | st.builds(lambda x, n: x * n, st.lists(REPEATED, max_size=2).map(lambda x: sum(x, [])), st.integers(1, 4))


@settings(max_examples=300, deadline=None)
@given(st.lists(WORDS, max_size=5), st.sampled_from([8, 16, 40]))
def test_fragments_and_tiles_as_brute_force(given_words, tile):
    raw = [" ".join(w).encode() for w in given_words]
    ends = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    codes, _, _, before = periodic_runs.word_codes(np.frombuffer(b"".join(raw), np.uint8), ends)
    text, q, first, last = periodic_runs.fragments(codes, before)
    for i, words in enumerate(given_words):
        own = text == i
        runs = zip(first[own].tolist(), (last - first + q)[own].tolist(), q[own].tolist(), strict=True)
        assert periodic_runs.smallest_only(list(runs)) == expected_runs(words)
        parts = [np.zeros((3, 0), np.int64)]
        for low, high, a, z in periodic_runs.stretches(len(words), tile):
            _, p, f, e = periodic_runs.fragments(codes[before[i] + a : before[i] + z], np.array([0, z - a]), low, high)
            parts.append(np.stack([p, f + a, e + a]))
        p, f, e = periodic_runs.combine(*np.concatenate(parts, axis=1))
        long = e - f >= periodic_runs.least(p)
        runs = zip(f[long].tolist(), (e - f + p)[long].tolist(), p[long].tolist(), strict=True)
        assert periodic_runs.smallest_only(list(runs)) == expected_runs(words)


@pytest.mark.parametrize("tile", [16, 1 << 16])
def test_runs_of_documents(documents, tile):
    rng = random.Random(8)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "a " * 11), (4, "a\t" * 12), (5, "a b " * 500), (6, ("a " * 30 + "b ") * 20), (None, "x y " * 9), (5, "z " * 20)]
    rows += [(10 + i, " ".join(rng.choice(["a", "b", f"w{i}"]) for _ in range(rng.randrange(60))) + " k l m" * rng.randrange(9)) for i in range(30)]
    frame = documents(*rows, extra=("rid", "runs", "fragments"))
    found = periodic_runs.periodic_runs(frame, tile_words=tile, batch_bytes=500).collect()
    want = []
    for i, t in rows:
        words = (t or "").split()
        runs = expected_runs(words)
        want.append((i, tuple(runs), h(collapsed(words, runs))))
    got = [(r["doc_id"], tuple((x["start"], x["length"], x["period"]) for x in r["runs"]), r["collapsed_sha256"]) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r["collapsed"] is None or h(r["collapsed"]) == r["collapsed_sha256"] for r in found)


def test_very_repetitive_long_text(documents):
    (found,) = periodic_runs.periodic_runs(documents((1, "a b c " * 200_000))).collect()
    assert [tuple(r) for r in found["runs"]] == [(0, 600_000, 3)] and found["collapsed"] == "a b c"


def test_runs_as_sql(spark, documents, folder):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(80)))) for i in range(120)] + [(500, None), (501, "")]
    same_as_sql(QUERIES["op13_periodic_runs"], ORACLE["op13_periodic_runs"], spark, folder(documents=documents(*rows)))


def test_runs_of_an_empty_table(spark, documents, folder):
    assert QUERIES["op13_periodic_runs"](spark, folder(documents=documents())).collect() == []
