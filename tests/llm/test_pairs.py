"""The similarity join, substring dedup and top-k search against brute force."""

import hashlib
import random
import re
import time

import pytest

from deskmeter.llm import jaccard_join
from deskmeter.llm.common import store
from deskmeter.llm.components import contract
from deskmeter.llm.jaccard_join import Rule, drop_near_copies, near_copies, sketch_keys
from deskmeter.llm.queries import ORACLE, QUERIES
from deskmeter.llm.substring_dedup import repeats
from deskmeter.llm.topk_search import top_k

from .conftest import same_as_sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def near_family(rng, n, length=120):
    """Copies of one text with random edits, some cut short."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            words[rng.randrange(length)] = rng.choice([f"e{rng.randrange(10**6)}", "Same", base[0]])
        yield " ".join(words[: rng.choice([length] * 6 + [length * 3 // 4, length - 9])])


def odd_documents(seed):
    rng = random.Random(seed)
    out = [None, "", " \n", "a", "A", "a b", "A  B", "a b c", "a b c d", "Ä x y", "ä x y"]
    for size in (40, 40, 25):
        out += list(near_family(rng, size))
    out += [" ".join(rng.choice("abc") for _ in range(rng.randrange(30))) for _ in range(60)]
    out += out[11:30]
    out.append(" ".join(f"l{i}" for i in range(3000)))
    out.append(" ".join(f"l{i}" if i % 100 else "x" for i in range(3000)))
    rng.shuffle(out)
    return list(enumerate(out))


def sets_of(rows, k):
    out = {}
    for i, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    return out


def components(sets, p, q):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids[: ids.index(i)]:
            both = len(sets[i] & sets[j])
            if both and q * both >= p * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("k", "p", "members"), [(3, 90, 4096), (3, 90, 16), (5, 80, 20)])
def test_components_as_brute_force(documents, k, p, members):
    """Also with clusters that don't fit a task, as ``members`` makes them."""
    rows = odd_documents(k)
    sets = sets_of(rows, k)
    want = components(sets, p, 100)
    found = near_copies(documents(*rows, extra=("n", "rid")), Rule(k, p, 100), task_members=members, filter_bits=12).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {i: (len(sets[i]), want[i]) for i in want}


def test_a_set_moves_to_one_task_where_its_component_fits(spark, documents, monkeypatch):
    moved, inside = spark.sparkContext.accumulator(0), jaccard_join._inside

    def counted(rule):
        search = inside(rule)

        def run(rows):
            moved.add(rows.num_rows)
            return search(rows)

        return run

    monkeypatch.setattr(jaccard_join, "_inside", counted)
    texts = list(dict.fromkeys(near_family(random.Random(2), 60)))
    found = near_copies(documents(*enumerate(texts)), Rule()).collect()
    want = components(sets_of(list(enumerate(texts)), 5), 80, 100)
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    assert 0 < moved.value <= len(texts)


def test_clusters_inside_another(spark):
    members = [(1, r) for r in (1, 2, 3, 4)] + [(2, 2), (2, 3), (3, 3), (3, 4), (3, 9), (5, 5), (5, 6), (6, 6), (6, 7)]
    found = jaccard_join._inner(spark.createDataFrame(members, "cluster long, rid long")).collect()
    assert {tuple(r) for r in found} == {(2, 1)}


@pytest.mark.parametrize("elements", [10, 2_000_000])
def test_texts_much_longer_than_their_sets(documents, elements):
    """Words that repeat make few shingles; what a task takes counts the texts."""
    rows = [(i, " ".join(["a b c d e f g h i j k l m n o p q r s t"] * n + tail)) for i, (n, tail) in enumerate(
        [(3, []), (400, []), (400, ["x"]), (900, ["y z"]), (1, []), (1, ["x"]), (2, ["1 2 3 4 5 6 7 8 9 10 11 12"])])]
    want = components(sets_of(rows, 5), 80, 100)
    found = near_copies(documents(*rows), Rule(), task_elements=elements).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == want


def test_similar_sets_share_a_key():
    import numpy as np

    rng, rule = np.random.default_rng(1), Rule(5, 80, 100)
    for size in [1, 2, 4, 5, 9, 10, 17, 40, 333, 5000]:
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        lost = rule.most(len(a)) // 2
        b = np.unique(np.concatenate([a[lost:], rng.integers(0, 2**63, lost, dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            assert len(np.intersect1d(sketch_keys(a, rule), sketch_keys(b, rule)))


def test_a_set_keys_no_more_parts_than_similar_ones_may_differ_in():
    import numpy as np

    rng, rule = np.random.default_rng(4), Rule(5, 80, 100)
    for size in [40, 95, 100, 150, 333, 1200, 5000]:
        edges, most = jaccard_join.bands(rule), rule.most(size)
        below = -(-size * 80 // 100) < edges[edges <= size][-1]
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            assert len(sketch_keys(a, rule)) <= (most + 1) * (2 if below else 1)
            kept, more = a[rng.permutation(size)[rng.integers(0, most + 1) :]], rng.integers(0, 2**64, rng.integers(0, most + 1), dtype=np.uint64)
            b = np.unique(np.concatenate([kept, more]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= 80 * (len(a) + len(b) - common):
                assert len(np.intersect1d(sketch_keys(a, rule), sketch_keys(b, rule)))


def test_texts_with_a_common_passage_meet_seldom(spark, documents, monkeypatch):
    moved, inside = spark.sparkContext.accumulator(0), jaccard_join._inside

    def counted(rule):
        search = inside(rule)

        def run(rows):
            moved.add(rows.num_rows)
            return search(rows)

        return run

    monkeypatch.setattr(jaccard_join, "_inside", counted)
    rng = random.Random(3)
    texts = [" ".join(["the same twelve words of a common passage begin every text in here"] + [f"w{rng.randrange(10**6)}" for _ in range(90 + i % 60)]) for i in range(300)]
    found = near_copies(documents(*enumerate(texts)), Rule()).collect()
    assert all(r["doc_id"] == r["component_id"] for r in found) and moved.value < 100


@pytest.mark.parametrize("bits", [6, 20])
def test_rows_that_surely_stay_do_not_move(spark, documents, folder, bits):
    """Also with a filter that is full."""
    rng = random.Random(6)
    rows = list(enumerate([*near_family(rng, 40), *(" ".join(rng.choice("abcdefgh") * 3 for _ in range(30)) for _ in range(200))]))
    frame = spark.read.parquet(f"{folder(documents=documents(*rows))}/documents.parquet")
    kept = drop_near_copies(frame, Rule(), filter_bits=bits)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(components(sets_of(rows, 5), 80, 100).values()))
    plan = kept._jdf.queryExecution().analyzed().toString()
    assert "Union" in plan and "LeftSemi" not in plan


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle_")}

    before = files()
    store(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    until = time.time() + 10
    while (left := files() - before) and time.time() < until:  # they go in the background
        time.sleep(0.1)
    assert not left


def test_near_copies_dropped(documents):
    frame = documents((5, "a b c d e f"), (3, "A b c d e f"), (3, "A b c d e f"), (9, None), (8, ""), (7, "q"), extra=("label",))
    assert sorted(r["doc_id"] for r in drop_near_copies(frame).collect()) == [3, 7, 8, 9]


@pytest.mark.parametrize("name", ["op7_jaccard_join", "op8_substring_dedup"])
def test_empty_documents(spark, documents, folder, name):
    assert QUERIES[name](spark, folder(documents=documents())).collect() == []


def test_long_chains_contract(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "u long, v long")
    labels = {r["id"]: r["label"] for r in contract(edges).collect()}
    assert len({labels[i] for i in range(301)}) == 1 and labels[1000] == labels[1001] != labels[0]


def expected_repeats(rows, window=20):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        covered = [False] * len(words)
        for j in range(len(words) - window + 1):
            key = tuple(words[j : j + window])
            if key in seen:
                covered[j : j + window] = [True] * window
            seen.add(key)
        left = " ".join(w for w, c in zip(words, covered, strict=True) if not c)
        out[i] = (len(words), sum(covered), hashlib.sha256(left.encode()).hexdigest(), left)
    return out


@pytest.mark.parametrize("group_rows", [0, 3, 20_000])
def test_repeats_as_brute_force(documents, group_rows):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(70)]
    rows = [(0, None), (1, ""), (2, "x " * 19), (3, "x " * 20), (4, "x " * 21), (5, "x " * 300), (6, " ".join(passage))]
    for i in range(7, 60):
        words = [rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(rng.randrange(120))]
        at = rng.randrange(len(words) + 1)
        cut = rng.randrange(50)
        rows.append((i, "\t".join(words[:at] + passage[cut : cut + rng.choice([0, 19, 20, 21, 60])] + words[at:])))
    rows += [(i + 100, t) for i, t in rows[20:30]]
    want = expected_repeats(rows)
    found = repeats(documents(*rows, extra=("start", "key")), with_text=True, group_rows=group_rows, task_rows=50).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == {i: w[:3] for i, w in want.items()}
    for r in found:
        assert sum(s["end"] - s["begin"] for s in r["spans"]) == r["n_removed"]
        assert r["kept"] in (None, want[r["doc_id"]][3])


def test_top_k_as_sql(spark, small):
    same_as_sql(QUERIES["op5_topk_search"], ORACLE["op5_topk_search"], spark, small, ("embeddings",))


def test_top_k_of_repeated_ids_as_sql(spark, folder):
    rng = random.Random(9)
    rows = [(i % 150, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    same_as_sql(QUERIES["op5_topk_search"], ORACLE["op5_topk_search"], spark, folder(embeddings=frame), ("embeddings",))


def test_top_k_odd_vectors(spark):
    from pyspark.sql import functions as F

    rng = random.Random(2)
    vectors = [[float(rng.randrange(-3, 4)) for _ in range(4)] for _ in range(300)]
    rows = list(enumerate(vectors)) + [(7, vectors[7]), (8, [9.0, 9.0, 9.0, 9.0]), (8, [-9.0] * 4), (100, [1.0, 2.0, 3.0, 0.0]), (400, None), (401, [1.0, None, 2.0, 3.0]), (402, [float("nan")] * 4),
                                       (403, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (404, [2.0, 2.0]), (500, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).withColumn("rank", F.lit(1))
    usable = [(i, [int(x * 1024) for x in v]) for i, v in rows if i is not None and i not in (400, 401, 402, 403)]
    want = []
    for row, (q, own) in enumerate(usable):
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for r, (i, v) in enumerate(usable) if r != row)[:10]  # noqa: B905
            want += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    found = top_k(frame, F.col("id") % 100 == 0, block_rows=8, group=5, chunk_rows=3).collect()
    assert sorted(map(tuple, found)) == sorted(want)
    empty = top_k(frame.limit(0), F.col("id") % 100 == 0)
    assert empty.collect() == [] and empty.columns == ["query_id", "rank", "vec_id", "score"]
