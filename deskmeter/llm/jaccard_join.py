"""Near copies: the exact similarity join of word shingle sets, by parity sketches.

Sketch. The hashed shingles of a set are dealt to P parts, and each part keeps the XOR of its
shingles' hashes: a shingle of both sets cancels out, so one that is in a single set changes
just one part, and the number of parts that differ is at most the symmetric difference d. Sets
with similarity p/q or more have d <= (q - p) / (q + p) * (|A| + |B|). P exceeds the largest d that a band of
sizes allows, so similar sets agree in a part (pigeonhole): band, part and XOR are a join key. A
set is keyed for its own band and, where it can have partners there, for the band below. Of its parts with shingles, a set
that may differ in D parts from similar ones keys the first D + 1 only, in an order that all sets share: the parts with most shingles
first, equal ones by place. The first part on which two similar sets agree is among these in both, as all before it differ. So chance
seldom makes sets meet, for which a part with few shingles is enough. Parts without shingles
say nothing; they are keyed only, with all others, for sets with at most D others.

Verification. Sets that keys connect, be it through others, are searched in one task where they fit it: breadth first, so that
a set once reached is never compared again; so a set moves to one place only. Else the sets that share keys with one set, the
hub, are a cluster, searched likewise, unless another one that fits holds all of it. A larger one is settled
from a centre z, sets x having the differences X from it: if X and Y are disjoint, x and y are similar just if
f(x) + f(y) <= 0 where f(x) = (q + p)|X| - (q - p)|x|, and then both are similar to the set with the
smallest f. So one star per cluster links these, and any other similar pair shares an element of
its differences: sets go on to buckets by (cluster, element) for the first D + 1 elements in hash order,
D being the largest difference from x that is allowed. As the centre is what most have in common, such
a bucket has at most half of the cluster. Sets far from the hub go on by the elements they have beyond it
(or, having few, by those they lack). It ends when no bucket holds two components. No group is ever paired out, no cap is set, no link is lost.

Scale: equal sets are one class first (by count and two 64-bit sums of mixed hashes). Keys are counted in one
aggregate; a bit filter of the repeated ones (``filter_bits``, a fixed bound for what is
broadcast) lets the second reading keep keys and sets only where they can meet. It never loses a row; at sizes where it is
full everything passes, and results are the same. What moves are the texts that share keys, as a text takes less room than the
hashes of its shingles; sets are made of them where they are compared. Components come from
contraction, see components.py. 64-bit hashes stand for shingles.

Nulls and texts without words have empty sets, which are linked with nothing. A text with fewer
words than a shingle is one shingle. Repeated rows are equal sets. Further columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmeter.llm.bitfilter import BITS, build, passes
from deskmeter.llm.common import lean, lengths, owning, release, slices, store, texts, utf8, with_rows
from deskmeter.llm.components import contract, relabel
from deskmeter.llm.words import grams, hashes, mix, spans

TASK_MEMBERS, TASK_ELEMENTS = 4096, 2_000_000
_SKETCH_BITS = 4096
BATCH_BYTES = 2 << 20


@dataclass(frozen=True)
class Rule:
    """Sets are similar when q * |A and B| >= p * |A or B|."""

    words: int = 5
    p: int = 80
    q: int = 100

    def allowed(self, sizes):
        """The largest symmetric difference of two similar sets with so many elements together."""
        return (self.q - self.p) * sizes // (self.q + self.p)

    def most(self, size):
        """The largest symmetric difference of a set of ``size`` from any similar set."""
        return self.allowed(size + size * self.q // self.p)


@lru_cache(maxsize=8)
def bands(rule: Rule) -> np.ndarray:
    """The least sizes of the bands; each is at least (q/p)**2 times the one before."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, ceil(out[-1] * rule.q**2 / rule.p**2)))
    return np.array(out, np.int64)


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, ends = utf8(column)
    begin, stop, before = spans(raw, ends)
    each = hashes(raw, begin, stop, lower=True)
    every = grams(each, words)
    out = []
    for i in range(len(column)):
        low, high = int(before[i]), int(before[i + 1])
        n = high - low
        if n >= words:
            out.append(np.unique(every[low : high - words + 1]))
        else:
            out.append(grams(each[low:high], n) if n else np.zeros(0, np.uint64))
    return out


def sketch_keys(found: np.ndarray, rule: Rule) -> np.ndarray:
    """The join keys of one set of sorted hashes."""
    size = len(found)
    if not size:
        return found
    edges = bands(rule)
    own = int(np.searchsorted(edges, size, side="right")) - 1
    least = -(-size * rule.p // rule.q)
    keys = [_band_keys(found, own, rule, edges)]
    if own and least < edges[own]:
        keys.append(_band_keys(found, own - 1, rule, edges))
    return np.unique(np.concatenate(keys))


def _band_keys(found: np.ndarray, band: int, rule: Rule, edges: np.ndarray) -> np.ndarray:
    most = rule.most(int(edges[band + 1]) - 1)
    parts, differ = most + 2 + most // 8, min(most, rule.most(len(found)))
    part = ((found >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # rises with the hash
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    used, parity = part[first], np.bitwise_xor.reduceat(mix(found + np.uint64(1)), first)
    if len(used) > differ:
        fullest = np.argsort(np.diff(first, append=len(found)) * -1, kind="stable")[: differ + 1]
        used, parity = used[fullest], parity[fullest]
    else:
        full = np.zeros(parts, np.uint64)
        full[used.astype(np.int64)] = parity
        used, parity = np.arange(parts, dtype=np.uint64), full
    return mix(parity ^ mix(used + np.uint64(band << 40)))


def _keys_only(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, BATCH_BYTES):
            keys = [sketch_keys(s, rule) for s in shingle_sets(batch.column("text"), rule.words)]
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            for at in range(0, len(flat), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(flat[at : at + (1 << 17)].view(np.int64))], ["key"])

    return run


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _profiles(rule: Rule, passing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = passing.value
        for batch in slices(batches, BATCH_BYTES):
            sets = shingle_sets(batch.column("text"), rule.words)
            keys = [sketch_keys(s, rule) for s in sets]
            keys = [k[passes(table, k)] for k in keys]
            n, text = np.array([len(s) for s in sets], np.int64), batch.column("text")
            # what it takes in a task: the set, or the text where that is longer
            weight = np.maximum(n, lengths(text) // 8)
            with np.errstate(over="ignore"):
                first = [int(mix(s).sum(dtype=np.uint64)) for s in sets]
                second = [int(mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n),
                 pa.array(np.array(first, np.uint64).view(np.int64)), pa.array(np.array(second, np.uint64).view(np.int64)),
                 _lists(keys), pa.array(weight), pc.if_else(pa.array([len(k) > 0 for k in keys], pa.bool_()), text, pa.scalar("", text.type))],
                ["id", "n", "s1", "s2", "keys", "weight", "text"])

    return run


def _shingled(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_BYTES):
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), _lists(shingle_sets(batch.column("text"), rule.words))], ["rid", "shingles"])

    return run


def _inside(rule: Rule):
    """The links of one cluster that fits a task: a breadth-first search over its members.

    Each member is compared with those not reached yet, by the Hamming distance of bit sketches first (a lower
    bound of the difference) and by the sets where it does not rule them out.
    """

    def run(rows: pa.Table) -> pa.Table:
        rid = rows.column("rid").to_numpy()
        sets = [s for part in slices(rows.to_batches(), BATCH_BYTES) for s in shingle_sets(part.column("text"), rule.words)]
        size = np.array([len(s) for s in sets], np.int64)
        sketch = np.zeros((len(rid), _SKETCH_BITS // 8), np.uint8)
        for i, s in enumerate(sets):
            low = (s & np.uint64(_SKETCH_BITS - 1)).astype(np.int64)
            sketch[i] = np.packbits((np.bincount(low, minlength=_SKETCH_BITS) & 1).astype(np.uint8))
        sketch = sketch.view(np.uint64)
        waiting, u, v = np.arange(len(rid)), [], []
        while len(waiting):
            queue, waiting = [waiting[0]], waiting[1:]
            root = queue[0]
            while queue and len(waiting):
                x = queue.pop()
                most = rule.allowed(size[x] + size[waiting])
                maybe = np.abs(size[x] - size[waiting]) <= most
                maybe[maybe] = np.bitwise_count(sketch[waiting[maybe]] ^ sketch[x]).sum(axis=1, dtype=np.int64) <= most[maybe]
                linked = np.zeros(len(waiting), bool)
                for i in np.flatnonzero(maybe):
                    common = np.intersect1d(sets[x], sets[waiting[i]], assume_unique=True).size
                    linked[i] = size[x] + size[waiting[i]] - 2 * common <= most[i]
                found = waiting[linked]
                u += [rid[root]] * len(found)
                v += rid[found].tolist()
                queue += found.tolist()
                waiting = waiting[~linked]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _large(members: DataFrame, sets: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) and further buckets (key, rid) of clusters that don't fit a task, from a centre.

    The centre of a cluster is made of the shingles that most of its members near the hub have: the hub with the
    elements changed that are in the differences of more than half of them.
    """
    plus, minus = rule.q + rule.p, rule.q - rule.p
    a = sets.select("rid", F.col("shingles").alias("a"))
    h = sets.select(F.col("rid").alias("hub"), F.col("shingles").alias("h"))
    size = F.size("a").cast("bigint")
    most = F.floor(minus * (size + F.floor(size * rule.q / rule.p)) / plus).cast("int")
    rows = members.join(a, "rid").join(h, "hub").select(
        "cluster", "hub", "rid", size.alias("size"), F.size("h").cast("bigint").alias("hub_size"), most.alias("most"),
        F.array_except("a", "h").alias("own"), F.array_except("h", "a").alias("lack"))
    rows = store(rows.withColumn("d", F.size("own") + F.size("lack")))
    # what is similar to a member that differs by at most D from the hub differs by at most D + D' from it
    near = rows.where(F.col("d") <= F.col("most") + F.ceil(F.col("most") * rule.q / rule.p) + 1)
    far = rows.where(F.col("d") > F.col("most"))
    near = near.withColumn("x", F.concat("own", "lack"))
    half = near.groupBy("cluster").agg((F.count(F.lit(1)) / 2).alias("half"))
    common = (
        near.select("cluster", F.explode("x").alias("e")).groupBy("cluster", "e").count().join(half, "cluster")
        .where(F.col("count") > F.col("half")).groupBy("cluster").agg(F.collect_list("e").alias("centre"))
    )
    none = F.array().cast("array<bigint>")
    near = near.join(store(common), "cluster", "left").withColumn("centre", F.coalesce("centre", none))
    near = store(near.select(
        "cluster", "hub", "rid", "size", "hub_size", "most", "d",
        F.concat(F.array_except("x", "centre"), F.array_except("centre", "x")).alias("x"),
    ).withColumn("f", plus * F.size("x") - minus * F.col("size")))
    first = store(near.groupBy("cluster").agg(F.min(F.struct("f", "rid")).alias("m")))
    links = near.join(first, "cluster").where(F.col("f") + F.col("m.f") <= 0).select(
        F.col("m.rid").alias("u"), F.col("rid").alias("v"))
    links = links.unionByName(near.where(plus * F.col("d") <= minus * (F.col("size") + F.col("hub_size"))).select(
        F.col("hub").alias("u"), F.col("rid").alias("v")))

    def led(rows, name, kind):
        e = F.explode(F.slice(F.array_sort(name), F.lit(1), F.col("most") + 1)).alias("e")
        # the hub has been compared with all of them and is done with
        return rows.where("rid <> hub").select("rid", "cluster", e).select(
            F.xxhash64("cluster", F.lit(kind), "e").alias("key"), "rid")

    # far sets with little of their own are parts of the hub, and lack the same elements if they are similar
    further = led(near, "x", "near").unionByName(led(far, "own", "far")).unionByName(
        led(far.where(F.size("own") <= F.col("most")), "lack", "part"))
    return links.where("u <> v"), further.distinct()


def _mixed(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(key, hub, rid): members of the buckets that hold more than one component; hubs are their smallest members."""
    rows = store(relabel(labels, buckets.withColumn("label", F.col("rid")), "label"))
    several = store(rows.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("m"), F.min("rid").alias("hub"))
                    .where("l < m").select("key", "hub"))
    return rows.join(several, "key").select("key", "hub", "rid")


def _inner(members: DataFrame) -> DataFrame:
    """(cluster, outer): clusters whose members are all in one other cluster, the first that each of them is in."""
    firsts = members.groupBy("rid").agg(F.min("cluster").alias("outer"))
    by = members.join(firsts, "rid").groupBy("cluster").agg(F.min("outer").alias("outer"), F.max("outer").alias("last"))
    # its members have it as their first, so the outer cluster itself is never inside another
    return by.where((F.col("outer") == F.col("last")) & (F.col("outer") != F.col("cluster"))).select("cluster", "outer")


def connect(sets: DataFrame, buckets: DataFrame, rule: Rule, task_members: int, task_elements: int) -> DataFrame | None:
    """Labels of the linked sets; ``sets`` (rid, weight, text), ``buckets`` (key, rid)."""
    labels, weights, texts_of = None, sets.select("rid", "weight"), sets.select("rid", "text")
    fits = ((F.count(F.lit(1)) <= task_members) & (F.sum("weight") <= task_elements)).alias("fits")
    # at first, the buckets of one hub are one cluster; later they must stay apart to get smaller
    cluster = F.col("hub")
    while True:
        members = store(_mixed(buckets, labels).select(cluster.alias("cluster"), "hub", "rid").distinct())
        if members.isEmpty():
            return labels
        small, first = None, labels is None
        if first:  # what hangs together and fits a task as a whole goes there once, not with each of its hubs
            whole = contract(members.select(F.col("hub").alias("u"), F.col("rid").alias("v")))
            members = store(relabel(whole, members.withColumn("whole", F.col("hub")), "whole"))
            each = members.select(F.col("whole").alias("cluster"), "rid").distinct()
            wholes = store(each.join(weights, "rid").groupBy("cluster").agg(fits).where("fits").select("cluster"))
            small = each.join(wholes, "cluster")
            members = store(members.join(wholes.withColumnRenamed("cluster", "whole"), "whole", "left_anti").drop("whole"))
        clusters = store(members.join(weights, "rid").groupBy("cluster").agg(fits))
        if first:
            outer = _inner(members).join(clusters.where("fits").select(F.col("cluster").alias("outer")), "outer")
            clusters = store(clusters.join(outer, "cluster", "left_anti"))
        apart = members.join(clusters.where("fits").select("cluster"), "cluster").select("cluster", "rid")
        small = (apart if small is None else small.unionByName(apart)).join(texts_of, "rid")
        links = store(small.select("cluster", "rid", "text").groupBy("cluster").applyInArrow(_inside(rule), "u bigint, v bigint"))
        large = clusters.where(~F.col("fits")).select("cluster")
        if large.isEmpty():
            return contract(links, labels)
        members = store(members.join(large, "cluster"))
        used = texts_of.join(members.select("rid"), "rid", "left_semi")
        used = store(used.mapInArrow(_shingled(rule), "rid bigint, shingles array<bigint>"))
        more, buckets = _large(members, used, rule)
        buckets, cluster = store(buckets), F.col("key")
        labels = contract(links.unionByName(more), labels)


def near_copies(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text",
                filter_bits: int = BITS, task_members: int = TASK_MEMBERS,
                task_elements: int = TASK_ELEMENTS) -> DataFrame:
    """One row per row of ``docs``: rid, id, n_shingles, component_id (smallest id reachable), class_id."""
    rows = texts(docs, F.col(id_col).alias("id"), text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    repeated = store(rows.select("text").mapInArrow(_keys_only(rule), "key bigint").groupBy("key").count().where("count > 1").select("key"))
    passing = docs.sparkSession.sparkContext.broadcast(build(repeated, filter_bits))
    schema = f"id {kind}, n bigint, s1 bigint, s2 bigint, keys array<bigint>, weight bigint, text string"
    profiles = store(rows.mapInArrow(_profiles(rule, passing), schema)
                     .withColumn("rid", F.monotonically_increasing_id()))
    plain = profiles.select("rid", "id", "n", "s1", "s2")
    classes = store(plain.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("rid").alias("class"), F.min("id").alias("least")))
    keys = profiles.select("rid", "keys").join(classes.select(F.col("class").alias("rid")), "rid", "left_semi")
    sets = profiles.where(F.size("keys") > 0).select("rid", "weight", "text")
    labels = connect(sets, keys.select(F.explode("keys").alias("key"), "rid"), rule, task_members, task_elements)
    labelled = store(relabel(labels, classes.withColumn("label", F.col("class")), "label"))
    least = store(labelled.groupBy("label").agg(F.min("least").alias("component_id")))
    named = store(labelled.join(least, "label").select("n", "s1", "s2", "class", "component_id"))
    alone = plain.where("n = 0").select("rid", "id", "n", F.col("id").alias("component_id"), F.col("rid").alias("class"))
    linked = plain.where("n > 0").join(named, ["n", "s1", "s2"]).select("rid", "id", "n", "component_id", "class")
    return linked.unionByName(alone).select(
        "rid", F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("class").alias("class_id"))


def drop_near_copies(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text",
                     filter_bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id; all columns kept.

    Documents with empty sets are linked with nothing and stay. Rows are decided one by one: a row without an id
    stays only where its component has no other, and of rows that share an id any one stays.
    """
    rows, key, row = with_rows(docs, id_col)
    with owning() as used:
        found = near_copies(rows, rule, key, text_col)
        gone = store(found.where(F.col(key)["row"] != F.col("component_id")["row"]).select(F.col(key)["row"].alias("_gone")))
    release(docs.sparkSession, used[:-1])  # what the search has stored
    passing = docs.sparkSession.sparkContext.broadcast(build(gone.select(F.xxhash64("_gone").alias("key")), filter_bits))

    @F.arrow_udf("boolean")
    def maybe(key: pa.Array) -> pa.Array:
        return pa.array(passes(passing.value, key.to_numpy().view(np.uint64)))

    # only rows that may be dropped move; a full filter lets all of them pass, with the same result
    rows = rows.withColumn(key, maybe(F.xxhash64(row)))
    stays = rows.where(~F.col(key))
    moved = rows.where(F.col(key)).join(gone, F.col(row) == F.col("_gone"), "left_anti")
    return stays.unionByName(moved).select(*docs.columns)
