"""A Merkle manifest of a dataset: one tree of digests per group, one tree over the groups' roots, and proofs.

Every row is a leaf. In a group, leaves ascend by id; every 8 consecutive nodes (fewer in the last
run) become the hash of their digests, as hex text one after another, until one node remains: the
subroot. Subroots, by group (null first), become the root in the same way.

Method: an aligned builder takes 8**3 consecutive leaves and appends nodes to its log in the order
in which they are complete: leaves as they come, a parent right behind its last child. So a log is
in postorder, and the place of node j of a level follows from the sizes of the subtrees before it: no
pointers are stored. The tops of the builders are the leaves of the next round, 512 times fewer. The
proof of a leaf is read from its builder's log by the places of its siblings, and goes on with the
proof of the builder's top, which all of its leaves share, from the round above.

Scale: texts are hashed where they are read; only digests are stored and move. Leaves get their
number from ranges of (group, id, digest): place in the range plus the totals of the ranges before, so a
group that holds most rows is spread like any other. No task holds more than 512 leaves and their
log at once. There is one round for every factor of 512.

Nulls: a null field is hashed as ``-``, a null group is a group of its own, null ids come first. Rows that repeat
an id are leaves one by one, in the order of their digests. Further columns are ignored. An empty table
has no leaves and gives an empty result. A group of one row has its leaf as subroot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmeter.llm.common import store

ARITY, BUILDER_LEVELS = 8, 3
BUILDER_LEAVES = ARITY**BUILDER_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: list[Column]) -> Column:
    """The hash of the fields' values, each behind its length in bytes and a colon."""
    values = [f.cast("string") for f in fields]
    named = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*named).cast("binary"), 256))


def node(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    levels, width = 0, leaves
    while width > 1:
        levels, width = levels + 1, -(-width // ARITY)
    return levels


def position(level: int, j: int, leaves: int) -> int:
    """The place of node ``j`` of ``level`` in the postorder log over ``leaves`` leaves.

    Before it stand the complete subtrees to its left and all but itself of its own.
    """
    first = j * ARITY**level
    own = min(leaves, first + ARITY**level) - first
    left = first + sum(first // ARITY**m for m in range(1, 1 + height(leaves)))
    return left + sum(-(-own // ARITY**m) for m in range(level + 1)) - 1


def append_log(leaves: list[str], levels: int) -> list[str]:
    """All nodes over ``leaves`` up to ``levels`` above them, in the order of completion."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(levels + 1)]

    def complete(level: int, digest: str) -> None:
        log.append(digest)
        if level < levels:
            waiting[level].append(digest)
            if len(waiting[level]) == ARITY:
                children, waiting[level] = waiting[level], []
                complete(level + 1, node(children))

    for digest in leaves:
        complete(0, digest)
    for level in range(levels):
        if waiting[level]:
            children, waiting[level] = waiting[level], []
            complete(level + 1, node(children))
    return log


@lru_cache(maxsize=64)
def addresses(leaves: int, levels: int) -> list[tuple[list[int], bytes]]:
    """For every leaf: the places of its siblings level by level, and (place, width) of it in each run."""
    out = []
    for i in range(leaves):
        places, path, j, width = [], bytearray(), i, leaves
        for level in range(levels):
            run = range(j // ARITY * ARITY, min(j // ARITY * ARITY + ARITY, width))
            places += [position(level, s, leaves) for s in run if s != j]
            path += bytes([j - run.start, len(run)])
            j, width = j // ARITY, -(-width // ARITY)
        out.append((places, bytes(path)))
    return out


def fold(leaf: str, siblings: str, path: bytes) -> str:
    """The root that follows from a leaf, its siblings' digests (hex, one after another) and its path."""
    at = 0
    for place, width in zip(path[::2], path[1::2], strict=True):
        before, after = at + 64 * place, at + 64 * (width - 1)
        leaf = hashlib.sha256((siblings[at:before] + leaf + siblings[before:after]).encode()).hexdigest()
        at = after
    return leaf


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with ``i``, their number in their ``tree`` from 0 by ``order``, and ``n``, the tree's size."""
    by = [F.col("tree"), *order]
    placed = store(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    ranges = store(placed.groupBy("tree", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_count")))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        "tree", "_range", (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_count").over(tree).alias("n"))
    return placed.join(starts, ["tree", "_range"]).withColumn("i", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def _builders(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """(tree, chunk, n, leaves, log): a row per aligned builder; ``leaves`` in order, ``log`` their digests and those above."""
    grouped = nodes.groupBy("tree", F.floor(F.col("i") / BUILDER_LEAVES).alias("chunk")).agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "digest", *payload))).alias("leaves"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = []
            for n, leaves in zip(batch.column("n").to_pylist(), batch.column("leaves"), strict=True):
                digests = [d.hex() for d in leaves.values.field("digest").to_pylist()]
                levels = height(n) if n <= BUILDER_LEAVES else BUILDER_LEVELS
                logs.append(bytes.fromhex("".join(append_log(digests, levels))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.binary())], [*batch.schema.names, "log"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in grouped.schema.fields)
    return store(grouped.mapInArrow(build, f"{shape}, log binary"))


def _rounds(nodes: DataFrame, payload: list[str]) -> list[DataFrame]:
    """The builders of every round; those of round r + 1 take the tops of round r in trees of more than one builder."""
    rounds = [_builders(nodes, payload)]
    while not (above := rounds[-1].where(F.col("n") > BUILDER_LEAVES)).isEmpty():
        rounds.append(_builders(above.select(
            "tree", F.col("chunk").alias("i"), F.ceil(F.col("n") / BUILDER_LEAVES).alias("n"),
            F.expr("substring(log, -32)").alias("digest")), []))
    return rounds


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """(tree, round, digest): the root of every tree."""
    tops = [r.where(F.col("n") <= BUILDER_LEAVES).select("tree", F.lit(k).alias("round"), F.expr("substring(log, -32)").alias("digest"))
            for k, r in enumerate(rounds)]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


def _proofs(builders: DataFrame, above: DataFrame, payload: list[str], folded: bool) -> DataFrame:
    """(tree, i, leaf, siblings, path, kept columns of ``above``, payload): a row per leaf of the builders.

    ``above`` has the proof of each builder's top: (tree, chunk, siblings, path, subroot, root).
    """
    joined = builders.join(above, ["tree", "chunk"])
    kinds = {f.name: f.dataType for f in builders.schema["leaves"].dataType.elementType.fields}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = {name: batch.column(name)[row] for name in batch.schema.names}
                leaves, log, n = at["leaves"].values, at["log"].as_py().hex(), at["n"].as_py()
                count = len(leaves)
                places = addresses(count, height(n) if n <= BUILDER_LEAVES else BUILDER_LEVELS)
                shared, way = at["siblings"].as_py().hex(), at["path"].as_py()
                siblings = ["".join([log[64 * p : 64 * p + 64] for p in own]) + shared for own, _ in places]
                paths = [own + way for _, own in places]
                columns = [
                    pa.array([at["tree"].as_py()] * count, pa.string()), leaves.field("i"), leaves.field("digest"),
                    pa.array([bytes.fromhex(s) for s in siblings], pa.binary()), pa.array(paths, pa.binary()),
                    *[pa.array([at[c].as_py()] * count, pa.binary()) for c in ("subroot", "root")],
                    *[leaves.field(p) for p in payload]]
                if folded:
                    claims = [(c or d).hex() for c, d in zip(leaves.field("claimed").to_pylist(), leaves.field("digest").to_pylist(), strict=True)]
                    columns.append(pa.array([bytes.fromhex(fold(*x)) for x in zip(claims, siblings, paths, strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["tree", "i", "leaf", "siblings", "path", "subroot", "root", *payload, *["folded_root"] * folded]
    shape = "tree string, i bigint, leaf binary, siblings binary, path binary, subroot binary, root binary"
    shape += "".join(f", {p} {kinds[p].simpleString()}" for p in payload) + ", folded_root binary" * folded
    return joined.mapInArrow(read, shape)


def _descend(rounds: list[DataFrame], tops: DataFrame, payload: list[str], folded: bool) -> DataFrame:
    """Proofs of all leaves of round 0; ``tops`` has (tree, round, siblings, path, subroot, root) of every tree's root."""
    above = None
    for k in reversed(range(len(rounds))):
        here = tops.where(F.col("round") == k).select("tree", F.lit(0).cast("bigint").alias("chunk"), "siblings", "path", "subroot", "root")
        if above is not None:
            here = here.unionByName(above.select("tree", F.col("i").alias("chunk"), "siblings", "path", "subroot", "root"))
        above = _proofs(rounds[k], here, payload if k == 0 else [], folded and k == 0)
        if k:
            above = store(above)
    return above


def manifest(docs: DataFrame, group: str = "lang", id_col: str = "doc_id", fields: tuple[str, ...] = FIELDS,
             claimed: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, siblings, path, folded_root (all binary but the id).

    ``siblings`` are the digests of the proof one after another, ``path`` has a byte for the place
    and one for the width of each run. ``folded_root`` is recomputed from the ``claimed`` digest of the row,
    where that is given and not null (a row as someone received it), and from its leaf otherwise.
    """
    named = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = store(docs.select(
        named.alias("tree"), F.col(id_col).alias("id"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
        (F.lit(None).cast("binary") if claimed is None else claimed).alias("claimed")))
    payload = ["id", "claimed"]
    rounds = _rounds(numbered(leaves, F.col("id").asc_nulls_first(), F.col("digest")), payload)
    tops = store(_tops(rounds))

    # the groups' roots are the leaves of one more tree
    forest = numbered(tops.select(F.lit("").alias("tree"), F.col("tree").alias("member"), "round", "digest"), F.col("member"))
    over = _rounds(forest, ["member", "round"])
    root = store(_tops(over)).select(
        "tree", "round", F.lit(b"").alias("siblings"), F.lit(b"").alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    members = store(_descend(over, root, ["member", "round"], False).select(
        F.col("member").alias("tree"), "round", "siblings", "path", F.col("leaf").alias("subroot"), "root"))
    return _descend(rounds, members, payload, True).select(
        F.col("id").alias(id_col), "leaf", "subroot", "root", "siblings", "path", "folded_root")
