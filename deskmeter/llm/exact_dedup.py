"""Exact duplicates by deterministic block naming (Karp, Miller and Rosenberg's scheme).

A text is cut into blocks of ``block_bytes`` bytes. The distinct blocks are sorted (by digest, over all tasks) and numbered;
a text is then a list of integers. Adjacent pairs of integers are sorted and numbered in turn,
which halves the lists, until every text is one integer. Two texts have the same
(level, integer) if and only if they are the same bytes: names are given to contents, never to
digests. Rows find the name of a block through a 128-bit digest, which is checked to be free of
collisions over all distinct blocks before it is used (and seeded anew if it were not).

Scale: distinct blocks are combined before their only shuffle, rows move as digests and integers.
The joins that meet hot blocks are plain equi-joins of stored tables, which adaptive execution
splits. A text of n bytes takes ceil(log2(n / block_bytes)) rounds over the still unfinished
texts alone. DataFrame functions only.

Nulls count as empty texts; empty texts equal one another. Of equal texts the row with the
largest id stays; null ids are smaller than any other. Rows that repeat an id and a text are a
group like any other: exactly one of them stays. An empty table gives an empty result. Further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmeter.llm.common import owning, ranked, release, store, texts, with_rows

BLOCK_BYTES = 4096


def _blocks(data: Column, block_bytes: int) -> Column:
    """The fixed-size blocks of a binary column; one empty block if there is nothing."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(data) / block_bytes)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)),
    )


def _digest(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(block).alias("a"), F.xxhash64(block, F.lit(seed)).alias("b")]


def name_blocks(rows: DataFrame, block_bytes: int, seed: int = 1) -> tuple[DataFrame, int]:
    """(a, b, name) of every distinct block of ``rows.text``, and the seed of the digest."""
    data = rows.select(F.explode(_blocks(F.col("text").cast("binary"), block_bytes)).alias("block"))
    while True:
        distinct = data.select(*_digest(F.col("block"), seed), "block").distinct()
        # in the order of the digests, so that blocks move once; they are as good an order as the bytes
        names = ranked(distinct.select("a", "b"), "a", "b", keep=("a", "b"))
        if names.groupBy("a", "b").count().where("count > 1").isEmpty():
            return names, seed
        seed += 1


def name_pairs(lists: DataFrame) -> DataFrame:
    """One round: ``names`` of each ``rid`` becomes half as long."""
    pairs = lists.select(
        "rid",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int")),
                lambda i: F.struct(
                    F.get("names", i * 2).alias("x"),
                    F.coalesce(F.get("names", i * 2 + 1), F.lit(-1)).alias("y"),
                ),
            )
        ).alias("pos", "pair"),
    ).select("rid", "pos", "pair.x", "pair.y")
    names = ranked(pairs.select("x", "y").distinct(), "x", "y", keep=("x", "y"))
    return store(_gather(pairs.join(names, ["x", "y"])))


def _gather(named: DataFrame) -> DataFrame:
    """The names of each ``rid`` in order; a list is as long as its text has blocks."""
    inside = F.array_sort(F.collect_list(F.struct("pos", "name")))
    return named.groupBy("rid").agg(inside.alias("l")).select("rid", F.col("l.name").alias("names"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, level, name."""
    rows = texts(docs, F.col(id_col).alias("id"), text=text_col)
    names, seed = name_blocks(rows, block_bytes)
    data = F.col("text").cast("binary")
    # row numbers are fixed by storing them
    listed = store(rows.select(
        F.monotonically_increasing_id().alias("rid"), "id", F.sha2(data, 256).alias("text_sha256"),
        F.transform(_blocks(data, block_bytes), lambda b: F.struct(*_digest(b, seed))).alias("blocks"),
    ))
    placed = listed.select("rid", F.posexplode("blocks").alias("pos", "block")).select("rid", "pos", "block.*")
    lists, level, finished = store(_gather(placed.join(names, ["a", "b"]))), 0, []
    while True:
        finished.append(lists.where(F.size("names") == 1).select(
            "rid", F.lit(level).alias("level"), F.col("names")[0].alias("name")))
        longer = lists.where(F.size("names") > 1)
        if longer.isEmpty():
            break
        lists, level = name_pairs(longer), level + 1
    identity = finished[0]
    for more in finished[1:]:
        identity = identity.unionByName(more)
    rows = store(listed.drop("blocks").join(identity, "rid"))
    groups = store(rows.groupBy("level", "name").agg(
        F.max(F.struct("id", "rid")).alias("keep"), F.count(F.lit(1)).alias("group_size")))
    return rows.join(groups, ["level", "name"]).select(
        F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"), "text_sha256", "level", "name",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with exactly one row of each group of equal texts, the one with the largest id; all columns kept.

    Rows are decided one by one, whatever else they have in common: a null id is smaller than any other, and of rows that share
    an id any one stays.
    """
    rows, key, row = with_rows(docs, id_col)
    last = rows.withColumn(key, F.struct((~F.col(key)["no_id"]).alias("known"), F.col(key)["id"].alias("id"), F.col(key)["row"].alias("row")))
    with owning() as used:
        kept = store(exact_groups(last, key, text_col).where("kept").select(F.col(key)["row"].alias("_kept")))
    release(docs.sparkSession, used[:-1])
    return rows.join(kept, rows[row] == F.col("_kept"), "left_semi").select(*docs.columns)
