"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words: its share of the total by weight, at most ``cap``
times what it has, the excess shared out again by weight. A source with target T and S words
wants r = T / S copies of each of its documents. The documents of a source are put in an order,
the expected copies are summed up along it, one random offset u per source is added, and a
document is emitted once for every integer that its step crosses:
floor(i r + u) - floor((i - 1) r + u) copies for the i-th document. As r <= cap, no document is
taken more than cap times. The order goes by size first, so that the sample has long and
short documents in proportion and the words taken come near the target.

Scale: the text is read once, for its number of words. Ranks come from cells (source, size class,
bucket of id and text): row numbers inside a cell plus the counts of the cells before it, so no window
ever holds a whole source. The counts before a cell are summed over the buckets of a class and
over the classes of a source, 256 and some hundred rows. The water level is found in a few
rounds of sums over the table of sources; only those sums reach the driver. DataFrame functions
only, the same on every run.

Nulls: a null text has no words, a null source is a source of its own. Documents without words
take part but add nothing. Rows that repeat one another count as often as they occur. A source
without words has target 0, an empty table gives an empty result. Weights are whole numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmeter.llm.common import WORD, store, texts
from deskmeter.operators.ordering import surrogate_key

CAP = 3
SEED = "mix-1"


def _join(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    """Join on the named columns, nulls equal to nulls."""
    renamed = right.select(*[F.col(c).alias(f"_{c}" if c in names else c) for c in right.columns])
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return left.join(renamed, condition).drop(*[f"_{name}" for name in names])


def size_class(size: Column) -> Column:
    """Four classes per doubling, from the leading bits of the number."""
    bits = F.length(F.bin(size))
    lead = F.call_function("shiftright", size, F.greatest(bits - 3, F.lit(0)).cast("int"))
    return (bits * 4 + lead.bitwiseAND(F.lit(3))).cast("int")


def offset(source: Column, seed: str = SEED) -> Column:
    """The random offset of a source in [0, 1), fixed by the seed."""
    named = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("/"), source), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """(source, weight): the weights in turn over the sources by code point, null last."""
    ranked = surrogate_key(sources, "source", "n")
    values = F.array(*[F.lit(w) for w in weights])
    return ranked.select("source", F.get(values, ((F.col("n") - 1) % len(weights)).cast("int")).cast("bigint").alias("weight"))


def targets(sources: DataFrame, cap: int = CAP, share: float = 1.0) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``.

    The level rises with every round, as capped sources leave their excess to the others; it
    stands still when no further source is capped.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    ceiling, level, capped_before = F.col("source_size") * cap, 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > ceiling
        held, weight, capped = sources.agg(
            F.sum(F.when(over, ceiling).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))),
            F.sum(over.cast("int")),
        ).first()
        if not weight or capped == capped_before:
            break
        level, capped_before = (total * share - held) / weight, capped
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), ceiling.cast("double")))


def plan(docs: DataFrame, weigh=cyclic_weights, cap: int = CAP, share: float = 1.0, seed: str = SEED,
         row: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, and the columns of ``row``.

    Equal ids are ordered by the digest of the text, so that any reading of the same rows takes the same ones.
    """
    size = F.regexp_count("text", F.lit(WORD)).cast("bigint")
    digest = F.md5(F.col("text").cast("binary"))
    rows = store(texts(docs, "doc_id", "source", *row).select("doc_id", "source", *row, digest.alias("_digest"), size.alias("size")))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/"), F.col("_digest"))
    rows = rows.withColumns({
        "class": size_class(F.col("size")),
        "bucket": F.substring(F.md5(named.cast("binary")), 1, 2),
    })
    cells = store(rows.groupBy("source", "class", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")))
    classes = cells.groupBy("source", "class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    sizes = store(classes.groupBy("source").agg(F.sum("words").alias("source_size")))
    aims = store(targets(store(_join(sizes, weigh(sizes.select("source")), "source")), cap, share))

    def before(*names):
        window = Window.partitionBy(*names[:-1]).orderBy(names[-1]).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    whole = classes.select("source", "class", before("source", "class").alias("classes_before"))
    within = cells.select("source", "class", "bucket", before("source", "class", "bucket").alias("buckets_before"))
    bases = _join(_join(within, whole, "source", "class"), aims, "source")
    ranked = rows.withColumn(
        "_i", F.row_number().over(Window.partitionBy("source", "class", "bucket").orderBy("doc_id", "_digest", *row)))
    joined = _join(ranked, bases, "source", "class", "bucket")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    i, u = F.col("classes_before") + F.col("buckets_before") + F.col("_i"), offset(F.col("source"), seed)
    copies = F.floor(i * rate + u) - F.floor((i - 1) * rate + u)
    return joined.withColumn("copies", F.least(copies, F.lit(cap)).cast("bigint")).select(
        "doc_id", "source", *row, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weigh=cyclic_weights, cap: int = CAP, share: float = 1.0, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the plan takes it, whatever its id: rows are stored with a number."""
    row = "_row"
    while row in docs.columns:
        row = "_" + row
    rows = store(docs.withColumn(row, F.monotonically_increasing_id()))
    taken = plan(rows, weigh, cap, share, seed, (row,)).where("copies > 0").select(F.col(row).alias("_taken"), F.col("copies").alias("_copies"))
    both = rows.join(taken, F.col(row) == F.col("_taken"))
    return both.select(*[rows[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), taken["_copies"].cast("int"))).alias("_copy")).drop("_copy")
