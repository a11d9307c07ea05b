"""One-hot, z-score and the feature matrix.

Categories are fitted on all rows, moments on the training rows only. Both fits reduce the
data to a few bounded rows; the transforms are row-wise expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmeter import domain
from deskmeter.operators.ordering import numbered
from deskmeter.session import reliable_checkpoint

MAX_CATEGORIES = 1000


def fit_categories(df: DataFrame, columns: list[str] = domain.CATEGORICAL) -> dict[str, list[str]]:
    """Sorted distinct values per column, from one scan.

    A column with more than ``MAX_CATEGORIES`` values is no category; that is an error, not
    a reason to cut the list.
    """
    sets = [[F.col(c)] for c in columns]
    name = F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(c)) for c in columns])
    pairs = (
        df.groupingSets(sets, *[F.col(c) for c in columns])
        .agg(name.alias("_column"))
        .select("_column", F.coalesce(*[F.col(c).cast("string") for c in columns]).alias("_value"))
        .where(F.col("_value").isNotNull())
    )
    bound = MAX_CATEGORIES * len(columns)
    rows = pairs.limit(bound + 1).collect()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        found[row["_column"]].append(row["_value"])
    wide = [c for c, values in found.items() if len(values) > MAX_CATEGORIES]
    if wide or len(rows) > bound:
        raise ValueError(f"too many distinct values for one-hot columns: {wide or columns}")
    return {c: sorted(values, key=lambda v: v.encode()) for c, values in found.items()}


def dummy_name(column: str, value: str) -> str:
    return f"{column}_{value}"


def one_hot_columns(categories: dict[str, list[str]]) -> dict[str, Column]:
    """One 0/1 column per category, none dropped; a missing value gives all zeros."""
    return {
        dummy_name(c, v): F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
        for c, values in categories.items()
        for v in values
    }


def one_hot(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    return df.withColumns(one_hot_columns(categories))


def dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(place, value, index): every value of every column with its number, by column and then by value.

    However many there are: they are numbered by ranges and stay a table.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)]))
    values = df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()
    return numbered(values, ["place", "value"], "index")


def one_hot_sparse(df: DataFrame, key: str, columns: list[str], known: DataFrame | None = None) -> DataFrame:
    """(key, indices): the places of the ones in each row's vector, rising; missing and unknown values have none.

    ``key`` is unique. Rows meet the dictionary in one join per column, on the value; the rows of a hot value are split by adaptive execution,
    and no row is put together again from parts. Nothing is collected.
    """
    known = dictionary(df, columns) if known is None else known
    known = reliable_checkpoint(known)
    found = df.select(key, *columns)
    for i, c in enumerate(columns):
        own = known.where(F.col("place") == i).select(F.col("value").alias(f"_v{i}"), F.col("index").alias(f"_i{i}"))
        found = found.join(own, F.col(c).cast("string") == F.col(f"_v{i}"), "left")
    ones = F.filter(F.array(*[F.col(f"_i{i}") for i in range(len(columns))]), lambda x: x.isNotNull())
    return found.select(key, ones.alias("indices"))


def moments(train: DataFrame, columns: list[str] = domain.NUMERIC) -> DataFrame:
    """One row with ``mean_<c>`` and ``std_<c>`` (sample); a constant column gets std 1."""
    aggregates = []
    for c in columns:
        value = F.col(c).cast("double")
        std = F.stddev_samp(value)
        aggregates += [F.avg(value).alias(f"mean_{c}"), F.when(std == 0, 1.0).otherwise(std).alias(f"std_{c}")]
    return train.agg(*aggregates)


def zscore(df: DataFrame, train: DataFrame, columns: list[str] = domain.NUMERIC) -> DataFrame:
    """Scale ``columns`` of ``df`` with the moments of ``train``.

    The moments come in as a one-row scalar subquery, so nothing is joined or collected.
    """
    fitted = moments(train, columns)
    packed = fitted.select(F.struct("*").alias("m")).scalar()
    with_moments = df.withColumn("_m", packed)
    scaled = {
        c: (F.col(c).cast("double") - F.col("_m")[f"mean_{c}"]) / F.col("_m")[f"std_{c}"]
        for c in columns
    }
    return with_moments.withColumns(scaled).drop("_m")


def feature_names(categories: dict[str, list[str]], numeric: list[str] = domain.NUMERIC) -> list[str]:
    return [*numeric, *[dummy_name(c, v) for c, values in categories.items() for v in values]]


def matrix(
    df: DataFrame,
    train: DataFrame,
    categories: dict[str, list[str]],
    key: str = "ticket_id",
    target: str = domain.TARGET,
    numeric: list[str] = domain.NUMERIC,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(key, label, features): z-scored numerics followed by unscaled 0/1 columns."""
    scaled = zscore(df, train, numeric)
    values = [F.col(c) for c in numeric]
    values += [c.cast("double") for c in one_hot_columns(categories).values()]
    return scaled.select(
        F.col(key).alias("id"),
        F.col(target).cast("int").alias("label"),
        F.array(*values).alias("features"),
        *keep,
    )
