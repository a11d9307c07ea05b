"""Optional dashboard filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = {
    "priority": "priority",
    "category": "category",
    "channel": "channel",
    "month": "created_month",
}


def apply_filters(df: DataFrame, **selected) -> DataFrame:
    """Keep rows whose columns match the chosen values.

    A filter that is absent or ``None`` adds no predicate at all; a single value and a list
    of values both work. An empty list counts as nothing chosen.
    """
    unknown = set(selected) - set(FILTERS)
    if unknown:
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    for name, values in selected.items():
        if values is None:
            continue
        if isinstance(values, str) or not isinstance(values, Iterable):
            values = [values]
        values = list(values)
        if values:
            df = df.where(F.col(FILTERS[name]).isin(values))
    return df
