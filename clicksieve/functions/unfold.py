"""One row per array element without computing the array twice.

For a plain ``explode`` the optimizer adds a filter on the size of the array
and pushes it below the projection, where the whole array expression runs a
second time. The outer form has no such filter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used.

    Inside a lambda a plain expression would be computed for every element.
    """
    return F.transform(F.array(value), use)[0]


def unfold(df: DataFrame, keep: Sequence[str], values: Column, name: str) -> DataFrame:
    """Kept columns and one element per row; empty and null arrays give no row."""
    rows = df.select(*keep, F.posexplode_outer(values).alias("_at", name))
    return rows.filter(F.col("_at").isNotNull()).drop("_at")


def unfold_structs(df: DataFrame, keep: Sequence[str], structs: Column) -> DataFrame:
    """Kept columns and the fields of one struct per row."""
    return unfold(df, keep, structs, "_element").select(*keep, "_element.*")
