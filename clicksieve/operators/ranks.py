"""Places of rows in their groups, without a task that holds a group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.session import keep_table

# Bits that Spark's increasing ids leave for the rows of a partition.
_ROW_BITS = 33


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], name: str = "place") -> DataFrame:
    """``df`` as a table with the place of each row in its group, from 0.

    Rows are dealt by ranges of (group, order), so a hot group spreads over many
    partitions and each row knows its place inside one. What stands before a
    partition is a running sum over one row per (group, partition). ``df`` is
    computed twice, for the ranges and for the rows: give a written table. Rows
    that are equal in all of ``order`` get their places in any order; nulls go
    first.
    """
    names = [*df.columns, "__at"]
    table = keep_table(
        df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
        .withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", _ROW_BITS)
    starts = table.groupBy(*group, part.alias("__part")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")
    keys = [F.col(g).alias(f"__g{i}") for i, g in enumerate(group)]
    shifts = starts.select(*keys, F.col("__part").alias("__p"), shift.alias("__shift"))
    rows = table.withColumn("__part", part)
    on = [rows["__part"] == shifts["__p"], *[rows[g].eqNullSafe(shifts[f"__g{i}"]) for i, g in enumerate(group)]]
    return rows.join(shifts, reduce(lambda a, b: a & b, on)).select(
        *names[:-1], (F.col("__at") + F.col("__shift")).alias(name))


def running(
    df: DataFrame, group: Sequence[str], place: str, values: dict[str, tuple], block: int = 4096,
) -> DataFrame:
    """``df`` with running values over the rows before each row of its group.

    ``values`` maps an output column to (aggregate, column): an aggregate that
    merges, as ``F.sum``, ``F.min`` or ``F.bit_xor``. Rows are cut into blocks of
    places; a window runs inside a block, another one over the blocks' totals, so
    no task holds a group. The first row of a group gets null.
    """
    names = df.columns
    rows = df.withColumn("__b", F.floor(F.col(place) / block))
    inside = Window.partitionBy(*group, "__b").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*group, "__b").agg(*[f(c).alias(f"__{n}") for n, (f, c) in values.items()])
    keys = [F.col(g).alias(f"__g{i}") for i, g in enumerate(group)]
    before = totals.select(
        *keys, F.col("__b").alias("__c"), *[f(F.col(f"__{n}")).over(across).alias(f"__{n}") for n, (f, _) in values.items()]
    ).filter(F.col("__c") > 0)
    rows = rows.select(*names, "__b", *[f(c).over(inside).alias(n) for n, (f, c) in values.items()])
    on = [rows["__b"] == before["__c"], *[rows[g].eqNullSafe(before[f"__g{i}"]) for i, g in enumerate(group)]]
    joined = rows.join(before, reduce(lambda a, b: a & b, on), "left")
    return joined.select(*names, *[_merged(f, F.col(f"__{n}"), F.col(n)).alias(n) for n, (f, _) in values.items()])


def _merged(aggregate, before: Column, here: Column) -> Column:
    """An aggregate's value over two parts, either of which may be null."""
    both = {F.sum: lambda: before + here, F.min: lambda: F.least(before, here), F.max: lambda: F.greatest(before, here),
            F.bit_xor: lambda: before.bitwiseXOR(here)}[aggregate]()
    return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(both)
