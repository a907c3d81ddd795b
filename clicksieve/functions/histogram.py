"""Histogram texts ``key:count|key:count`` and numeric binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.functions.unfold import unfold_structs


def clean_key(key: Column) -> Column:
    """Key without white space and the separators of the text form."""
    bare = F.regexp_replace(key, r"[\s|#:,]", "")
    return F.when(bare == "", F.lit("unk")).otherwise(bare)


def entries(text: Column) -> Column:
    """Parsed ``array<struct<key,n>>``; malformed parts are dropped."""
    parts = F.filter(F.split(text, r"\|"), lambda s: F.size(F.split(s, ":")) == 2)
    parsed = F.transform(parts, lambda s: F.struct(
        F.split(s, ":")[0].alias("key"), F.split(s, ":")[1].try_cast("double").alias("n")))
    return F.filter(parsed, lambda e: e["n"].isNotNull())


def explode_histogram(df: DataFrame, col: str, key: str = "k", n: str = "n") -> DataFrame:
    """One row per entry of a histogram text column, other columns kept."""
    rest = [c for c in df.columns if c != col]
    return unfold_structs(df, rest, entries(F.col(col))).toDF(*rest, key, n)


def write_entries(pairs: Column) -> Column:
    """Text of an ``array<struct<key,n>>`` in its given order."""
    return F.array_join(
        F.transform(pairs, lambda e: F.concat(e["key"], F.lit(":"), e["n"].cast("bigint").cast("string"))),
        "|",
    )


def write_shares(pairs: Column, total: Column) -> Column:
    """Text ``key:share`` with three decimals."""
    return F.array_join(
        F.transform(pairs, lambda e: F.format_string("%s:%.3f", e["key"], e["n"] / total)), "|")


def edge_bin(value: Column, edges: Sequence[float]) -> Column:
    """First edge not below the value, else the last edge; non-numbers are null."""
    ordered = sorted(edges)
    number = value.try_cast("double")
    literal = F.array(*[F.lit(e) for e in ordered])
    first = F.get(F.filter(literal, lambda e: number <= e), F.lit(0))
    return F.when(number.isNotNull(), F.coalesce(first, F.lit(ordered[-1])))


def log_gap_bucket(gap: Column) -> Column:
    """Rounded natural log of a gap, at least 1; an unreadable gap counts as 20."""
    number = F.greatest(F.coalesce(gap.try_cast("double"), F.lit(20.0)), F.lit(1.0))
    return F.floor(F.ln(number) + 0.5)


def action_count_token(count: Column, most: int = 20) -> Column:
    """``n:1`` for n actions, n capped; empty for none."""
    size = F.least(count, F.lit(most))
    return F.when(size > 0, F.concat(size.cast("string"), F.lit(":1"))).otherwise(F.lit(""))
