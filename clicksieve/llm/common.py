"""Helpers shared by the operators on documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicksieve.session import scratch_path

# Fixed value: what separates words. Everything else belongs to a word.
BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once below the shared folder and read it from there.

    Cuts the lineage: a lost executor re-reads the files instead of replaying
    what made them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words of a text as an array; a null or blank text has none."""
    clean = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, f"{BLANK}+"))


def null_join(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names that may be null; the left ones stay."""
    other = right.withColumnsRenamed({n: f"__right_{n}" for n in names})
    on = reduce(lambda a, b: a & b, [left[n].eqNullSafe(other[f"__right_{n}"]) for n in names])
    return left.join(other, on, how).drop(*[f"__right_{n}" for n in names])


def replace_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The frame with result columns; an input column of the same name gives way."""
    taken = {c.lower() for c in columns}
    old = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*old, *[c.alias(n) for n, c in columns.items()])


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model may learn labels from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
