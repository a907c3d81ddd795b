"""Reading logs and sheets, writing sheets and models, merging keyed sheets."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clicksieve.operators.aggregate import same_keys


def day_list(start: str, days: int) -> list[str]:
    """``days`` consecutive days from ``start``, as yyyyMMdd."""
    first = datetime.strptime(start, "%Y%m%d")
    return [(first + timedelta(days=i)).strftime("%Y%m%d") for i in range(days)]


def read_log(spark: SparkSession, path: str, day: str | None = None, schema: str | StructType | None = None) -> DataFrame:
    """A click log, or one day of a log partitioned by ``day``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    log = reader.parquet(path)
    return log if day is None else log.filter(F.col("day") == day)


def read_days(spark: SparkSession, path: str, start: str, days: int) -> DataFrame:
    """Consecutive days of a partitioned log; only their folders are read."""
    typed = spark.read.option("basePath", path).parquet(path)
    wanted = day_list(start, days)
    return typed.withColumn("day", F.col("day").cast("string")).filter(F.col("day").isin(wanted))


def read_sheet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header, all columns text. Naming the columns saves a look at the file."""
    reader = spark.read.option("header", True)
    if columns is not None:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    return reader.csv(path if isinstance(path, str) else list(path))


def write_sheet(df: DataFrame, path: str, one_file: bool = True) -> None:
    """CSV with a header, replacing what was there. One file is for small reports only.

    The rows of the report move to one task; what makes them stays spread.
    """
    out = df.repartition(1) if one_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def save_model(df: DataFrame, path: str, by: Sequence[str] = ("day",)) -> None:
    """A model is a table: parquet, one folder per day."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    model = spark.read.parquet(path)
    return model.withColumn("day", F.col("day").cast("string")) if "day" in model.columns else model


def daily_union(
    spark: SparkSession, template: str, start: str, end: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The same report over all days from ``start`` to ``end``, with the day as ``date``.

    ``template`` holds ``{day}``. One scan reads all days; the day comes from
    the path of the file.
    """
    if int(end) <= int(start):
        raise ValueError(f"the end {end} must lie after the start {start}")
    days = (datetime.strptime(end, "%Y%m%d") - datetime.strptime(start, "%Y%m%d")).days + 1
    head = template.split("{day}")[0].rstrip("/").rsplit("/", 1)[-1]
    frame = read_sheet(spark, [template.format(day=d) for d in day_list(start, days)], columns)
    pattern = (head if not template.split("{day}")[0].endswith("/") else head + "/") + r"(\d{8})"
    return frame.select("*", F.regexp_extract("_metadata.file_path", pattern, 1).alias("date"))


def promote_report(spark: SparkSession, temp_path: str, path: str, columns: Sequence[str] | None = None) -> None:
    """Copy a checked report to its final place."""
    write_sheet(read_sheet(spark, temp_path, columns), path)


def model_history(models: DataFrame, day: str, start: int = 1, days: int = 7) -> DataFrame:
    """Models of ``days`` previous days, the nearest first; a missing day gives nulls."""
    back = [(datetime.strptime(day, "%Y%m%d") - timedelta(days=g)).strftime("%Y%m%d") for g in range(start, start + days)]
    wanted = models.sparkSession.createDataFrame(list(enumerate(back, start)), "gap int, day string")
    return wanted.join(models.filter(F.col("day").isin(back)), "day", "left").orderBy("gap")


def patch_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows of ``old`` with the values of ``new`` where the key is known there."""
    renamed = new.select(*keys, F.lit(True).alias("_hit"), *[F.col(v).alias(f"_new_{v}") for v in values])
    joined = same_keys(old, renamed, keys)
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in old.columns])


def upsert_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Known keys take the new values, unknown keys are added."""
    a, b = old.alias("a"), new.alias("b")
    cond = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = a.withColumn("_a", F.lit(1)).alias("a").join(b.withColumn("_b", F.lit(1)).alias("b"), cond, "full_outer")
    pick = lambda c: F.when(F.col("b._b") == 1, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))
    return both.select(*[pick(c).alias(c) for c in [*keys, *values]])


def exclude_listed(df: DataFrame, spark: SparkSession, list_path: str, col: str = "site") -> DataFrame:
    """Rows whose value is not a line of the text list."""
    listed = spark.read.text(list_path).select(F.trim("value").alias(col)).distinct()
    return df.join(listed, col, "left_anti")


def train_mix(
    natural: DataFrame, bad: DataFrame, id_col: str, natural_rate: float, bad_rate: float
) -> tuple[DataFrame, float]:
    """Sampled natural (label 0) and bad (label 1) rows, and the bad/natural ratio.

    A row is drawn by a hash of its id, so the sample is the same on every run.
    """
    drawn = lambda rate: F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast(
        "bigint") < int(rate * (1 << 32))
    mix = natural.filter(drawn(natural_rate)).withColumn("label", F.lit(0)).unionByName(
        bad.filter(drawn(bad_rate)).withColumn("label", F.lit(1)))
    counts = {r["label"]: r["count"] for r in mix.groupBy("label").count().collect()}
    return mix, counts.get(1, 0) / counts[0] if counts.get(0) else float("nan")
