"""Row features written as SQL expressions, and column selection by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expr_feature(df: DataFrame, name: str, text: str) -> DataFrame:
    """``name = expression``. Write divisions as ``try_divide``: a zero gives null."""
    return df.withColumn(name, F.expr(text))


def expr_score(df: DataFrame, name: str, source: str, text: str, default: float) -> DataFrame:
    """The source column where the expression holds, else the default score."""
    return df.withColumn(name, F.when(F.expr(text), F.col(source)).otherwise(F.lit(default)))


def conditional_feature(
    df: DataFrame, name: str, branches: Sequence[tuple[str, str]], default: str
) -> DataFrame:
    """Value of the first (condition, value) whose condition holds, else the default."""
    if not branches:
        raise ValueError("a conditional feature needs an if expression")
    out = F.when(F.expr(branches[0][0]), F.expr(branches[0][1]))
    for cond, value in branches[1:]:
        out = out.when(F.expr(cond), F.expr(value))
    return df.withColumn(name, out.otherwise(F.expr(default)))


def select_pattern(
    df: DataFrame, keep: Sequence[str], parts: Sequence[str] = ("Count", "Score"),
    without: Sequence[str] = ("Check",), labels: dict[str, Column] | None = None,
) -> DataFrame:
    """Named columns, then those whose name has one of ``parts`` and none of ``without``."""
    found = [
        c for c in df.columns
        if c not in keep and any(p in c for p in parts) and not any(w in c for w in without)]
    return df.select(*keep, *found, *[c.alias(n) for n, c in (labels or {}).items()])


def rule_pairs_of_row(names: Column) -> Column:
    """All unordered pairs of an array, smaller value first."""
    return F.flatten(F.transform(names, lambda a: F.transform(
        F.filter(names, lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
