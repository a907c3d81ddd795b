"""Check-status scales and the rule operators that produce and combine them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The status scale, the finer scale and the rule families.
STATUS = {"unknown": 0, "error": 1, "remit": 2, "real": 3, "anomaly": 4, "spam": 5}
STATUS_FINE = {
    "unknown": 0, "error": 1, "remit": 2, "real": 3,
    "anomalyLow": 4, "anomalyMid": 5, "anomalyHigh": 6, "spam": 8,
}
RULE_FAMILIES = ("CommercialAntiSpam", "BusyUser", "DistributeDisorder", "InvalidBehavior")

UNKNOWN, ERROR, REMIT, REAL, ANOMALY, SPAM = range(6)


def _checks(names: Sequence[str]) -> list[Column]:
    if not names:
        raise ValueError("at least one check column is needed")
    return [F.coalesce(F.col(n), F.lit(UNKNOWN)) for n in names]


def _sum(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def worst(names: Sequence[str]) -> Column:
    """Highest status of a row; a missing status counts as unknown."""
    cols = _checks(names)
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def fired(names: Sequence[str]) -> Column:
    """Number of checks at anomaly or above."""
    return _sum([(c >= ANOMALY).cast("int") for c in _checks(names)])


def anomalies(names: Sequence[str]) -> Column:
    """Number of checks that are exactly anomaly."""
    return _sum([(c == ANOMALY).cast("int") for c in _checks(names)])


def any_match(text: Column, patterns: Sequence[str]) -> Column:
    """True when one of the regular expressions is found in the text."""
    return text.rlike("|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


def check_rule(
    spam: str | Column | None = None,
    anomaly: str | Column | None = None,
    remit: Sequence[str] = (),
    channel: str = "srcg",
) -> Column:
    """Status of a rule: remit, spam, anomaly, else real."""
    if spam is None and anomaly is None:
        raise ValueError("a rule needs a spam or an anomaly expression")
    as_col = lambda e: F.expr(e) if isinstance(e, str) else e
    branches = []
    if remit:
        branches.append((any_match(F.col(channel), remit), REMIT))
    if spam is not None:
        branches.append((as_col(spam), SPAM))
    if anomaly is not None:
        branches.append((as_col(anomaly), ANOMALY))
    out = F.when(branches[0][0], F.lit(branches[0][1]))
    for cond, value in branches[1:]:
        out = out.when(cond, F.lit(value))
    return out.otherwise(F.lit(REAL))


def guarded_rule(verdict: Column, remit: Sequence[str] = (), channel: str = "srcg") -> Column:
    """A computed verdict; a null one means it could not be computed: error."""
    safe = F.coalesce(verdict, F.lit(ERROR))
    if not remit:
        return safe
    return F.when(any_match(F.col(channel), remit), F.lit(REMIT)).otherwise(safe)


def status_label(names: Sequence[str], min_anomalies: int = 3) -> Column:
    """1 when a check is spam or enough checks are anomaly, else 0."""
    spam = reduce(lambda a, b: a | b, [c == SPAM for c in _checks(names)])
    return (spam | (anomalies(names) >= min_anomalies)).cast("int")


def check_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "Check" in c]


def valid_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows at most real, or anomaly with fewer than three anomaly checks."""
    top = worst(names)
    return df.filter((top <= REAL) | ((top == ANOMALY) & (anomalies(names) < 3)))
