"""Text classes, cleaning and small numeric helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a cleaned query keeps (fixed values): CJK, digits, letters.
_NOT_KEPT = "[^一-龥0-9a-zA-Z]"


def first_match_class(text: Column, rules: Sequence[tuple[str, str | Sequence[str]]], default: str = "unk") -> Column:
    """Class of the first rule (class, patterns) found in the text."""
    out = None
    for name, patterns in rules:
        found = text.rlike(patterns if isinstance(patterns, str) else "|".join(f"(?:{p})" for p in patterns))
        out = F.when(found, F.lit(name)) if out is None else out.when(found, F.lit(name))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def search_entrance(src: Column, patterns: Sequence[str]) -> Column:
    """``search1`` when a pattern is found, else ``search2``."""
    return first_match_class(src, [("search1", patterns)], "search2")


def clean_query(text: Column) -> Column:
    return F.regexp_replace(text, _NOT_KEPT, "")


def product_token(agent: Column) -> Column:
    """Last product of a user agent, without its version."""
    return F.split(F.element_at(F.split(agent, " "), -1), "/")[0]


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def split_key(key: Column, names: Sequence[str], sep: str = "#") -> list[Column]:
    """Columns of a joined key."""
    parts = F.split(key, sep)
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]
