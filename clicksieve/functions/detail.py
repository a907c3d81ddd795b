"""Expressions over array and JSON detail columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicksieve.functions.unfold import bind

_AD_FIELDS = {
    "industry": "string", "sub_industry": "string", "location": "string", "pos": "string", "ad_clicknum": "string",
    "ad_clickdetails": "array<struct<click_time:string>>",
}


def ad_schema(*fields: str) -> str:
    """Schema of the details with some of their fields; parsing skips the others."""
    return f"array<struct<{','.join(f'{f}:{_AD_FIELDS[f]}' for f in fields)}>>"


AD_SCHEMA = ad_schema(*_AD_FIELDS)
_DIGITS = "0123456789."

_OPS = {
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
    ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
}


def is_digital(text: Column) -> Column:
    """Only digits and dots, at least one character; null is not digital."""
    return F.coalesce((text != "") & (F.translate(text, _DIGITS, "") == ""), F.lit(False))


@dataclass(frozen=True)
class Condition:
    """``field op literal``; numeric when both sides are digits, else as text."""

    field: str
    op: str
    literal: str

    def test(self, value: Column) -> Column:
        if self.op not in _OPS:
            raise ValueError(f"unknown comparison {self.op}")
        compare = _OPS[self.op]
        text = value.cast("string")
        literal = "" if self.literal == "''" else self.literal
        as_text = compare(text, F.lit(literal))
        if not literal or set(literal) - set(_DIGITS):
            return F.coalesce(as_text, F.lit(False))
        as_number = compare(text.try_cast("double"), F.lit(float(literal)))
        return F.coalesce(F.when(is_digital(text), as_number).otherwise(as_text), F.lit(False))


def keep_where(values: Column, conditions: Column, cond: Condition) -> Column:
    """Values whose condition holds, pairwise for lists of equal length.

    With lists of unequal length one true condition keeps every value.
    """

    def keep(p: Column) -> Column:
        pairwise = F.filter(p["v"], lambda v, i: cond.test(F.get(p["c"], i)))
        return F.when(F.size(p["v"]) == F.size(p["c"]), pairwise).otherwise(
            F.filter(p["v"], lambda v: F.exists(p["c"], cond.test)))

    return bind(F.struct(values.alias("v"), conditions.alias("c")), keep)


def parse_details(text: Column, schema: str = AD_SCHEMA) -> Column:
    """JSON array text to an array of structs; broken text gives an empty array."""
    return F.coalesce(F.from_json(text, schema), F.array().cast(schema))


def _field(structs: Column, name: str) -> Column:
    return F.transform(structs, lambda e: e[name])


def leaf_values(parsed: Column, path: str) -> Column:
    """Flat list of the leaves at ``a.b.c``; arrays on the way are flattened."""
    first, *rest = path.split(".")
    out = F.transform(parsed, lambda e: e[first])
    for step in rest:
        out = _field(F.flatten(out), step)
    return F.filter(out, lambda v: v.isNotNull())


def click_hours(times: Column) -> Column:
    """Hour of day of each epoch-millisecond text; other texts are dropped."""
    readable = F.filter(times, is_digital)
    return F.transform(
        readable, lambda t: F.hour(F.timestamp_millis(t.try_cast("double").cast("bigint")))
    )


def click_locations(parsed: Column) -> Column:
    """``location(pos)`` once per click, for ads with clicks."""
    clicks = lambda e: F.coalesce(e["ad_clicknum"].try_cast("int"), F.lit(0))
    clicked = F.filter(parsed, lambda e: clicks(e) > 0)
    return F.flatten(F.transform(
        clicked,
        lambda e: F.array_repeat(F.concat(e["location"], F.lit("("), e["pos"], F.lit(")")), clicks(e)),
    ))


def top_ad_missing(slots: Column, positions: Column) -> Column:
    """Spam (5) when a top slot was sold but no shown ad stands at position 1."""
    slot = F.split(F.coalesce(slots, F.lit("")), ",")
    sold = F.exists(
        slot, lambda s: (F.size(F.split(s, r"\|")) > 1) & (F.get(F.split(s, r"\|"), F.lit(0)) == "top")
    )
    shown = F.exists(positions, lambda p: p == "1")
    return F.when(sold & ~F.coalesce(shown, F.lit(False)), F.lit(5)).otherwise(F.lit(3))


def arrays_to_text(df, sep: str = "; "):
    """Join every array column of a frame into text."""
    arrays = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
    return df.select(*[
        F.array_join(F.transform(F.col(c), lambda v: v.cast("string")), sep).alias(c)
        if c in arrays else F.col(c)
        for c in df.columns
    ])
