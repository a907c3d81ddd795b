"""Browser, system, version and webmail of user-agent and referrer columns.

Each is one expression built from the rule tables. The mixes count rows per
(channel, agent) first, so an expression runs once per distinct agent.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.functions import agent_rules as rules
from clicksieve.functions.unfold import bind

UNKNOWN = "Unknown"
ROBOT = "Robot/Spider"


@dataclass(frozen=True)
class System:
    name: str
    required: tuple[tuple[str, ...], ...]  # own aliases and those of every parent
    excludes: tuple[str, ...]
    device: str


def _lower(words: Sequence[str]) -> tuple[str, ...]:
    return tuple(w.lower() for w in words)


BROWSERS = [b._replace(aliases=_lower(b.aliases), excludes=_lower(b.excludes)) for b in rules.BROWSERS]
WEBMAIL = [(name, _lower(words)) for name, words in rules.WEBMAIL]
WEBKIT_SAFARI = rules.WEBKIT_SAFARI


def _systems() -> list[System]:
    """Rules in the order they are tried: children before their parent."""
    place: dict[str, int] = {}  # the last rule of each name so far
    children: dict[int | None, list[int]] = {}
    for i, rule in enumerate(rules.SYSTEMS):
        children.setdefault(None if rule.parent is None else place[rule.parent], []).append(i)
        place[rule.name] = i

    def under(parent: int | None, above: tuple[tuple[str, ...], ...]) -> list[System]:
        out: list[System] = []
        for i in children.get(parent, []):
            rule = rules.SYSTEMS[i]
            required = (*above, _lower(rule.aliases))
            out += [*under(i, required), System(rule.name, required, _lower(rule.excludes), rule.device)]
        return out

    return under(None, ())


SYSTEMS = _systems()


def _has(text: Column, words: Sequence[str]) -> Column:
    if len(words) == 1:
        return text.contains(words[0])
    return text.rlike("|".join(f"\\Q{w}\\E" for w in words))


def _first(cases: list[tuple[Column, Column]], default: Column) -> Column:
    out = F.when(*cases[0])
    for case in cases[1:]:
        out = out.when(*case)
    return out.otherwise(default)


def _browser_case(agent: Column, value) -> Column:
    lower = F.lower(agent)
    cases = []
    for i, b in enumerate(BROWSERS):
        cond = _has(lower, b.aliases)
        if b.excludes:
            cond = cond & ~_has(lower, b.excludes)
        cases.append((cond, value(i, b)))
    return cases


def browser_rule(agent: Column) -> Column:
    """Index of the first rule that fits; -1 without one."""
    return _first(_browser_case(agent, lambda i, b: F.lit(i)), F.lit(-1))


def browser_name(agent: Column) -> Column:
    return _first(_browser_case(agent, lambda i, b: F.lit(b.name)), F.lit(UNKNOWN))


def browser_type(rule: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(b.kind) for b in BROWSERS]), rule), F.lit("UNKNOWN"))


def browser_engine(rule: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(b.engine) for b in BROWSERS]), rule), F.lit("OTHER"))


def browser_version(agent: Column, rule: Column) -> Column:
    """Struct (full, major, minor) by the pattern of the browser; null when not found.

    Safari without a version of its own is looked up by its engine version.
    """
    of_rule = lambda values: F.get(F.array(*[F.lit(v) for v in values]), rule)
    pattern = of_rule([f"(?i){b.version}" if b.version else None for b in BROWSERS])
    has_minor = of_rule([pattern_groups(b.version) > 2 for b in BROWSERS])
    part = lambda n: F.call_function("regexp_extract", agent, pattern, F.lit(n))
    minor = F.when(has_minor, part(3)).otherwise(F.lit("0"))
    found = F.when(F.regexp_like(agent, pattern), F.struct(
        part(1).alias("full"), part(2).alias("major"), F.when(minor != "", minor).alias("minor")))
    engines = F.create_map(*[F.lit(v) for p in WEBKIT_SAFARI.items() for v in p])
    full = F.try_element_at(engines, F.regexp_extract(agent, r"AppleWebKit/(\d+(?:.\d+){1,2})", 1))
    digits = F.split(full, r"\.")
    safari = [i for i, b in enumerate(BROWSERS) if b.name == "Safari"]
    by_engine = F.when(rule.isin(safari) & full.isNotNull(), F.struct(
        full.alias("full"), F.get(digits, F.lit(0)).alias("major"), F.get(digits, F.lit(1)).alias("minor")))
    return F.coalesce(found, by_engine)


def pattern_groups(pattern: str) -> int:
    return re.compile(pattern).groups


def _system_case(agent: Column, value) -> Column:
    lower = F.lower(agent)
    cases = []
    for s in SYSTEMS:
        cond = reduce(lambda a, b: a & b, [_has(lower, words) for words in s.required])
        if s.excludes:
            cond = cond & ~_has(lower, s.excludes)
        cases.append((cond, value(s)))
    return cases


def system(agent: Column, rule: Column) -> Column:
    """Struct (os, device) of an agent; robots have none."""
    make = lambda name, device: F.struct(F.lit(name).alias("os"), F.lit(device).alias("device"))
    none = make(UNKNOWN, "UNKNOWN")
    robots = [i for i, b in enumerate(BROWSERS) if b.name == ROBOT]
    found = _first(_system_case(agent, lambda s: make(s.name, s.device)), none)
    return F.when(rule.isin(robots), none).otherwise(found)


def webmail_product(referrer: Column) -> Column:
    lower = F.lower(referrer)
    found = _first([(_has(lower, w), F.lit(n)) for n, w in WEBMAIL], F.lit(UNKNOWN))
    return F.when(F.length(referrer) > 1, found).otherwise(F.lit(UNKNOWN))


def version_key(version: Column) -> Column:
    """Sort key: a longer part wins, then its text, then the number of parts."""
    return F.transform(F.split(version, r"\."), lambda p: F.struct(F.length(p).alias("n"), p.alias("p")))


# Jobs ------------------------------------------------------------------------

def per_agent(df: DataFrame, dims: Sequence[str], agent: str) -> DataFrame:
    """Rows per (dims, agent)."""
    return df.groupBy(*dims, F.col(agent).alias("agent")).agg(F.count(F.lit(1)).alias("n"))


def _mix(counted: DataFrame, dims: Sequence[str], cols: dict[str, Column]) -> DataFrame:
    return counted.groupBy(*dims, *[c.alias(n) for n, c in cols.items()]).agg(F.sum("n").alias("n"))


def browser_mix(df: DataFrame, dims: Sequence[str], agent: str) -> DataFrame:
    """Rows and share of each browser; the total of a group comes from its few browsers."""
    named = per_agent(df, dims, agent).withColumn("browser", browser_name(F.col("agent")))
    mix = _mix(named, dims, {"browser": F.col("browser")})
    return mix.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*dims)))


def os_mix(df: DataFrame, dims: Sequence[str], agent: str) -> DataFrame:
    found = per_agent(df, dims, agent).withColumn("_r", browser_rule(F.col("agent")))
    found = found.withColumn("_s", system(F.col("agent"), F.col("_r")))
    return _mix(found, dims, {"os": F.col("_s.os"), "device": F.col("_s.device")})


def versions(df: DataFrame, dims: Sequence[str], agent: str) -> DataFrame:
    """Rows per (dims, browser, kind, engine, full, major, minor)."""
    names = F.array(*[F.lit(b.name) for b in BROWSERS])
    found = bind(browser_rule(F.col("agent")), lambda r: F.struct(
        F.coalesce(F.get(names, r), F.lit(UNKNOWN)).alias("browser"),
        browser_type(r).alias("kind"), browser_engine(r).alias("engine"),
        browser_version(F.col("agent"), r).alias("version")))
    counted = per_agent(df, dims, agent).withColumn("_v", found)
    return _mix(counted, dims, {
        "browser": F.col("_v.browser"), "kind": F.col("_v.kind"), "engine": F.col("_v.engine"), "full": F.col("_v.version.full"),
        "major": F.col("_v.version.major"), "minor": F.col("_v.version.minor")})


def latest_version(df: DataFrame, agent: str) -> DataFrame:
    """Highest version seen per browser."""
    best = versions(df, [], agent).groupBy("browser").agg(
        F.max_by("full", version_key(F.col("full"))).alias("latest"))
    return best.filter(F.col("latest").isNotNull())


def referrer_mix(df: DataFrame, dims: Sequence[str], referrer: str) -> DataFrame:
    named = per_agent(df, dims, referrer).withColumn("product", webmail_product(F.col("agent")))
    return _mix(named, dims, {"product": F.col("product")})
