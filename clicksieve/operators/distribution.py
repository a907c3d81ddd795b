"""Comparison of group histograms with a standard distribution."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.functions.histogram import write_entries, write_shares
from clicksieve.operators.aggregate import same_keys

EPSILON = 1e-7

Standard = dict[str, tuple[float, float]]  # key -> (mean share, deviation)


def complete_keys(hist: DataFrame, dims: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Histogram with the missing standard keys of each group added as zeros."""
    zeros = hist.select(*dims).distinct().select(
        *dims, F.explode(F.array(*[F.lit(k) for k in keys])).alias("k"), F.lit(0).cast("bigint").alias("n"))
    return hist.select(*dims, "k", "n").unionByName(zeros).groupBy(*dims, "k").agg(F.sum("n").alias("n"))


def relative_entropy(hist: DataFrame, dims: Sequence[str], p: str, q: str) -> DataFrame:
    """KL(P || Q) in nats per group, both normalised; q gets 1e-7 added, a zero p is 1e-7."""
    sums = hist.groupBy(*dims).agg(F.sum(p).alias("_sp"), F.sum(q).alias("_sq"))
    joined = same_keys(hist, sums, dims)
    share = F.col(p) / F.col("_sp")
    ps = F.when(share == 0, F.lit(EPSILON)).otherwise(share)
    term = ps * F.ln(ps / (F.col(q) / F.col("_sq") + EPSILON))
    return joined.groupBy(*dims).agg(F.sum(term).alias("kl"))


def share_excess(
    hist: DataFrame, dims: Sequence[str], p: str, q: str, threshold: float = 0.0
) -> DataFrame:
    """Positions whose observed share q exceeds the standard share p by more than a threshold."""
    sums = hist.groupBy(*dims).agg(F.sum(p).alias("_sp"), F.sum(q).alias("_sq"))
    excess = F.col(q) / F.col("_sq") - F.col(p) / F.col("_sp")
    return same_keys(hist, sums, dims).withColumn("excess", excess).filter(
        F.col("excess") > threshold).drop("_sp", "_sq")


@dataclass(frozen=True)
class Remit:
    """Other mean and deviation for listed keys, in groups where ``where`` holds.

    ``where`` reads the group columns and ``top_key``, the largest key.
    """

    where: Column
    values: Standard = field(default_factory=dict)


def _array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def distribution_groups(
    hist: DataFrame, dims: Sequence[str], standard: Standard, *, second: Standard | None = None,
    dividend: str = "total", limit: float = 2000, remit: Remit | None = None, n: str = "n", key: str = "k",
) -> DataFrame:
    """Score and excess of each group's histogram against a standard.

    The counts of the standard keys and the total come from one aggregation
    per group, so the standard itself is never joined. Returns per group
    ``total``, ``score`` (the smaller KL of the standards) and ``excess``, a
    map key -> max(0, (share - mean) / deviation). Groups below the limit have
    score 0 and no excess. ``hist`` and ``shares`` are the texts of the standard
    keys by falling count, ``excess_text`` that of the excess by falling value.
    """
    keys = sorted(standard)
    if second is not None and sorted(second) != keys:
        raise ValueError("both standards need the same keys")
    order = F.struct(-F.col("_n"), F.col("_k"))
    summed = hist.groupBy(*dims, F.col(key).alias("_k")).agg(F.sum(n).alias("_n"))
    count_of = [F.coalesce(F.sum(F.when(F.col("_k") == k, F.col("_n"))), F.lit(0)).cast("double") for k in keys]
    groups = summed.groupBy(*dims).agg(
        F.sum("_n").cast("double").alias("total"), F.array(*count_of).alias("_c"),
        F.min_by("_k", order).alias("top_key"),
        # count of the first key in name order, the standard keys included
        F.min_by("_n", "_k").cast("double").alias("_first"), F.min("_k").alias("_first_key"))
    if dividend == "first":
        base = F.when(F.lit(keys[0]) < F.col("_first_key"), F.lit(0.0)).otherwise(F.col("_first"))
    else:
        base = F.col("total") + 0.001

    def kl(std: Standard) -> Column:
        mass = sum(std[k][0] for k in keys)
        p = [std[k][0] / mass or EPSILON for k in keys]
        terms = F.zip_with(_array(p), F.col("_c"), lambda a, c: a * F.ln(
            a / (F.try_divide(c, F.col("total")) + EPSILON)))
        return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)

    def excess(std: Standard) -> Column:
        def one(k: str, i: int) -> Column:
            share = F.coalesce(F.try_divide(F.get("_c", F.lit(i)), base), F.lit(0.0))
            dev = lambda mean, sd: F.greatest((share - mean) / (sd + EPSILON), F.lit(0.0))
            own = dev(*std[k])
            if remit is not None and k in remit.values:
                own = F.when(remit.where, dev(*remit.values[k])).otherwise(own)
            return own
        return F.map_from_arrays(
            F.array(*[F.lit(k) for k in keys]), F.array(*[one(k, i) for i, k in enumerate(keys)]))

    score, chosen = kl(standard), excess(standard)
    if second is not None:
        chosen = F.when(kl(second) < score, excess(second)).otherwise(chosen)
        score = F.least(score, kl(second))
    enough = F.col("total") >= limit
    parts = F.transform(F.array(*[F.lit(k) for k in keys]), lambda k, i: F.struct(
        (-F.get("_c", i)).alias("order"), k.alias("key"), F.get("_c", i).cast("bigint").alias("n")))
    pairs = F.filter(F.array_sort(parts), lambda e: e["n"] > 0)
    out = groups.select(
        *dims, "total", "top_key",
        F.when(enough, score).otherwise(F.lit(0.0)).alias("score"),
        F.when(enough, chosen).otherwise(F.create_map().cast("map<string,double>")).alias("excess"),
        write_entries(pairs).alias("hist"), write_shares(pairs, F.col("total")).alias("shares"))
    above = F.transform(F.filter(F.map_entries("excess"), lambda e: e["value"] > 0), lambda e: F.struct(
        (-e["value"]).alias("order"), e["key"].alias("key")))
    text = F.transform(F.array_sort(above), lambda e: F.format_string("%s:%.3f", e["key"], -e["order"]))
    return out.withColumn("excess_text", F.array_join(text, "|"))


def distribution_users(
    hist: DataFrame, dims: Sequence[str], user: Sequence[str], groups: DataFrame, n: str = "n", key: str = "k"
) -> DataFrame:
    """User score: excess of the group's keys weighted with the user's own counts."""
    keys = [*dims, *user]
    joined = same_keys(hist, groups.select(*dims, "score", "excess"), dims)
    part = F.col(n) * F.coalesce(F.try_element_at("excess", F.col(key)), F.lit(0.0))
    return joined.groupBy(*keys).agg(
        F.coalesce(F.try_divide(F.sum(part), F.sum(n).cast("double")), F.lit(0.0)).alias("user_score"),
        F.max("score").alias("group_score"))


def fit_standard(hist: DataFrame, dims: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Mean and deviation of each key's share over the groups; a missing key has share 0."""
    full = complete_keys(hist, dims, keys)
    totals = full.groupBy(*dims).agg(F.sum("n").alias("_total"))
    shares = same_keys(full, totals, dims).withColumn("_share", F.col("n") / F.col("_total"))
    return shares.groupBy("k").agg(F.avg("_share").alias("mean"), F.stddev_pop("_share").alias("std"))


def redistribute_by_frequency(
    hist: DataFrame, major: Sequence[str], user: Sequence[str], bins: Sequence[float], *,
    sizes: DataFrame | None = None, unit: float = 5000, n: str = "n", key: str = "k",
) -> DataFrame:
    """Each key of a user replaced by the bin of its total in the major group.

    With ``sizes`` (major columns and ``size``) the total is scaled to groups
    of ``unit`` rows. The bin is the first edge not below it, else the last.
    """
    totals = hist.groupBy(*major, key).agg(F.sum(n).cast("double").alias("_t"))
    if sizes is not None:
        totals = same_keys(totals, sizes, major).withColumn("_t", F.col("_t") * unit / F.col("size"))
    edges = sorted(bins)
    first = F.get(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: F.col("_t") <= e), F.lit(0))
    binned = totals.select(*major, key, F.coalesce(first, F.lit(edges[-1])).alias("bin"))
    return (
        same_keys(hist, binned, [*major, key], "inner")
        .groupBy(*major, *user, "bin").agg(F.sum(n).alias("n"))
    )


def lookup(df: DataFrame, model: DataFrame, keys: Sequence[str], defaults: dict[str, Column]) -> DataFrame:
    """Left join with a model table; a missing key gets the default values."""
    joined = same_keys(df, model.select(*keys, *defaults), keys)
    return reduce(lambda d, c: d.withColumn(c, F.coalesce(F.col(c), defaults[c])), defaults, joined)
