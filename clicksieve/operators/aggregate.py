"""Group features: counts, distinct counts, frequency statistics, histograms.

Every operator aggregates on ``(group, key)`` first, where Spark combines on
the map side, and only then on the group. A group that holds a third of the
log therefore reaches one task as its distinct keys, already counted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.functions.histogram import clean_key, entries, write_entries, write_shares
from clicksieve.functions.unfold import unfold_structs

# Keys in the text of a group by default.
TEXT_KEYS = 1000

_STATS = {
    "Max": lambda n: F.max(n), "Min": lambda n: F.min(n),
    "Mean": lambda n: F.avg(n), "Dev": lambda n: F.var_pop(n),
}


# A1: one pass over the log for all statistics of a grouping -----------------

@dataclass(frozen=True)
class Scalar:
    """A statistic that merges: ``kind`` is count, sum, min or max of ``value``."""

    name: str
    kind: str
    value: Column


@dataclass(frozen=True)
class Part:
    """One field of a user's own statistic.

    ``value`` is what a row adds, ``merge`` the aggregate that joins two values, in
    any order and grouping (``F.sum``, ``F.max``, ``F.bit_or``, ...), ``start`` the
    value of a group without any.
    """

    value: Column
    merge: Callable[[Column], Column]
    start: Column | None = None


@dataclass(frozen=True)
class Statistic:
    """A user's own statistic: fields that merge, and what they give in the end.

    Spark sums the fields up on the map side, as it does for its own aggregates.
    """

    name: str
    parts: dict[str, Part]
    finish: Callable[[dict[str, Column]], Column]


@dataclass(frozen=True)
class Keyed:
    """Statistics over the histogram of ``key``; rows with a null key are skipped.

    ``outputs`` maps an output column to distinct, total, max, min, mean, dev,
    share (of the top key) or top (the key with the largest weight), or to a
    function of weight and key that aggregates them. userTotal, userShare and
    userTop are total, share and top with the distinct users of a key as weight.
    """

    name: str
    key: Column
    outputs: dict[str, str | Callable[[Column, Column], Column]]
    weight: Column | None = None

    @property
    def counts_users(self) -> bool:
        return any(isinstance(kind, str) and kind.startswith("user") for kind in self.outputs.values())


def _keyed_output(kind: str | Callable[[Column, Column], Column], here: Column) -> Column:
    n, k = F.when(here, F.col("_w")), F.when(here, F.col("_k"))
    if callable(kind):
        return kind(n, k)
    if kind.startswith("user"):
        users = F.col("_users").cast("double")
        n = F.when(here, users)
        return {
            "userTotal": lambda: F.coalesce(F.sum(n), F.lit(0.0)),
            "userShare": lambda: F.coalesce(F.try_divide(F.max(n), F.sum(n)), F.lit(0.0)),
            "userTop": lambda: F.min_by(k, F.when(here, F.struct(-users, F.col("_k")))),
        }[kind]()
    return {
        "distinct": lambda: F.count(k),
        "total": lambda: F.coalesce(F.sum(n), F.lit(0.0)),
        "max": lambda: F.coalesce(F.max(n), F.lit(-1.0)),
        "min": lambda: F.coalesce(F.min(n), F.lit(-1.0)),
        "mean": lambda: F.coalesce(F.avg(n), F.lit(-1.0)),
        "dev": lambda: F.coalesce(F.var_pop(n), F.lit(-1.0)),
        "share": lambda: F.coalesce(F.try_divide(F.max(n), F.sum(n)), F.lit(0.0)),
        # largest weight, then smallest key
        "top": lambda: F.min_by(k, F.when(here, F.struct(-F.col("_w"), F.col("_k")))),
    }[kind]()


def _fields(scalars: Sequence[Scalar | Statistic]) -> tuple[list[tuple], list[Callable[[], Column]]]:
    """(row value, first aggregate, merging aggregate) of every field, and each statistic over the merged fields."""
    first = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    fields, results = [], []
    for s in scalars:
        at = len(fields)
        if isinstance(s, Scalar):
            fields.append((s.value, first[s.kind], F.sum if s.kind == "count" else first[s.kind]))
            results.append(F.col(f"_s{at}").alias(s.name))
            continue
        fields += [(p.value, p.merge, p.merge) for p in s.parts.values()]
        merged = {n: F.col(f"_s{at + i}") if p.start is None else F.coalesce(f"_s{at + i}", p.start)
                  for i, (n, p) in enumerate(s.parts.items())}
        results.append(s.finish(merged).alias(s.name))
    return fields, results


def group_features(
    df: DataFrame, dims: Sequence[str], scalars: Sequence[Scalar | Statistic] = (), keyed: Sequence[Keyed] = (),
    user: Column | None = None,
) -> DataFrame:
    """All scalar and keyed statistics of a grouping from one scan.

    A row turns into one entry for the scalars and one per keyed feature. The
    entries are summed by (dims, feature, key), then by dims. Outputs that count
    users need ``user``: entries of their features are summed by (dims, feature,
    key, user) first, so each user of a key is one row.
    """
    fields, results = _fields(scalars)
    if not keyed:
        summed = df.groupBy(*dims).agg(*[first(value).alias(f"_s{i}") for i, (value, first, _) in enumerate(fields)])
        return summed.select(*dims, *results)
    by_user = any(s.counts_users for s in keyed)
    if by_user and user is None:
        raise ValueError("outputs that count users need the user column")
    who = lambda s: [(user.cast("string") if s is not None and s.counts_users else F.lit(None).cast("string")).alias("u")] \
        if by_user else []
    if by_user:
        df, user = _users_together(df, dims, user), F.col("_u")
    base = df.select(
        *dims,
        *[value.alias(f"_s{i}") for i, (value, _, _) in enumerate(fields)],
        F.explode(F.array(
            F.struct(F.lit(-1).alias("f"), F.lit(None).cast("string").alias("k"), F.lit(0.0).alias("w"), *who(None)),
            *[
                F.struct(
                    F.lit(i).alias("f"), s.key.cast("string").alias("k"),
                    (F.lit(1.0) if s.weight is None else s.weight.cast("double")).alias("w"), *who(s))
                for i, s in enumerate(keyed)
            ],
        )).alias("_e"),
    ).filter((F.col("_e.f") == -1) | F.col("_e.k").isNotNull())
    own = F.col("_e.f") == -1
    keys = [F.col("_e.f").alias("_f"), F.col("_e.k").alias("_k")] + ([F.col("_e.u").alias("_u")] if by_user else [])
    counted = base.groupBy(*dims, *keys).agg(
        F.sum("_e.w").alias("_w"),
        *[first(F.when(own, F.col(f"_s{i}"))).alias(f"_s{i}") for i, (_, first, _) in enumerate(fields)],
    )
    merged = [merge(f"_s{i}").alias(f"_s{i}") for i, (_, _, merge) in enumerate(fields)]
    if by_user:
        counted = counted.groupBy(*dims, "_f", "_k").agg(F.sum("_w").alias("_w"), F.count("_u").alias("_users"), *merged)
    outs = [(name, _keyed_output(kind, F.col("_f") == i)) for i, s in enumerate(keyed) for name, kind in s.outputs.items()]
    rows = counted.groupBy(*dims).agg(*merged, *[c.alias(name) for name, c in outs])
    return rows.select(*dims, *results, *[name for name, _ in outs])


def _users_together(df: DataFrame, dims: Sequence[str], user: Column) -> DataFrame:
    """The rows with the user as text in ``_u``, those of one user of a group side by side.

    A row has an entry per feature, and the entries of a user repeat the same keys: on
    rows that lie together Spark combines them before the shuffle, where rows in any
    order would send nearly every entry on. A rebalance moves the rows, not their
    entries, and AQE splits the part of a user that holds much of the log.
    """
    return df.withColumn("_u", user.cast("string")).hint("rebalance", *[F.col(d) for d in dims], F.col("_u"))


def key_distributions(df: DataFrame, dims: Sequence[str], user: Column, keys: dict[str, Column]) -> DataFrame:
    """Distributions of many keys by rows and by users, as (dims, feature, k, n, users), from one scan.

    Rows are summed by (dims, feature, key, user) first, so a frequent key of a hot
    group spreads over its users. Rows without a user count in ``n`` only.
    """
    entries_ = F.array(*[F.struct(F.lit(i).alias("_f"), c.cast("string").alias("k")) for i, c in enumerate(keys.values())])
    near = _users_together(df, dims, user)
    rows = unfold_structs(near.select(*dims, "_u", entries_.alias("_e")), [*dims, "_u"], F.col("_e"))
    per_user = rows.filter(F.col("k").isNotNull()).groupBy(*dims, "_f", "k", "_u").agg(F.count(F.lit(1)).alias("n"))
    per_key = per_user.groupBy(*dims, "_f", "k").agg(F.sum("n").alias("n"), F.count("_u").alias("users"))
    name = F.get(F.array(*[F.lit(n) for n in keys]), F.col("_f"))
    return per_key.select(*dims, name.alias("feature"), "k", "n", "users")


# A2-A7 ------------------------------------------------------------------------

def distinct_count(
    df: DataFrame, dims: Sequence[str], outputs: dict[str, Column], approx: bool = False
) -> DataFrame:
    """Distinct values per group; give ``F.when(cond, col)`` to count under a condition."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(*dims).agg(*[count(c).alias(n) for n, c in outputs.items()])


def freq_stats(
    df: DataFrame, dims: Sequence[str], value: Column, name: str, stats: Sequence[str] = tuple(_STATS)
) -> DataFrame:
    """Distinct values of a group and statistics of how often each occurs.

    ``Dev`` is the population variance. Groups without a value give -1.
    """
    counted = df.groupBy(*dims, value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    n = F.when(F.col("_v").isNotNull(), F.col("_n").cast("double"))
    return counted.groupBy(*dims).agg(
        F.count("_v").alias(name),
        *[F.coalesce(_STATS[s](n), F.lit(-1.0)).alias(name + s) for s in stats],
    )


def pooled_distinct(
    df: DataFrame, dims: Sequence[str], values: Sequence[Column], name: str, stats: Sequence[str] = ()
) -> DataFrame:
    """Distinct values over several columns taken together."""
    pooled = df.select(*dims, F.explode(F.array(*[v.cast("string") for v in values])).alias("_p"))
    return freq_stats(pooled, dims, F.col("_p"), name, stats)


@dataclass(frozen=True)
class Numeric:
    """Count of a column's values, or their sum; optionally under a condition
    and only in rows of given types. Array columns count their elements."""

    name: str
    value: Column
    total: bool = False
    where: Column | None = None
    types: Sequence[str] = ()
    array: bool = False

    def agg(self, type_col: str = "tp") -> Column:
        if self.array:
            each = (
                F.aggregate(self.value, F.lit(0.0), lambda a, v: a + v.cast("double"))
                if self.total else F.size(self.value).cast("double")
            )
        else:
            each = self.value.cast("double") if self.total else F.when(self.value.isNotNull(), F.lit(1.0))
        cond = self.where
        if self.types:
            of_type = F.col(type_col).isin(list(self.types))
            cond = of_type if cond is None else cond & of_type
        return F.coalesce(F.sum(each if cond is None else F.when(cond, each)), F.lit(0.0)).alias(self.name)


def numeric_features(df: DataFrame, dims: Sequence[str], features: Sequence[Numeric]) -> DataFrame:
    return df.groupBy(*dims).agg(*[f.agg() for f in features])


def weighted_histogram(
    df: DataFrame, dims: Sequence[str], key: Column, weight: Column, where: Column | None = None
) -> DataFrame:
    """Distinct keys, largest weight and its share of the total per group."""
    keep = F.lit(True) if where is None else where
    summed = df.groupBy(*dims, F.when(keep, key).alias("_k")).agg(
        F.sum(F.when(keep, weight.cast("double"))).alias("_w"))
    w = F.when(F.col("_k").isNotNull(), F.col("_w"))
    total = F.sum(w)
    return summed.groupBy(*dims).agg(
        F.count("_k").alias("keys"),
        F.coalesce(F.max(w), F.lit(0.0)).alias("max"),
        F.when(total != 0, F.max(w) / total).otherwise(F.lit(0.0)).alias("max_share"),
    )


# A8-A10, T1: histograms ------------------------------------------------------

def histogram(
    df: DataFrame, dims: Sequence[str], key: Column, *, valid: Sequence[str] = (),
    exclude: Sequence[str] = ("null",), where: Column | None = None, clean: bool = True,
) -> DataFrame:
    """Long histogram (dims, k, n) of a key; keys outside ``valid`` become "other"."""
    text = key.cast("string")
    k = clean_key(text) if clean else text
    if valid:
        k = F.when(k.isin(list(valid)), k).otherwise(F.lit("other"))
    rows = (df if where is None else df.filter(where)).filter(key.isNotNull())
    if exclude:
        rows = rows.filter(~text.isin(list(exclude)))
    return rows.groupBy(*dims, k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


def top_entries(hist: DataFrame, dims: Sequence[str], limit: int, n: str = "n", k: str = "k") -> DataFrame:
    """Largest entries per group, smaller key first among equals.

    Spark keeps ``limit`` rows per group before the shuffle as well.
    """
    w = Window.partitionBy(*dims).orderBy(F.desc(n), F.asc(k))
    return hist.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def _sorted_entries() -> Column:
    return F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("k").alias("key")))),
        lambda e: F.struct(e["key"].alias("key"), (-e["m"]).alias("n")),
    )


def value_distribution(
    df: DataFrame, dims: Sequence[str], key: Column, *, limit: int | None = TEXT_KEYS,
    bernoulli: bool = False, **options,
) -> DataFrame:
    """Histogram and share texts by falling count, total, and share of the top value.

    The texts show the ``limit`` most frequent keys, so a group's row stays small;
    total and share are over all keys, and ``histogram`` has them all as rows. With
    ``limit=None`` the text of a group holds all its keys.
    """
    hist = histogram(df, dims, key, **options)
    pairs = _sorted_entries()
    if bernoulli:
        pairs = F.transform(pairs, lambda e: F.struct(e["key"].alias("key"), F.lit(1).alias("n")))
    totals = [F.sum("n").cast("double").alias("total"), (F.max("n") / F.sum("n")).alias("top_share")]
    texts = [write_entries(F.col("_p")).alias("hist"), write_shares(F.col("_p"), F.col("total")).alias("shares")]
    if limit is None:
        return hist.groupBy(*dims).agg(*totals, pairs.alias("_p")).select(*dims, "total", "top_share", *texts)
    shown = top_entries(hist, dims, limit).groupBy(*dims).agg(pairs.alias("_p"))
    return same_keys(hist.groupBy(*dims).agg(*totals), shown, dims).select(*dims, "total", "top_share", *texts)


def bin_edges(style: str, spec: str) -> list[int]:
    """Edges of a frequency binning: ``custom`` lists them, ``bins-max`` spaces them."""
    if style == "custom":
        return sorted({int(e) for e in spec.split(",")})
    bins, most = (int(v) for v in spec.split("-"))
    return sorted({1, *(most // bins * i for i in range(1, bins + 1))})


def freq_of_freq_bins(
    df: DataFrame, dims: Sequence[str], key: Column, edges: Sequence[int], limit: int | None = None
) -> DataFrame:
    """How many keys have a frequency in (previous edge, edge], largest edge first."""
    counted = df.filter(key.isNotNull()).groupBy(*dims, key.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    ordered = sorted(edges)
    edge = F.get(F.filter(F.array(*[F.lit(e) for e in ordered]), lambda e: F.col("_n") <= e), F.lit(0))
    binned = counted.groupBy(*dims, F.coalesce(edge, F.lit(ordered[-1] + 1)).alias("edge")).agg(
        F.count(F.lit(1)).alias("n"))
    pairs = F.reverse(F.array_sort(F.collect_list(F.struct("edge", "n"))))
    if limit:
        pairs = F.slice(pairs, 1, limit)
    return binned.groupBy(*dims).agg(pairs.alias("_p")).select(
        *dims,
        write_entries(F.transform(F.col("_p"), lambda e: F.struct(
            e["edge"].cast("string").alias("key"), e["n"].alias("n")))).alias("bins"))


def merge_histograms(df: DataFrame, dims: Sequence[str], text: str) -> DataFrame:
    """Sum of many histogram texts per group, as (dims, k, n)."""
    return (
        unfold_structs(df, dims, entries(F.col(text)))
        .groupBy(*dims, F.col("key").alias("k")).agg(F.sum("n").alias("n"))
    )


# A18-A25 ----------------------------------------------------------------------

def group_spam_rate(
    df: DataFrame, dims: Sequence[str], flag: str, threshold: float, limit: int = 2000
) -> DataFrame:
    """Flagged clicks, spam clicks and spam rate of each group; whether it is anomalous.

    ``flag`` is text: "1" is spam, any other non-empty text is a judged click.
    """
    judged = F.sum(F.when(F.length(flag) > 0, F.lit(1)).otherwise(F.lit(0)))
    spam = F.sum(F.when(F.col(flag) == "1", F.lit(1)).otherwise(F.lit(0)))
    return df.groupBy(*dims).agg(judged.alias("judged"), spam.alias("spam")).withColumn(
        "rate", F.coalesce(F.try_divide(F.col("spam"), F.col("judged")), F.lit(0.0))
    ).withColumn("anomalous", (F.col("judged") > limit) & (F.col("rate") >= threshold))


def majority_blacklist(df: DataFrame, keys: Sequence[str], checks: Sequence[str]) -> DataFrame:
    """Keys where more than half of the rows are spam (a 5, or two checks >= 4)."""
    from clicksieve.status import SPAM, fired, worst

    spam = (worst(checks) == SPAM) | (fired(checks) >= 2)
    return (
        df.groupBy(*keys).agg(F.avg(spam.cast("double")).alias("spam_share"))
        .filter(F.col("spam_share") > 0.5)
    )


def dominant_position(
    df: DataFrame, dims: Sequence[str], position: Column, threshold: float
) -> DataFrame:
    """Groups whose largest category exceeds a share; smaller position wins a tie."""
    counted = df.groupBy(*dims, position.alias("position")).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*dims).agg(
        F.min_by("position", F.struct(-F.col("n"), F.col("position"))).alias("position"),
        (F.max("n") / F.sum("n")).alias("share"),
    ).filter(F.col("share") > threshold)


def profile_nonneg(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, min and max over non-negative values, mean and deviation over positive ones."""
    out = []
    for c in cols:
        known, positive = F.when(F.col(c) >= 0, F.col(c)), F.when(F.col(c) > 0, F.col(c))
        out += [
            F.avg(known).alias(f"{c}_mean"), F.min(known).alias(f"{c}_min"), F.max(known).alias(f"{c}_max"),
            F.avg(positive).alias(f"{c}_posmean"), F.stddev_samp(positive).alias(f"{c}_posstd"),
        ]
    return df.agg(*out)


def channel_features(
    df: DataFrame, dims: Sequence[str], user: str, search: Column, click: Column,
    adshow: Column, adclick: Column,
) -> DataFrame:
    """Volumes, users and ratios of a channel.

    The four columns hold counts per row. Users are counted from one row per
    (channel, user), so no row is expanded for the distinct counts.
    """
    per_user = df.groupBy(*dims, user).agg(*[
        F.coalesce(F.sum(c.cast("double")), F.lit(0.0)).alias(n)
        for n, c in {"s": search, "c": click, "a": adshow, "k": adclick}.items()
    ])
    users = lambda n: F.sum(F.when((F.col(n) > 0) & F.col(user).isNotNull(), 1).otherwise(0))
    volumes = per_user.groupBy(*dims).agg(
        F.sum("s").alias("SPV"), F.sum("c").alias("CPV"), users("s").alias("SUV"), users("c").alias("CUV"),
        F.sum("a").alias("ADSPV"), F.sum("k").alias("ADCPV"), users("a").alias("ADSUV"),
        users("k").alias("ADCUV"))
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(b))
    ratios = {
        "CTR": ("CPV", "SPV"), "SPV2SUV": ("SPV", "SUV"), "CPV2CUV": ("CPV", "CUV"), "CUV2SUV": ("CUV", "SUV"),
        "ADCPV2ADSPV": ("ADCPV", "ADSPV"), "ADSPV2ADSUV": ("ADSPV", "ADSUV"),
        "ADCPV2ADCUV": ("ADCPV", "ADCUV"), "ADCUV2ADSUV": ("ADCUV", "ADSUV"), "ADCUV2CUV": ("ADCUV", "CUV"),
    }
    return volumes.select("*", *[ratio(a, b).alias(n) for n, (a, b) in ratios.items()])


def channel_catalogue(
    df: DataFrame, dims: Sequence[str], user: Column, classes: dict[str, Column], tops: dict[str, Column],
    per_value: dict[str, Column], *, user_classes: dict[str, Column] | None = None,
    rates: dict[str, tuple[Column, Column]] | None = None, by_users: bool = False,
) -> DataFrame:
    """The shares of a channel's catalogue, from one scan.

    ``classes`` are conditions: the share of rows that meet them (second search,
    suggestion, paging). ``user_classes`` likewise: the share of users with a row that
    meets them (age, life stage). ``rates`` are a sum over another one (ad clicks over
    shown ads). ``tops`` are keys: the share of the most frequent value (click
    position, ad-click hour, industry, query), with ``by_users`` also the share of the
    value that most users have. ``per_value`` are keys: the users per distinct value
    (users per address, per query).
    """
    user_classes, rates = user_classes or {}, rates or {}
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    scalars = [Scalar("_rows", "count", F.lit(1))]
    scalars += [Scalar(f"_c_{n}", "sum", F.when(c, 1).otherwise(0)) for n, c in classes.items()]
    scalars += [Statistic(f"{n}Rate", {"a": Part(a.cast("double"), total), "b": Part(b.cast("double"), total)},
                          lambda p: F.try_divide(p["a"], p["b"])) for n, (a, b) in rates.items()]
    keyed = [Keyed("_user", user, {"_users_": "distinct"})]
    keyed += [Keyed(f"_u_{n}", F.when(c, user), {f"_u_{n}": "distinct"}) for n, c in user_classes.items()]
    keyed += [Keyed(n, c, {f"{n}TopRatio": "share", **({f"{n}UserTopRatio": "userShare"} if by_users else {})})
              for n, c in tops.items()]
    keyed += [Keyed(f"_v_{n}", c, {f"_v_{n}": "distinct"}) for n, c in per_value.items()]
    out = group_features(df, dims, scalars, keyed, user)
    return out.select(
        *dims, *[F.try_divide(F.col(f"_c_{n}"), F.col("_rows")).alias(f"{n}Ratio") for n in classes],
        *[F.try_divide(F.col(f"_u_{n}"), F.col("_users_")).alias(f"{n}UserRatio") for n in user_classes],
        *[f"{n}Rate" for n in rates], *[c for n in tops for c in (f"{n}TopRatio", f"{n}UserTopRatio") if c in out.columns],
        *[F.try_divide(F.col("_users_"), F.col(f"_v_{n}")).alias(f"usersPer{n}") for n in per_value])


def user_features(
    df: DataFrame, user: str, counts: dict[str, Column], distinct: dict[str, Column],
    frequencies: dict[str, Column],
) -> DataFrame:
    """Per user: sums, distinct counts, and distinct counts with max/min frequency."""
    scalars = [Scalar(n, "sum", c.cast("double")) for n, c in counts.items()]
    keyed = [Keyed(n, c, {n: "distinct"}) for n, c in distinct.items()]
    keyed += [
        Keyed(n, c, {n: "distinct", f"{n}Max": "max", f"{n}Min": "min"}) for n, c in frequencies.items()
    ]
    return group_features(df, [user], scalars, keyed)


def same_keys(left: DataFrame, right: DataFrame, dims: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe join of two frames on columns of the same names."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in dims else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"_r_{d}")) for d in dims])
    return left.join(r, cond, how).drop(*[f"_r_{d}" for d in dims])
