"""Settlement sheets, rule reports and score-bin reports over judged rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.functions.unfold import unfold, unfold_structs
from clicksieve.operators.aggregate import same_keys
from clicksieve.status import ANOMALY, REAL, SPAM, STATUS, fired, worst

TOP_PARTNERS = 10  # fixed value: partners shown per rule


def _count(cond: Column) -> Column:
    return F.sum(cond.cast("bigint"))


def final_status(rules: Sequence[str]) -> Column:
    """Highest status of a row, at least real."""
    return F.greatest(worst(rules), F.lit(REAL))


def settlement_sheet(df: DataFrame, rules: Sequence[str], site: str = "site", channel: str = "srcg") -> DataFrame:
    """Searches, statuses and valid rows per site (without scheme) and channel."""
    # One row per (site, channel, pattern of statuses) is enough for the sums.
    judged = df.select(
        F.regexp_replace(F.col(site), "https?://", "").alias("site"), F.col(channel).alias("channel"),
        final_status(rules).alias("_final"), fired(rules).alias("_hits"))
    merged = (F.col("_final") == ANOMALY) & (F.col("_hits") > 2)
    charged = (F.col("_hits") > 2) | (F.col("_final") == SPAM)
    sheet = judged.groupBy("site", "channel").agg(
        F.count(F.lit(1)).alias("searchNum"),
        _count(F.col("_final") == REAL).alias("real"),
        _count(F.col("_final") == ANOMALY).alias("anomaly"),
        _count(F.col("_final") == SPAM).alias("oriSpam"),
        _count(merged).alias("mergedAnomaly"),
        F.sum(F.when(charged, F.col("_hits")).otherwise(0)).alias("_checks"))
    spam = F.col("oriSpam") + F.col("mergedAnomaly")
    return sheet.select(
        "site", "channel", "searchNum", "real", "anomaly", "oriSpam", "mergedAnomaly",
        (F.col("searchNum") - spam).alias("valid"), spam.alias("spam"),
        F.coalesce(F.try_divide(F.col("_checks"), spam), F.lit(0.0)).alias("AvgCheckoutNum"))


def settlement_sheet_pc(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Searches and payable rows (95 % of the valid ones, rounded) per ad space.

    Merged anomalies here need more than two checks that are exactly anomaly.
    """
    from clicksieve.status import anomalies

    judged = df.select(
        "site", F.col("srcg").alias("channel"), "ctype", F.lit("2").alias("jt"),
        F.coalesce("sadspace", F.lit("0")).alias("sadspace"),
        final_status(rules).alias("_final"), anomalies(rules).alias("_soft"))
    spam = (F.col("_final") == SPAM) | ((F.col("_final") == ANOMALY) & (F.col("_soft") > 2))
    valid = F.count(F.lit(1)) - _count(spam)
    return judged.groupBy("site", "channel", "ctype", "jt", "sadspace").agg(
        F.count(F.lit(1)).alias("searchNum"), F.floor(valid * 0.95 + 0.5).alias("valid"))


def rule_status(df: DataFrame, rules: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """Rows per status of every rule, per group of ``dims`` (which may be empty)."""
    patterns = df.groupBy(*dims, *rules).agg(F.count(F.lit(1)).alias("_n"))
    long = patterns.select(*dims, "_n", F.inline(F.array(*[
        F.struct(F.lit(r).alias("algorithm"), F.coalesce(F.col(r), F.lit(0)).alias("_s")) for r in rules])))
    return long.groupBy(*dims, "algorithm").agg(*[
        F.sum(F.when(F.col("_s") == v, F.col("_n")).otherwise(0)).alias(name) for name, v in STATUS.items()])


def rule_status_by_channel(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    site = F.regexp_replace("site", "https?://", "")
    keyed = df.select(F.concat_ws("#", site, F.col("srcg")).alias("channel"), *rules)
    return rule_status(keyed, rules, ["channel"])


def rule_status_total(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    return rule_status(df, rules, [])


def fired_patterns(df: DataFrame, rules: Sequence[str], dims: Sequence[str] = ()) -> DataFrame:
    """Rows per set of fired rules: (dims, fired array in name order, n)."""
    ordered = sorted(rules)
    names = F.filter(
        F.array(*[F.when(F.col(r) >= ANOMALY, F.lit(r)) for r in ordered]), lambda r: r.isNotNull())
    return df.select(*dims, names.alias("fired")).groupBy(*dims, "fired").agg(F.count(F.lit(1)).alias("n"))


def _family(rule: Column) -> Column:
    return F.split(rule, "By")[0]


def rule_pairs(patterns: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Joint count of rules (a before b by name) whose names differ before "By".

    Pairs come from distinct rule sets, of which there are few, not from rows.
    """
    pairs = F.flatten(F.transform("fired", lambda a, i: F.transform(
        F.filter("fired", lambda b: (b > a) & (_family(a) != _family(b))),
        lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return unfold_structs(patterns, [*dims, "n"], pairs).groupBy(*dims, "a", "b").agg(F.sum("n").alias("joint"))


def rule_cooccurrence(
    df: DataFrame, rules: Sequence[str], dims: Sequence[str] = (), top: int = TOP_PARTNERS
) -> DataFrame:
    """Per rule its count, its independent count and its partners by joint count.

    A rule is independent in a row when it alone fired, or when exactly two
    fired whose names agree before "By"; then the first by name gets the row.
    Partners with equal joint counts go by name.
    """
    patterns = fired_patterns(df, rules, dims)
    two_of_one = (F.size("fired") == 2) & (
        _family(F.get("fired", F.lit(0))) == _family(F.get("fired", F.lit(1))))
    alone = ((F.size("fired") == 1) | two_of_one) & (F.col("rule") == F.get("fired", F.lit(0)))
    fired_rows = unfold(patterns.withColumn("_f", F.col("fired")), [*dims, "n", "fired"], F.col("_f"), "rule")
    totals = fired_rows.groupBy(*dims, "rule").agg(
        F.sum("n").alias("checked"), F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("independent"))
    pairs = rule_pairs(patterns, dims)
    mirrored = pairs.select(*dims, F.inline(F.array(
        F.struct(F.col("a").alias("rule"), F.col("b").alias("partner"), "joint"),
        F.struct(F.col("b").alias("rule"), F.col("a").alias("partner"), "joint"))))
    order = Window.partitionBy(*dims, "rule").orderBy(F.desc("joint"), "partner")
    best = mirrored.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= top).drop("_r")
    other = totals.select(*dims, F.col("rule").alias("partner"), F.col("checked").alias("partner_checked"))
    joined = same_keys(same_keys(best, totals, [*dims, "rule"]), other, [*dims, "partner"])
    union = F.col("checked") + F.col("partner_checked") - F.col("joint")
    return joined.select(
        *dims, "rule", "checked", "independent", "partner", "partner_checked", "joint",
        (F.col("joint") / union).alias("jaccard"))


def score_bin_report(
    df: DataFrame, score: str, online: str, label: str, *, gap: float = 0.002, begin: float = 0.3,
    most: float = 1.0,
) -> DataFrame:
    """Rows in and above each score bin, with online, rule and independent rows above.

    One aggregation by bin, then running sums over the bins, whose number the
    parameters fix. The last bin is open so that higher scores count as above.
    """
    bins = int((most - begin) / gap)
    s = F.col(score)
    guess = F.floor((s - begin) / gap)
    edge = lambda i: i * F.lit(gap) + F.lit(begin)
    # floor() of a quotient can miss an edge by one step of rounding
    exact = F.when(s >= edge(guess + 1), guess + 1).when(s < edge(guess), guess - 1).otherwise(guess)
    place = F.greatest(F.least(exact, F.lit(bins)), F.lit(0)).cast("int")
    is_online, is_rule = F.col(online) > 1, F.col(label) == 1
    cells = df.filter(s.isNotNull()).groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), _count(is_online).alias("o"), _count(is_rule).alias("r"),
        _count(~is_online & ~is_rule).alias("i"))
    spark = df.sparkSession
    grid = spark.range(bins + 1).select(F.col("id").cast("int").alias("bin"))
    up = Window.orderBy(F.desc("bin"))
    every = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = grid.join(cells, "bin", "left").na.fill(0)
    above = lambda c: F.sum(c).over(up)
    total = F.sum("n").over(every)
    return filled.select(
        "bin", edge(F.col("bin")).alias("begin"), total.alias("total"),
        F.sum("o").over(every).alias("total_online"), F.sum("r").over(every).alias("total_rule"),
        F.col("n").alias("in_bin"), above("n").alias("above"),
        F.coalesce(F.try_divide(above("n"), total), F.lit(0.0)).alias("above_rate"),
        above("o").alias("online_above"), above("r").alias("rule_above"), above("i").alias("independent_above"),
    ).filter((F.col("bin") >= 1) & (F.col("bin") < bins))


def score_bin_report_flat(
    df: DataFrame, score: str, online: str, label: str, *, width: float = 0.2, most: float = 120.0
) -> DataFrame:
    """Label counts in bins of fixed width from 0, an overflow bin last; empty bins stay."""
    bins = int(round(most / width))
    s = F.col(score)
    guess = F.floor(s / width)
    edge = lambda i: i * F.lit(width)
    exact = F.when(s >= edge(guess + 1), guess + 1).when(s < edge(guess), guess - 1).otherwise(guess)
    place = F.when(s >= most, F.lit(bins)).otherwise(F.least(exact, F.lit(bins - 1))).cast("int")
    is_online, is_rule = F.col(online) > 1, F.col(label) == 1
    cells = df.filter(s >= 0).groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), _count(is_online).alias("online"), _count(is_rule).alias("rule"),
        _count(~is_online).alias("not_online"), _count(~is_rule).alias("not_rule"),
        _count(~is_online & ~is_rule).alias("independent"))
    grid = df.sparkSession.range(bins + 1).select(F.col("id").cast("int").alias("bin"))
    return grid.join(cells, "bin", "left").na.fill(0)
