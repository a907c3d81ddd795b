"""Entropy of count histograms, and the peeling of their top keys.

Peeling removes the most frequent keys one after another. The entropy of what
is left needs only the sums of c and c*log2(c) over the rest, so all steps
come from running sums. The sums run over *distinct counts*: keys with equal
counts form one block. A group with N rows has at most sqrt(2N) blocks, which
keeps the window small however many keys the group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.operators.aggregate import same_keys
from clicksieve.session import keep_table


def _clog(c: Column) -> Column:
    return F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))


def entropy(counts: DataFrame, dims: Sequence[str], n: str = "n") -> DataFrame:
    """Entropy in bits of each group's counts, and entropy over its maximum."""
    c = F.col(n).cast("double")
    sums = counts.groupBy(*dims).agg(
        F.sum(c).alias("_s"), F.sum(_clog(c)).alias("_l"), F.count(F.lit(1)).alias("categories"))
    h = F.when(F.col("_s") > 0, F.log2("_s") - F.col("_l") / F.col("_s")).otherwise(F.lit(0.0))
    return sums.select(*dims, "categories", h.alias("entropy"), _normal(h, F.col("_s"), F.col("categories")).alias("norm"))


def _normal(h: Column, total: Column, categories: Column) -> Column:
    return (
        F.when(categories <= 1, F.lit(1.0))
        .when(total <= 0, F.lit(0.0))
        .otherwise(h / F.log2(F.greatest(categories, F.lit(2)).cast("double")))
    )


def count_blocks(counts: DataFrame, dims: Sequence[str], n: str = "n") -> DataFrame:
    """Blocks of equal counts per group, with the sums of the keys from there on.

    ``c`` is the count, ``m`` how many keys have it, ``start`` how many keys
    are larger, ``s`` and ``l`` the sums of c and c*log2(c) from the block on,
    ``keys`` all keys of the group.
    """
    c = F.col("c").cast("double")
    blocks = counts.groupBy(*dims, F.col(n).alias("c")).agg(F.count(F.lit(1)).alias("m"))
    order = Window.partitionBy(*dims).orderBy(F.desc("c"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    return blocks.select(
        *dims, "c", "m",
        F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"),
        F.sum(c * F.col("m")).over(rest).alias("s"),
        F.sum(_clog(c) * F.col("m")).over(rest).alias("l"),
        F.sum("m").over(Window.partitionBy(*dims)).alias("keys"),
        F.sum(c * F.col("m")).over(Window.partitionBy(*dims)).alias("total"),
    )


def _after(removed: Column) -> tuple[Column, Column]:
    """Sums left after ``removed`` keys of the current block are gone too."""
    c = F.col("c").cast("double")
    return F.col("s") - c * removed, F.col("l") - _clog(c) * removed


def _entropy_of(s: Column, l: Column) -> Column:
    return F.when(s > 0, F.greatest(F.log2(s) - l / s, F.lit(0.0))).otherwise(F.lit(0.0))


def peel_entropy(counts: DataFrame, dims: Sequence[str], n: str = "n") -> DataFrame:
    """Entropy left after the top r keys, for every r below the number of keys."""
    steps = count_blocks(counts, dims, n).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1)).alias("_j"))
    s, l = _after(F.col("_j"))
    h = _entropy_of(s, l)
    removed = F.col("start") + F.col("_j")
    return steps.select(
        *dims, removed.alias("removed"), s.alias("remaining"), h.alias("entropy"),
        _normal(h, s, F.col("keys") - removed).alias("norm"))


def _ranked(counts: DataFrame, dims: Sequence[str], key: str, n: str, need: DataFrame, salts: int) -> DataFrame:
    """Rank of each key by falling count then key, up to ``_need`` per group.

    Keys with a count below the last needed one are dropped first. The rest is
    ranked in salted parts, then once more among the leaders of all parts.
    """
    near = same_keys(counts, need, dims, "inner").filter(F.col(n) >= F.col("_floor"))
    order = [F.desc(n), F.asc(key)]
    parts = near.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)))
    part = Window.partitionBy(*dims, "_salt").orderBy(*order)
    leaders = parts.withColumn("_r", F.row_number().over(part)).filter(F.col("_r") <= F.col("_need"))
    return (
        leaders.withColumn("rank", F.row_number().over(Window.partitionBy(*dims).orderBy(*order)))
        .filter(F.col("rank") <= F.col("_need")).select(*dims, key, n, "rank")
    )


def _needed(blocks: DataFrame, dims: Sequence[str], last: DataFrame) -> DataFrame:
    """Count of the key at rank ``_need`` in each group."""
    return same_keys(blocks.select(*dims, "c", "start"), last, dims, "inner").filter(
        F.col("start") < F.col("_need")
    ).groupBy(*dims).agg(F.min("c").alias("_floor"), F.first("_need").alias("_need"))


def general_entropy(
    counts: DataFrame, dims: Sequence[str], key: str, *, threshold: float = 1.0,
    limit: float = 0.0, normed: bool = False, n: str = "n", salts: int = 16,
) -> DataFrame:
    """Keys peeled from each group, with the entropy at the step that took them.

    The top key goes while the entropy is below the threshold; the rest must
    stay above ``limit`` and a group must hold at least ``limit`` to start.
    Only peeled keys are returned: every other key scores 100. The counts are read
    twice, for their blocks and for the ranks of the peeled keys; the steps between
    are a small table that carries the last rank and its count.
    """
    blocks = count_blocks(counts, dims, n)
    top = _normal(_entropy_of(F.col("s"), F.col("l")), F.col("s"), F.col("keys") - F.col("start")) \
        if normed else _entropy_of(F.col("s"), F.col("l"))
    # A block of m equal keys that starts below the threshold has at most
    # 2^threshold keys, so the ranks of the open blocks are few.
    in_order = Window.partitionBy(*dims).orderBy(F.desc("c"))
    state = blocks.withColumn("_closed", (top >= threshold).cast("int"))
    opened = state.filter(F.col("total") >= limit).withColumn(
        "_shut", F.max("_closed").over(in_order)).filter(F.col("_shut") == 0)
    steps = opened.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1)).alias("_j"))
    s, l = _after(F.col("_j"))
    rank = F.col("start") + F.col("_j") + 1
    h = _entropy_of(s, l)
    value = _normal(h, s, F.col("keys") - rank + 1) if normed else h
    trail = steps.select(*dims, rank.alias("rank"), s.alias("_s"), value.alias("entropy"), "c")
    # Step 1 always runs; step r > 1 runs while more than the limit is left.
    stops = (F.col("entropy") >= threshold) | ((F.col("rank") > 1) & (F.col("_s") <= limit))
    by_rank = Window.partitionBy(*dims).orderBy("rank")
    peeled = trail.withColumn("_stop", F.max(stops.cast("int")).over(by_rank)).filter(F.col("_stop") == 0)
    group = Window.partitionBy(*dims)
    peeled = keep_table(peeled.select(*dims, "rank", "entropy", F.max("rank").over(group).alias("_need"),
                                      F.min("c").over(group).alias("_floor")), "peeled")
    need = peeled.filter(F.col("rank") == 1).select(*dims, "_need", "_floor")
    ranked = _ranked(counts, dims, key, n, need, salts)
    return same_keys(ranked, peeled.select(*dims, "rank", "entropy"), [*dims, "rank"], "inner")


def entropy_scores(counts: DataFrame, peeled: DataFrame, dims: Sequence[str], key: str) -> DataFrame:
    """Every key with its score: the entropy at the step that peeled it, 100 for all others."""
    found = peeled.select(*dims, key, "entropy")
    return same_keys(counts, found, [*dims, key]).withColumn("score", F.coalesce("entropy", F.lit(100.0))).drop("entropy")


def peeled_text(peeled: DataFrame, dims: Sequence[str], key: str) -> DataFrame:
    """Per group the peeled keys with their entropies, ``key:%.3f`` in the order they went.

    At most 2^threshold keys are open at a step, so the list is short.
    """
    steps = F.array_sort(F.collect_list(F.struct("rank", F.col(key).cast("string").alias("k"), "entropy")))
    texts = F.transform(steps, lambda e: F.format_string("%s:%.3f", e["k"], e["entropy"]))
    return peeled.groupBy(*dims).agg(F.array_join(texts, "|").alias("peeled"))


def action_entropy(
    chains: DataFrame, dims: Sequence[str], key: str, *, threshold: float, n: str = "n", salts: int = 16,
) -> tuple[DataFrame, DataFrame]:
    """Channels whose users share few action chains, and the scores of those chains.

    ``chains`` holds (dims, key, n). Returns the channel frame (entropy, total,
    distinct) and the chain frame (dims, key, n, rank, delta). The histogram is
    padded with zeros to a quarter of the total. Step r removes max(1, r // 2)
    more keys, so before step r exactly floor((r-1)^2 / 4) + 1 are gone (0 at
    r = 1), and the r-th chain gets threshold minus the entropy at that step.
    """
    if threshold > 1:
        raise ValueError("the threshold compares with a normalised entropy: at most 1")
    blocks = keep_table(count_blocks(chains, dims, n), "blocks")
    padded = F.greatest(F.col("keys"), F.floor(F.col("total") / 4)).cast("bigint")
    first = blocks.filter(F.col("start") == 0)
    channels = first.select(
        *dims, _normal(_entropy_of(F.col("s"), F.col("l")), F.col("s"), padded).alias("entropy"),
        F.col("total").cast("bigint").alias("total"), F.col("keys").alias("distinct"))
    # Zero padding is one more block after the real keys.
    zero = first.filter(padded > F.col("keys")).select(
        *dims, F.lit(0).cast("bigint").alias("c"), (padded - F.col("keys")).alias("m"),
        F.col("keys").alias("start"), F.lit(0.0).alias("s"), F.lit(0.0).alias("l"), "keys", "total")
    all_blocks = blocks.unionByName(zero)
    gone = lambda r: F.when(r <= 1, F.lit(0).cast("bigint")).otherwise(
        F.floor((r - 1) * (r - 1) / 4) + 1)
    guess = lambda removed: F.floor(2 * F.sqrt(F.greatest(removed - 1, F.lit(0)).cast("double"))).cast("bigint")
    end = F.col("start") + F.col("m")
    r = F.col("r")
    steps = all_blocks.select("*", F.explode(F.sequence(
        F.greatest(guess(F.col("start")) - 1, F.lit(1)).cast("bigint"), guess(end) + 3)).alias("r")
    ).filter((gone(r) >= F.col("start")) & (gone(r) < end) & (r <= F.col("keys")))
    s, l = _after(gone(r) - F.col("start"))
    h = _normal(_entropy_of(s, l), s, padded - gone(r))
    trail = steps.select(*dims, "r", h.alias("_h"))
    by_step = Window.partitionBy(*dims).orderBy("r")
    deltas = (
        trail.withColumn("_stop", F.max((F.col("_h") >= threshold).cast("int")).over(by_step))
        .filter(F.col("_stop") == 0)
        .select(*dims, F.col("r").alias("rank"), (F.lit(threshold) - F.col("_h")).alias("delta"))
    )
    deltas = keep_table(deltas, "deltas")
    last = deltas.groupBy(*dims).agg(F.max("rank").alias("_need"))
    ranked = _ranked(chains, dims, key, n, _needed(blocks, dims, last), salts)
    return channels, same_keys(ranked, deltas, [*dims, "rank"], "inner")


def user_chains(timeline: DataFrame, keys: Sequence[str], head: int = 200) -> DataFrame:
    """(keys, chain) of numbered events: what tells the whole chain of a user's actions from others.

    A chain is the xor of its actions' hashes, each taken with its place, so parts of
    a user's events merge in any order and no list of all actions is made. The first
    ``head`` actions stand before the hashes as text, which orders chains like their
    texts; chains equal so far go by the hashes.
    """
    place, action = F.col("place"), F.col("action")
    first = F.sort_array(F.collect_list(F.when(place < head, F.struct("place", "action"))))
    parts = timeline.groupBy(*keys).agg(
        F.bit_xor(F.xxhash64(place, action)).alias("_x"), F.bit_xor(F.xxhash64(F.lit("second"), action, place)).alias("_y"),
        F.count(F.lit(1)).alias("_n"), first.alias("_h"))
    text = F.array_join(F.transform("_h.action", lambda a: F.coalesce(a, F.lit(""))), "->")
    return parts.select(*keys, F.concat_ws("\u0001", text, F.hex("_x"), F.hex("_y"), F.col("_n").cast("string")).alias("chain"))


def chain_counts(df: DataFrame, dims: Sequence[str], actions: str, attention: Sequence[str] = ()) -> DataFrame:
    """Users per action chain and channel; with a list, only chains that hold one of it."""
    chains = df.select(*dims, F.array_join(actions, "->").alias("chain"))
    if attention:
        found = F.lit(False)
        for word in attention:
            found = found | F.col("chain").contains(word)
        chains = chains.filter(found)
    return chains.groupBy(*dims, "chain").agg(F.count(F.lit(1)).alias("n"))
