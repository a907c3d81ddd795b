"""Mixing sources to target weights by entropy balancing.

Among all document rates r between 0 and the ceiling c, the mix takes the one
closest in entropy to the base rate b ("every document once") that gives each
source its number of target words:

    minimise  sum_i KL(r_i / c, b / c)   over documents i, KL between two coins
    so that   sum_{i in s} size_i r_i = T_s     for every source s

The dual is convex, and its minimiser tilts every document by its own size:

    r_i = c / (1 + (c - b) / b exp(-l_s z_i)),   z_i = size_i / mean size of s

so a source that needs more words takes its long documents sooner, and none
passes the ceiling. A document bears the constraint of its own source alone, so
the Hessian is diagonal. Each Newton step is one distributed aggregation over the
counts per (source, size): the gradient sum size r - T and the curvature
sum size z r (1 - r / c) of all sources at once. A bracket around the minimiser
keeps the steps safe. Sums are exact decimals, so reruns agree to the last bit.

Rates become copies by systematic rounding along the sizes of a source: a document
gets floor(R + 1/2) copies less those of the documents before it, R being the sum
of the rates up to it, in fixed point. Sizes are monotone along the ranks, so the
words a source gets differ from its target by at most the size of one document
(Abel summation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.llm.common import keep_table, null_join, replace_columns, words_of

NEWTON_STEPS = 100  # at most; with a bracket, more would not move a double any further
NEWTON_GAP = 1e-9  # steps end when every source is this near its target, as a share of it
UNIT = 1 << 24  # parts of a copy in fixed-point rates
BLOCK = 256  # documents ranked together


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, ceiling: float) -> DataFrame:
    """Target words of each source: (source, words) -> (source, words, target).

    ``weights`` repeat along the sources in code point order, null last. Together
    they get ``share`` times all words; none gets more than ``ceiling`` times its
    own, and what is above goes to the others by weight. The sources that reach
    the ceiling are those with the least ceiling per weight, so one running sum
    along that order finds them.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sources.withColumn("_k", F.row_number().over(
        everything.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_k") - 1) % len(weights) + 1).cast("int"))
    cap = F.col("words") * F.lit(float(ceiling))
    ranked = ranked.withColumn("_w", pick).withColumn("_cap", cap)
    order = everything.orderBy(F.col("_cap") / F.col("_w"), "_k").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("words").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(order), F.lit(0.0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(order), F.lit(0.0)))
    leveled = ranked.withColumn("_level", level)
    free = leveled.withColumn("_free", F.col("_cap") > F.col("_level") * F.col("_w"))
    # the level of the first source below its ceiling holds for all after it
    final = F.min(F.when(F.col("_free"), F.struct(F.col("_cap") / F.col("_w"), "_k", "_level"))).over(everything)["_level"]
    target = F.when(F.col("_free"), final * F.col("_w")).otherwise(F.col("_cap"))
    return free.select("source", "words", target.alias("target"))


def tilted_rate(size: Column, mean: Column, tilt: Column, ceiling: float) -> Column:
    """Rate of a document of some size: the base rate, tilted, below the ceiling."""
    base = min(1.0, ceiling / 2)
    return F.lit(float(ceiling)) / (1.0 + F.lit((ceiling - base) / base) * F.exp(-tilt * size / mean))


def newton_tilts(sizes: DataFrame, targets: DataFrame, ceiling: float) -> DataFrame:
    """(source, words, mean, target, tilt) that gives each source its target.

    ``sizes``: (source, size, n), ``targets``: (source, words, mean, target). A
    source whose target is its ceiling, or nothing, has an infinite tilt.
    """
    least, most = F.lit(float("-inf")), F.lit(float("inf"))
    full = F.col("target") >= F.col("words") * ceiling * (1 - 1e-12)
    start = F.when(F.col("target") <= 0, least).when(full, most).otherwise(F.lit(0.0))
    state = keep_table(targets.select("*", start.alias("tilt"), least.alias("low"), most.alias("high")), "tilts")
    exact = lambda value: F.sum(value.cast("decimal(38,10)")).cast("double")
    for _ in range(NEWTON_STEPS):
        inside = null_join(sizes.filter("size > 0"), state.filter(F.abs("tilt") < most), ["source"])
        rate = tilted_rate(F.col("size"), F.col("mean"), F.col("tilt"), ceiling)
        mass = F.col("n") * F.col("size") * rate
        sums = inside.groupBy("source").agg(
            exact(mass).alias("got"), exact(mass * F.col("size") / F.col("mean") * (1.0 - rate / ceiling)).alias("curve"))
        now = null_join(state, sums, ["source"], "left")
        gap = F.col("got") - F.col("target")
        now = now.withColumns({
            "gap": F.coalesce(F.abs(gap) / F.col("target"), F.lit(0.0)),
            "low": F.when(gap < 0, F.col("tilt")).otherwise(F.col("low")),
            "high": F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))})
        reach = 4.0 + 3.0 * F.abs("tilt")  # where the curve is flat, a step goes no further
        step = F.when(F.col("curve") > 0, F.greatest(-reach, F.least(reach, -gap / F.col("curve")))) \
            .otherwise(F.when(gap < 0, reach).otherwise(-reach))
        aim = F.col("tilt") + step
        middle = (F.col("low") + F.col("high")) / 2
        aim = F.when((aim > F.col("low")) & (aim < F.col("high")), aim).otherwise(middle)
        moved = F.when(F.col("gap") <= NEWTON_GAP, F.col("tilt")).otherwise(aim)
        state = keep_table(now.select(*targets.columns, moved.alias("tilt"), "low", "high", "gap"), "tilts")
        if (state.agg(F.max("gap")).first()[0] or 0.0) <= NEWTON_GAP:
            break
    return state.select(*targets.columns, "tilt")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, ceiling: float = 2.0,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Documents with size, source_size, target, rate, copies and taken.

    Size counts the words of a text (null: 0); ``taken`` is copies times size. A
    null source is a source of its own. Documents without words keep a row and
    are taken 0 times; identical rows are told apart by chance, which changes no
    row's total. An empty table gives an empty table. Result columns replace
    input columns of the same names.

    Ranks never gather a source: documents are counted per (source, size), runs
    of one size are cut into blocks of about ``BLOCK`` documents by their hash,
    and only counts are summed along the blocks. Texts move once, in the join
    that brings the copies back.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    tagged = docs.withColumns({
        "__h1": F.xxhash64(F.col(id_col), text), "__h2": F.xxhash64(text, F.col(source_col), F.col(id_col))})
    keys = tagged.select("__h1", "__h2", F.col(source_col).alias("source"),
                         F.size(words_of(F.col(text_col))).cast("long").alias("size"))
    keys = keys.groupBy("__h1", "__h2", "source", "size").agg(F.count("*").alias("m"))

    keys = keep_table(keys, "mix-keys")
    sizes = keep_table(keys.groupBy("source", "size").agg(F.sum("m").alias("n")), "mix-sizes")
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"),
                                          F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("docs"))
    targets = source_targets(sources.select("source", "words"), weights, share, ceiling)
    means = sources.select("source", F.greatest(F.col("words") / F.col("docs"), F.lit(1.0)).alias("mean"))
    tilts = newton_tilts(sizes, null_join(targets, means, ["source"]), ceiling)
    exact_rate = F.when((F.col("size") <= 0) | (F.col("tilt") == float("-inf")), 0.0) \
        .when(F.col("tilt") == float("inf"), float(ceiling)) \
        .otherwise(tilted_rate(F.col("size"), F.col("mean"), F.col("tilt"), ceiling))
    runs = null_join(sizes, tilts, ["source"]).withColumn("units", F.round(exact_rate * UNIT).cast("long"))
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("units")).over(smaller), F.lit(0)))

    placed = null_join(keys, runs, ["source", "size"]).withColumn(
        "block", F.pmod(F.col("__h1"), F.ceil(F.col("n") / BLOCK)))
    counts = placed.groupBy("source", "size", "block").agg(F.sum("m").alias("in_block"))
    along = Window.partitionBy("source", "size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source", "size", "block", F.coalesce(F.sum("in_block").over(along), F.lit(0)).alias("start"))
    upto_here = Window.partitionBy("source", "size", "block").orderBy("__h1", "__h2") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.withColumn("inside", F.sum("m").over(upto_here))
    ranked = null_join(ranked, starts, ["source", "size", "block"]).select(
        F.col("__h1"), F.col("__h2"), F.struct(
            "size", "words", "target", "units", "before", "m",
            (F.col("start") + F.col("inside")).alias("last")).alias("__mix"))

    out = tagged.join(ranked, ["__h1", "__h2"])
    # rows with the same id and text follow each other; each takes its own rank
    twin = F.row_number().over(Window.partitionBy("__h1", "__h2").orderBy("__h1"))
    rank = F.col("__mix.last") - F.col("__mix.m") + F.when(F.col("__mix.m") > 1, twin).otherwise(F.lit(1))
    upto = lambda k: F.shiftright(F.col("__mix.before") + k * F.col("__mix.units") + UNIT // 2, UNIT.bit_length() - 1)
    copies = F.when(F.col("__mix.size") > 0, upto(rank) - upto(rank - 1)).otherwise(F.lit(0)).cast("long")
    return replace_columns(out.withColumn("__copies", copies), {
        "size": F.col("__mix.size"), "source_size": F.col("__mix.words"), "target": F.col("__mix.target"),
        "rate": F.col("__mix.units") / F.lit(float(UNIT)), "copies": F.col("__copies"),
        "taken": F.col("__copies") * F.col("__mix.size")}).drop("__mix", "__copies", "__h1", "__h2")


def repeat_copies(mixed: DataFrame) -> DataFrame:
    """One row per copy; documents that the mix leaves out go."""
    return mixed.filter(F.col("copies") > 0).withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("__copy")
