"""Action timelines, time gaps, think-time tokens and Markov likelihoods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicksieve.functions.detail import is_digital
from clicksieve.functions.unfold import bind, unfold_structs
from clicksieve.operators.aggregate import same_keys
from clicksieve.operators.ranks import number_rows, running
from clicksieve.session import keep_table

EPSILON = 1e-7

# The action classes of a search entry, in order (fixed values).
ACTION_RULES = [
    ("search1", ["lm", "home_.*", "se[0-9|_].*", "360.*", "corr_.*", "hao.*", "recom-nlp.*",
                 "oneboxlink.*", "internal_.*"]),
    ("search2", ["srp.*", "res-sug.*", "sug-local", "tab_.*", "inline.*"]),
    ("paging", ["srp_paging"]),
    ("right_sug", ["know_side_nl.*"]),
    ("related", ["related_.*", "pdr_guide.*", "inline-recommend_.*"]),
]


def search_class(source: Column) -> Column:
    """Class of a search by its whole source text, in the order of the rules; null without one."""
    fits = lambda patterns: source.rlike("^(?:" + "|".join(patterns) + ")$")
    out = F.when(fits(ACTION_RULES[0][1]), ACTION_RULES[0][0])
    for name, patterns in ACTION_RULES[1:]:
        out = out.when(fits(patterns), name)
    return out


def whole_millis(time: Column, fallback: Column) -> Column:
    """Time text cut at its first dot; the fallback when it is not a number."""
    return F.when(is_digital(time), F.split(time, r"\.")[0].try_cast("bigint")).otherwise(fallback)


def timeline_events(
    df: DataFrame, dims: Sequence[str], action: Column, time: Column,
    clicks: Column, ad_clicks: Column, *, second_time: Column | None = None, row_type: str = "tp",
) -> DataFrame:
    """Events (dims, time, action) of the rows, repeated ones included.

    A row gives its search, its clicks and its ad clicks. A search without a
    readable time takes the second time; one without either is left out. A click
    without a readable time gets the search time plus 5 s per click number, an
    ad click plus 10 s; numbers run on from clicks to ad clicks.
    """
    base = whole_millis(time, F.lit(0) if second_time is None else whole_millis(second_time, F.lit(0)))
    click_time = F.transform("_clicks", lambda t, i: F.struct(
        whole_millis(t, F.col("_t") + 5000 * (i + 1)).alias("time"), F.lit("click").alias("action")))
    ad_time = F.transform("_ad_clicks", lambda t, i: F.struct(
        whole_millis(t, F.col("_t") + 10000 * (F.size("_clicks") + i + 1)).alias("time"),
        F.lit("adclick").alias("action")))
    own = F.array(F.struct(F.col("_t").alias("time"), F.col("_a").alias("action")))
    rows = (
        df.filter(F.col(row_type) <= "1")
        .select(*dims, base.cast("bigint").alias("_t"), action.alias("_a"),
                clicks.alias("_clicks"), ad_clicks.alias("_ad_clicks"))
        .filter(F.col("_t") != 0)
    )
    return unfold_structs(rows, dims, F.concat(own, click_time, ad_time))


def timeline_rows(events: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The distinct (time, action) events of each group, numbered in time order from 0.

    Long form (dims, time, action, place): a group's events are dealt by ranges of
    time and numbered by running sums, so no task holds a user.
    """
    distinct = events.select(*dims, "time", "action").distinct()
    return number_rows(keep_table(distinct, "events"), dims, ["time", "action"])


def action_timeline(
    df: DataFrame, dims: Sequence[str], action: Column, time: Column,
    clicks: Column, ad_clicks: Column, *, second_time: Column | None = None, row_type: str = "tp",
    limit: int | None = None,
) -> DataFrame:
    """The first ``limit`` actions of each group in time order, as arrays of actions and times.

    Equal (time, action) pairs count once. For exports that want lists of a bounded
    length; without a limit a list has all actions of its group and stands in one
    row. ``timeline_rows`` has them all as rows, and models read the events.
    """
    events = timeline_events(df, dims, action, time, clicks, ad_clicks, second_time=second_time, row_type=row_type)
    return first_actions(events, dims, limit)


def first_actions(events: DataFrame, dims: Sequence[str], limit: int | None = None) -> DataFrame:
    """Arrays of the distinct (time, action) events per group, or of the first ``limit``.

    One shuffle: repeated events have the same dense rank and are dropped where
    they meet, and the arrays are collected in the same partition.
    """
    order = Window.partitionBy(*dims).orderBy("time", "action")
    ranked = events.select(*dims, "time", "action", F.dense_rank().over(order).alias("_rank"),
                           F.lag(F.struct("time", "action")).over(order).alias("_before"))
    kept = ranked.filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.struct("time", "action")))
    if limit is not None:
        kept = kept.filter(F.col("_rank") <= limit)
    return kept.groupBy(*dims).agg(
        F.array_sort(F.collect_list(F.struct("time", "action"))).alias("_e")
    ).select(*dims, F.col("_e.action").alias("actions"), F.col("_e.time").alias("times"))


def time_gap_histogram(
    df: DataFrame, dims: Sequence[str], time: str, *, step: int, session_gap: int, max_step: int,
    bucket_millis: int = 600_000,
) -> DataFrame:
    """Histogram of the gaps between neighbouring events of a group, in steps.

    Gaps above ``session_gap`` steps are dropped, the others capped at
    ``max_step - 1``. Equal times are counted first: n of them make n-1 zero
    gaps. Times are then cut into buckets; a bucket passes on its first and
    last time and its gap counts, so no task sees all events of a group.
    """
    steps = lambda gap: F.floor(gap / step)
    counted = df.groupBy(*dims, F.floor(F.col(time) / bucket_millis).alias("_b"), F.col(time).alias("_t")).agg(
        F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy(*dims, "_b").orderBy("_t")
    near = counted.withColumn("_s", steps(F.col("_t") - F.lag("_t").over(inside)))
    kept = F.when(F.col("_s") <= session_gap, F.least("_s", F.lit(max_step - 1)))
    buckets = near.withColumn("_s", kept).groupBy(*dims, "_b").agg(
        F.min("_t").alias("_lo"), F.max("_t").alias("_hi"),
        *[F.sum((F.col("_s") == i).cast("bigint")).alias(f"_h{i}") for i in range(1, max_step)],
        # equal times are gaps of no step
        (F.coalesce(F.sum((F.col("_s") == 0).cast("bigint")), F.lit(0)) + F.sum(F.col("_n") - 1)).alias("_h0"))
    across = Window.partitionBy(*dims).orderBy("_b")
    far = buckets.withColumn("_s", steps(F.col("_lo") - F.lag("_hi").over(across))).withColumn("_s", kept)
    total = lambda i: F.sum(F.coalesce(F.col(f"_h{i}"), F.lit(0)) + F.coalesce(
        (F.col("_s") == i).cast("bigint"), F.lit(0)))
    wide = far.groupBy(*dims).agg(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("gap"), total(i).alias("n")) for i in range(max_step)]).alias("_g"))
    return unfold_structs(wide, dims, F.filter("_g", lambda e: e["n"] > 0))


def _pause_token(millis: Column) -> Column:
    """``t<p>`` with p the log-6 class of a pause, -1 below a second."""
    seconds = F.floor(F.abs(millis) / 1000)
    return F.concat(F.lit("t"), F.when(seconds == 0, F.lit(-1)).otherwise(
        F.least(F.floor(F.ln(seconds) / F.ln(F.lit(6.0))), F.lit(5))).cast("string"))


def think_time_rows(timeline: DataFrame, dims: Sequence[str], include_time: bool = True) -> DataFrame:
    """Tokens (dims, pos, token) of numbered events: ``start``, a1, ``t<p>``, a2, ..., ``end``.

    The pause before an event needs the time of the event before it, a running
    maximum over blocks of places; the end needs the number of events only.
    """
    token = lambda pos, text: F.struct(pos.cast("bigint").alias("pos"), text.alias("token"))
    place, action = F.col("place"), F.col("action")
    first = F.array(token(F.lit(0), F.lit("start")), token(F.lit(1), action))
    if include_time:
        rows = running(timeline, dims, "place", {"before": (F.max, F.col("time"))})
        later = F.array(token(2 * place, _pause_token(F.col("time") - F.col("before"))), token(2 * place + 1, action))
    else:
        rows, later = timeline, F.array(token(place + 1, action))
    body = unfold_structs(rows, dims, F.when(place == 0, first).otherwise(later))
    last = 2 * F.count(F.lit(1)) if include_time else F.count(F.lit(1)) + 1
    ends = timeline.groupBy(*dims).agg(last.alias("pos")).withColumn("token", F.lit("end"))
    return body.unionByName(ends)


def think_time_tokens(actions: Column, times: Column, include_time: bool = True) -> Column:
    """The tokens of ``think_time_rows`` for a list of bounded length, as an array."""
    rest = F.greatest(F.size(times) - 1, F.lit(0))
    pauses = F.zip_with(
        F.slice(times, 2, rest), F.slice(times, 1, rest), lambda after, before: _pause_token(after - before))
    if include_time:  # the last action has no pause: its partner is null
        body = F.flatten(F.zip_with(actions, pauses, lambda a, t: F.when(t.isNull(), F.array(a)).otherwise(F.array(a, t))))
    else:
        body = actions
    ends = lambda word: F.array(F.lit(word))
    return F.when(F.size(actions) > 0, F.concat(ends("start"), body, ends("end"))).otherwise(
        F.array().cast("array<string>"))


def token_id(token: Column, vocabulary: dict[str, int]) -> Column:
    """Id of a token by vocabulary; an unknown token is an error."""
    table = F.create_map(*[F.lit(v) for pair in vocabulary.items() for v in pair])
    return F.coalesce(
        F.try_element_at(table, token),
        F.raise_error(F.concat(F.lit("token not in vocabulary: "), token)).cast("int"))


def token_ids(tokens: Column, vocabulary: dict[str, int]) -> Column:
    """Ids of an array of tokens by vocabulary."""
    return F.transform(tokens, lambda t: token_id(t, vocabulary))


# Variable-order Markov model ---------------------------------------------------
# The model is a table (dims, len, ctx, next, n). ``ctx`` lists the previous
# actions, oldest first, joined by the separator; the empty context is the root.
# It is counted from contexts: one row (keys, prev, next) per action, ``prev``
# being the up to depth - 1 actions before it.

_SEP = "\u0001"


def event_contexts(
    events: DataFrame, keys: Sequence[str], depth: int, bucket_millis: int = 600_000
) -> DataFrame:
    """Contexts of the distinct (time, action) events of each sequence.

    Times are cut into buckets. Inside a bucket the actions before an event are
    neighbours; what its first events lack is handed over by the buckets before
    it, which pass on their last actions only. No task sees all events of a user.
    """
    back = depth - 1
    distinct = events.groupBy(*keys, F.floor(F.col("time") / bucket_millis).alias("_b"), "time", "action").agg(
        F.lit(1).alias("_one"))
    inside = Window.partitionBy(*keys, "_b").orderBy("time", "action")
    none = F.array().cast("array<string>")
    before = lambda what, window: F.array_compact(F.array(*[F.lag(what, k).over(window) for k in range(back, 0, -1)])) \
        if back else none
    rows = distinct.select(*keys, "_b", F.col("action").alias("next"), before("action", inside).alias("_near"),
                           F.lead("action").over(inside).isNull().alias("_last"))
    if not back:
        return rows.select(*keys, F.col("_near").alias("prev"), "next")
    ends = rows.filter("_last").select(*keys, "_b", _last_of(F.concat("_near", F.array("next")), back).alias("_tail"))
    carried = ends.select(*keys, "_b", _last_of(F.flatten(before(
        "_tail", Window.partitionBy(*keys).orderBy("_b"))), back).alias("_far"))
    full = same_keys(rows.drop("_last"), carried, [*keys, "_b"], "inner")
    return full.select(*keys, _last_of(F.concat("_far", "_near"), back).alias("prev"), "next")


def _last_of(values: Column, n: int) -> Column:
    return bind(values, lambda v: F.slice(v, F.greatest(F.size(v) - n + 1, F.lit(1)), n))


def list_contexts(df: DataFrame, keys: Sequence[str], actions: str, depth: int) -> DataFrame:
    """Contexts of sequences that are arrays; an empty one gives a row without an action."""
    rows = df.select(*keys, F.col(actions).alias("_acts"), F.posexplode_outer(actions).alias("_i", "next"))
    n = F.least(F.col("_i"), F.lit(depth - 1))
    prev = F.when(F.col("_i").isNotNull(), F.slice("_acts", F.col("_i") - n + 1, n)).otherwise(F.array().cast("array<string>"))
    return rows.select(*keys, prev.alias("prev"), "next")


def _suffixes(grams: DataFrame, keep: Sequence[str], depth: int) -> DataFrame:
    """Each (prev, next) with every context that ends where it does."""
    prev = F.col("prev")
    lens = F.sequence(F.lit(0), F.least(F.size(prev), F.lit(depth - 1)))
    return unfold_structs(grams, keep, bind(prev, lambda p: F.transform(lens, lambda n: F.struct(
        n.alias("len"), F.array_join(F.slice(p, F.size(p) - n + 1, n), _SEP).alias("ctx")))))


def context_counts(contexts: DataFrame, dims: Sequence[str], depth: int, limit: int | None = None) -> DataFrame:
    """Counts of the next action after each context of up to ``depth - 1`` actions.

    The longest contexts are counted first, so only distinct ones are unfolded
    into their suffixes. With a limit, only groups with more actions are kept.
    """
    grams = contexts.filter(F.col("next").isNotNull()).groupBy(*dims, "prev", "next").agg(F.count(F.lit(1)).alias("_n"))
    if limit is not None and dims:
        grams = keep_table(grams, "grams")  # read for the sizes of groups and for the counts
        roots = grams.groupBy(*dims).agg(F.sum("_n").alias("_root"))
        grams = same_keys(grams, roots.filter(F.col("_root") > limit).select(*dims), dims, "left_semi")
    return _suffixes(grams, [*dims, "next", "_n"], depth).groupBy(*dims, "len", "ctx", "next").agg(F.sum("_n").alias("n"))


def context_probs(counts: DataFrame, dims: Sequence[str], min_count: int = 20) -> DataFrame:
    """Probabilities of contexts seen more than ``min_count`` times.

    The counts of a context never exceed those of its shorter suffix, so a
    flat filter drops whole branches. A group whose root is itself too small
    keeps its raw counts.
    """
    per_ctx = Window.partitionBy(*dims, "len", "ctx")
    totals = counts.withColumn("_total", F.sum("n").over(per_ctx))
    roots = counts.filter(F.col("len") == 0).groupBy(*dims).agg(F.sum("n").alias("_root"))
    if dims:
        with_root = same_keys(totals, roots, dims)
    else:  # one model for the whole log: its root total is a single number
        with_root = totals.withColumn("_root", F.lit(roots.agg(F.coalesce(F.max("_root"), F.lit(0))).first()[0]))
    raw = F.col("_root") <= min_count
    prob = F.when(raw, F.col("n").cast("double")).otherwise(F.col("n") / F.col("_total"))
    return with_root.filter(raw | (F.col("_total") > min_count)).select(
        *dims, "len", "ctx", "next", "n", prob.alias("p"))


def sequence_likelihood(
    contexts: DataFrame, dims: Sequence[str], user: Sequence[str], model: DataFrame, *,
    depth: int, prior: dict[str, float] | None = None,
) -> DataFrame:
    """Score of each sequence: geometric mean of p(action | context) / prior.

    Each action uses its longest context in the model. Without a prior the
    root shares of the model serve. One action scores 1, none ln(1e-7), and a
    group without a model 0. ``user`` with ``dims`` must name a sequence.

    Contexts are counted per sequence, and each distinct one of a group is looked
    up once, so frequent short contexts meet the model as single rows.
    """
    keys = [*dims, *user]
    own = contexts.groupBy(*keys, "prev", "next").agg(F.count("next").alias("_n"))
    table = F.map_from_entries(F.collect_list(F.struct("next", "p")))
    nodes = model.groupBy(*dims, "len", "ctx").agg(table.alias("_probs"))
    distinct = own.filter(F.col("next").isNotNull()).select(*dims, "prev", "next").distinct()
    looked = same_keys(_suffixes(distinct, [*dims, "prev", "next"], depth), nodes, [*dims, "len", "ctx"], "inner")
    chance = F.coalesce(F.try_element_at("_probs", F.col("next")), F.lit(EPSILON))
    solved = looked.withColumn("_p", chance).groupBy(*dims, "prev", "next").agg(
        F.max_by("_p", "len").alias("_p"), F.max_by("_p", -F.col("len")).alias("_q"))
    if prior is None:
        base = F.col("_q")
    else:
        given = F.create_map(*[F.lit(v) for pair in prior.items() for v in pair])
        base = F.try_element_at(given, F.col("next"))
    rated = solved.select(*dims, "prev", "next", F.ln(F.col("_p") / base).alias("_rate"))
    sums = same_keys(own, rated, [*dims, "prev", "next"]).groupBy(*keys).agg(
        F.sum("_n").alias("_size"), F.sum(F.col("_n") * F.col("_rate")).alias("_log"))
    if dims:
        roots = model.filter(F.col("len") == 0).select(*dims, F.lit(True).alias("_known")).distinct()
        sums = same_keys(sums, roots, dims)
    else:
        sums = sums.withColumn("_known", F.lit(not model.isEmpty()))
    size = F.col("_size")
    return sums.select(
        *keys,
        F.when(F.col("_known").isNull() | ~F.col("_known"), F.lit(0.0))
        .when(size == 0, F.ln(F.lit(EPSILON)))
        .when(size == 1, F.lit(1.0))
        .otherwise(F.exp(F.col("_log") / (size - 1))).alias("score"),
    )
