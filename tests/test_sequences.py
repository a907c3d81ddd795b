import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clicksieve.operators import entropy, sequence
from clicksieve.session import keep_table


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# time gaps ------------------------------------------------------------------


@pytest.mark.parametrize("bucket", [1, 7, 50, 1000])
def test_time_gaps_equal_a_walk(spark, bucket):
    rng = random.Random(bucket)
    rows = [(u, rng.choice([5, 5, rng.randrange(0, 400)])) for u in "ab" for _ in range(60)] + [("c", 9)]
    want = Counter()
    for u in "abc":
        times = sorted(t for v, t in rows if v == u)
        for x, y in zip(times, times[1:]):
            steps = (y - x) // 4
            if steps <= 6:
                want[u, min(steps, 4)] += 1
    got = sequence.time_gap_histogram(
        frame(spark, rows, "u string, t bigint"), ["u"], "t", step=4, session_gap=6, max_step=5, bucket_millis=bucket)
    assert {(r.u, r.gap): r.n for r in got.collect()} == want


# timelines and tokens -----------------------------------------------------------


def test_timeline_fills_times_and_drops_rows(spark):
    rows = [
        ("u", "s", "1000.7", ["1500", "x"], ["y"], "0"), ("u", "s", "1000", [], [], "1"),
        ("u", "s", "0", ["5"], [], "0"), ("u", "s", "7", [], [], "2"), ("u", "s", "bad", [], [], "0")]
    df = frame(spark, rows, "u string, a string, t string, c array<string>, k array<string>, tp string")
    out = sequence.action_timeline(df, ["u"], F.col("a"), F.col("t"), F.col("c"), F.col("k")).first()
    assert out.actions == ["s", "click", "click", "adclick"]
    assert out.times == [1000, 1500, 11000, 31000]


def test_timeline_keeps_the_first_actions(spark):
    df = frame(spark, [("u", i, f"a{i}") for i in range(300)], "u string, time bigint, action string")
    out = sequence.first_actions(df, ["u"], 200).first()
    assert out.times == list(range(200))


def test_a_user_with_a_million_events(spark):
    """A third of all events belong to one user; places, pauses and tokens stay right and spread."""
    times = F.when(F.col("id") < 1_000_000, (F.col("id") * 7919 % 1_000_003) * 3000).otherwise(F.col("id") % 50 * 90_000)
    user = F.when(F.col("id") < 1_000_000, "hot").otherwise((F.col("id") % 40_000).cast("string"))
    events = spark.range(0, 3_000_000, 1, 12).select(user.alias("u"), times.alias("time"), F.lit("a").alias("action"))
    timeline = keep_table(sequence.timeline_rows(events, ["u"]), "timeline")
    sizes = timeline.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 600_000
    hot = timeline.filter("u = 'hot'").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("place").alias("d"), F.max("place").alias("m")).first()
    assert hot == (1_000_000, 1_000_000, 999_999)
    steps = timeline.filter("u = 'hot'").select("place", "time").orderBy("place").limit(1000).collect()
    assert all(x.time < y.time for x, y in zip(steps, steps[1:]))
    rows = sequence.think_time_rows(timeline, ["u"])
    counts = {r.token: r["count"] for r in rows.filter("u = 'hot'").groupBy("token").count().collect()}
    assert (counts["start"], counts["end"], counts["a"]) == (1, 1, 1_000_000)
    assert sum(n for t, n in counts.items() if t[0] == "t") == 999_999 and rows.filter("u = 'hot'").agg(F.max("pos")).first()[0] == 2_000_000


@pytest.mark.parametrize("include", [True, False])
def test_token_rows_equal_token_lists(spark, include):
    rng = random.Random(8)
    rows = [(rng.choice([None, "x", "y", "z"]), rng.choice([5, rng.randrange(10 ** 7)]), rng.choice("abc")) for _ in range(200)] + [("one", 1, "a")]
    events = frame(spark, rows, "u string, time bigint, action string")
    got = defaultdict(list)
    for r in sequence.think_time_rows(sequence.timeline_rows(events, ["u"]), ["u"], include).orderBy("pos").collect():
        got[r.u].append(r.token)
        assert len(got[r.u]) == r.pos + 1
    lists = sequence.first_actions(events, ["u"])
    assert got == {r.u: r.t for r in lists.select("u", sequence.think_time_tokens(F.col("actions"), F.col("times"), include).alias("t")).collect()}


def tokens(spark, actions, times, include=True):
    df = frame(spark, [(actions, times)], "a array<string>, t array<bigint>")
    return df.select(sequence.think_time_tokens(F.col("a"), F.col("t"), include)).first()[0]


def test_tokens(spark):
    assert tokens(spark, [], []) == []
    assert tokens(spark, ["x"], [1]) == ["start", "x", "end"]
    seconds = [0, 0.9, 1.9, 7.9, 43.9, 10**6]
    times = [int(s * 1000) for s in seconds]
    assert tokens(spark, list("abcdef"), times) == [
        "start", "a", "t-1", "b", "t0", "c", "t1", "d", "t2", "e", "t5", "f", "end"]
    assert tokens(spark, ["a", "b"], [1, 2], False) == ["start", "a", "b", "end"]


def test_unknown_token_is_an_error(spark):
    df = frame(spark, [(["a", "b"],)], "t array<string>")
    assert df.select(sequence.token_ids(F.col("t"), {"a": 3, "b": 4})).first()[0] == [3, 4]
    with pytest.raises(Exception, match="not in vocabulary"):
        df.select(sequence.token_ids(F.col("t"), {"a": 3})).collect()


# Markov -----------------------------------------------------------------------


def brute_counts(seqs, depth):
    counts = defaultdict(Counter)
    for s in seqs:
        for i in range(len(s)):
            for n in range(min(i, depth - 1) + 1):
                counts[tuple(s[i - n:i])][s[i]] += 1
    return counts


def brute_score(seq, counts, depth, min_count, prior):
    if not seq:
        return math.log(1e-7)
    raw = sum(counts[()].values()) <= min_count
    kept = {c: v for c, v in counts.items() if raw or sum(v.values()) > min_count}
    p = lambda c, a: (kept[c][a] / (1 if raw else sum(kept[c].values()))) or 1e-7
    total = 1.0
    for i, a in enumerate(seq):
        ctx = next(tuple(seq[i - n:i]) for n in range(min(i, depth), -1, -1) if tuple(seq[i - n:i]) in kept)
        total *= p(ctx, a) / (prior[a] if prior else p((), a))
    return total ** (1 / (len(seq) - 1)) if len(seq) > 1 else 1.0


def test_context_counts_of_a_known_sequence(spark):
    df = frame(spark, [("g", list("1000100110"))], "g string, acts array<string>")
    rows = sequence.context_counts(sequence.list_contexts(df, ["g"], "acts", 3), ["g"], 3).collect()
    want = brute_counts(["1000100110"], 3)
    assert {(tuple(r.ctx.split("\u0001")) if r.ctx else (), r.next): r.n for r in rows} == {
        (c, a): n for c, v in want.items() for a, n in v.items()}


@pytest.mark.parametrize("seed,prior,min_count", [(1, None, 3), (2, {"a": 0.5, "b": 0.3, "c": 0.2}, 4), (3, None, 5000)])
def test_likelihood_equals_a_tree_walk(spark, seed, prior, min_count):
    rng = random.Random(seed)
    data = {(g, f"u{i}"): [rng.choice("aaabc") for _ in range(rng.randrange(0, 9))] for g in "xy" for i in range(25)}
    data["z", "u0"] = list("ab")  # too few actions for a model
    df = frame(spark, [(g, u, s) for (g, u), s in data.items()], "g string, u string, acts array<string>")
    contexts = sequence.list_contexts(df, ["g", "u"], "acts", 4)
    counts = sequence.context_counts(contexts, ["g"], 4, limit=10)
    model = sequence.context_probs(counts, ["g"], min_count)
    got = sequence.sequence_likelihood(contexts, ["g"], ["u"], model, depth=4, prior=prior)
    brute = {g: brute_counts([s for (h, _), s in data.items() if h == g], 4) for g in "xy"}
    for r in got.collect():
        want = brute_score(data[r.g, r.u], brute[r.g], 4, min_count, prior) if r.g in brute else 0.0
        assert r.score == pytest.approx(want, rel=1e-9)


def test_one_model_for_the_whole_log(spark):
    data = {"u1": list("abab"), "u2": list("aab"), "u3": ["a"], "u4": []}
    df = frame(spark, list(data.items()), "u string, acts array<string>")
    contexts = sequence.list_contexts(df, ["u"], "acts", 3)
    model = sequence.context_probs(sequence.context_counts(contexts, [], 3), [], 1)
    got = sequence.sequence_likelihood(contexts, [], ["u"], model, depth=3)
    counts = brute_counts(data.values(), 3)
    for r in got.collect():
        assert r.score == pytest.approx(brute_score(data[r.u], counts, 3, 1, None))


def test_contexts_of_events_cross_buckets(spark):
    """A user with more than 1,000 events, some far apart, some repeated: no event is left out."""
    rng = random.Random(9)
    times = sorted(rng.choice([rng.randrange(10**6), rng.randrange(10**9)]) for _ in range(1500))
    events = {(u, t, rng.choice("abc")) for u in "xy" for t in times[:1500 if u == "x" else 3]}
    df = frame(spark, list(events) * 2, "u string, time bigint, action string")
    for depth in (1, 2, 4):
        got = Counter((r.u, tuple(r.prev), r.next) for r in sequence.event_contexts(df, ["u"], depth).collect())
        want = Counter()
        for u in "xy":
            acts = [a for _, a in sorted((t, a) for v, t, a in events if v == u)]
            want.update((u, tuple(acts[max(0, i - depth + 1):i]), a) for i, a in enumerate(acts))
        assert got == want
    lists = {r.u: r.actions for r in sequence.first_actions(df, ["u"]).collect()}
    assert lists["x"] == [a for _, a in sorted((t, a) for v, t, a in events if v == "x")] and len(lists["x"]) > 1000


# entropies -----------------------------------------------------------------------


def h(counts):
    total = sum(counts)
    return -sum(c / total * math.log2(c / total) for c in counts if c) if total else 0.0


def norm(counts):
    if len(counts) <= 1:
        return 1.0
    return h(counts) / math.log2(len(counts)) if sum(counts) else 0.0


def counts_frame(spark, groups):
    rows = [(g, f"k{i:03}", c) for g, cs in groups.items() for i, c in enumerate(cs)]
    return frame(spark, rows, "g string, k string, n bigint"), rows


GROUPS = {
    "one": [7], "zero": [0, 0], "flat": [3, 3, 3, 3], "ties": [9, 5, 5, 5, 1, 1, 1, 1],
    **{f"r{s}": [random.Random(s).choice([1, 1, 2, 3, 40, 400]) for _ in range(30)] for s in range(6)},
}


def test_entropy_and_normal_form(spark):
    df, _ = counts_frame(spark, GROUPS)
    for r in entropy.entropy(df, ["g"]).collect():
        assert r.entropy == pytest.approx(h(GROUPS[r.g]), abs=1e-9)
        assert r.norm == pytest.approx(norm(GROUPS[r.g]), abs=1e-9)


def test_peeling_equals_recounting(spark):
    df, _ = counts_frame(spark, GROUPS)
    got = {(r.g, r.removed): r for r in entropy.peel_entropy(df, ["g"]).collect()}
    for g, cs in GROUPS.items():
        left = sorted(cs, reverse=True)
        for i in range(len(left)):
            assert got[g, i].entropy == pytest.approx(h(left[i:]), abs=1e-9)
            assert got[g, i].norm == pytest.approx(norm(left[i:]), abs=1e-9)
    assert len(got) == sum(map(len, GROUPS.values()))


@pytest.mark.parametrize("threshold,limit,normed", [(1.0, 0, False), (2.5, 5, False), (0.8, 0, True), (1.0, 10, True)])
def test_general_entropy_equals_the_loop(spark, threshold, limit, normed):
    df, rows = counts_frame(spark, GROUPS)
    measure = norm if normed else h
    want = {}
    for g in GROUPS:
        left = sorted(((k, n) for x, k, n in rows if x == g), key=lambda e: (-e[1], e[0]))
        if sum(n for _, n in left) < limit:
            continue
        while True:
            value = measure([n for _, n in left])
            if value < threshold and left:
                want[g, left[0][0]] = value
            left = left[1:]
            if not (sum(n for _, n in left) > limit and value < threshold):
                break
    got = entropy.general_entropy(df, ["g"], "k", threshold=threshold, limit=limit, normed=normed, salts=3)
    have = {(r.g, r.k): r.entropy for r in got.collect()}
    assert have.keys() == want.keys()
    for key in want:
        assert have[key] == pytest.approx(want[key], abs=1e-9)


@pytest.mark.parametrize("threshold", [0.3, 0.75, 1.0])
def test_action_entropy_equals_the_loop(spark, threshold):
    groups = {k: v for k, v in GROUPS.items() if sum(v)}
    groups["padded"] = [100, 4]
    df, rows = counts_frame(spark, groups)
    channels, scored = entropy.action_entropy(df, ["g"], "k", threshold=threshold, salts=3)
    want = {}
    for g, cs in groups.items():
        left = sorted(cs, reverse=True) + [0] * max(0, sum(cs) // 4 - len(cs))
        deltas, value = [], norm(left)
        while value < threshold:
            deltas.append(threshold - value)
            left = left[min(max(1, len(deltas) // 2), len(left)):]
            value = norm(left)
        ranked = sorted((k for x, k, _ in rows if x == g), key=lambda k: (-cs[int(k[1:])], k))
        want.update({(g, k): d for k, d in zip(ranked, deltas)})
    have = {(r.g, r.k): r.delta for r in scored.collect()}
    assert have.keys() == want.keys()
    for key in want:
        assert have[key] == pytest.approx(want[key], abs=1e-9)
    totals = {r.g: (r.total, r.distinct) for r in channels.collect()}
    assert totals == {g: (sum(cs), len(cs)) for g, cs in groups.items()}


def test_threshold_above_one_is_refused(spark):
    df, _ = counts_frame(spark, {"a": [1]})
    with pytest.raises(ValueError):
        entropy.action_entropy(df, ["g"], "k", threshold=1.5)


def test_attention_list(spark):
    df = frame(spark, [("g", ["a", "b"]), ("g", ["c"]), ("g", ["a", "b"])], "g string, acts array<string>")
    rows = entropy.chain_counts(df, ["g"], "acts", ["b"]).collect()
    assert [(r.chain, r.n) for r in rows] == [("a->b", 2)]


def test_chains_are_told_apart_without_lists(spark):
    """Equal hashes for equal sequences only, ordered like the texts."""
    rng = random.Random(6)
    rows = [(u, t, rng.choice("ab")) for u in range(300) for t in range(rng.randint(1, 4))] + [(900 + u, t, "a" if t else "b") for u in (0, 1) for t in range(400)]
    rows += [(999, t, "a" if 0 < t < 399 else "b") for t in range(400)]
    timeline = sequence.timeline_rows(frame(spark, rows, "u int, time bigint, action string"), ["u"])
    got = {r.u: r.chain for r in entropy.user_chains(timeline, ["u"]).collect()}
    text = {u: "->".join(a for v, t, a in sorted(rows) if v == u) for u in got}
    assert {(got[u] == got[v]) == (text[u] == text[v]) for u in got for v in got} == {True}
    short = sorted((u for u in got if u < 900), key=lambda u: text[u])
    assert [got[u] for u in short] == sorted(got[u] for u in short)
    assert max(map(len, got.values())) < 1000
