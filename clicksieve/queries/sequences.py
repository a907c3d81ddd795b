"""Queries of timelines, gaps, tokens, Markov models and entropies."""

from pyspark.sql import functions as F

from clicksieve.operators import aggregate as agg
from clicksieve.operators import distribution, entropy, sequence
from clicksieve.queries.base import HIST, LOG, ctes, hist, log, query, rounded
from clicksieve.session import keep_table

# Rows are searches; a row with event_id mod 3 = 0 (tp "0") or 1 (tp "1") has as
# many clicks as the last digit of event_id mod 3, the second without a time.


def _clicks():
    return F.expr("""transform(filter(sequence(1, 2), j -> j <= event_id % 3),
        j -> case when j = 2 then 'x' else concat(cast(t_ms + 1000 * j as string), '.5') end)""")


def _ad_clicks():
    return F.expr("""transform(filter(sequence(1, 1), j -> act = 'purchase'), j -> 'null')""")


def _rows(spark, folder):
    return log(spark, folder), F.concat(F.lit("search_"), F.substring("act", 1, 1)), F.col("t_ms").cast("string")


def _events(spark, folder):
    rows, action, time = _rows(spark, folder)
    return sequence.timeline_events(rows, ["srcg", "guid"], action, time, _clicks(), _ad_clicks())


def _timeline(spark, folder):
    """All events, numbered by user, as a table: tokens read it twice."""
    return keep_table(sequence.timeline_rows(_events(spark, folder), ["srcg", "guid"]), "timeline")


TIMELINE = """ev AS (
  SELECT srcg, guid, t_ms t, concat('search_', substr(act, 1, 1)) a FROM log WHERE tp <= '1'
  UNION SELECT srcg, guid, t_ms + 1000, 'click' FROM log WHERE tp <= '1' AND event_id % 3 >= 1
  UNION SELECT srcg, guid, t_ms + 10000, 'click' FROM log WHERE tp <= '1' AND event_id % 3 >= 2
  UNION SELECT srcg, guid, t_ms + 10000 * (event_id % 3 + 1), 'adclick' FROM log WHERE tp <= '1' AND act = 'purchase'),
tl AS (SELECT *, row_number() OVER (PARTITION BY srcg, guid ORDER BY t, a) r FROM ev)"""


@query("action_timeline", ctes(LOG, TIMELINE) + 'SELECT srcg, guid, r - 1 place, t "time", a "action" FROM tl')
def action_timeline(spark, folder):
    return sequence.timeline_rows(_events(spark, folder), ["srcg", "guid"])


LIST = 20  # actions in an exported list


@query("action_lists", ctes(LOG, TIMELINE) + f"""
SELECT srcg, guid, string_agg(a, '->' ORDER BY r) actions, string_agg(CAST(t AS VARCHAR), ',' ORDER BY r) times
FROM tl WHERE r <= {LIST} GROUP BY ALL""")
def action_lists(spark, folder):
    rows, action, time = _rows(spark, folder)
    lists = sequence.action_timeline(rows, ["srcg", "guid"], action, time, _clicks(), _ad_clicks(), limit=LIST)
    return lists.select(
        "srcg", "guid", F.array_join("actions", "->").alias("actions"),
        F.array_join(F.col("times").cast("array<string>"), ",").alias("times"))


_SOURCES = ["lm", "home_a", "se9|_", "srp_paging", "srp_x", "tab_", "know_side_nl", "related_", "pdr_guide1", "other", "xlm"]


@query("search_classes", ctes(LOG) + ", s AS (SELECT srcg, [" + ", ".join(f"'{x}'" for x in _SOURCES) + f"][1 + event_id % {len(_SOURCES)}] src FROM log)"
       + " SELECT srcg, CASE " + " ".join(f"WHEN regexp_full_match(src, '{'|'.join(p)}') THEN '{n}'" for n, p in sequence.ACTION_RULES)
       + " END kind, count(*) n FROM s GROUP BY ALL")
def search_classes(spark, folder):
    source = F.element_at(F.array(*[F.lit(x) for x in _SOURCES]), (F.col("event_id") % len(_SOURCES) + 1).cast("int"))
    return log(spark, folder).groupBy("srcg", sequence.search_class(source).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("time_gap_histogram", ctes(LOG) + """
, g AS (SELECT guid, (t_ms - lag(t_ms) OVER (PARTITION BY guid ORDER BY t_ms, event_id)) // 3600000 s FROM log)
SELECT guid, least(s, 9) gap, count(*) n FROM g WHERE s IS NOT NULL AND s <= 24 GROUP BY ALL""")
def time_gap_histogram(spark, folder):
    return sequence.time_gap_histogram(
        log(spark, folder), ["guid"], "t_ms", step=3_600_000, session_gap=24, max_step=10)


TOKENS = """nx AS (SELECT *, t - lag(t) OVER w gap, lead(t) OVER w IS NULL ends FROM tl
  WINDOW w AS (PARTITION BY srcg, guid ORDER BY r)),
tokens AS (
  SELECT srcg, guid, 0 pos, 'start' token FROM nx WHERE r = 1
  UNION ALL SELECT srcg, guid, 2 * r - 2, CASE WHEN gap // 1000 = 0 THEN 't-1'
    ELSE concat('t', CAST(least(CAST(floor(ln(gap // 1000) / ln(6.0)) AS BIGINT), 5) AS VARCHAR)) END FROM nx WHERE r > 1
  UNION ALL SELECT srcg, guid, 2 * r - 1, a FROM nx
  UNION ALL SELECT srcg, guid, 2 * r, 'end' FROM nx WHERE ends)"""

VOCABULARY = {t: i for i, t in enumerate(
    ["start", "end", "click", "adclick", *(f"search_{c}" for c in "cepsv"), *(f"t{i}" for i in range(-1, 6))])}


@query("think_time_tokens", ctes(LOG, TIMELINE, TOKENS) + "SELECT * FROM tokens")
def think_time_tokens(spark, folder):
    return sequence.think_time_rows(_timeline(spark, folder), ["srcg", "guid"])


@query("token_ids", ctes(LOG, TIMELINE, TOKENS) + ", v(w, i) AS (VALUES " + ", ".join(
    f"('{w}', {i})" for w, i in VOCABULARY.items()) + ") SELECT srcg, guid, pos, i id FROM tokens JOIN v ON w = token")
def token_ids(spark, folder):
    rows = sequence.think_time_rows(_timeline(spark, folder), ["srcg", "guid"])
    return rows.select("srcg", "guid", "pos", sequence.token_id(F.col("token"), VOCABULARY).alias("id"))


# Markov ------------------------------------------------------------------------

DEPTH, MIN_COUNT, MIN_ROOT = 4, 20, 500
_SEP_SQL = "chr(1)"

# ctx lists the previous actions, oldest first
GRAMS = "gr AS (" + " UNION ALL ".join(
    f"SELECT srcg, guid, r, {n} len, "
    + ("''" if n == 0 else f" || {_SEP_SQL} || ".join(f"lag(a, {k}) OVER w" for k in range(n, 0, -1)))
    + ' ctx, a AS "next" FROM tl WINDOW w AS (PARTITION BY srcg, guid ORDER BY r)'
    for n in range(DEPTH)) + f"""),
cc AS (SELECT srcg, len, ctx, "next", count(*) n FROM gr WHERE ctx IS NOT NULL GROUP BY ALL),
rt AS (SELECT srcg, sum(n) root FROM cc WHERE len = 0 GROUP BY srcg HAVING sum(n) > {MIN_ROOT}),
counts AS (SELECT cc.* FROM cc JOIN rt USING (srcg)),
tot AS (SELECT *, sum(n) OVER (PARTITION BY srcg, len, ctx) total FROM counts),
probs AS (SELECT srcg, len, ctx, "next", n, n / total p FROM tot WHERE total > {MIN_COUNT})"""


def _contexts(spark, folder):
    """One row per action with the actions before it, as a table: fitting and scoring read it."""
    return keep_table(sequence.event_contexts(_events(spark, folder), ["srcg", "guid"], DEPTH), "contexts")


def _counts(contexts):
    return keep_table(sequence.context_counts(contexts, ["srcg"], DEPTH, MIN_ROOT), "context-counts")


@query("context_counts", ctes(LOG, TIMELINE, GRAMS) + 'SELECT srcg, len, ctx, "next", n FROM counts')
def context_counts(spark, folder):
    return _counts(_contexts(spark, folder))


@query("context_probs", ctes(LOG, TIMELINE, GRAMS) + 'SELECT srcg, len, ctx, "next", n, round(p, 6) p FROM probs')
def context_probs(spark, folder):
    probs = sequence.context_probs(_counts(_contexts(spark, folder)), ["srcg"], MIN_COUNT)
    return probs.select("srcg", "len", "ctx", "next", "n", rounded("p"))


PRIOR = {"click": 0.3, "adclick": 0.1, "search_c": 0.15, "search_e": 0.1, "search_p": 0.1, "search_s": 0.05, "search_v": 0.2}


@query("sequence_likelihood", ctes(LOG, TIMELINE, GRAMS) + ", prior(\"next\", q) AS (VALUES " + ", ".join(
    f"('{k}', {v}::DOUBLE)" for k, v in PRIOR.items()) + """)
, best AS (SELECT gr.srcg, gr.guid, gr.r, any_value(gr."next") "next", max(gr.len) len
   FROM gr JOIN (SELECT DISTINCT srcg, len, ctx FROM probs) k ON k.srcg = gr.srcg AND k.len = gr.len AND k.ctx = gr.ctx GROUP BY ALL)
, pr AS (SELECT best.srcg, best.guid, best.r, coalesce(probs.p, 1e-7) p, prior.q
   FROM best JOIN gr ON gr.srcg = best.srcg AND gr.guid = best.guid AND gr.r = best.r AND gr.len = best.len
   JOIN prior ON prior."next" = best."next"
   LEFT JOIN probs ON probs.srcg = best.srcg AND probs.len = best.len AND probs.ctx = gr.ctx AND probs."next" = best."next")
, sz AS (SELECT srcg, guid, count(*) c FROM tl GROUP BY ALL)
SELECT sz.srcg, sz.guid, round(CASE WHEN sz.srcg NOT IN (SELECT srcg FROM rt) THEN 0.0 WHEN c = 1 THEN 1.0
   ELSE (SELECT exp(sum(ln(p / q)) / (sz.c - 1)) FROM pr WHERE pr.srcg = sz.srcg AND pr.guid = sz.guid) END, 5) score FROM sz""")
def sequence_likelihood(spark, folder):
    contexts = _contexts(spark, folder)
    model = keep_table(sequence.context_probs(_counts(contexts), ["srcg"], MIN_COUNT), "model")
    scored = sequence.sequence_likelihood(contexts, ["srcg"], ["guid"], model, depth=DEPTH, prior=PRIOR)
    return scored.select("srcg", "guid", rounded("score", 5))


# Entropies -----------------------------------------------------------------------

_ACT = "f AS (SELECT srcg, q k, count(*) n FROM log GROUP BY ALL)"


def _queries(spark, folder):
    return agg.histogram(log(spark, folder), ["srcg"], F.col("q"))


@query("entropy", ctes(LOG, _ACT) + """
, p AS (SELECT srcg, n / sum(n) OVER (PARTITION BY srcg) p FROM f)
SELECT srcg, count(*) categories, round(-sum(p * log2(p)), 6) entropy, round(-sum(p * log2(p)) / log2(count(*)), 6) norm FROM p GROUP BY srcg""")
def shannon(spark, folder):
    out = entropy.entropy(_queries(spark, folder), ["srcg"])
    return out.select("srcg", "categories", rounded("entropy"), rounded("norm"))


@query("peel_entropy", ctes(LOG, _ACT) + """
, o AS (SELECT *, row_number() OVER (PARTITION BY srcg ORDER BY n DESC, k) r, count(*) OVER (PARTITION BY srcg) c FROM f)
, s AS (SELECT a.srcg, a.r, a.c, b.n, sum(b.n) OVER (PARTITION BY a.srcg, a.r) t FROM o a JOIN o b ON a.srcg = b.srcg AND b.r >= a.r)
SELECT srcg, r - 1 removed, CAST(max(t) AS DOUBLE) remaining, abs(round(-sum(n / t * log2(n / t)), 6)) entropy,
       round(CASE WHEN c - r + 1 <= 1 THEN 1.0 ELSE -sum(n / t * log2(n / t)) / log2(c - r + 1) END, 6) norm FROM s GROUP BY srcg, r, c""")
def peel_entropy(spark, folder):
    out = entropy.peel_entropy(_queries(spark, folder), ["srcg"])
    return out.select("srcg", "removed", "remaining", rounded("entropy"), rounded("norm"))


_SKEWED = "f AS (SELECT srcg, CAST(floor(ln(value + 1) * 2) AS INTEGER) k, count(*) n FROM log GROUP BY ALL)"


_WALK = "WITH RECURSIVE " + ",\n".join([LOG, _SKEWED]) + """
, o AS (SELECT srcg, k, n, row_number() OVER (PARTITION BY srcg ORDER BY n DESC, k) r FROM f)
, h AS (SELECT a.srcg, a.k, a.n, a.r, (SELECT sum(b.n) FROM o b WHERE b.srcg = a.srcg AND b.r >= a.r) t,
   (SELECT -sum(b.n / tt * log2(b.n / tt)) FROM o b, (SELECT sum(c.n) tt FROM o c WHERE c.srcg = a.srcg AND c.r >= a.r) WHERE b.srcg = a.srcg AND b.r >= a.r) e FROM o a)
, walk AS (SELECT srcg, k, n, r, e FROM h WHERE r = 1 AND e < 3.4 AND t >= 20
   UNION ALL SELECT h.srcg, h.k, h.n, h.r, h.e FROM walk JOIN h ON h.srcg = walk.srcg AND h.r = walk.r + 1 WHERE h.e < 3.4 AND h.t > 20)"""


def _peeled(spark, folder):
    rows = log(spark, folder).withColumn("k", F.floor(F.ln(F.col("value") + 1) * 2).cast("int"))
    counts = keep_table(rows.groupBy("srcg", "k").agg(F.count(F.lit(1)).alias("n")), "counts")
    return counts, entropy.general_entropy(counts, ["srcg"], "k", threshold=3.4, limit=20)


@query("general_entropy", _WALK + """
SELECT srcg, k, n, r "rank", abs(round(e, 6)) entropy FROM walk""")
def general_entropy(spark, folder):
    _, out = _peeled(spark, folder)
    return out.select("srcg", "k", "n", F.col("rank").cast("bigint").alias("rank"), rounded("entropy"))


@query("entropy_scores", _WALK + """
SELECT f.srcg, f.k, f.n, coalesce(abs(round(e, 6)), 100.0::DOUBLE) score FROM f LEFT JOIN walk ON walk.srcg = f.srcg AND walk.k = f.k""")
def entropy_scores(spark, folder):
    counts, out = _peeled(spark, folder)
    return entropy.entropy_scores(counts, out, ["srcg"], "k").select("srcg", "k", "n", F.abs(F.round("score", 6)).alias("score"))


@query("peeled_text", _WALK + """
SELECT srcg, string_agg(concat(CAST(k AS VARCHAR), ':', format('{:.3f}', abs(e) + 1e-12)), '|' ORDER BY r) peeled FROM walk GROUP BY srcg""")
def peeled_text(spark, folder):
    return entropy.peeled_text(_peeled(spark, folder)[1], ["srcg"], "k")


# Chains of actions by day parts: few distinct ones, so that peeling has work to do.
_CHAINS = """cu AS (SELECT srcg, guid, t_ms // 43200000 part, string_agg(act, '->' ORDER BY t_ms, act) chain,
   count(*) c FROM log GROUP BY ALL),
ch AS (SELECT srcg, chain, count(*) n FROM cu GROUP BY ALL)"""


def _chains(spark, folder):
    """The chain of each user and day part, and how many have it, as tables."""
    rows = log(spark, folder).select(
        "srcg", "guid", F.floor(F.col("t_ms") / 43_200_000).alias("part"), F.col("t_ms").alias("time"),
        F.col("act").alias("action"))
    keys = ["srcg", "guid", "part"]
    users = keep_table(entropy.user_chains(sequence.timeline_rows(rows, keys), keys), "user-chains")
    return users, keep_table(users.groupBy("srcg", "chain").agg(F.count(F.lit(1)).alias("n")), "chains")


@query("action_entropy", "WITH RECURSIVE " + ",\n".join([LOG, _CHAINS]) + """
, o AS (SELECT srcg, chain, n, row_number() OVER w r, sum(n) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) s,
   sum(n * log2(n)) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) l FROM ch WINDOW w AS (PARTITION BY srcg ORDER BY n DESC, chain))
, g AS (SELECT srcg, CAST(sum(n) AS BIGINT) total, count(*) keys, greatest(count(*), CAST(sum(n) AS BIGINT) // 4) padded FROM ch GROUP BY srcg)
, st AS (SELECT srcg, padded, CAST(1 AS BIGINT) step, CAST(0 AS BIGINT) gone FROM g
   UNION ALL SELECT srcg, padded, step + 1, least(gone + greatest(1, step // 2), padded) FROM st WHERE gone < padded)
, h AS (SELECT st.srcg, step, gone, CASE WHEN padded - gone <= 1 THEN 1.0 WHEN s IS NULL THEN 0.0
   ELSE greatest(log2(s) - l / s, 0) / log2(padded - gone) END e FROM st LEFT JOIN o ON o.srcg = st.srcg AND o.r = gone + 1)
, stop AS (SELECT srcg, min(step) step FROM h WHERE e >= 0.75 GROUP BY srcg)
, top AS (SELECT o.srcg, o.chain, 0.75 - h.e delta FROM o JOIN h ON h.srcg = o.srcg AND h.step = o.r
   LEFT JOIN stop ON stop.srcg = h.srcg WHERE stop.step IS NULL OR h.step < stop.step)
SELECT cu.srcg, cu.guid, cu.part, round(coalesce(delta, 0.0), 6) user_score, total, keys "distinct", round(h.e, 6) entropy
FROM cu JOIN g USING (srcg) JOIN h ON h.srcg = cu.srcg AND h.step = 1 LEFT JOIN top ON top.srcg = cu.srcg AND top.chain = cu.chain""")
def action_entropy(spark, folder):
    users, chains = _chains(spark, folder)
    channels, scored = entropy.action_entropy(chains, ["srcg"], "chain", threshold=0.75)
    scored = scored.select("srcg", "chain", F.col("delta").alias("user_score"))
    out = distribution.lookup(users, scored, ["srcg", "chain"], {"user_score": F.lit(0.0)})
    return agg.same_keys(out, channels, ["srcg"]).select(
        "srcg", "guid", "part", rounded("user_score"), "total", "distinct", rounded("entropy"))


# Distributions ---------------------------------------------------------------------

_LANGS = ["de", "en", "es", "fr"]
_WORLD = "w AS (SELECT lang k, count(*) p FROM documents GROUP BY lang)"


def _against_world(spark, folder):
    own = distribution.complete_keys(hist(spark, folder), ["grp"], _LANGS)
    world = own.groupBy("k").agg(F.sum("n").alias("p"))
    return agg.same_keys(own, world, ["k"], "inner")


_FULL = """, full_ AS (SELECT g.grp, w.k, w.p, coalesce(hist.n, 0) n FROM (SELECT DISTINCT grp FROM hist) g CROSS JOIN w
   LEFT JOIN hist ON hist.grp = g.grp AND hist.k = w.k)
, sh AS (SELECT grp, k, p / sum(p) OVER (PARTITION BY grp) p, n / sum(n) OVER (PARTITION BY grp) q FROM full_)"""


@query("relative_entropy", ctes(HIST, _WORLD) + _FULL + """
SELECT grp, round(sum(p * ln(p / (q + 1e-7::DOUBLE))), 5) kl FROM sh GROUP BY grp""")
def relative_entropy(spark, folder):
    out = distribution.relative_entropy(_against_world(spark, folder), ["grp"], "p", "n")
    return out.select("grp", rounded("kl", 5))


@query("share_excess", ctes(HIST, _WORLD) + _FULL + """
SELECT grp, k, round(q - p, 6) excess FROM sh WHERE q - p > 0.001""")
def share_excess(spark, folder):
    out = distribution.share_excess(_against_world(spark, folder), ["grp"], "p", "n", 0.001)
    return out.select("grp", "k", rounded("excess"))


STANDARD = {"click": (0.15, 0.02), "error": (0.1, 0.02), "purchase": (0.1, 0.03), "signup": (0.25, 0.02), "view": (0.4, 0.05)}
SECOND = {"click": (0.2, 0.02), "error": (0.2, 0.02), "purchase": (0.2, 0.02), "signup": (0.2, 0.02), "view": (0.2, 0.02)}
REMIT = {"view": (0.05, 0.5), "click": (0.1, 0.2)}


def _std_sql(name, std):
    return f"{name}(k, mean, sd) AS (VALUES " + ", ".join(
        f"('{k}', {m}::DOUBLE, {s}::DOUBLE)" for k, (m, s) in std.items()) + ")"


def _distribution_sql(limit: int, remit: bool) -> str:
    over = "CASE WHEN remit.k IS NOT NULL AND top_key = 'click' THEN remit.{c} ELSE s.{c} END" if remit else "s.{c}"
    return ctes(LOG, _std_sql("std1", STANDARD), _std_sql("std2", SECOND), _std_sql("remit", REMIT)) + f"""
, h AS (SELECT site, srcg, act k, count(*) n FROM log GROUP BY ALL)
, g AS (SELECT site, srcg, CAST(sum(n) AS DOUBLE) total, arg_min(k, (-n, k)) top_key FROM h GROUP BY ALL)
, s AS (SELECT 1 v, *, mean / sum(mean) OVER () p FROM std1 UNION ALL SELECT 2, *, mean / sum(mean) OVER () FROM std2)
, x AS (SELECT g.site, g.srcg, g.total, s.v, s.k, s.p, coalesce(h.n, 0) / g.total q, coalesce(h.n, 0) / (g.total + 0.001) share_,
     {over.format(c='mean')} mean, {over.format(c='sd')} sd
   FROM g CROSS JOIN s LEFT JOIN h ON h.site = g.site AND h.srcg = g.srcg AND h.k = s.k LEFT JOIN remit ON remit.k = s.k)
, kl AS (SELECT site, srcg, total, v, sum(p * ln(p / (q + 1e-7))) kl FROM x GROUP BY ALL)
, pick AS (SELECT site, srcg, total, min(kl) score, CASE WHEN min(kl) FILTER (v = 2) < min(kl) FILTER (v = 1) THEN 2 ELSE 1 END v FROM kl GROUP BY ALL)
, e AS (SELECT x.site, x.srcg, x.k, pick.total, CASE WHEN pick.total >= {limit} THEN score ELSE 0 END score,
     CASE WHEN pick.total >= {limit} THEN greatest((share_ - mean) / (sd + 1e-7), 0) ELSE 0 END d
   FROM x JOIN pick ON x.site = pick.site AND x.srcg = pick.srcg AND x.v = pick.v)
, u AS (SELECT site, srcg, guid, act k, count(*) n FROM log GROUP BY ALL)
SELECT u.site, u.srcg, u.guid, round(sum(u.n * e.d) / sum(u.n), 6) user_score, round(max(e.score), 5) group_score
FROM u JOIN e ON u.site = e.site AND u.srcg = e.srcg AND u.k = e.k GROUP BY ALL"""


def _distribution(spark, folder, limit, remit=None):
    users = agg.histogram(log(spark, folder), ["site", "srcg", "guid"], F.col("act"))
    groups = distribution.distribution_groups(
        users, ["site", "srcg"], STANDARD, second=SECOND, limit=limit, remit=remit)
    out = distribution.distribution_users(users, ["site", "srcg"], ["guid"], groups)
    return out.select("site", "srcg", "guid", rounded("user_score"), rounded("group_score", 5))


@query("distribution_feature", _distribution_sql(210, False))
def distribution_feature(spark, folder):
    return _distribution(spark, folder, 210)


@query("distribution_feature_override", _distribution_sql(0, True))
def distribution_feature_override(spark, folder):
    return _distribution(spark, folder, 0, distribution.Remit(F.col("top_key") == "click", REMIT))


def _groups_sql():
    body = _distribution_sql(210, False)
    return body[:body.index(", u AS (SELECT site, srcg, guid")] + """
SELECT g.site, g.srcg, g.total, (SELECT round(any_value(score), 5) FROM e WHERE e.site = g.site AND e.srcg = g.srcg) score,
  (SELECT string_agg(concat(k, ':', CAST(n AS VARCHAR)), '|' ORDER BY n DESC, k) FROM h WHERE h.site = g.site AND h.srcg = g.srcg) hist,
  (SELECT string_agg(concat(k, ':', format('{:.3f}', n / g.total + 1e-12)), '|' ORDER BY n DESC, k) FROM h WHERE h.site = g.site AND h.srcg = g.srcg) shares,
  coalesce((SELECT string_agg(concat(k, ':', format('{:.3f}', d + 1e-12)), '|' ORDER BY d DESC, k) FROM e WHERE e.site = g.site AND e.srcg = g.srcg AND d > 0), '') excess_text
FROM g"""


@query("distribution_groups", _groups_sql())
def distribution_groups(spark, folder):
    users = agg.histogram(log(spark, folder), ["site", "srcg", "guid"], F.col("act"))
    out = distribution.distribution_groups(users, ["site", "srcg"], STANDARD, second=SECOND, limit=210)
    return out.select("site", "srcg", "total", rounded("score", 5), "hist", "shares", "excess_text")


@query("fit_standard", ctes(HIST) + """
, ks(k) AS (VALUES ('de'), ('en'), ('es'), ('fr'))
, s AS (SELECT g.grp, ks.k, coalesce(hist.n, 0) / (SELECT sum(n) FROM hist h2 WHERE h2.grp = g.grp) sh
   FROM (SELECT DISTINCT grp FROM hist) g CROSS JOIN ks LEFT JOIN hist ON hist.grp = g.grp AND hist.k = ks.k)
SELECT k, round(avg(sh), 6) mean, round(stddev_pop(sh), 6) std FROM s GROUP BY k""")
def fit_standard(spark, folder):
    return distribution.fit_standard(hist(spark, folder), ["grp"], _LANGS).select("k", rounded("mean"), rounded("std"))


@query("redistribute_by_frequency", ctes(LOG) + """
, u AS (SELECT srcg, guid, q k, count(*) n FROM log GROUP BY ALL)
, z AS (SELECT srcg, count(*) "size" FROM log GROUP BY srcg)
, t AS (SELECT u.srcg, k, sum(n) * 5000.0::DOUBLE / any_value("size") t FROM u JOIN z USING (srcg) GROUP BY ALL)
SELECT u.srcg, u.guid, CASE WHEN t <= 10 THEN 10 WHEN t <= 40 THEN 40 WHEN t <= 60 THEN 60 ELSE 100 END bin, CAST(sum(n) AS BIGINT) n
FROM u JOIN t ON u.srcg = t.srcg AND u.k = t.k GROUP BY ALL""")
def redistribute_by_frequency(spark, folder):
    rows = log(spark, folder)
    users = agg.histogram(rows, ["srcg", "guid"], F.col("q"))
    sizes = rows.groupBy("srcg").agg(F.count(F.lit(1)).alias("size"))
    return distribution.redistribute_by_frequency(users, ["srcg"], ["guid"], [40, 10, 60, 100], sizes=sizes)


@query("join_bin_dict", ctes(LOG) + """
, t AS (SELECT srcg, q, count(*) t FROM log GROUP BY ALL)
SELECT event_id, CASE WHEN t <= 5 THEN 5 WHEN t <= 15 THEN 15 ELSE 30 END bin FROM log LEFT JOIN t ON t.srcg = log.srcg AND t.q = log.q""")
def join_bin_dict(spark, folder):
    from clicksieve.functions.histogram import edge_bin

    rows = log(spark, folder)
    totals = agg.histogram(rows, ["srcg"], F.col("q"), clean=False).withColumn("bin", edge_bin(F.col("n"), [5, 15, 30]))
    named = totals.select("srcg", F.col("k").alias("q"), "bin")
    return distribution.lookup(rows, named, ["srcg", "q"], {"bin": F.lit(30)}).select("event_id", "bin")
