"""Queries of the group features and their reports."""

from pyspark.sql import functions as F

from clicksieve.functions import detail
from clicksieve.functions.unfold import unfold_structs
from clicksieve.operators import aggregate as agg
from clicksieve.queries.base import ADLOG, ADVIEWS, CHECKS, LOG, RULES, adlog, adviews, checks, ctes, log, query, rounded, table

DIMS = ["site", "srcg"]


def _hour():
    return F.hour(F.timestamp_millis("t_ms"))


_HOUR_SQL = "CAST(extract(hour FROM make_timestamp(t_ms * 1000)) AS INTEGER)"


@query("fused_group_agg", ctes(LOG) + f"""
, h AS (SELECT site, srcg, {_HOUR_SQL} h, count(*) n FROM log GROUP BY ALL)
, a AS (SELECT site, srcg, act k, sum(value) w FROM log GROUP BY ALL)
, hs AS (SELECT site, srcg, count(*) AS "hours", round(max(n) / sum(n), 6) hourMaxRatio, round(var_pop(n), 4) hourDev FROM h GROUP BY site, srcg)
, asum AS (SELECT site, srcg, round(max(w), 4) actMax, arg_max(k, w) topAct FROM a GROUP BY site, srcg)
, s AS (SELECT site, srcg, count(*) SPV, round(sum(value), 4) "value", CAST(min(t_ms) AS BIGINT) first_ms FROM log GROUP BY site, srcg)
SELECT s.*, "hours", hourMaxRatio, hourDev, actMax, topAct FROM s JOIN hs USING (site, srcg) JOIN asum USING (site, srcg)""")
def fused_group_agg(spark, folder):
    out = agg.group_features(
        log(spark, folder), DIMS,
        [agg.Scalar("SPV", "count", F.lit(1)), agg.Scalar("value", "sum", F.col("value")),
         agg.Scalar("first_ms", "min", F.col("t_ms"))],
        [agg.Keyed("hour", _hour(), {"hours": "distinct", "hourMaxRatio": "share", "hourDev": "dev"}),
         agg.Keyed("act", F.col("act"), {"actMax": "max", "topAct": "top"}, F.col("value"))])
    return out.select(
        *DIMS, "SPV", rounded("value", 4), "first_ms", "hours", rounded("hourMaxRatio"), rounded("hourDev", 4),
        rounded("actMax", 4), "topAct")


@query("distinct_count", ctes(LOG) + """
SELECT site, srcg, count(DISTINCT guid) users, count(DISTINCT q) queries FROM log GROUP BY ALL""")
def distinct_count(spark, folder):
    return agg.distinct_count(log(spark, folder), DIMS, {"users": F.col("guid"), "queries": F.col("q")})


@query("freq_stats", ctes(LOG) + """
, f AS (SELECT srcg, q, count(*) n FROM log GROUP BY ALL)
SELECT srcg, count(*) q, CAST(max(n) AS DOUBLE) qMax, CAST(min(n) AS DOUBLE) qMin, round(avg(n), 6) qMean,
       round(var_pop(n), 6) qDev FROM f GROUP BY srcg""")
def freq_stats(spark, folder):
    out = agg.freq_stats(log(spark, folder), ["srcg"], F.col("q"), "q")
    return out.select("srcg", "q", "qMax", "qMin", rounded("qMean"), rounded("qDev"))


@query("distinct_count_if", ctes(LOG) + """
SELECT guid, count(DISTINCT CASE WHEN act = 'click' THEN q END) clicked, count(DISTINCT CASE WHEN value > 50 THEN q END) dear
FROM log GROUP BY guid""")
def distinct_count_if(spark, folder):
    where = lambda cond: F.when(F.expr(cond), F.col("q"))
    return agg.distinct_count(
        log(spark, folder), ["guid"], {"clicked": where("act = 'click'"), "dear": where("value > 50")})


@query("pooled_distinct", ctes(ADLOG) + """
, p AS (SELECT srcg, v, count(*) n FROM (SELECT srcg, industry v FROM adrows UNION ALL SELECT srcg, sub_industry FROM adrows) GROUP BY ALL)
SELECT srcg, count(*) pooled, CAST(max(n) AS DOUBLE) pooledMax, round(avg(n), 6) pooledMean FROM p GROUP BY srcg""")
def pooled_distinct(spark, folder):
    rows = unfold_structs(adlog(spark, folder), ["srcg"], detail.parse_details(F.col("ads_details")))
    out = agg.pooled_distinct(rows, ["srcg"], [F.col("industry"), F.col("sub_industry")], "pooled", ["Max", "Mean"])
    return out.select("srcg", "pooled", "pooledMax", rounded("pooledMean"))


@query("numeric_count_sum", ctes(LOG) + """
SELECT srcg, CAST(count(*) AS DOUBLE) SPV, coalesce(round(sum(value), 4), 0) spent,
       CAST(count(*) FILTER (act = 'click') AS DOUBLE) clicks,
       coalesce(round(sum(value) FILTER (act = 'click' AND tp IN ('0', '1')), 4), 0) click_value FROM log GROUP BY srcg""")
def numeric_count_sum(spark, folder):
    click = F.col("act") == "click"
    out = agg.numeric_features(log(spark, folder), ["srcg"], [
        agg.Numeric("SPV", F.col("event_id")), agg.Numeric("spent", F.col("value"), total=True),
        agg.Numeric("clicks", F.col("event_id"), where=click),
        agg.Numeric("click_value", F.col("value"), total=True, where=click, types=["0", "1"])])
    return out.select("srcg", "SPV", rounded("spent", 4), "clicks", rounded("click_value", 4))


@query("weighted_histogram", ctes(ADLOG) + """
, w AS (SELECT srcg, industry, sum(clicknum) w FROM adrows WHERE clicknum > 0 GROUP BY ALL)
SELECT srcg, count(*) keys, CAST(max(w) AS DOUBLE) "max", round(max(w) / sum(w), 6) max_share FROM w GROUP BY srcg""")
def weighted_histogram(spark, folder):
    rows = unfold_structs(adlog(spark, folder), ["srcg"], detail.parse_details(F.col("ads_details")))
    clicks = F.col("ad_clicknum").cast("int")
    out = agg.weighted_histogram(rows, ["srcg"], F.col("industry"), clicks, clicks > 0)
    return out.filter("keys > 0").select("srcg", "keys", "max", rounded("max_share"))


@query("value_distribution", ctes(LOG) + """
, d AS (SELECT site, srcg, CASE WHEN act IN ('view', 'click', 'purchase') THEN act ELSE 'other' END k, count(*) n FROM log GROUP BY ALL)
SELECT site, srcg, CAST(sum(n) AS DOUBLE) total, round(max(n) / sum(n), 6) top_share,
       string_agg(concat(k, ':', CAST(n AS VARCHAR)), '|' ORDER BY n DESC, k) hist,
       string_agg(concat(k, ':', format('{:.3f}', n / t + 1e-12)), '|' ORDER BY n DESC, k) shares
FROM (SELECT *, sum(n) OVER (PARTITION BY site, srcg) t FROM d) GROUP BY site, srcg""")
def value_distribution(spark, folder):
    noisy = F.concat(F.lit(" "), F.col("act"), F.lit("|"))
    out = agg.value_distribution(log(spark, folder), DIMS, noisy, valid=["view", "click", "purchase"])
    return out.select(*DIMS, "total", rounded("top_share"), "hist", "shares")


@query("freq_of_freq_bins", ctes(LOG) + """
, f AS (SELECT srcg, q, count(*) n FROM log GROUP BY ALL)
, b AS (SELECT srcg, CASE WHEN n <= 1 THEN 1 WHEN n <= 5 THEN 5 WHEN n <= 10 THEN 10 WHEN n <= 15 THEN 15 WHEN n <= 20 THEN 20 ELSE 21 END e,
        count(*) c FROM f GROUP BY ALL)
SELECT srcg, string_agg(concat(CAST(e AS VARCHAR), ':', CAST(c AS VARCHAR)), '|' ORDER BY e DESC) bins FROM b GROUP BY srcg""")
def freq_of_freq_bins(spark, folder):
    return agg.freq_of_freq_bins(log(spark, folder), ["srcg"], F.col("q"), agg.bin_edges("bins", "4-20"))


@query("merge_histograms", ctes(LOG) + "SELECT srcg, act k, CAST(count(*) AS DOUBLE) n FROM log GROUP BY ALL")
def merge_histograms(spark, folder):
    users = agg.value_distribution(log(spark, folder), ["srcg", "guid"], F.col("act"))
    return agg.merge_histograms(users, ["srcg"], "hist")


@query("topn_per_group", ctes(LOG) + """
, f AS (SELECT srcg, q k, count(*) n FROM log GROUP BY ALL)
SELECT srcg, k, n, CAST(row_number() OVER (PARTITION BY srcg ORDER BY n DESC, k) AS INTEGER) "rank" FROM f
QUALIFY "rank" <= 10""")
def topn_per_group(spark, folder):
    return agg.top_entries(agg.histogram(log(spark, folder), ["srcg"], F.col("q")), ["srcg"], 10)


_SPAM_SQL = """, f AS (SELECT *, CASE WHEN act = 'error' THEN '' WHEN value > 40 THEN '1' ELSE '0' END spam FROM log)
, g AS (SELECT site, srcg, count(*) FILTER (spam <> '') judged, count(*) FILTER (spam = '1') spam FROM f GROUP BY ALL)
, r AS (SELECT *, coalesce(spam / nullif(judged, 0), 0) rate, judged > 50 AND coalesce(spam / nullif(judged, 0), 0) >= 0.29 anomalous FROM g)"""


@query("group_spam_rate", ctes(LOG) + _SPAM_SQL + """
SELECT f.site, f.srcg, judged, r.spam, round(rate, 6) rate, anomalous,
       count(*) FILTER (anomalous AND f.spam = '1') flagged
FROM f JOIN r ON f.site = r.site AND f.srcg = r.srcg GROUP BY ALL""")
def group_spam_rate(spark, folder):
    flag = F.when(F.col("act") == "error", "").when(F.col("value") > 40, "1").otherwise("0")
    rows = log(spark, folder).withColumn("flag", flag)
    rates = agg.group_spam_rate(rows, DIMS, "flag", 0.29, 50)
    judged = agg.same_keys(rows.select(*DIMS, "flag"), rates, DIMS)
    hit = (F.col("anomalous") & (F.col("flag") == "1")).cast("bigint")
    return judged.groupBy(*DIMS, "judged", "spam", F.round("rate", 6).alias("rate"), "anomalous").agg(
        F.sum(hit).alias("flagged"))


@query("majority_blacklist", ctes(CHECKS) + """
, s AS (SELECT guid, CASE WHEN greatest(QtyBySrcg, QtyByGuid, DiscBySrcg, TaxBySite, PriceByGuid) = 5 OR
  (QtyBySrcg >= 4)::INT + (QtyByGuid >= 4)::INT + (DiscBySrcg >= 4)::INT + (TaxBySite >= 4)::INT + (PriceByGuid >= 4)::INT >= 2
  THEN 1.0 ELSE 0.0 END s FROM checks)
SELECT guid, round(avg(s), 6) spam_share FROM s GROUP BY guid HAVING avg(s) > 0.5""")
def majority_blacklist(spark, folder):
    return agg.majority_blacklist(checks(spark, folder), ["guid"], RULES).select("guid", rounded("spam_share"))


@query("dominant_position", ctes(ADLOG) + """
, c AS (SELECT guid, pos, count(*) n FROM adrows WHERE clicknum > 0 GROUP BY ALL)
, t AS (SELECT guid, pos, n / sum(n) OVER (PARTITION BY guid) s, row_number() OVER (PARTITION BY guid ORDER BY n DESC, pos) r FROM c)
SELECT guid, CAST(pos AS INTEGER) "position", round(s, 6) "share" FROM t WHERE r = 1 AND s > 0.5""")
def dominant_position(spark, folder):
    rows = unfold_structs(adlog(spark, folder), ["guid"], detail.parse_details(F.col("ads_details")))
    clicked = rows.filter(F.col("ad_clicknum").cast("int") > 0)
    out = agg.dominant_position(clicked, ["guid"], F.col("pos").cast("int"), 0.5)
    return out.select("guid", "position", rounded("share"))


@query("profile_nonneg", """
WITH f AS (SELECT l_quantity - 25 a, l_discount - 0.03 b FROM lineitem)
SELECT round(avg(a) FILTER (a >= 0), 6) a_mean, round(min(a) FILTER (a >= 0), 6) a_min, round(max(a), 6) a_max,
       round(avg(a) FILTER (a > 0), 6) a_posmean, round(stddev_samp(a) FILTER (a > 0), 6) a_posstd,
       round(avg(b) FILTER (b >= 0), 6) b_mean, round(min(b) FILTER (b >= 0), 6) b_min, round(max(b), 6) b_max,
       round(avg(b) FILTER (b > 0), 6) b_posmean, round(stddev_samp(b) FILTER (b > 0), 6) b_posstd FROM f""")
def profile_nonneg(spark, folder):
    rows = table(spark, folder, "lineitem").selectExpr("l_quantity - 25D a", "l_discount - 0.03D b")
    out = agg.profile_nonneg(rows, ["a", "b"])
    return out.select(*[rounded(c) for c in out.columns])


_CH = {"s": "act IN ('view', 'click')", "c": "act = 'click'", "a": "act IN ('purchase', 'signup')", "k": "act = 'purchase'"}


@query("channel_ratio_features", ctes(LOG) + ", v AS (SELECT site, srcg, " + ", ".join(
    f"CAST(count(*) FILTER ({c}) AS DOUBLE) {n}pv, count(DISTINCT guid) FILTER ({c}) {n}uv" for n, c in _CH.items()) + """
  FROM log GROUP BY site, srcg)
SELECT site, srcg, spv SPV, cpv CPV, suv SUV, cuv CUV, apv ADSPV, kpv ADCPV, auv ADSUV, kuv ADCUV,
  round(cpv / nullif(spv, 0), 6) CTR, round(spv / nullif(suv, 0), 6) SPV2SUV, round(cpv / nullif(cuv, 0), 6) CPV2CUV,
  round(cuv / nullif(suv, 0), 6) CUV2SUV, round(kpv / nullif(apv, 0), 6) ADCPV2ADSPV, round(apv / nullif(auv, 0), 6) ADSPV2ADSUV,
  round(kpv / nullif(kuv, 0), 6) ADCPV2ADCUV, round(kuv / nullif(auv, 0), 6) ADCUV2ADSUV, round(kuv / nullif(cuv, 0), 6) ADCUV2CUV
FROM v""")
def channel_ratio_features(spark, folder):
    flag = lambda n: F.when(F.expr(_CH[n]), 1).otherwise(0)
    out = agg.channel_features(log(spark, folder), DIMS, "guid", flag("s"), flag("c"), flag("a"), flag("k"))
    plain = {"SPV", "CPV", "SUV", "CUV", "ADSPV", "ADCPV", "ADSUV", "ADCUV", *DIMS}
    return out.select(*[F.col(c) if c in plain else rounded(c) for c in out.columns])


@query("channel_catalogue", ctes(LOG) + f"""
, top AS (SELECT site, srcg, 'q' what, CAST(q AS VARCHAR) v, count(*) n FROM log GROUP BY ALL
  UNION ALL SELECT site, srcg, 'h', CAST({_HOUR_SQL} AS VARCHAR), count(*) FROM log WHERE act = 'click' GROUP BY ALL)
, share AS (SELECT site, srcg, what, max(n) / sum(n) s FROM top WHERE v IS NOT NULL GROUP BY ALL)
SELECT site, srcg, round(count(*) FILTER (act = 'signup') / count(*), 6) secondSearchRatio,
       round(count(*) FILTER (act = 'error') / count(*), 6) suggestionRatio,
       (SELECT round(any_value(s), 6) FROM share WHERE share.site = log.site AND share.srcg = log.srcg AND what = 'q') queryTopRatio,
       coalesce((SELECT round(any_value(s), 6) FROM share WHERE share.site = log.site AND share.srcg = log.srcg AND what = 'h'), 0) clickHourTopRatio,
       round(count(DISTINCT guid) / nullif(count(DISTINCT q), 0), 6) "usersPerQuery"
FROM log GROUP BY site, srcg""")
def channel_catalogue(spark, folder):
    is_ = lambda act: F.col("act") == act
    out = agg.channel_catalogue(
        log(spark, folder), DIMS, F.col("guid"), {"secondSearch": is_("signup"), "suggestion": is_("error")},
        {"query": F.col("q"), "clickHour": F.when(is_("click"), _hour())}, {"Query": F.col("q")})
    return out.select(*DIMS, *[rounded(c) for c in out.columns if c not in DIMS])


@query("user_features", ctes(LOG) + f"""
, hq AS (SELECT guid, q, count(*) n FROM log GROUP BY ALL)
, fq AS (SELECT guid, count(*) queryCount, CAST(max(n) AS DOUBLE) queryCountMax, CAST(min(n) AS DOUBLE) queryCountMin FROM hq GROUP BY guid)
, hc AS (SELECT guid, srcg, count(*) n FROM log GROUP BY ALL)
, fc AS (SELECT guid, count(*) channelCount, CAST(max(n) AS DOUBLE) channelCountMax, CAST(min(n) AS DOUBLE) channelCountMin FROM hc GROUP BY guid)
SELECT guid, CAST(count(*) AS DOUBLE) spv, CAST(count(*) FILTER (act = 'click') AS DOUBLE) cpv, count(DISTINCT {_HOUR_SQL}) hourCount,
       count(DISTINCT CASE WHEN act = 'click' THEN q END) clickedQueryCount,
       queryCount, queryCountMax, queryCountMin, channelCount, channelCountMax, channelCountMin
FROM log JOIN fq USING (guid) JOIN fc USING (guid) GROUP BY ALL""")
def user_features(spark, folder):
    clicked = F.when(F.col("act") == "click", F.col("q"))
    return agg.user_features(
        log(spark, folder), "guid", {"spv": F.lit(1), "cpv": F.when(F.col("act") == "click", 1).otherwise(0)},
        {"hourCount": _hour(), "clickedQueryCount": clicked}, {"queryCount": F.col("q"), "channelCount": F.col("srcg")})


# The catalogue of a channel's ads: what is counted, as a key that is null for rows that don't count.
_CLICKED = ["pos", "hr", "industry", "sub_industry", "address", "q", "city", "area", "gap"]
_SHOWN = ["industry", "sub_industry", "address", "q", "city", "browser", "kind"]
_AD_KEYS = {f"adShow_{k}": k for k in _SHOWN} | {f"adClick_{k}": f"CASE WHEN clicks > 0 THEN {k} END" for k in _CLICKED}
_AD_KEYS["adClick_gap"] = "CASE WHEN clicks > 0 THEN gap - gap % 10 END"
_AD_ENTRIES = ", d AS (" + " UNION ALL ".join(
    f"SELECT site, srcg, guid, '{n}' feature, CAST({e} AS VARCHAR) k FROM adviews" for n, e in _AD_KEYS.items()) + """)
, dist AS (SELECT site, srcg, feature, k, count(*) n, count(DISTINCT guid) users FROM d WHERE k IS NOT NULL GROUP BY ALL)"""


@query("channel_distributions", ctes(ADVIEWS) + _AD_ENTRIES + " SELECT * FROM dist")
def channel_distributions(spark, folder):
    return agg.key_distributions(adviews(spark, folder), DIMS, F.col("guid"), {n: F.expr(e) for n, e in _AD_KEYS.items()})


_STAGES = {"newUser": "age = 0", "youngUser": "age <= 3", "oldUser": "age >= 4"}


@query("channel_ad_catalogue", ctes(ADVIEWS) + _AD_ENTRIES + """
, top AS (SELECT site, srcg, feature, max(n) / sum(n) r, max(users) / sum(users) u FROM dist GROUP BY ALL)
, base AS (SELECT site, srcg, round(sum(clicks) / count(*), 6) adClickRate,
    round(count(*) FILTER (kind = 'second') / count(*), 6) secondSearchRatio, """ + ", ".join(
    f"round(count(DISTINCT guid) FILTER ({c}) / count(DISTINCT guid), 6) {n}UserRatio" for n, c in _STAGES.items()) + """,
    round(count(DISTINCT guid) / count(DISTINCT address), 6) "usersPerAddress",
    round(count(DISTINCT guid) / count(DISTINCT q), 6) "usersPerQuery" FROM adviews GROUP BY site, srcg)
SELECT base.*, """ + ", ".join(
    f"(SELECT round(any_value({c}), 6) FROM top WHERE top.site = base.site AND top.srcg = base.srcg AND feature = '{n}') {n}{t}TopRatio"
    for n in _AD_KEYS for c, t in (("r", ""), ("u", "User"))) + " FROM base")
def channel_ad_catalogue(spark, folder):
    out = agg.channel_catalogue(
        adviews(spark, folder), DIMS, F.col("guid"), {"secondSearch": F.col("kind") == "second"},
        {n: F.expr(e) for n, e in _AD_KEYS.items()}, {"Address": F.col("address"), "Query": F.col("q")},
        user_classes={n: F.expr(c) for n, c in _STAGES.items()}, rates={"adClick": (F.col("clicks"), F.lit(1))}, by_users=True)
    return out.select(*DIMS, *[rounded(c) for c in out.columns if c not in DIMS])


_USER_COUNTS = {f"adShow{k}": k for k in ("industry", "sub_industry")} | {
    f"adClick{k}": f"CASE WHEN clicks > 0 THEN {k} END" for k in ("industry", "sub_industry")} | {
    f"{k}Count": k for k in ("address", "city", "browser", "hr", "srcg")}
_USER_SUMS = {"adshow": "1", "adclick": "clicks"} | {
    f"{k}Count": f"CASE WHEN kind = '{k}' THEN 1 ELSE 0 END" for k in ("first", "second", "suggestion", "page")}


@query("user_catalogue", ctes(ADVIEWS) + """
, hq AS (SELECT guid, q, count(*) n FROM adviews WHERE q IS NOT NULL GROUP BY ALL)
, fq AS (SELECT guid, count(*) queryCount, CAST(max(n) AS DOUBLE) queryCountMax, CAST(min(n) AS DOUBLE) queryCountMin FROM hq GROUP BY guid)
, hc AS (SELECT guid, srcg, count(*) n FROM adviews GROUP BY ALL)
, fc AS (SELECT guid, count(*) channelCount, CAST(max(n) AS DOUBLE) channelCountMax, CAST(min(n) AS DOUBLE) channelCountMin FROM hc GROUP BY guid)
, base AS (SELECT guid, """ + ", ".join([f"CAST(sum({e}) AS DOUBLE) {n}" for n, e in _USER_SUMS.items()] + [
    f"count(DISTINCT {e}) {n}" for n, e in _USER_COUNTS.items()]) + """ FROM adviews GROUP BY guid)
SELECT base.*, coalesce(queryCount, 0) queryCount, coalesce(queryCountMax, -1.0::DOUBLE) queryCountMax,
       coalesce(queryCountMin, -1.0::DOUBLE) queryCountMin, channelCount, channelCountMax, channelCountMin
FROM base JOIN fc USING (guid) LEFT JOIN fq USING (guid)""")
def user_catalogue(spark, folder):
    exprs = lambda specs: {n: F.expr(e) for n, e in specs.items()}
    return agg.user_features(adviews(spark, folder), "guid", exprs(_USER_SUMS), exprs(_USER_COUNTS),
                             {"queryCount": F.col("q"), "channelCount": F.col("srcg")})


# A statistic of this query's own: the hours seen as bits, and the mean gap of clicked ads with its spread.
def _own_statistics():
    clicked = F.when(F.col("clicks") > 0, F.col("gap").cast("double"))
    moments = {"n": agg.Part(F.when(F.col("clicks") > 0, 1), F.sum, F.lit(0)), "s": agg.Part(clicked, F.sum, F.lit(0.0)),
               "q": agg.Part(clicked * clicked, F.sum, F.lit(0.0))}
    bit = F.expr("shiftleft(1L, cast(hr as int))")
    return [
        agg.Statistic("gapMean", moments, lambda p: F.try_divide(p["s"], p["n"])),
        agg.Statistic("gapVariance", moments, lambda p: F.try_divide(p["q"], p["n"]) - F.pow(F.try_divide(p["s"], p["n"]), F.lit(2))),
        agg.Statistic("hoursSeen", {"bits": agg.Part(bit, F.bit_or)}, lambda p: F.bit_count(p["bits"])),
    ]


@query("own_statistics", ctes(ADVIEWS) + """
, w AS (SELECT site, srcg, industry, count(*) n FROM adviews GROUP BY ALL)
, k AS (SELECT site, srcg, count(*) FILTER (n >= 20) usualIndustries, sum(n * n) / (sum(n) * sum(n)) concentration FROM w GROUP BY ALL)
SELECT site, srcg, round(avg(gap) FILTER (clicks > 0), 6) gapMean, round(var_pop(gap) FILTER (clicks > 0), 4) gapVariance,
       CAST(count(DISTINCT hr) AS INT) hoursSeen, any_value(usualIndustries) usualIndustries, round(any_value(concentration), 6) concentration
FROM adviews JOIN k USING (site, srcg) GROUP BY site, srcg""")
def own_statistics(spark, folder):
    keyed = agg.Keyed("industry", F.col("industry"), {
        "usualIndustries": lambda n, k: F.count(F.when(n >= 20, 1)),
        "concentration": lambda n, k: F.sum(n * n) / (F.sum(n) * F.sum(n))})
    out = agg.group_features(adviews(spark, folder), DIMS, _own_statistics(), [keyed])
    return out.select(*DIMS, rounded("gapMean"), rounded("gapVariance", 4), "hoursSeen", "usualIndustries", rounded("concentration"))
