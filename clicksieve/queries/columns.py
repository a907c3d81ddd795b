"""Queries of projections, predicates, joins, set operations and column functions."""

from pyspark.sql import functions as F

from clicksieve.functions import agents, detail, histogram, text, times
from clicksieve.functions.unfold import unfold, unfold_structs
from clicksieve.operators import aggregate as agg
from clicksieve.operators import distribution, features
from clicksieve.plans import pipeline, reports
from clicksieve.queries.base import (
    ADLOG, CHECKS, HIST, LOG, RULES, adlog, checks, ctes, hist, log, query, rounded, table,
)
from clicksieve.sources import tables as src
from clicksieve.status import check_columns, check_rule, guarded_rule, status_label, valid_rows


def one():
    return F.count(F.lit(1)).alias("n")


# P: projections and predicates -------------------------------------------------


@query("filter_tp", ctes(LOG) + "SELECT event_id, tp, act FROM log WHERE tp <= '1'")
def filter_tp(spark, folder):
    return pipeline.filter_types(log(spark, folder)).select("event_id", "tp", "act")


_SITE_COUNTS = """, g AS (
  SELECT site, srcg, count(*) SPV, CAST(sum(CASE WHEN act = 'click' THEN 1 ELSE 0 END) AS BIGINT) CPV,
         CAST(sum(CASE WHEN act = 'signup' AND CAST(q AS INT) < 2 THEN 1 ELSE 0 END) AS BIGINT) rare
  FROM log GROUP BY site, srcg)"""


def _site_counts(spark, folder):
    return log(spark, folder).groupBy("site", "srcg").agg(
        F.count(F.lit(1)).alias("SPV"),
        F.sum(F.when(F.col("act") == "click", 1).otherwise(0)).alias("CPV"),
        F.sum(F.when((F.col("act") == "signup") & (F.col("q").cast("int") < 2), 1).otherwise(0)).alias("rare"))


@query("expr_feature", ctes(LOG) + _SITE_COUNTS + """
SELECT site, srcg, round(CPV / nullif(SPV, 0), 6) ctr, round(CPV / nullif(rare, 0), 6) per_rare FROM g""")
def expr_feature(spark, folder):
    df = features.expr_feature(_site_counts(spark, folder), "ctr", "try_divide(CPV, SPV)")
    df = features.expr_feature(df, "per_rare", "try_divide(CPV, rare)")
    return df.select("site", "srcg", rounded("ctr"), rounded("per_rare"))


@query("expr_score", ctes(LOG) + """
SELECT event_id, CASE WHEN tp <= '1' AND value > 10 THEN value ELSE -1.0 END score FROM log""")
def expr_score(spark, folder):
    df = features.expr_score(log(spark, folder), "score", "value", "tp <= '1' and value > 10", -1.0)
    return df.select("event_id", "score")


@query("conditional_feature", ctes(LOG) + """
SELECT event_id, CASE WHEN act = 'click' THEN value * 2 WHEN tp = '0' THEN value + 1 ELSE 0.0 END feature FROM log""")
def conditional_feature(spark, folder):
    branches = [("act = 'click'", "value * 2"), ("tp = '0'", "value + 1D")]
    return features.conditional_feature(log(spark, folder), "feature", branches, "0D").select("event_id", "feature")


def _tagged(tag, values):
    return F.transform(values, lambda v: F.struct(F.lit(tag).alias("tag"), v.alias("value")))


@query("inline_predicate", ctes(ADLOG) + """
SELECT srcg, count(*) FILTER (clicknum > 0) clicked,
       count(DISTINCT CASE WHEN clicknum > 0 THEN industry END) clicked_kinds,
       count(*) FILTER ("location" <> 'top') side,
       count(*) FILTER (l_quantity > 20) guarded
FROM adrows GROUP BY srcg""")
def inline_predicate(spark, folder):
    rows = _ads(spark, folder, "industry", "sub_industry", "location", "ad_clicknum")
    leaf = lambda path: detail.leaf_values(F.col("ads"), path)
    cond = detail.Condition
    kept = {
        "clicked": detail.keep_where(leaf("industry"), leaf("ad_clicknum"), cond("ad_clicknum", ">", "0")),
        "side": detail.keep_where(leaf("sub_industry"), leaf("location"), cond("location", "!=", "top")),
        "guarded": detail.keep_where(leaf("industry"), F.array("qty"), cond("qty", ">", "20")),
    }
    # plain counts are sizes, summed by row; only what is counted distinct is unfolded
    sized = rows.select("srcg", *[v.alias(n) for n, v in kept.items()]).select(
        "srcg", "clicked", F.size("side").alias("side"), F.size("guarded").alias("guarded"))
    # one entry per kind, the sizes with the first; a row without kinds gives them a null kind
    entry = lambda kind, side, guarded: F.struct(kind.alias("kind"), side.alias("side"), guarded.alias("guarded"))
    size_at = lambda i, name: F.when(i == 0, F.col(name)).otherwise(0)
    entries = F.when(F.size("clicked") > 0, F.transform(
        "clicked", lambda v, i: entry(v, size_at(i, "side"), size_at(i, "guarded")))).otherwise(
        F.array(entry(F.lit(None).cast("string"), F.col("side"), F.col("guarded"))))
    counted = unfold_structs(sized, ["srcg"], entries).groupBy("srcg", "kind").agg(
        one(), F.sum("side").alias("side"), F.sum("guarded").alias("guarded"))
    return counted.groupBy("srcg").agg(
        F.coalesce(F.sum(F.when(F.col("kind").isNotNull(), F.col("n"))), F.lit(0)).alias("clicked"),
        F.count("kind").alias("clicked_kinds"), F.sum("side").alias("side"), F.sum("guarded").alias("guarded"))


@query("select_pattern", """
SELECT l_orderkey ad_click_id, l_returnflag site, l_quantity qtyCount, l_tax taxScore,
       CASE WHEN l_discount >= 0.09 OR ((CASE WHEN l_tax >= 0.07 THEN 1 ELSE 0 END)
         + (CASE WHEN l_quantity >= 30 THEN 1 ELSE 0 END)) >= 3 THEN 1 ELSE 0 END spam_label
FROM lineitem""")
def select_pattern(spark, folder):
    df = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey ad_click_id", "l_returnflag site", "l_linestatus other", "l_quantity qtyCount",
        "l_tax taxScore", "case when l_discount >= 0.09 then 5 else 3 end discScoreCheck",
        "case when l_tax >= 0.07 then 4 else 3 end taxCheck",
        "case when l_quantity >= 30 then 4 else 3 end qtyCountCheck")
    label = status_label(check_columns(df))
    return features.select_pattern(df, ["ad_click_id", "site"], labels={"spam_label": label})


@query("arrays_to_text", """
SELECT conv_id, turn, array_to_string(string_split("text", ' '), '; ') words FROM conversations""")
def arrays_to_text(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", F.split("text", " ").alias("words"))
    return detail.arrays_to_text(rows)


@query("group_frame_export", ctes(LOG) + """
, g AS (SELECT guid, count(*) SPV, count(*) FILTER (act = 'purchase') AdclickNum,
               string_agg(DISTINCT act, '->' ORDER BY act) actions FROM log GROUP BY guid)
SELECT guid, SPV, AdclickNum, actions, '20240131' "day" FROM g
WHERE actions LIKE '%purchase%' AND AdclickNum > 0 AND SPV >= 20""")
def group_frame_export(spark, folder):
    frame = log(spark, folder).groupBy("guid").agg(
        F.count(F.lit(1)).alias("SPV"), F.sum(F.when(F.col("act") == "purchase", 1).otherwise(0)).alias("AdclickNum"),
        F.array_sort(F.collect_set("act")).alias("actions"), F.max(F.lit(3)).alias("BusyCheck"))
    return pipeline.export_frame(
        frame, "20240131", where=F.col("AdclickNum") > 0, actions="actions", must_hold="purchase",
        drop=["BusyCheck"], min_volume=("SPV", 20))


@query("valid_rows", ctes(CHECKS) + """
, j AS (SELECT *, greatest(QtyBySrcg, QtyByGuid, DiscBySrcg, TaxBySite, PriceByGuid) m,
   (QtyBySrcg = 4)::INT + (QtyByGuid = 4)::INT + (DiscBySrcg = 4)::INT + (TaxBySite = 4)::INT + (PriceByGuid = 4)::INT soft
   FROM checks)
SELECT l_orderkey, l_linenumber, QtyBySrcg, QtyByGuid, DiscBySrcg, TaxBySite, PriceByGuid
FROM j WHERE m <= 3 OR (m = 4 AND soft < 3)""")
def valid(spark, folder):
    return valid_rows(checks(spark, folder), RULES).select("l_orderkey", "l_linenumber", *RULES)


@query("train_mix", ctes(CHECKS) + """
, d AS (SELECT *, CAST(concat('0x', substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) h FROM checks)
, m AS (SELECT l_orderkey, l_linenumber, 0 "label" FROM d WHERE PriceByGuid = 3 AND h < 1288490188
        UNION ALL SELECT l_orderkey, l_linenumber, 1 FROM d WHERE DiscBySrcg = 5 AND h < 1503238553)
SELECT *, round((SELECT count(*) FROM m WHERE "label" = 1) / (SELECT count(*) FROM m WHERE "label" = 0), 6) ratio FROM m""")
def train_mix(spark, folder):
    rows = checks(spark, folder)
    cols = ["l_orderkey", "l_linenumber"]
    mix, ratio = src.train_mix(
        rows.filter("PriceByGuid = 3").select(*cols), rows.filter("DiscBySrcg = 5").select(*cols),
        "l_orderkey", 0.3, 0.35)
    return mix.withColumn("ratio", F.lit(round(ratio, 6)))


@query("status_label", ctes(CHECKS) + """
, j AS (SELECT *, greatest(QtyBySrcg, QtyByGuid, DiscBySrcg, TaxBySite, PriceByGuid) m,
   (QtyBySrcg = 4)::INT + (QtyByGuid = 4)::INT + (DiscBySrcg = 4)::INT + (TaxBySite = 4)::INT + (PriceByGuid = 4)::INT soft
   FROM checks)
SELECT l_orderkey, l_linenumber, CASE WHEN m = 5 OR soft >= 3 THEN 1 ELSE 0 END "label",
       CASE WHEN m = 5 OR soft >= 4 THEN 1 ELSE 0 END train_label FROM j""")
def labels(spark, folder):
    return checks(spark, folder).select(
        "l_orderkey", "l_linenumber", status_label(RULES).alias("label"), status_label(RULES, 4).alias("train_label"))


# J: joins ----------------------------------------------------------------------

_RATES = """, g AS (
  SELECT site, srcg, count(*) SPV, round(avg(value), 6) mean_value,
         CASE WHEN avg(CASE WHEN act = 'click' THEN 1.0 ELSE 0 END) > 0.2 THEN 5
              WHEN avg(CASE WHEN act = 'click' THEN 1.0 ELSE 0 END) > 0.19 THEN 4 ELSE 3 END ClickBySrcg
  FROM log GROUP BY site, srcg)"""


def _rates(spark, folder):
    g = log(spark, folder).groupBy("site", "srcg").agg(
        F.count(F.lit(1)).alias("SPV"), F.round(F.avg("value"), 6).alias("mean_value"),
        F.avg(F.when(F.col("act") == "click", 1.0).otherwise(0.0)).alias("rate"))
    return g.withColumn("ClickBySrcg", check_rule("rate > 0.2", "rate > 0.19"))


@query("join_back_judgement", ctes(LOG) + _RATES + """
SELECT event_id, log.site, log.srcg, ClickBySrcg FROM log JOIN g ON log.site = g.site AND log.srcg = g.srcg""")
def join_back_judgement(spark, folder):
    joined = pipeline.join_judgements(log(spark, folder), _rates(spark, folder), ["site", "srcg"], ["ClickBySrcg"])
    return joined.select("event_id", "site", "srcg", "ClickBySrcg")


@query("join_major_features", ctes(LOG) + _RATES + """
SELECT event_id, log.guid, SPV, mean_value FROM log LEFT JOIN g ON log.site = g.site AND log.srcg = g.srcg""")
def join_major_features(spark, folder):
    joined = pipeline.join_judgements(log(spark, folder), _rates(spark, folder), ["site", "srcg"], ["SPV", "mean_value"])
    return joined.select("event_id", "guid", "SPV", "mean_value")


@query("lookup_join", ctes(LOG) + """
, m AS (SELECT q, count(*) n FROM log WHERE act = 'signup' GROUP BY q HAVING count(*) >= 20)
SELECT event_id, coalesce(m.n, 100) score FROM log LEFT JOIN m ON log.q = m.q""")
def lookup_join(spark, folder):
    rows = log(spark, folder)
    model = rows.filter("act = 'signup'").groupBy("q").agg(F.count(F.lit(1)).alias("score")).filter("score >= 20")
    return distribution.lookup(rows, model, ["q"], {"score": F.lit(100).cast("bigint")}).select("event_id", "score")


@query("blacklist_membership", ctes(CHECKS) + """
, b AS (SELECT guid FROM checks GROUP BY guid
        HAVING avg(CASE WHEN greatest(QtyBySrcg, DiscBySrcg) = 5 THEN 1.0 ELSE 0 END) > 0.5)
SELECT l_orderkey, l_linenumber, CASE WHEN guid IN (SELECT guid FROM b) THEN 5 ELSE 3 END status FROM checks""")
def blacklist_membership(spark, folder):
    rows = checks(spark, folder)
    spam = (F.greatest("QtyBySrcg", "DiscBySrcg") == 5).cast("double")
    black = rows.groupBy("guid").agg(F.avg(spam).alias("s")).filter("s > 0.5").select("guid", F.lit(5).alias("status"))
    return distribution.lookup(rows, black, ["guid"], {"status": F.lit(3)}).select("l_orderkey", "l_linenumber", "status")


@query("cluster_tag_join", ctes(CHECKS) + """
, t AS (SELECT srcg, CASE WHEN sum(l_quantity) > 76000 THEN 'high' ELSE 'low' END tag
        FROM checks GROUP BY srcg HAVING count(*) >= 2950)
SELECT checks.srcg, tag, count(*) n FROM checks LEFT JOIN t ON checks.srcg = t.srcg GROUP BY ALL""")
def cluster_tag_join(spark, folder):
    rows = checks(spark, folder)
    tags = rows.groupBy("srcg").agg(one(), F.sum("l_quantity").alias("v")).filter("n >= 2950").select(
        "srcg", F.when(F.col("v") > 76000, "high").otherwise("low").alias("tag"))
    counted = rows.groupBy("srcg").agg(one())
    return agg.same_keys(counted, tags, ["srcg"]).select("srcg", "tag", "n")


@query("pair_join", ctes(CHECKS) + """
, f AS (SELECT row_number() OVER () id, * FROM checks)
, r AS (SELECT id, site, u.rule FROM f, LATERAL (VALUES ('QtyBySrcg', QtyBySrcg), ('QtyByGuid', QtyByGuid),
   ('DiscBySrcg', DiscBySrcg), ('TaxBySite', TaxBySite), ('PriceByGuid', PriceByGuid)) AS u(rule, s) WHERE u.s >= 4)
SELECT a.site, a.rule a, b.rule b, count(*) n FROM r a JOIN r b ON a.id = b.id AND a.rule < b.rule GROUP BY ALL""")
def pair_join(spark, folder):
    patterns = reports.fired_patterns(checks(spark, folder), RULES, ["site"])
    pairs = unfold_structs(patterns, ["site", "n"], features.rule_pairs_of_row(F.col("fired")))
    return pairs.groupBy("site", "a", "b").agg(F.sum("n").alias("n"))


# U: set operations --------------------------------------------------------------


@query("union_all", """
SELECT event_id id, event_type kind FROM events UNION ALL SELECT o_orderkey, o_orderpriority FROM orders""")
def union_all(spark, folder):
    a = table(spark, folder, "events").selectExpr("event_id id", "event_type kind")
    return a.unionByName(table(spark, folder, "orders").selectExpr("o_orderpriority kind", "o_orderkey id"))


@query("distinct_labels", 'SELECT DISTINCT "label" FROM embeddings')
def distinct_labels(spark, folder):
    return table(spark, folder, "embeddings").select("label").distinct()


@query("complete_keys", ctes(HIST) + """
SELECT g.grp, s.k, coalesce(max(hist.n), 0) n
FROM (SELECT DISTINCT grp FROM hist) g CROSS JOIN (VALUES ('de'), ('en'), ('es'), ('fr'), ('it'), ('pt')) s(k)
LEFT JOIN hist ON hist.grp = g.grp AND hist.k = s.k GROUP BY ALL""")
def complete_keys(spark, folder):
    return distribution.complete_keys(hist(spark, folder), ["grp"], ["de", "en", "es", "fr", "it", "pt"])


# F: column functions ----------------------------------------------------------


def _ads(spark, folder, *fields):
    """The log with its ads parsed, of which only the named fields are read."""
    return adlog(spark, folder).withColumn("ads", detail.parse_details(F.col("ads_details"), detail.ad_schema(*fields)))


@query("click_hours", ctes(ADLOG) + """
SELECT srcg, CAST(hour(to_timestamp(epoch(l_shipdate) + l_linenumber * 7200 + k * 600 + j * 3000) AT TIME ZONE 'UTC') AS INTEGER) "hour",
       count(*) n
FROM adrows, unnest(range(0, clicknum)) AS c(j) WHERE l_quantity <> 1 GROUP BY ALL""")
def click_hours(spark, folder):
    hours = detail.click_hours(detail.leaf_values(F.col("ads"), "ad_clickdetails.click_time"))
    return unfold(_ads(spark, folder, "ad_clickdetails"), ["srcg"], hours, "hour").groupBy("srcg", "hour").agg(one())


@query("day_of_week", ctes(LOG) + """
SELECT strftime(make_timestamp(t_ms * 1000), '%a') dow, count(*) n FROM log WHERE act <> 'error' GROUP BY ALL
UNION ALL SELECT NULL, count(*) FROM log WHERE act = 'error'""")
def day_of_week(spark, folder):
    stamp = F.when(F.col("act") == "error", F.lit("n/a")).otherwise(F.col("t_ms").cast("string"))
    return log(spark, folder).groupBy(times.day_of_week(stamp).alias("dow")).agg(one())


def _order_day():
    return F.date_format("o_orderdate", "yyyyMMdd")



@query("shift_day", """
SELECT strftime(o_orderdate, '%Y%m%d') "day", strftime(o_orderdate - INTERVAL 3 DAY, '%Y%m%d') "before",
       strftime(o_orderdate + INTERVAL 2 DAY, '%Y%m%d') last, count(*) n FROM orders GROUP BY ALL""")
def shift_day(spark, folder):
    days = table(spark, folder, "orders").groupBy(_order_day().alias("day")).agg(one())
    d = F.col("day")
    return days.select("day", times.shift_day(d, -3).alias("before"), F.element_at(times.next_days(d, 3), -1).alias("last"), "n")


@query("day_gap", """
SELECT CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) gap, count(*) n
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""")
def day_gap(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", _order_day().alias("a"))
    li = table(spark, folder, "lineitem").select("l_orderkey", F.date_format("l_shipdate", "yyyyMMdd").alias("b"))
    joined = o.join(li, o.o_orderkey == li.l_orderkey)
    return joined.groupBy("a", "b").agg(one()).groupBy(times.day_gap(F.col("a"), F.col("b")).alias("gap")).agg(
        F.sum("n").alias("n"))


@query("format_ts", ctes(LOG) + """
SELECT event_id, strftime(make_timestamp(t_ms * 1000), '%Y%m%d') "day",
       strftime(make_timestamp(t_ms * 1000), '%m/%d %H:%M:%S') "time" FROM log""")
def format_ts(spark, folder):
    t = F.col("t_ms").cast("string")
    return log(spark, folder).select("event_id", times.format_day(t).alias("day"), times.format_time(t).alias("time"))


_CALENDAR = [("holiday", "19950501", "3"), ("holiday", "19961001", "7"), ("holiday", "19980127", "7"),
             ("workday", "19961005", "2"), ("workday", "19980214", "2"), ("workday", "19990703", "1"),
             ("holiday", "20000102", "1")]


@query("holiday_flag", """
WITH cal(kind, s, n) AS (VALUES ('holiday', DATE '1995-05-01', 3), ('holiday', DATE '1996-10-01', 7),
  ('holiday', DATE '1998-01-27', 7), ('workday', DATE '1996-10-05', 2), ('workday', DATE '1998-02-14', 2),
  ('workday', DATE '1999-07-03', 1), ('holiday', DATE '2000-01-02', 1)),
d AS (SELECT kind, s + CAST(i AS INTEGER) d FROM cal, unnest(range(0, n)) AS r(i)),
o AS (SELECT CAST(o_orderdate AS DATE) d, count(*) n FROM orders GROUP BY ALL)
SELECT strftime(o.d, '%Y%m%d') "day", n,
  CASE WHEN d IN (SELECT d FROM d WHERE kind = 'holiday') THEN TRUE
       WHEN d IN (SELECT d FROM d WHERE kind = 'workday') THEN FALSE ELSE isodow(o.d) >= 6 END holiday
FROM o""")
def holiday_flag(spark, folder):
    calendar = spark.createDataFrame(_CALENDAR, "type string, start string, last string")
    days = table(spark, folder, "orders").groupBy(_order_day().alias("day")).agg(one())
    return times.holiday_flag(days, "day", calendar)


_URL_RULES = [("mobile", [r"://m\."]), ("paged", [r"page=\d+", r"/p\d+$"]), ("secure", ["^https:"]), ("home", [r"\.com/?$"])]


@query("first_match_class", r"""
SELECT CASE WHEN regexp_matches(url, '://m\.') THEN 'mobile' WHEN regexp_matches(url, '(page=\d+)|(/p\d+$)') THEN 'paged'
       WHEN regexp_matches(url, '^https:') THEN 'secure' WHEN regexp_matches(url, '\.com/?$') THEN 'home' ELSE 'unk' END cls,
       CASE WHEN regexp_matches(url, 'ref=') THEN 'search1' ELSE 'search2' END entrance, count(*) n
FROM pages GROUP BY ALL""")
def first_match_class(spark, folder):
    url = F.col("url")
    return table(spark, folder, "pages").groupBy(
        text.first_match_class(url, _URL_RULES).alias("cls"), text.search_entrance(url, ["ref="]).alias("entrance")).agg(one())


@query("remit_match", ctes(CHECKS) + """
SELECT srcg, CASE WHEN srcg IN ('s1', 's7') OR srcg LIKE '%5' THEN 2 WHEN l_quantity >= 48 THEN 5
  WHEN l_quantity >= 40 THEN 4 ELSE 3 END status, count(*) n FROM checks GROUP BY ALL""")
def remit_match(spark, folder):
    status = check_rule("l_quantity >= 48", "l_quantity >= 40", remit=["^s[17]$", "5$"])
    return checks(spark, folder).groupBy("srcg", status.alias("status")).agg(one())


# An agent text holds names that the rules know, picked by the row's number, and
# versions from the row's values. The oracle is a CASE written from the rules.

def _pick(words):
    return F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("event_id") % len(words) + 1).cast("int"))


_PRODUCTS = [w for b in agents.BROWSERS for w in b.aliases]
_PLATFORMS = [w for s in agents.SYSTEMS for w in s.required[-1]]
_ENGINES = list(agents.WEBKIT_SAFARI)


def ua(spark, folder):
    engine = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" applewebkit/"), _pick(_ENGINES))).otherwise("")
    return log(spark, folder).withColumn("ua", F.concat(
        _pick(_PRODUCTS), F.lit("/"), F.col("guid"), F.lit("."), F.col("q"), F.lit(" ("), _pick(_PLATFORMS), F.lit(")"), engine))


def _text(value):
    return "'" + value.replace("'", "''") + "'"


def _list(words):
    return "[" + ", ".join(map(_text, words)) + "]"


def _found(words, excludes=()):
    one = lambda ws: "(" + " OR ".join(f"contains(lower(ua), {_text(w)})" for w in ws) + ")"
    return one(words) + (f" AND NOT {one(excludes)}" if excludes else "")


_RULE_SQL = "CASE " + " ".join(
    f"WHEN {_found(b.aliases, b.excludes)} THEN {i}" for i, b in enumerate(agents.BROWSERS)) + " END"
_SYSTEM_SQL = "CASE " + " ".join(
    "WHEN " + " AND ".join(_found(w) for w in s.required[:-1] + ()) + (" AND " if s.required[:-1] else "")
    + _found(s.required[-1], s.excludes) + f" THEN {i}" for i, s in enumerate(agents.SYSTEMS)) + " END"


def _version_sql(group):
    """Group of the browser's own pattern; a case for each rule that has one."""
    return "CASE rule " + " ".join(
        f"WHEN {i} THEN regexp_extract(ua, {_text('(?i)' + b.version)}, {group})"
        for i, b in enumerate(agents.BROWSERS) if b.version and agents.pattern_groups(b.version) >= group) + " ELSE '' END"


_SAFARI = [i for i, b in enumerate(agents.BROWSERS) if b.name == "Safari"]
_ENGINE_SQL = "map {" + ", ".join(f"{_text(k)}: {_text(v)}" for k, v in agents.WEBKIT_SAFARI.items()) + "}"
UA = f"""uas AS (
  SELECT *, concat({_list(_PRODUCTS)}[1 + event_id % {len(_PRODUCTS)}], '/', guid, '.', q, ' (',
                   {_list(_PLATFORMS)}[1 + event_id % {len(_PLATFORMS)}], ')',
                   CASE WHEN event_id % 2 = 0 THEN concat(' applewebkit/', {_list(_ENGINES)}[1 + event_id % {len(_ENGINES)}]) ELSE '' END) ua
  FROM log),
ruled AS (SELECT *, {_RULE_SQL} rule, {_SYSTEM_SQL} sys FROM uas),
engines AS (SELECT *, {_version_sql(1)} v1, {_version_sql(2)} v2, {_version_sql(3)} v3, {_ENGINE_SQL} known FROM ruled),
parts AS (SELECT *, CASE WHEN v1 = '' AND rule IN ({', '.join(map(str, _SAFARI))})
   THEN known[regexp_extract(ua, 'AppleWebKit/(\\d+(?:.\\d+){{1,2}})', 1)] END safari FROM engines),
ua AS (SELECT * EXCLUDE (known),
   coalesce({_list([b.name for b in agents.BROWSERS])}[rule + 1], 'Unknown') browser,
   coalesce({_list([b.kind for b in agents.BROWSERS])}[rule + 1], 'UNKNOWN') kind,
   coalesce({_list([b.engine for b in agents.BROWSERS])}[rule + 1], 'OTHER') engine,
   CASE WHEN v1 <> '' THEN v1 ELSE safari END "full",
   CASE WHEN v1 <> '' THEN v2 ELSE string_split(safari, '.')[1] END major,
   CASE WHEN v1 <> '' THEN CASE WHEN rule IN ({', '.join(str(i) for i, b in enumerate(agents.BROWSERS) if b.version and agents.pattern_groups(b.version) > 2)})
     THEN nullif(v3, '') ELSE '0' END ELSE string_split(safari, '.')[2] END minor,
   CASE WHEN rule = {[b.name for b in agents.BROWSERS].index(agents.ROBOT)} OR sys IS NULL THEN 'Unknown'
     ELSE {_list([s.name for s in agents.SYSTEMS])}[sys + 1] END os,
   CASE WHEN rule = {[b.name for b in agents.BROWSERS].index(agents.ROBOT)} OR sys IS NULL THEN 'UNKNOWN'
     ELSE {_list([s.device for s in agents.SYSTEMS])}[sys + 1] END device FROM parts)"""


@query("browser_mix", ctes(LOG, UA) + """
SELECT srcg, browser, count(*) n, round(count(*) / sum(count(*)) OVER (PARTITION BY srcg), 6) "share"
FROM ua GROUP BY srcg, browser""")
def browser_mix(spark, folder):
    return agents.browser_mix(ua(spark, folder), ["srcg"], "ua").select("srcg", "browser", "n", rounded("share"))


@query("os_mix", ctes(LOG, UA) + "SELECT srcg, os, device, count(*) n FROM ua GROUP BY ALL")
def os_mix(spark, folder):
    return agents.os_mix(ua(spark, folder), ["srcg"], "ua")


@query("version_mix", ctes(LOG, UA) + 'SELECT browser, kind, engine, "full", major, minor, count(*) n FROM ua GROUP BY ALL')
def version_mix(spark, folder):
    return agents.versions(ua(spark, folder), [], "ua")


_HOSTS = [*[w for _, words in agents.WEBMAIL for w in words], "www.example.com", "shop.example.net"]


@query("referrer_mix", f"""WITH refs AS (SELECT page_id, CASE WHEN page_id % 13 = 12 THEN '-' ELSE
   concat('http://', {_list(_HOSTS)}[1 + page_id % {len(_HOSTS)}], '/', url) END ua FROM pages)
SELECT page_id % 7 grp, CASE WHEN length(ua) <= 1 THEN 'Unknown' """ + " ".join(
    f"WHEN {_found(words)} THEN {_text(name)}" for name, words in agents.WEBMAIL) + """ ELSE 'Unknown' END product,
   count(*) n FROM refs GROUP BY ALL""")
def referrer_mix(spark, folder):
    host = F.element_at(F.array(*[F.lit(h) for h in _HOSTS]), (F.col("page_id") % len(_HOSTS) + 1).cast("int"))
    ref = F.when(F.col("page_id") % 13 == 12, "-").otherwise(F.concat(F.lit("http://"), host, F.lit("/"), F.col("url")))
    rows = table(spark, folder, "pages").select((F.col("page_id") % 7).alias("grp"), ref.alias("ref"))
    return agents.referrer_mix(rows, ["grp"], "ref")


@query("latest_version", ctes(LOG, UA) + """
, v AS (SELECT DISTINCT browser, "full" FROM ua WHERE "full" IS NOT NULL)
, k AS (SELECT *, list_transform(string_split("full", '.'), lambda p: {'n': length(p), 'p': p}) key FROM v)
SELECT browser, arg_max("full", key) latest FROM k GROUP BY browser""")
def latest_version(spark, folder):
    return agents.latest_version(ua(spark, folder), "ua")


@query("log_gap_bucket", ctes(LOG) + """
SELECT srcg, CAST(floor(ln(greatest(CASE WHEN act = 'error' THEN 20.0 ELSE value * 100 END, 1.0)) + 0.5) AS BIGINT) bucket,
       count(*) n FROM log GROUP BY ALL""")
def log_gap_bucket(spark, folder):
    gap = F.when(F.col("act") == "error", F.lit("null")).otherwise((F.col("value") * 100).cast("string"))
    return log(spark, folder).groupBy("srcg", histogram.log_gap_bucket(gap).alias("bucket")).agg(one())


@query("edge_bin", ctes(LOG) + """
SELECT srcg, CASE WHEN value <= 5 THEN 5 WHEN value <= 10 THEN 10 WHEN value <= 20 THEN 20 ELSE 40 END edge, count(*) n
FROM log WHERE act <> 'error' GROUP BY ALL""")
def edge_bin(spark, folder):
    shown = F.when(F.col("act") == "error", F.lit("-")).otherwise(F.col("value").cast("string"))
    rows = log(spark, folder).select("srcg", histogram.edge_bin(shown, [20, 5, 40, 10]).alias("edge"))
    return rows.filter("edge is not null").groupBy("srcg", "edge").agg(one())


@query("json_path_values", ctes(ADLOG) + """
SELECT srcg, 'industry' leaf, industry "value", count(*) n FROM adrows GROUP BY ALL
UNION ALL SELECT srcg, 'ad_clickdetails.click_time', CASE WHEN l_quantity = 1 THEN 'null' ELSE
  CAST(epoch_ms(l_shipdate) + (l_linenumber * 7200 + k * 600 + j * 3000) * 1000 AS VARCHAR) END, count(*)
FROM adrows, unnest(range(0, clicknum)) AS c(j) GROUP BY ALL""")
def json_path_values(spark, folder):
    def leaves(path):
        return F.transform(detail.leaf_values(F.col("ads"), path), lambda v: F.struct(F.lit(path).alias("leaf"), v.alias("value")))

    parts = F.concat(leaves("industry"), leaves("ad_clickdetails.click_time"))
    return unfold_structs(_ads(spark, folder, "industry", "ad_clickdetails"), ["srcg"], parts).groupBy("srcg", "leaf", "value").agg(one())


@query("click_location", ctes(ADLOG) + """
SELECT srcg, concat("location", '(', CAST(pos AS VARCHAR), ')') loc, CAST(sum(clicknum) AS BIGINT) n
FROM adrows WHERE clicknum > 0 GROUP BY ALL""")
def click_location(spark, folder):
    places = detail.click_locations(F.col("ads"))
    return unfold(_ads(spark, folder, "location", "pos", "ad_clicknum"), ["srcg"], places, "loc").groupBy("srcg", "loc").agg(one())


@query("action_count_token", ctes(LOG) + """
, u AS (SELECT guid, least(count(*) FILTER (act = 'click'), 15) c FROM log GROUP BY guid)
SELECT guid, CASE WHEN c > 0 THEN concat(CAST(c AS VARCHAR), ':1') ELSE '' END token FROM u""")
def action_count_token(spark, folder):
    users = log(spark, folder).groupBy("guid").agg(F.count_if(F.col("act") == "click").alias("n"))
    return users.select("guid", histogram.action_count_token(F.col("n"), 15).alias("token"))


@query("top_ad_missing", ctes(ADLOG) + """
, shown AS (SELECT l_linenumber, l_quantity, concat('s', CAST(l_suppkey % 20 AS VARCHAR)) srcg,
    l_quantity <> 50 AND l_linenumber % 2 = 0 AS first_shown, l_linenumber IN (1, 5, 6) AS sold FROM lineitem)
SELECT srcg, CASE WHEN sold AND NOT first_shown THEN 5 ELSE 3 END status, count(*) n FROM shown GROUP BY ALL""")
def top_ad_missing(spark, folder):
    status = detail.top_ad_missing(F.col("tg"), detail.leaf_values(F.col("ads"), "pos"))
    return _ads(spark, folder, "pos").groupBy("srcg", status.alias("status")).agg(one())


@query("histogram_explode", ctes(LOG) + """
, h AS (SELECT guid, act k, count(*) n FROM log GROUP BY ALL)
SELECT guid, k, CAST(n AS DOUBLE) n, string_agg(concat(k, ':', CAST(n AS VARCHAR)), '|' ORDER BY n DESC, k)
  OVER (PARTITION BY guid ORDER BY n DESC, k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) hist FROM h""")
def histogram_explode(spark, folder):
    texts = agg.value_distribution(log(spark, folder), ["guid"], F.col("act")).select("guid", "hist")
    return histogram.explode_histogram(texts.withColumn("text", F.col("hist")), "text")


@query("split_key", ctes(LOG) + "SELECT site, srcg, guid, count(*) n FROM log GROUP BY ALL")
def split_key(spark, folder):
    joined = log(spark, folder).groupBy(F.concat_ws("#", "site", "srcg", "guid").alias("key")).agg(one())
    return joined.select(*text.split_key(F.col("key"), ["site", "srcg", "guid"]), "n")


@query("clean_query_counts", """
WITH c AS (SELECT source, regexp_replace("text", '[^一-龥0-9a-zA-Z]', '', 'g') q FROM documents)
SELECT source, md5(q) clean_md5, length(q) len, count(*) n FROM c GROUP BY ALL""")
def clean_query_counts(spark, folder):
    cleaned = table(spark, folder, "documents").select("source", text.clean_query(F.col("text")).alias("q"))
    return cleaned.groupBy("source", F.md5("q").alias("clean_md5"), F.length("q").alias("len")).agg(one())


@query("check_rule", ctes(CHECKS) + """
SELECT l_orderkey, l_linenumber, CASE WHEN srcg LIKE 's1%' THEN 2 WHEN l_quantity >= 48 THEN 5 WHEN l_discount >= 0.07 THEN 4 ELSE 3 END rule,
       CASE WHEN srcg LIKE 's1%' THEN 2 WHEN l_tax = 0 THEN 1 WHEN l_discount / l_tax > 2 THEN 4 ELSE 3 END guarded FROM checks""")
def rule(spark, folder):
    ratio = F.try_divide(F.col("l_discount"), F.col("l_tax"))
    verdict = F.when(ratio > 2, 4).when(ratio <= 2, 3)
    return checks(spark, folder).select(
        "l_orderkey", "l_linenumber", check_rule("l_quantity >= 48", "l_discount >= 0.07", remit=["^s1"]).alias("rule"),
        guarded_rule(verdict, remit=["^s1"]).alias("guarded"))


_AGENT = "concat('Mozilla/5.0 (X11) ', CASE event_id % 3 WHEN 0 THEN 'Gecko/1 Alpha' WHEN 1 THEN 'Beta' ELSE 'Gamma Delta' END, '/', CAST(event_id % 9 AS STRING), '.2')"


@query("product_scores", ctes(LOG) + ", a AS (SELECT " + _AGENT + """ agent, value, q FROM log)
SELECT split_part(string_split(agent, ' ')[-1], '/', 1) product, count(*) n, round(avg(1 / (1 + exp(-value / 100))), 6) score,
       max(length(coalesce(CAST(q AS VARCHAR), ''))) longest FROM a GROUP BY 1""")
def product_scores(spark, folder):
    rows = log(spark, folder).withColumn("agent", F.expr(_AGENT))
    out = rows.groupBy(text.product_token(F.col("agent")).alias("product")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(text.sigmoid(F.col("value") / 100)).alias("score"),
        F.max(F.length(text.text_or_empty(F.col("q")))).cast("bigint").alias("longest"))
    return out.select("product", "n", rounded("score"), "longest")
