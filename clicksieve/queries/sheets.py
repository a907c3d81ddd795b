"""Queries of the sheets and reports, and of the whole pipeline."""

from pyspark.sql import functions as F

from clicksieve.operators import aggregate as agg
from clicksieve.plans import pipeline, reports
from clicksieve.queries.base import CHECKS, LOG, RULES, checks, ctes, log, query
from clicksieve.session import scratch_path
from clicksieve.status import check_rule

_HITS = " + ".join(f"({r} >= 4)::INT" for r in RULES)
_SOFT = " + ".join(f"({r} = 4)::INT" for r in RULES)
JUDGED = f""", j AS (SELECT *, greatest({', '.join(RULES)}, 3) f, {_HITS} hits, {_SOFT} soft FROM checks)"""

_SHEET = """
SELECT regexp_replace(site, 'https?://', '') site, srcg channel, count(*) searchNum, count(*) FILTER (f = 3) "real",
       count(*) FILTER (f = 4) anomaly, count(*) FILTER (f = 5) oriSpam, count(*) FILTER (f = 4 AND hits > 2) mergedAnomaly,
       count(*) - count(*) FILTER (f = 5 OR (f = 4 AND hits > 2)) valid, count(*) FILTER (f = 5 OR (f = 4 AND hits > 2)) spam,
       coalesce(round(sum(hits) FILTER (hits > 2 OR f = 5) / nullif(count(*) FILTER (f = 5 OR (f = 4 AND hits > 2)), 0), 6), 0) AvgCheckoutNum
FROM j GROUP BY ALL"""


@query("settlement_sheet", ctes(CHECKS) + JUDGED + _SHEET)
def settlement_sheet(spark, folder):
    sheet = reports.settlement_sheet(checks(spark, folder), RULES)
    return sheet.withColumn("AvgCheckoutNum", F.round("AvgCheckoutNum", 6))


@query("settlement_sheet_pc", ctes(CHECKS) + JUDGED + """
SELECT site, srcg channel, ctype, '2' jt, coalesce(sadspace, '0') sadspace, count(*) searchNum,
       CAST(floor((count(*) - count(*) FILTER (f = 5 OR (f = 4 AND soft > 2))) * 0.95::DOUBLE + 0.5) AS BIGINT) valid
FROM j GROUP BY ALL""")
def settlement_sheet_pc(spark, folder):
    return reports.settlement_sheet_pc(checks(spark, folder), RULES)


_LONG = ", l AS (" + " UNION ALL ".join(
    f"SELECT concat(site, '#', srcg) channel, srcg, '{r}' algorithm, {r} s FROM checks" for r in RULES) + ")"
_STATUS = ", ".join(f"count(*) FILTER (s = {i}) \"{n}\"" for i, n in enumerate(
    ["unknown", "error", "remit", "real", "anomaly", "spam"]))


@query("rule_status_by_channel", ctes(CHECKS) + _LONG + f"SELECT channel, algorithm, {_STATUS} FROM l GROUP BY ALL")
def rule_status_by_channel(spark, folder):
    return reports.rule_status_by_channel(checks(spark, folder), RULES)


@query("rule_status_total", ctes(CHECKS) + _LONG + f"SELECT algorithm, {_STATUS} FROM l GROUP BY ALL")
def rule_status_total(spark, folder):
    return reports.rule_status_total(checks(spark, folder), RULES)


def _cooccurrence_sql(dims: str) -> str:
    d = f"{dims}, " if dims else ""
    on = f"AND m.{dims} = t.{dims}" if dims else ""
    on2 = f"AND m.{dims} = o.{dims}" if dims else ""
    md = f"m.{dims}, " if dims else ""
    values = ", ".join(f"('{r}', {r})" for r in RULES)
    return ctes(CHECKS) + f"""
, f AS (SELECT row_number() OVER () id, * FROM checks)
, r AS (SELECT id, srcg, u.rule, split_part(u.rule, 'By', 1) fam FROM f, LATERAL (VALUES {values}) AS u(rule, s) WHERE u.s >= 4)
, s AS (SELECT id, count(*) c, count(DISTINCT fam) fams, min(rule) lead FROM r GROUP BY id)
, t AS (SELECT {d}rule, count(*) checked, count(*) FILTER ((c = 1 OR (c = 2 AND fams = 1)) AND rule = lead) independent
        FROM r JOIN s USING (id) GROUP BY ALL)
, m AS (SELECT {'a.' + d if d else ''}a.rule, b.rule partner, count(*) joint FROM r a JOIN r b ON a.id = b.id AND a.fam <> b.fam GROUP BY ALL)
SELECT {md}m.rule, t.checked, t.independent, m.partner, o.checked partner_checked, m.joint,
       round(m.joint / (t.checked + o.checked - m.joint), 6) jaccard
FROM m JOIN t ON m.rule = t.rule {on} JOIN t o ON m.partner = o.rule {on2}
QUALIFY row_number() OVER (PARTITION BY {md}m.rule ORDER BY m.joint DESC, m.partner) <= 10"""


@query("rule_cooccurrence_by_channel", _cooccurrence_sql("srcg"))
def rule_cooccurrence_by_channel(spark, folder):
    out = reports.rule_cooccurrence(checks(spark, folder), RULES, ["srcg"])
    return out.withColumn("jaccard", F.round("jaccard", 6))


@query("rule_cooccurrence", _cooccurrence_sql(""))
def rule_cooccurrence(spark, folder):
    return reports.rule_cooccurrence(checks(spark, folder), RULES).withColumn("jaccard", F.round("jaccard", 6))


@query("partner_rank", _cooccurrence_sql("srcg").replace("<= 10", "<= 2"))
def partner_rank(spark, folder):
    out = reports.rule_cooccurrence(checks(spark, folder), RULES, ["srcg"], top=2)
    return out.withColumn("jaccard", F.round("jaccard", 6))


_SCORES = """, s AS (SELECT l_extendedprice / 100000.0 score, CASE WHEN l_discount >= 0.08 THEN 2 ELSE 1 END online,
    CASE WHEN l_quantity >= 45 THEN 1 ELSE 0 END lab FROM checks)"""


def _scores(spark, folder):
    return checks(spark, folder).selectExpr(
        "l_extendedprice / 100000D score", "case when l_discount >= 0.08 then 2 else 1 end online",
        "case when l_quantity >= 45 then 1 else 0 end lab")


@query("score_bin_report", ctes(CHECKS) + _SCORES + """
, b AS (SELECT CAST(i AS INTEGER) bin, i * 0.002::DOUBLE + 0.3::DOUBLE lo, (i + 1) * 0.002::DOUBLE + 0.3::DOUBLE hi FROM range(1, 350) AS r(i)
        WHERE i < CAST(floor((1.0::DOUBLE - 0.3::DOUBLE) / 0.002::DOUBLE) AS INTEGER))
SELECT bin, round(lo, 6) "begin", (SELECT count(*) FROM s) total, (SELECT count(*) FILTER (online > 1) FROM s) total_online,
       (SELECT count(*) FILTER (lab = 1) FROM s) total_rule, count(*) FILTER (score < hi) in_bin, count(score) above,
       round(count(score) / (SELECT count(*) FROM s), 6) above_rate, count(*) FILTER (online > 1) online_above,
       count(*) FILTER (lab = 1) rule_above, count(*) FILTER (online < 2 AND lab = 0) independent_above
FROM b LEFT JOIN s ON score >= lo GROUP BY bin, lo""")
def score_bin_report(spark, folder):
    out = reports.score_bin_report(_scores(spark, folder), "score", "online", "lab")
    return out.withColumn("begin", F.round("begin", 6)).withColumn("above_rate", F.round("above_rate", 6))


@query("score_bin_report_flat", ctes(CHECKS) + _SCORES + """
, t AS (SELECT score * 130 v, online, lab FROM s)
, b AS (SELECT CAST(i AS INTEGER) bin, i * 0.2::DOUBLE lo, CASE WHEN i = 600 THEN 1e308 ELSE (i + 1) * 0.2::DOUBLE END hi FROM range(0, 601) AS r(i))
SELECT bin, count(v) n, count(*) FILTER (online > 1) online, count(*) FILTER (lab = 1) "rule",
       count(*) FILTER (online < 2) not_online, count(*) FILTER (lab = 0) not_rule, count(*) FILTER (online < 2 AND lab = 0) independent
FROM b LEFT JOIN t ON v >= lo AND v < hi GROUP BY bin""")
def score_bin_report_flat(spark, folder):
    rows = _scores(spark, folder).withColumn("v", F.col("score") * 130)
    return reports.score_bin_report_flat(rows, "v", "online", "lab")


# G: the pipeline ----------------------------------------------------------------


def day_groups():
    """A user group, a channel group that uses a model of the users, and final rules."""
    click = F.when(F.col("act") == "click", 1).otherwise(0)
    busy = pipeline.Model(
        "busy_users",
        fit=lambda users: users.filter("spv >= 50").groupBy("srcg_of").agg(F.count(F.lit(1)).alias("busy")),
        apply=lambda frame, model: agg.same_keys(
            frame, model.withColumnRenamed("srcg_of", "srcg"), ["srcg"]).na.fill({"busy": 0}),
        target=["channel"])
    users = pipeline.Group(
        "user", ["guid"],
        row_columns={"hour": F.hour(F.timestamp_millis("t_ms"))},
        scalars=[agg.Scalar("spv", "count", F.lit(1)), agg.Scalar("srcg_of", "max", F.col("srcg"))],
        keyed=[agg.Keyed("q", F.col("q"), {"queries": "distinct"})],
        rules={"BusyByGuid": check_rule("spv >= 70", "spv >= 50")}, models=[busy], join_back=["queries"])
    channels = pipeline.Group(
        "channel", ["site", "srcg"],
        scalars=[agg.Scalar("SPV", "count", F.lit(1)), agg.Scalar("CPV", "sum", click)],
        keyed=[agg.Keyed("hour", F.col("hour"), {"hourMaxRatio": "share"})],
        features={"ctr": F.try_divide(F.col("CPV"), F.col("SPV"))},
        rules={"CtrBySrcg": check_rule("ctr > 0.22", "ctr > 0.2"), "HourBySrcg": check_rule(anomaly="hourMaxRatio > 0.07")},
        join_back=["busy"])
    rows = pipeline.Group("row", rules={"DearByRow": check_rule("value > 300 and queries > 20", "value > 100")})
    return [users, channels, rows]


DAY_RULES = ["BusyByGuid", "CtrBySrcg", "HourBySrcg", "DearByRow"]
DAY = f""", d AS (SELECT *, CAST(extract(hour FROM make_timestamp(t_ms * 1000)) AS INTEGER) h FROM log WHERE tp <= '1')
, u AS (SELECT guid, count(*) spv, count(DISTINCT q) queries, max(srcg) sc FROM d GROUP BY guid)
, busy AS (SELECT sc, count(*) busy FROM u WHERE spv >= 50 GROUP BY sc)
, hh AS (SELECT site, srcg, h, count(*) n FROM d GROUP BY ALL)
, hr AS (SELECT site, srcg, max(n) / sum(n) hr FROM hh GROUP BY ALL)
, c AS (SELECT site, srcg, count(*) SPV, count(*) FILTER (act = 'click') CPV FROM d GROUP BY ALL)
, judged AS (SELECT d.*, queries, coalesce(busy, 0) busy,
    CASE WHEN spv_u >= 70 THEN 5 WHEN spv_u >= 50 THEN 4 ELSE 3 END BusyByGuid,
    CASE WHEN CPV / SPV > 0.22 THEN 5 WHEN CPV / SPV > 0.2 THEN 4 ELSE 3 END CtrBySrcg,
    CASE WHEN hr > 0.07 THEN 4 ELSE 3 END HourBySrcg,
    CASE WHEN value > 300 AND queries > 20 THEN 5 WHEN value > 100 THEN 4 ELSE 3 END DearByRow
  FROM d JOIN (SELECT guid, spv spv_u, queries FROM u) USING (guid) JOIN c USING (site, srcg) JOIN hr USING (site, srcg)
  LEFT JOIN busy ON busy.sc = d.srcg)"""


@query("group_pipeline", ctes(LOG) + DAY + f"""
SELECT event_id, queries, busy, {', '.join(DAY_RULES)} FROM judged""")
def group_pipeline(spark, folder):
    result = pipeline.run(pipeline.filter_types(log(spark, folder)), day_groups())
    return result.log.select("event_id", "queries", "busy", *result.rules)


@query("cross_group_apply", ctes(LOG) + DAY + """
SELECT c.site, c.srcg, SPV, CPV, coalesce(busy, 0) busy FROM c LEFT JOIN busy ON sc = c.srcg""")
def cross_group_apply(spark, folder):
    result = pipeline.run(pipeline.filter_types(log(spark, folder)), day_groups())
    return result.frames["channel"].select("site", "srcg", "SPV", "CPV", "busy")


_DAY_HITS = " + ".join(f"({r} >= 4)::INT" for r in DAY_RULES)
_DAY_SOFT = " + ".join(f"({r} = 4)::INT" for r in DAY_RULES)


@query("daily_reports", ctes(LOG) + DAY + f"""
, j AS (SELECT *, greatest({', '.join(DAY_RULES)}, 3) f, {_DAY_HITS} hits, {_DAY_SOFT} soft FROM judged)
, v AS (SELECT regexp_replace(site, 'https?://', '') site, srcg channel, count(*) valid_rows FROM j WHERE f <= 3 OR (f = 4 AND soft < 3) GROUP BY ALL)
, s AS ({_SHEET})
, fired AS (SELECT srcg, count(*) FILTER (BusyByGuid >= 4) busy_fired FROM j GROUP BY srcg)
SELECT s.*, coalesce(valid_rows, 0) valid_rows, coalesce(busy_fired, 0) busy_fired
FROM s LEFT JOIN v USING (site, channel) LEFT JOIN fired ON fired.srcg = channel""")
def daily_reports(spark, folder):
    day = log(spark, folder).withColumn("ctype", F.col("act")).withColumn("sadspace", F.col("q"))
    out = pipeline.daily_reports(day, day_groups(), scratch_path(spark, "judged"))
    sheet = out["sheet"].withColumn("AvgCheckoutNum", F.round("AvgCheckoutNum", 6))
    valid = out["valid"].groupBy(
        F.regexp_replace("site", "https?://", "").alias("site"), F.col("srcg").alias("channel")).agg(
        F.count(F.lit(1)).alias("valid_rows"))
    status = reports.rule_status(out["judged"], DAY_RULES, ["srcg"]).filter("algorithm = 'BusyByGuid'").select(
        F.col("srcg").alias("channel"), (F.col("anomaly") + F.col("spam")).alias("busy_fired"))
    joined = agg.same_keys(agg.same_keys(sheet, valid, ["site", "channel"]), status, ["channel"])
    return joined.na.fill({"valid_rows": 0, "busy_fired": 0})
