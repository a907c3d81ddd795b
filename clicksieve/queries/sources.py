"""Queries of the source and sink operators."""

from pyspark.sql import functions as F

from clicksieve.queries.base import CHECKS, LOG, checks, ctes, log, query, table
from clicksieve.session import scratch_path
from clicksieve.sources import tables as src

def _day():
    return F.date_format(F.timestamp_millis("t_ms"), "yyyyMMdd")


_DAY_SQL = "strftime(to_timestamp(t_ms / 1000) AT TIME ZONE 'UTC', '%Y%m%d')"


def _daily(spark, folder):
    """Searches and clicks per day and channel."""
    return log(spark, folder).withColumn("day", _day()).groupBy("day", "srcg").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("act") == "click", 1).otherwise(0)).alias("clicks"))


DAILY = f"""daily AS (
  SELECT {_DAY_SQL} "day", srcg, count(*) n, CAST(sum(CASE WHEN act = 'click' THEN 1 ELSE 0 END) AS BIGINT) clicks
  FROM log GROUP BY ALL)"""


@query("scan_log", "SELECT event_id, user_id, event_type, value FROM events")
def scan_log(spark, folder):
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    return src.read_log(spark, f"{folder}/events.parquet", schema=schema)


@query("scan_days", ctes(LOG) + f"""
SELECT {_DAY_SQL} "day", count(*) n, round(sum(value), 4) "value"
FROM log WHERE {_DAY_SQL} BETWEEN '20240101' AND '20240131' GROUP BY ALL""")
def scan_days(spark, folder):
    path = scratch_path(spark, "log")
    log(spark, folder).withColumn("day", _day()).write.partitionBy("day").parquet(path)
    return src.read_days(spark, path, "20240101", 31).groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query("scan_sheet", """
SELECT CAST(c_custkey AS VARCHAR) c_custkey, c_name, CAST(c_nationkey AS VARCHAR) c_nationkey, c_mktsegment
FROM customer""")
def scan_sheet(spark, folder):
    path = scratch_path(spark, "sheet")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    src.write_sheet(table(spark, folder, "customer").select(*cols), path, one_file=False)
    return src.read_sheet(spark, path, cols)


@query("sink_sheet", ctes(LOG) + """
SELECT site, srcg, CAST(count(*) AS VARCHAR) n FROM log GROUP BY site, srcg""")
def sink_sheet(spark, folder):
    path = scratch_path(spark, "sheet")
    src.write_sheet(log(spark, folder).groupBy("site", "srcg").agg(F.count(F.lit(1)).alias("n")), path)
    return src.read_sheet(spark, path)


@query("sink_model", ctes(LOG, DAILY) + "SELECT * FROM daily")
def sink_model(spark, folder):
    path = scratch_path(spark, "model")
    src.save_model(_daily(spark, folder), path)
    return src.load_model(spark, path)


@query("daily_union", ctes(LOG, DAILY) + """
SELECT srcg, CAST(n AS VARCHAR) n, CAST(clicks AS VARCHAR) clicks, "day" AS "date" FROM daily
WHERE "day" BETWEEN '20240101' AND '20240130'""")
def daily_union(spark, folder):
    path = scratch_path(spark, "reports")
    _daily(spark, folder).write.partitionBy("day").option("header", True).csv(path)
    return src.daily_union(spark, path + "/day={day}", "20240101", "20240130", ["srcg", "n", "clicks"])


@query("promote_report", ctes(LOG) + """
SELECT site, CAST(count(DISTINCT guid) AS VARCHAR) users, CAST(count(*) AS VARCHAR) n FROM log GROUP BY site""")
def promote_report(spark, folder):
    path = scratch_path(spark, "report")
    report = log(spark, folder).groupBy("site").agg(
        F.count_distinct("guid").alias("users"), F.count(F.lit(1)).alias("n"))
    src.write_sheet(report, path + "_temp")
    src.promote_report(spark, path + "_temp", path)
    return src.read_sheet(spark, path)


@query("model_history", ctes(LOG, DAILY) + """
SELECT CAST(g AS INTEGER) gap, strftime(DATE '2024-02-05' - CAST(g AS INTEGER), '%Y%m%d') "day", srcg, n, clicks
FROM range(1, 41) AS r(g)
LEFT JOIN daily ON daily."day" = strftime(DATE '2024-02-05' - CAST(g AS INTEGER), '%Y%m%d')""")
def model_history(spark, folder):
    path = scratch_path(spark, "model")
    src.save_model(_daily(spark, folder), path)
    return src.model_history(src.load_model(spark, path), "20240205", 1, 40).select(
        "gap", "day", "srcg", "n", "clicks")


_KEYS = ["site", "srcg", "ctype", "sadspace"]


@query("patch_by_key", ctes(CHECKS) + """
, old AS (SELECT site, srcg, ctype, sadspace, count(*) searchNum,
                 CAST(sum(CASE WHEN TaxBySite = 3 THEN 1 ELSE 0 END) AS BIGINT) valid FROM checks GROUP BY ALL)
, new AS (SELECT site, srcg, ctype, sadspace, count(*) searchNum,
                 CAST(sum(CASE WHEN PriceByGuid = 3 THEN 1 ELSE 0 END) AS BIGINT) valid
          FROM checks WHERE QtyBySrcg = 5 AND DiscBySrcg = 5 GROUP BY ALL)
SELECT old.site, old.srcg, old.ctype, old.sadspace,
       CASE WHEN new.site IS NULL THEN old.searchNum ELSE new.searchNum END searchNum,
       CASE WHEN new.site IS NULL THEN old.valid ELSE new.valid END valid
FROM old LEFT JOIN new ON old.site = new.site AND old.srcg = new.srcg AND old.ctype = new.ctype
  AND old.sadspace IS NOT DISTINCT FROM new.sadspace""")
def patch_by_key(spark, folder):
    rows = checks(spark, folder)
    sheet = lambda df, rule: df.groupBy(*_KEYS).agg(
        F.count(F.lit(1)).alias("searchNum"), F.sum((F.col(rule) == 3).cast("bigint")).alias("valid"))
    new = sheet(rows.filter("QtyBySrcg = 5 and DiscBySrcg = 5"), "PriceByGuid")
    return src.patch_by_key(sheet(rows, "TaxBySite"), new, _KEYS, ["searchNum", "valid"])


@query("upsert_by_key", ctes(CHECKS) + """
, old AS (SELECT guid, count(*) "level" FROM checks WHERE PriceByGuid = 4 GROUP BY guid)
, new AS (SELECT guid, count(*) "level" FROM checks WHERE DiscBySrcg = 5 GROUP BY guid)
SELECT guid, "level" FROM new
UNION ALL SELECT guid, "level" FROM old WHERE guid NOT IN (SELECT guid FROM new)""")
def upsert_by_key(spark, folder):
    rows = checks(spark, folder)
    levels = lambda cond: rows.filter(cond).groupBy("guid").agg(F.count(F.lit(1)).alias("level"))
    return src.upsert_by_key(levels("PriceByGuid = 4"), levels("DiscBySrcg = 5"), ["guid"], ["level"])


@query("exclude_list", ctes(LOG) + """
SELECT site, srcg, count(*) n FROM log WHERE site NOT LIKE 'https%' GROUP BY site, srcg""")
def exclude_list(spark, folder):
    path = scratch_path(spark, "exclude")
    rows = log(spark, folder)
    rows.filter(F.col("site").startswith("https")).select("site").distinct().write.text(path)
    kept = src.exclude_listed(rows, spark, path)
    return kept.groupBy("site", "srcg").agg(F.count(F.lit(1)).alias("n"))
