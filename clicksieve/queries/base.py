"""Registry of queries with their oracle SQL, and the views they read.

The test tables are mapped to the data model of a click log here, so that the
operators see the columns they would see in production.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicksieve.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is what DuckDB runs on the same tables."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(tune(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# log: one row per search or click ------------------------------------------

def log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "cast(user_id as string) guid",
        "concat('s', cast(user_id % 7 as string)) srcg",
        "concat(case when user_id % 2 = 0 then 'http://' else 'https://' end,"
        " 'site', cast(user_id % 3 as string)) site",
        "cast(event_id % 3 as string) tp",
        "event_type act",
        "unix_millis(cast(ts as timestamp)) t_ms",
        "value",
        "get_json_object(props, '$.k') q",
    )


LOG = """log AS (
  SELECT event_id, CAST(user_id AS VARCHAR) guid,
         concat('s', CAST(user_id % 7 AS VARCHAR)) srcg,
         concat(CASE WHEN user_id % 2 = 0 THEN 'http://' ELSE 'https://' END,
                'site', CAST(user_id % 3 AS VARCHAR)) site,
         CAST(event_id % 3 AS VARCHAR) tp, event_type act,
         epoch_us(ts) // 1000 t_ms, value,
         json_extract_string(props, '$.k') q
  FROM events)"""


# checks: judged rows --------------------------------------------------------

RULES = ["QtyBySrcg", "QtyByGuid", "DiscBySrcg", "TaxBySite", "PriceByGuid"]

_RULE_SQL = """
  CASE WHEN l_quantity >= 48 THEN 5 WHEN l_quantity >= 40 THEN 4 ELSE 3 END QtyBySrcg,
  CASE WHEN l_quantity >= 30 THEN 4 ELSE 3 END QtyByGuid,
  CASE WHEN l_discount >= 0.09 THEN 5 WHEN l_discount >= 0.07 THEN 4 ELSE 3 END DiscBySrcg,
  CASE WHEN l_tax >= 0.07 THEN 4 ELSE 3 END TaxBySite,
  CASE WHEN l_extendedprice >= 60000 THEN 4 ELSE 3 END PriceByGuid"""


def checks(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    return li.selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag site",
        "concat('s', cast(l_suppkey % 20 as string)) srcg",
        "cast(l_orderkey as string) guid",
        "l_linestatus ctype",
        "case when l_linenumber = 1 then null else cast(l_linenumber as string) end sadspace",
        *[part.strip() for part in _RULE_SQL.split(",\n")],
    )


CHECKS = f"""checks AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag site,
         concat('s', CAST(l_suppkey % 20 AS VARCHAR)) srcg, CAST(l_orderkey AS VARCHAR) guid,
         l_linestatus ctype,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END sadspace,
         {_RULE_SQL}
  FROM lineitem)"""


# ads: one row per shown ad --------------------------------------------------

def ads(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    li = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    p = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(p, li.l_partkey == p.p_partkey)
        .selectExpr(
            "o_orderkey", "cast(o_custkey as string) guid", "o_orderpriority srcg",
            "p_brand industry", "p_type sub_industry", "l_linenumber - 1 clicks",
            "l_linenumber pos", "l_quantity w")
    )


ADS = """ads AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) guid, o_orderpriority srcg,
         p_brand industry, p_type sub_industry, l_linenumber - 1 clicks,
         l_linenumber pos, l_quantity w
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey)"""


# adlog: log rows that carry their ads as JSON text ---------------------------
# A row shows 1 to 3 ads. Ad k stands at position k + (l_linenumber mod 2) and
# was clicked (l_linenumber + k) mod 3 times. Rows with quantity 50 hold broken
# JSON; clicks of rows with quantity 1 have no readable time.

def _ad_text(k: int, location: str) -> str:
    """SQL of the JSON text of ad k."""
    clicks = f"(l_linenumber + {k}) % 3"
    click = lambda j: f"""concat('{{"click_time":"', case when l_quantity = 1 then 'null' else
        cast(day_ms + (l_linenumber * 7200 + {k * 600 + j * 3000}) * 1000L as string) end, '"}}')"""
    return f"""concat('{{"industry":"i', cast(l_partkey % 25 as string), '","sub_industry":"u',
        cast((l_partkey + {k}) % 40 as string), '","location":"{location}","pos":"',
        cast({k} + l_linenumber % 2 as string), '","ad_clicknum":"', cast({clicks} as string),
        '","ad_clickdetails":[', case {clicks} when 0 then '' when 1 then {click(0)}
        else concat({click(0)}, ',', {click(1)}) end, ']}}')"""


def adlog(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_suppkey", "l_partkey", "l_returnflag", "l_linenumber", "l_quantity",
        "unix_millis(cast(l_shipdate as timestamp)) day_ms")
    # the test table is one row group: without this one task would write and parse all the JSON
    li = li.repartition("l_orderkey", "l_linenumber")
    shown = [f"case when l_linenumber % 3 >= {k - 1} then {_ad_text(k, place)} end"
             for k, place in enumerate(["top", "right", "bottom"], 1)]
    return li.selectExpr(
        "cast(l_orderkey as string) guid",
        "concat('s', cast(l_suppkey % 20 as string)) srcg",
        "l_returnflag site",
        f"case when l_quantity = 50 then '{{broken' else concat('[', concat_ws(',', {', '.join(shown)}), ']') end ads_details",
        """case l_linenumber when 1 then 'top|keyword|1|182,bottom|keyword|1' when 2 then 'right|keyword|1'
            when 3 then 'top' when 4 then '' when 5 then 'top|keyword|1'
            when 6 then 'bottom|keyword|2|7,top|keyword|1|3' else 'right|keyword|1,bottom|keyword|1' end tg""",
        "cast(l_quantity as string) qty",
    )


# adrows: the same ads, flat
ADLOG = """adrows AS (
  SELECT CAST(l_orderkey AS VARCHAR) guid, concat('s', CAST(l_suppkey % 20 AS VARCHAR)) srcg,
         l_returnflag site,
         concat('i', CAST(l_partkey % 25 AS VARCHAR)) industry,
         concat('u', CAST((l_partkey + k) % 40 AS VARCHAR)) sub_industry,
         ['top', 'right', 'bottom'][k] AS "location",
         k + l_linenumber % 2 pos, (l_linenumber + k) % 3 clicknum, k,
         l_quantity, l_linenumber, l_shipdate
  FROM lineitem, unnest(range(1, 2 + l_linenumber % 3)) AS u(k)
  WHERE l_quantity <> 50)"""


# adviews: one row per shown ad with all that the feature catalogue asks of it ----
# A customer is its order here; its age in days follows from the number. Line 1 is
# a first search, line 2 a second one, line 3 a suggestion, the rest are pages.

_ADVIEWS = {
    "site": "l_returnflag",
    "srcg": "concat('s', CAST(l_suppkey % 5 AS STRING))",
    "guid": "CAST(l_orderkey % 900 AS STRING)",
    "age": "l_orderkey % 900 % 11",
    "industry": "concat('i', CAST(l_partkey % 25 AS STRING))",
    "sub_industry": "concat('u', CAST(l_partkey % 140 AS STRING))",
    "clicks": "(l_linenumber + l_partkey) % 3",
    "pos": "l_linenumber",
    "hr": "(l_partkey + l_orderkey) % 24",
    "address": "concat('a', CAST(l_suppkey % 60 AS STRING))",
    "q": "CASE WHEN l_quantity > 3 THEN concat('q', CAST(l_partkey % 80 AS STRING)) END",
    "city": "concat('c', CAST(l_suppkey % 17 AS STRING))",
    "area": "concat('r', CAST((l_suppkey + l_linenumber) % 6 AS STRING))",
    "browser": "concat('b', CAST(l_orderkey % 7 AS STRING))",
    "kind": "CASE l_linenumber WHEN 1 THEN 'first' WHEN 2 THEN 'second' WHEN 3 THEN 'suggestion' ELSE 'page' END",
    "gap": "(l_partkey * 7 + l_linenumber) % 100",
}


def adviews(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*[f"{e} {n}" for n, e in _ADVIEWS.items()])


ADVIEWS = "adviews AS (SELECT " + ", ".join(f"{e} {n}" for n, e in _ADVIEWS.items()) + " FROM lineitem)"


# hist, vec --------------------------------------------------------------------

def hist(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "documents")
        .groupBy(F.col("source").alias("grp"), F.col("lang").alias("k"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


HIST = "hist AS (SELECT source grp, lang k, count(*) n FROM documents GROUP BY source, lang)"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def rounded(name: str, digits: int = 6):
    """Column rounded for comparison, under its own name."""
    return F.round(F.col(name), digits).alias(name)
