"""Properties of the plans: no Python, no cross joins, filters in the scan, few shuffles."""

import re

import pytest

import __spark_entry__ as entry
from clicksieve.operators import aggregate as agg
from clicksieve.operators import sequence
from clicksieve.plans import pipeline
from clicksieve.plans.pipeline import filter_types
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
PYTHON = {"iforest_fit", "iforest_score", "iforest_detect", "mahalanobis", "mahalanobis_scores", "correlation_matrix"}
NAMES = sorted(q for q in entry.queries() if not re.match(r"op\d+_|pipeline$", q))
ALL_PAIRS = {"pairwise_kl"}  # the distances of all groups are what it is asked for


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", NAMES)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER), "simple")
    if name not in ALL_PAIRS:  # a cross join in the form of blocks that all meet all
        assert not re.search(r"Join \[_i#\d+, _j#\d+\]", text)
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    if name not in PYTHON:
        assert not re.search(r"Python|MapInPandas|FlatMapGroups", text)


def test_type_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("0", 1), ("2", 2)], "tp string, v int").write.parquet(path)
    text = plan(filter_types(spark.read.parquet(path)))
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(tp,1\)", text)


def test_scan_reads_only_needed_columns(spark):
    text = plan(entry.queries()["settlement_sheet"](spark, FOLDER))
    read = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "l_shipdate" not in read and "l_partkey" not in read


def exchanges(df):
    return plan(df, "simple").count("Exchange ")


def test_group_features_shuffle_and_scan_once(spark):
    rows = spark.read.parquet(f"{FOLDER}/events.parquet")
    scalars = [agg.Scalar("n", "count", F.lit(1)), agg.Scalar("v", "sum", F.col("value"))]
    assert exchanges(agg.group_features(rows, ["event_type"], scalars)) == 1
    keyed = [agg.Keyed("p", F.col("props"), {"p": "distinct"}), agg.Keyed("u", F.col("user_id"), {"u": "share"})]
    both = agg.group_features(rows, ["event_type"], scalars, keyed)
    assert exchanges(both) == 2
    assert plan(both, "simple").count("FileScan") == 1


def test_top_entries_cut_before_the_shuffle(spark):
    rows = spark.read.parquet(f"{FOLDER}/events.parquet")
    top = agg.top_entries(agg.histogram(rows, ["event_type"], F.col("props")), ["event_type"], 3)
    assert "WindowGroupLimit" in plan(top, "simple")


@pytest.mark.parametrize("name", ["fused_group_agg", "time_gap_histogram", "rule_cooccurrence", "action_entropy"])
def test_same_result_for_any_partition_count(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows.append(sorted(map(str, entry.queries()[name](spark, FOLDER).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows[0] == rows[1]


def test_a_hot_key_is_split_at_the_join(spark):
    from clicksieve.plans.pipeline import join_judgements

    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        log = spark.range(0, 400_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), F.rand(1).alias("v"))
        groups = log.groupBy("g").agg(F.count(F.lit(1)).alias("rows"))
        joined = join_judgements(log, groups, ["g"], ["rows"])
        assert joined.filter("g = 'hot'").agg(F.min("rows")).first()[0] == 133_334
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == 400_000
        final = joined.select(F.xxhash64("g", "v", "rows").alias("h"))
        final.collect()
        assert "isSkew=true" in final._jdf.queryExecution().executedPlan().toString().replace("skew=true", "isSkew=true")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_group_reads_only_the_joins_it_names(spark):
    """The channel frame reads no column of the user group, so the log is not joined for it."""
    log = spark.createDataFrame([("u", "s", 1, 2.0)], "guid string, srcg string, h int, value double")
    count = lambda name: agg.Scalar(name, "count", F.lit(1))
    user = pipeline.Group("user", ["guid"], scalars=[count("spv")], join_back=["spv"])
    plain = pipeline.Group("channel", ["srcg"], scalars=[count("n")], join_back=["n"])
    asking = pipeline.Group("busy", ["srcg"], scalars=[agg.Scalar("most", "max", F.col("spv"))], uses=["spv"])
    seen = []
    last = pipeline.Group("hour", ["h"], scalars=[count("m")], export=lambda frame: seen.append(frame.columns))
    out = pipeline.run(log, [user, plain, asking, last], materialize=False)
    assert "Join" not in plan(out.frames["channel"], "simple") and "Join" not in plan(out.frames["hour"], "simple")
    assert plan(out.frames["busy"], "simple").count("Join") == 1
    assert plan(out.log, "simple").count("Join") == 2 and seen == [["h", "m"]]
    assert out.frames["busy"].first().most == 1 and out.log.first().n == 1


def test_timeline_shuffles_once(spark):
    rows = spark.createDataFrame([("u", 1, "a")], "u string, time long, action string")
    assert exchanges(sequence.first_actions(rows, ["u"])) == 1


def test_mix_reads_the_log_once(spark):
    text = plan(entry.queries()["browser_mix"](spark, FOLDER), "simple")
    assert text.count("FileScan") == 1


def test_shares_by_users_gather_a_users_rows_first(spark):
    """A row has many entries: its user's rows meet before them, in parts that AQE may split."""
    rows = spark.read.parquet(f"{FOLDER}/events.parquet")
    by_users = agg.Keyed("p", F.col("props"), {"p": "share", "u": "userShare"})
    by_rows = agg.Keyed("p", F.col("props"), {"p": "share"})
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(agg.group_features(rows, ["event_type"], [], [by_users], F.col("user_id")), "simple")
    assert "REBALANCE" not in plan(agg.group_features(rows, ["event_type"], [], [by_rows]), "simple")


def test_distributions_gather_a_users_rows_first(spark):
    rows = spark.read.parquet(f"{FOLDER}/events.parquet")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(agg.key_distributions(rows, ["event_type"], F.col("user_id"), {"p": F.col("props")}), "simple")


@pytest.mark.parametrize("name, unread", [("json_path_values", "location"), ("click_hours", "industry"),
                                          ("inline_predicate", "ad_clickdetails")])
def test_only_asked_fields_are_parsed(spark, name, unread):
    text = plan(entry.queries()[name](spark, FOLDER), "extended")
    assert "StructField(" in text and f"StructField({unread}" not in text


def test_a_row_gives_one_entry_per_clicked_kind(spark):
    """The sizes ride on the first kind instead of an entry of their own."""
    text = plan(entry.queries()["inline_predicate"](spark, FOLDER), "extended")
    assert not re.search(r"posexplode\(concat\(array", text)
