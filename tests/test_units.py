import math
import re
import random
from datetime import datetime
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clicksieve import status
from clicksieve.functions import agents, detail, histogram, text, times
from clicksieve.operators import aggregate as agg
from clicksieve.operators import cluster, distribution, features, forest, vectors
from clicksieve.plans import pipeline, reports
from clicksieve.sources import tables as src


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def value(spark, expr, **cols):
    df = spark.createDataFrame([tuple(v for v, _ in cols.values())], ", ".join(f"{k} {t}" for k, (_, t) in cols.items()))
    return df.select(expr).first()[0]


# status ------------------------------------------------------------------------


def test_check_rule_order(spark):
    df = frame(spark, [("s1", 9), ("x", 9), ("x", 5), ("x", 1)], "srcg string, v int")
    got = [r[0] for r in df.select(status.check_rule("v > 8", "v > 4", remit=["^s"])).collect()]
    assert got == [2, 5, 4, 3]
    with pytest.raises(ValueError):
        status.check_rule()


def test_guarded_rule_reports_errors(spark):
    df = frame(spark, [(1, 2), (1, 0)], "a int, b int")
    verdict = F.when(F.try_divide(F.col("a"), F.col("b")) > 0, 4)
    assert [r[0] for r in df.select(status.guarded_rule(verdict)).collect()] == [4, 1]


def test_labels_and_valid_rows(spark):
    rows = [(3, 3, 3, 3), (5, 3, 3, 3), (4, 4, 3, 3), (4, 4, 4, 3), (4, 4, 4, 4), (None, None, 0, 4)]
    df = frame(spark, rows, "a int, b int, c int, d int")
    names = ["a", "b", "c", "d"]
    assert [r[0] for r in df.select(status.status_label(names)).collect()] == [0, 1, 0, 1, 1, 0]
    assert [r[0] for r in df.select(status.status_label(names, 4)).collect()] == [0, 1, 0, 0, 1, 0]
    assert status.valid_rows(df, names).count() == 3


# details -----------------------------------------------------------------------


@pytest.mark.parametrize("op,literal,shown,want", [
    (">", "0", "2", True), (">", "9", "10", True), (">", "9", "x10", True), ("==", "''", "", True),
    ("!=", "search2", "search1", True), ("<=", "1.5", "1.5", True), (">", "1", None, False), (">", "1", "1.2.3", False),
])
def test_conditions(spark, op, literal, shown, want):
    cond = detail.Condition("f", op, literal)
    assert value(spark, cond.test(F.col("v")), v=(shown, "string"), z=(1, "int")) is want


@pytest.mark.parametrize("conds,want", [(["1", "0", "3"], ["a", "c"]), (["1"], ["a", "b", "c"]), (["0"], []), ([], [])])
def test_keep_where(spark, conds, want):
    expr = detail.keep_where(F.col("v"), F.col("c"), detail.Condition("c", ">", "0"))
    assert value(spark, expr, v=(["a", "b", "c"], "array<string>"), c=(conds, "array<string>")) == want


def test_json_paths(spark):
    sample = '[{"pn":"4","srcg":[{"pos":"4"},{"pos":"2"}]},{"pn":"4","srcg":[]}]'
    schema = "array<struct<pn:string,srcg:array<struct<pos:string>>>>"
    leaf = lambda p: detail.leaf_values(detail.parse_details(F.col("j"), schema), p)
    assert value(spark, leaf("srcg.pos"), j=(sample, "string")) == ["4", "2"]
    assert value(spark, leaf("pn"), j=(sample, "string")) == ["4", "4"]
    assert value(spark, leaf("pn"), j=("{broken", "string"), z=(1, "int")) == []
    assert value(spark, leaf("pn"), j=(None, "string"), z=(1, "int")) == []


def test_leaves_of_all_rows_are_counted(spark, tmp_path):
    """Click times of every row that can be read; only broken texts have no leaves."""
    duckdb = pytest.importorskip("duckdb")
    day = datetime(2024, 1, 2)
    line = lambda order, part, number, quantity: (order, part, 21, "A", number, quantity, day)
    rows = [line(1, 26, 1, 7.0), line(1, 26, 1, 7.0), line(2, 27, 1, 1.0), line(3, 28, 1, 50.0), line(4, 29, 3, 49.0)]
    folder, sql = str(tmp_path), entry.oracle_sql()["json_path_values"]
    frame(spark, rows, "l_orderkey long, l_partkey long, l_suppkey long, l_returnflag string, l_linenumber int, "
                       "l_quantity double, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")
    got = {(r.leaf, r.value): r.n for r in entry.queries()["json_path_values"](spark, folder).collect()}
    at = lambda seconds: ("ad_clickdetails.click_time", str(1704153600000 + seconds * 1000))
    assert got == {
        ("industry", "i1"): 4, ("industry", "i2"): 2, ("industry", "i4"): 1, ("ad_clickdetails.click_time", "null"): 2,
        at(7200 + 600): 2, at(7200 + 600 + 3000): 2, at(3 * 7200 + 600): 1}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
    assert got == {(leaf, value): n for leaf, value, n in con.execute(f"SELECT leaf, value, n FROM ({sql})").fetchall()}


def test_top_ad_missing(spark):
    rule = lambda tg, pos: value(
        spark, detail.top_ad_missing(F.col("t"), F.col("p")), t=(tg, "string"), p=(pos, "array<string>"))
    assert rule("top|keyword|1|182,bottom|keyword|1", ["2"]) == 5
    assert rule("top|keyword|1", ["2", "1"]) == 3
    assert rule("top", []) == 3 and rule("", []) == 3 and rule(None, []) == 3
    assert rule("right|k|1", []) == 3


# histograms ---------------------------------------------------------------------


def test_keys_and_texts(spark):
    assert value(spark, histogram.clean_key(F.col("k")), k=("ab#\r\n | :ab", "string")) == "abab"
    assert value(spark, histogram.clean_key(F.col("k")), k=(" |", "string")) == "unk"
    got = value(spark, histogram.entries(F.col("k")), k=("1:0.3|2:0.2|x|3:y|4:1", "string"))
    assert [(e.key, e.n) for e in got] == [("1", 0.3), ("2", 0.2), ("4", 1.0)]


def test_edges(spark):
    assert agg.bin_edges("custom", "5,1,9") == [1, 5, 9]
    assert agg.bin_edges("bins", "3-9") == [1, 3, 6, 9]
    edge = lambda v: value(spark, histogram.edge_bin(F.col("v"), [10, 1, 5]), v=(v, "string"), z=(1, "int"))
    assert [edge(v) for v in ("0", "1", "1.5", "10", "99", "x", None)] == [1, 1, 5, 10, 10, None, None]
    gap = lambda v: value(spark, histogram.log_gap_bucket(F.col("v")), v=(v, "string"), z=(1, "int"))
    assert [gap(v) for v in ("0", "1", "20", "x", None)] == [0, 0, 3, 3, 3]


def test_value_distribution_options(spark):
    df = frame(spark, [("g", v) for v in ["a", "a", "b", "c", "c", "c", "null", None]], "g string, v string")
    dist = lambda **kw: agg.value_distribution(df, ["g"], F.col("v"), **kw).first()
    assert dist().hist == "c:3|a:2|b:1" and dist().total == 6 and dist().top_share == 0.5
    assert dist(limit=1).hist == "c:3" and dist(limit=1).total == 6
    assert dist(bernoulli=True).hist == "c:1|a:1|b:1"
    assert dist(valid=["b"]).hist == "other:5|b:1"
    assert dist(exclude=[], where=F.col("v") > "b").hist == "c:3|null:1"


def test_frequency_statistics(spark):
    df = frame(spark, [("g", "a"), ("g", "a"), ("g", "b"), ("g", None), ("e", None)], "g string, v string")
    got = {r.g: tuple(r)[1:] for r in agg.freq_stats(df, ["g"], F.col("v"), "v").collect()}
    assert got == {"g": (2, 2.0, 1.0, 1.5, 0.25), "e": (0, -1.0, -1.0, -1.0, -1.0)}


def test_group_features_equal_separate_aggregates(spark):
    df = frame(spark, [("g", "a", 1), ("g", "b", 2), ("g", "b", 3), (None, None, 4)], "g string, k string, v int")
    out = agg.group_features(
        df, ["g"], [agg.Scalar("n", "count", F.lit(1)), agg.Scalar("lo", "min", F.col("v")), agg.Scalar("s", "sum", F.col("v"))],
        [agg.Keyed("k", F.col("k"), {"kinds": "distinct", "most": "max", "share": "share", "top": "top", "mean": "mean"})])
    got = {r.g: tuple(r)[1:] for r in out.collect()}
    assert got == {"g": (3, 1, 6, 2, 2.0, 2 / 3, "b", 1.5), None: (1, 4, 4, 0, -1.0, 0.0, None, -1.0)}


def test_numeric_features(spark):
    df = frame(spark, [("g", 2.0, "0", [1, 2]), ("g", None, "1", []), ("g", 5.0, "2", [7])], "g string, v double, tp string, a array<int>")
    out = agg.numeric_features(df, ["g"], [
        agg.Numeric("n", F.col("v")), agg.Numeric("s", F.col("v"), total=True, types=["0", "1"]),
        agg.Numeric("none", F.col("v"), total=True, where=F.col("v") > 9),
        agg.Numeric("an", F.col("a"), array=True), agg.Numeric("as", F.col("a"), total=True, array=True)]).first()
    assert tuple(out)[1:] == (2.0, 2.0, 0.0, 3.0, 10.0)


# text, times, agents ---------------------------------------------------------------


def test_text_helpers(spark):
    assert value(spark, text.clean_query(F.col("q")), q=("A b-1, 中文!é", "string")) == "Ab1中文"
    assert value(spark, text.product_token(F.col("q")), q=("Mozilla/5.0 (X) Safari/537.36", "string")) == "Safari"
    assert value(spark, text.sigmoid(F.col("q")), q=(0.0, "double")) == 0.5
    assert value(spark, text.text_or_empty(F.col("q")), q=(None, "int"), z=(1, "int")) == ""
    df = frame(spark, [("a#b#c",)], "k string")
    assert tuple(df.select(*text.split_key(F.col("k"), ["x", "y", "z"])).first()) == ("a", "b", "c")


def test_days(spark):
    day = lambda e, v: value(spark, e, d=(v, "string"), z=(1, "int"))
    assert day(times.shift_day(F.col("d"), 3), "20121230") == "20130102"
    assert day(times.next_days(F.col("d"), 3), "20200228") == ["20200228", "20200229", "20200301"]
    assert day(times.day_gap(F.col("d"), F.lit("20201101")), "20201028") == 4
    assert day(times.day_of_week(F.col("d")), "1601604290000") == "Fri"
    assert day(times.day_of_week(F.col("d")), "x") is None
    assert day(times.format_time(F.col("d")), "1601604290000") == "10/02 02:04:50"


def test_holidays(spark):
    cal = frame(spark, [("holiday", "20240101", "2"), ("workday", "20240106", "1"), ("workday", "20240102", "1")], "type string, start string, last string")
    days = frame(spark, [(d,) for d in ("20240101", "20240102", "20240103", "20240106", "20240107")], "d string")
    got = {r.d: r.holiday for r in times.holiday_flag(days, "d", cal).collect()}
    assert got == {"20240101": True, "20240102": True, "20240103": False, "20240106": False, "20240107": True}


def test_agents_by_the_rule_tables(spark):
    """Every browser and system rule is found by its own words, unless an earlier rule takes them."""
    texts = [f"{w}/7.1 ({s.required[-1][0]})" for b in agents.BROWSERS for w in b.aliases for s in agents.SYSTEMS[::9]]
    texts += [" ".join(w[-1] for w in s.required) + end for s in agents.SYSTEMS for end in ("", " mobile")] + ["", "nothing known"]
    has = lambda t, words: any(w in t.lower() for w in words)
    browser = lambda t: next((b for b in agents.BROWSERS if has(t, b.aliases) and not has(t, b.excludes)), None)
    system = lambda t: next((s for s in agents.SYSTEMS if all(has(t, w) for w in s.required) and not has(t, s.excludes)), None)
    df = frame(spark, [(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i int, ua string")
    ua = F.col("ua")
    got = df.select("i", agents.browser_name(ua).alias("b"), agents.browser_rule(ua).alias("r"), ua).select(
        "i", "b", agents.system(ua, F.col("r")).os.alias("os"), agents.browser_version(ua, F.col("r")).full.alias("v"))
    for r in got.collect():
        t = texts[r.i] if r.i >= 0 else ""
        b, s = browser(t), system(t)
        assert r.b == (b.name if b else "Unknown"), t
        assert r.os == (s.name if s and not (b and b.name == agents.ROBOT) else "Unknown"), t
        if b and b.version and b.name not in ("Safari", "Outlook"):
            found = re.search(f"(?i){b.version}", t)
            assert r.v == (found[1] if found else None), t
    assert {s.name for s in map(system, texts) if s} == {s.name for s in agents.SYSTEMS}


def test_version_order(spark):
    less = [("2.5", "3.1"), ("7.0", "7.0.1"), ("7.0.a", "7.0.b"), ("3.1", "25.0"), ("9.9", "10.0")]
    df = frame(spark, less, "a string, b string")
    assert all(r[0] for r in df.select(agents.version_key(F.col("a")) < agents.version_key(F.col("b"))).collect())


# distributions ---------------------------------------------------------------------


def test_distribution_groups(spark):
    hist = frame(spark, [("g", "u", "a", 30), ("g", "v", "b", 60), ("g", "v", "x", 10), ("low", "u", "a", 1)], "g string, u string, k string, n bigint")
    std = {"a": (0.2, 0.1), "b": (0.7, 0.1), "c": (0.1, 0.1)}
    got = {r.g: r for r in distribution.distribution_groups(hist, ["g"], std, limit=50).collect()}
    q = {"a": 0.3, "b": 0.6, "c": 0.0}
    assert got["g"].score == pytest.approx(sum(m * math.log(m / (q[k] + 1e-7)) for k, (m, _) in std.items()))
    assert got["g"].excess["a"] == pytest.approx((30 / 100.001 - 0.2) / (0.1 + 1e-7)) and got["g"].excess["b"] == 0
    assert got["low"].score == 0 and got["low"].excess == {} and got["g"].top_key == "b"
    second = {"a": (0.3, 0.1), "b": (0.6, 0.1), "c": (0.1, 0.1)}
    both = distribution.distribution_groups(hist, ["g"], std, second=second, limit=50).filter("g = 'g'").first()
    assert both.score < got["g"].score and both.excess["a"] == pytest.approx(0, abs=1e-3)
    users = distribution.distribution_users(hist, ["g"], ["u"], distribution.distribution_groups(hist, ["g"], std, limit=50))
    scores = {(r.g, r.u): r.user_score for r in users.collect()}
    assert scores["g", "u"] == pytest.approx(got["g"].excess["a"]) and scores["g", "v"] == 0 and scores["low", "u"] == 0
    remit = distribution.Remit(F.col("top_key") == "b", {"a": (0.3, 0.1)})
    eased = distribution.distribution_groups(hist, ["g"], std, limit=50, remit=remit).filter("g = 'g'").first()
    assert eased.excess["a"] == 0
    first = distribution.distribution_groups(hist, ["g"], std, limit=50, dividend="first").filter("g = 'g'").first()
    assert first.excess["b"] == pytest.approx((60 / 30 - 0.7) / (0.1 + 1e-7))


# vectors ---------------------------------------------------------------------------


@pytest.mark.parametrize("data", [range(1, 10), [0, *range(2, 10)], [*range(1, 9), 10]])
def test_skewness(spark, data):
    x = np.array(list(data), float)
    want = ((x - x.mean()) ** 3).mean() / ((x - x.mean()) ** 2).mean() ** 1.5
    df = frame(spark, [("g", float(v)) for v in x], "g string, v double")
    assert vectors.skewness(df, ["g"], "v").first().skewness == pytest.approx(want, abs=1e-12)


def test_moments_and_mahalanobis(spark):
    m = np.array([[4.0, 2, 3], [5, 6, 1], [2, 4, 7], [3, 6, 5], [1, 7, 2]])
    df = frame(spark, [(list(map(float, r)),) for r in m], "v array<double>").repartition(3)
    model = vectors.fit_moments(df, "v")
    assert np.allclose(model.cov, np.cov(m.T))
    inv, mean, sd = np.linalg.inv(np.cov(m.T)), m.mean(0), m.std(0, ddof=1)
    got = [r[0] for r in df.select(vectors.mahalanobis(model, F.col("v"))).collect()]
    d = lambda x: (x - mean - 3 * sd) @ inv @ (x - mean - 3 * sd)
    assert np.allclose(sorted(got), sorted(math.sqrt(d(x) / d(mean + 2 * sd)) for x in m))


def test_calinski_harabasz(spark):
    m = {0: [[4.0, 2, 3], [5, 6, 1]], 1: [[2.0, 4, 7], [3, 6, 5]], 2: [[9.0, 9, 9]]}
    rows = [(k, [float(x) for x in v]) for k, vs in m.items() for v in vs]
    allv = np.array([v for _, v in rows])
    between = sum(len(v) * ((np.mean(v, 0) - allv.mean(0)) ** 2).sum() for v in m.values())
    within = sum(len(v) * np.trace(np.cov(np.array(v).T)) for v in m.values() if len(v) > 1)
    got = vectors.calinski_harabasz(frame(spark, rows, "l int, v array<double>"), "l", "v").first()
    assert got.score == pytest.approx(between / within * (5 - 3) / (3 - 1))


def test_correlation_without_variance(spark):
    df = frame(spark, [([1.0, 2.0, 5.0],), ([2.0, 4.0, 5.0],), ([3.0, 5.0, 5.0],)], "v array<double>")
    got = {(r.a, r.b): r.corr for r in vectors.correlation_matrix(df, "v").collect()}
    assert got[0, 1] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 5])[0, 1])
    assert math.isnan(got[0, 2]) and got[2, 2] == 1.0 and len(got) == 9


def test_euclid_outlier(spark):
    rows = [(20.0, 1.0, 1.0), (20.0, 3.0, 0.0), (3.0, 4.0, 0.0)]
    df = frame(spark, rows, "a double, b double, c double")
    got = [r[0] for r in df.select(vectors.euclid_outlier(F.array("a", "b", "c"))).collect()]
    assert got == pytest.approx([14.9, math.sqrt(409), 5.0])


@pytest.mark.parametrize("values", [
    [1.0] * 500 + [2.0], list(np.random.default_rng(1).normal(size=999)),
    [math.exp(v) for v in range(-300, 300)], [7.0], [0.1] * 300 + list(np.linspace(0, 1, 300))])
@pytest.mark.parametrize("q", [0.5, 0.9, 1.0])
def test_exact_quantile(spark, values, q):
    df = frame(spark, [(float(v),) for v in values], "v double")
    want = sorted(values)[max(1, math.ceil(q * len(values))) - 1]
    assert vectors.exact_quantile(df, "v", q) == want


def test_exact_quantile_of_odd_values(spark, monkeypatch):
    monkeypatch.setattr(vectors, "FEW", 5)
    rng = np.random.default_rng(3)
    base = [*rng.normal(size=3000), *[0.25] * 2000, 1e300, math.inf, -math.inf, -math.inf]
    df = frame(spark, [(float(v),) for v in base] + [(math.nan,), (None,)], "v double")
    for q in (0.0001, 0.3, 0.5, 0.55, 0.9, 0.9999, 1.0):
        assert vectors.exact_quantile(df, "v", q) == sorted(base)[max(1, math.ceil(q * len(base))) - 1], q
    assert {r.anomaly for r in vectors.anomaly_cut(df, "v", 0.1).filter("v is null or isnan(v)").collect()} == {0}


# forest -----------------------------------------------------------------------------


def test_average_path():
    assert forest.average_path(256) == pytest.approx(10.244771, abs=1e-6)
    assert list(forest.average_path(np.array([0, 1, 2]))) == [0, 0, 1]


@pytest.mark.parametrize("params", [
    forest.ForestParams(trees=4, max_samples=40, max_depth=5, clamp=None, shuffle_columns=False),
    forest.ForestParams(trees=3, max_samples=0.5, max_features=2, bootstrap=True),
])
def test_forest_invariants(spark, params):
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, rng.normal(size=2)), 1.0) for i in range(100)] + [(100, 30.0, -30.0, 1.0)]
    df = frame(spark, rows, "i int, a double, b double, c double")
    cols = ["a", "b", "c"]
    sample = forest.iforest_sample(df, "i", cols, params)
    n = forest.tree_rows(101, params)
    per_tree = {r["tree"]: r["count"] for r in sample.groupBy("tree").count().collect()}
    assert per_tree == {t: n for t in range(params.trees)}
    if params.clamp is not None:
        assert sample.agg(F.max("a")).first()[0] <= params.clamp + 0.5
    nodes = forest.iforest_fit(sample, cols, params)
    table = nodes.toPandas()
    for _, t in table.groupby("tree"):
        by = t.set_index("node")
        assert by.loc[0, "size"] == n and by["depth"].max() <= params.max_depth
        inner = by[by["feature"] >= 0]
        assert (inner["feature"] != 2).all()  # the constant column never splits
        for _, r in inner.iterrows():
            assert by.loc[r["left"], "size"] + by.loc[r["right"], "size"] == r["size"]
        assert by[by["feature"] < 0]["size"].sum() == n
    again = forest.iforest_fit(forest.iforest_sample(df, "i", cols, params), cols, params).toPandas()
    key = ["tree", "node"]
    assert table.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))
    scores = {r.i: r.score for r in forest.iforest_score(df, nodes, cols, n, adjust=False).collect()}
    assert all(0 < s <= 1 for s in scores.values())
    if not params.shuffle_columns:
        assert scores[100] == max(scores.values())


def test_forest_refuses_too_many_rows(spark):
    with pytest.raises(ValueError):
        forest.tree_rows(10, forest.ForestParams(max_samples=20))


# clusters ---------------------------------------------------------------------------


def kl(p, q):
    p, q = np.array(p) + 0.0001, np.array(q) + 0.0001
    p, q = p / p.sum(), q / q.sum()
    return float((p * np.log(p / q)).sum())


def greedy(vecs, threshold):
    ids = list(vecs)
    first = lambda a, b: (a, b) if (vecs[a][1], b) > (vecs[b][1], a) else (b, a)
    dist = {frozenset(p): kl(*(vecs[x][0] for x in first(*p))) for p in combinations(ids, 2)}
    groups = [[i] for i in ids]
    while len(groups) > 1:
        mean = lambda a, b: np.mean([dist[frozenset((x, y))] for x in a for y in b])
        d, a, b = min((mean(a, b), i, j) for (i, a), (j, b) in combinations(enumerate(groups), 2))
        if d >= threshold:
            break
        groups[a] += groups.pop(b)
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("seed,threshold", [(1, 0.05), (2, 0.2)])
def test_average_linkage_equals_greedy_merging(spark, seed, threshold):
    rng = np.random.default_rng(seed)
    vecs = {f"g{i:02}": ([float(x) for x in rng.integers(1, 40, 4)], int(rng.integers(10, 99))) for i in range(12)}
    df = frame(spark, [(g, v, n) for g, (v, n) in vecs.items()], "g string, vec array<double>, volume int")
    tags = {}
    for r in cluster.average_link_clusters(df, "g", "volume", threshold).collect():
        tags.setdefault(r.tag, set()).add(r.g)
    assert {frozenset(v) for v in tags.values()} == greedy(vecs, threshold)


def test_histogram_vectors_order_keys(spark):
    numbers = frame(spark, [("a", "10", 1), ("a", "9", 2), ("b", "9", 3)], "g string, k string, n int")
    got = {r.g: r.vec for r in cluster.histogram_vectors(numbers, "g").collect()}
    assert got == {"a": [2.0, 1.0], "b": [3.0, 0.0]}


def test_keep_one_per_page_equals_a_walk(spark):
    rng = random.Random(5)
    rows = [(s, f"{s}{i:03}", rng.randrange(900, 1100)) for s in ("x", "y") for i in range(80)] + [("unk", "u1", 5), ("unk", "u2", 5)]
    want = {("unk", "u1"), ("unk", "u2")}
    for site in "xy":
        anchor, last = 0, None
        for _, ch, v in sorted((r for r in rows if r[0] == site), key=lambda r: (-r[2], r[1])):
            if abs((v - anchor) / (v + anchor)) >= 0.01:
                want |= {(site, last)} if last else set()
                anchor = v
            last = ch
        want.add((site, last))
    df = frame(spark, rows, "site string, srcg string, spv int")
    assert {(r.site, r.srcg) for r in cluster.keep_one_per_page(df, "site", "srcg", "spv").collect()} == want


# sources, joins, reports, pipeline ------------------------------------------------------


def test_patch_and_upsert(spark):
    old = frame(spark, [("a", None, 1), ("b", "x", 2)], "k string, l string, v int")
    new = frame(spark, [("a", None, 9), ("z", "z", 5)], "k string, l string, v int")
    patched = {(r.k, r.l): r.v for r in src.patch_by_key(old, new, ["k", "l"], ["v"]).collect()}
    assert patched == {("a", None): 9, ("b", "x"): 2}
    merged = {(r.k, r.l): r.v for r in src.upsert_by_key(old, new, ["k", "l"], ["v"]).collect()}
    assert merged == {("a", None): 9, ("b", "x"): 2, ("z", "z"): 5}


def test_days_of_sources(spark, tmp_path):
    assert src.day_list("20231230", 4) == ["20231230", "20231231", "20240101", "20240102"]
    with pytest.raises(ValueError):
        src.daily_union(spark, str(tmp_path / "{day}"), "20240102", "20240102")
    for day in ("20240101", "20240102"):
        src.write_sheet(frame(spark, [(day[-1],)], "v string"), str(tmp_path / day / "sheet"))
    got = src.daily_union(spark, str(tmp_path / "{day}" / "sheet"), "20240101", "20240102", ["v"])
    assert {(r.v, r.date) for r in got.collect()} == {("1", "20240101"), ("2", "20240102")}
    models = frame(spark, [("20240102", 7)], "day string, v int")
    rows = src.model_history(models, "20240104", 1, 3).collect()
    assert [(r.gap, r.day, r.v) for r in rows] == [(1, "20240103", None), (2, "20240102", 7), (3, "20240101", None)]


def test_save_model_replaces_only_its_day(spark, tmp_path):
    path = str(tmp_path / "m")
    src.save_model(frame(spark, [("20240101", 1), ("20240102", 2)], "day string, v int"), path)
    src.save_model(frame(spark, [("20240102", 3)], "day string, v int"), path)
    assert {(r.day, r.v) for r in src.load_model(spark, path).collect()} == {("20240101", 1), ("20240102", 3)}


def test_cooccurrence_counts(spark):
    rows = [("s", 4, 4, 3), ("s", 4, 3, 3), ("s", 5, 4, 4), ("s", 3, 3, 4)]
    df = frame(spark, rows, "srcg string, QtyBySrcg int, QtyByGuid int, TaxBySite int")
    got = {(r.rule, r.partner): (r.checked, r.independent, r.joint) for r in reports.rule_cooccurrence(df, ["QtyBySrcg", "QtyByGuid", "TaxBySite"]).collect()}
    # names of one family never pair; the first by name gets a row of just the two
    assert got == {
        ("QtyBySrcg", "TaxBySite"): (3, 1, 1), ("QtyByGuid", "TaxBySite"): (2, 1, 1),
        ("TaxBySite", "QtyByGuid"): (2, 1, 1), ("TaxBySite", "QtyBySrcg"): (2, 1, 1)}


def test_score_bins_at_their_edges(spark):
    df = frame(spark, [(0.3, 1, 0), (0.302, 2, 1), (0.304, 1, 0), (2.0, 1, 1)], "s double, o int, l int")
    got = {r.bin: r for r in reports.score_bin_report(df, "s", "o", "l").collect()}
    assert (got[1].in_bin, got[1].above, got[1].total) == (1, 3, 4) and got[2].above == 2 and got[300].above == 1
    flat = {r.bin: r.n for r in reports.score_bin_report_flat(frame(spark, [(0.6, 1, 0), (120.0, 1, 0), (119.99, 1, 0)], "s double, o int, l int"), "s", "o", "l").collect()}
    assert len(flat) == 601 and flat[3] + flat[2] == 1 and flat[600] == 1 and flat[599] == 1


def test_select_pattern(spark):
    df = frame(spark, [(1, 2, 3, 4, 5)], "id int, aCount int, bScore int, bScoreCheck int, other int")
    assert features.select_pattern(df, ["id"], labels={"l": F.lit(0)}).columns == ["id", "aCount", "bScore", "l"]
    with pytest.raises(ValueError):
        features.conditional_feature(df, "x", [], "0")


def test_join_back_keeps_rows_with_null_keys(spark):
    log = frame(spark, [(None, 1), ("a", 2)], "g string, v int")
    groups = log.groupBy("g").agg(F.lit(4).alias("rule"))
    assert pipeline.join_judgements(log, groups, ["g"], ["rule"]).filter("rule = 4").count() == 2


def test_model_for_an_absent_group(spark):
    log = frame(spark, [("a", 1)], "g string, v int")
    model = pipeline.Model("m", fit=lambda f: f, apply=lambda f, m: f, target=["later"])
    group = pipeline.Group("g", ["g"], scalars=[agg.Scalar("n", "count", F.lit(1))], models=[model])
    with pytest.raises(ValueError, match="later"):
        pipeline.run(log, [group])


def test_a_forest_too_large_to_keep_is_read_from_its_files(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, [(i, *map(float, rng.normal(size=2))) for i in range(200)], "i int, a double, b double")
    params = forest.ForestParams(trees=9, max_samples=50, max_depth=4)
    nodes = forest.iforest_fit(forest.iforest_sample(df, "i", ["a", "b"], params), ["a", "b"], params)
    scores = [{r.i: r.score for r in forest.iforest_score(df, nodes, ["a", "b"], 50, kept_nodes=k).collect()} for k in (0, 60, 10 ** 6)]
    assert scores[0] == scores[1] == scores[2] and len(set(scores[0].values())) > 100


# statistics of groups ---------------------------------------------------------------------


def test_own_statistics_and_outputs_by_users(spark):
    rows = [("a", "u1", "x", 2.0), ("a", "u1", "x", 3.0), ("a", "u2", "y", 4.0), ("a", "u3", "y", 1.0), ("a", None, "z", 9.0),
            ("a", "u1", None, 5.0), ("b", None, None, None), (None, "u9", "x", 7.0)]
    df = frame(spark, rows, "g string, u string, k string, v double")
    product = agg.Statistic(
        "product", {"logs": agg.Part(F.ln("v"), F.sum, F.lit(0.0)), "n": agg.Part(F.when(F.col("v").isNotNull(), 1), F.sum, F.lit(0))},
        lambda p: F.when(p["n"] > 0, F.round(F.exp(p["logs"]), 6)))
    keyed = agg.Keyed("k", F.col("k"), {"top": "top", "userTop": "userTop", "userShare": "userShare", "userTotal": "userTotal",
                                       "pairs": lambda n, k: F.sum(n * (n - 1) / 2)})
    plain = {r.g: r.product for r in agg.group_features(df, ["g"], [product]).collect()}
    got = {r.g: r for r in agg.group_features(df, ["g"], [product, agg.Scalar("n", "count", F.lit(1))], [keyed], F.col("u")).collect()}
    assert plain == {g: r["product"] for g, r in got.items()} == {"a": 1080.0, "b": None, None: 7.0}
    # rows: x 2, y 2, z 1; users: x 1, y 2, z none
    assert (got["a"].n, got["a"].top, got["a"].userTop, got["a"].userShare, got["a"].userTotal, got["a"].pairs) == (6, "x", "y", 2 / 3, 3.0, 2.0)
    assert (got["b"].userTop, got["b"].userShare, got["b"].userTotal) == (None, 0.0, 0.0)
    with pytest.raises(ValueError):
        agg.group_features(df, ["g"], [], [keyed])
    spread = {(r.g, r.feature, r.k): (r.n, r.users) for r in agg.key_distributions(df, ["g"], F.col("u"), {"k": F.col("k"), "v": F.col("v")}).collect()}
    assert spread["a", "k", "x"] == (2, 1) and spread["a", "k", "z"] == (1, 0) and spread[None, "v", "7.0"] == (1, 1) and len(spread) == 11
