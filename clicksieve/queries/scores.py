"""Queries of the vector statistics and the isolation forest."""

from pyspark.sql import functions as F

from clicksieve.operators import forest, vectors
from clicksieve.queries.base import ctes, query, rounded, table
from clicksieve.session import keep_table

# Every component of the vectors is read; ``c`` numbers them from 0.
CELLS = """l AS (SELECT vec_id, "label" + 1 w, generate_subscripts(embedding, 1) - 1 c, CAST(unnest(embedding) AS DOUBLE) x FROM embeddings)"""


def _vectors(spark, folder):
    return table(spark, folder, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))


@query("standard_score", ctes(CELLS) + """
, m AS (SELECT c, sum(w * x) / sum(w) mean, sum(w) - sum(w * w) / sum(w) d FROM l GROUP BY c)
, s AS (SELECT l.c, any_value(mean) mean, sqrt(sum(w * (x - mean) * (x - mean)) / any_value(d)) sd FROM l JOIN m USING (c) GROUP BY l.c)
SELECT vec_id, CAST(c AS INT) c, round(least(3 - least((x - mean) / sd, 3), 9), 6) z,
       round(least(3 - least((x - mean) / (SELECT sd FROM s WHERE c = 0), 3), 9), 6) r FROM l JOIN s USING (c)""")
def standard_score(spark, folder):
    rows = _vectors(spark, folder).withColumn("w", F.col("label") + 1)
    model = vectors.fit_weighted(rows, "v", "w")
    both = F.arrays_zip(model.score(F.col("v")).alias("z"), model.score(F.col("v"), reference_mode=True).alias("r"))
    return rows.select("vec_id", F.posexplode(both).alias("c", "_s")).select(
        "vec_id", "c", F.round(F.col("_s")["z"], 6).alias("z"), F.round(F.col("_s")["r"], 6).alias("r"))


@query("mean_of_scores", ctes(CELLS) + "SELECT vec_id, round(sum(x ORDER BY c) / count(*), 6) score FROM l GROUP BY vec_id")
def mean_of_scores(spark, folder):
    return _vectors(spark, folder).select("vec_id", F.round(vectors.mean_of_scores(F.col("v")), 6).alias("score"))


# Over the rows a distance was fitted on, squared distances to the mean add up to
# (rows - 1) x width, and those to mean + 3 sigma, in units of sigma's own, to the
# same over that unit plus 9 x rows. SQL knows both without inverting a matrix.
@query("mahalanobis", ctes(CELLS) + """
, n AS (SELECT count(DISTINCT vec_id) "rows", count(DISTINCT c) width FROM l)
SELECT "rows", width, round(CAST(("rows" - 1) * width AS DOUBLE), 3) squares, round(9.0::DOUBLE * "rows", 3) shifted FROM n""")
def mahalanobis(spark, folder):
    rows = _vectors(spark, folder)
    model = vectors.fit_moments(rows, "v")
    return _mahalanobis_sums(rows, model)


def _mahalanobis_sums(rows, model):
    scored = rows.select(
        F.size("v").alias("width"), vectors.mahalanobis(model, F.col("v")).alias("score"),
        vectors.squared_distance(model, F.col("v")).alias("near"), vectors.squared_distance(model, F.col("v"), 3.0).alias("far"))
    unit = F.max(F.col("far") / (F.col("score") * F.col("score")))
    sums = scored.agg(F.count(F.lit(1)).alias("rows"), F.max("width").cast("bigint").alias("width"), F.sum("near").alias("_n"),
                      F.sum(F.col("score") * F.col("score")).alias("_s"), unit.alias("_u"))
    return sums.select("rows", "width", F.round("_n", 3).alias("squares"), F.round(F.col("_s") - F.col("_n") / F.col("_u"), 3).alias("shifted"))


# The inverse of the covariances by Gauss-Jordan steps, one per component.
_INVERSE = """m AS (SELECT c, avg(x) m, stddev_samp(x) s FROM l GROUP BY c)
, cov AS (SELECT p.c i, q.c j, covar_samp(p.x, q.x) v FROM l p JOIN l q USING (vec_id) GROUP BY p.c, q.c)
, ks AS (SELECT c, row_number() OVER (ORDER BY c) r FROM m)
, steps AS (
  SELECT 0 k, i, j, v FROM cov
  UNION ALL
  SELECT a.k + 1, a.i, a.j, CASE WHEN a.i = ks.c AND a.j = ks.c THEN 1 / p.v WHEN a.i = ks.c THEN a.v / p.v
    WHEN a.j = ks.c THEN -a.v / p.v ELSE a.v - ic.v * jr.v / p.v END
  FROM steps a JOIN ks ON ks.r = a.k + 1 JOIN steps p ON p.i = ks.c AND p.j = ks.c
  JOIN steps ic ON ic.i = a.i AND ic.j = ks.c JOIN steps jr ON jr.i = ks.c AND jr.j = a.j)
, inv AS (SELECT i, j, v FROM steps WHERE k = (SELECT max(k) FROM steps))"""


@query("mahalanobis_scores", ctes(CELLS, _INVERSE).replace("WITH", "WITH RECURSIVE", 1) + """
, unit AS (SELECT sum(p.s * v * q.s) u FROM inv JOIN m p ON p.c = i JOIN m q ON q.c = j)
, z AS (SELECT vec_id, c, x - m - 3 * s z FROM l JOIN m USING (c))
, d AS (SELECT p.vec_id, sum(p.z * v * q.z) d FROM z p JOIN inv ON inv.i = p.c JOIN z q ON q.vec_id = p.vec_id AND q.c = inv.j GROUP BY p.vec_id)
SELECT vec_id, round(sqrt(d / u), 5) score FROM d, unit""")
def mahalanobis_scores(spark, folder):
    rows = _vectors(spark, folder)
    model = vectors.fit_moments(rows, "v")
    return rows.select("vec_id", F.round(vectors.mahalanobis(model, F.col("v")), 5).alias("score"))


@query("euclid_outlier", ctes(CELLS) + """
, m AS (SELECT c, avg(x) m, stddev_samp(x) d FROM l GROUP BY c)
, z AS (SELECT vec_id, abs((x - m) / d) * 2 s FROM l JOIN m USING (c))
, n AS (SELECT vec_id, sqrt(sum(s * s)) len, list_sort(list(s), 'DESC')[2] AS second_ FROM z GROUP BY vec_id)
SELECT vec_id, round(CASE WHEN len > 15 AND second_ < 6 THEN 14.9 ELSE len END, 6) score FROM n""")
def euclid_outlier(spark, folder):
    rows = _vectors(spark, folder)
    model = vectors.fit_euclid(rows, "v")
    mean, sd = (F.array(*[F.lit(x) for x in values]) for values in (model.mean, model.sigma))
    scores = F.transform("v", lambda v, i: F.abs((v - mean[i]) / sd[i]) * 2)
    return rows.select("vec_id", F.round(vectors.euclid_outlier(scores, 15.0, 6.0), 6).alias("score"))


@query("correlation_matrix", ctes(CELLS) + """
SELECT CAST(p.c AS INT) a, CAST(q.c AS INT) b, round(CASE WHEN p.c = q.c THEN 1.0 ELSE corr(p.x, q.x) END, 6) corr
FROM l p JOIN l q ON p.vec_id = q.vec_id GROUP BY p.c, q.c""")
def correlation_matrix(spark, folder):
    return vectors.correlation_matrix(_vectors(spark, folder), "v").select("a", "b", rounded("corr"))


@query("skewness", """
WITH m AS (SELECT l_returnflag site, avg(l_extendedprice) m FROM lineitem GROUP BY ALL)
SELECT site, round(avg(pow(l_extendedprice - m, 3)) / pow(avg(pow(l_extendedprice - m, 2)), 1.5), 6) skewness
FROM lineitem JOIN m ON l_returnflag = site GROUP BY site""")
def skewness(spark, folder):
    rows = table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("site"), "l_extendedprice")
    return vectors.skewness(rows, ["site"], "l_extendedprice").select("site", rounded("skewness"))


@query("calinski_harabasz", """
WITH l AS (SELECT "label" k, CAST(unnest(embedding) AS DOUBLE) x, generate_subscripts(embedding, 1) d FROM embeddings)
, c AS (SELECT k, d, count(*) n, avg(x) m, coalesce(var_samp(x), 0) v FROM l GROUP BY ALL)
, a AS (SELECT d, avg(x) m FROM l GROUP BY d)
, t AS (SELECT sum(c.n * (c.m - a.m) * (c.m - a.m)) b, sum(c.n * c.v) w FROM c JOIN a USING (d))
, z AS (SELECT count(*) n, count(DISTINCT "label") k FROM embeddings)
SELECT z.n AS "rows", z.k AS clusters, round(b / w * (z.n - z.k) / (z.k - 1), 6) score FROM t, z""")
def calinski_harabasz(spark, folder):
    out = vectors.calinski_harabasz(table(spark, folder, "embeddings"), "label", "embedding")
    return out.select("rows", "clusters", rounded("score"))


# Forest ------------------------------------------------------------------------

PARAMS = forest.ForestParams(trees=50, max_samples=128, max_depth=7)


def _features(spark, folder):
    """All components as columns f0, f1, ...; their number comes from the table."""
    rows = table(spark, folder, "embeddings")
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    cols = [f"f{i}" for i in range(width)]
    return rows.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(cols)]), cols


# The draws are digests, so SQL can repeat the sample and grow the same trees.
_WIDTH = 64  # components of a vector of the test tables
_DIGEST = "md5(concat_ws(':', {}))"
_UNIT = "CAST(concat('0x', substr(md5(concat_ws(':', {})), 1, 13)) AS BIGINT) / 4503599627370496::DOUBLE"


def _sample_sql(params: forest.ForestParams) -> str:
    return f"""pool AS (
  SELECT vec_id, embedding FROM embeddings
  ORDER BY {_DIGEST.format(f"{params.seed}, vec_id")}, vec_id LIMIT {params.trees * int(params.max_samples)})
, drawn AS (
  SELECT tree, embedding, row_number() OVER (PARTITION BY tree ORDER BY {_DIGEST.format(f"{params.seed}, tree, vec_id")}, vec_id) - 1 pos
  FROM pool, range({params.trees}) t(tree) QUALIFY pos < {int(params.max_samples)})
, long AS (SELECT tree, pos, f, CAST(embedding[f + 1] AS DOUBLE) v FROM drawn, range({_WIDTH}) c(f))
, mixed AS (
  SELECT tree, f, v, row_number() OVER (PARTITION BY tree, f ORDER BY {_DIGEST.format(f"{params.seed}, tree, concat('f', f), pos")}, pos) - 1 pos
  FROM long)
, smp AS (
  SELECT tree, pos, f, CASE WHEN v > {params.clamp} THEN {params.clamp}::DOUBLE + ({_UNIT.format(f"{params.seed}, tree, pos, concat('f', f)")} - 0.5::DOUBLE)
         ELSE v END v FROM mixed)"""


@query("iforest_sample", "WITH " + _sample_sql(PARAMS) + " SELECT CAST(tree AS INT) tree, CAST(pos AS INT) pos, " + ", ".join(
    f"max(v) FILTER (f = {i}) f{i}" for i in range(_WIDTH)) + " FROM smp GROUP BY tree, pos")
def iforest_sample(spark, folder):
    rows, cols = _features(spark, folder)
    return forest.iforest_sample(rows, "vec_id", cols, PARAMS)


def _picked_sql(rows: str) -> str:
    """The open nodes of ``rows`` (tree, node, depth, x) with their feature and split."""
    seed = PARAMS.seed
    return f"""cells AS (
    SELECT tree, node, f, min(x[f + 1]) lo, max(x[f + 1]) hi FROM {rows}, range({_WIDTH}) c(f)
    WHERE depth < {PARAMS.max_depth} GROUP BY tree, node, f HAVING min(x[f + 1]) < max(x[f + 1]))
  , usable AS (SELECT tree, node, list(struct_pack(f := f, lo := lo, hi := hi) ORDER BY f) fs FROM cells GROUP BY tree, node)
  , picked AS (
    SELECT tree, node, p.f f, p.lo + {_UNIT.format(f"{seed}, tree, node, 'split'")} * (p.hi - p.lo) split FROM (
      SELECT tree, node, fs[1 + CAST(floor({_UNIT.format(f"{seed}, tree, node, 'feature'")} * len(fs)) AS BIGINT)] p FROM usable))"""


_GROWN = _sample_sql(PARAMS) + f"""
, vecs AS (SELECT tree, pos, list(v ORDER BY f) x FROM smp GROUP BY tree, pos)
, grown AS (
  SELECT tree, pos, x, 0 node, 0 depth FROM vecs
  UNION ALL
  SELECT tree, pos, x, below, depth + 1 FROM (
    WITH {_picked_sql('grown')}
    SELECT g.tree, g.pos, g.x, g.depth, CASE WHEN g.x[p.f + 1] < p.split THEN 2 * g.node + 1 ELSE 2 * g.node + 2 END below
    FROM grown g JOIN picked p ON p.tree = g.tree AND p.node = g.node))
, {_picked_sql('grown')}
, nodes AS (
  SELECT CAST(g.tree AS INT) tree, CAST(g.node AS INT) node, CAST(coalesce(any_value(f), -1) AS INT) f, any_value(split) split,
         CAST(CASE WHEN any_value(f) IS NULL THEN -1 ELSE 2 * g.node + 1 END AS INT) l,
         CAST(CASE WHEN any_value(f) IS NULL THEN -1 ELSE 2 * g.node + 2 END AS INT) r,
         CAST(count(*) AS INT) size, CAST(any_value(depth) AS INT) depth
  FROM grown g LEFT JOIN picked p ON p.tree = g.tree AND p.node = g.node GROUP BY g.tree, g.node)"""


@query("iforest_fit", "WITH RECURSIVE " + _GROWN + """
SELECT tree, node, f feature, split, l "left", r "right", size, depth FROM nodes""")
def iforest_fit(spark, folder):
    rows, cols = _features(spark, folder)
    return forest.iforest_fit(forest.iforest_sample(rows, "vec_id", cols, PARAMS), cols, PARAMS)


# A fixed forest: tree, node, feature, split, left, right, size, depth
NODES = [
    (0, 0, 40, 0.0, 1, 2, 64, 0), (0, 1, 63, 0.05, 3, 4, 30, 1), (0, 2, -1, None, -1, -1, 34, 1),
    (0, 3, -1, None, -1, -1, 29, 2), (0, 4, -1, None, -1, -1, 1, 2),
    (1, 0, 2, -0.02, 1, 2, 64, 0), (1, 1, -1, None, -1, -1, 2, 1), (1, 2, 3, 0.1, 3, 4, 62, 1),
    (1, 3, 0, 0.03, 5, 6, 60, 2), (1, 4, -1, None, -1, -1, 2, 2), (1, 5, -1, None, -1, -1, 50, 3),
    (1, 6, -1, None, -1, -1, 10, 3),
    (2, 0, 1, 0.12, 1, 2, 64, 0), (2, 1, 0, -0.1, 3, 4, 63, 1), (2, 2, -1, None, -1, -1, 1, 1),
    (2, 3, -1, None, -1, -1, 3, 2), (2, 4, -1, None, -1, -1, 60, 2),
]
_NODE_SQL = ", ".join(
    "(" + ", ".join("NULL" if v is None else f"{v}::DOUBLE" if isinstance(v, float) else str(v) for v in n) + ")"
    for n in NODES)
_C = "CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649::DOUBLE) - 2 * ({n} - 1) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
def _walk_sql(samples: int) -> str:
    """Scores of all rows of embeddings by a table ``nodes``."""
    return f"""walk AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) x, nodes.* FROM embeddings, nodes WHERE node = 0
   UNION ALL SELECT walk.vec_id, walk.x, n.* FROM walk JOIN nodes n ON n.tree = walk.tree
     AND n.node = CASE WHEN walk.x[walk.f + 1] < walk.split THEN walk.l ELSE walk.r END WHERE walk.f >= 0)
, leaf AS (SELECT vec_id, depth + {_C.format(n='size::DOUBLE')} p FROM walk WHERE f < 0)
, scored AS (SELECT vec_id, pow(2, -avg(CASE WHEN p <= 2 THEN 0 WHEN p <= 5 THEN p - 1 ELSE p END) / ({_C.format(n=f'{samples}::DOUBLE')})) score FROM leaf GROUP BY vec_id)"""


_SCORED = f"nodes(tree, node, f, split, l, r, size, depth) AS (VALUES {_NODE_SQL})\n, " + _walk_sql(64)


def _scored(spark, folder):
    nodes = spark.createDataFrame(NODES, forest.NODE_SCHEMA)
    rows, cols = _features(spark, folder)
    return forest.iforest_score(rows, nodes, cols, 64)


@query("iforest_score", "WITH RECURSIVE " + _SCORED + " SELECT vec_id, round(score, 6) score FROM scored")
def iforest_score(spark, folder):
    return _scored(spark, folder).select("vec_id", rounded("score"))


@query("iforest_detect", "WITH RECURSIVE " + _GROWN + "\n, " + _walk_sql(int(PARAMS.max_samples)) + """
, q AS (SELECT vec_id, round(score, 9) score FROM scored)
, o AS (SELECT score, row_number() OVER (ORDER BY score) r, count(*) OVER () n FROM q)
, c AS (SELECT min(score) cut FROM o WHERE r >= ceil((1.0::DOUBLE - 0.05::DOUBLE) * n))
SELECT vec_id, score, cut, CASE WHEN score > cut THEN 1 ELSE 0 END anomaly FROM q, c""")
def iforest_detect(spark, folder):
    """Sample, fit, score and cut on one table; scores are equal up to nine digits."""
    rows, cols = _features(spark, folder)
    nodes = keep_table(forest.iforest_fit(forest.iforest_sample(rows, "vec_id", cols, PARAMS), cols, PARAMS), "forest")
    scored = forest.iforest_score(rows, nodes, cols, int(PARAMS.max_samples))
    scored = keep_table(scored.select("vec_id", F.round("score", 9).alias("score")), "scores")
    return vectors.anomaly_cut(scored, "score", 0.05)


@query("anomaly_cut", """
WITH s AS (SELECT l_orderkey, l_linenumber, l_extendedprice * (1 + l_tax) score FROM lineitem)
, o AS (SELECT score, row_number() OVER (ORDER BY score) r, count(*) OVER () n FROM s)
, c AS (SELECT min(score) cut FROM o WHERE r >= ceil((1.0::DOUBLE - 0.1::DOUBLE) * n))
SELECT l_orderkey, l_linenumber, round(cut, 4) cut, CASE WHEN score > cut THEN 1 ELSE 0 END anomaly FROM s, c""")
def anomaly_cut(spark, folder):
    rows = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice * (1D + l_tax) score")
    return vectors.anomaly_cut(rows, "score", 0.1).select("l_orderkey", "l_linenumber", rounded("cut", 4), "anomaly")
