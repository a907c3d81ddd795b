"""Statistics and outlier scores over feature vectors.

A fit is an aggregation that returns a few numbers per component to the driver;
a score is an expression over each row's array. No width is written down.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _by_component(df: DataFrame, vector: str, *keep: Column) -> DataFrame:
    """One row per component: (kept columns, dim, x)."""
    return df.select(*keep, F.posexplode(vector).alias("dim", "_v")).select("*", F.col("_v").cast("double").alias("x"))


@dataclass(frozen=True)
class StandardModel:
    """Mean and deviation of each component of a vector."""

    mean: tuple[float, ...]
    sigma: tuple[float, ...]

    def score(self, vector: Column, reference_mode: bool = False) -> Column:
        """``min(3 - min((v - mean) / sigma, 3), 9)`` of each component, as an array.

        Reference mode divides every component by the first deviation.
        """
        mean = _literal(self.mean)
        sigma = _literal([self.sigma[0]] * len(self.sigma) if reference_mode else self.sigma)
        z = lambda v, i: F.least(F.try_divide(v - mean[i], sigma[i]), F.lit(3.0))
        return F.transform(vector, lambda v, i: F.least(3.0 - z(v.cast("double"), i), F.lit(9.0)))


def fit_weighted(df: DataFrame, vector: str, weight: str) -> StandardModel:
    """Weighted mean and unbiased weighted deviation of each component."""
    long = _by_component(df, vector, F.col(weight).cast("double").alias("w"))
    w, x = F.col("w"), F.col("x")
    sums = long.groupBy("dim").agg(
        F.sum(w).alias("w"), F.sum(w * w).alias("w2"), F.sum(w * x).alias("s")).orderBy("dim").collect()
    means = [r.s / r.w for r in sums]
    off = x - _literal(means)[F.col("dim")]
    dev = long.groupBy("dim").agg(F.sum(w * off * off).alias("d")).orderBy("dim").collect()
    return StandardModel(tuple(means), tuple(
        float(np.sqrt(d.d / (r.w - r.w2 / r.w))) for d, r in zip(dev, sums)))


def mean_of_scores(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda a, v: a + v) / F.size(vector)


@dataclass(frozen=True)
class Moments:
    mean: tuple[float, ...]
    sigma: tuple[float, ...]
    cov: np.ndarray


def _products(df: DataFrame, vector: str) -> tuple[list[float], int, DataFrame]:
    """Means, number of rows, and the centred product sums (i, j, s) with i <= j.

    A task multiplies its rows as one matrix and passes on one row per pair of
    components; the pairs are then summed.
    """
    per = _by_component(df, vector).groupBy("dim").agg(F.avg("x").alias("m"), F.count("x").alias("n")).orderBy("dim").collect()
    mean = np.array([r.m for r in per])

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(mean)))
        for batch in batches:
            if len(batch):
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) - mean
                total += x.T @ x
        i, j = np.triu_indices(len(mean))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "s"])

    rows = df.select(F.col(vector).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    pairs = rows.mapInArrow(gram, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    return mean.tolist(), per[0].n if per else 0, pairs


def fit_moments(df: DataFrame, vector: str) -> Moments:
    """Means, sample deviations and sample covariances; the vectors have one length and no nulls."""
    mean, rows, pairs = _products(df, vector)
    cov = np.zeros((len(mean), len(mean)))
    for r in pairs.collect():  # half the square of the width
        cov[r.i, r.j] = cov[r.j, r.i] = r.s / (rows - 1)
    return Moments(tuple(mean), tuple(float(v) for v in np.sqrt(np.diag(cov))), cov)


def squared_distance(model: Moments, vector: Column, offset: float = 0.0) -> Column:
    """Squared Mahalanobis distance to the mean plus ``offset`` deviations; null for a null vector.

    The form has as many terms as the width squared, so a batch of vectors is
    multiplied as one matrix.
    """
    at = np.array(model.mean) + offset * np.array(model.sigma)
    inverse = np.linalg.inv(model.cov)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            valid = batch.is_valid().to_numpy(zero_copy_only=False)
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(at)) - at
            out = np.zeros(len(batch))
            out[valid] = np.einsum("ij,ij->i", x @ inverse, x)
            yield pa.array(out, pa.float64(), mask=~valid)

    return run(vector.cast("array<double>"))


def mahalanobis(model: Moments, vector: Column) -> Column:
    """Distance to mean + 3 sigma, relative to the distance of mean + 2 sigma."""
    sigma = np.array(model.sigma)
    metric = float(sigma @ np.linalg.inv(model.cov) @ sigma)  # (mean + 2s) - (mean + 3s) = -s
    return F.sqrt(squared_distance(model, vector, 3.0) / metric)


def fit_euclid(df: DataFrame, vector: str) -> StandardModel:
    """Mean and sample deviation of each component, kept with the model."""
    stats = _by_component(df, vector).groupBy("dim").agg(
        F.avg("x").alias("m"), F.stddev_samp("x").alias("d")).orderBy("dim").collect()
    return StandardModel(tuple(r.m for r in stats), tuple(float(r.d) for r in stats))


def euclid_outlier(vector: Column, spam_threshold: float = 15.0, sigma_offset: float = 3.0) -> Column:
    """Length of the score vector; one single large score stays below the threshold."""
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, v: a + v * v))
    second = F.get(F.sort_array(vector, asc=False), F.lit(1))
    return F.when(
        (length > spam_threshold) & (second < sigma_offset), F.lit(spam_threshold - 0.1)).otherwise(length)


def correlation_matrix(df: DataFrame, vector: str) -> DataFrame:
    """Pearson correlations of components as (a, b, corr); NaN beside one without variance."""
    _, rows, pairs = _products(df, vector)
    own = pairs.filter("i = j").select(F.col("i").alias("_k"), (F.col("s") / (rows - 1)).alias("_var"))
    cells = pairs.join(own.withColumnsRenamed({"_k": "i", "_var": "_vi"}), "i").join(
        own.withColumnsRenamed({"_k": "j", "_var": "_vj"}), "j")
    flat = (F.col("_vi") <= 1e-12) | (F.col("_vj") <= 1e-12)
    corr = F.when(F.col("i") == F.col("j"), F.lit(1.0)).when(flat, F.lit(float("nan"))).otherwise(
        F.col("s") / (rows - 1) / F.sqrt(F.col("_vi") * F.col("_vj")))
    half = cells.select(F.col("i").alias("a"), F.col("j").alias("b"), corr.alias("corr"))
    return half.union(half.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "corr"))


def skewness(df: DataFrame, dims: Sequence[str], col: str) -> DataFrame:
    """Population skewness per group."""
    return df.groupBy(*dims).agg(F.skewness(col).alias("skewness"))


def calinski_harabasz(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Between over within scatter of labelled vectors, in one row.

    The within part of a cluster is its size times the trace of its sample
    covariance; a single-row cluster adds nothing there.
    """
    long = df.select(label, F.posexplode(vector).alias("_dim", "_x"))
    x = F.col("_x").cast("double")
    cells = long.groupBy(label, "_dim").agg(
        F.count(F.lit(1)).alias("_n"), F.avg(x).alias("_mean"), F.coalesce(F.var_samp(x), F.lit(0.0)).alias("_var"))
    dim = Window.partitionBy("_dim")
    centre = F.sum(F.col("_n") * F.col("_mean")).over(dim) / F.sum("_n").over(dim)
    per_dim = cells.withColumn("_c", centre).groupBy("_dim").agg(
        F.sum(F.col("_n") * (F.col("_mean") - F.col("_c")) * (F.col("_mean") - F.col("_c"))).alias("_between"),
        F.sum(F.col("_n") * F.col("_var")).alias("_within"),
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("clusters"))
    total = per_dim.agg(
        F.sum("_between").alias("_b"), F.sum("_within").alias("_w"),
        F.max("rows").alias("rows"), F.max("clusters").alias("clusters"))
    score = F.try_divide(F.col("_b"), F.col("_w")) * F.try_divide(
        F.col("rows") - F.col("clusters"), F.col("clusters") - 1)
    return total.select("rows", "clusters", score.alias("score"))


FEW = 2000  # values that are sorted in one step
RANK_ERROR = 0.001


def exact_quantile(df: DataFrame, col: str, q: float) -> float:
    """Smallest value with at least ``ceil(q * rows)`` rows at or below it.

    Nulls and NaN are no values and have no rank; infinities are the ends of the
    order. Quantile summaries fence the wanted rank between two values, and one
    aggregation counts what lies below, on and between them, so each pass keeps
    less than a hundredth of the values, whatever their distribution. The last
    few end in one more aggregation; only counts and two values reach the driver.
    """
    v = F.col(col).cast("double")
    data = df.select(v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    rows = data.count()
    if not rows:
        raise ValueError("no values")
    rank = max(1, int(np.ceil(q * rows)))
    while rows > FEW:
        ends = [max(0.0, (rank - 1) / rows - 2 * RANK_ERROR), min(1.0, rank / rows + 2 * RANK_ERROR)]
        low, high = data.approxQuantile("_v", ends, RANK_ERROR)
        x = F.col("_v")
        below, at_low, between = data.agg(*[F.count_if(c) for c in (x < low, x == low, (x > low) & (x < high))]).first()
        rank -= below + at_low
        if rank <= 0:
            return low
        if rank > between:
            return high
        data, rows = data.filter((x > low) & (x < high)), between
    return data.orderBy("_v").limit(rank).agg(F.max("_v")).first()[0]


def anomaly_cut(df: DataFrame, col: str, contamination: float) -> DataFrame:
    """Rows with the score cut at 1 - contamination, and whether they lie above it.

    A null or NaN score has no rank and is no anomaly.
    """
    cut = exact_quantile(df, col, 1.0 - contamination)
    above = F.coalesce((F.col(col) > cut) & ~F.isnan(col), F.lit(False))
    return df.select("*", F.lit(cut).alias("cut"), above.cast("int").alias("anomaly"))
