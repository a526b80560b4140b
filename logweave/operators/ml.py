"""Streaming k-means and streaming linear regression, one micro-batch at a time
(ML1-ML4), plus the z-score scaling the regression needs.

The distributed work per batch is one aggregate over the batch: per-cluster
counts and coordinate sums for k-means, five sums for 1-feature least squares.
The driver only ever holds the model (k centers, or a weight and an intercept),
whose size is fixed by parameters, never by data.  Scoring is a column
expression with the model inlined as literals, so no join is needed.

Update rules follow Spark MLlib's public ``StreamingKMeans`` and
``StreamingLinearRegressionWithSGD`` semantics.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: reference / library defaults ----------------------------------------------
KMEANS_K = 5
KMEANS_DECAY = 1.0
SGD_STEP = 0.1
SGD_ITERATIONS = 50
SGD_CONVERGENCE_TOL = 0.001
# --- end of fixed values ----------------------------------------------------------------------


# ----------------------------------------------------------------------------- k-means
@dataclass
class KMeansModel:
    centers: np.ndarray                     # k x dim
    weights: np.ndarray                     # k
    decay: float = KMEANS_DECAY

    @classmethod
    def random(cls, k: int, dim: int, weight: float = 0.0, seed: int = 42, decay: float = KMEANS_DECAY):
        rng = np.random.default_rng(seed)
        return cls(rng.standard_normal((k, dim)), np.full(k, float(weight)), decay)

    @classmethod
    def from_rows(cls, df: DataFrame, features: str, order: str, k: int = KMEANS_K, weight: float = 0.0,
                  decay: float = KMEANS_DECAY):
        """Initial centers: the first ``k`` rows in ``order`` (k rows reach the driver)."""
        rows = df.orderBy(order).select(features).limit(k).collect()
        return cls(np.array([[float(x) for x in r[0]] for r in rows]), np.full(len(rows), float(weight)), decay)


def _double_literal(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)" if not np.isfinite(x) else f"({float(x)!r}D)"


def squared_distance(features: str, center: np.ndarray) -> Column:
    """Squared Euclidean distance of array column ``features`` to a literal center.

    The sum of ``(x[j] - c_j) * (x[j] - c_j)`` over element lookups, written as one SQL
    expression (one parser call instead of thousands of Column objects) and compiled with
    the stage."""
    col = "`" + features.replace("`", "``") + "`"
    terms = []
    for j, x in enumerate(center):
        d = f"(CAST({col}[{j}] AS DOUBLE) - {_double_literal(x)})"
        terms.append(f"{d} * {d}")
    return F.expr(" + ".join(terms))


def kmeans_predict(df: DataFrame, model: KMeansModel, features: str = "features", out: str = "cluster") -> DataFrame:
    """ML2: add the nearest cluster id (ties: lowest id); other columns, e.g. a known label,
    are carried.

    The k distances are columns of one projection and the argmin (``least`` + ``CASE``)
    reads them in the next, so each distance is computed once inside compiled code."""
    centers = model.centers
    names = [f"_d{i}" for i in range(len(centers))]
    dist = df.select("*", *[squared_distance(features, c).alias(n) for n, c in zip(names, centers)])
    m = F.least(*[F.col(n) for n in names])
    arg = None
    for i, n in enumerate(names):
        arg = F.when(F.col(n) == m, F.lit(i)) if arg is None else arg.when(F.col(n) == m, F.lit(i))
    return dist.withColumn(out, arg).drop(*names)


def label_cluster_counts(predicted: DataFrame, label: str = "label", cluster: str = "cluster") -> DataFrame:
    """ML2 check: how the known labels spread over the predicted clusters."""
    return predicted.groupBy(label, cluster).agg(F.count(F.lit(1)).alias("count"))


def kmeans_update(model: KMeansModel, batch: DataFrame, features: str = "features") -> KMeansModel:
    """ML1: one streaming k-means step over ``batch``.

    One partial aggregate gives per-cluster count and coordinate sums; then
    ``c' = (c * n * a + sum) / (n * a + m)``, ``n' = n * a + m``; a dying cluster
    (weight < 1e-8 of the largest) takes half of the largest cluster.
    """
    dim = model.centers.shape[1]
    assigned = kmeans_predict(batch.select(features), model, features, "_c")
    agg = assigned.groupBy("_c").agg(F.count(F.lit(1)).alias("m"),
                                     *[F.sum(F.col(features)[j].cast("double")).alias(f"s{j}") for j in range(dim)])
    stats = agg.collect()                   # at most k rows
    centers, weights = model.centers.copy(), model.weights * model.decay
    for r in stats:
        i, m = r["_c"], r["m"]
        s = np.array([r[f"s{j}"] for j in range(dim)], dtype=float)
        upd = weights[i] + m
        lam = m / max(upd, 1e-16)
        weights[i] = upd
        centers[i] = (1.0 - lam) * centers[i] + (lam / m) * s
    hi, lo = int(np.argmax(weights)), int(np.argmin(weights))
    if weights[lo] < 1e-8 * weights[hi]:
        w = (weights[hi] + weights[lo]) / 2.0
        weights[hi] = weights[lo] = w
        x = centers[hi].copy()
        p = 1e-14 * np.maximum(np.abs(x), 1.0)
        centers[hi], centers[lo] = x + p, x - p
    return KMeansModel(centers, weights, model.decay)


def kmeans_model_frame(spark, model: KMeansModel, digits: int = 6) -> DataFrame:
    rows = [(i, float(model.weights[i]), [round(float(x), digits) for x in model.centers[i]])
            for i in range(len(model.weights))]
    return spark.createDataFrame(rows, "cluster int, weight double, center array<double>")


# ----------------------------------------------------------------------------- scaling
def zscore(df: DataFrame, cols, suffix: str = "_z") -> DataFrame:
    """(x - mean) / stddev per column.  One aggregate pass computes every statistic; the
    2 x len(cols) numbers are inlined as literals (their count is fixed by ``cols``)."""
    r = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
               *[F.stddev(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = df
    for i, c in enumerate(cols):
        out = out.withColumn(c + suffix, (F.col(c) - F.lit(r[f"m{i}"])) / F.lit(r[f"s{i}"]))
    return out


# ----------------------------------------------------------------------------- regression
@dataclass
class LinearModel:
    weight: float = 0.0
    intercept: float = 0.0
    iterations: int = 0
    history: list = field(default_factory=list)


def least_squares_sums(df: DataFrame, label: str, feature: str) -> dict:
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(feature).alias("sx"), F.sum(label).alias("sy"),
               F.sum(F.col(feature) * F.col(feature)).alias("sxx"),
               F.sum(F.col(feature) * F.col(label)).alias("sxy")).first()
    return r.asDict()


def sgd_fit(sums: dict, weight: float = 0.0, step: float = SGD_STEP, iterations: int = SGD_ITERATIONS,
            tol: float = SGD_CONVERGENCE_TOL) -> LinearModel:
    """Full-batch gradient descent for y ~ w*x + b from the five batch sums.

    As in MLlib's SGD with an intercept: the bias weight starts at 1.0 for every
    batch (only the feature weight carries over), the step at iteration i is
    ``step / sqrt(i)``, and it stops once two consecutive iterates differ by less
    than ``tol * max(|w|, 1)``.
    """
    n = sums["n"]
    if not n:
        return LinearModel(weight, 1.0, 0)
    sx, sy, sxx, sxy = sums["sx"], sums["sy"], sums["sxx"], sums["sxy"]
    w, b = float(weight), 1.0
    prev = None
    i = 0
    for i in range(1, iterations + 1):
        gw = (w * sxx + b * sx - sxy) / n
        gb = (w * sx + b * n - sy) / n
        s = step / math.sqrt(i)
        w, b = w - s * gw, b - s * gb
        if prev is not None:
            diff = math.hypot(w - prev[0], b - prev[1])
            if diff < tol * max(math.hypot(w, b), 1.0):
                break
        prev = (w, b)
    return LinearModel(w, b, i)


def linreg_update(model: LinearModel, batch: DataFrame, label: str = "label", feature: str = "x") -> LinearModel:
    """ML3: train on one batch, starting from the model's weight."""
    return sgd_fit(least_squares_sums(batch, label, feature), model.weight)


def linreg_predict(df: DataFrame, model: LinearModel, feature: str = "x", out: str = "prediction") -> DataFrame:
    """ML4: ``intercept + weight * x`` as a column; other columns (the known label) carried."""
    return df.withColumn(out, F.lit(model.intercept) + F.lit(model.weight) * F.col(feature))


def rmse(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """ML4 check: root mean squared error of the predictions (one aggregate)."""
    d = F.col(prediction) - F.col(label)
    return predicted.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.count(F.lit(1)).alias("n"))
