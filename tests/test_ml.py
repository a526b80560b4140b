"""ML1-ML4 against direct NumPy computations."""

import math

import numpy as np

from logweave.operators import ml


def test_kmeans_update_matches_numpy(spark):
    rng = np.random.default_rng(0)
    pts = rng.normal(size=(200, 3))
    df = spark.createDataFrame([(p.tolist(),) for p in pts], "features array<double>")
    model = ml.KMeansModel(pts[:4].copy(), np.array([0.0, 2.0, 0.0, 1.0]), decay=0.5)
    new = ml.kmeans_update(model, df)
    assign = np.argmin(((pts[:, None, :] - model.centers[None]) ** 2).sum(-1), axis=1)
    for i in range(4):
        m = (assign == i).sum()
        n = model.weights[i] * 0.5
        exp = (model.centers[i] * n + pts[assign == i].sum(0)) / (n + m)
        assert np.allclose(new.centers[i], exp) and math.isclose(new.weights[i], n + m)
    pred = ml.kmeans_predict(df, model).select("cluster").collect()
    assert [r[0] for r in pred] == assign.tolist()


def test_dying_cluster_split(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([0.1, 0.0],)], "features array<double>")
    model = ml.KMeansModel(np.array([[0.0, 0.0], [100.0, 100.0]]), np.zeros(2))
    new = ml.kmeans_update(model, df)
    assert new.weights[0] == new.weights[1] == 1.0
    assert np.allclose(new.centers[0], new.centers[1], atol=1e-12)


def test_sgd_matches_loop(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, 500)
    y = -0.7 * x + 0.2 + rng.normal(scale=0.05, size=500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, label double")
    m = ml.linreg_update(ml.LinearModel(), df)
    w, b, prev = 0.0, 1.0, None
    for i in range(1, 51):
        g = (w * x + b - y)
        w, b = w - 0.1 / math.sqrt(i) * (g * x).mean(), b - 0.1 / math.sqrt(i) * g.mean()
        if prev is not None and math.hypot(w - prev[0], b - prev[1]) < 0.001 * max(math.hypot(w, b), 1):
            break
        prev = (w, b)
    assert math.isclose(m.weight, w, rel_tol=1e-9) and math.isclose(m.intercept, b, rel_tol=1e-9)
    pred = ml.linreg_predict(df, m).select("prediction").first()[0]
    assert math.isclose(pred, m.intercept + m.weight * x[0], rel_tol=1e-9)
