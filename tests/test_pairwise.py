"""Coupled class probabilities against the minimum found step by step, and on fitted classes."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tablelens.operators import models
from tablelens.operators.models import couple, fit_platt, fit_predict, make_estimator


def _least(r):
    """The same objective by projected gradient steps in plain Python, one row."""
    k = len(r)
    q = [[sum(r[s][i] ** 2 for s in range(k) if s != i) if i == j else -r[j][i] * r[i][j] for j in range(k)] for i in range(k)]
    p = np.full(k, 1.0 / k)
    q = np.array(q)
    for _ in range(20_000):
        g = q @ p
        p = np.clip(p - 0.2 * (g - g.mean()), 0.0, None)
        p /= p.sum()
    return p


@pytest.mark.parametrize("k", [3, 4, 5])
def test_couple_is_the_minimum(k):
    rng = np.random.default_rng(k)
    r = np.full((6, k, k), 0.5)
    for i in range(k):
        for j in range(i + 1, k):
            r[:, i, j] = rng.uniform(0.05, 0.95, 6)
            r[:, j, i] = 1.0 - r[:, i, j]
    p = couple(r)
    assert np.allclose(p.sum(axis=1), 1.0) and (p >= 0).all()
    assert np.allclose(p[0], _least(r[0].tolist()), atol=1e-4)
    # pairwise values that come from one distribution give it back
    true = rng.dirichlet(np.ones(k), 6)
    both = true[:, :, None] / (true[:, :, None] + true[:, None, :])
    assert np.allclose(couple(both), true, atol=1e-5)


def _data(spark, n, classes, spread):
    rng = np.random.default_rng(7)
    y = np.arange(n) % classes
    at = np.array([[np.cos(2 * np.pi * c / classes), np.sin(2 * np.pi * c / classes)] for c in range(classes)])[y]
    x = at + rng.normal(0, spread, (n, 2))
    df = spark.createDataFrame([(i, float(c), [float(a), float(b)]) for i, (c, (a, b)) in enumerate(zip(y, x, strict=True))], "key long, label_idx double, v array<double>")
    return df.select("key", "label_idx", array_to_vector("v").alias("features")).persist()


def test_probabilities_of_three_overlapping_classes(spark, monkeypatch):
    monkeypatch.setattr(models, "SVC_MAX_ITER", 15)
    df = _data(spark, 800, 3, 0.6)
    train, test = df.filter("key < 600").coalesce(1).persist(), df.filter("key >= 600")
    got = fit_predict("SVC_LinearProb", train, test, {"svc_c": 1.0}, 4, "key", None, probabilities=True).select("label_idx", "prediction", vector_to_array("probability").alias("p")).collect()
    p, y = np.array([r["p"] for r in got]), np.array([int(r["label_idx"]) for r in got])
    assert p.shape == (200, 4) and np.allclose(p.sum(axis=1), 1.0) and (p[:, 3] == 0).all()  # class 3 has no rows
    right = p[np.arange(200), y]
    assert 0.7 < np.mean([r["prediction"] == r["label_idx"] for r in got]) and 0.5 < right.mean() < 0.95
    sure = p.max(axis=1) > 0.9
    assert (p.argmax(axis=1) == y)[sure].mean() > 0.85  # calibrated


def test_platt_margins_of_a_class_held_out_whole(spark, monkeypatch):
    monkeypatch.setattr(models, "SVC_MAX_ITER", 15)
    df = _data(spark, 60, 2, 0.1).coalesce(1).persist()
    one = df.filter("label_idx = 0").unionByName(df.filter("label_idx = 1").limit(1))  # its fold leaves one class to the others
    platt = fit_platt(make_estimator("SVC_LinearProb", {"svc_c": 1.0}, 2, None, 31.0), one, "key")
    assert np.isfinite(platt.intercept) and np.isfinite(platt.coefficients[0])
