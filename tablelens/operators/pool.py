"""Candidate pool gates (M0) and per-profile model settings.

Membership and settings are column expressions over profile rows, so a job
can decide the pools of many datasets at once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Candidate names in their fixed order (the dedup/alphabetical ordering is applied afterwards).
CANDIDATES = [
    "DummyMostFrequent", "LogisticRegression", "RandomForest", "ExtraTrees", "GradientBoosting",
    "LinearSVC", "KNN", "SVC_RBF", "SVC_LinearProb",
]


def candidate_pool(rows: Column, feature_count: Column, dominant: Column, high_dim: Column, hc_count: Column,
                   num_classes: Column, bucket: Column, flags: Column) -> Column:
    """M0: names admitted by the gates, in alphabetical order (the no-history candidate order)."""
    cols = F.greatest(feature_count, F.lit(1))
    hc = hc_count > 0
    boosting = flags["include_boosting"] & flags["include_gradient_boosting"]
    members = [
        (F.lit(True), "DummyMostFrequent"),
        (F.lit(True), "LogisticRegression"),
        (F.lit(True), "RandomForest"),
        (flags["include_extra_trees"] | high_dim, "ExtraTrees"),
        (boosting & (rows >= 200) & (dominant != "categorical"), "GradientBoosting"),
        (high_dim | (dominant == "numeric") | bucket.isin("tiny", "small"), "LinearSVC"),
        ((rows <= 6000) & (cols <= 40) & (dominant == "numeric") & ~high_dim, "KNN"),
        (flags["include_kernel_model"] & (rows <= 8000) & (cols <= 80) & ~hc
         & (F.coalesce(num_classes, F.lit(0)) <= 5), "SVC_RBF"),
        (flags["expand_model_diversity"] & (dominant != "categorical") & (rows <= 12000) & (cols <= 100),
         "SVC_LinearProb"),
    ]
    return F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in members])))


def model_settings(rows: int, prefer_simple: bool) -> dict:
    """Per-profile sizes for the pool (forest/boosting sizes, depths, leaf sizes, neighbours)."""
    return {
        "forest_trees": 250 if rows >= 10000 else 350,
        "forest_max_depth": 8 if prefer_simple else None,
        "forest_min_leaf": 2 if rows < 1000 else 1,
        "full_sample_trees": 300 if rows >= 5000 else 400,
        "full_sample_max_depth": 10 if prefer_simple else None,
        "gbt_step": 0.05 if prefer_simple else 0.1,
        "gbt_rounds": 100 if rows >= 10000 else 150,
        "gbt_depth": 2 if prefer_simple else 3,
        "svc_c": 0.5 if prefer_simple else 1.0,
        "knn_k": 7 if rows > 1000 else 5,
    }
