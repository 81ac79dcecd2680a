"""Profile rules as column expressions.

Every function takes Columns and returns a Column, so the same rule runs over a
computed profile, over many segment profiles, or over stored profile rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablelens.functions.columns import floor_int, ordered_labels, pyround

# Fixed values that must equal the reference's: note sentences, in rule order.
NOTE_TINY = "Tiny dataset: prefer simpler models and cross-validation-aware decisions."
NOTE_SMALL = "Small dataset: use cross-validation to reduce single-split noise."
NOTE_HIGH_DIM = "High-dimensional feature space detected: reduce overfitting risk and prefer robust ranking."
NOTE_HIGH_CARD = "High-cardinality categorical features detected: group rare categories before encoding."
NOTE_MISSING = "Substantial missingness detected: compare default imputation against dropping the worst columns."
NOTE_TARGET_LOW = "Automatic target inference is uncertain and should be justified in the demo."
NOTE_IMBALANCE = "Class imbalance detected: rank candidates using balanced accuracy and macro F1."
NOTE_MINORITY = "Minority class is small: prefer CV-aware selection and avoid over-trusting a single split."
NOTE_NOT_CLASSIFICATION = "This template is classification-focused; non-classification targets may need extra work."
NOTE_WEAK_SIGNAL = "Potential weak-signal scenario: use cautious interpretation and stronger baselines."

# Strategy flag names in their fixed order (12 booleans, then replan_count).
FLAG_NAMES = [
    "use_class_weight",
    "group_rare_categories",
    "enable_cv",
    "compare_on_cv",
    "prefer_simple_models",
    "expand_model_diversity",
    "include_kernel_model",
    "include_boosting",
    "include_extra_trees",
    "include_gradient_boosting",
    "tune_decision_threshold",
    "drop_high_missing_features",
]


def size_bucket(rows: Column) -> Column:
    return (
        F.when(rows < 300, "tiny").when(rows < 3000, "small").when(rows < 30000, "medium").otherwise("large")
    )


def missing_severity(overall: Column, max_missing: Column) -> Column:
    return (
        F.when((overall >= 25) | (max_missing >= 60), "severe")
        .when((overall >= 10) | (max_missing >= 35), "high")
        .when((overall >= 3) | (max_missing >= 15), "medium")
        .otherwise("low")
    )


def dominant_type(numeric_ratio: Column, categorical_ratio: Column) -> Column:
    return F.when(numeric_ratio > 0.7, "numeric").when(categorical_ratio > 0.7, "categorical").otherwise("mixed")


def high_card_cutoff(rows: Column) -> Column:
    """A categorical feature is high-cardinality above min(50, max(20, int(0.1*max(rows,1))))."""
    return F.least(F.lit(50), F.greatest(F.lit(20), floor_int(F.greatest(rows, F.lit(1)) * 0.1)))


def high_dimensional(feature_count: Column, rows: Column) -> Column:
    r = F.greatest(rows, F.lit(1))
    return (feature_count > F.greatest(F.lit(80), floor_int(F.sqrt(r) * 6))) | (feature_count > rows)


def feature_to_row_ratio(feature_count: Column, rows: Column) -> Column:
    return pyround(feature_count / F.greatest(rows, F.lit(1)), 4)


def is_severe(severity: Column) -> Column:
    return severity.isin("high", "severe")


def weak_signal_risk(rows: Column, feature_count: Column, severity: Column, hc_count: Column, confidence: Column) -> Column:
    few_rows_wide = (rows < 500) & (feature_count > F.greatest(F.floor(rows / 5), F.lit(10)))
    return few_rows_wide | (is_severe(severity) & (hc_count > 0)) | (confidence == "low")


def profile_notes(
    bucket: Column,
    high_dim: Column,
    hc_count: Column,
    severity: Column,
    confidence: Column,
    is_classification: Column,
    imbalance_raw: Column,
    minority: Column,
    weak: Column,
) -> Column:
    """Array of note sentences in the fixed rule order."""
    return ordered_labels(
        [
            (bucket == "tiny", NOTE_TINY),
            (bucket == "small", NOTE_SMALL),
            (high_dim, NOTE_HIGH_DIM),
            (hc_count > 0, NOTE_HIGH_CARD),
            (is_severe(severity), NOTE_MISSING),
            (confidence == "low", NOTE_TARGET_LOW),
            (is_classification & (imbalance_raw >= 3.0), NOTE_IMBALANCE),
            (is_classification & (minority < 20), NOTE_MINORITY),
            (~is_classification, NOTE_NOT_CLASSIFICATION),
            (weak, NOTE_WEAK_SIGNAL),
        ]
    )


def strategy_flags(
    imbalance: Column,
    num_classes: Column,
    bucket: Column,
    hc_count: Column,
    dominant: Column,
    max_missing: Column,
    minority: Column,
) -> Column:
    """Default strategy flags (struct of 12 booleans + replan_count)."""
    imb = F.coalesce(imbalance, F.lit(1.0))
    smallest = F.coalesce(minority, F.lit(0))
    high_card = hc_count > 0
    small_data = bucket.isin("tiny", "small")
    not_categorical = dominant != "categorical"
    boosting = not_categorical & (bucket != "large")
    return F.struct(
        (imb >= 3.0).alias("use_class_weight"),
        high_card.alias("group_rare_categories"),
        (small_data | (smallest < 25)).alias("enable_cv"),
        ((bucket == "tiny") | (smallest < 15)).alias("compare_on_cv"),
        (bucket == "tiny").alias("prefer_simple_models"),
        F.lit(False).alias("expand_model_diversity"),
        (small_data & not_categorical & ~high_card).alias("include_kernel_model"),
        boosting.alias("include_boosting"),
        F.lit(True).alias("include_extra_trees"),
        boosting.alias("include_gradient_boosting"),
        ((F.coalesce(num_classes, F.lit(0)) == 2) & (imb >= 4.0)).alias("tune_decision_threshold"),
        (max_missing >= 40.0).alias("drop_high_missing_features"),
        F.lit(0).alias("replan_count"),
    )


def facts_rules(df, confidence_col: str = "target_confidence"):
    """Apply G4/G9/G10/G12-G15 to a table of profile facts (e.g. F5 rows).

    Needs columns n_rows, feature_count, numeric_ratio, categorical_ratio,
    overall_missing, max_missing, high_cardinality_count, num_classes,
    imbalance_ratio, minority_class_count, target_confidence, is_classification.
    """
    rows, fc = F.col("n_rows"), F.col("feature_count")
    out = (
        df.withColumn("size_bucket", size_bucket(rows))
        .withColumn("missing_severity", missing_severity(F.col("overall_missing"), F.col("max_missing")))
        .withColumn("dominant_feature_type", dominant_type(F.col("numeric_ratio"), F.col("categorical_ratio")))
        .withColumn("high_dimensional", high_dimensional(fc, rows))
    )
    minority = F.when(F.col("is_classification"), F.col("minority_class_count")).otherwise(F.lit(0))
    imbalance = F.when(F.col("is_classification"), F.col("imbalance_ratio"))
    out = out.withColumn(
        "weak_signal_risk",
        weak_signal_risk(rows, fc, F.col("missing_severity"), F.col("high_cardinality_count"), F.col(confidence_col)),
    )
    out = out.withColumn(
        "notes",
        profile_notes(
            F.col("size_bucket"),
            F.col("high_dimensional"),
            F.col("high_cardinality_count"),
            F.col("missing_severity"),
            F.col(confidence_col),
            F.col("is_classification"),
            imbalance,
            minority,
            F.col("weak_signal_risk"),
        ),
    )
    return out.withColumn(
        "strategy_flags",
        strategy_flags(
            imbalance,
            F.when(F.col("is_classification"), F.col("num_classes")).otherwise(F.lit(0)),
            F.col("size_bucket"),
            F.col("high_cardinality_count"),
            F.col("dominant_feature_type"),
            F.col("max_missing"),
            minority,
        ),
    )
