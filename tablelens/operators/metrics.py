"""Scores, thresholds and classification metrics.

Every metric comes from confusion counts ``(group..., label, prediction, n)``:
the raw prediction table is aggregated once (partial aggregation before the
shuffle), and all later steps work on at most ``groups x classes^2`` rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelens.functions.columns import r6

# The 13 candidate thresholds, as the reference builds them (evenly spaced 0.20..0.80).
THRESHOLDS = [float(x) for x in np.linspace(0.2, 0.8, 13)]


def sigmoid(raw: Column) -> Column:
    """K1: logistic of a raw margin."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-raw))


def apply_threshold(score: Column, threshold: Column | float) -> Column:
    """K2: 1 when score >= threshold."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= t).cast("int")


def threshold_sweep(df: DataFrame, label: str, score: str, group_cols=(), thresholds=None) -> DataFrame:
    """K3: balanced accuracy of ``score >= t`` for each threshold (binary labels 0/1).

    One pass: per (group, label) the count and, for every threshold, how many
    rows score at or above it; no join with the threshold grid.
    """
    thresholds = THRESHOLDS if thresholds is None else thresholds
    per_class = df.filter(F.col(label).isNotNull()).groupBy(*group_cols, label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum((F.col(score) >= F.lit(t)).cast("long")).alias(f"p{i}") for i, t in enumerate(thresholds)],
    )
    positive = F.col(label).cast("double") == 1.0
    recalls = per_class.select(
        *group_cols,
        *[F.when(positive, F.col(f"p{i}") / F.col("n")).otherwise((F.col("n") - F.col(f"p{i}")) / F.col("n"))
          .alias(f"r{i}") for i in range(len(thresholds))],
    )
    bal = recalls.groupBy(*group_cols).agg(*[F.avg(f"r{i}").alias(f"b{i}") for i in range(len(thresholds))])
    entries = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"b{i}").alias("balanced_accuracy"))
                        for i, t in enumerate(thresholds)])
    return bal.select(*group_cols, F.explode(entries).alias("e")).select(*group_cols, "e.*")


def best_threshold(sweep: DataFrame, group_cols=()) -> DataFrame:
    """K3: highest balanced accuracy; the lowest threshold wins ties."""
    return sweep.groupBy(*group_cols).agg(
        F.max_by("threshold", F.struct("balanced_accuracy", (-F.col("threshold")).alias("neg_t"))).alias("threshold"),
        F.max("balanced_accuracy").alias("balanced_accuracy"),
    )


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction", group_cols=()) -> DataFrame:
    """K5: (group..., label, prediction, n)."""
    return df.groupBy(*group_cols, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_dense(cm: DataFrame, group_cols=()) -> DataFrame:
    """K5 dense: every (label, prediction) pair over the group's labels (true or predicted), 0 filled.

    Built from per-group arrays (at most classes^2 entries), not a self-join.
    """
    labels = cm.select(*group_cols, F.col("label").alias("c")).unionByName(
        cm.select(*group_cols, F.col("prediction").alias("c"))
    ).groupBy(*group_cols).agg(F.array_sort(F.collect_set("c")).alias("labels"))
    rows = cm.groupBy(*group_cols, "label").agg(
        F.map_from_entries(F.collect_list(F.struct("prediction", "n"))).alias("m")
    )
    joined = labels.select(*group_cols, "labels", F.explode("labels").alias("label")).join(
        rows, on=[*group_cols, "label"], how="left"
    )
    cells = F.transform("labels", lambda p: F.struct(p.alias("prediction"),
                                                     F.coalesce(F.col("m")[p], F.lit(0)).cast("long").alias("n")))
    return joined.select(*group_cols, "label", F.explode(cells).alias("e")).select(*group_cols, "label", "e.*")


def class_stats(cm: DataFrame, group_cols=()) -> DataFrame:
    """Per (group, class in y_true U y_pred): support, predicted, tp, precision, recall, f1."""
    entries = F.array(
        F.struct(F.col("label").alias("class_label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).cast("long").alias("tp")),
        F.struct(F.col("prediction").alias("class_label"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
    )
    long = cm.select(*group_cols, F.explode(entries).alias("e")).select(*group_cols, "e.*")
    agg = long.groupBy(*group_cols, "class_label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    out = agg.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.when((F.col("precision") + F.col("recall")) > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return out.withColumn("f1", f1)


def summary_metrics(cs: DataFrame, group_cols=()) -> DataFrame:
    """K6-K8: accuracy, balanced accuracy (classes present in y_true), macro precision/recall/F1."""
    return cs.groupBy(*group_cols).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.sum("support").alias("n"),
    )


def classification_report(cs: DataFrame, group_cols=()) -> DataFrame:
    """K9: per-class rows plus 'accuracy', 'macro avg', 'weighted avg' rows.

    Columns: group..., class_label, precision, recall, f1_score, support.
    """
    per_class = cs.select(*group_cols, "class_label", "precision", "recall", F.col("f1").alias("f1_score"),
                          F.col("support").cast("long").alias("support"))
    tot = cs.groupBy(*group_cols).agg(
        F.sum("support").alias("total"),
        (F.sum("tp") / F.sum("support")).alias("acc"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
    )
    rows = F.array(
        F.struct(F.lit("accuracy").alias("class_label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1_score")),
        F.struct(F.lit("macro avg").alias("class_label"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1_score")),
        F.struct(F.lit("weighted avg").alias("class_label"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1_score")),
    )
    summary = tot.select(*group_cols, F.col("total").cast("long").alias("support"), F.explode(rows).alias("e")).select(
        *group_cols, "e.class_label", "e.precision", "e.recall", "e.f1_score", "support"
    )
    return per_class.unionByName(summary)


def metrics_by_model(preds: DataFrame, group_cols=("run_id", "model"), split_col: str = "split",
                     label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Test metrics plus train balanced accuracy / macro F1 per (run, model)."""
    g = [*group_cols, split_col]
    cm = confusion_counts(preds, label, prediction, g)
    sm = summary_metrics(class_stats(cm, g), g)
    test = F.col(split_col) == "test"
    train = F.col(split_col) == "train"
    return sm.groupBy(*group_cols).agg(
        F.max(F.when(test, F.col("accuracy"))).alias("accuracy"),
        F.max(F.when(test, F.col("balanced_accuracy"))).alias("balanced_accuracy"),
        F.max(F.when(test, F.col("f1_macro"))).alias("f1_macro"),
        F.max(F.when(test, F.col("precision_macro"))).alias("precision_macro"),
        F.max(F.when(test, F.col("recall_macro"))).alias("recall_macro"),
        F.max(F.when(train, F.col("balanced_accuracy"))).alias("train_balanced_accuracy"),
        F.max(F.when(train, F.col("f1_macro"))).alias("train_f1_macro"),
    )


def cv_fold_metrics(preds: DataFrame, group_cols=("run_id", "model"), fold_col: str = "fold",
                    label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Balanced accuracy, macro F1 and accuracy per fold."""
    g = [*group_cols, fold_col]
    return summary_metrics(class_stats(confusion_counts(preds, label, prediction, g), g), g)


def cv_summary(folds: DataFrame, group_cols=("run_id", "model"), fold_col: str = "fold") -> DataFrame:
    """Mean and population std of fold balanced accuracy, mean F1/accuracy, scores in fold order."""
    return folds.groupBy(*group_cols).agg(
        F.avg("balanced_accuracy").alias("cv_balanced_accuracy_mean"),
        F.stddev_pop("balanced_accuracy").alias("cv_balanced_accuracy_std"),
        F.avg("f1_macro").alias("cv_f1_macro_mean"),
        F.avg("accuracy").alias("cv_accuracy_mean"),
        F.transform(F.array_sort(F.collect_list(F.struct(fold_col, "balanced_accuracy"))),
                    lambda s: s["balanced_accuracy"]).alias("cv_balanced_accuracy_scores"),
    )


def round_metrics(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals (for comparison with other engines)."""
    return df.select(*[r6(F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
                       for f in df.schema.fields])
