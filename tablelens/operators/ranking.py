"""Leaderboards and selection rationale over a metrics table.

Input metrics rows carry (run keys..., model, accuracy, balanced_accuracy,
f1_macro, cv_balanced_accuracy_mean, ...); run context rows carry
(run key, imbalance_ratio, compare_on_cv).  Windows partition by run, so each
holds only that run's candidate models.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: rationale sentences.
SUMMARY_CV = "Selected using cross-validation-aware ranking to prioritise stability."
SUMMARY_HOLDOUT = "Selected mainly from holdout performance, with CV used as supporting evidence."
# The sentences of the run report's rationale.
REPORT_CV = (
    "Model selected using cross-validation-aware ranking to prefer stability "
    "over a single holdout split."
)
REPORT_HOLDOUT = "Model selected mainly from holdout performance, with CV used as supporting evidence."


def primary_metric(imbalance_ratio: Column) -> Column:
    """Balanced accuracy when imbalance >= 2.5, else accuracy."""
    return F.when(F.coalesce(imbalance_ratio, F.lit(1.0)) >= 2.5, "balanced_accuracy").otherwise("accuracy")


def _primary_value() -> Column:
    return F.when(F.col("primary_metric") == "balanced_accuracy", F.col("balanced_accuracy")).otherwise(
        F.col("accuracy")
    )


def leaderboard(metrics: DataFrame, context: DataFrame, run_cols=("run_id", "attempt"), on=("run_id",),
                candidate_order: Column | None = None) -> DataFrame:
    """R2: rank models per run.

    Keys, all descending: (cv, primary, F1) when compare_on_cv and the model has
    a CV mean, else (primary, F1, cv or -1); ties keep the candidate order
    (alphabetical without history, see ``order_candidates``).
    """
    m = metrics.join(context, on=list(on), how="left")
    m = m.withColumn("primary_metric", primary_metric(F.col("imbalance_ratio")))
    cv = F.col("cv_balanced_accuracy_mean")
    use_cv = F.coalesce(F.col("compare_on_cv"), F.lit(False)) & cv.isNotNull()
    prim = _primary_value()
    m = (
        m.withColumn("primary_value", prim)
        .withColumn("_k1", F.when(use_cv, cv).otherwise(prim))
        .withColumn("_k2", F.when(use_cv, prim).otherwise(F.col("f1_macro")))
        .withColumn("_k3", F.when(use_cv, F.col("f1_macro")).otherwise(F.coalesce(cv, F.lit(-1.0))))
        .withColumn("_cand", candidate_order if candidate_order is not None else F.col("model"))
    )
    w = Window.partitionBy(*run_cols).orderBy(F.col("_k1").desc(), F.col("_k2").desc(), F.col("_k3").desc(),
                                              F.col("_cand"))
    # later sorts are stable over the leaderboard order, so their ties fall back to rank
    w2 = Window.partitionBy(*run_cols).orderBy(prim.desc(), F.col("f1_macro").desc(), F.col("rank"))
    w3 = Window.partitionBy(*run_cols).orderBy(F.col("balanced_accuracy").desc(), F.col("f1_macro").desc(),
                                               F.col("rank"))
    return (
        m.withColumn("rank", F.row_number().over(w).cast("long"))
        .withColumn("holdout_rank", F.row_number().over(w2).cast("long"))
        .withColumn("balanced_rank", F.row_number().over(w3).cast("long"))
        .drop("_k1", "_k2", "_k3", "_cand")
    )


def best_models(board: DataFrame) -> DataFrame:
    """The rank-1 row per run."""
    return board.filter(F.col("rank") == 1)


def selection_rationale(board: DataFrame, run_cols=("run_id", "attempt")) -> DataFrame:
    """Why the winner won; runner-up is 2nd by (primary, F1) whatever the compare mode."""
    best, runner = F.col("rank") == 1, F.col("holdout_rank") == 2
    dummy = F.col("model").startswith("Dummy")
    agg = board.groupBy(*run_cols).agg(
        F.max(F.when(best, F.col("model"))).alias("selected_model"),
        F.max("primary_metric").alias("primary_metric"),
        F.max(F.coalesce(F.col("compare_on_cv"), F.lit(False)).cast("int")).cast("boolean").alias("compare_on_cv"),
        F.max(F.when(best, F.col("primary_value"))).alias("best_primary_metric"),
        F.max(F.when(best, F.col("cv_balanced_accuracy_mean"))).alias("best_cv_balanced_accuracy_mean"),
        F.max(F.when(best, F.col("cv_balanced_accuracy_std"))).alias("best_cv_balanced_accuracy_std"),
        F.max(F.when(best, F.col("balanced_accuracy"))).alias("_best_bal"),
        F.max(F.when(runner, F.col("model"))).alias("runner_up_model"),
        F.max(F.when(runner, F.col("primary_value"))).alias("runner_up_primary_metric"),
        F.max(F.when(runner, F.col("cv_balanced_accuracy_mean"))).alias("runner_up_cv_balanced_accuracy_mean"),
        F.min_by(F.col("balanced_accuracy"), F.when(dummy, F.col("rank"))).alias("dummy_balanced_accuracy"),
    )
    return agg.select(
        *run_cols, "selected_model", "primary_metric", "compare_on_cv",
        F.when(F.col("compare_on_cv"), "cv_first_then_holdout").otherwise("holdout_first_then_cv")
        .alias("selection_policy"),
        "best_primary_metric", "best_cv_balanced_accuracy_mean", "best_cv_balanced_accuracy_std",
        "runner_up_model", "runner_up_primary_metric", "runner_up_cv_balanced_accuracy_mean",
        "dummy_balanced_accuracy",
        (F.col("_best_bal") - F.col("dummy_balanced_accuracy")).alias("dummy_gain_balanced_accuracy"),
        F.when(F.col("compare_on_cv"), SUMMARY_CV).otherwise(SUMMARY_HOLDOUT).alias("human_summary"),
    )


def report_rationale(board: DataFrame, run_cols=("run_id", "attempt")) -> DataFrame:
    """R4, second form: the rationale kept with the run and its history record."""
    r = selection_rationale(board, run_cols).drop("dummy_balanced_accuracy", "dummy_gain_balanced_accuracy")
    return r.withColumn("human_summary", F.when(F.col("compare_on_cv"), REPORT_CV).otherwise(REPORT_HOLDOUT))


def order_candidates(candidates: DataFrame, preferred: DataFrame | None = None, avoid: DataFrame | None = None,
                     group_cols=("dataset_id",), on=None) -> DataFrame:
    """order = (in avoid list, rank among preferred, name); no history gives alphabetical order.

    ``preferred`` rows: (group..., model, pref_rank) with ``best_model`` already
    put first; ``avoid`` rows: (group..., model).  Both are left-joined on ``on``
    (default: the group) and model; ranks are inside the group.
    """
    c = candidates
    g = list(group_cols)
    keys = list(on or g)
    if preferred is not None:
        c = c.join(preferred.select(*keys, "model", "pref_rank"), on=[*keys, "model"], how="left")
    else:
        c = c.withColumn("pref_rank", F.lit(None).cast("long"))
    if avoid is not None:
        c = c.join(avoid.select(*keys, "model").withColumn("_avoid", F.lit(1)), on=[*keys, "model"], how="left")
    else:
        c = c.withColumn("_avoid", F.lit(None).cast("int"))
    n_pref = F.count("pref_rank").over(Window.partitionBy(*g))
    c = c.withColumn("_pr", F.coalesce(F.col("pref_rank"), n_pref + 10))
    w = Window.partitionBy(*g).orderBy(F.coalesce(F.col("_avoid"), F.lit(0)), F.col("_pr"), F.col("model"))
    return c.withColumn("candidate_order", F.row_number().over(w).cast("long")).drop("_pr", "_avoid")
