"""Run diagnosis by rules over the metrics table.

One aggregate per (run, attempt) over the ranked models gathers the winner,
the runner-up, the baseline and the spread; every rule after that is a column
expression, and ordered lists are ``array_distinct(array_compact(array(...)))``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelens.functions.columns import ordered_labels

GOOD_SCORE, MODEST_SCORE, POOR_SCORE = 0.80, 0.65, 0.55

# Fixed values that must equal the reference's: suggestion sentences, in rule order.
SUGGEST_WEAK_GAIN = "Review feature usefulness, confirm the target column, and prioritise stronger non-linear models."
SUGGEST_LOW_RECALL = "Keep balanced metrics as the main ranking signal and enable stronger imbalance handling."
SUGGEST_ACCURACY_TRAP = "Use class weighting and threshold tuning instead of trusting raw accuracy."
SUGGEST_HIGH_CARD = "Group rare categories before one-hot encoding to reduce noisy sparse features."
SUGGEST_DATA_QUALITY = (
    "Drop or isolate very high-missing columns and compare results against the default imputation pipeline."
)
SUGGEST_SMALL_DATA = (
    "Use cross-validation-driven ranking because holdout estimates are unstable on very small datasets."
)
SUGGEST_OVERFIT = (
    "Prefer simpler or more regularised models because the best model appears to overfit the training split."
)
SUGGEST_TIED = "Top models are nearly tied; rank candidates using cross-validation stability as a tie-breaker."
SUGGEST_SIMILAR = "Expand the model pool slightly because all candidates behave too similarly on this dataset."
SUGGEST_WEAK_SIGNAL = "Treat this as a weak-signal problem and prioritise robust ensembles over extensive tuning."
SUGGEST_NOT_SEPARATED = "The top two models are not clearly separated in CV; prefer the simpler one if results are similar."

# The issue sentences, with the number each shows.
ISSUE_TEXTS = {
    "low_dummy_gain": ("Best model improves balanced accuracy over the dummy baseline by only %.3f.", "dummy_gain_balanced_accuracy"),
    "weak_balanced_accuracy": ("Balanced accuracy is weak at %.3f.", "best_balanced_accuracy"),
    "moderate_balanced_accuracy": ("Balanced accuracy is only moderate at %.3f.", "best_balanced_accuracy"),
    "weak_macro_f1": ("Macro F1 is weak at %.3f, suggesting uneven class performance.", "best_macro_f1"),
    "low_class_recall": ("At least one class has very low recall (%.3f).", "worst_class_recall"),
}
# Fixed value: the note a re-attempt leaves in the profile.
REPLAN_NOTE = "Replan applied: strategy flags updated based on reflection root causes: "

# Steps every re-attempt puts first, and causes that make one worth while.
REPLAN_STEPS_FIXED = ["apply_replanned_strategy", "rebuild_preprocessor", "reselect_models"]
BENEFIT_CAUSES = ["imbalance_handling", "preprocessing_mismatch", "overly_simple_models", "unstable_model_rankings"]


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) of Student's t with a whole number of degrees of freedom, by its finite series.

    With theta = atan(|t| / sqrt(df)) the middle holds sin(theta) * (1 + 1/2 cos^2 + 1*3/(2*4) cos^4 + ...) for an even
    df, and 2/pi * (theta + sin(theta) * (cos + 2/3 cos^3 + 2*4/(3*5) cos^5 + ...)) for an odd one; both end at cos^(df-2).
    """
    n = df.cast("double")
    theta = F.atan(F.abs(t) / F.sqrt(n))
    cos2, sin = F.cos(theta) * F.cos(theta), F.sin(theta)
    even = df % 2 == 0
    steps = F.floor((df - F.when(even, 2).otherwise(3)) / 2).cast("int")  # factors after the first term
    more = F.when(steps >= 1, F.sequence(F.lit(1), F.greatest(steps, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(acc, k):
        ratio = F.when(even, (2 * k - 1) / (2 * k)).otherwise((2 * k) / (2 * k + 1))
        term = acc["term"] * ratio.cast("double") * cos2
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    series = F.aggregate(more, start, add, lambda acc: acc["sum"])
    middle = F.when(even, sin * series).otherwise(F.lit(2.0 / math.pi) * (theta + F.when(df > 1, sin * F.cos(theta) * series).otherwise(0.0)))
    return F.greatest(F.lit(1.0) - middle, F.lit(0.0))


def _paired_t(a: Column, b: Column):
    """Paired two-sided t-test over three or more folds."""
    d = F.zip_with(a, b, lambda x, y: x - y)
    k = F.size(d)
    mean = F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x) / k
    ss = F.aggregate(d, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    sd = F.sqrt(ss / (k - 1))
    t = mean / (sd / F.sqrt(k.cast("double")))
    available = a.isNotNull() & b.isNotNull() & (F.size(a) >= 3) & (F.size(a) == F.size(b))
    p = (
        F.when(~available, F.lit(None))
        .when(sd == 0, F.when(mean == 0, F.lit(None)).otherwise(F.lit(0.0)))
        .otherwise(t_two_sided(t, k - 1))
    )
    mean_a = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / F.size(a)
    mean_b = F.aggregate(b, F.lit(0.0), lambda acc, x: acc + x) / F.size(b)
    gap = F.when(available, mean_a - mean_b)
    return available, p.cast("double"), gap


def paired_t_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """X2 on any table: ttest_available, ttest_p_value and cv_mean_gap of two array columns of fold scores."""
    available, p, gap = _paired_t(F.col(a), F.col(b))
    return df.withColumns({"ttest_available": F.coalesce(available, F.lit(False)), "ttest_p_value": p, "cv_mean_gap": gap})


def run_summary(board: DataFrame, run_cols=("run_id", "attempt")) -> DataFrame:
    """Per (run, attempt): winner, runner-up (2nd by balanced accuracy, F1), baseline and spread.

    If the board has ``worst_class_recall`` per model, the winner's comes along.
    """
    worst = [F.max(F.when(F.col("rank") == 1, F.col("worst_class_recall"))).alias("worst_class_recall")] \
        if "worst_class_recall" in board.columns else []
    best = F.col("rank") == 1
    runner = F.col("balanced_rank") == 2
    dummy_rank = F.when(F.col("model").startswith("Dummy"), F.col("balanced_rank"))
    return board.groupBy(*run_cols).agg(
        F.max(F.when(best, F.col("model"))).alias("best_model"),
        F.max(F.when(best, F.col("balanced_accuracy"))).alias("best_balanced_accuracy"),
        F.max(F.when(best, F.col("f1_macro"))).alias("best_macro_f1"),
        F.max(F.when(best, F.col("accuracy"))).alias("best_accuracy"),
        F.max(F.when(best, F.col("train_balanced_accuracy"))).alias("train_balanced_accuracy"),
        F.max(F.when(best, F.col("cv_balanced_accuracy_mean"))).alias("cv_balanced_accuracy_mean"),
        F.max(F.when(best, F.col("cv_balanced_accuracy_std"))).alias("cv_balanced_accuracy_std"),
        F.first(F.when(best, F.col("cv_balanced_accuracy_scores")), ignorenulls=True).alias("best_folds"),
        F.max(F.when(runner, F.col("balanced_accuracy"))).alias("runner_up_balanced_accuracy"),
        F.first(F.when(runner, F.col("cv_balanced_accuracy_scores")), ignorenulls=True).alias("runner_folds"),
        F.max(runner.cast("int")).alias("has_runner"),
        F.min_by("balanced_accuracy", dummy_rank).alias("dummy_balanced_accuracy"),
        F.min_by("f1_macro", dummy_rank).alias("dummy_macro_f1"),
        F.max("balanced_accuracy").alias("spread_best"),
        F.median("balanced_accuracy").alias("spread_median"),
        F.stddev_pop("balanced_accuracy").alias("spread_std"),
        (F.max("balanced_accuracy") - F.min("balanced_accuracy")).alias("spread_range"),
        *worst,
    )


def diagnose(summary: DataFrame, context: DataFrame, worst: DataFrame | None = None,
             run_cols=("run_id", "attempt"), on=("run_id",)) -> DataFrame:
    """One diagnosis row per (run, attempt).

    ``context`` per run: imbalance_ratio, n_rows, high_cardinality_count,
    overall_missing, missing_severity, weak_signal_risk.  ``worst``: per
    (run, attempt) worst_class_recall of the winner's report (optional).
    """
    d = summary.join(context, on=list(on), how="left")
    if worst is not None:
        d = d.join(worst, on=list(run_cols), how="left")
    elif "worst_class_recall" not in d.columns:
        d = d.withColumn("worst_class_recall", F.lit(None).cast("double"))
    bal, f1, acc = F.col("best_balanced_accuracy"), F.col("best_macro_f1"), F.col("best_accuracy")
    imb = F.coalesce(F.col("imbalance_ratio"), F.lit(1.0))
    gain = bal - F.col("dummy_balanced_accuracy")
    gap = F.when(F.col("has_runner") == 1, bal - F.coalesce(F.col("runner_up_balanced_accuracy"), F.lit(0.0)))
    overfit = F.coalesce(F.col("train_balanced_accuracy"), F.lit(0.0)) - bal
    cv_std = F.col("cv_balanced_accuracy_std")
    worst_r = F.col("worst_class_recall")
    available, p_value, mean_gap = _paired_t(F.col("best_folds"), F.col("runner_folds"))
    d = (
        d.withColumn("dummy_gain_balanced_accuracy", gain)
        .withColumn("dummy_gain_macro_f1", f1 - F.col("dummy_macro_f1"))
        .withColumn("ranking_gap_to_runner_up", gap)
        .withColumn("train_test_gap_balanced_accuracy", overfit)
        .withColumn("ttest_available", available)
        .withColumn("ttest_p_value", p_value)
        .withColumn("ttest_mean_gap", mean_gap)
    )
    g = F.col("dummy_gain_balanced_accuracy")
    rg = F.col("ranking_gap_to_runner_up")
    ov = F.col("train_test_gap_balanced_accuracy")
    high_card = F.coalesce(F.col("high_cardinality_count"), F.lit(0)) > 0
    small_unstable = (F.col("n_rows") < 500) & (cv_std.isNull() | (cv_std > 0.06))
    tied = rg.isNotNull() & (rg < 0.01)
    quality = F.col("missing_severity").isin("high", "severe") | (F.coalesce(F.col("overall_missing"), F.lit(0.0)) >= 12.0)
    low_recall = worst_r.isNotNull() & (worst_r < 0.45)
    weak_sig = F.coalesce(F.col("weak_signal_risk"), F.lit(False))
    issue_codes = ordered_labels([
        (g < 0.03, "low_dummy_gain"),
        (bal < POOR_SCORE, "weak_balanced_accuracy"),
        ((bal >= POOR_SCORE) & (bal < MODEST_SCORE), "moderate_balanced_accuracy"),
        (f1 < POOR_SCORE, "weak_macro_f1"),
        (low_recall, "low_class_recall"),
    ])
    causes = F.array_distinct(ordered_labels([
        (g < 0.03, "weak_features"),
        ((f1 < POOR_SCORE) & (imb >= 3.0), "imbalance_handling"),
        (low_recall & (imb >= 2.5), "imbalance_handling"),
        (low_recall & (imb < 2.5), "weak_features"),
        ((imb >= 4.0) & ((bal - acc) < -0.08), "imbalance_handling"),
        (high_card & (bal < GOOD_SCORE), "preprocessing_mismatch"),
        (quality, "data_quality"),
        (small_unstable, "too_little_data"),
        (ov > 0.12, "unstable_model_rankings"),
        (tied, "unstable_model_rankings"),
        ((F.col("spread_std") < 0.025) & (bal < MODEST_SCORE), "overly_simple_models"),
        (weak_sig & (bal < GOOD_SCORE), "weak_features"),
    ]))
    suggestions = F.array_distinct(ordered_labels([
        (g < 0.03, SUGGEST_WEAK_GAIN),
        (low_recall & (imb >= 2.5), SUGGEST_LOW_RECALL),
        ((imb >= 4.0) & ((bal - acc) < -0.08), SUGGEST_ACCURACY_TRAP),
        (high_card & (bal < GOOD_SCORE), SUGGEST_HIGH_CARD),
        (quality, SUGGEST_DATA_QUALITY),
        (small_unstable, SUGGEST_SMALL_DATA),
        (ov > 0.12, SUGGEST_OVERFIT),
        (tied, SUGGEST_TIED),
        ((F.col("spread_std") < 0.025) & (bal < MODEST_SCORE), SUGGEST_SIMILAR),
        (weak_sig & (bal < GOOD_SCORE), SUGGEST_WEAK_SIGNAL),
        (F.col("ttest_available") & (F.col("ttest_p_value") > 0.10), SUGGEST_NOT_SEPARATED),
    ]))
    d = d.withColumn("issue_codes", issue_codes).withColumn("root_causes", causes).withColumn("suggestions", suggestions)
    d = d.withColumn("priority_actions", F.slice("suggestions", 1, 3))
    d = d.withColumn("status", F.when(F.size("issue_codes") > 0, "needs_attention").otherwise("ok"))
    d = d.withColumn(
        "confidence",
        F.when(small_unstable | (tied & (cv_std.isNull() | (cv_std > 0.03))), "medium").otherwise("high"),
    )
    rc = F.col("root_causes")
    benefit = (
        (g.isNotNull() & (g < 0.08)).cast("int")
        + F.array_contains(rc, "imbalance_handling").cast("int")
        + F.array_contains(rc, "preprocessing_mismatch").cast("int")
        + F.array_contains(rc, "overly_simple_models").cast("int")
        + F.array_contains(rc, "unstable_model_rankings").cast("int")
    )
    d = d.withColumn("replan_recommended",
                     (F.col("status") == "needs_attention") & (bal < GOOD_SCORE) & (benefit >= 1))
    return d


def should_replan(diag: DataFrame, max_replans: int = 1, run_col: str = "run_id", attempt_col: str = "attempt") -> DataFrame:
    """Re-attempt decision; attempt k has made k replans so far."""
    w = Window.partitionBy(run_col).orderBy(attempt_col)  # one row per attempt: a handful per run
    prev = F.lag("best_balanced_accuracy").over(w)
    bal = F.coalesce(F.col("best_balanced_accuracy"), F.lit(0.0))
    g, rg, cv_std = F.col("dummy_gain_balanced_accuracy"), F.col("ranking_gap_to_runner_up"), F.col("cv_balanced_accuracy_std")
    replans = F.col(attempt_col)
    no_gain = prev.isNotNull() & ((bal - F.coalesce(prev, F.lit(0.0))) < 0.01) & (replans >= 1)
    good_enough = (bal >= GOOD_SCORE) & g.isNotNull() & (g >= 0.10)
    potential = (
        (g.isNull() | (g < 0.08)).cast("int")
        + (rg.isNotNull() & (rg < 0.02)).cast("int")
        + (cv_std.isNull() | (cv_std > 0.04)).cast("int")
        + F.arrays_overlap(F.col("root_causes"), F.array(*[F.lit(c) for c in BENEFIT_CAUSES])).cast("int")
    )
    decision = (
        F.when(replans >= max_replans, False)
        .when(~F.col("replan_recommended"), False)
        .when(no_gain, False)
        .when(good_enough, False)
        .otherwise(potential >= 2)
    )
    return diag.withColumn("should_replan", decision)


def replan_flags(flags: Column, causes: Column, num_classes: Column) -> Column:
    """X11: strategy flags for the next attempt (struct in, struct out)."""
    has = lambda c: F.array_contains(causes, c)
    imb, pre, small = has("imbalance_handling"), has("preprocessing_mismatch"), has("too_little_data")
    simple, weak, unstable = has("overly_simple_models"), has("weak_features"), has("unstable_model_rankings")
    expand = simple | weak
    return F.struct(
        (flags["use_class_weight"] | imb).alias("use_class_weight"),
        (flags["group_rare_categories"] | pre).alias("group_rare_categories"),
        (flags["enable_cv"] | imb | small | unstable).alias("enable_cv"),
        (flags["compare_on_cv"] | imb | small | unstable).alias("compare_on_cv"),
        (flags["prefer_simple_models"] | small | unstable).alias("prefer_simple_models"),
        (flags["expand_model_diversity"] | expand).alias("expand_model_diversity"),
        (flags["include_kernel_model"] | expand).alias("include_kernel_model"),
        (flags["include_boosting"] | expand).alias("include_boosting"),
        (flags["include_extra_trees"] | expand).alias("include_extra_trees"),
        (flags["include_gradient_boosting"] | expand).alias("include_gradient_boosting"),
        (flags["tune_decision_threshold"] | (imb & (num_classes == 2))).alias("tune_decision_threshold"),
        (flags["drop_high_missing_features"] | pre).alias("drop_high_missing_features"),
        (flags["replan_count"] + 1).alias("replan_count"),
    )


def replan_steps(new_flags: Column, plan: Column) -> Column:
    """Fixed re-attempt steps plus flag-driven ones, put in front; first occurrence kept."""
    extra = F.concat(
        F.array(*[F.lit(s) for s in REPLAN_STEPS_FIXED]),
        ordered_labels([
            (new_flags["group_rare_categories"], "group_rare_categories"),
            (new_flags["drop_high_missing_features"], "drop_high_missing_columns"),
            (new_flags["enable_cv"], "validate_with_cross_validation"),
            (new_flags["compare_on_cv"], "rank_with_cv_stability"),
            (new_flags["expand_model_diversity"], "expand_model_pool"),
            (new_flags["tune_decision_threshold"], "tune_decision_thresholds"),
        ]),
    )
    return F.array_distinct(F.concat(extra, plan))


def issue_texts(diag: DataFrame) -> Column:
    """The issues of a ``diagnose`` row as sentences, in the order of their codes."""
    return ordered_labels([(F.array_contains("issue_codes", code), F.format_string(text, F.col(value)))
                           for code, (text, value) in ISSUE_TEXTS.items()])


def replan_note(causes: Column) -> Column:
    """Note appended to the profile after a re-attempt (causes sorted)."""
    return F.concat(
        F.lit(REPLAN_NOTE),
        F.array_join(F.array_sort(causes), ", "),
    )


def attempt_history(diag: DataFrame, run_cols=("run_id", "attempt")) -> DataFrame:
    """One summary row per attempt."""
    return diag.select(*run_cols, "best_model", F.col("best_balanced_accuracy").alias("balanced_accuracy"),
                       F.col("best_macro_f1").alias("f1_macro"), F.col("status").alias("reflection_status"))
