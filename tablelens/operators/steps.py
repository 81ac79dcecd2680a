"""Step lists and runtime flags from profile rows.

The step order the planner produces is static, so the plan is one rule table
``(step, condition)`` evaluated top to bottom over every profile row at once;
``array_distinct`` keeps the first of the two slots some steps have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelens.functions.columns import ordered_labels

# Flag defaults used when a profile row carries no value (L2).
FLAG_DEFAULTS = {
    "use_class_weight": False,
    "group_rare_categories": False,
    "enable_cv": False,
    "compare_on_cv": False,
    "prefer_simple_models": False,
    "expand_model_diversity": False,
    "include_kernel_model": False,
    "include_boosting": True,
    "include_extra_trees": True,
    "include_gradient_boosting": True,
    "tune_decision_threshold": False,
    "drop_high_missing_features": False,
}


def plan_inputs(df: DataFrame) -> DataFrame:
    """L1+L2: planner view of profile facts with defaults.

    Reads n_rows, feature_count, imbalance_ratio, overall_missing, max_missing,
    missing_severity, high_cardinality_count, high_dimensional,
    dominant_feature_type, num_classes, target_confidence, weak_signal_risk,
    size_bucket, is_classification, numeric_ratio, categorical_ratio and the
    strategy_flags struct.
    """
    flags = F.col("strategy_flags")
    return df.select(
        "*",
        F.coalesce(F.col("imbalance_ratio"), F.lit(1.0)).alias("_imb"),
        (F.col("feature_count") > F.greatest(F.col("n_rows"), F.lit(1))).alias("_wide"),
        (F.coalesce(F.col("num_classes"), F.lit(0)) == 2).alias("_binary"),
        *[F.coalesce(flags[k], F.lit(v)).alias(f"_f_{k}") for k, v in FLAG_DEFAULTS.items()],
        F.coalesce(flags["replan_count"], F.lit(0)).alias("_f_replan_count"),
    )


def _rules(preferred: Column, avoid: Column, has_performance: Column):
    c = F.col
    clf = F.coalesce(c("is_classification"), F.lit(True))
    imb = c("_imb")
    tiny, small, large = c("size_bucket") == "tiny", c("size_bucket") == "small", c("size_bucket") == "large"
    missing = c("missing_severity").isin("medium", "high", "severe") | (c("overall_missing") >= 5.0)
    hc = c("high_cardinality_count") > 0
    wide = c("high_dimensional") | c("_wide")
    tuning = clf & c("_binary") & ((imb >= 4.0) | c("_f_tune_decision_threshold"))
    weak = F.coalesce(c("weak_signal_risk"), F.lit(False))
    has_pref = F.size(preferred) > 0
    has_avoid = F.size(avoid) > 0
    always = F.lit(True)
    linear = (c("dominant_feature_type") == "numeric") & ~hc & ~c("_wide")
    return [
        (always, "profile_dataset"),
        (always, "validate_target"),
        (always, "check_for_data_leakage"),
        (always, "remove_leaky_features"),
        (c("target_confidence") == "low", "confirm_target_assumption"),
        (always, "assess_risks"),
        (missing, "audit_missingness"),
        (missing & (c("numeric_ratio") > 0), "impute_numeric_features"),
        (missing & (c("categorical_ratio") > 0), "impute_categorical_features"),
        (missing, "add_missing_indicators"),
        (missing & ((c("max_missing") >= 35.0) | c("_f_drop_high_missing_features")), "drop_high_missing_columns"),
        (hc, "control_high_cardinality"),
        (wide, "apply_feature_selection"),
        (c("_f_group_rare_categories"), "group_rare_categories"),
        (c("_f_replan_count") > 0, "apply_replanned_strategy"),
        (always, "build_preprocessor"),
        (clf, "set_problem_type::classification"),
        (~clf, "set_problem_type::regression"),
        (clf & (imb >= 2.5), "activate_imbalance_strategy"),
        (clf & (imb >= 2.5) & (c("_f_use_class_weight") | (imb >= 3.0)), "enable_class_weighted_models"),
        (tiny, "guard_against_tiny_sample"),
        (wide, "reduce_model_complexity_risk"),
        (linear, "prioritise_linear_and_distance_models"),
        (~linear, "prioritise_tree_ensembles_for_mixed_data"),
        (weak, "prefer_regularised_models"),
        (has_pref, "prioritise_models_from_memory"),
        (has_avoid, "avoid_previously_unstable_models"),
        (has_performance, "rank_models_by_past_performance"),
        (always, "select_models"),
        (always, "train_baseline"),
        (tiny, "prefer_simple_models"),
        (tiny, "limit_model_complexity"),
        (large, "use_runtime_aware_model_pool"),
        (c("_f_include_kernel_model"), "include_kernel_models"),
        (~c("_f_include_boosting"), "exclude_boosting_models"),
        (~c("_f_include_extra_trees"), "exclude_extra_trees_models"),
        (~c("_f_include_gradient_boosting"), "exclude_gradient_boosting_models"),
        (weak, "compare_with_dummy_baseline"),
        (c("_f_expand_model_diversity"), "expand_model_pool"),
        (c("_f_prefer_simple_models"), "prefer_simple_models"),
        (has_pref, "try_memory_models_first"),
        (always, "train_candidate_models"),
        (~tiny & (small | c("_f_enable_cv")), "validate_with_cross_validation"),
        (clf & (imb >= 2.5) & tuning, "tune_decision_thresholds"),
        (always, "compare_candidates"),
        (c("_f_compare_on_cv"), "rank_with_cv_stability"),
        (tiny, "validate_with_cross_validation"),
        (large, "check_scalability_tradeoffs"),
        (clf & (imb >= 2.5), "use_balanced_accuracy"),
        (clf & (imb < 2.5), "use_accuracy"),
        (clf, "use_macro_f1"),
        (~clf, "use_rmse"),
        (~clf, "use_mae"),
        (always, "evaluate"),
        (weak, "prepare_fallback_strategy"),
        (always, "reflect"),
        (c("_f_replan_count") > 0, "assess_replan_impact"),
        (always, "write_report"),
    ]


def plan_steps(df: DataFrame, preferred: Column | None = None, avoid: Column | None = None,
               has_performance: Column | None = None) -> Column:
    """L3 (+L6/L7): ordered, de-duplicated step array for every row of ``plan_inputs(df)``.

    ``preferred``/``avoid`` are arrays of model names from the history hint;
    the first three of each become ``memory_priority::``/``memory_avoid::`` steps.
    """
    empty = F.array().cast("array<string>")
    preferred = preferred if preferred is not None else empty
    avoid = avoid if avoid is not None else empty
    has_performance = has_performance if has_performance is not None else F.lit(False)
    base = ordered_labels(_rules(preferred, avoid, has_performance))
    memory = F.concat(
        F.transform(F.slice(preferred, 1, 3), lambda m: F.concat(F.lit("memory_priority::"), m)),
        F.transform(F.slice(avoid, 1, 3), lambda m: F.concat(F.lit("memory_avoid::"), m)),
    )
    return F.array_distinct(F.concat(base, memory))


def preferred_models(preferred: Column, best_model: Column) -> Column:
    """Names with a non-negative score, else the hint's best model (array of (name, score) structs in)."""
    names = F.transform(F.filter(preferred, lambda s: s["score"] >= 0.0), lambda s: s["name"])
    return F.when(F.size(names) > 0, names).when(best_model.isNotNull(), F.array(best_model)).otherwise(
        F.array().cast("array<string>")
    )


def runtime_flags(flags: Column, steps: Column) -> Column:
    """L4: steps switch flags on (or boosting off)."""
    has = lambda s: F.array_contains(steps, s)
    no_boost = has("exclude_boosting_models")
    return F.struct(
        (flags["use_class_weight"] | has("activate_imbalance_strategy")).alias("use_class_weight"),
        (flags["group_rare_categories"] | has("control_high_cardinality")).alias("group_rare_categories"),
        (flags["enable_cv"] | has("validate_with_cross_validation")).alias("enable_cv"),
        (flags["compare_on_cv"] | has("rank_with_cv_stability")).alias("compare_on_cv"),
        (flags["prefer_simple_models"] | has("prefer_simple_models") | has("limit_model_complexity"))
        .alias("prefer_simple_models"),
        (flags["expand_model_diversity"] | has("expand_model_pool")).alias("expand_model_diversity"),
        (flags["include_kernel_model"] | has("include_kernel_models")).alias("include_kernel_model"),
        (flags["include_boosting"] & ~no_boost).alias("include_boosting"),
        (flags["include_extra_trees"] & ~has("exclude_extra_trees_models")).alias("include_extra_trees"),
        (flags["include_gradient_boosting"] & ~no_boost).alias("include_gradient_boosting"),
        (flags["tune_decision_threshold"] | has("tune_decision_thresholds")).alias("tune_decision_threshold"),
        (flags["drop_high_missing_features"] | has("drop_high_missing_columns")).alias("drop_high_missing_features"),
        flags["replan_count"].alias("replan_count"),
    )


def flags_from_votes(flags: Column, voted: Column) -> Column:
    """Flags named by the history's strategy preferences are forced on (booleans only)."""
    from tablelens.operators.profile_rules import FLAG_NAMES

    return F.struct(
        *[(flags[k] | F.array_contains(voted, k)).alias(k) for k in FLAG_NAMES],
        flags["replan_count"].alias("replan_count"),
    )
