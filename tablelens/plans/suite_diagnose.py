"""Registered queries for diagnosis (X1-X14), step lists (L1-L4) and candidate pools (M0)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelens.functions.columns import r6
from tablelens.operators import diagnose as X
from tablelens.operators import metrics as K
from tablelens.operators import pool as M
from tablelens.operators import steps as L
from tablelens.operators.profile_rules import FLAG_NAMES, facts_rules
from tablelens.plans.fixtures import fixture, with_fixtures
from tablelens.plans.suite_metrics import (
    F7M_CTE, RUN_MODEL, board_cte, class_stats_ctes, f7_board, run_context,
)
from tablelens.plans.suite_profile import _flags_sql
from tablelens.sources.tables import read_table as table

MAX_REPLANS = 2  # lets the second attempt reach the "no gain since last attempt" rule


# ------------------------------------------------------------------ Spark side
def f5_planned(spark, sf):
    """F5 facts with default flags, planner view, plan and runtime flags (dataset_id keyed)."""
    f5 = facts_rules(fixture(spark, sf, "f5"))
    f5 = f5.withColumn("imbalance_ratio", F.when(F.col("is_classification"), F.col("imbalance_ratio"))) \
        .withColumn("num_classes", F.when(F.col("is_classification"), F.col("num_classes")).otherwise(F.lit(0)))
    p = L.plan_inputs(f5)
    p = p.withColumn("plan", L.plan_steps(p))
    return p.withColumn("runtime_flags", L.runtime_flags(F.col("strategy_flags"), F.col("plan")))


def diagnosis(spark, sf):
    test = fixture(spark, sf, "f6").filter(F.col("split") == "test")
    worst = K.class_stats(K.confusion_counts(test, group_cols=RUN_MODEL), RUN_MODEL) \
        .groupBy(*RUN_MODEL).agg(F.min("recall").alias("worst_class_recall"))
    summary = X.run_summary(f7_board(spark, sf).join(worst, on=RUN_MODEL, how="left"))
    d = X.diagnose(summary, run_context(spark, sf).drop("compare_on_cv"))
    return X.should_replan(d, MAX_REPLANS)


def _keys(*cols):
    return ["run_id", "attempt", *cols]


def q_model_spread(spark, sf):
    d = diagnosis(spark, sf)
    return d.select(*_keys(), *[r6(F.col(c)).alias(c) for c in ("spread_best", "spread_median", "spread_std", "spread_range")])


def q_paired_t_test(spark, sf):
    d = diagnosis(spark, sf)
    return d.select(*_keys(), "ttest_available", r6(F.col("ttest_p_value")).alias("ttest_p_value"),
                    r6(F.col("ttest_mean_gap")).alias("ttest_mean_gap"))


def q_paired_t_five_folds(spark, sf):
    """X2 with five folds: discounts against taxes, averaged by supplier and fold (order number mod 5)."""
    li = table(spark, sf, "lineitem")
    fold = li.groupBy("l_suppkey", (F.col("l_orderkey") % 5).alias("fold")).agg(F.avg(F.col("l_discount").cast("double")).alias("a"), F.avg(F.col("l_tax").cast("double")).alias("b"))
    rows = fold.groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct("fold", "a", "b"))).alias("f"))  # five entries
    rows = rows.select("l_suppkey", F.col("f.a").alias("a"), F.col("f.b").alias("b"))
    t = X.paired_t_test(rows, "a", "b")
    return t.select("l_suppkey", "ttest_available", r6(F.col("ttest_p_value")).alias("ttest_p_value"), r6(F.col("cv_mean_gap")).alias("cv_mean_gap"))


def q_run_gaps(spark, sf):
    cols = ["dummy_gain_balanced_accuracy", "dummy_gain_macro_f1", "ranking_gap_to_runner_up",
            "train_test_gap_balanced_accuracy"]
    return diagnosis(spark, sf).select(*_keys(), *[r6(F.col(c)).alias(c) for c in cols])


def q_worst_class_recall(spark, sf):
    return diagnosis(spark, sf).select(*_keys(), "best_model", r6(F.col("worst_class_recall")).alias("worst_class_recall"))


def q_run_issues(spark, sf):
    return diagnosis(spark, sf).select(*_keys(), "status", F.array_join("issue_codes", "|").alias("issue_codes"))


def q_root_causes(spark, sf):
    return diagnosis(spark, sf).select(*_keys(), F.array_join("root_causes", "|").alias("root_causes"), "confidence")


def q_suggestions_top3(spark, sf):
    d = diagnosis(spark, sf)
    return d.select(*_keys(), F.array_join("priority_actions", "|").alias("priority_actions"),
                    F.size("suggestions").cast("long").alias("n_suggestions"))


def q_replan_recommended(spark, sf):
    return diagnosis(spark, sf).select(*_keys(), "replan_recommended")


def q_should_replan(spark, sf):
    return diagnosis(spark, sf).select(*_keys(), "should_replan")


def _replanned(spark, sf):
    d = diagnosis(spark, sf)
    plans = f5_planned(spark, sf).select(F.col("dataset_id").alias("run_id"), "plan")
    # a list of steps per run is many times its file's size, by which Spark would broadcast it
    d = d.join(plans.hint("merge"), on="run_id", how="left")
    d = d.withColumn("new_flags", X.replan_flags(F.col("strategy_flags"), F.col("root_causes"), F.col("num_classes")))
    return d.withColumn("new_plan", X.replan_steps(F.col("new_flags"), F.col("plan")))


def q_replan_flags(spark, sf):
    d = _replanned(spark, sf)
    return d.select(*_keys(), *[F.col(f"new_flags.{k}").alias(k) for k in FLAG_NAMES],
                    F.col("new_flags.replan_count").cast("long").alias("replan_count"))


def q_replan_steps(spark, sf):
    d = _replanned(spark, sf)
    return d.select(*_keys(), F.posexplode("new_plan").alias("position", "step")).select(
        *_keys(), F.col("position").cast("long").alias("position"), "step")


def q_diagnose_runs(spark, sf):
    d = diagnosis(spark, sf)
    return d.select(
        *_keys(), "best_model", "status", "confidence",
        F.array_join("issue_codes", "|").alias("issue_codes"),
        F.array_join("root_causes", "|").alias("root_causes"),
        F.array_join("priority_actions", "|").alias("priority_actions"),
        "replan_recommended", "should_replan",
        r6(F.col("best_balanced_accuracy")).alias("best_balanced_accuracy"),
        r6(F.col("cv_balanced_accuracy_std")).alias("cv_balanced_accuracy_std"),
    )


def q_attempt_history(spark, sf):
    h = X.attempt_history(diagnosis(spark, sf))
    return h.select(*_keys(), "best_model", r6(F.col("balanced_accuracy")).alias("balanced_accuracy"),
                    r6(F.col("f1_macro")).alias("f1_macro"), "reflection_status")


def q_plan_steps(spark, sf):
    p = f5_planned(spark, sf)
    return p.select("dataset_id", F.posexplode("plan").alias("position", "step")).select(
        "dataset_id", F.col("position").cast("long").alias("position"), "step")


def q_runtime_flags(spark, sf):
    p = f5_planned(spark, sf)
    return p.select("dataset_id", *[F.col(f"runtime_flags.{k}").alias(k) for k in FLAG_NAMES])


def q_candidate_pool(spark, sf):
    p = f5_planned(spark, sf)
    pool = M.candidate_pool(F.col("n_rows"), F.col("feature_count"), F.col("dominant_feature_type"),
                            F.col("high_dimensional"), F.col("high_cardinality_count"), F.col("num_classes"),
                            F.col("size_bucket"), F.col("runtime_flags"))
    return p.select("dataset_id", F.posexplode(pool).alias("position", "model")).select(
        "dataset_id", F.col("position").cast("long").alias("position"), "model")


QUERIES = {
    "model_spread": q_model_spread,
    "paired_t_test": q_paired_t_test,
    "paired_t_five_folds": q_paired_t_five_folds,
    "run_gaps": q_run_gaps,
    "worst_class_recall": q_worst_class_recall,
    "run_issues": q_run_issues,
    "root_causes": q_root_causes,
    "suggestions_top3": q_suggestions_top3,
    "replan_recommended": q_replan_recommended,
    "should_replan": q_should_replan,
    "replan_flags": q_replan_flags,
    "replan_steps": q_replan_steps,
    "diagnose_runs": q_diagnose_runs,
    "attempt_history": q_attempt_history,
    "plan_steps": q_plan_steps,
    "runtime_flags": q_runtime_flags,
    "candidate_pool": q_candidate_pool,
}


# ------------------------------------------------------------------ oracle SQL
def _olist(items) -> str:
    """SQL list of labels whose conditions hold, NULLs removed."""
    cases = ", ".join(f"CASE WHEN {c} THEN '{label}' END" for c, label in items)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def _distinct(lst: str) -> str:
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


FR_CTES = f"""fr0 AS (SELECT *,
  CASE WHEN n_rows < 300 THEN 'tiny' WHEN n_rows < 3000 THEN 'small' WHEN n_rows < 30000 THEN 'medium' ELSE 'large' END AS size_bucket,
  CASE WHEN overall_missing >= 25 OR max_missing >= 60 THEN 'severe' WHEN overall_missing >= 10 OR max_missing >= 35 THEN 'high'
       WHEN overall_missing >= 3 OR max_missing >= 15 THEN 'medium' ELSE 'low' END AS missing_severity,
  CASE WHEN numeric_ratio > 0.7 THEN 'numeric' WHEN categorical_ratio > 0.7 THEN 'categorical' ELSE 'mixed' END AS dominant_feature_type,
  (feature_count > greatest(80, floor(sqrt(greatest(n_rows, 1)) * 6)) OR feature_count > n_rows) AS high_dimensional,
  CASE WHEN is_classification THEN minority_class_count ELSE 0 END AS minority_eff,
  CASE WHEN is_classification THEN imbalance_ratio END AS imbalance_eff,
  CASE WHEN is_classification THEN num_classes ELSE 0 END AS classes_eff
FROM f5),
fr1 AS (SELECT *, ((n_rows < 500 AND feature_count > greatest(floor(n_rows / 5), 10))
   OR (missing_severity IN ('high', 'severe') AND high_cardinality_count > 0) OR target_confidence = 'low') AS weak_signal_risk
FROM fr0),
fr AS (SELECT *, {_flags_sql("coalesce(imbalance_eff, 1.0)", "classes_eff", "size_bucket", "high_cardinality_count",
                             "dominant_feature_type", "max_missing", "minority_eff")} FROM fr1),
ctx AS (SELECT dataset_id AS run_id, imbalance_eff AS imbalance_ratio, compare_on_cv FROM fr)"""

_IMB = "coalesce(imbalance_eff, 1.0)"
_MISS = "(missing_severity IN ('medium', 'high', 'severe') OR overall_missing >= 5.0)"
_WIDE = "(feature_count > greatest(n_rows, 1))"
_HC = "(high_cardinality_count > 0)"
_LINEAR = f"(dominant_feature_type = 'numeric' AND NOT {_HC} AND NOT {_WIDE})"
_TUNE = f"(is_classification AND classes_eff = 2 AND ({_IMB} >= 4.0 OR tune_decision_threshold))"
PLAN_RULES = [
    ("TRUE", "profile_dataset"), ("TRUE", "validate_target"), ("TRUE", "check_for_data_leakage"),
    ("TRUE", "remove_leaky_features"), ("target_confidence = 'low'", "confirm_target_assumption"),
    ("TRUE", "assess_risks"), (_MISS, "audit_missingness"),
    (f"{_MISS} AND numeric_ratio > 0", "impute_numeric_features"),
    (f"{_MISS} AND categorical_ratio > 0", "impute_categorical_features"),
    (_MISS, "add_missing_indicators"),
    (f"{_MISS} AND (max_missing >= 35.0 OR drop_high_missing_features)", "drop_high_missing_columns"),
    (_HC, "control_high_cardinality"), (f"(high_dimensional OR {_WIDE})", "apply_feature_selection"),
    ("group_rare_categories", "group_rare_categories"), ("replan_count > 0", "apply_replanned_strategy"),
    ("TRUE", "build_preprocessor"), ("is_classification", "set_problem_type::classification"),
    ("NOT is_classification", "set_problem_type::regression"),
    (f"is_classification AND {_IMB} >= 2.5", "activate_imbalance_strategy"),
    (f"is_classification AND {_IMB} >= 2.5 AND (use_class_weight OR {_IMB} >= 3.0)", "enable_class_weighted_models"),
    ("size_bucket = 'tiny'", "guard_against_tiny_sample"),
    (f"(high_dimensional OR {_WIDE})", "reduce_model_complexity_risk"),
    (_LINEAR, "prioritise_linear_and_distance_models"),
    (f"NOT {_LINEAR}", "prioritise_tree_ensembles_for_mixed_data"),
    ("weak_signal_risk", "prefer_regularised_models"),
    ("TRUE", "select_models"), ("TRUE", "train_baseline"),
    ("size_bucket = 'tiny'", "prefer_simple_models"), ("size_bucket = 'tiny'", "limit_model_complexity"),
    ("size_bucket = 'large'", "use_runtime_aware_model_pool"),
    ("include_kernel_model", "include_kernel_models"), ("NOT include_boosting", "exclude_boosting_models"),
    ("NOT include_extra_trees", "exclude_extra_trees_models"),
    ("NOT include_gradient_boosting", "exclude_gradient_boosting_models"),
    ("weak_signal_risk", "compare_with_dummy_baseline"), ("expand_model_diversity", "expand_model_pool"),
    ("prefer_simple_models", "prefer_simple_models"), ("TRUE", "train_candidate_models"),
    ("size_bucket <> 'tiny' AND (size_bucket = 'small' OR enable_cv)", "validate_with_cross_validation"),
    (f"is_classification AND {_IMB} >= 2.5 AND {_TUNE}", "tune_decision_thresholds"),
    ("TRUE", "compare_candidates"), ("compare_on_cv", "rank_with_cv_stability"),
    ("size_bucket = 'tiny'", "validate_with_cross_validation"),
    ("size_bucket = 'large'", "check_scalability_tradeoffs"),
    (f"is_classification AND {_IMB} >= 2.5", "use_balanced_accuracy"),
    (f"is_classification AND {_IMB} < 2.5", "use_accuracy"), ("is_classification", "use_macro_f1"),
    ("NOT is_classification", "use_rmse"), ("NOT is_classification", "use_mae"),
    ("TRUE", "evaluate"), ("weak_signal_risk", "prepare_fallback_strategy"), ("TRUE", "reflect"),
    ("replan_count > 0", "assess_replan_impact"), ("TRUE", "write_report"),
]
PLAN_CTE = f"pl AS (SELECT *, {_distinct(_olist(PLAN_RULES))} AS plan FROM fr)"

_RT = {
    "use_class_weight": "use_class_weight OR list_contains(plan, 'activate_imbalance_strategy')",
    "group_rare_categories": "group_rare_categories OR list_contains(plan, 'control_high_cardinality')",
    "enable_cv": "enable_cv OR list_contains(plan, 'validate_with_cross_validation')",
    "compare_on_cv": "compare_on_cv OR list_contains(plan, 'rank_with_cv_stability')",
    "prefer_simple_models": "prefer_simple_models OR list_contains(plan, 'prefer_simple_models') "
                            "OR list_contains(plan, 'limit_model_complexity')",
    "expand_model_diversity": "expand_model_diversity OR list_contains(plan, 'expand_model_pool')",
    "include_kernel_model": "include_kernel_model OR list_contains(plan, 'include_kernel_models')",
    "include_boosting": "include_boosting AND NOT list_contains(plan, 'exclude_boosting_models')",
    "include_extra_trees": "include_extra_trees AND NOT list_contains(plan, 'exclude_extra_trees_models')",
    "include_gradient_boosting": "include_gradient_boosting AND NOT list_contains(plan, 'exclude_boosting_models')",
    "tune_decision_threshold": "tune_decision_threshold OR list_contains(plan, 'tune_decision_thresholds')",
    "drop_high_missing_features": "drop_high_missing_features OR list_contains(plan, 'drop_high_missing_columns')",
}
RT_CTE = "rt AS (SELECT dataset_id, plan, n_rows, feature_count, dominant_feature_type, high_dimensional, " \
         "high_cardinality_count, classes_eff, size_bucket, " + ", ".join(f"({v}) AS rt_{k}" for k, v in _RT.items()) + " FROM pl)"

DIAG_CTES = f"""{FR_CTES},
{F7M_CTE},
{board_cte('m7')},
t6 AS (SELECT * FROM f6 WHERE split = 'test'),
{class_stats_ctes('t6', RUN_MODEL, 'wcs')},
wr AS (SELECT run_id, model, min(recall) AS worst_class_recall FROM wcs GROUP BY run_id, model),
sm AS (SELECT run_id, attempt,
  max(CASE WHEN rank = 1 THEN model END) AS best_model,
  max(CASE WHEN rank = 1 THEN balanced_accuracy END) AS bal,
  max(CASE WHEN rank = 1 THEN f1_macro END) AS f1,
  max(CASE WHEN rank = 1 THEN accuracy END) AS acc,
  max(CASE WHEN rank = 1 THEN train_balanced_accuracy END) AS train_bal,
  max(CASE WHEN rank = 1 THEN cv_balanced_accuracy_std END) AS cv_std,
  max(CASE WHEN rank = 1 THEN fold0 END) AS bf0, max(CASE WHEN rank = 1 THEN fold1 END) AS bf1,
  max(CASE WHEN rank = 1 THEN fold2 END) AS bf2,
  max(CASE WHEN balanced_rank = 2 THEN balanced_accuracy END) AS rbal,
  max(CASE WHEN balanced_rank = 2 THEN fold0 END) AS rf0, max(CASE WHEN balanced_rank = 2 THEN fold1 END) AS rf1,
  max(CASE WHEN balanced_rank = 2 THEN fold2 END) AS rf2,
  max(CASE WHEN balanced_rank = 2 THEN 1 ELSE 0 END) AS has_runner,
  arg_min(CASE WHEN model LIKE 'Dummy%' THEN balanced_accuracy END, CASE WHEN model LIKE 'Dummy%' THEN balanced_rank END) AS dbal,
  arg_min(CASE WHEN model LIKE 'Dummy%' THEN f1_macro END, CASE WHEN model LIKE 'Dummy%' THEN balanced_rank END) AS df1,
  max(balanced_accuracy) AS spread_best, median(balanced_accuracy) AS spread_median,
  stddev_pop(balanced_accuracy) AS spread_std, max(balanced_accuracy) - min(balanced_accuracy) AS spread_range
FROM board GROUP BY run_id, attempt),
d0 AS (SELECT sm.*, wr.worst_class_recall, fr.n_rows, fr.missing_severity, fr.overall_missing, fr.high_cardinality_count,
  fr.weak_signal_risk, fr.classes_eff, coalesce(fr.imbalance_eff, 1.0) AS imb,
  bal - dbal AS gain, f1 - df1 AS f1_gain,
  CASE WHEN has_runner = 1 THEN bal - coalesce(rbal, 0.0) END AS rgap,
  coalesce(train_bal, 0.0) - bal AS overfit,
  bf0 IS NOT NULL AND rf0 IS NOT NULL AS t_avail,
  bf0 - rf0 AS d0, bf1 - rf1 AS d1, bf2 - rf2 AS d2
FROM sm LEFT JOIN wr ON sm.run_id = wr.run_id AND sm.best_model = wr.model
LEFT JOIN fr ON sm.run_id = fr.dataset_id),
d1 AS (SELECT *, (d0 + d1 + d2) / 3 AS dm FROM d0),
d2 AS (SELECT *, sqrt(((d0 - dm) * (d0 - dm) + (d1 - dm) * (d1 - dm) + (d2 - dm) * (d2 - dm)) / 2) AS dsd FROM d1),
d3 AS (SELECT *,
  CASE WHEN NOT t_avail THEN NULL WHEN dsd = 0 THEN CASE WHEN dm = 0 THEN NULL ELSE 0.0 END
       ELSE 1.0 - abs(dm / (dsd / sqrt(3.0))) / sqrt(2.0 + (dm / (dsd / sqrt(3.0))) * (dm / (dsd / sqrt(3.0)))) END AS p_value,
  CASE WHEN t_avail THEN (bf0 + bf1 + bf2) / 3 - (rf0 + rf1 + rf2) / 3 END AS mean_gap,
  worst_class_recall IS NOT NULL AND worst_class_recall < 0.45 AS low_recall,
  n_rows < 500 AND (cv_std IS NULL OR cv_std > 0.06) AS small_unstable,
  rgap IS NOT NULL AND rgap < 0.01 AS tied,
  (missing_severity IN ('high', 'severe') OR coalesce(overall_missing, 0.0) >= 12.0) AS quality
FROM d2),
d4 AS (SELECT *,
  {_olist([("gain < 0.03", "low_dummy_gain"), ("bal < 0.55", "weak_balanced_accuracy"),
           ("bal >= 0.55 AND bal < 0.65", "moderate_balanced_accuracy"), ("f1 < 0.55", "weak_macro_f1"),
           ("low_recall", "low_class_recall")])} AS issues,
  {_distinct(_olist([("gain < 0.03", "weak_features"), ("f1 < 0.55 AND imb >= 3.0", "imbalance_handling"),
                     ("low_recall AND imb >= 2.5", "imbalance_handling"), ("low_recall AND imb < 2.5", "weak_features"),
                     ("imb >= 4.0 AND (bal - acc) < -0.08", "imbalance_handling"),
                     ("high_cardinality_count > 0 AND bal < 0.80", "preprocessing_mismatch"),
                     ("quality", "data_quality"), ("small_unstable", "too_little_data"),
                     ("overfit > 0.12", "unstable_model_rankings"), ("tied", "unstable_model_rankings"),
                     ("spread_std < 0.025 AND bal < 0.65", "overly_simple_models"),
                     ("coalesce(weak_signal_risk, FALSE) AND bal < 0.80", "weak_features")]))} AS causes,
  {_distinct(_olist([("gain < 0.03", X.SUGGEST_WEAK_GAIN), ("low_recall AND imb >= 2.5", X.SUGGEST_LOW_RECALL),
                     ("imb >= 4.0 AND (bal - acc) < -0.08", X.SUGGEST_ACCURACY_TRAP),
                     ("high_cardinality_count > 0 AND bal < 0.80", X.SUGGEST_HIGH_CARD),
                     ("quality", X.SUGGEST_DATA_QUALITY), ("small_unstable", X.SUGGEST_SMALL_DATA),
                     ("overfit > 0.12", X.SUGGEST_OVERFIT), ("tied", X.SUGGEST_TIED),
                     ("spread_std < 0.025 AND bal < 0.65", X.SUGGEST_SIMILAR),
                     ("coalesce(weak_signal_risk, FALSE) AND bal < 0.80", X.SUGGEST_WEAK_SIGNAL),
                     ("t_avail AND p_value > 0.10", X.SUGGEST_NOT_SEPARATED)]))} AS suggestions,
  CASE WHEN small_unstable OR (tied AND (cv_std IS NULL OR cv_std > 0.03)) THEN 'medium' ELSE 'high' END AS confidence
FROM d3),
d5 AS (SELECT *, CASE WHEN len(issues) > 0 THEN 'needs_attention' ELSE 'ok' END AS status,
  (CASE WHEN gain IS NOT NULL AND gain < 0.08 THEN 1 ELSE 0 END
   + CASE WHEN list_contains(causes, 'imbalance_handling') THEN 1 ELSE 0 END
   + CASE WHEN list_contains(causes, 'preprocessing_mismatch') THEN 1 ELSE 0 END
   + CASE WHEN list_contains(causes, 'overly_simple_models') THEN 1 ELSE 0 END
   + CASE WHEN list_contains(causes, 'unstable_model_rankings') THEN 1 ELSE 0 END) AS benefit,
  lag(bal) OVER (PARTITION BY run_id ORDER BY attempt) AS prev_bal
FROM d4),
dg AS (SELECT *, (status = 'needs_attention' AND bal < 0.80 AND benefit >= 1) AS replan_recommended FROM d5),
dq AS (SELECT *, CASE
    WHEN attempt >= {MAX_REPLANS} THEN FALSE
    WHEN NOT replan_recommended THEN FALSE
    WHEN prev_bal IS NOT NULL AND (coalesce(bal, 0.0) - coalesce(prev_bal, 0.0)) < 0.01 AND attempt >= 1 THEN FALSE
    WHEN coalesce(bal, 0.0) >= 0.80 AND gain IS NOT NULL AND gain >= 0.10 THEN FALSE
    ELSE (CASE WHEN gain IS NULL OR gain < 0.08 THEN 1 ELSE 0 END
          + CASE WHEN rgap IS NOT NULL AND rgap < 0.02 THEN 1 ELSE 0 END
          + CASE WHEN cv_std IS NULL OR cv_std > 0.04 THEN 1 ELSE 0 END
          + CASE WHEN list_has_any(causes, ['imbalance_handling', 'preprocessing_mismatch', 'overly_simple_models',
                                            'unstable_model_rankings']) THEN 1 ELSE 0 END) >= 2 END AS should_replan
FROM dg)"""


def _diag(select: str) -> str:
    return with_fixtures(f"{DIAG_CTES}\n{select}", "f5", "f6", "f7")


_NEWFLAGS = {
    "use_class_weight": "fr.use_class_weight OR list_contains(causes, 'imbalance_handling')",
    "group_rare_categories": "fr.group_rare_categories OR list_contains(causes, 'preprocessing_mismatch')",
    "enable_cv": "fr.enable_cv OR list_has_any(causes, ['imbalance_handling', 'too_little_data', 'unstable_model_rankings'])",
    "compare_on_cv": "fr.compare_on_cv OR list_has_any(causes, ['imbalance_handling', 'too_little_data', 'unstable_model_rankings'])",
    "prefer_simple_models": "fr.prefer_simple_models OR list_has_any(causes, ['too_little_data', 'unstable_model_rankings'])",
    "expand_model_diversity": "fr.expand_model_diversity OR list_has_any(causes, ['overly_simple_models', 'weak_features'])",
    "include_kernel_model": "fr.include_kernel_model OR list_has_any(causes, ['overly_simple_models', 'weak_features'])",
    "include_boosting": "fr.include_boosting OR list_has_any(causes, ['overly_simple_models', 'weak_features'])",
    "include_extra_trees": "fr.include_extra_trees OR list_has_any(causes, ['overly_simple_models', 'weak_features'])",
    "include_gradient_boosting": "fr.include_gradient_boosting OR list_has_any(causes, ['overly_simple_models', 'weak_features'])",
    "tune_decision_threshold": "fr.tune_decision_threshold OR (list_contains(causes, 'imbalance_handling') AND fr.classes_eff = 2)",
    "drop_high_missing_features": "fr.drop_high_missing_features OR list_contains(causes, 'preprocessing_mismatch')",
}


def _oracles():
    o = {}
    k = "run_id, attempt"
    o["model_spread"] = _diag(f"SELECT {k}, round(spread_best, 6) AS spread_best, round(spread_median, 6) AS spread_median, "
                              "round(spread_std, 6) AS spread_std, round(spread_range, 6) AS spread_range FROM dq")
    o["paired_t_five_folds"] = """WITH f AS (SELECT l_suppkey, l_orderkey % 5 AS fold, avg(CAST(l_discount AS DOUBLE)) - avg(CAST(l_tax AS DOUBLE)) AS d FROM lineitem GROUP BY 1, 2),
m AS (SELECT l_suppkey, avg(d) AS mean, avg(d) / (stddev_samp(d) / sqrt(5)) AS t FROM f GROUP BY 1),
th AS (SELECT *, atan(abs(t) / 2) AS a FROM m)
SELECT l_suppkey, true AS ttest_available, round(1 - sin(a) * (1 + cos(a) * cos(a) / 2), 6) AS ttest_p_value, round(mean, 6) AS cv_mean_gap FROM th"""
    o["paired_t_test"] = _diag(f"SELECT {k}, t_avail AS ttest_available, round(p_value, 6) AS ttest_p_value, "
                               "round(mean_gap, 6) AS ttest_mean_gap FROM dq")
    o["run_gaps"] = _diag(f"SELECT {k}, round(gain, 6) AS dummy_gain_balanced_accuracy, round(f1_gain, 6) AS dummy_gain_macro_f1, "
                          "round(rgap, 6) AS ranking_gap_to_runner_up, round(overfit, 6) AS train_test_gap_balanced_accuracy FROM dq")
    o["worst_class_recall"] = _diag(f"SELECT {k}, best_model, round(worst_class_recall, 6) AS worst_class_recall FROM dq")
    o["run_issues"] = _diag(f"SELECT {k}, status, array_to_string(issues, '|') AS issue_codes FROM dq")
    o["root_causes"] = _diag(f"SELECT {k}, array_to_string(causes, '|') AS root_causes, confidence FROM dq")
    o["suggestions_top3"] = _diag(f"SELECT {k}, array_to_string(list_slice(suggestions, 1, 3), '|') AS priority_actions, "
                                  "CAST(len(suggestions) AS BIGINT) AS n_suggestions FROM dq")
    o["replan_recommended"] = _diag(f"SELECT {k}, replan_recommended FROM dq")
    o["should_replan"] = _diag(f"SELECT {k}, should_replan FROM dq")
    newflags = ", ".join(f"({v}) AS {f}" for f, v in _NEWFLAGS.items())
    replan = f""",
{PLAN_CTE},
nf AS (SELECT dq.run_id, dq.attempt, dq.causes, pl.plan, {newflags.replace('fr.', 'pl.')},
  CAST(pl.replan_count + 1 AS BIGINT) AS replan_count FROM dq LEFT JOIN pl ON dq.run_id = pl.dataset_id)"""
    o["replan_flags"] = _diag(replan + f"\nSELECT {k}, " + ", ".join(FLAG_NAMES) + ", replan_count FROM nf")
    extra = _olist([("TRUE", s) for s in X.REPLAN_STEPS_FIXED] + [
        ("group_rare_categories", "group_rare_categories"), ("drop_high_missing_features", "drop_high_missing_columns"),
        ("enable_cv", "validate_with_cross_validation"), ("compare_on_cv", "rank_with_cv_stability"),
        ("expand_model_diversity", "expand_model_pool"), ("tune_decision_threshold", "tune_decision_thresholds")])
    np_ = f"list_concat({extra}, plan)"
    o["replan_steps"] = _diag(
        replan + f""",
np AS (SELECT run_id, attempt, {_distinct(np_)} AS new_plan FROM nf)
SELECT run_id, attempt, CAST(generate_subscripts(new_plan, 1) - 1 AS BIGINT) AS position, unnest(new_plan) AS step FROM np""")
    o["diagnose_runs"] = _diag(
        f"""SELECT {k}, best_model, status, confidence, array_to_string(issues, '|') AS issue_codes,
  array_to_string(causes, '|') AS root_causes, array_to_string(list_slice(suggestions, 1, 3), '|') AS priority_actions,
  replan_recommended, should_replan, round(bal, 6) AS best_balanced_accuracy, round(cv_std, 6) AS cv_balanced_accuracy_std
FROM dq""")
    o["attempt_history"] = _diag(f"SELECT {k}, best_model, round(bal, 6) AS balanced_accuracy, round(f1, 6) AS f1_macro, "
                                 "status AS reflection_status FROM dq")
    o["plan_steps"] = with_fixtures(
        f"""{FR_CTES},
{PLAN_CTE}
SELECT dataset_id, CAST(generate_subscripts(plan, 1) - 1 AS BIGINT) AS position, unnest(plan) AS step FROM pl""", "f5")
    o["runtime_flags"] = with_fixtures(
        f"{FR_CTES},\n{PLAN_CTE},\n{RT_CTE}\nSELECT dataset_id, "
        + ", ".join(f"rt_{f} AS {f}" for f in FLAG_NAMES) + " FROM rt", "f5")
    pool = _olist([
        ("TRUE", "DummyMostFrequent"), ("TRUE", "LogisticRegression"), ("TRUE", "RandomForest"),
        ("rt_include_extra_trees OR high_dimensional", "ExtraTrees"),
        ("rt_include_boosting AND rt_include_gradient_boosting AND n_rows >= 200 AND dominant_feature_type <> 'categorical'",
         "GradientBoosting"),
        ("high_dimensional OR dominant_feature_type = 'numeric' OR size_bucket IN ('tiny', 'small')", "LinearSVC"),
        ("n_rows <= 6000 AND greatest(feature_count, 1) <= 40 AND dominant_feature_type = 'numeric' AND NOT high_dimensional",
         "KNN"),
        ("rt_include_kernel_model AND n_rows <= 8000 AND greatest(feature_count, 1) <= 80 AND NOT high_cardinality_count > 0 "
         "AND coalesce(classes_eff, 0) <= 5", "SVC_RBF"),
        ("rt_expand_model_diversity AND dominant_feature_type <> 'categorical' AND n_rows <= 12000 "
         "AND greatest(feature_count, 1) <= 100", "SVC_LinearProb"),
    ])
    o["candidate_pool"] = with_fixtures(
        f"""{FR_CTES},
{PLAN_CTE},
{RT_CTE},
cp AS (SELECT dataset_id, list_sort({pool}) AS pool FROM rt)
SELECT dataset_id, CAST(generate_subscripts(pool, 1) - 1 AS BIGINT) AS position, unnest(pool) AS model FROM cp""", "f5")
    return o


ORACLES = _oracles()
