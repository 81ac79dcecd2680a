"""Golden vectors taken from the reference's own unit tests, run through the column rules."""

import pytest
from pyspark.sql import functions as F

from tablelens.operators import diagnose as X
from tablelens.operators import history as H
from tablelens.operators import ranking as RK
from tablelens.operators import steps as L
from tablelens.operators.profile_rules import FLAG_NAMES, facts_rules

FACT_SCHEMA = (
    "dataset_id long, n_rows long, feature_count long, numeric_ratio double, categorical_ratio double, "
    "overall_missing double, max_missing double, high_cardinality_count long, num_classes long, "
    "imbalance_ratio double, minority_class_count long, target_confidence string, is_classification boolean"
)


def _plan(spark, row, preferred=None):
    df = spark.createDataFrame([row], FACT_SCHEMA)
    f = facts_rules(df)
    # the reference test passes an empty flag dict: the planner falls back to its defaults
    empty = F.struct(*[F.lit(None).cast("boolean").alias(k) for k in FLAG_NAMES], F.lit(0).alias("replan_count"))
    p = L.plan_inputs(f.withColumn("strategy_flags", empty))
    pref = F.array(*[F.lit(m) for m in preferred]) if preferred else None
    return p.select(L.plan_steps(p, preferred=pref).alias("plan")).first()["plan"]


def test_planner_imbalance_and_high_cardinality(spark):
    # 1200 rows x 18 cols, imbalance 5.2, missing 8/20 (medium), one high-card feature, mixed, binary
    plan = _plan(spark, (1, 1200, 17, 0.5, 0.5, 8.0, 20.0, 1, 2, 5.2, 100, "high", True))
    for step in ["activate_imbalance_strategy", "control_high_cardinality", "audit_missingness",
                 "tune_decision_thresholds"]:
        assert step in plan
    assert plan.index("train_candidate_models") < plan.index("tune_decision_thresholds")
    assert plan.index("audit_missingness") < plan.index("build_preprocessor")


def test_planner_tiny_with_memory(spark):
    plan = _plan(spark, (2, 120, 9, 1.0, 0.0, 0.0, 0.0, 0, 2, 1.4, 50, "low", True), preferred=["RandomForest"])
    for step in ["guard_against_tiny_sample", "validate_with_cross_validation", "confirm_target_assumption",
                 "prioritise_models_from_memory", "memory_priority::RandomForest"]:
        assert step in plan
    assert plan[-1] == "memory_priority::RandomForest"
    assert len(plan) == len(set(plan))


def test_reflector_weak_signal_vector(spark):
    board = spark.createDataFrame(
        [
            ("r", 0, "RandomForest", 0.84, 0.56, 0.49, 0.88, 0.55, 0.06, [0.54, 0.57, 0.54], 1, 1),
            ("r", 0, "LogisticRegression", 0.0, 0.55, 0.48, 0.0, None, None, None, 2, 2),
            ("r", 0, "DummyMostFrequent", 0.0, 0.50, 0.45, 0.0, None, None, None, 3, 3),
        ],
        "run_id string, attempt int, model string, accuracy double, balanced_accuracy double, f1_macro double, "
        "train_balanced_accuracy double, cv_balanced_accuracy_mean double, cv_balanced_accuracy_std double, "
        "cv_balanced_accuracy_scores array<double>, rank long, balanced_rank long",
    )
    ctx = spark.createDataFrame(
        [("r", 4.0, 2000, "high", 15.0, 1, True, 2)],
        "run_id string, imbalance_ratio double, n_rows long, missing_severity string, overall_missing double, "
        "high_cardinality_count long, weak_signal_risk boolean, num_classes long",
    )
    worst = spark.createDataFrame([("r", 0, 0.20)], "run_id string, attempt int, worst_class_recall double")
    d = X.should_replan(X.diagnose(X.run_summary(board), ctx, worst), max_replans=1).first()
    assert d["status"] == "needs_attention"
    assert d["replan_recommended"] is True
    assert list(d["root_causes"]) == ["imbalance_handling", "preprocessing_mismatch", "data_quality",
                                      "unstable_model_rankings", "weak_features"]
    assert d["should_replan"] is True


def test_replan_flags_and_steps(spark):
    flags = {k: False for k in FLAG_NAMES}
    flags.update(include_boosting=True, include_extra_trees=True, include_gradient_boosting=True)
    schema = "f struct<" + ",".join(f"{k}:boolean" for k in FLAG_NAMES) + ",replan_count:int>, c array<string>, p array<string>"
    row = spark.createDataFrame(
        [({**flags, "replan_count": 0}, ["imbalance_handling", "preprocessing_mismatch", "weak_features"],
          ["profile_dataset", "select_models", "train_candidate_models", "reflect"])], schema)
    out = row.select(X.replan_flags(F.col("f"), F.col("c"), F.lit(2)).alias("nf"), "p") \
        .select("nf", X.replan_steps(F.col("nf"), F.col("p")).alias("np")).first()
    nf = out["nf"]
    assert nf["use_class_weight"] and nf["group_rare_categories"] and nf["enable_cv"] and nf["tune_decision_threshold"]
    assert nf["replan_count"] == 1
    assert out["np"][:3] == ["apply_replanned_strategy", "rebuild_preprocessor", "reselect_models"]
    assert "expand_model_pool" in out["np"]


def test_similarity_golden(spark):
    sig = "struct<numeric_ratio:double,size_bucket:string,missing_severity:string,dominant_feature_type:string," \
          "imbalance_ratio:double,num_classes:bigint,high_dimensional:boolean,high_cardinality_count:bigint," \
          "weak_signal_risk:boolean>"
    a = (0.5, "medium", "medium", "mixed", 3.8, 2, False, 2, False)
    b = (0.4, "medium", "medium", "mixed", 4.0, 2, False, 2, False)
    df = spark.createDataFrame([(a, b), (a, a)], f"a {sig}, b {sig}")
    vals = [r[0] for r in df.select(H.similarity_expr("a", "b")).collect()]
    assert vals[0] == pytest.approx(11.7625 / 12.0)
    assert vals[1] == pytest.approx(1.0)


def test_order_candidates_without_history_is_alphabetical(spark):
    c = spark.createDataFrame([(1, m) for m in ["RandomForest", "KNN", "DummyMostFrequent"]], "dataset_id long, model string")
    got = [r["model"] for r in RK.order_candidates(c).orderBy("candidate_order").collect()]
    assert got == ["DummyMostFrequent", "KNN", "RandomForest"]


def test_csv_tokens_and_inference(spark):
    from tablelens.sources.csv import infer_types, normalise_missing_tokens

    df = spark.createDataFrame(
        [("1", "1", "x", "true", "2.5"), ("2", "NA", "n/a", "False", ""), ("3", "3", "y", "true", "4")],
        "a string, b string, c string, d string, e string",
    )
    out = infer_types(normalise_missing_tokens(df))
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types == {"a": "bigint", "b": "double", "c": "string", "d": "boolean", "e": "double"}
    assert [r["c"] for r in out.orderBy("a").collect()] == ["x", None, "y"]


def test_guards_and_split_fallback(spark):
    import math

    from tablelens.operators import profile as P
    from tablelens.operators import split as D
    from tablelens.operators import target as TG

    df = spark.createDataFrame([(i, "a" if i < 39 else "b", float(i)) for i in range(40)], "k long, y string, x double")
    with pytest.raises(ValueError):
        P.profile_dataset(df, "missing_target")
    with pytest.raises(ValueError):
        TG.resolve_target(df, "nope")
    assert TG.resolve_target(df, " AUTO ")[0] in df.columns
    # class 'b' has one row: the holdout is not stratified and takes ceil(n * f) test rows
    out, stratified = D.holdout_split(df, "y", "k", 0.2, 42)
    assert stratified is False
    assert out.filter(F.col("split") == "test").count() == math.ceil(40 * 0.2)


def test_two_sided_t_by_integration(spark):
    import math

    import numpy as np

    from tablelens.operators.diagnose import t_two_sided

    points = [(t, df) for df in [*range(1, 31), 61, 200] for t in (0.0, 0.3, -1.0, 2.0, 5.0)]
    got = spark.createDataFrame(points, "t double, df int").select("t", "df", t_two_sided(F.col("t"), F.col("df")).alias("p")).collect()
    for r in got:
        x = np.linspace(0, abs(r["t"]), 20001)
        scale = math.exp(math.lgamma((r["df"] + 1) / 2) - math.lgamma(r["df"] / 2)) / math.sqrt(r["df"] * math.pi)
        y = scale * (1 + x * x / r["df"]) ** (-(r["df"] + 1) / 2)
        assert abs(r["p"] - (1 - 2 * np.trapezoid(y, x))) < 1e-8, r


def test_target_record(spark):
    from tablelens.operators.target import target_record

    df = spark.createDataFrame([(i, i * 0.5, "ab"[i % 2]) for i in range(40)], "n long, x double, kind string")
    assert target_record(df, "x") == {"target": "x", "confidence": "high", "method": "given", "candidates": ["x"]}
    found = target_record(df, " AUTO ")
    assert (found["target"], found["method"]) == ("kind", "heuristic_score") and len(found["candidates"]) == 3
    # the first known name in priority order wins, in any case; of case variants the last column
    assert target_record(df.selectExpr("n as Class", "x as LABEL", "kind as y", "n as label"), "auto")["target"] == "label"
