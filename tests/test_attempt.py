"""One attempt end to end on the smallest scale (few candidates, with CV), and the re-attempt decision."""

from pyspark.sql import functions as F

from tablelens.plans import attempts as Z
from tablelens.plans.fixtures import fixture

SF = "/root/testdata/sf0.01"


def test_attempt_with_cv(spark):
    f1 = fixture(spark, SF, "f1")
    a = Z.run_attempt(f1, "label", "row_key", run_id="t", with_cv=True,
                      candidates=["DummyMostFrequent", "LogisticRegression", "KNN"])
    m = {r["model"]: r for r in a.metrics.collect()}
    assert set(m) == {"DummyMostFrequent", "LogisticRegression", "KNN"}
    assert m["LogisticRegression"]["cv_balanced_accuracy_mean"] is not None
    assert len(m["LogisticRegression"]["cv_balanced_accuracy_scores"]) == 3
    assert m["DummyMostFrequent"]["balanced_accuracy"] == 0.5
    # F1's score column carries label information: fitted models must beat the majority baseline
    assert m["LogisticRegression"]["balanced_accuracy"] > 0.6
    assert m["KNN"]["balanced_accuracy"] > 0.5
    d = a.diagnosis.first()
    assert d["best_model"] in m
    assert d["status"] in ("ok", "needs_attention")
    per_model = a.predictions.filter(F.col("split") == "test").groupBy("model").count().collect()
    assert len({r["count"] for r in per_model}) == 1 and len(per_model) == 3


def test_a_given_key_that_repeats_is_no_feature(spark):
    rows = [(i // 2, float(i * 7919 % 1000), "a" if i < 120 else "b") for i in range(240)]
    df = spark.createDataFrame(rows, "k long, x double, label string")
    a = Z.run_attempt(df, "label", "k", run_id="k", with_cv=False, candidates=["DummyMostFrequent", "RandomForest"])
    assert a.profile["feature_count"] == 1
    m = {r["model"]: r["balanced_accuracy"] for r in a.metrics.collect()}
    assert m["RandomForest"] < 0.8  # the key would tell the label


def test_reattempts_extend_the_plan_until_nothing_is_gained(spark):
    df = spark.createDataFrame([(i, 1.0, "ab"[i % 3 == 0]) for i in range(120)], "k long, x double, label string")
    atts = Z.run(df, "label", "k", run_id="z2", max_replans=3, with_cv=False, candidates=["DummyMostFrequent", "LogisticRegression"])
    assert len(atts) == 2  # the second gains nothing
    assert atts[1].plan[:3] == ["apply_replanned_strategy", "rebuild_preprocessor", "reselect_models"]
    assert (atts[0].flags["replan_count"], atts[1].flags["replan_count"]) == (0, 1)
    assert len(atts[1].notes) == len(atts[0].notes) + 1 and "overly_simple_models" in atts[1].notes[-1]
