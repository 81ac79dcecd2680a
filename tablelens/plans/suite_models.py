"""Registered queries for the classifier pool (M1-M9, M11) and attempts.

Model scores have no form in SQL, but on the separable fixtures F9 and F10 every
sound candidate must predict the label itself, so the held-out rows with their
labels are an exact oracle.  Tree counts, rounds and cross-validation follow the
library's rules.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablelens.operators import diagnose as X
from tablelens.operators import history as H
from tablelens.operators import models as MD
from tablelens.operators import pool as PL
from tablelens.operators import split as D
from tablelens.operators.metrics import round_metrics
from tablelens.operators.prep import with_class_weight
from tablelens.plans import attempts as Z
from tablelens.plans import guided_run as GR
from tablelens.plans.fixtures import fixture, with_fixtures
from tablelens.plans.suite_diagnose import FR_CTES, f5_planned
from tablelens.session import checkpoint_dir

SEED = 42
F9_NUMERIC, F9_CATEGORICAL = ["vip", "x1", "x2", "x3", "x4", "x5"], ["segment"]
F10_NUMERIC = ["x1", "x2", "x3"]
_ATTEMPTS: dict = {}


def _prepared(spark, sf, name, numeric, categorical):
    """Train and test parts of a fixture, prepared, with balanced class weights."""
    df = fixture(spark, sf, name)
    split = D.stratified_split(df, "label", "row_key", 0.2, SEED)
    train, test = split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")
    n = df.count()
    prep = MD.fit_preparation(train, numeric, categorical, 0.0, True, n)
    labels = MD.label_values(df, "label")
    tr = with_class_weight(MD.index_labels(prep.transform(train), "label", labels), "label_idx", "weight")
    te = MD.index_labels(prep.transform(test), "label", labels)
    checkpoint_dir(spark)
    tr, te = MD.spread(tr.select("row_key", "features", "label_idx", "weight"), n), MD.spread(te, n)
    return tr.checkpoint(), te, labels, PL.model_settings(n, False)


def _model_query(name, fx="f9", numeric=F9_NUMERIC, categorical=F9_CATEGORICAL):
    def q(spark, sf):
        tr, te, labels, settings = _prepared(spark, sf, fx, numeric, categorical)
        weight = None if name == "GradientBoosting" else "weight"
        pr = MD.fit_predict(name, tr, te, settings, len(labels), "row_key", weight, SEED)
        return pr.select("row_key", MD.label_of(labels, F.col("prediction")).alias("prediction"))
    return q


def q_model_settings(spark, sf):
    p = f5_planned(spark, sf)
    return p.select("dataset_id", *MD.settings_columns(F.col("n_rows"), F.col("runtime_flags.prefer_simple_models")))


def q_predict_majority(spark, sf):
    split = D.stratified_split(fixture(spark, sf, "f2"), "label", "row_key", 0.2, SEED)
    train, test = split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")
    return MD.predict_majority(train, test, "label").select("row_key", "prediction")


def q_knn_vote(spark, sf):
    f4 = fixture(spark, sf, "f4")
    train, test = f4.filter(F.col("split") == "train"), f4.filter(F.col("split") == "test")
    k = 7 if train.count() > 1000 else 5
    return MD.knn_vote(train, test, "row_key", "embedding", "label", k)


def q_assembled_features(spark, sf):
    """Numeric block then one-hot block in one vector; size and non-zeros per test row."""
    from pyspark.ml.functions import vector_to_array

    f2 = fixture(spark, sf, "f2")
    split = D.stratified_split(f2, "label", "row_key", 0.2, SEED)
    train, test = split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")
    prep = MD.fit_preparation(train, ["o_totalprice", "c_acctbal"], ["o_orderpriority", "c_mktsegment"], 0.0, False,
                              f2.count())
    arr = vector_to_array(F.col("features"))
    return prep.transform(test).select("row_key", F.size(arr).alias("n_features"),
                                       F.size(F.filter(arr, lambda x: x != 0)).alias("n_nonzero"))


def _attempt(spark, sf, name):
    """One attempt on a fixture; its checkpointed results serve every query of the session that shows a part of it."""
    at = (spark.sparkContext.applicationId, sf, name)
    if at not in _ATTEMPTS:
        _ATTEMPTS[at] = Z.run_attempt(fixture(spark, sf, name), "label", "row_key", run_id=name, seed=SEED)
    return _ATTEMPTS[at]


def _guided(spark, sf):
    """A guided run on F9 with an empty history; its only attempt and its record serve three queries."""
    at = (spark.sparkContext.applicationId, sf, "guided")
    if at not in _ATTEMPTS:
        path = f"{checkpoint_dir(spark).rstrip('/')}/guided-{uuid.uuid4().hex}"
        run = GR.guided_run(fixture(spark, sf, "f9"), "auto", "row_key", path, run_id="f9", seed=SEED)
        _ATTEMPTS[at] = run, path
    return _ATTEMPTS[at]


def q_run_history_after_attempt(spark, sf):
    """What the history holds after the run."""
    run, path = _guided(spark, sf)
    return H.read_history(spark, path).select("run_id", "best_model", "best_score", "status", F.array_join("root_causes", "|").alias("root_causes"), "rows", "num_classes")


def q_pool_results(spark, sf):
    return round_metrics(_guided(spark, sf)[0].attempts[0].metrics.drop("cv_balanced_accuracy_scores"))


def q_pool_results_rare_class(spark, sf):
    """a class of two rows stays in training; the candidates must still name the others right."""
    return _attempt(spark, sf, "f10").metrics.select("model", "accuracy", "balanced_accuracy").filter(F.col("model") != "DummyMostFrequent")


def q_classification_attempt(spark, sf):
    a = _guided(spark, sf)[0].attempts[0]
    return a.diagnosis.select("run_id", "attempt", "best_model", "best_balanced_accuracy", "status", "confidence",
                              F.array_join("root_causes", "|").alias("root_causes"), "replan_recommended")


def q_reattempts(spark, sf):
    """Z2 on F12: a hopeless first attempt, changed flags, steps in front, a note, and the end because nothing was gained."""
    tried = Z.run(fixture(spark, sf, "f12"), "label", "row_key", run_id="f12", max_replans=3, candidates=["DummyMostFrequent", "KNN", "LogisticRegression"], seed=SEED)
    rows = None
    for a in tried:
        noted = [n for n in a.notes if n.startswith(X.REPLAN_NOTE)]
        row = a.diagnosis.select(
            "attempt", F.round("best_balanced_accuracy", 6).alias("best_balanced_accuracy"), "status", F.lit("|".join(a.plan[:3])).alias("first_steps"),
            F.lit(a.flags["replan_count"]).cast("int").alias("replan_count"), F.lit(a.flags["expand_model_diversity"]).alias("expand_model_diversity"),
            F.lit(len(noted)).alias("replan_notes"), F.lit(any("overly_simple_models" in n for n in noted)).alias("noted_simple_models"), F.lit(len(tried)).alias("attempts"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


QUERIES = {
    "reattempts": q_reattempts,
    "model_settings": q_model_settings,
    "predict_majority": q_predict_majority,
    "knn_vote": q_knn_vote,
    "model_logistic": _model_query("LogisticRegression"),
    "model_random_forest": _model_query("RandomForest"),
    "model_full_sample_forest": _model_query("ExtraTrees"),
    "model_gbt": _model_query("GradientBoosting"),
    "model_linear_svc": _model_query("LinearSVC"),
    "model_rff_svm": _model_query("SVC_RBF"),
    "model_calibrated_svm": _model_query("SVC_LinearProb"),
    "model_linear_svc_multiclass": _model_query("LinearSVC", "f10", F10_NUMERIC, []),
    "model_logistic_multiclass": _model_query("LogisticRegression", "f10", F10_NUMERIC, []),
    "model_random_forest_multiclass": _model_query("RandomForest", "f10", F10_NUMERIC, []),
    "model_gbt_multiclass": _model_query("GradientBoosting", "f10", F10_NUMERIC, []),
    "assembled_features": q_assembled_features,
    "pool_results": q_pool_results,
    "pool_results_rare_class": q_pool_results_rare_class,
    "run_history_after_attempt": q_run_history_after_attempt,
    "classification_attempt": q_classification_attempt,
}

_RT_PREFER_SIMPLE = ("prefer_simple_models OR list_contains(plan, 'prefer_simple_models') "
                     "OR list_contains(plan, 'limit_model_complexity')")


def _oracles():
    from tablelens.plans.suite_diagnose import PLAN_CTE
    o = {}
    o["model_settings"] = with_fixtures(
        f"""{FR_CTES},
{PLAN_CTE},
ps AS (SELECT dataset_id, n_rows, ({_RT_PREFER_SIMPLE}) AS simple FROM pl)
SELECT dataset_id, CASE WHEN n_rows >= 10000 THEN 250 ELSE 350 END AS forest_trees,
  CAST(CASE WHEN simple THEN 8 END AS DOUBLE) AS forest_max_depth, CASE WHEN n_rows < 1000 THEN 2 ELSE 1 END AS forest_min_leaf,
  CASE WHEN n_rows >= 5000 THEN 300 ELSE 400 END AS full_sample_trees, CAST(CASE WHEN simple THEN 10 END AS DOUBLE) AS full_sample_max_depth,
  CASE WHEN simple THEN 0.05 ELSE 0.1 END AS gbt_step, CASE WHEN n_rows >= 10000 THEN 100 ELSE 150 END AS gbt_rounds,
  CASE WHEN simple THEN 2 ELSE 3 END AS gbt_depth, CASE WHEN simple THEN 0.5 ELSE 1.0 END AS svc_c,
  CASE WHEN n_rows > 1000 THEN 7 ELSE 5 END AS knn_k FROM ps""", "f5")
    o["predict_majority"] = with_fixtures(
        f"""sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(concat('{SEED}', ':', CAST(row_key AS VARCHAR))), row_key)
       <= round(0.2 * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split FROM f2),
md AS (SELECT label FROM sp WHERE split = 'train' AND label IS NOT NULL GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
SELECT row_key, (SELECT label FROM md) AS prediction FROM sp WHERE split = 'test'""", "f2")
    o["knn_vote"] = with_fixtures(
        """tr AS (SELECT * FROM f4 WHERE split = 'train'), te AS (SELECT * FROM f4 WHERE split = 'test'),
k AS (SELECT CASE WHEN count(*) > 1000 THEN 7 ELSE 5 END AS k FROM tr),
d AS (SELECT te.row_key AS q, tr.row_key AS r, tr.label,
  list_sum(list_transform(range(1, len(te.embedding) + 1),
    lambda i: (CAST(te.embedding[i] AS DOUBLE) - CAST(tr.embedding[i] AS DOUBLE))
            * (CAST(te.embedding[i] AS DOUBLE) - CAST(tr.embedding[i] AS DOUBLE)))) AS dist FROM te, tr),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, r) AS rn FROM d) x, k WHERE rn <= k.k),
v AS (SELECT q, label, count(*) AS c FROM nn GROUP BY q, label)
SELECT q AS row_key, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY c DESC, label) AS rk FROM v) y WHERE rk = 1""", "f4")
    held = """sp AS (SELECT row_key, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(concat('{seed}', ':', CAST(row_key AS VARCHAR))), row_key)
       <= round(0.2 * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split FROM {fx})
""".replace("{seed}", str(SEED))
    right = "SELECT row_key, label AS prediction FROM sp WHERE split = 'test'"
    for name in ("logistic", "random_forest", "full_sample_forest", "gbt", "linear_svc", "rff_svm", "calibrated_svm"):
        o[f"model_{name}"] = with_fixtures(held.replace("{fx}", "f9") + right, "f9")
    for name in ("linear_svc", "logistic", "random_forest", "gbt"):
        o[f"model_{name}_multiclass"] = with_fixtures(held.replace("{fx}", "f10") + right, "f10")
    seen = "(SELECT count(*) AS n, count(CASE WHEN label = 'no' THEN 1 END) AS no, count(DISTINCT label) AS k FROM f9)"
    # every model but the majority one is right everywhere; ties go to the first by name, which is ExtraTrees
    o["classification_attempt"] = with_fixtures(
        f"""SELECT 'f9' AS run_id, 0 AS attempt, 'ExtraTrees' AS best_model, 1.0::DOUBLE AS best_balanced_accuracy, 'ok' AS status,
  CASE WHEN n < 4000 THEN 'high' ELSE 'medium' END AS confidence, 'data_quality|unstable_model_rankings' AS root_causes, false AS replan_recommended FROM {seen} s""", "f9")
    o["run_history_after_attempt"] = with_fixtures(
        f"""SELECT 'f9' AS run_id, 'ExtraTrees' AS best_model, 1.0::DOUBLE AS best_score, 'ok' AS status, 'data_quality|unstable_model_rankings' AS root_causes,
  n AS rows, k AS num_classes FROM {seen} s""", "f9")
    steps = X.REPLAN_STEPS_FIXED
    o["reattempts"] = with_fixtures(
        f"""SELECT CAST(i AS INTEGER) AS attempt, round(1.0 / k, 6)::DOUBLE AS best_balanced_accuracy, 'needs_attention' AS status,
  CASE WHEN i = 1 THEN '{"|".join(steps)}' ELSE 'profile_dataset|validate_target|check_for_data_leakage' END AS first_steps, CAST(i AS INTEGER) AS replan_count, i = 1 AS expand_model_diversity,
  CAST(i AS INTEGER) AS replan_notes, i = 1 AS noted_simple_models, 2 AS attempts FROM (SELECT count(DISTINCT label) AS k FROM f12) s, range(2) r(i)""", "f12")
    o["pool_results_rare_class"] = with_fixtures(
        f"""SELECT unnest(list_filter(['ExtraTrees', 'GradientBoosting', 'KNN', 'LinearSVC', 'LogisticRegression', 'RandomForest', 'SVC_RBF'],
    lambda m: (m <> 'KNN' OR n <= 6000) AND (m <> 'SVC_RBF' OR n <= 8000))) AS model,
  1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS balanced_accuracy FROM (SELECT count(*) AS n FROM f10) s""", "f10")
    o["assembled_features"] = with_fixtures(
        held.replace("{fx}", "f2").replace("row_key, label,", "*,") + """,
tr AS (SELECT * FROM sp WHERE split = 'train'),
st AS (SELECT avg(o_totalprice) AS mp, avg(c_acctbal) AS ma, count(DISTINCT o_orderpriority) AS np, count(DISTINCT c_mktsegment) AS nm FROM tr),
kp AS (SELECT DISTINCT o_orderpriority FROM tr), km AS (SELECT DISTINCT c_mktsegment FROM tr)
SELECT row_key, CAST(2 + np + nm AS INTEGER) AS n_features,
  CAST(CASE WHEN o_totalprice <> mp THEN 1 ELSE 0 END + CASE WHEN c_acctbal <> ma THEN 1 ELSE 0 END
     + CASE WHEN o_orderpriority IN (SELECT * FROM kp) THEN 1 ELSE 0 END + CASE WHEN c_mktsegment IN (SELECT * FROM km) THEN 1 ELSE 0 END AS INTEGER) AS n_nonzero
FROM sp, st WHERE split = 'test'""", "f2")
    return o


ORACLES = _oracles()
