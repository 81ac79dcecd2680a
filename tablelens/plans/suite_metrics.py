"""Registered queries for scores, thresholds, metrics (K1-K11) and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelens.functions.columns import r6
from tablelens.operators import metrics as K
from tablelens.operators import ranking as RK
from tablelens.operators.profile_rules import facts_rules
from tablelens.plans.fixtures import fixture, with_fixtures

RUN_MODEL = ["run_id", "model"]


# ------------------------------------------------------------------ shared inputs
def f7_metrics(spark, sf):
    """F7 with CV mean / population std / fold list derived from its three fold scores."""
    f7 = fixture(spark, sf, "f7")
    mean = (F.col("fold0") + F.col("fold1") + F.col("fold2")) / 3
    var = ((F.col("fold0") - mean) ** 2 + (F.col("fold1") - mean) ** 2 + (F.col("fold2") - mean) ** 2) / 3
    return (
        f7.withColumn("cv_balanced_accuracy_mean", mean)
        .withColumn("cv_balanced_accuracy_std", F.sqrt(var))
        .withColumn("cv_balanced_accuracy_scores",
                    F.when(F.col("fold0").isNotNull(), F.array("fold0", "fold1", "fold2")))
    )


def run_context(spark, sf):
    """Per run: F5 facts (dataset_id = run_id) with default flags.

    Joined by merging: the file's size says little about a side of one row per run with texts and flags.
    """
    f5 = facts_rules(fixture(spark, sf, "f5"))
    return f5.hint("merge").select(
        F.col("dataset_id").alias("run_id"),
        F.when(F.col("is_classification"), F.col("imbalance_ratio")).alias("imbalance_ratio"),
        F.col("strategy_flags.compare_on_cv").alias("compare_on_cv"),
        "n_rows", "missing_severity", "overall_missing", "high_cardinality_count", "weak_signal_risk",
        F.when(F.col("is_classification"), F.col("num_classes")).otherwise(F.lit(0)).alias("num_classes"),
        "strategy_flags",
    )


def f7_board(spark, sf):
    return RK.leaderboard(f7_metrics(spark, sf), run_context(spark, sf).select("run_id", "imbalance_ratio", "compare_on_cv"))


def _f6_test(spark, sf):
    return fixture(spark, sf, "f6").filter(F.col("split") == "test")


def _cs(spark, sf):
    return K.class_stats(K.confusion_counts(_f6_test(spark, sf), group_cols=RUN_MODEL), RUN_MODEL)


# ------------------------------------------------------------------ queries
def q_sigmoid_score(spark, sf):
    f1 = fixture(spark, sf, "f1")
    return f1.select("row_key", r6(K.sigmoid((F.col("score") - 0.5) * 10)).alias("score_sigmoid"))


def q_threshold_sweep(spark, sf):
    sw = K.threshold_sweep(fixture(spark, sf, "f1"), "label", "score", ["lang"])
    return sw.select("lang", "threshold", r6(F.col("balanced_accuracy")).alias("balanced_accuracy"))


def q_best_threshold(spark, sf):
    sw = K.threshold_sweep(fixture(spark, sf, "f1"), "label", "score", ["lang"])
    b = K.best_threshold(sw, ["lang"])
    return b.select("lang", "threshold", r6(F.col("balanced_accuracy")).alias("balanced_accuracy"))


def q_apply_threshold(spark, sf):
    f1 = fixture(spark, sf, "f1")
    best = K.best_threshold(K.threshold_sweep(f1, "label", "score", ["lang"]), ["lang"]).select("lang", "threshold")
    # one row per language: a bounded broadcast
    j = f1.join(F.broadcast(best), on="lang")
    return j.select("row_key", "lang", "label", K.apply_threshold(F.col("score"), F.col("threshold")).alias("prediction"))


def q_confusion_matrix(spark, sf):
    return K.confusion_counts(_f6_test(spark, sf), group_cols=RUN_MODEL)


def q_confusion_matrix_dense(spark, sf):
    return K.confusion_dense(K.confusion_counts(_f6_test(spark, sf), group_cols=RUN_MODEL), RUN_MODEL)


def _summary(spark, sf):
    return K.summary_metrics(_cs(spark, sf), RUN_MODEL)


def q_accuracy(spark, sf):
    return _summary(spark, sf).select(*RUN_MODEL, r6(F.col("accuracy")).alias("accuracy"))


def q_balanced_accuracy(spark, sf):
    return _summary(spark, sf).select(*RUN_MODEL, r6(F.col("balanced_accuracy")).alias("balanced_accuracy"))


def q_macro_metrics(spark, sf):
    s = _summary(spark, sf)
    return s.select(*RUN_MODEL, *[r6(F.col(c)).alias(c) for c in ("precision_macro", "recall_macro", "f1_macro")])


def q_classification_report(spark, sf):
    return K.round_metrics(K.classification_report(_cs(spark, sf), RUN_MODEL))


def _folds(spark, sf):
    train = fixture(spark, sf, "f6").filter(F.col("split") == "train")
    return K.cv_fold_metrics(train, RUN_MODEL)


def q_cv_fold_scores(spark, sf):
    return _folds(spark, sf).select(*RUN_MODEL, "fold", r6(F.col("balanced_accuracy")).alias("balanced_accuracy"))


def q_cv_summary(spark, sf):
    s = K.cv_summary(_folds(spark, sf), RUN_MODEL)
    return K.round_metrics(s.drop("cv_balanced_accuracy_scores"))


def q_metrics_by_model(spark, sf):
    return K.round_metrics(K.metrics_by_model(fixture(spark, sf, "f6")))


def q_primary_metric(spark, sf):
    ctx = run_context(spark, sf)
    return ctx.select("run_id", RK.primary_metric(F.col("imbalance_ratio")).alias("primary_metric"))


def q_leaderboard(spark, sf):
    return f7_board(spark, sf).select("run_id", "attempt", "model", "rank")


def q_best_model(spark, sf):
    b = RK.best_models(f7_board(spark, sf))
    return b.select("run_id", "attempt", "model", "primary_metric", r6(F.col("primary_value")).alias("primary_value"))


def q_selection_rationale(spark, sf):
    return K.round_metrics(RK.selection_rationale(f7_board(spark, sf)))


def q_evaluation_summary(spark, sf):
    f6 = fixture(spark, sf, "f6")
    mm = K.metrics_by_model(f6)
    cv = K.cv_summary(K.cv_fold_metrics(f6.filter(F.col("split") == "train"), RUN_MODEL), RUN_MODEL)
    m = mm.join(cv.drop("cv_balanced_accuracy_scores"), on=RUN_MODEL).withColumn("attempt", F.lit(0))
    ctx = run_context(spark, sf).select("run_id", "imbalance_ratio", "compare_on_cv")
    best = RK.best_models(RK.leaderboard(m, ctx)).select("run_id", "model", "primary_metric", "accuracy",
                                                          "balanced_accuracy", "f1_macro")
    rep = K.class_stats(K.confusion_counts(f6.filter(F.col("split") == "test"), group_cols=RUN_MODEL), RUN_MODEL)
    worst = rep.groupBy(*RUN_MODEL).agg(F.min("recall").alias("worst_class_recall"),
                                        F.count(F.lit(1)).alias("n_matrix_labels"))
    sizes = f6.groupBy("run_id", "model").agg(
        F.count(F.when(F.col("split") == "train", 1)).alias("train_rows"),
        F.count(F.when(F.col("split") == "test", 1)).alias("test_rows"),
    )
    out = best.join(worst, on=RUN_MODEL).join(sizes, on=RUN_MODEL)
    return K.round_metrics(out.withColumnRenamed("model", "best_model"))


QUERIES = {
    "sigmoid_score": q_sigmoid_score,
    "threshold_sweep": q_threshold_sweep,
    "best_threshold": q_best_threshold,
    "apply_threshold": q_apply_threshold,
    "confusion_matrix": q_confusion_matrix,
    "confusion_matrix_dense": q_confusion_matrix_dense,
    "accuracy": q_accuracy,
    "balanced_accuracy": q_balanced_accuracy,
    "macro_metrics": q_macro_metrics,
    "classification_report": q_classification_report,
    "cv_fold_scores": q_cv_fold_scores,
    "cv_summary": q_cv_summary,
    "metrics_by_model": q_metrics_by_model,
    "primary_metric": q_primary_metric,
    "leaderboard": q_leaderboard,
    "best_model": q_best_model,
    "selection_rationale": q_selection_rationale,
    "evaluation_summary": q_evaluation_summary,
}


# ------------------------------------------------------------------ oracle SQL pieces
def class_stats_ctes(src: str, groups: list[str], name: str = "cs") -> str:
    """CTEs cm_<name> (confusion counts) and <name> (per class precision/recall/f1) over ``src``."""
    g = ", ".join(groups)
    return f"""cm_{name} AS (SELECT {g}, label, prediction, count(*) AS n FROM {src} GROUP BY {g}, label, prediction),
x_{name} AS (
  SELECT {g}, class_label, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
    SELECT {g}, label AS class_label, n AS support, 0 AS predicted, CASE WHEN label = prediction THEN n ELSE 0 END AS tp FROM cm_{name}
    UNION ALL SELECT {g}, prediction, 0, n, 0 FROM cm_{name}) u
  GROUP BY {g}, class_label),
y_{name} AS (SELECT *, CASE WHEN predicted > 0 THEN tp * 1.0 / predicted ELSE 0.0 END AS precision,
                       CASE WHEN support > 0 THEN tp * 1.0 / support ELSE 0.0 END AS recall FROM x_{name}),
{name} AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
      FROM y_{name})"""


def summary_cte(cs: str, groups: list[str], name: str) -> str:
    g = ", ".join(groups)
    return f"""{name} AS (SELECT {g}, sum(tp) * 1.0 / sum(support) AS accuracy,
    avg(CASE WHEN support > 0 THEN recall END) AS balanced_accuracy, avg(f1) AS f1_macro,
    avg(precision) AS precision_macro, avg(recall) AS recall_macro FROM {cs} GROUP BY {g})"""


CTX_CTES = """r0 AS (SELECT *,
  CASE WHEN n_rows < 300 THEN 'tiny' WHEN n_rows < 3000 THEN 'small' WHEN n_rows < 30000 THEN 'medium' ELSE 'large' END AS size_bucket,
  CASE WHEN is_classification THEN minority_class_count ELSE 0 END AS minority_eff,
  CASE WHEN is_classification THEN imbalance_ratio END AS imbalance_eff
FROM f5),
ctx AS (SELECT dataset_id AS run_id, imbalance_eff AS imbalance_ratio,
  (size_bucket = 'tiny' OR coalesce(minority_eff, 0) < 15) AS compare_on_cv FROM r0)"""

F7M_CTE = """m7 AS (SELECT *, (fold0 + fold1 + fold2) / 3 AS cv_balanced_accuracy_mean,
  sqrt((power(fold0 - (fold0 + fold1 + fold2) / 3, 2) + power(fold1 - (fold0 + fold1 + fold2) / 3, 2)
        + power(fold2 - (fold0 + fold1 + fold2) / 3, 2)) / 3) AS cv_balanced_accuracy_std FROM f7)"""


def board_cte(metrics: str, groups: str = "run_id, attempt", name: str = "board") -> str:
    """Leaderboard CTE over ``metrics`` joined with ctx (same keys as the Spark side)."""
    return f"""b0_{name} AS (SELECT m.*, c.imbalance_ratio, c.compare_on_cv,
    CASE WHEN coalesce(c.imbalance_ratio, 1.0) >= 2.5 THEN 'balanced_accuracy' ELSE 'accuracy' END AS primary_metric
  FROM {metrics} m LEFT JOIN ctx c ON m.run_id = c.run_id),
b1_{name} AS (SELECT *, CASE WHEN primary_metric = 'balanced_accuracy' THEN balanced_accuracy ELSE accuracy END AS primary_value,
    coalesce(compare_on_cv, FALSE) AND cv_balanced_accuracy_mean IS NOT NULL AS use_cv FROM b0_{name}),
b2_{name} AS (SELECT *,
    row_number() OVER (PARTITION BY {groups} ORDER BY
      CASE WHEN use_cv THEN cv_balanced_accuracy_mean ELSE primary_value END DESC,
      CASE WHEN use_cv THEN primary_value ELSE f1_macro END DESC,
      CASE WHEN use_cv THEN f1_macro ELSE coalesce(cv_balanced_accuracy_mean, -1.0) END DESC, model) AS rank
  FROM b1_{name}),
{name} AS (SELECT *,
    row_number() OVER (PARTITION BY {groups} ORDER BY primary_value DESC, f1_macro DESC, rank) AS holdout_rank,
    row_number() OVER (PARTITION BY {groups} ORDER BY balanced_accuracy DESC, f1_macro DESC, rank) AS balanced_rank
  FROM b2_{name})"""


def _oracles():
    o = {}
    o["sigmoid_score"] = with_fixtures(
        "SELECT row_key, round(1.0 / (1.0 + exp(-((score - 0.5) * 10))), 6) AS score_sigmoid FROM f1", "f1"
    )
    grid = " UNION ALL ".join(f"SELECT CAST('{t!r}' AS DOUBLE) AS threshold" for t in K.THRESHOLDS)
    sweep = f"""g AS ({grid}),
pc AS (SELECT lang, label, g.threshold, count(*) AS n, sum(CASE WHEN score >= g.threshold THEN 1 ELSE 0 END) AS p
       FROM f1, g WHERE label IS NOT NULL GROUP BY lang, label, g.threshold),
sw AS (SELECT lang, threshold, avg(CASE WHEN label = 1 THEN p * 1.0 / n ELSE (n - p) * 1.0 / n END) AS balanced_accuracy
       FROM pc GROUP BY lang, threshold)"""
    o["threshold_sweep"] = with_fixtures(
        f"{sweep}\nSELECT lang, threshold, round(balanced_accuracy, 6) AS balanced_accuracy FROM sw", "f1"
    )
    best = """bt AS (SELECT lang, threshold, balanced_accuracy FROM (
   SELECT *, row_number() OVER (PARTITION BY lang ORDER BY balanced_accuracy DESC, threshold) AS rn FROM sw) x WHERE rn = 1)"""
    o["best_threshold"] = with_fixtures(
        f"{sweep},\n{best}\nSELECT lang, threshold, round(balanced_accuracy, 6) AS balanced_accuracy FROM bt", "f1"
    )
    o["apply_threshold"] = with_fixtures(
        f"{sweep},\n{best}\nSELECT f1.row_key, f1.lang, f1.label, CAST(f1.score >= bt.threshold AS INTEGER) AS prediction "
        "FROM f1 JOIN bt ON f1.lang = bt.lang",
        "f1",
    )
    t6 = "t6 AS (SELECT * FROM f6 WHERE split = 'test')"
    o["confusion_matrix"] = with_fixtures(
        f"{t6}\nSELECT run_id, model, label, prediction, count(*) AS n FROM t6 GROUP BY 1, 2, 3, 4", "f6"
    )
    o["confusion_matrix_dense"] = with_fixtures(
        f"""{t6},
cm AS (SELECT run_id, model, label, prediction, count(*) AS n FROM t6 GROUP BY 1, 2, 3, 4),
lb AS (SELECT DISTINCT run_id, model, label AS c FROM cm UNION SELECT DISTINCT run_id, model, prediction FROM cm)
SELECT a.run_id, a.model, a.c AS label, b.c AS prediction, CAST(coalesce(cm.n, 0) AS BIGINT) AS n
FROM lb a JOIN lb b ON a.run_id = b.run_id AND a.model = b.model
LEFT JOIN cm ON cm.run_id = a.run_id AND cm.model = a.model AND cm.label = a.c AND cm.prediction = b.c""",
        "f6",
    )
    base = f"{t6},\n{class_stats_ctes('t6', RUN_MODEL)},\n{summary_cte('cs', RUN_MODEL, 'sm')}"
    o["accuracy"] = with_fixtures(f"{base}\nSELECT run_id, model, round(accuracy, 6) AS accuracy FROM sm", "f6")
    o["balanced_accuracy"] = with_fixtures(
        f"{base}\nSELECT run_id, model, round(balanced_accuracy, 6) AS balanced_accuracy FROM sm", "f6"
    )
    o["macro_metrics"] = with_fixtures(
        f"{base}\nSELECT run_id, model, round(precision_macro, 6) AS precision_macro, round(recall_macro, 6) AS recall_macro, "
        "round(f1_macro, 6) AS f1_macro FROM sm",
        "f6",
    )
    o["classification_report"] = with_fixtures(
        f"""{base}
SELECT run_id, model, class_label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1_score,
       CAST(support AS BIGINT) AS support FROM cs
UNION ALL
SELECT run_id, model, k.class_label, round(k.p, 6), round(k.r, 6), round(k.f, 6), CAST(total AS BIGINT) FROM (
  SELECT run_id, model, sum(support) AS total, sum(tp) * 1.0 / sum(support) AS acc, avg(precision) AS mp, avg(recall) AS mr,
         avg(f1) AS mf, sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
         sum(f1 * support) / sum(support) AS wf FROM cs GROUP BY run_id, model) t,
  LATERAL (SELECT 'accuracy' AS class_label, NULL::DOUBLE AS p, NULL::DOUBLE AS r, acc AS f
           UNION ALL SELECT 'macro avg', mp, mr, mf UNION ALL SELECT 'weighted avg', wp, wr, wf) k""",
        "f6",
    )
    rmf = RUN_MODEL + ["fold"]
    folds = f"tr6 AS (SELECT * FROM f6 WHERE split = 'train'),\n{class_stats_ctes('tr6', rmf, 'fcs')},\n{summary_cte('fcs', rmf, 'fm')}"
    o["cv_fold_scores"] = with_fixtures(
        f"{folds}\nSELECT run_id, model, fold, round(balanced_accuracy, 6) AS balanced_accuracy FROM fm", "f6"
    )
    o["cv_summary"] = with_fixtures(
        f"""{folds}
SELECT run_id, model, round(avg(balanced_accuracy), 6) AS cv_balanced_accuracy_mean,
  round(stddev_pop(balanced_accuracy), 6) AS cv_balanced_accuracy_std, round(avg(f1_macro), 6) AS cv_f1_macro_mean,
  round(avg(accuracy), 6) AS cv_accuracy_mean FROM fm GROUP BY run_id, model""",
        "f6",
    )
    rms = RUN_MODEL + ["split"]
    mbm = f"""{class_stats_ctes('f6', rms, 'mcs')},
{summary_cte('mcs', rms, 'msm')},
mbm AS (SELECT run_id, model,
  max(CASE WHEN split = 'test' THEN accuracy END) AS accuracy,
  max(CASE WHEN split = 'test' THEN balanced_accuracy END) AS balanced_accuracy,
  max(CASE WHEN split = 'test' THEN f1_macro END) AS f1_macro,
  max(CASE WHEN split = 'test' THEN precision_macro END) AS precision_macro,
  max(CASE WHEN split = 'test' THEN recall_macro END) AS recall_macro,
  max(CASE WHEN split = 'train' THEN balanced_accuracy END) AS train_balanced_accuracy,
  max(CASE WHEN split = 'train' THEN f1_macro END) AS train_f1_macro
FROM msm GROUP BY run_id, model)"""
    o["metrics_by_model"] = with_fixtures(
        f"{mbm}\nSELECT run_id, model, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in ["accuracy", "balanced_accuracy", "f1_macro", "precision_macro",
                                                      "recall_macro", "train_balanced_accuracy", "train_f1_macro"])
        + " FROM mbm",
        "f6",
    )
    o["primary_metric"] = with_fixtures(
        f"{CTX_CTES}\nSELECT run_id, CASE WHEN coalesce(imbalance_ratio, 1.0) >= 2.5 THEN 'balanced_accuracy' "
        "ELSE 'accuracy' END AS primary_metric FROM ctx",
        "f5",
    )
    bsql = f"{CTX_CTES},\n{F7M_CTE},\n{board_cte('m7')}"
    o["leaderboard"] = with_fixtures(f"{bsql}\nSELECT run_id, attempt, model, rank FROM board", "f5", "f7")
    o["best_model"] = with_fixtures(
        f"{bsql}\nSELECT run_id, attempt, model, primary_metric, round(primary_value, 6) AS primary_value FROM board WHERE rank = 1",
        "f5", "f7",
    )
    o["selection_rationale"] = with_fixtures(
        f"""{bsql},
sr AS (SELECT run_id, attempt,
  max(CASE WHEN rank = 1 THEN model END) AS selected_model, max(primary_metric) AS primary_metric,
  CAST(max(CAST(coalesce(compare_on_cv, FALSE) AS INTEGER)) AS BOOLEAN) AS compare_on_cv,
  max(CASE WHEN rank = 1 THEN primary_value END) AS best_primary_metric,
  max(CASE WHEN rank = 1 THEN cv_balanced_accuracy_mean END) AS best_cv_balanced_accuracy_mean,
  max(CASE WHEN rank = 1 THEN cv_balanced_accuracy_std END) AS best_cv_balanced_accuracy_std,
  max(CASE WHEN rank = 1 THEN balanced_accuracy END) AS best_bal,
  max(CASE WHEN holdout_rank = 2 THEN model END) AS runner_up_model,
  max(CASE WHEN holdout_rank = 2 THEN primary_value END) AS runner_up_primary_metric,
  max(CASE WHEN holdout_rank = 2 THEN cv_balanced_accuracy_mean END) AS runner_up_cv_balanced_accuracy_mean,
  arg_min(CASE WHEN model LIKE 'Dummy%' THEN balanced_accuracy END, CASE WHEN model LIKE 'Dummy%' THEN rank END) AS dummy_balanced_accuracy
FROM board GROUP BY run_id, attempt)
SELECT run_id, attempt, selected_model, primary_metric, compare_on_cv,
  CASE WHEN compare_on_cv THEN 'cv_first_then_holdout' ELSE 'holdout_first_then_cv' END AS selection_policy,
  round(best_primary_metric, 6) AS best_primary_metric, round(best_cv_balanced_accuracy_mean, 6) AS best_cv_balanced_accuracy_mean,
  round(best_cv_balanced_accuracy_std, 6) AS best_cv_balanced_accuracy_std, runner_up_model,
  round(runner_up_primary_metric, 6) AS runner_up_primary_metric,
  round(runner_up_cv_balanced_accuracy_mean, 6) AS runner_up_cv_balanced_accuracy_mean,
  round(dummy_balanced_accuracy, 6) AS dummy_balanced_accuracy,
  round(best_bal - dummy_balanced_accuracy, 6) AS dummy_gain_balanced_accuracy,
  CASE WHEN compare_on_cv THEN '{RK.SUMMARY_CV}' ELSE '{RK.SUMMARY_HOLDOUT}' END AS human_summary
FROM sr""",
        "f5", "f7",
    )
    o["evaluation_summary"] = with_fixtures(
        f"""{CTX_CTES},
{folds},
{mbm},
cv AS (SELECT run_id, model, avg(balanced_accuracy) AS cv_balanced_accuracy_mean FROM fm GROUP BY run_id, model),
em AS (SELECT mbm.*, cv.cv_balanced_accuracy_mean, 0 AS attempt FROM mbm JOIN cv USING (run_id, model)),
{board_cte('em', 'run_id', 'eb')},
t6 AS (SELECT * FROM f6 WHERE split = 'test'),
{class_stats_ctes('t6', RUN_MODEL, 'ecs')},
wr AS (SELECT run_id, model, min(recall) AS worst_class_recall, count(*) AS n_matrix_labels FROM ecs GROUP BY run_id, model),
sz AS (SELECT run_id, model, count(CASE WHEN split = 'train' THEN 1 END) AS train_rows,
              count(CASE WHEN split = 'test' THEN 1 END) AS test_rows FROM f6 GROUP BY run_id, model)
SELECT eb.run_id, eb.model AS best_model, eb.primary_metric, round(eb.accuracy, 6) AS accuracy,
  round(eb.balanced_accuracy, 6) AS balanced_accuracy, round(eb.f1_macro, 6) AS f1_macro,
  round(wr.worst_class_recall, 6) AS worst_class_recall, wr.n_matrix_labels, sz.train_rows, sz.test_rows
FROM eb JOIN wr USING (run_id, model) JOIN sz USING (run_id, model) WHERE eb.rank = 1""",
        "f5", "f6",
    )
    return o


ORACLES = _oracles()
