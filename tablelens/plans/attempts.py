"""One classification attempt (Z1) and the re-attempt loop.

A thin driver loop: every step is a distributed job (profile aggregate, hash
split, preparation statistics, MLlib fits, metric aggregates, rule columns).
Only one-row results (the profile, the step list, the decision) reach the
driver; predictions, metrics and diagnoses stay DataFrames.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.operators import diagnose as X
from tablelens.operators import metrics as K
from tablelens.operators import models as MD
from tablelens.operators import pool as PL
from tablelens.operators import prep as E
from tablelens.operators import profile as P
from tablelens.operators import ranking as RK
from tablelens.operators import split as D
from tablelens.operators import steps as L
from tablelens.operators.profile_rules import FLAG_NAMES
from tablelens.session import checkpoint_dir

ROW_KEY = "_row_key"


@dataclass
class Attempt:
    profile: dict
    plan: list
    flags: dict
    candidates: list
    predictions: DataFrame
    metrics: DataFrame
    board: DataFrame
    diagnosis: DataFrame
    failures: list = field(default_factory=list)
    split_info: dict = field(default_factory=dict)
    labels: list = field(default_factory=list)
    notes: list = field(default_factory=list)


def _profile_row(df: DataFrame, target: str, confidence: str, columns) -> tuple[DataFrame, dict]:
    prof = P.profile_dataset(df, target, target_confidence=confidence, columns=columns)
    return prof, prof.first().asDict(recursive=True)  # one row


def with_row_key(df: DataFrame, key: str | None) -> tuple[DataFrame, str]:
    """The table and a unique, non-NULL key column: the named one if it is that, else row numbers fixed by a checkpoint."""
    if key is not None:
        c = df.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("present"), F.count_distinct(key).alias("d")).first()
        if c["n"] == c["present"] == c["d"]:
            return df, key
    checkpoint_dir(df.sparkSession)
    return df.withColumn(ROW_KEY, F.monotonically_increasing_id()).checkpoint(), ROW_KEY


def run_attempt(df: DataFrame, target: str, key: str | None = None, run_id: str = "run", attempt: int = 0, flags: dict | None = None,
                plan: list | None = None, confidence: str = "high", seed: int = 42, test_size: float = 0.2,
                with_cv: bool | None = None, candidates: list | None = None, preferred: list | None = None,
                avoid: list | None = None, best_model: str | None = None, has_performance: bool = False,
                parallelism: int = 8) -> Attempt:
    """Flags -> preparation -> pool -> train -> evaluate -> diagnose.

    ``preferred``/``avoid``/``best_model`` come from the history and order the
    candidates.  Independent fits run side by side (``parallelism`` at a time):
    on small tables a fit waits for the scheduler more than it computes.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    names = [c for c in df.columns if c not in (key, ROW_KEY)]  # the key is no feature
    df, key = with_row_key(df, key)
    prof_df, prof = _profile_row(df, target, confidence, names)
    base_flags = flags or prof["strategy_flags"]
    flags_col = F.struct(*[F.lit(base_flags[k]).alias(k) for k in FLAG_NAMES],
                         F.lit(int(base_flags.get("replan_count", 0))).alias("replan_count"))
    p = L.plan_inputs(prof_df.withColumn("strategy_flags", flags_col))
    strings = lambda xs: F.array(*[F.lit(x) for x in xs or []]).cast("array<string>")
    if plan is None:
        plan = p.select(L.plan_steps(p, strings(preferred), strings(avoid), F.lit(has_performance)).alias("plan")).first()["plan"]
    plan_arr = F.array(*[F.lit(s) for s in plan])
    rt = p.select(L.runtime_flags(F.col("strategy_flags"), plan_arr).alias("rt")).first()["rt"].asDict()
    rows = prof["n_rows"]
    if candidates is None:
        pool_col = PL.candidate_pool(F.col("n_rows"), F.col("feature_count"), F.col("dominant_feature_type"),
                                     F.col("high_dimensional"), F.col("high_cardinality_count"), F.col("num_classes"),
                                     F.col("size_bucket"), F.struct(*[F.lit(v).alias(k) for k, v in rt.items()]))
        candidates = p.select(pool_col.alias("pool")).first()["pool"]
    ranks = {m: i for i, m in enumerate(dict.fromkeys([*([best_model] if best_model else []), *(preferred or [])]))}
    candidates = sorted(candidates, key=lambda m: (m in (avoid or []), ranks.get(m, len(ranks) + 10), m))
    settings = PL.model_settings(rows, bool(rt["prefer_simple_models"]))

    labelled = P.filter_labelled_rows(df, target)
    labels = MD.label_values(labelled, target)
    if len(labels) < 2:
        raise ValueError(f"classification needs two classes at least; {target!r} has {len(labels)}")
    n_classes = len(labels)
    split, stratified = D.holdout_split(labelled, target, key, test_size, seed)
    split = split.checkpoint()
    train, test = split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")
    kinds = [(c, k) for c, k in P.feature_kinds(df, target) if c in names]  # a given key that repeats is no feature either
    numeric = [c for c, k in kinds if k == "numeric"]
    categorical = [c for c, k in kinds if k == "categorical"]
    group_rare = bool(rt["group_rare_categories"]) or prof["high_cardinality_count"] > 0
    prepared = MD.fit_preparation(train, numeric, categorical, prof["max_missing"], group_rare, rows)
    tr = MD.index_labels(prepared.transform(train), target, labels)
    te = MD.index_labels(prepared.transform(test), target, labels)
    weight_col = None
    imb = prof["imbalance_ratio"] or 1.0
    if rt["use_class_weight"] or imb >= 3.0:
        tr = E.with_class_weight(tr, "label_idx", "weight")
        weight_col = "weight"
    # every candidate refits on these frames: cut their lineage in the shared checkpoint folder
    keep = [key, "features", "label_idx"]
    tr, te = (MD.spread(x, rows).checkpoint() for x in (tr.select(*keep, *([weight_col] if weight_col else [])), te.select(*keep)))

    if with_cv is None:
        with_cv = bool(rt["enable_cv"]) or rows < 4000
    min_train_class = tr.groupBy("label_idx").count().agg(F.min("count")).first()[0]
    folds = MD.spread(D.stratified_folds(tr, "label_idx", key, 3, seed), rows).checkpoint() if with_cv and min_train_class >= 3 else None
    binary = n_classes == 2
    scored = [key, "label_idx", "prediction", "score"]

    def knn(fit_part, evs, threshold):
        vt = fit_part.withColumn("vec", vector_to_array("features"))
        outs = []
        for ev in evs:
            got = MD.knn_vote(vt, ev.withColumn("vec", vector_to_array("features")), key, "vec", "label_idx", settings["knn_k"],
                              positive=1.0 if binary else None)
            if not binary:
                got = got.withColumn("score", F.lit(None).cast("double"))
            if threshold is not None:
                got = got.withColumn("prediction", (F.col("score") >= F.lit(threshold)).cast("double"))
            outs.append(ev.select(key, "label_idx").join(got, on=key).select(*scored))
        return outs

    def majority(fit_part, evs, threshold):
        return [MD.predict_majority(fit_part, ev, "label_idx").withColumn("score", F.lit(None).cast("double")).select(*scored) for ev in evs]

    def fitted(name, fit_part, evs, tune):
        """One fit, all evaluation parts, written before the candidate counts as done; the threshold if one was tuned."""
        predict = {"DummyMostFrequent": majority, "KNN": knn}.get(name) or (
            lambda fit_part, evs, threshold: [x.select(*scored) for x in MD.fit_predict(name, fit_part, evs, settings, n_classes, key, weight_col, seed, threshold)])
        threshold = None
        if tune and rt["tune_decision_threshold"] and binary and name != "DummyMostFrequent":
            vsplit = MD.spread(D.validation_split(fit_part, "label_idx", key, seed), rows).checkpoint()
            sub = vsplit.filter(F.col("split") == "fit").drop("split")
            valid = vsplit.filter(F.col("split") == "valid").drop("split")
            best = K.best_threshold(K.threshold_sweep(predict(sub, [valid], None)[0], "label_idx", "score")).first()
            threshold = float(best["threshold"]) if best else 0.5
        return [x.checkpoint() for x in predict(fit_part, evs, threshold)], threshold

    jobs = [(name, None) for name in candidates] + ([(name, k) for name in candidates for k in range(3)] if folds is not None else [])

    def work(job):
        name, k = job
        try:
            if k is None:
                return job, fitted(name, tr, [tr, te], True), None
            return job, fitted(name, folds.filter(F.col("fold") != k).drop("fold"), [folds.filter(F.col("fold") == k).drop("fold")], False), None
        except Exception as exc:  # noqa: BLE001 - a failing candidate is recorded, the rest go on
            return job, None, f"{type(exc).__name__}: {exc}"

    with ThreadPoolExecutor(parallelism) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(work), jobs))
    failed = {name: error for (name, _), _, error in reversed(done) if error}
    failures = [{"model": m, "error": failed[m]} for m in candidates if m in failed]
    if len(failed) == len(candidates):
        raise RuntimeError(f"no candidate could be fitted: {failures}")
    preds, fold_preds, thresholds = [], [], {}
    for (name, k), got, _ in done:
        if name in failed:
            continue
        if k is None:
            thresholds[name] = got[1]
            preds += [x.withColumn("split", F.lit(part)).withColumn("model", F.lit(name)) for part, x in zip(("train", "test"), got[0], strict=True)]
        else:
            fold_preds.append(got[0][0].withColumn("fold", F.lit(k)).withColumn("model", F.lit(name)))

    def union(parts):
        out = parts[0]
        for p_ in parts[1:]:
            out = out.unionByName(p_)
        return out.withColumn("run_id", F.lit(run_id)).withColumn("attempt", F.lit(attempt)) \
            .withColumn("label", F.col("label_idx"))

    pred = union(preds)
    metrics = K.metrics_by_model(pred, group_cols=("run_id", "attempt", "model"))
    if fold_preds:
        cv = K.cv_summary(K.cv_fold_metrics(union(fold_preds), ("run_id", "attempt", "model")),
                          ("run_id", "attempt", "model"))
        metrics = metrics.join(cv.drop("cv_f1_macro_mean", "cv_accuracy_mean"), on=["run_id", "attempt", "model"],
                               how="left")
    else:
        metrics = metrics.withColumn("cv_balanced_accuracy_mean", F.lit(None).cast("double")) \
            .withColumn("cv_balanced_accuracy_std", F.lit(None).cast("double")) \
            .withColumn("cv_balanced_accuracy_scores", F.lit(None).cast("array<double>"))
    tuned = F.create_map(*[F.lit(x) for m, t in thresholds.items() if t is not None for x in (m, t)]) if any(t is not None for t in thresholds.values()) else None
    metrics = metrics.withColumn("decision_threshold", (tuned[F.col("model")] if tuned is not None else F.lit(None)).cast("double")).checkpoint()
    ctx = spark.createDataFrame(
        [(run_id, float(prof["imbalance_ratio"]) if prof["imbalance_ratio"] is not None else None,
          bool(rt["compare_on_cv"]), int(rows), prof["missing_severity"], float(prof["overall_missing"]),
          int(prof["high_cardinality_count"]), bool(prof["weak_signal_risk"]), int(prof["num_classes"]))],
        "run_id string, imbalance_ratio double, compare_on_cv boolean, n_rows long, missing_severity string, "
        "overall_missing double, high_cardinality_count long, weak_signal_risk boolean, num_classes long",
    )  # one row of run context
    place = F.array_position(F.array(*[F.lit(m) for m in candidates]), F.col("model"))
    board = RK.leaderboard(metrics, ctx.select("run_id", "imbalance_ratio", "compare_on_cv"), candidate_order=place).checkpoint()
    keys = ["run_id", "attempt", "model"]
    test_pred = pred.filter(F.col("split") == "test")
    worst = K.class_stats(K.confusion_counts(test_pred, group_cols=keys), keys).groupBy(*keys).agg(F.min("recall").alias("worst_class_recall"))
    summary = X.run_summary(board.join(worst, on=keys, how="left"))
    diag = X.diagnose(summary, ctx.drop("compare_on_cv")).checkpoint()
    info = D.split_info(split, stratified).first().asDict()  # one row: train rows, test rows, stratified
    return Attempt(prof, plan, rt, candidates, pred, metrics, board, diag, failures, info, labels)


def run(df: DataFrame, target: str, key: str | None = None, run_id: str = "run", max_replans: int = 1, on_attempt=None, **kw) -> list[Attempt]:
    """Attempts until the diagnosis says stop; the step list grows, flags follow the causes, notes name them.

    ``on_attempt(attempt)`` is called as each attempt ends.
    """
    attempts: list[Attempt] = []
    flags, plan, notes = kw.pop("flags", None), None, []
    if key is None:
        df, key = with_row_key(df, None)  # the same keys, so the same split, in every attempt
    while True:
        a = run_attempt(df, target, key, run_id, len(attempts), flags=flags, plan=plan, **kw)
        a.notes = [*(a.profile["notes"] or []), *notes]
        attempts.append(a)
        if on_attempt is not None:
            on_attempt(a)
        hist = attempts[0].diagnosis
        for prev in attempts[1:]:
            hist = hist.unionByName(prev.diagnosis)
        decision = X.should_replan(hist, max_replans).filter(F.col("attempt") == len(attempts) - 1).first()
        if not decision["should_replan"]:
            return attempts
        causes = decision["root_causes"]
        spark = df.sparkSession
        current = flags or a.profile["strategy_flags"]  # the profile's flags, without step overrides
        row = spark.createDataFrame([(current, causes, a.plan)],
                                    "f struct<" + ",".join(f"{k}:boolean" for k in FLAG_NAMES) +
                                    ",replan_count:int>, c array<string>, p array<string>")
        new_flags = X.replan_flags(F.col("f"), F.col("c"), F.lit(a.profile["num_classes"]))
        out = row.select(new_flags.alias("nf"), "p", X.replan_note(F.col("c")).alias("note")).withColumn("np", X.replan_steps(F.col("nf"), F.col("p"))).first()
        flags, plan = out["nf"].asDict(), list(out["np"])
        notes.append(out["note"])
