"""Registered queries for run history (S3-S6, H1-H12) and history-driven planning."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablelens.functions.columns import pyround, r6
from tablelens.operators import history as H
from tablelens.operators import pool as M
from tablelens.operators import profile as P
from tablelens.operators import ranking as RK
from tablelens.operators import steps as L
from tablelens.operators.profile_rules import FLAG_NAMES, facts_rules
from tablelens.operators.rollup import RolledHistory
from tablelens.plans.fixtures import fixture, with_fixtures
from tablelens.plans.suite_diagnose import FR_CTES, PLAN_CTE, RT_CTE, f5_planned
from tablelens.plans.suite_profile import F3_SEG_COLS, _profile_sql
from tablelens.session import checkpoint_dir

F8_FLAGS = ["use_class_weight", "group_rare_categories", "enable_cv"]
F8_CAUSES = ["cause_1", "cause_2"]
N_FP = 50  # F5 dataset d is recorded under the F8 fingerprint 'fp_<d mod 50>'


def _runs(spark, sf):
    return fixture(spark, sf, "f8")


def _records(spark, sf):
    """History records: F5 profiles with their fingerprint; insertion order = dataset_id.

    Signatures need only the profile rules, not the step list.
    """
    f5 = facts_rules(fixture(spark, sf, "f5"))
    p = f5.withColumn("imbalance_ratio", F.when(F.col("is_classification"), F.col("imbalance_ratio"))) \
        .withColumn("num_classes", F.when(F.col("is_classification"), F.col("num_classes")).otherwise(F.lit(0))) \
        .withColumn("n_cols", F.col("feature_count") + 1)
    sig = H.profile_signature(p, "dataset_id")
    return sig.withColumn("fingerprint", F.concat(F.lit("fp_"), (F.col("dataset_id") % N_FP).cast("string")))


def _queries(spark, sf):
    """Query profiles: one per supplier segment of F3."""
    prof = P.profile_dataset(fixture(spark, sf, "f3"), "label", segment_cols=["l_suppkey"])
    return H.profile_signature(prof, "l_suppkey")


def _matches(spark, sf):
    return H.similar_records(_queries(spark, sf), _records(spark, sf), "l_suppkey", "dataset_id", "dataset_id")


def q_model_outcomes(spark, sf):
    return H.model_outcomes(_runs(spark, sf)).drop("first_seen")


def _rolled(spark, sf):
    """All runs in three batches, the first replayed with other rows after a compaction."""
    runs = _runs(spark, sf)
    part = F.pmod(F.xxhash64("run_id"), F.lit(4))
    store = RolledHistory(spark, _scratch(spark), F8_FLAGS, F8_CAUSES)
    store.append(runs.filter(part < 2), "first")
    store.append(runs.filter(part == 1), "second")
    store.compact()
    store.append(runs.filter(part == 0), "first")
    store.append(runs.filter(part > 1), "third")
    return store


def q_rolled_model_outcomes(spark, sf):
    return _rolled(spark, sf).model_outcomes().drop("first_seen")


def q_rolled_last_runs(spark, sf):
    store = _rolled(spark, sf)
    store.compact()
    return store.last_runs(10).select("fingerprint", "run_id", "recency")


def q_strategy_outcomes(spark, sf):
    return H.strategy_outcomes(_runs(spark, sf), F8_FLAGS).drop("first_seen")


def q_root_cause_counts(spark, sf):
    return H.root_cause_counts(_runs(spark, sf), F8_CAUSES).drop("first_seen")


def q_last_runs_per_dataset(spark, sf):
    return H.last_runs(_runs(spark, sf)).select("fingerprint", "run_id", "recency")


def q_recent_runs(spark, sf):
    return H.recent_runs(_runs(spark, sf)).select("run_id", "fingerprint", "ts", "best_model")


def q_history_exact_lookup(spark, sf):
    """H1: every F5 record left-joined to the latest run of its fingerprint."""
    latest = H.latest_per_dataset(_runs(spark, sf), ["run_id", "best_model", "best_score"])
    rec = _records(spark, sf).select("dataset_id", "fingerprint")
    return rec.join(latest, on="fingerprint", how="left").select(
        "dataset_id", "fingerprint", "run_id", "best_model", "best_score", "n_runs")


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/history-{uuid.uuid4().hex}"


def q_history_append_latest(spark, sf):
    """S4+H6: two appends to a day-partitioned history table, then the latest run per dataset."""
    runs = _runs(spark, sf)
    path = _scratch(spark)
    cut = F.lit("1995-01-01").cast("timestamp_ntz")
    H.append_runs(runs.filter(F.col("ts") < cut), path, "older")
    H.append_runs(runs.filter(F.col("ts") >= cut), path, "newer")
    hist = spark.read.parquet(path)
    return H.latest_per_dataset(hist, ["run_id", "best_model", "best_score"])


def q_history_union_legacy(spark, sf):
    """An older layout (renamed key, no flags) read together with the current one."""
    runs = _runs(spark, sf)
    base = _scratch(spark)
    cut = F.lit("1995-01-01").cast("timestamp_ntz")
    runs.filter(F.col("ts") < cut).select(
        F.col("fingerprint").alias("dataset_fingerprint"), "run_id", "ts", "best_model", "best_score"
    ).write.parquet(f"{base}/legacy")
    runs.filter(F.col("ts") >= cut).write.parquet(f"{base}/current")
    hist = H.read_history(spark, f"{base}/current", f"{base}/legacy")
    return hist.groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("n_runs"), F.max("best_score").alias("max_score"),
        F.count("use_class_weight").alias("n_with_flags"),
    )


def _run_log(spark, sf):
    """Four events per run derived from F8 (attempt, models, reflect, done or error)."""
    runs = _runs(spark, sf)
    last = F.when(F.col("best_score") < 0.1, "error").otherwise("done")
    events = F.array(
        F.struct(F.lit(1).alias("seq"), F.lit("attempt").alias("stage"), F.lit("Starting attempt 0").alias("message")),
        F.struct(F.lit(2).alias("seq"), F.lit("models").alias("stage"),
                 F.concat(F.lit("Candidate models for "), F.col("fingerprint")).alias("message")),
        F.struct(F.lit(3).alias("seq"), F.lit("reflect").alias("stage"),
                 F.concat(F.lit("best="), F.col("best_model")).alias("message")),
        F.struct(F.lit(4).alias("seq"), last.alias("stage"), F.lit("finished").alias("message")),
    )
    return runs.select("run_id", "ts", F.explode(events).alias("e")).select(
        "run_id", (F.col("ts") + F.expr("make_interval(0, 0, 0, 0, 0, 0, e.seq)")).alias("ts"),
        F.col("e.seq").alias("seq"), F.col("e.stage").alias("stage"), F.col("e.message").alias("message"))


def q_run_log_summary(spark, sf):
    return H.run_log_summary(_run_log(spark, sf))


def q_run_last_event(spark, sf):
    return H.last_event(_run_log(spark, sf)).select("run_id", "stage", "message")


def q_profile_signature(spark, sf):
    return _records(spark, sf).drop("fingerprint")


def q_similar_datasets_top3(spark, sf):
    m = _matches(spark, sf)
    return m.select("l_suppkey", "rank", "dataset_id", r6(F.col("similarity")).alias("similarity"))


def _matched_records(spark, sf):
    """Matches by fingerprint: counters and runs are joined to the few matches, never spread over all datasets."""
    rec = _records(spark, sf).select("dataset_id", "fingerprint")
    return _matches(spark, sf).join(rec, on="dataset_id")


def q_history_votes(spark, sf):
    """H9: all four vote kinds in one join and one aggregate (top 5/3/5/3 per kind)."""
    counters = H.vote_counters(_runs(spark, sf), F8_FLAGS, F8_CAUSES)
    k = F.when(F.col("kind").isin("preferred", "strategy"), 5).otherwise(3)
    v = H.weighted_votes(_matched_records(spark, sf), counters, "l_suppkey", "fingerprint", "name", "n", k, kind_col="kind")
    return v.select("l_suppkey", "kind", "position", "name", r6(F.col("score")).alias("score"))


def q_history_hint(spark, sf):
    """Similarity of the top match, runs matched (<= 10 per record), best model of its latest run."""
    return H.similar_hint(_matched_records(spark, sf), _runs(spark, sf), "l_suppkey")


def _exact(spark, sf):
    runs = _runs(spark, sf)
    return H.exact_hint(H.model_outcomes(runs), H.strategy_outcomes(runs, F8_FLAGS))


def q_exact_hint(spark, sf):
    return _exact(spark, sf)


def q_order_candidates(spark, sf):
    """M10 with the exact hint of each dataset's fingerprint: best model first, avoid list last."""
    p = f5_planned(spark, sf).withColumn("fingerprint", F.concat(F.lit("fp_"), (F.col("dataset_id") % N_FP).cast("string")))
    pool = M.candidate_pool(F.col("n_rows"), F.col("feature_count"), F.col("dominant_feature_type"),
                            F.col("high_dimensional"), F.col("high_cardinality_count"), F.col("num_classes"),
                            F.col("size_bucket"), F.col("runtime_flags"))
    cands = p.select("dataset_id", "fingerprint", F.explode(pool).alias("model"))
    hint = _exact(spark, sf)
    best = H.latest_per_dataset(_runs(spark, sf), ["best_model"]).select("fingerprint", "best_model")
    pref = hint.filter(F.col("kind") == "preferred").select("fingerprint", F.col("name").alias("model"), "position")
    pref = pref.join(best, on="fingerprint", how="left")
    has_best = pref.groupBy("fingerprint").agg(F.max((F.col("model") == F.col("best_model")).cast("int")).alias("hb"))
    pref = pref.join(has_best, on="fingerprint").select(
        "fingerprint", "model", F.when(F.col("hb") == 1, F.col("position") - 1).otherwise(F.col("position")).alias("pref_rank"))
    extra = best.join(has_best, on="fingerprint", how="left").filter(F.coalesce(F.col("hb"), F.lit(0)) == 0) \
        .select("fingerprint", F.col("best_model").alias("model"), F.lit(0).cast("long").alias("pref_rank"))
    pref = pref.unionByName(extra)
    avoid = hint.filter(F.col("kind") == "avoid").select("fingerprint", F.col("name").alias("model"))
    ordered = RK.order_candidates(cands, pref, avoid, group_cols=("dataset_id",), on=("fingerprint",))
    return ordered.select("dataset_id", "model", "candidate_order")


def _seen_profiles(spark, sf):
    """Every other supplier's profile has been run before: its fingerprint is in the history, next to F8's runs."""
    prof = P.profile_dataset(fixture(spark, sf, "f3"), "label", segment_cols=["l_suppkey"]).select(
        "l_suppkey", F.col("profile_id").alias("fingerprint"))
    seen = prof.filter(F.col("l_suppkey") % 2 == 0).groupBy("fingerprint").agg(F.max("l_suppkey").alias("s")).select(
        (F.col("s") + 1_000_000_000).alias("run_id"), "fingerprint", F.lit("2000-01-01").cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("seen_"), F.col("s").cast("string")).alias("best_model"), F.lit(0.9).alias("best_score"))
    return prof, _runs(spark, sf).select("run_id", "fingerprint", F.col("ts").cast("timestamp_ntz").alias("ts"), "best_model", "best_score").unionByName(seen)


def q_resolved_hint(spark, sf):
    """The exact record's hint when the profile's fingerprint is in the history, else the similar one."""
    prof, runs = _seen_profiles(spark, sf)
    return H.resolve_hint(prof, runs, q_history_hint(spark, sf), "l_suppkey")


def q_flags_from_history(spark, sf):
    """Strategies preferred by the exact hint switch their flags on."""
    p = f5_planned(spark, sf).withColumn("fingerprint", F.concat(F.lit("fp_"), (F.col("dataset_id") % N_FP).cast("string")))
    votes = _exact(spark, sf).filter(F.col("kind") == "strategy").groupBy("fingerprint") \
        .agg(F.collect_list("name").alias("voted"))
    j = p.join(votes, on="fingerprint", how="left")
    j = j.withColumn("voted", F.coalesce(F.col("voted"), F.array().cast("array<string>")))
    flags = L.flags_from_votes(F.col("strategy_flags"), F.col("voted"))
    return j.select("dataset_id", *[flags[k].alias(k) for k in FLAG_NAMES])


def q_profile_as_json(spark, sf):
    """S3: profile rows serialised with to_json; fields read back from the text."""
    prof = P.flatten_profile(P.profile_dataset(fixture(spark, sf, "f3"), "label", segment_cols=["l_suppkey"]))
    js = prof.select("l_suppkey", F.to_json(F.struct(*[c for c in prof.columns if c != "l_suppkey"])).alias("payload"))
    return js.select(
        "l_suppkey",
        F.get_json_object("payload", "$.n_rows").cast("long").alias("n_rows"),
        F.get_json_object("payload", "$.missing_severity").alias("missing_severity"),
        F.get_json_object("payload", "$.size_bucket").alias("size_bucket"),
        F.get_json_object("payload", "$.profile_id").alias("profile_id"),
    )


QUERIES = {
    "model_outcomes": q_model_outcomes,
    "rolled_model_outcomes": q_rolled_model_outcomes,
    "rolled_last_runs": q_rolled_last_runs,
    "strategy_outcomes": q_strategy_outcomes,
    "root_cause_counts": q_root_cause_counts,
    "last_runs_per_dataset": q_last_runs_per_dataset,
    "recent_runs": q_recent_runs,
    "history_exact_lookup": q_history_exact_lookup,
    "history_append_latest": q_history_append_latest,
    "history_union_legacy": q_history_union_legacy,
    "run_log_summary": q_run_log_summary,
    "run_last_event": q_run_last_event,
    "profile_signature": q_profile_signature,
    "similar_datasets_top3": q_similar_datasets_top3,
    "history_votes": q_history_votes,
    "history_hint": q_history_hint,
    "exact_hint": q_exact_hint,
    "order_candidates": q_order_candidates,
    "flags_from_history": q_flags_from_history,
    "resolved_hint": q_resolved_hint,
    "profile_as_json": q_profile_as_json,
}


# ------------------------------------------------------------------ oracle SQL
def _f8(body: str) -> str:
    return with_fixtures(body, "f8")


_OUTCOMES = """mo AS (SELECT fingerprint, best_model AS model,
   count(CASE WHEN coalesce(best_score, 0.0) >= 0.7 THEN 1 END) AS successful,
   count(CASE WHEN coalesce(best_score, 0.0) < 0.7 THEN 1 END) AS failed,
   min(ts) AS fs_ts, arg_min(run_id, (ts, run_id)) AS fs_run
 FROM f8 WHERE best_model IS NOT NULL GROUP BY fingerprint, best_model),
sl AS (SELECT fingerprint, ts, run_id, best_score, 'use_class_weight' AS strategy FROM f8 WHERE use_class_weight
  UNION ALL SELECT fingerprint, ts, run_id, best_score, 'group_rare_categories' FROM f8 WHERE group_rare_categories
  UNION ALL SELECT fingerprint, ts, run_id, best_score, 'enable_cv' FROM f8 WHERE enable_cv),
so AS (SELECT fingerprint, strategy, count(CASE WHEN coalesce(best_score, 0.0) >= 0.7 THEN 1 END) AS successful,
   count(CASE WHEN coalesce(best_score, 0.0) < 0.7 THEN 1 END) AS unsuccessful,
   min(ts) AS fs_ts, arg_min(run_id, (ts, run_id)) AS fs_run FROM sl GROUP BY fingerprint, strategy),
cl AS (SELECT fingerprint, ts, run_id, cause_1 AS cause FROM f8 WHERE cause_1 IS NOT NULL
  UNION ALL SELECT fingerprint, ts, run_id, cause_2 FROM f8 WHERE cause_2 IS NOT NULL),
rc AS (SELECT fingerprint, cause, count(*) AS n, min(ts) AS fs_ts, arg_min(run_id, (ts, run_id)) AS fs_run
   FROM cl GROUP BY fingerprint, cause),
lt AS (SELECT fingerprint, arg_max(run_id, (ts, run_id)) AS run_id, arg_max(best_model, (ts, run_id)) AS best_model,
   arg_max(best_score, (ts, run_id)) AS best_score, count(*) AS n_runs FROM f8 GROUP BY fingerprint),
eh AS (
  SELECT fingerprint, 'preferred' AS kind, model AS name, CAST(successful AS BIGINT) AS n,
     row_number() OVER (PARTITION BY fingerprint ORDER BY successful DESC, fs_ts, fs_run) AS position FROM mo WHERE successful > 0
  UNION ALL
  SELECT fingerprint, 'avoid', model, CAST(failed AS BIGINT),
     row_number() OVER (PARTITION BY fingerprint ORDER BY failed DESC, fs_ts, fs_run) FROM mo WHERE failed > 0
  UNION ALL
  SELECT fingerprint, 'strategy', strategy, CAST(successful AS BIGINT),
     row_number() OVER (PARTITION BY fingerprint ORDER BY successful DESC, fs_ts, fs_run) FROM so WHERE successful > 0),
ehk AS (SELECT * FROM eh WHERE (kind = 'avoid' AND position <= 3) OR (kind <> 'avoid' AND position <= 5))"""

_QSIG = _profile_sql("f3", F3_SEG_COLS, "label", "l_suppkey", fx_names=())
_SIM_CTES = f"""{FR_CTES},
qp AS ({_QSIG.replace('WITH ', 'WITH ', 1)}),
qs AS (SELECT l_suppkey, size_bucket, numeric_ratio, missing_severity, dominant_feature_type,
   coalesce(imbalance_ratio, 1.0) AS imb, num_classes, high_dimensional, high_cardinality_count AS hc, weak_signal_risk FROM qp),
rs AS (SELECT dataset_id, concat('fp_', CAST(dataset_id % {N_FP} AS VARCHAR)) AS fingerprint, size_bucket, numeric_ratio,
   missing_severity, dominant_feature_type, coalesce(imbalance_eff, 1.0) AS imb, classes_eff AS num_classes,
   high_dimensional, high_cardinality_count AS hc, weak_signal_risk FROM fr),
pairs AS (SELECT q.l_suppkey, r.dataset_id, r.fingerprint,
  (2.0 * greatest(0.0, 1.0 - least(abs(q.numeric_ratio - r.numeric_ratio) / 1.0, 1.0))
   + CASE WHEN q.size_bucket = r.size_bucket THEN 1.5 ELSE 0.0 END
   + CASE WHEN q.missing_severity = r.missing_severity THEN 1.5 ELSE 0.0 END
   + CASE WHEN q.dominant_feature_type = r.dominant_feature_type THEN 1.5 ELSE 0.0 END
   + 1.5 * greatest(0.0, 1.0 - least(abs(q.imb - r.imb) / 8.0, 1.0))
   + CASE WHEN q.num_classes = r.num_classes THEN 1.0 ELSE 0.0 END
   + CASE WHEN q.high_dimensional = r.high_dimensional THEN 1.0 ELSE 0.0 END
   + 1.0 * greatest(0.0, 1.0 - least(abs(CAST(q.hc AS DOUBLE) - CAST(r.hc AS DOUBLE)) / 10.0, 1.0))
   + CASE WHEN q.weak_signal_risk = r.weak_signal_risk THEN 1.0 ELSE 0.0 END) / 12.0 AS similarity
  FROM qs q, rs r),
top3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY similarity DESC, dataset_id) AS rank
  FROM pairs WHERE similarity >= 0.45) x WHERE rank <= 3)"""


def _sim(body: str) -> str:
    # the query-profile SQL carries its own WITH; splice its CTEs into ours
    q = _QSIG
    inner_ctes, inner_select = q[len("WITH "):].split("\nSELECT ", 1)
    sim = _SIM_CTES.replace(f"qp AS ({q})", f"{inner_ctes.rstrip().rstrip(',')},\nqp AS (SELECT {inner_select})")
    return with_fixtures(f"{sim},\n{_OUTCOMES}\n{body}", "f3", "f5", "f8")


def _oracles():
    o = {}
    o["model_outcomes"] = _f8(f"{_OUTCOMES}\nSELECT fingerprint, model, successful, failed FROM mo")
    o["strategy_outcomes"] = _f8(f"{_OUTCOMES}\nSELECT fingerprint, strategy, successful, unsuccessful FROM so")
    o["root_cause_counts"] = _f8(f"{_OUTCOMES}\nSELECT fingerprint, cause, n FROM rc")
    o["last_runs_per_dataset"] = _f8(
        "SELECT fingerprint, run_id, recency FROM (SELECT fingerprint, run_id, "
        "row_number() OVER (PARTITION BY fingerprint ORDER BY ts DESC, run_id DESC) AS recency FROM f8) x WHERE recency <= 10")
    o["rolled_model_outcomes"], o["rolled_last_runs"] = o["model_outcomes"], o["last_runs_per_dataset"]
    o["recent_runs"] = _f8("SELECT run_id, fingerprint, ts, best_model FROM f8 ORDER BY ts DESC, run_id DESC LIMIT 50")
    o["history_exact_lookup"] = with_fixtures(
        f"""{_OUTCOMES}
SELECT p.p_partkey AS dataset_id, concat('fp_', CAST(p.p_partkey % {N_FP} AS VARCHAR)) AS fingerprint,
  lt.run_id, lt.best_model, lt.best_score, lt.n_runs
FROM part p LEFT JOIN lt ON lt.fingerprint = concat('fp_', CAST(p.p_partkey % {N_FP} AS VARCHAR))""", "f8")
    o["history_append_latest"] = _f8(f"{_OUTCOMES}\nSELECT fingerprint, run_id, best_model, best_score, n_runs FROM lt")
    o["history_union_legacy"] = _f8(
        "SELECT fingerprint, count(*) AS n_runs, max(best_score) AS max_score, "
        "count(CASE WHEN ts >= TIMESTAMP '1995-01-01' THEN use_class_weight END) AS n_with_flags FROM f8 GROUP BY fingerprint")
    log = """lg AS (
  SELECT run_id, ts, 1 AS seq, 'attempt' AS stage, 'Starting attempt 0' AS message FROM f8
  UNION ALL SELECT run_id, ts, 2, 'models', concat('Candidate models for ', fingerprint) FROM f8
  UNION ALL SELECT run_id, ts, 3, 'reflect', concat('best=', best_model) FROM f8
  UNION ALL SELECT run_id, ts, 4, CASE WHEN best_score < 0.1 THEN 'error' ELSE 'done' END, 'finished' FROM f8)"""
    o["run_log_summary"] = _f8(f"{log}\nSELECT stage, count(*) AS n_events, count(DISTINCT run_id) AS n_runs FROM lg GROUP BY stage")
    o["run_last_event"] = _f8(f"{log}\nSELECT run_id, arg_max(stage, seq) AS stage, arg_max(message, seq) AS message FROM lg GROUP BY run_id")
    o["profile_signature"] = with_fixtures(
        f"""{FR_CTES}
SELECT dataset_id, size_bucket, CAST(n_rows AS BIGINT) AS rows, CAST(feature_count + 1 AS BIGINT) AS cols,
  numeric_ratio, categorical_ratio, missing_severity, overall_missing, coalesce(imbalance_eff, 1.0) AS imbalance_ratio,
  CAST(classes_eff AS BIGINT) AS num_classes, high_dimensional, CAST(high_cardinality_count AS BIGINT) AS high_cardinality_count,
  dominant_feature_type, weak_signal_risk FROM fr""", "f5")
    o["similar_datasets_top3"] = _sim("SELECT l_suppkey, CAST(rank AS BIGINT) AS rank, dataset_id, round(similarity, 6) AS similarity FROM top3")
    votes = []
    for kind, src, name, cnt, k in [("preferred", "mo", "model", "successful", 5), ("avoid", "mo", "model", "failed", 3),
                                    ("strategy", "so", "strategy", "successful", 5), ("cause", "rc", "cause", "n", 3)]:
        votes.append(f"""SELECT l_suppkey, '{kind}' AS kind, position, name, round(score, 6) AS score FROM (
  SELECT l_suppkey, name, score, row_number() OVER (PARTITION BY l_suppkey ORDER BY round(score, 9) DESC, mr, fts, frun) AS position
  FROM (SELECT t.l_suppkey, c.{name} AS name,
          coalesce(max(CASE WHEN t.rank = 1 THEN t.similarity * c.{cnt} END), 0.0)
          + coalesce(max(CASE WHEN t.rank = 2 THEN t.similarity * c.{cnt} END), 0.0)
          + coalesce(max(CASE WHEN t.rank = 3 THEN t.similarity * c.{cnt} END), 0.0) AS score, min(t.rank) AS mr,
          arg_min(c.fs_ts, t.rank) AS fts, arg_min(c.fs_run, t.rank) AS frun
        FROM top3 t JOIN {src} c ON c.fingerprint = t.fingerprint WHERE c.{cnt} > 0 GROUP BY t.l_suppkey, c.{name}) a) b
WHERE position <= {k}""")
    o["history_votes"] = _sim("\nUNION ALL\n".join(votes))
    o["history_hint"] = _sim(
        """SELECT t.l_suppkey, round(max(CASE WHEN t.rank = 1 THEN t.similarity END), 3) AS similarity,
  sum(least(coalesce(lt.n_runs, 0), 10)) AS matched_runs, max(CASE WHEN t.rank = 1 THEN lt.best_model END) AS best_model
FROM top3 t LEFT JOIN lt ON lt.fingerprint = t.fingerprint GROUP BY t.l_suppkey""")
    o["exact_hint"] = _f8(f"{_OUTCOMES}\nSELECT fingerprint, kind, name, n, CAST(position AS BIGINT) AS position FROM ehk")
    pool_sql = __import__("tablelens.plans.suite_diagnose", fromlist=["_oracles"])
    cp = pool_sql.ORACLES["candidate_pool"]
    # reuse only the pool list expression: rebuild the pool CTE inline
    pool_expr = cp.split("cp AS (SELECT dataset_id, ", 1)[1].split(" AS pool FROM rt)", 1)[0]
    o["order_candidates"] = with_fixtures(
        f"""{FR_CTES},
{PLAN_CTE},
{RT_CTE},
{_OUTCOMES},
cp AS (SELECT dataset_id, concat('fp_', CAST(dataset_id % {N_FP} AS VARCHAR)) AS fingerprint, unnest({pool_expr}) AS model FROM rt),
pf AS (SELECT e.fingerprint, e.name AS model, e.position, lt.best_model FROM ehk e LEFT JOIN lt ON lt.fingerprint = e.fingerprint
       WHERE e.kind = 'preferred'),
hb AS (SELECT fingerprint, max(CASE WHEN model = best_model THEN 1 ELSE 0 END) AS hb FROM pf GROUP BY fingerprint),
pr AS (SELECT pf.fingerprint, pf.model, CASE WHEN hb.hb = 1 THEN position - 1 ELSE position END AS pref_rank
       FROM pf JOIN hb ON pf.fingerprint = hb.fingerprint
       UNION ALL
       SELECT lt.fingerprint, lt.best_model, 0 FROM lt LEFT JOIN hb ON hb.fingerprint = lt.fingerprint WHERE coalesce(hb.hb, 0) = 0),
av AS (SELECT fingerprint, name AS model FROM ehk WHERE kind = 'avoid')
SELECT cp.dataset_id, cp.model, row_number() OVER (PARTITION BY cp.dataset_id ORDER BY
    CASE WHEN av.model IS NOT NULL THEN 1 ELSE 0 END, coalesce(pr.pref_rank, 1000000), cp.model) AS candidate_order
FROM cp LEFT JOIN pr ON pr.fingerprint = cp.fingerprint AND pr.model = cp.model
LEFT JOIN av ON av.fingerprint = cp.fingerprint AND av.model = cp.model""", "f5", "f8")
    o["flags_from_history"] = with_fixtures(
        f"""{FR_CTES},
{_OUTCOMES},
vt AS (SELECT fingerprint, list(name) AS voted FROM ehk WHERE kind = 'strategy' GROUP BY fingerprint),
j AS (SELECT fr.*, coalesce(vt.voted, []::VARCHAR[]) AS voted FROM fr
      LEFT JOIN vt ON vt.fingerprint = concat('fp_', CAST(fr.dataset_id % {N_FP} AS VARCHAR)))
SELECT dataset_id, """ + ", ".join(f"({f} OR list_contains(voted, '{f}')) AS {f}" for f in FLAG_NAMES) + " FROM j",
        "f5", "f8")
    o["resolved_hint"] = _sim(
        """,
hh AS (SELECT t.l_suppkey, max(CASE WHEN t.rank = 1 THEN lt.best_model END) AS best_model,
              max(CASE WHEN t.rank = 1 THEN t.similarity END) AS similarity
       FROM top3 t LEFT JOIN lt ON lt.fingerprint = t.fingerprint GROUP BY t.l_suppkey),
seen AS (SELECT profile_id AS fingerprint, concat('seen_', CAST(max(l_suppkey) AS VARCHAR)) AS best_model FROM qp
         WHERE l_suppkey % 2 = 0 GROUP BY profile_id),
ex AS (SELECT fingerprint, best_model FROM seen UNION ALL
       SELECT fingerprint, best_model FROM lt WHERE fingerprint NOT IN (SELECT fingerprint FROM seen))
SELECT qp.l_suppkey,
  CASE WHEN le.best_model IS NOT NULL THEN 'exact_fingerprint'
       WHEN hh.best_model IS NOT NULL OR hh.similarity IS NOT NULL THEN 'similar_dataset' END AS source,
  CASE WHEN le.best_model IS NOT NULL THEN le.best_model ELSE hh.best_model END AS best_model
FROM qp LEFT JOIN ex le ON le.fingerprint = qp.profile_id LEFT JOIN hh ON hh.l_suppkey = qp.l_suppkey""")
    segp = _profile_sql("f3", F3_SEG_COLS, "label", "l_suppkey")
    o["profile_as_json"] = f"SELECT l_suppkey, n_rows, missing_severity, size_bucket, profile_id FROM ({segp}) q"
    return o


ORACLES = _oracles()
