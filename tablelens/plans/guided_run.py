"""The whole run (Z2): a table in, a target, guidance from earlier runs, attempts, results and a history record out.

Each decision that reaches the driver is one row (the target, the profile, the
hint, the diagnosis); tables, predictions and histories stay distributed.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelens.operators import diagnose as X
from tablelens.operators import history as H
from tablelens.operators import metrics as K
from tablelens.operators import profile as P
from tablelens.operators import ranking as RK
from tablelens.operators import steps as L
from tablelens.operators.rollup import RolledHistory
from tablelens.operators.profile_rules import FLAG_NAMES
from tablelens.operators.target import target_record
from tablelens.plans import attempts as Z

SIGNATURE = [f for f, _ in H.SIGNATURE_FIELDS]
EVENTS = "run_id string, ts timestamp, seq int, stage string, message string"


@dataclass
class GuidedRun:
    run_id: str
    target: str
    fingerprint: str
    hint: dict | None
    attempts: list
    record: DataFrame
    events: list
    inference: dict


def read_hint(history: DataFrame | RolledHistory | None, profile: DataFrame) -> dict | None:
    """H11, else H9 and H10, for a one-row profile: best_model, preferred, avoid, strategies, causes, source, similarity.

    A rolled-up history answers from one bucket of its partials, or from its merged partials.
    """
    if history is None:
        return None
    fp = profile.first()["profile_id"]
    rolled = isinstance(history, RolledHistory)
    mine = None if rolled else history.filter(F.col("fingerprint") == fp)
    best = (history.latest_per_dataset(["best_model"], fp) if rolled else H.latest_per_dataset(mine, ["best_model"])).first()
    names = lambda rows, kind: [r["name"] for r in rows if r["kind"] == kind]
    if best is not None:
        outcomes = (history.model_outcomes(fp), history.strategy_outcomes(fp)) if rolled else (H.model_outcomes(mine), H.strategy_outcomes(mine, FLAG_NAMES))
        rows = sorted(H.exact_hint(*outcomes).collect(), key=lambda r: r["position"])
        return {"source": "exact_fingerprint", "similarity": None, "matched_runs": best["n_runs"], "best_model": best["best_model"],
                "preferred": names(rows, "preferred"), "scores": [(r["name"], r["n"]) for r in rows if r["kind"] == "preferred"],
                "avoid": names(rows, "avoid"), "strategies": names(rows, "strategy"), "causes": []}
    newest = F.max_by(F.struct(*SIGNATURE), F.struct("ts", "run_id")).alias("s")
    if rolled:  # the latest ``keep`` runs of a dataset stand for all: matched runs count up to 10
        runs, counters = history.recent(), history.vote_counters()
        records = runs.groupBy("fingerprint").agg(newest).join(history.first_runs().withColumnRenamed("first_seen", "_first"), "fingerprint")
    else:
        runs, counters = history, H.vote_counters(history, FLAG_NAMES, "root_causes")
        records = runs.groupBy("fingerprint").agg(newest, F.min(F.struct("ts", "run_id")).alias("_first"))
    records = records.select("fingerprint", "s.*", "_first")
    records = records.withColumn("_order", F.unix_micros(F.col("_first.ts")))
    matches = H.similar_records(H.profile_signature(profile, "profile_id"), records, "profile_id", "fingerprint", "_order")
    top = H.similar_hint(matches, runs, "profile_id").first()
    if top is None:
        return None
    k = F.when(F.col("kind").isin("preferred", "strategy"), 5).otherwise(3)
    votes = H.weighted_votes(matches, counters, "profile_id", "fingerprint", "name", "n", k, kind_col="kind")
    rows = sorted(votes.collect(), key=lambda r: r["position"])  # at most 16 rows
    return {"source": "similar_dataset", "similarity": top["similarity"], "matched_runs": top["matched_runs"], "best_model": top["best_model"],
            "preferred": names(rows, "preferred"), "scores": [(r["name"], r["score"]) for r in rows if r["kind"] == "preferred"],
            "avoid": names(rows, "avoid"), "strategies": names(rows, "strategy"), "causes": names(rows, "cause")}


def history_record(attempt: Z.Attempt, profile: DataFrame, run_id: str, ts: datetime.datetime) -> DataFrame:
    """The row an ended run adds to the history."""
    d = attempt.diagnosis.select("best_model", F.col("best_balanced_accuracy").alias("best_score"), "status", "root_causes")
    flags = [F.lit(bool(attempt.flags[k])).alias(k) for k in FLAG_NAMES]
    sig = H.profile_signature(profile, "profile_id").withColumnRenamed("profile_id", "fingerprint")
    one = F.lit(1).alias("_one")
    return d.select("*", one).join(sig.select("*", one), "_one").drop("_one").select(
        F.lit(run_id).alias("run_id"), "fingerprint", F.lit(ts).cast("timestamp").alias("ts"), "best_model", "best_score", "status", "root_causes", *flags, *SIGNATURE)


def _attempt_tables(a: Z.Attempt) -> dict[str, DataFrame]:
    """What an ended attempt leaves: metrics, leaderboard, rationale, reflection, matrix, report, failures, plan, split."""
    spark = a.board.sparkSession
    best = a.diagnosis.select(F.col("best_model").alias("model"))
    test = a.predictions.filter(F.col("split") == "test").join(F.broadcast(best), "model")  # one row
    names = F.array(*[F.lit(str(v)) for v in a.labels])
    name = lambda c: F.element_at(names, F.col(c).cast("int") + 1).alias(c)
    cm = K.confusion_counts(test.select(name("label"), name("prediction")))
    return {
        "plan": spark.createDataFrame([(i, s) for i, s in enumerate(a.plan)], "position int, step string"),
        "metrics": a.metrics, "leaderboard": a.board, "rationale": RK.report_rationale(a.board),
        "reflection": a.diagnosis.withColumn("issues", X.issue_texts(a.diagnosis)),
        "confusion_matrix": K.confusion_dense(cm), "classification_report": K.classification_report(K.class_stats(cm)),
        "failures": spark.createDataFrame([(f["model"], f["error"]) for f in a.failures], "model string, error string"),
        "split": spark.createDataFrame([a.split_info]),
    }


class ResultSink:
    """A run's results as JSON tables under ``path``/<run id>, visible only once its manifest is there.

    Every attempt writes its tables under attempt-<k> as it ends; an ended run adds
    the final set and, last of all, the manifest, which names every table.  A run
    that fails has no manifest, only ``error``: what its attempts left is not read.
    Writing a run again takes its old manifest away first.
    """

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.base, self.run_id, self.tables = spark, f"{path.rstrip('/')}/{run_id}", run_id, []
        for name in ("manifest", "error"):
            self._remove(name)

    def _remove(self, name: str) -> None:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def _write(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").json(f"{self.base}/{name}")
        self.tables.append(name)

    def attempt(self, a: Z.Attempt, index: int) -> None:
        for name, df in _attempt_tables(a).items():
            self._write(f"attempt-{index}/{name}", df)

    def finish(self, run: GuidedRun) -> None:
        last = run.attempts[-1]
        diag = last.diagnosis
        for a in run.attempts[:-1]:
            diag = diag.unionByName(a.diagnosis)
        profile = {k: str(v) for k, v in last.profile.items()} | {"notes": str(last.notes)} | {f"target_{k}": str(v) for k, v in run.inference.items()}
        final = _attempt_tables(last) | {
            "profile": self.spark.createDataFrame([profile]), "attempts": X.attempt_history(diag),
            "log": self.spark.createDataFrame(run.events, EVENTS),
        }
        for name, df in final.items():
            self._write(f"final/{name}", df)
        rows = [(self.run_id, name) for name in self.tables]
        self.spark.createDataFrame(rows, "run_id string, table string").coalesce(1).write.json(f"{self.base}/manifest")

    def fail(self, error: str, events: list) -> None:
        self.spark.createDataFrame([("failed", error, self.run_id)], "status string, error string, run_id string").coalesce(1).write.mode("overwrite").json(f"{self.base}/error")
        self.spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("overwrite").json(f"{self.base}/error_log")


def read_results(spark: SparkSession, path: str, run_id: str, table: str) -> DataFrame:
    """A table of an ended run ("final/metrics", "attempt-0/leaderboard", ...); LookupError where no manifest names it."""
    base = f"{path.rstrip('/')}/{run_id}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/manifest/_SUCCESS")
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        raise LookupError(f"run {run_id!r} has not ended")
    if spark.read.json(f"{base}/manifest").filter(F.col("table") == table).isEmpty():
        raise LookupError(f"run {run_id!r} has no table {table!r}")
    return spark.read.json(f"{base}/{table}")


def _read_history(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The history, or None where none has been written."""
    if path is None:
        return None
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return H.read_history(spark, path) if store.exists(target) else None


def guided_run(df: DataFrame, target: str = "auto", key: str | None = None, history_path: str | None = None, out_path: str | None = None,
               log_path: str | None = None, run_id: str | None = None, ts: datetime.datetime | None = None, max_replans: int = 1, rolled: bool = False, **kw) -> GuidedRun:
    """Resolve the target, profile, take the history's hint, attempt (again), write results, append the record.

    With ``rolled`` the history at ``history_path`` is a ``RolledHistory`` (compact it from time to time).

    A run that fails leaves an error record among the results, an ``error`` event
    in its log and a note beside the history (``<history_path>-notes``); the error
    goes on to the caller.
    """
    spark = df.sparkSession
    run_id, ts = run_id or uuid.uuid4().hex, ts or datetime.datetime.now()
    events: list[tuple] = []
    say = lambda stage, message: events.append((run_id, ts, len(events) + 1, stage, message))
    sink = ResultSink(spark, out_path, run_id) if out_path else None
    ended: list = []

    def on_attempt(a: Z.Attempt) -> None:
        say("attempt", f"{len(a.plan)} steps, {len(a.candidates)} candidates, {len(a.failures)} failed")
        if sink:
            sink.attempt(a, len(ended))
        ended.append(a)

    try:
        inference = target_record(df.drop(key) if key else df, target)
        target, confidence = inference["target"], inference["confidence"]
        names = [c for c in df.columns if c != key]
        profile = P.profile_dataset(df, target, target_confidence=confidence, columns=names)
        row = profile.first()
        store = RolledHistory(spark, history_path, FLAG_NAMES, "root_causes") if rolled and history_path else None
        hint = read_hint((store if store.exists() else None) if store else _read_history(spark, history_path), profile)
        flags = {k: bool(row["strategy_flags"][k]) for k in [*FLAG_NAMES]} | {"replan_count": row["strategy_flags"]["replan_count"]}
        if hint:
            say("memory", f"{hint['source']}: best model {hint['best_model']}")
            voted = F.array(*[F.lit(s) for s in hint["strategies"]]).cast("array<string>")
            flags = profile.select(L.flags_from_votes(F.col("strategy_flags"), voted).alias("f")).first()["f"].asDict()
            scored = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(x)).alias("score")) for n, x in hint["scores"]]).cast("array<struct<name:string,score:double>>")
            preferred = profile.select(L.preferred_models(scored, F.lit(hint["best_model"]).cast("string")).alias("m")).first()["m"]
            kw |= {"preferred": preferred, "avoid": hint["avoid"], "best_model": hint["best_model"], "has_performance": hint["matched_runs"] > 0}
        else:
            say("memory", "no earlier run is close")
        attempts = Z.run(df, target, key, run_id, max_replans, on_attempt, flags=flags, confidence=confidence, **kw)
        say("replan", attempts[-1].notes[-1] if len(attempts) > 1 else "no further attempt")
        record = history_record(attempts[-1], profile, run_id, ts)
        run = GuidedRun(run_id, target, row["profile_id"], hint, attempts, record, events, inference)
        if store:
            store.append(spark.createDataFrame(record.collect(), record.schema), run_id)  # one row
        elif history_path:
            H.append_runs(record, history_path, run_id)
        say("done", "finished")
        if sink:
            sink.finish(run)
        return run
    except Exception as exc:
        error = f"{type(exc).__name__}: {exc}"
        say("error", error)
        if sink:
            sink.fail(error, events)
        if history_path:
            H.append_note(spark, f"{history_path.rstrip('/')}-notes", run_id, ts, f"run failed: {error}")
        raise
    finally:
        if log_path:
            H.append_log(spark.createDataFrame(events, EVENTS), log_path, run_id)
