"""The whole run twice: the second takes guidance from the first's record."""

import datetime
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tablelens.plans.fixtures import fixture
from tablelens.plans.guided_run import guided_run, read_results
from tablelens.session import checkpoint_dir

SF = "/root/testdata/sf0.001"


def test_second_run_uses_the_first(spark):
    base = f"{checkpoint_dir(spark)}/guided-{uuid.uuid4().hex}"
    df = fixture(spark, SF, "f9")
    args = dict(key="row_key", history_path=f"{base}/history", log_path=f"{base}/log", candidates=["DummyMostFrequent", "LogisticRegression"], max_replans=0, with_cv=False)
    first = guided_run(df, "auto", run_id="one", ts=datetime.datetime(2024, 1, 1), out_path=f"{base}/out", **args)
    assert first.target == "label" and first.hint is None
    second = guided_run(df, "label", run_id="two", ts=datetime.datetime(2024, 1, 2), **args)
    assert second.hint["source"] == "exact_fingerprint" and second.hint["best_model"] == "LogisticRegression"
    assert second.attempts[0].candidates[0] == "LogisticRegression" and "try_memory_models_first" in second.attempts[0].plan
    other = guided_run(df.filter("row_key % 10 < 9"), "label", run_id="three", ts=datetime.datetime(2024, 1, 3), **args)
    assert other.hint["source"] == "similar_dataset" and other.hint["similarity"] > 0.9 and other.hint["preferred"] == ["LogisticRegression"]
    rows = spark.read.parquet(f"{base}/history").orderBy("ts").collect()
    assert [(r["run_id"], r["best_model"], r["best_score"]) for r in rows] == [(x, "LogisticRegression", 1.0) for x in ("one", "two", "three")]
    stages = [(r["run_id"], r["stage"]) for r in spark.read.parquet(f"{base}/log").orderBy("ts", "seq").collect()]
    assert ("one", "done") in stages and ("three", "memory") in stages
    report = [json.loads(r["value"]) for r in spark.read.text(f"{base}/out/one/final/classification_report").collect()]
    assert any(r["class_label"] == "macro avg" and r["f1_score"] == 1.0 for r in report)


def test_the_rolled_history_gives_the_same_hints(spark):
    from tablelens.operators.profile import profile_dataset
    from tablelens.operators.profile_rules import FLAG_NAMES
    from tablelens.operators.rollup import RolledHistory
    from tablelens.plans.guided_run import read_hint

    base = f"{checkpoint_dir(spark)}/guided-{uuid.uuid4().hex}"
    df = fixture(spark, SF, "f9")
    args = dict(key="row_key", candidates=["DummyMostFrequent", "LogisticRegression"], max_replans=0, with_cv=False)
    guided_run(df, "label", run_id="one", ts=datetime.datetime(2024, 1, 1), history_path=f"{base}/rolled", rolled=True, **args)
    store = RolledHistory(spark, f"{base}/rolled", FLAG_NAMES, "root_causes")
    store.compact()
    second = guided_run(df, "label", run_id="two", ts=datetime.datetime(2024, 1, 2), history_path=f"{base}/rolled", rolled=True, **args)
    assert second.hint["source"] == "exact_fingerprint" and second.hint["matched_runs"] == 1
    plain = store.runs()
    names = [c for c in df.columns if c != "row_key"]
    for part in (df, df.filter("row_key % 10 < 9")):
        profile = profile_dataset(part, "label", columns=names)
        assert read_hint(store, profile) == read_hint(plain, profile)


def test_every_attempt_leaves_results_and_the_manifest_comes_last(spark, monkeypatch):
    from tablelens.plans import attempts as Z

    base = f"{checkpoint_dir(spark)}/sink-{uuid.uuid4().hex}"
    df = fixture(spark, SF, "f12").unionByName(fixture(spark, SF, "f12").withColumn("row_key", F.col("row_key") + 1000))
    args = dict(key="row_key", out_path=base, history_path=f"{base}/history", candidates=["DummyMostFrequent", "LogisticRegression"], with_cv=False)
    run = guided_run(df, "auto", run_id="r", **args)
    assert len(run.attempts) == 2 and run.inference["method"] == "known_name"
    assert run.attempts[1].plan[:3] == ["apply_replanned_strategy", "rebuild_preprocessor", "reselect_models"]
    assert run.attempts[1].flags["replan_count"] == 1 and not run.attempts[0].flags["replan_count"]
    boards = [read_results(spark, base, "r", f"attempt-{k}/leaderboard") for k in (0, 1)]
    assert all(b.count() == 2 for b in boards)
    assert [r["reflection_status"] for r in read_results(spark, base, "r", "final/attempts").collect()] == ["needs_attention"] * 2
    profile = read_results(spark, base, "r", "final/profile").first()
    assert profile["target_target"] == "label" and "Replan applied" in profile["notes"]
    with pytest.raises(LookupError):
        read_results(spark, base, "r", "final/other")
    # a run that dies in its second attempt shows nothing but its failure
    calls, whole = [], Z.run_attempt

    def dies(*a, **kw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return whole(*a, **kw)

    monkeypatch.setattr(Z, "run_attempt", dies)
    with pytest.raises(RuntimeError):
        guided_run(df, "auto", run_id="r", **args)
    with pytest.raises(LookupError):
        read_results(spark, base, "r", "attempt-0/leaderboard")
    assert spark.read.json(f"{base}/r/error").first()["error"] == "RuntimeError: lost"
    assert "lost" in spark.read.parquet(f"{base}/history-notes").first()["message"]


def test_failed_run_leaves_its_log(spark):
    path = f"{checkpoint_dir(spark)}/failed-{uuid.uuid4().hex}"
    df = spark.createDataFrame([(i, 1.0, "only") for i in range(10)], "k long, x double, label string")
    try:
        guided_run(df, "label", "k", log_path=path, run_id="bad")
        raise AssertionError("one class must fail")
    except ValueError:
        pass
    assert [r["stage"] for r in spark.read.parquet(path).orderBy("seq").collect()][-1] == "error"
