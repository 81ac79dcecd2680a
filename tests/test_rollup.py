"""The rolled-up history equals the aggregates over all runs after replays and compactions."""

import uuid

import pytest
from pyspark.sql import functions as F

from tablelens.operators import history as H
from tablelens.operators.rollup import RolledHistory
from tablelens.plans.fixtures import fixture
from tablelens.session import checkpoint_dir

SF = "/root/testdata/sf0.001"
FLAGS, CAUSES = ["use_class_weight", "group_rare_categories", "enable_cv"], ["cause_1", "cause_2"]


def _rows(df):
    return sorted((tuple(sorted(r.asDict(recursive=True).items(), key=lambda x: x[0])) for r in df.collect()), key=repr)


def _store(spark, **kw):
    return RolledHistory(spark, f"{checkpoint_dir(spark)}/rolled-{uuid.uuid4().hex}", FLAGS, CAUSES, **kw)


def _same(store, runs):
    assert _rows(store.runs().select(*runs.columns)) == _rows(runs)
    assert _rows(store.model_outcomes()) == _rows(H.model_outcomes(runs))
    assert _rows(store.strategy_outcomes()) == _rows(H.strategy_outcomes(runs, FLAGS))
    assert _rows(store.root_cause_counts()) == _rows(H.root_cause_counts(runs, CAUSES))
    assert _rows(store.last_runs(3).select(*runs.columns, "recency")) == _rows(H.last_runs(runs, 3))
    assert _rows(store.latest_per_dataset(["best_model"])) == _rows(H.latest_per_dataset(runs, ["best_model"]))


def test_replays_and_compactions_leave_the_full_aggregates(spark):
    runs = fixture(spark, SF, "f8").limit(600).persist()
    runs = runs.withColumn("fingerprint", F.when(F.col("run_id") % 97 != 0, F.col("fingerprint"))) if dict(runs.dtypes)["run_id"] != "string" else runs
    part = F.pmod(F.xxhash64("run_id"), F.lit(4))
    store = _store(spark, rows_per_bucket=100)
    with pytest.raises(LookupError):
        store.runs()
    assert store.compact() == 0 and not store.exists()
    store.append(runs.filter(part == 0), "a/b c%")
    store.append(runs.filter(part == 1).limit(3), "second")
    store.append(runs.filter(part == 1), "second")  # a replay before compaction
    _same(store, runs.filter(part < 2))
    assert store.compact() == runs.filter(part < 2).count()
    _same(store, runs.filter(part < 2))
    store.append(runs.filter(part == 2), "a/b c%")  # replays a compacted batch with other rows
    store.append(runs.filter(part == 3), "third")
    store.append(runs.filter(part > 9), "empty")
    _same(store, runs.filter(part > 0))
    assert store.compact() == runs.filter(part > 0).count()
    _same(store, runs.filter(part > 0))
    assert store.compact() == 0


def test_unfinished_writes_are_not_read(spark):
    runs = fixture(spark, SF, "f8").limit(50).persist()
    store = _store(spark)
    store.append(runs, "one")
    # a batch whose runs never came, a segment without a manifest
    runs.write.parquet(f"{store.path}/batches/b-two/1/recent")
    runs.write.parquet(f"{store.path}/segments/lost/runs")
    _same(store, runs)
    store.compact()
    _same(store, runs)
    assert "lost" not in store._names("segments")


def test_a_lookup_reads_one_bucket_a_segment(spark):
    runs = fixture(spark, SF, "f8").persist()
    store = _store(spark, rows_per_bucket=max(1, runs.count() // 12))
    store.append(runs, "all")
    store.compact()
    assert store._state().batches == {}
    fp = runs.filter(F.col("fingerprint").isNotNull()).first()["fingerprint"]
    mine = store.runs(fp)
    assert _rows(mine.select(*runs.columns)) == _rows(runs.filter(F.col("fingerprint") == fp))
    assert "PartitionFilters: [isnotnull(bucket" in mine._jdf.queryExecution().toString()
    assert _rows(store.model_outcomes(fp)) == _rows(H.model_outcomes(runs.filter(F.col("fingerprint") == fp)))
    with pytest.raises(ValueError):
        store.last_runs(11)
