"""Real-world tables: NULL groups and keys, odd columns, unseen categories, CSV quoting, replayed batches."""

import uuid

import pytest
from pyspark.sql import functions as F

from tablelens.functions.ranking import hash_rank
from tablelens.operators import history as H
from tablelens.operators import models as MD
from tablelens.operators import prep as E
from tablelens.operators import profile as P
from tablelens.plans import attempts as Z
from tablelens.plans.fixtures import fixture
from tablelens.session import checkpoint_dir
from tablelens.sources.csv import read_csv_typed
from tablelens.streaming.history_ingest import ingest_runs

SF = "/root/testdata/sf0.001"


def test_null_groups_and_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None if i % 4 == 0 else i, None if i % 3 == 0 else "ab"[i % 2]) for i in range(30)], "k long, g string")
    got = hash_rank(df, ["g"], "k", 1)
    assert got.count() == 30
    assert sorted(r["rank"] for r in got.filter("g is null").collect()) == list(range(1, 11))


def test_unseen_category_is_all_zeros_and_rare_is_not(spark):
    rows = [(i, float(i % 7), "common" if i % 2 else "usual") for i in range(40)] + [(100, 1.0, "rare1"), (101, 2.0, "rare2")]
    train = spark.createDataFrame(rows, "k long, x double, c string").withColumns({"b": F.col("k") % 2 == 0, "n": F.lit(None).cast("double"), "one": F.lit(1)})
    prep = MD.fit_preparation(train, ["x", "b", "n", "one"], ["c"], 0.0, True, 42)
    test = spark.createDataFrame([(1, 1.0, "new"), (2, 1.0, "rare1"), (3, None, None)], "k long, x double, c string").withColumns(
        {"b": F.lit(True), "n": F.lit(None).cast("double"), "one": F.lit(1)})
    vec = {r["k"]: r["features"].toArray().tolist() for r in prep.transform(test).collect()}
    width = 3 + 3  # x, b, one; common, usual, the rare level
    assert all(len(v) == width and all(x == x for x in v) for v in vec.values())
    assert sum(vec[1][3:]) == 0 and sum(vec[2][3:]) == 1 and sum(vec[3][3:]) == 1


def test_empty_table_and_constant_columns(spark):
    empty = spark.createDataFrame([], "a double, b string, label string")
    assert P.missing_by_column(empty).count() in (0, 3)
    df = spark.createDataFrame([(1.0, 2.0, i % 2) for i in range(10)], "a double, b double, y int")
    assert [r["abs_corr"] for r in E.correlation_ranking(df, "y", ["a", "b"]).collect()] == [None, None]
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "v double")
    assert P.n_unique_approx(nan).first()["n_unique_approx"] == 2


def test_attempt_needs_two_classes_and_makes_its_own_key(spark):
    df = spark.createDataFrame([(float(i % 2) * 9 + i % 5, "ab"[i % 2]) for i in range(80)], "x double, label string")
    a = Z.run_attempt(df, "label", None, with_cv=False, candidates=["DummyMostFrequent", "LogisticRegression"])
    best = {r["model"]: r["balanced_accuracy"] for r in a.metrics.collect()}
    assert best["LogisticRegression"] == 1.0 and a.profile["feature_count"] == 1
    assert a.predictions.filter("split = 'test' AND model = 'LogisticRegression'").count() == 16
    twice = df.withColumn("k", F.lit(1))  # a key that repeats is no key
    b = Z.run_attempt(twice, "label", "k", with_cv=False, candidates=["DummyMostFrequent"])
    assert b.predictions.filter("split = 'test'").count() == 16
    with pytest.raises(ValueError):
        Z.run_attempt(df.filter("label = 'a'"), "label", None, with_cv=False, candidates=["DummyMostFrequent"])


def test_rare_class_has_one_index_in_train_and_test(spark):
    rows = [(i, 10.0 * (i % 2) + i % 3, "AC"[i % 2]) for i in range(60)] + [(100, -20.0, "B"), (101, -21.0, "B")]
    df = spark.createDataFrame(rows, "k long, x double, label string")
    a = Z.run_attempt(df, "label", "k", with_cv=False, candidates=["DummyMostFrequent", "LogisticRegression", "LinearSVC", "KNN"])
    got = {r["model"]: r["accuracy"] for r in a.metrics.collect()}
    assert not a.failures and got["LogisticRegression"] == got["KNN"] == 1.0 and set(got) == {"DummyMostFrequent", "LogisticRegression", "LinearSVC", "KNN"}


def test_csv_quotes_newlines_and_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,n,none\n1,"say ""hi"", ok",NA,\n2,"two\nlines",3.5,NA\n')
    df = read_csv_typed(spark, str(tmp_path / "a.csv"))
    rows = df.orderBy("id").collect()
    assert [r["text"] for r in rows] == ['say "hi", ok', "two\nlines"] and dict(df.dtypes) == {"id": "bigint", "text": "string", "n": "double", "none": "double"}
    typed = read_csv_typed(spark, str(tmp_path / "a.csv"), "id int, text string, n double, none string").orderBy("id").collect()
    assert [(r["id"], r["n"], r["none"]) for r in typed] == [(1, None, None), (2, 3.5, None)]


def test_replayed_batch_counts_once(spark):
    runs = fixture(spark, SF, "f8").withColumn("ts", F.col("ts").cast("timestamp"))
    path = f"{checkpoint_dir(spark)}/replay-{uuid.uuid4().hex}"
    for _ in range(2):
        H.append_runs(runs, path, "stream-0")
    H.append_runs(runs.limit(10), path, "stream-1")
    assert H.read_history(spark, path).count() == runs.count() + 10
    assert ingest_runs is not None
