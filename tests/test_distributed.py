"""Exactness of the distributed building blocks against single-window / numpy results."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablelens.functions.columns import seeded_md5
from tablelens.functions.ranking import hash_rank, top_k
from tablelens.operators import history as H
from tablelens.operators import prep
from tablelens.operators.prep import fit_medians
from tablelens.operators.split import plain_split, stratified_split


def _skewed(spark, n=5000):
    # one group holds about a third of the rows
    return spark.range(n).select(F.col("id").alias("key"),
                                 F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 17).cast("string")).alias("g"),
                                 ((F.col("id") * 7919) % 1000).cast("double").alias("v"))


def test_hash_rank_equals_row_number(spark):
    df = _skewed(spark)
    got = hash_rank(df, ["g"], "key", 42, prefix_hex=2).select("key", "rank", "group_n")
    w = Window.partitionBy("g").orderBy(seeded_md5(42, "key"), "key")
    exp = df.select("key", F.row_number().over(w).cast("long").alias("rank"),
                    F.count(F.lit(1)).over(Window.partitionBy("g")).alias("group_n"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_top_k_equals_window(spark):
    df = _skewed(spark)
    got = top_k(df, ["g"], [F.col("v").desc(), F.col("key")], 5, salt_key=F.xxhash64("key"), salts=8)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("key"))
    exp = df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 5)
    assert got.select("key", "rank").exceptAll(exp.select("key", "rank")).count() == 0
    assert got.count() == exp.count()


@pytest.mark.parametrize("accuracy, pivots", [(10_000, 100), (50, 4), (10, 2)])
def test_medians_of_many_columns(spark, accuracy, pivots):
    rnd = np.random.default_rng(accuracy)
    n = 4001
    data = {f"c{i}": rnd.standard_normal(n) * 10**i for i in range(12)}
    data |= {"tied": np.where(rnd.random(n) < 0.8, 3.0, rnd.integers(0, 1000, n)), "two": np.where(np.arange(n) % 2 == 0, 1.0, 2.0),
             "few": np.where(rnd.random(n) < 0.97, np.nan, rnd.random(n)), "wide": np.exp(rnd.standard_normal(n) * 30), "one": np.where(np.arange(n) == 7, 5.0, np.nan),
             "none": np.full(n, np.nan), "ends": np.where(rnd.random(n) < 0.7, np.inf, rnd.random(n)), "even": np.where(np.arange(n) < 4000, rnd.random(n), np.nan)}
    df = spark.createDataFrame(pd.DataFrame(data)).repartition(5)
    got = fit_medians(df, list(data), accuracy, pivots)
    for c, x in data.items():
        x = np.sort(x[~np.isnan(x)])
        want = None if not len(x) else (x[(len(x) - 1) // 2] + x[len(x) // 2]) / 2
        assert got[c] == want, c
    assert fit_medians(df, []) == {}


def test_medians_take_three_scans_whatever_the_columns(spark, monkeypatch):
    calls, whole = [], prep._middle_values
    monkeypatch.setattr(prep, "_middle_values", lambda *a: calls.append(len(a[1])) or whole(*a))
    df = spark.range(5000).select(*[((F.col("id") * (7919 + i)) % 4999).cast("double").alias(f"c{i}") for i in range(20)])
    assert set(fit_medians(df, df.columns).values()) == {2498.5}
    assert calls == [20]  # one scan for the brackets, then two for all columns together


@pytest.mark.parametrize("size", [0.0, 0.2, 0.5, 1.0])
def test_split_equals_ranks_and_moves_no_rows(spark, size):
    df = _skewed(spark).withColumn("g", F.when(F.col("g") != "5", F.col("g"))).withColumn("wide", F.lit("x"))
    got = stratified_split(df, "g", "key", size)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan  # rows meet a table of cuts and are decided
    w = Window.partitionBy("g").orderBy(seeded_md5(42, "key"), "key")
    n = F.count(F.lit(1)).over(Window.partitionBy("g"))
    exp = df.withColumn("split", F.when(F.row_number().over(w) <= F.round(F.lit(size) * n), "test").otherwise("train"))
    assert got.exceptAll(exp.select(got.columns)).count() == 0 and got.count() == df.count()
    got = plain_split(df, "key", size)
    exp = df.withColumn("split", F.when(F.row_number().over(Window.orderBy(seeded_md5(42, "key"), "key")) <= F.ceil(F.lit(size) * 5000), "test").otherwise("train"))
    assert got.exceptAll(exp.select(got.columns)).count() == 0


def _signatures(spark, n, seed, key):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["small", "medium", None]), 100, 5, rnd.choice([0.0, 0.3, round(rnd.random(), 3)]), 0.5, rnd.choice(["low", "high", "a|b"]), 0.0,
             rnd.choice([1.0, 3.5, rnd.random() * 40]), rnd.choice([2, 2, 3, 7]), rnd.random() < 0.2, rnd.choice([0, 1, 15, 60]), rnd.choice(["mixed", "numeric"]),
             rnd.random() < 0.5) for i in range(n)]
    fields = ", ".join(f"{c} {t}" for c, t in H.SIGNATURE_FIELDS)
    return spark.createDataFrame(rows, f"{key} long, {fields}")


@pytest.mark.parametrize("k, cell_rows, least", [(3, 4096, 0.45), (3, 5, 0.45), (1, 1, 0.9), (20, 8, 0.45)])
def test_bounded_similarity_equals_all_pairs(spark, k, cell_rows, least):
    q, r = _signatures(spark, 40, k, "qid"), _signatures(spark, 400, k + 1, "rid")
    r = r.unionByName(r.filter("rid < 30").withColumn("rid", F.col("rid") + 1000))
    got = H.similar_records(q, r, "qid", "rid", "rid", least, k, cell_rows)
    pairs = q.crossJoin(r.select(*[F.col(c).alias(f"r_{c}") for c in r.columns])).select(
        "qid", F.col("r_rid").alias("rid"), F.struct(*H.COMPARED).alias("a"), F.struct(*[F.col(f"r_{c}").alias(c) for c in H.COMPARED]).alias("b"))
    exact = pairs.withColumn("s", H.similarity_expr("a", "b")).filter(F.col("s") >= least)
    w = Window.partitionBy("qid").orderBy(F.col("s").desc(), "rid")
    exact = exact.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).collect()
    assert sorted((x["qid"], x["rank"], x["rid"], x["similarity"]) for x in got.collect()) == sorted((x["qid"], x["rank"], x["rid"], x["s"]) for x in exact)


def test_no_cell_under_the_floor_is_met(spark):
    q, r = _signatures(spark, 30, 1, "qid"), H._cells(_signatures(spark, 500, 2, "rid"), 8)
    q = q.withColumn("_qg", H._text_key([F.col(f) for f in H.DISCRETE])).withColumn("floor", F.lit(0.9))
    cells = H._cell_bounds(r)
    met = H.bounded_pairs(q, H._group_pairs(q, r), cells, "floor")
    assert met.filter("bound < 0.9 * 12 - 1e-6").count() == 0
    assert met.count() < 0.1 * q.count() * cells.count()
    # bounds hold: no pair of a cell is more alike than its bound
    pairs = met.select("qid", "_cell", "bound", F.struct(*H.COMPARED).alias("a")).join(r.select("_cell", F.struct(*H.COMPARED).alias("b")), "_cell")
    assert pairs.filter(H.similarity_expr("a", "b") * 12 > F.col("bound") + 1e-9).count() == 0
    with pytest.raises(ValueError):
        H.similar_records(q, r, "qid", "rid", "rid", 0.3)
