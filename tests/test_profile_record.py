"""Nested profile records, mergeable distinct counts and information ranking on small tables."""

import math

import pytest
from pyspark.sql import functions as F

from tablelens.operators import profile as P
from tablelens.operators.prep import information_ranking
from tablelens.operators.target import target_record


def _table(spark):
    rows = [(i, None if i % 4 == 0 else float("nan") if i % 4 == 1 else i / 2, "ab"[i % 2], None if i == 7 else "xyz"[i % 3], None if i < 5 else "s") for i in range(20)]
    return spark.createDataFrame(rows, "id long, v double, c string, label string, seg string")


def test_one_row_holds_the_whole_profile(spark):
    df = _table(spark)
    rec = P.profile_record(df, "label", inference=target_record(df, "auto")).first()
    assert [(c["name"], c["dtype"], c["n_missing"], c["missing_pct"], c["n_unique"]) for c in rec["columns"]] == [
        ("id", "bigint", 0, 0.0, 20), ("v", "double", 10, 50.0, 10), ("c", "string", 0, 0.0, 2), ("label", "string", 1, 5.0, 3), ("seg", "string", 5, 25.0, 1)]
    assert rec["class_counts"] == {"x": 7, "y": 6, "z": 6, "nan": 1}
    assert rec["feature_types"].asDict() == {"numeric": ["id", "v"], "categorical": ["c", "seg"]}
    assert rec["target_inference"]["method"] == "known_name" and rec["target_inference"]["candidates"] == ["label"]
    plain = P.profile_dataset(df, "label").first().asDict()
    assert {k: rec[k] for k in plain} == plain


def test_segments_null_segment_and_other_targets(spark, monkeypatch):
    recs = {r["seg"]: r for r in P.profile_record(_table(spark), "label", ["seg"]).collect()}
    assert recs[None]["class_counts"] == {"x": 2, "y": 2, "z": 1} and recs["s"]["class_counts"]["nan"] == 1
    many = spark.range(2000).withColumn("y", F.col("id") * 1.5)
    rec = P.profile_record(many, "y").first()
    assert rec["class_counts"] is None and not rec["is_classification"] and rec["columns"][1]["n_unique"] == 2000
    empty = P.profile_record(_table(spark).limit(0), "label").first()
    assert empty["n_rows"] == 0 and empty["class_counts"] is None and len(empty["columns"]) == 5
    monkeypatch.setattr(P, "RECORD_CLASSES", 2)
    assert P.profile_record(_table(spark), "label").first()["class_counts"] is None


def test_merged_sketches_equal_the_whole(spark):
    df = spark.range(30000).select((F.col("id") % 7000).alias("k"), F.when(F.col("id") % 2 == 0, (F.col("id") % 3000).cast("double")).alias("d"),
                                   F.lit(None).cast("string").alias("none"), F.lit("a").alias("seg"))
    part = [P.distinct_sketches(df.filter(F.col("k") % 3 == i), ["seg"]) for i in range(3)]
    merged = P.sketch_counts(P.merge_sketches(part[0].unionByName(part[1]).unionByName(part[2]), ["seg"]))
    got = {r["column_name"]: r["n_unique_approx"] for r in merged.collect()}
    whole = {r["column_name"]: r["n_unique_approx"] for r in P.sketch_counts(P.distinct_sketches(df, ["seg"])).collect()}
    assert set(got) == {"k", "d", "none"} and got["none"] == whole["none"] == 0
    for c, exact in (("k", 7000), ("d", 1500)):
        assert abs(got[c] - exact) <= 0.03 * exact and abs(whole[c] - exact) <= 0.03 * exact


def test_information_is_the_entropy_where_a_feature_tells_the_label(spark):
    df = spark.range(1200).select((F.col("id") % 4).alias("y"), (F.col("id") % 4 + 10).alias("same"), (F.col("id") % 3).alias("free"),
                                  F.when(F.col("id") % 2 == 0, F.col("id") % 4).alias("half"), F.lit(None).cast("string").alias("none"), F.col("id").alias("key"))
    got = {r["column_name"]: r for r in information_ranking(df, "y", ["same", "free", "half", "none", "key"]).collect()}
    assert got["same"]["information"] == got["key"]["information"] == pytest.approx(math.log(4), abs=1e-6)
    assert got["free"]["information"] == 0.0 and got["half"]["information"] == pytest.approx(math.log(2), abs=1e-6)
    assert got["none"]["information"] is None and got["none"]["rank"] == 5 and got["key"]["rank"] == 1
