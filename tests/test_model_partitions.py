"""Training rows are dealt out before a fit, however few partitions they come in."""

from pyspark.sql import functions as F

from tablelens.operators import models as MD


def _sizes(df):
    return df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()


def test_rows_in_one_partition_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(MD, "ROWS_PER_PARTITION", 100)
    one = spark.range(950).withColumn("x", F.col("id") * 2).coalesce(1)
    got = MD._sized(one)
    assert len(_sizes(got)) == 10 and max(_sizes(got)) <= 150
    assert got.exceptAll(one).count() == 0 and one.exceptAll(got).count() == 0
    assert max(_sizes(MD.spread(one, 950))) <= 150


def test_merging_never_doubles_a_partition(spark, monkeypatch):
    monkeypatch.setattr(MD, "ROWS_PER_PARTITION", 100)
    assert max(_sizes(MD._sized(spark.range(0, 950, 1, 12)))) <= 150
    assert len(_sizes(MD._sized(spark.range(0, 950, 1, 40)))) == 10
    assert len(_sizes(MD._sized(spark.range(0, 50, 1, 8)))) == 1
