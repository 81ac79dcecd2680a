"""Registered queries over the dirty fixture F11: NULL segments, keys and labels, boolean, constant and empty columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelens.functions.columns import r6
from tablelens.operators import prep as E
from tablelens.operators import profile as P
from tablelens.operators import split as D
from tablelens.plans.fixtures import fixture, with_fixtures

SEED = 42
NUMERIC = ["flag", "constant", "nothing", "price"]


def q_dirty_profile(spark, sf):
    """Rows whose segment is NULL are a segment of their own, with its classes."""
    prof = P.profile_dataset(fixture(spark, sf, "f11"), "label", segment_cols=["seg"])
    return prof.select("seg", "n_rows", "num_classes", "minority_class_count", "majority_class_count", "max_missing")


def q_dirty_split(spark, sf):
    """Every row lands in a part, also those without key or label."""
    split = D.stratified_split(fixture(spark, sf, "f11"), "label", "row_key", 0.2, SEED)
    return split.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


def q_dirty_means(spark, sf):
    """Booleans count as 0/1; a column without values has no mean."""
    df = fixture(spark, sf, "f11")
    means = E.fit_means(df, NUMERIC)
    rows = [(c, means[c]) for c in NUMERIC]
    return spark.createDataFrame(rows, "column_name string, mean double").select("column_name", r6(F.col("mean")).alias("mean"))


def q_dirty_scaled(spark, sf):
    """Imputed and scaled columns of all rows: sums of squares are row counts, 0 for the constant."""
    df = fixture(spark, sf, "f11").select("flag", "constant", "price")
    cols = df.columns
    filled = E.apply_fill(df, E.fit_means(df, cols))
    scaled = E.apply_scaler(filled, E.fit_scaler(filled, cols))
    return scaled.agg(*[r6(F.sum(F.col(c) * F.col(c)) / F.count(F.lit(1))).alias(c) for c in cols])


def q_dirty_correlation(spark, sf):
    """A constant feature has no correlation and ranks last."""
    df = fixture(spark, sf, "f11").withColumn("y", F.when(F.col("label") == "F", 1).otherwise(0))
    return E.correlation_ranking(df, "y", ["flag", "constant", "nothing", "price"])


QUERIES = {
    "dirty_profile": q_dirty_profile,
    "dirty_split": q_dirty_split,
    "dirty_means": q_dirty_means,
    "dirty_scaled": q_dirty_scaled,
    "dirty_correlation": q_dirty_correlation,
}

_MISSING = " , ".join(f"count(*) - count({c})" for c in ("row_key", "flag", "constant", "nothing", "price", "label"))
_FILLED = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT avg(CAST({c} AS DOUBLE)) FROM f11)) AS {c}" for c in ("flag", "constant", "price"))
_CORR = "UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CASE WHEN max(x) > min(x) THEN abs(corr(x, y)) END AS a FROM (SELECT CAST({c} AS DOUBLE) AS x, y FROM z WHERE {c} IS NOT NULL) t "
    for c in ("flag", "constant", "nothing", "price")
)
ORACLES = {
    "dirty_profile": with_fixtures(
        f"""k AS (SELECT seg, label, count(*) AS n FROM f11 WHERE label IS NOT NULL GROUP BY seg, label),
c AS (SELECT seg, count(*) AS num_classes, min(n) AS lo, max(n) AS hi FROM k GROUP BY seg),
t AS (SELECT seg, count(*) AS n_rows, greatest({_MISSING}) AS most FROM f11 GROUP BY seg)
SELECT t.seg, n_rows, num_classes, lo AS minority_class_count, hi AS majority_class_count, round(round(100.0 * most / n_rows, 2), 3) AS max_missing
FROM t JOIN c ON t.seg IS NOT DISTINCT FROM c.seg""", "f11"),
    "dirty_split": with_fixtures(
        """t AS (SELECT label, count(*) AS n, CAST(round(0.2 * count(*)) AS BIGINT) AS k FROM f11 GROUP BY label)
SELECT label, 'test' AS split, k AS n FROM t WHERE k > 0 UNION ALL SELECT label, 'train', n - k FROM t WHERE n > k""", "f11"),
    "dirty_means": with_fixtures(
        " UNION ALL ".join(f"SELECT '{c}' AS column_name, round(avg(CAST({c} AS DOUBLE)), 6) AS mean FROM f11" for c in NUMERIC), "f11"),
    "dirty_scaled": with_fixtures(
        f"f AS (SELECT {_FILLED} FROM f11)\nSELECT CASE WHEN stddev_pop(flag) > 0 THEN 1.0::DOUBLE ELSE 0.0 END AS flag, 0.0::DOUBLE AS constant, "
        "CASE WHEN stddev_pop(price) > 0 THEN 1.0::DOUBLE ELSE 0.0 END AS price FROM f", "f11"),
    "dirty_correlation": with_fixtures(
        f"""z AS (SELECT *, CASE WHEN label = 'F' THEN 1.0 ELSE 0.0 END AS y FROM f11),
q AS ({_CORR})
SELECT column_name, round(a, 6) AS abs_corr, row_number() OVER (ORDER BY a DESC NULLS LAST, column_name) AS rank FROM q""", "f11"),
}
