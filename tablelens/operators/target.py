"""Target resolution and inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelens.functions.columns import floor_int, is_object_like
from tablelens.operators.profile import column_stats, profiled_fields

# Fixed values that must equal the reference's: known target names, in priority order.
KNOWN_TARGET_NAMES = ["target", "label", "class", "y", "outcome", "income", "subscribed", "deposit", "diagnosis"]


def known_name_target(columns: list[str]) -> str | None:
    """First known name present case-insensitively; among case variants the last column wins."""
    by_lower = {}
    for c in columns:
        by_lower[c.lower()] = c
    for name in KNOWN_TARGET_NAMES:
        if name in by_lower:
            return by_lower[name]
    return None


def target_record(df: DataFrame, target: str) -> dict:
    """How the target was found: target, confidence, method and the best candidates.

    'auto' (trimmed, any case) infers; any other name must be a column and has method 'given' and confidence 'high'.
    """
    if target.strip().lower() != "auto":
        if target not in df.columns:
            raise ValueError(f"the table has no column {target!r}")
        return {"target": target, "confidence": "high", "method": "given", "candidates": [target]}
    row = infer_target(df, "dataset").first()
    if row is None or row["target"] is None:
        raise ValueError("no column qualifies as the target; name one")
    return {"target": row["target"], "confidence": row["confidence"], "method": row["method"], "candidates": row["candidates"].split("|")}


def resolve_target(df: DataFrame, target: str) -> tuple[str, str]:
    """The target and the confidence in it."""
    found = target_record(df, target)
    return found["target"], found["confidence"]


def target_scores(df: DataFrame, dataset: str) -> DataFrame:
    """Candidate score per column (dataset, ci, column_name, score)."""
    fields = profiled_fields(df)
    last = fields[-1].name if fields else None
    object_like = F.array(*[F.lit(is_object_like(f.dataType)) for f in fields])
    stats = column_stats(df)
    n = F.greatest(F.col("n_rows"), F.lit(1))
    score = (
        F.when(F.element_at(object_like, F.col("ci") + 1), 1.0).otherwise(0.0)
        + F.when(F.col("n_unique") <= F.greatest(F.lit(50), floor_int(n * 0.05)), 1.0).otherwise(0.0)
        + F.when(F.col("n_unique") / n < 0.20, 0.5).otherwise(0.0)
        + F.when(F.col("missing_rate") * 100 < 30.0, 0.25).otherwise(0.0)
        + F.when(F.col("column_name") == F.lit(last), 0.5).otherwise(0.0)
    )
    return stats.select(F.lit(dataset).alias("dataset"), "ci", "column_name", "n_unique", score.alias("score"))


def infer_target(df: DataFrame, dataset: str) -> DataFrame:
    """T1+T3: one row (dataset, target, method, confidence, candidates '|'-joined)."""
    known = known_name_target([f.name for f in profiled_fields(df)])
    spark = df.sparkSession
    if known is not None:
        return spark.createDataFrame(
            [(dataset, known, "known_name", "high", known)],
            "dataset string, target string, method string, confidence string, candidates string",
        )
    scores = target_scores(df, dataset)
    # one row per column: the window holds at most the schema width
    w = Window.partitionBy("dataset").orderBy(F.col("score").desc(), F.col("column_name").desc())
    ranked = scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 3)
    agg = ranked.groupBy("dataset").agg(
        F.sort_array(F.collect_list(F.struct("rank", "column_name", "score"))).alias("top")
    )
    best = F.col("top")[0]
    conf = F.when(best["score"] >= 2.0, "medium").otherwise("low")
    method = F.when(best["score"] >= 1.25, "heuristic_score").otherwise("failed")
    return agg.select(
        "dataset",
        F.when(best["score"] >= 1.25, best["column_name"]).alias("target"),
        method.alias("method"),
        conf.alias("confidence"),
        F.array_join(F.transform("top", lambda s: s["column_name"]), "|").alias("candidates"),
    )


def is_classification(df: DataFrame, dataset: str, target: str) -> DataFrame:
    """T4: object-like target, or few distinct values relative to all rows (missing included)."""
    stats = column_stats(df, columns=[target])
    if is_object_like(df.schema[target].dataType):
        rule = F.lit(True)
    else:
        rule = F.col("n_unique") <= F.greatest(F.lit(20), floor_int(F.greatest(F.col("n_rows"), F.lit(1)) * 0.05))
    return stats.select(
        F.lit(dataset).alias("dataset"), F.lit(target).alias("target"), "n_unique", rule.alias("is_classification")
    )
