"""Run history: counters, recency, signatures and similarity search.

History is an append-only table of runs ``(run_id, fingerprint, ts,
best_model, best_score, <flag booleans>, causes...)``.  Per-dataset counters
are aggregates over it, never stored state.  Similarity search is a top-k join
with upper bounds over cells of like signatures (``similar_records``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelens.functions.columns import pyround
from tablelens.functions.ranking import top_k
from tablelens.session import checkpoint_dir

SUCCESS_SCORE = 0.70

SIGNATURE_FIELDS = [
    ("size_bucket", "string"), ("rows", "bigint"), ("cols", "bigint"), ("numeric_ratio", "double"),
    ("categorical_ratio", "double"), ("missing_severity", "string"), ("overall_missing", "double"),
    ("imbalance_ratio", "double"), ("num_classes", "bigint"), ("high_dimensional", "boolean"),
    ("high_cardinality_count", "bigint"), ("dominant_feature_type", "string"), ("weak_signal_risk", "boolean"),
]


# ------------------------------------------------------------------ counters (H3)
def _first_seen(*order: str) -> Column:
    return F.min(F.struct(*[F.col(c) for c in order])).alias("first_seen")


def model_outcomes(runs: DataFrame, key: str = "fingerprint") -> DataFrame:
    """(key, model, successful, failed, first_seen): best-model counts split at score 0.70."""
    ok = F.coalesce(F.col("best_score"), F.lit(0.0)) >= SUCCESS_SCORE
    return runs.filter(F.col("best_model").isNotNull()).groupBy(key, F.col("best_model").alias("model")).agg(
        F.count(F.when(ok, 1)).alias("successful"), F.count(F.when(~ok, 1)).alias("failed"),
        _first_seen("ts", "run_id"),
    )


def strategy_outcomes(runs: DataFrame, flag_cols: list[str], key: str = "fingerprint") -> DataFrame:
    """(key, strategy, successful, unsuccessful, first_seen) over the flags that were on."""
    entries = F.array(*[F.struct(F.lit(c).alias("strategy"), F.col(c).alias("on")) for c in flag_cols])
    long = runs.select(key, "ts", "run_id", "best_score", F.explode(entries).alias("e")) \
        .filter(F.col("e.on")).select(key, "ts", "run_id", "best_score", F.col("e.strategy").alias("strategy"))
    ok = F.coalesce(F.col("best_score"), F.lit(0.0)) >= SUCCESS_SCORE
    return long.groupBy(key, "strategy").agg(
        F.count(F.when(ok, 1)).alias("successful"), F.count(F.when(~ok, 1)).alias("unsuccessful"),
        _first_seen("ts", "run_id"),
    )


def root_cause_counts(runs: DataFrame, cause_cols: list[str] | str, key: str = "fingerprint") -> DataFrame:
    """(key, cause, n, first_seen) over the causes recorded per run (one array column, or several columns)."""
    causes = F.col(cause_cols) if isinstance(cause_cols, str) else F.array(*[F.col(c) for c in cause_cols])
    long = runs.select(key, "ts", "run_id", F.explode(causes).alias("cause")) \
        .filter(F.col("cause").isNotNull())
    return long.groupBy(key, "cause").agg(F.count(F.lit(1)).alias("n"), _first_seen("ts", "run_id"))


# ------------------------------------------------------------------ recency (H4-H6)
def last_runs(runs: DataFrame, k: int = 10, key: str = "fingerprint") -> DataFrame:
    """H4: latest ``k`` runs per dataset (two-stage top-k: a hot dataset is split by run id first)."""
    return top_k(runs, [key], [F.col("ts").desc(), F.col("run_id").desc()], k,
                 salt_key=F.xxhash64("run_id"), rank_col="recency")


def recent_runs(runs: DataFrame, k: int = 50) -> DataFrame:
    """H5: latest ``k`` runs overall (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return runs.orderBy(F.col("ts").desc(), F.col("run_id").desc()).limit(k)


def latest_per_dataset(runs: DataFrame, cols: list[str], key: str = "fingerprint") -> DataFrame:
    """H6: the newest values per dataset (``max_by`` over (ts, run_id), a partial aggregate)."""
    latest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct("ts", "run_id")).alias("latest")
    return runs.groupBy(key).agg(latest, F.count(F.lit(1)).alias("n_runs")).select(key, "latest.*", "n_runs")


def append_runs(runs: DataFrame, path: str, batch: str) -> None:
    """Append runs to the history table, partitioned by batch and month (no rewrite of older files).

    Writing the same ``batch`` again replaces it, so a replayed batch counts
    once.  Rows are rebalanced by month: each task writes few files, and a month
    that holds most rows is split over several tasks.
    """
    out = runs.withColumns({"run_batch": F.lit(batch), "run_month": F.date_format("ts", "yyyy-MM")})
    out.hint("rebalance", "run_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("run_batch", "run_month").parquet(path)


def read_history(spark, path: str, legacy_path: str | None = None) -> DataFrame:
    """Read the history table, optionally unioned with an older layout by column name."""
    cur = spark.read.parquet(path)
    if legacy_path is None:
        return cur
    old = spark.read.parquet(legacy_path)
    if "dataset_fingerprint" in old.columns and "fingerprint" not in old.columns:
        old = old.withColumnRenamed("dataset_fingerprint", "fingerprint")
    return cur.unionByName(old, allowMissingColumns=True)


# ------------------------------------------------------------------ signatures and similarity (H2, H7, H8)
def profile_signature(profiles: DataFrame, key: str) -> DataFrame:
    """H2: the 13 signature fields of profile rows, with defaults."""
    c = F.col
    return profiles.select(
        c(key),
        c("size_bucket"),
        F.coalesce(c("n_rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(c("n_cols"), F.lit(0)).cast("bigint").alias("cols"),
        F.coalesce(c("numeric_ratio"), F.lit(0.0)).cast("double").alias("numeric_ratio"),
        F.coalesce(c("categorical_ratio"), F.lit(0.0)).cast("double").alias("categorical_ratio"),
        F.coalesce(c("missing_severity"), F.lit("low")).alias("missing_severity"),
        F.coalesce(c("overall_missing"), F.lit(0.0)).cast("double").alias("overall_missing"),
        F.coalesce(c("imbalance_ratio"), F.lit(1.0)).cast("double").alias("imbalance_ratio"),
        F.coalesce(c("num_classes"), F.lit(0)).cast("bigint").alias("num_classes"),
        F.coalesce(c("high_dimensional"), F.lit(False)).alias("high_dimensional"),
        F.coalesce(c("high_cardinality_count"), F.lit(0)).cast("bigint").alias("high_cardinality_count"),
        F.coalesce(c("dominant_feature_type"), F.lit("mixed")).alias("dominant_feature_type"),
        F.coalesce(c("weak_signal_risk"), F.lit(False)).alias("weak_signal_risk"),
    )


def _clip_sim(d: Column, cap: float) -> Column:
    return F.greatest(F.lit(0.0), F.lit(1.0) - F.least(d / F.lit(cap), F.lit(1.0)))


def similarity_expr(a: str, b: str) -> Column:
    """H7 as a column expression over two signature structs ``a`` and ``b``."""
    A, B = F.col(a), F.col(b)
    eq = lambda f, w: F.when(A[f] == B[f], F.lit(w)).otherwise(F.lit(0.0))
    score = (
        F.lit(2.0) * _clip_sim(F.abs(A["numeric_ratio"] - B["numeric_ratio"]), 1.0)
        + eq("size_bucket", 1.5) + eq("missing_severity", 1.5) + eq("dominant_feature_type", 1.5)
        + F.lit(1.5) * _clip_sim(F.abs(A["imbalance_ratio"] - B["imbalance_ratio"]), 8.0)
        + eq("num_classes", 1.0) + eq("high_dimensional", 1.0)
        + F.lit(1.0) * _clip_sim(F.abs(A["high_cardinality_count"].cast("double")
                                       - B["high_cardinality_count"].cast("double")), 10.0)
        + eq("weak_signal_risk", 1.0)
    )
    return score / F.lit(12.0)


COMPARED = ["size_bucket", "numeric_ratio", "missing_severity", "imbalance_ratio", "num_classes", "high_dimensional",
            "high_cardinality_count", "dominant_feature_type", "weak_signal_risk"]


#: Weight of each field that must agree, and (weight, distance of no similarity) of each ratio.
DISCRETE = {"size_bucket": 1.5, "missing_severity": 1.5, "dominant_feature_type": 1.5, "num_classes": 1.0, "high_dimensional": 1.0, "weak_signal_risk": 1.0}
RATIOS = {"numeric_ratio": (2.0, 1.0), "imbalance_ratio": (1.5, 8.0), "high_cardinality_count": (1.0, 10.0)}
#: Range of each ratio that the grid cuts into equal steps; the last step is open.
GRID = {"numeric_ratio": 1.0, "imbalance_ratio": 16.0, "high_cardinality_count": 20.0}
CELL_ROWS = 4096
_SLACK = 1e-9  # sums of bounds and of similarities may differ in their last bits


def _text_key(cols) -> Column:
    return F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)]))


def _cells(records: DataFrame, steps: int) -> DataFrame:
    """Records with their group (``_rg``: the discrete fields) and grid cell inside it (``_cell``)."""
    grid = [F.floor(F.least(F.col(f).cast("double") / F.lit(top), F.lit(1.0)) * steps) for f, top in GRID.items()]
    return records.withColumn("_rg", _text_key([F.col(f) for f in DISCRETE])).withColumn("_cell", _text_key([F.col("_rg"), *grid]))


def _cell_bounds(celled: DataFrame) -> DataFrame:
    """(_rg, _cell, lo_<ratio>, hi_<ratio>): the range of every ratio inside a cell."""
    ends = [f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in RATIOS for n, f in (("lo", F.min), ("hi", F.max))]
    return celled.groupBy("_rg", "_cell").agg(*ends)


def _group_pairs(queries: DataFrame, records: DataFrame) -> DataFrame:
    """(_qg, _rg, agree): groups that agree on a discrete field at least, and the weight they agree on.

    The ratios give at most 4.5 of 12, so a match of 0.45 or more agrees somewhere:
    groups meet over equal (field, value) pairs, never all with all.
    """
    def fields(df, name):
        group = df.groupBy(_text_key([F.col(f) for f in DISCRETE]).alias(name)).agg(*[F.first(f).alias(f) for f in DISCRETE])
        each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), F.lit(w).alias("weight")) for f, w in DISCRETE.items()])
        return group.select(name, F.explode(each).alias("e")).select(name, "e.*")

    met = fields(queries, "_qg").join(fields(records, "_rg").drop("weight"), ["field", "value"])
    return met.groupBy("_qg", "_rg").agg(F.sum("weight").alias("agree"))


def _cell_bound() -> Column:
    """Upper bound (of 12) of a query's similarity with any record of a cell."""
    out = F.col("agree")
    for c, (weight, cap) in RATIOS.items():
        v = F.col(c).cast("double")
        gap = F.greatest(F.col(f"lo_{c}") - v, v - F.col(f"hi_{c}"), F.lit(0.0))
        out = out + F.lit(weight) * _clip_sim(gap, cap)
    return out


def bounded_pairs(queries: DataFrame, groups: DataFrame, cells: DataFrame, floor: str) -> DataFrame:
    """(query row, _cell, bound): the cells that may hold a record of similarity ``floor`` (a column of queries) or more."""
    most = sum(w for w, _ in RATIOS.values())
    near = queries.join(groups, "_qg").filter(F.col("agree") + most >= F.col(floor) * 12 - _SLACK)
    return near.join(cells, "_rg").withColumn("bound", _cell_bound()).filter(F.col("bound") >= F.col(floor) * 12 - _SLACK)


def similar_records(queries: DataFrame, records: DataFrame, query_key: str, record_key: str,
                    order_col: str, min_similarity: float = 0.45, k: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """H8: top-``k`` history records per query profile with similarity >= ``min_similarity``.

    ``queries``/``records`` are signature tables (``profile_signature``);
    records also carry ``order_col`` (insertion order, the tie-breaker).
    Queries with equal compared fields are scored once; of records with equal
    ones only the first ``k`` can be among the best.

    A top-k join with upper bounds: records are grouped by their discrete fields
    and, inside a group, by a grid over the ratios (so many steps that a cell has
    about ``cell_rows`` records), and every cell keeps the range of each ratio.
    A first pass scores a query against its best few cells of the two groups that
    agree most; the ``k``-th best found is a floor.  The second pass scores it
    against every cell whose bound reaches the floor and no other.  Both tables
    are written once; nothing is collected or broadcast by hint.
    Output: (query_key, rank, record_key, similarity).
    """
    if min_similarity * 12 <= sum(w for w, _ in RATIOS.values()):
        raise ValueError("min_similarity must be over 0.375, so that every match agrees on a discrete field")
    checkpoint_dir(queries.sparkSession)
    q = queries.select(F.col(query_key).alias("_qid"), *COMPARED).withColumn("_same", _text_key([F.col(c) for c in COMPARED])).checkpoint()
    distinct = q.groupBy("_same").agg(*[F.first(c).alias(c) for c in COMPARED]).withColumn("_qg", _text_key([F.col(f) for f in DISCRETE]))
    r = records.select(F.col(record_key).alias("_rid"), F.col(order_col).alias("_ord"), *COMPARED)
    r = top_k(r, COMPARED, [F.col("_ord"), F.col("_rid")], k, salt_key=F.xxhash64("_rid")).drop("rank").checkpoint()
    n = r.count()
    steps = min(64, max(1, math.ceil((n / cell_rows) ** (1 / 3))))
    r = _cells(r, steps)
    cells, groups = _cell_bounds(r), _group_pairs(distinct, r)
    found = r.select("_cell", "_rid", "_ord", F.struct(*COMPARED).alias("_r"))

    def scored(pairs: DataFrame, floor: str) -> DataFrame:
        met = pairs.select("_same", floor, "_cell", F.struct(*COMPARED).alias("_q")).join(found, "_cell")
        return met.select("_same", floor, "_rid", "_ord", similarity_expr("_q", "_r").alias("similarity")).filter(F.col("similarity") >= F.col(floor))

    best = [F.col("similarity").desc(), F.col("_ord"), F.col("_rid")]
    asked = distinct.withColumn("_floor", F.lit(float(min_similarity)))
    if n > cell_rows:  # below that one cell's worth of records costs less than finding the floors
        closest = groups.withColumn("_n", F.row_number().over(Window.partitionBy("_qg").orderBy(F.col("agree").desc(), "_rg"))).filter("_n <= 2").drop("_n")
        first = bounded_pairs(asked, closest, cells, "_floor")
        first = first.withColumn("_n", F.row_number().over(Window.partitionBy("_same").orderBy(F.col("bound").desc(), "_cell"))).filter("_n <= 4")
        reached = top_k(scored(first, "_floor"), ["_same"], best, k, salt_key=F.xxhash64("_rid")).filter(F.col("rank") == k)
        reached = reached.select("_same", F.col("similarity").alias("_kth"))
        asked = asked.join(reached, "_same", "left").withColumn("_floor", F.coalesce("_kth", "_floor")).drop("_kth")
    ranked = top_k(scored(bounded_pairs(asked, groups, cells, "_floor"), "_floor"), ["_same"], best, k, salt_key=F.xxhash64("_rid"))
    return q.select("_qid", "_same").join(ranked, "_same").select(
        F.col("_qid").alias(query_key), F.col("rank").cast("long").alias("rank"), F.col("_rid").alias(record_key), "similarity")


# ------------------------------------------------------------------ votes and hints
def weighted_votes(matches: DataFrame, counters: DataFrame, query_key: str, record_key: str, name_col: str,
                   count_col: str, k, n_matches: int = 3, kind_col: str | None = None) -> DataFrame:
    """H9: sum of similarity x count per name over the matched records; top ``k`` per query.

    The sum runs in match-rank order (at most ``n_matches`` terms), so it is the
    same double whatever the shuffle order.  Ties keep first appearance: the
    better-ranked record, then the name's first run.
    """
    j = matches.join(counters.filter(F.col(count_col) > 0), on=record_key)
    term = F.col("similarity") * F.col(count_col)
    keys = [query_key] + ([kind_col] if kind_col else [])
    agg = j.groupBy(*keys, F.col(name_col).alias("name")).agg(
        *[F.max(F.when(F.col("rank") == i, term)).alias(f"_s{i}") for i in range(1, n_matches + 1)],
        F.min(F.struct("rank", "first_seen")).alias("_first"),
    )
    score = F.coalesce(F.col("_s1"), F.lit(0.0))
    for i in range(2, n_matches + 1):
        score = score + F.coalesce(F.col(f"_s{i}"), F.lit(0.0))
    agg = agg.withColumn("score", score).drop(*[f"_s{i}" for i in range(1, n_matches + 1)])
    # one row per name: ties compared at 9 decimals, then by first appearance
    w = Window.partitionBy(*keys).orderBy(F.round("score", 9).desc(), F.col("_first"))
    limit = k if isinstance(k, Column) else F.lit(k)
    return agg.withColumn("position", F.row_number().over(w).cast("long")).filter(F.col("position") <= limit) \
        .drop("_first")


def exact_hint(models: DataFrame, strategies: DataFrame, key: str = "fingerprint") -> DataFrame:
    """Per dataset the top-5 successful models, top-3 failed, top-5 strategies by count.

    Ties keep the order in which names first appeared in the runs.
    """
    def ranked(df, count_col, kind, k):
        w = Window.partitionBy(key).orderBy(F.col(count_col).desc(), F.col("first_seen"))
        return df.filter(F.col(count_col) > 0).withColumn("position", F.row_number().over(w).cast("long")) \
            .filter(F.col("position") <= k).select(key, F.lit(kind).alias("kind"), F.col(df.columns[1]).alias("name"),
                                                   F.col(count_col).cast("long").alias("n"), "position")
    return ranked(models, "successful", "preferred", 5).unionByName(ranked(models, "failed", "avoid", 3)) \
        .unionByName(ranked(strategies, "successful", "strategy", 5))


def vote_counters(runs: DataFrame, flag_cols: list[str], cause_cols, key: str = "fingerprint") -> DataFrame:
    """(key, kind, name, n, first_seen): the four counters that vote (preferred, avoid, strategy, cause) in one table."""
    mo = model_outcomes(runs, key)
    part = lambda df, kind, name, n: df.select(key, F.lit(kind).alias("kind"), F.col(name).alias("name"), F.col(n).alias("n"), "first_seen")
    return part(mo, "preferred", "model", "successful").unionByName(part(mo, "avoid", "model", "failed")) \
        .unionByName(part(strategy_outcomes(runs, flag_cols, key), "strategy", "strategy", "successful")) \
        .unionByName(part(root_cause_counts(runs, cause_cols, key), "cause", "cause", "n"))


def similar_hint(matches: DataFrame, runs: DataFrame, query_key: str, record_key: str = "fingerprint") -> DataFrame:
    """Similarity of the top match, runs matched (<= 10 per record), best model of its latest run.

    ``matches`` rows: (query_key, rank, record_key, similarity).
    """
    latest = latest_per_dataset(runs, ["best_model"], record_key)
    j = matches.join(latest, on=record_key, how="left")
    return j.groupBy(query_key).agg(
        pyround(F.max(F.when(F.col("rank") == 1, F.col("similarity"))), 3).alias("similarity"),
        F.sum(F.least(F.coalesce(F.col("n_runs"), F.lit(0)), F.lit(10))).alias("matched_runs"),
        F.max(F.when(F.col("rank") == 1, F.col("best_model"))).alias("best_model"),
    )


def resolve_hint(profiles: DataFrame, runs: DataFrame, similar: DataFrame, query_key: str) -> DataFrame:
    """The exact record's hint when the profile's fingerprint has runs, else the similar one.

    ``profiles`` rows: (query_key, fingerprint); ``similar``: ``similar_hint``.
    """
    latest = latest_per_dataset(runs, ["best_model"]).select("fingerprint", F.col("best_model").alias("exact_best"))
    other = similar.select(query_key, F.col("best_model").alias("similar_best"), "similarity")
    j = profiles.join(latest, on="fingerprint", how="left").join(other, on=query_key, how="left")
    exact = F.col("exact_best").isNotNull()
    found = F.col("similar_best").isNotNull() | F.col("similarity").isNotNull()
    return j.select(query_key, F.when(exact, "exact_fingerprint").when(found, "similar_dataset").alias("source"),
                    F.when(exact, F.col("exact_best")).otherwise(F.col("similar_best")).alias("best_model"))


def append_log(events: DataFrame, path: str, batch: str) -> None:
    """S6 write side: events (run_id, ts, seq, stage, message), failures and notes among them; a batch replaces its first copy."""
    out = events.withColumn("log_batch", F.lit(batch))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("log_batch").parquet(path)


def append_note(spark, path: str, run_id: str, ts, message: str) -> None:
    """A note (run_id, ts, message) beside the history; a run's note replaces its earlier one."""
    note = spark.createDataFrame([(run_id, ts, message)], "run_id string, ts timestamp, message string")
    note.withColumn("run_batch", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_batch").parquet(path)


def run_log_summary(log: DataFrame) -> DataFrame:
    """S6 read side: events and runs per stage."""
    return log.groupBy("stage").agg(F.count(F.lit(1)).alias("n_events"), F.countDistinct("run_id").alias("n_runs"))


def last_event(log: DataFrame) -> DataFrame:
    """The latest stage and message of every run (max_by, partial aggregation)."""
    return log.groupBy("run_id").agg(
        F.max_by(F.struct("stage", "message"), F.struct("ts", "seq")).alias("e"), F.max("ts").alias("ts")
    ).select("run_id", "ts", "e.stage", "e.message")
