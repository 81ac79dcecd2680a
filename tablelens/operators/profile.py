"""Dataset profiling.

Column statistics (``column_stats``) unpivot each row into ``(segment, column,
value)`` entries that a partial aggregate collapses per partition before the
first shuffle; a second aggregate yields missing and distinct counts.  No
per-column ``count_distinct`` (that would Expand every row once per column),
nothing collected, and a hot segment is spread over its distinct values.

The profile row (``profile_dataset``) reads distinct counts only for
categorical features and the target, so it takes missing counts for every
column from one wide partial aggregate and sends only those few columns
through the value shuffle; a last aggregate folds the columns into one row per
segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.functions.columns import FLOAT_TYPES, INTEGRAL_TYPES, NUMERIC_TYPES, feature_kind, is_object_like, nan_to_null, pyround
from tablelens.operators import profile_rules as R


RECORD_CLASSES = 10_000  # the most classes one profile record holds as a map


def _family(dtype: T.DataType) -> str:
    if isinstance(dtype, INTEGRAL_TYPES):
        return "long"
    if isinstance(dtype, NUMERIC_TYPES):
        return "double"
    return "string"


def profiled_fields(df: DataFrame, segment_cols=(), columns=None) -> list[T.StructField]:
    """Flat columns in schema order, minus segment columns (nested ones are excluded)."""
    keep = set(columns) if columns is not None else None
    return [
        f
        for f in df.schema.fields
        if f.name not in segment_cols and feature_kind(f.dataType) is not None and (keep is None or f.name in keep)
    ]


def feature_kinds(df: DataFrame, target: str, segment_cols=()) -> list[tuple[str, str]]:
    """(column, kind) for every feature, in schema order."""
    return [(f.name, feature_kind(f.dataType)) for f in profiled_fields(df, segment_cols) if f.name != target]


def project_features(df: DataFrame, target: str) -> DataFrame:
    """All columns but the target."""
    return df.drop(target)


def filter_labelled_rows(df: DataFrame, target: str) -> DataFrame:
    """Drop rows whose target is missing (NULL, or NaN for floats)."""
    dtype = df.schema[target].dataType
    keep = F.col(target).isNotNull()
    if isinstance(dtype, FLOAT_TYPES):
        keep = keep & ~F.isnan(F.col(target))
    return df.filter(keep)


def value_counts(df: DataFrame, fields: list[T.StructField], segment_cols=()) -> DataFrame:
    """(segments..., ci, lv, dv, sv, n): rows per distinct value of every column.

    ``ci`` is the column ordinal; the value sits in the slot of its type family
    (integral/boolean -> lv, fractional -> dv, other -> sv); a missing value
    (NULL or NaN) has all three slots NULL.
    """
    entries = []
    for i, f in enumerate(fields):
        c = F.col(f.name)
        fam = _family(f.dataType)
        if isinstance(f.dataType, FLOAT_TYPES):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        lv = c.cast("long") if fam == "long" else F.lit(None).cast("long")
        dv = c.cast("double") if fam == "double" else F.lit(None).cast("double")
        sv = c.cast("string") if fam == "string" else F.lit(None).cast("string")
        entries.append(F.struct(F.lit(i).alias("ci"), lv.alias("lv"), dv.alias("dv"), sv.alias("sv")))
    segs = [F.col(s) for s in segment_cols]
    long = df.select(*segs, F.explode(F.array(*entries)).alias("e")).select(*segment_cols, "e.*")
    return long.groupBy(*segment_cols, "ci", "lv", "dv", "sv").agg(F.count(F.lit(1)).alias("n"))


def column_stats(df: DataFrame, segment_cols=(), columns=None) -> DataFrame:
    """Per (segments..., column): n_rows, n_missing, n_unique, max/min value count.

    Columns: segments..., ci, column_name, kind, dtype, n_rows, n_missing,
    n_unique, max_value_count, min_value_count, missing_rate, missing_pct.
    """
    fields = profiled_fields(df, segment_cols, columns)
    vc = value_counts(df, fields, segment_cols)
    present = F.col("lv").isNotNull() | F.col("dv").isNotNull() | F.col("sv").isNotNull()
    stats = vc.groupBy(*segment_cols, "ci").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("n_missing"),
        F.count(F.when(present, F.lit(1))).alias("n_unique"),
        F.max(F.when(present, F.col("n"))).alias("max_value_count"),
        F.min(F.when(present, F.col("n"))).alias("min_value_count"),
    )
    names = F.array(*[F.lit(f.name) for f in fields])
    kinds = F.array(*[F.lit(feature_kind(f.dataType)) for f in fields])
    dtypes = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])
    rate = F.try_divide(F.col("n_missing").cast("double"), F.col("n_rows").cast("double"))
    return stats.select(
        *segment_cols,
        "ci",
        F.element_at(names, F.col("ci") + 1).alias("column_name"),
        F.element_at(kinds, F.col("ci") + 1).alias("kind"),
        F.element_at(dtypes, F.col("ci") + 1).alias("dtype"),
        "n_rows",
        "n_missing",
        "n_unique",
        "max_value_count",
        "min_value_count",
        rate.alias("missing_rate"),
        pyround(rate * 100, 2).alias("missing_pct"),
    )


def _missing_long(df: DataFrame, fields: list[T.StructField], segment_cols) -> DataFrame:
    """(segments..., n_rows, ci, n_missing) from one wide partial aggregate (no value shuffle)."""
    def missing(f):
        c = F.col(f.name)
        return c.isNull() | F.isnan(c) if isinstance(f.dataType, FLOAT_TYPES) else c.isNull()

    wide = df.groupBy(*segment_cols).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(missing(f), 1)).alias(f"m{i}") for i, f in enumerate(fields)],
    )
    return wide.select(
        *segment_cols, "n_rows",
        F.explode(F.array(*[F.struct(F.lit(i).alias("ci"), F.col(f"m{i}").alias("n_missing"))
                            for i in range(len(fields))])).alias("e"),
    ).select(*segment_cols, "n_rows", "e.ci", "e.n_missing")


def missing_stats(df: DataFrame, segment_cols=(), columns=None) -> DataFrame:
    """Per (segments..., column): n_rows, n_missing, missing_rate, missing_pct (2 dp)."""
    fields = profiled_fields(df, segment_cols, columns)
    names = F.array(*[F.lit(f.name) for f in fields])
    rate = F.try_divide(F.col("n_missing").cast("double"), F.col("n_rows").cast("double"))
    return _missing_long(df, fields, list(segment_cols)).select(
        *segment_cols, "ci", F.element_at(names, F.col("ci") + 1).alias("column_name"), "n_rows", "n_missing",
        rate.alias("missing_rate"), pyround(rate * 100, 2).alias("missing_pct"),
    )


def _profile_stats(df: DataFrame, fields: list[T.StructField], segment_cols, t_idx: int, every: bool = False) -> DataFrame:
    """Per (segment, column) stats for the profile row.

    Missing counts for every column come from one wide partial aggregate.
    Distinct values are only counted where the profile reads them (categorical
    features for the high-cardinality rule, and the target), so numeric
    columns never enter the (segment, column, value) shuffle, unless ``every``.
    """
    names = F.array(*[F.lit(f.name) for f in fields])
    kinds = F.array(*[F.lit(feature_kind(f.dataType)) for f in fields])
    per_col = _missing_long(df, fields, segment_cols)
    counted = [i for i, f in enumerate(fields) if every or i == t_idx or feature_kind(f.dataType) == "categorical"]
    vc = value_counts(df, [fields[i] for i in counted], segment_cols)
    # value_counts numbers its columns 0..k-1; map them back to the profile ordinals
    remap = F.array(*[F.lit(i) for i in counted])
    present = F.col("lv").isNotNull() | F.col("dv").isNotNull() | F.col("sv").isNotNull()
    distinct = vc.filter(present).groupBy(*segment_cols, F.element_at(remap, F.col("ci") + 1).alias("ci")).agg(
        F.count(F.lit(1)).alias("n_unique"), F.max("n").alias("max_value_count"), F.min("n").alias("min_value_count"),
    )
    # null-safe: rows with a NULL segment value are a segment of their own
    right = distinct.select(F.col("ci").alias("_ci"), *[F.col(c).alias(f"_s{i}") for i, c in enumerate(segment_cols)],
                            "n_unique", "max_value_count", "min_value_count")
    cond = F.col("ci") == F.col("_ci")
    for i, c in enumerate(segment_cols):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    stats = per_col.join(right, cond, "left")
    rate = F.try_divide(F.col("n_missing").cast("double"), F.col("n_rows").cast("double"))
    return stats.select(
        *segment_cols, "ci",
        F.element_at(names, F.col("ci") + 1).alias("column_name"),
        F.element_at(kinds, F.col("ci") + 1).alias("kind"),
        "n_rows", "n_missing",
        F.coalesce(F.col("n_unique"), F.lit(0)).alias("n_unique"),
        "max_value_count", "min_value_count",
        rate.alias("missing_rate"),
        pyround(rate * 100, 2).alias("missing_pct"),
    )


def fingerprint_expr(n_rows: Column, fields: list[T.StructField], target: str) -> Column:
    """G16: 'fp_' + first 12 hex of md5('shape=RxC|target=T|cols|dtypes')."""
    cols = ",".join(f.name for f in fields)
    dts = ",".join(f.dataType.simpleString() for f in fields)
    base = F.concat(
        F.lit("shape="), n_rows.cast("string"), F.lit(f"x{len(fields)}|target={target}|{cols}|{dts}")
    )
    return F.concat(F.lit("fp_"), F.substring(F.md5(base), 1, 12))


def profile_dataset(
    df: DataFrame,
    target: str,
    segment_cols=(),
    target_confidence: str | Column = "high",
    columns=None,
    full: bool = False,
) -> DataFrame:
    """One profile row per segment (one row overall without segments).

    With ``full`` the row also has ``columns``: name, type, kind, missing % and
    distinct count of every column in schema order (``profile_record``).
    """
    segment_cols = list(segment_cols)
    fields = profiled_fields(df, segment_cols, columns)
    names = [f.name for f in fields]
    if target not in names:
        raise ValueError(f"no column {target!r} to profile against")
    t_idx = names.index(target)
    t_type = df.schema[target].dataType
    n_numeric = sum(1 for f in fields if f.name != target and feature_kind(f.dataType) == "numeric")
    n_categorical = len(fields) - 1 - n_numeric
    n_cols = len(fields)
    feature_count = max(n_cols - 1, 1)

    stats = _profile_stats(df, fields, segment_cols, t_idx, full)
    dtypes = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])
    described = F.struct("ci", F.col("column_name").alias("name"), F.element_at(dtypes, F.col("ci") + 1).alias("dtype"),
                         "kind", "n_missing", "missing_pct", "n_unique")
    is_t = F.col("ci") == t_idx
    high_card = (
        (F.col("kind") == "categorical")
        & ~is_t
        & (F.col("n_unique") > R.high_card_cutoff(F.col("n_rows")))
    )
    seg = stats.groupBy(*segment_cols).agg(
        F.max("n_rows").alias("n_rows"),
        (F.avg("missing_rate") * 100).alias("overall_raw"),
        F.max("missing_pct").alias("max_pct"),
        F.sort_array(F.collect_list(F.when(high_card, F.struct("ci", "column_name")))).alias("_hc"),
        F.max(F.when(is_t, F.col("n_unique"))).alias("t_unique"),
        F.max(F.when(is_t, F.col("max_value_count"))).alias("t_max"),
        F.max(F.when(is_t, F.col("min_value_count"))).alias("t_min"),
        *([F.sort_array(F.collect_list(described)).alias("columns")] if full else []),  # schema width
    )
    conf = target_confidence if isinstance(target_confidence, Column) else F.lit(target_confidence)
    rows = F.col("n_rows")
    object_like = is_object_like(t_type)
    is_clf = F.lit(True) if object_like else (
        F.col("t_unique") <= F.greatest(F.lit(20), F.floor(F.greatest(rows, F.lit(1)) * 0.05))
    )
    num_ratio = n_numeric / feature_count
    cat_ratio = n_categorical / feature_count
    out = seg.select(
        *segment_cols,
        fingerprint_expr(rows, fields, target).alias("profile_id"),
        rows.cast("long").alias("n_rows"),
        F.lit(n_cols).alias("n_cols"),
        F.lit(feature_count).alias("feature_count"),
        F.lit(target).alias("target"),
        F.lit(t_type.simpleString()).alias("target_dtype"),
        is_clf.alias("is_classification"),
        F.lit(n_numeric).alias("numeric_count"),
        F.lit(n_categorical).alias("categorical_count"),
        "overall_raw",
        pyround(F.col("overall_raw"), 3).alias("overall_missing"),
        pyround(F.col("max_pct"), 3).alias("max_missing"),
        R.missing_severity(F.col("overall_raw"), F.col("max_pct")).alias("missing_severity"),
        pyround(F.lit(num_ratio), 3).alias("numeric_ratio"),
        pyround(F.lit(cat_ratio), 3).alias("categorical_ratio"),
        R.dominant_type(F.lit(num_ratio), F.lit(cat_ratio)).alias("dominant_feature_type"),
        F.transform("_hc", lambda s: s["column_name"]).alias("high_cardinality_features"),
        F.size("_hc").alias("high_cardinality_count"),
        R.size_bucket(rows).alias("size_bucket"),
        R.high_dimensional(F.lit(feature_count), rows).alias("high_dimensional"),
        R.feature_to_row_ratio(F.lit(feature_count), rows).alias("feature_to_row_ratio"),
        "t_unique",
        "t_max",
        "t_min",
        conf.alias("target_confidence"),
        *([F.transform("columns", lambda c: c.dropFields("ci")).alias("columns")] if full else []),
    )
    clf = F.col("is_classification")
    two_plus = F.col("t_unique") >= 2
    one = F.col("t_unique") == 1
    imb_raw = F.when(two_plus, F.col("t_max") / F.greatest(F.col("t_min"), F.lit(1))).otherwise(F.lit(1.0))
    minority = F.when(two_plus | one, F.col("t_min")).otherwise(F.lit(0))
    out = (
        out.withColumn("num_classes", F.when(clf, F.col("t_unique")).otherwise(F.lit(0)).cast("long"))
        .withColumn("imbalance_raw", F.when(clf, imb_raw))
        .withColumn("imbalance_ratio", pyround(F.col("imbalance_raw"), 3))
        .withColumn("minority_class_count", F.when(clf, minority).otherwise(F.lit(0)).cast("long"))
        .withColumn(
            "majority_class_count",
            F.when(clf, F.when(two_plus, F.col("t_max")).otherwise(minority)).otherwise(F.lit(0)).cast("long"),
        )
        .withColumn("safe_for_stratified_cv", clf & (F.col("minority_class_count") >= 3))
    )
    out = out.withColumn(
        "weak_signal_risk",
        R.weak_signal_risk(
            F.col("n_rows"), F.col("feature_count"), F.col("missing_severity"),
            F.col("high_cardinality_count"), F.col("target_confidence"),
        ),
    )
    out = out.withColumn(
        "notes",
        R.profile_notes(
            F.col("size_bucket"), F.col("high_dimensional"), F.col("high_cardinality_count"),
            F.col("missing_severity"), F.col("target_confidence"), clf, F.col("imbalance_raw"),
            F.col("minority_class_count"), F.col("weak_signal_risk"),
        ),
    )
    out = out.withColumn(
        "strategy_flags",
        R.strategy_flags(
            F.col("imbalance_ratio"), F.col("num_classes"), F.col("size_bucket"), F.col("high_cardinality_count"),
            F.col("dominant_feature_type"), F.col("max_missing"), F.col("minority_class_count"),
        ),
    )
    return out.drop("t_unique", "t_max", "t_min", "overall_raw", "imbalance_raw")


def profile_record(df: DataFrame, target: str, segment_cols=(), inference: dict | None = None, columns=None) -> DataFrame:
    """The whole profile of each segment as one nested row.

    Beside ``profile_dataset``: ``columns`` (name, dtype, kind, n_missing,
    missing_pct, n_unique in schema order), ``feature_types`` (numeric and
    categorical names), ``class_counts`` (class -> rows, missing as 'nan'; NULL
    where the target is no classification target) and ``target_inference``
    (``target.target_record``'s method, confidence and candidates; a given target
    where None).  A row holds at most ``RECORD_CLASSES`` classes; where a segment
    has more its map is NULL and ``class_counts`` (the operator) has them as rows.
    """
    segment_cols = list(segment_cols)
    inference = inference or {"method": "given", "confidence": "high", "candidates": [target]}
    base = profile_dataset(df, target, segment_cols, inference["confidence"], columns, full=True)
    named = lambda kind: F.array(*[F.lit(n) for n in _feature_names(df, target, segment_cols, columns, kind)]).cast("array<string>")
    base = base.withColumns({
        "feature_types": F.struct(named("numeric").alias("numeric"), named("categorical").alias("categorical")),
        "target_inference": F.struct(F.lit(inference["method"]).alias("method"), F.lit(inference["confidence"]).alias("confidence"),
                                     F.array(*[F.lit(c) for c in inference["candidates"]]).cast("array<string>").alias("candidates")),
    })
    held = base.filter(F.col("is_classification") & (F.col("num_classes") <= RECORD_CLASSES)).select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(segment_cols)], F.lit(1).alias("_one"))
    same = lambda prefix: [F.col(c).eqNullSafe(F.col(f"{prefix}{i}")) for i, c in enumerate(segment_cols)]
    on = F.lit(True)
    for c in same("_s"):
        on = on & c
    counts = class_counts(df, target, segment_cols)
    counts = counts.join(held, on, "left_semi") if segment_cols else counts.join(held.select(F.col("_one").alias("_h")), F.lit(1) == F.col("_h"), "left_semi")
    maps = counts.groupBy(*segment_cols).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("class_label", "n")))).alias("class_counts"))
    if not segment_cols:
        maps = maps.filter(F.size("class_counts") > 0)
    maps = maps.select(*[F.col(c).alias(f"_m{i}") for i, c in enumerate(segment_cols)], "class_counts")
    on = F.lit(True)
    for c in same("_m"):
        on = on & c
    return base.join(maps, on, "left").drop(*[f"_m{i}" for i in range(len(segment_cols))])


def _feature_names(df: DataFrame, target: str, segment_cols, columns, kind: str) -> list[str]:
    return [f.name for f in profiled_fields(df, segment_cols, columns) if f.name != target and feature_kind(f.dataType) == kind]


def flatten_profile(df: DataFrame, sep: str = "|") -> DataFrame:
    """Profile row with arrays joined by ``sep`` and flags lifted to columns (for reports/oracles)."""
    cols = []
    for f in df.schema.fields:
        if f.name == "strategy_flags":
            cols.extend(F.col(f"strategy_flags.{n}").alias(n) for n in R.FLAG_NAMES + ["replan_count"])
        elif isinstance(f.dataType, T.ArrayType):
            cols.append(F.array_join(F.col(f.name), sep).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def n_unique_approx(df: DataFrame, segment_cols=(), columns=None, rsd: float = 0.05) -> DataFrame:
    """G5 (approximate): HyperLogLog distinct counts of every column in one partial aggregate."""
    fields = profiled_fields(df, segment_cols, columns)
    clean = nan_to_null(df)  # NaN counts as missing, as in the exact count
    agg = clean.groupBy(*segment_cols).agg(*[F.approx_count_distinct(f.name, rsd).alias(f"u{i}") for i, f in enumerate(fields)])
    return agg.select(*segment_cols, F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"u{i}").alias("n_unique_approx")) for i, f in enumerate(fields)
    ])).alias("e")).select(*segment_cols, "e.*")


def distinct_sketches(df: DataFrame, segment_cols=(), columns=None, lg_k: int = 14) -> DataFrame:
    """G5 as mergeable state: (segments..., column_name, sketch), one HyperLogLog sketch per segment and column.

    Sketches of batches are united by ``merge_sketches``, so a profile grows
    without rescanning.  Missing values (NULL, NaN) count nowhere; a column
    without values has an empty sketch.
    """
    fields = profiled_fields(df, segment_cols, columns)
    def hashed(f):
        c = F.col(f.name)
        if isinstance(f.dataType, FLOAT_TYPES):
            c = F.when(~F.isnan(c), c + F.lit(0.0))  # -0.0 is 0.0
        return F.when(c.isNotNull(), F.xxhash64(c))
    agg = df.groupBy(*segment_cols).agg(*[F.hll_sketch_agg(hashed(f), lg_k).alias(f"s{i}") for i, f in enumerate(fields)])
    return agg.select(*segment_cols, F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"s{i}").alias("sketch")) for i, f in enumerate(fields)
    ])).alias("e")).select(*segment_cols, "e.*")


def merge_sketches(sketches: DataFrame, segment_cols=()) -> DataFrame:
    """The union of the sketches of each segment and column (segments may be fewer than the sketches have)."""
    return sketches.groupBy(*segment_cols, "column_name").agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_counts(sketches: DataFrame) -> DataFrame:
    """The sketches' distinct counts (relative error about 1.04 / sqrt(2 ** lg_k))."""
    return sketches.withColumn("n_unique_approx", F.hll_sketch_estimate("sketch")).drop("sketch")


def class_counts(df: DataFrame, target: str, segment_cols=()) -> DataFrame:
    """Rows per class, missing included under the key 'nan'."""
    dtype = df.schema[target].dataType
    key = F.col(target).cast("string")
    if isinstance(dtype, FLOAT_TYPES):
        key = F.when(F.isnan(F.col(target)), F.lit(None)).otherwise(key)
    return df.groupBy(*segment_cols, F.coalesce(key, F.lit("nan")).alias("class_label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def missing_by_column(df: DataFrame, segment_cols=(), columns=None) -> DataFrame:
    """Missing percentage (2 decimals) of every column."""
    return missing_stats(df, segment_cols, columns).select(*segment_cols, "column_name", "missing_pct")


def missingness_summary(df: DataFrame, segment_cols=(), columns=None) -> DataFrame:
    """Overall (mean of column rates, 3 dp), max of rounded rates, severity."""
    stats = missing_stats(df, segment_cols, columns)
    agg = stats.groupBy(*segment_cols).agg(
        (F.avg("missing_rate") * 100).alias("overall_raw"), F.max("missing_pct").alias("max_pct")
    )
    return agg.select(
        *segment_cols,
        pyround(F.col("overall_raw"), 3).alias("overall_pct"),
        pyround(F.col("max_pct"), 3).alias("max_pct"),
        R.missing_severity(F.col("overall_raw"), F.col("max_pct")).alias("severity"),
    )
