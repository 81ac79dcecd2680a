"""Registered queries for target inference and profiling (T, G, P) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelens.operators import profile as P
from tablelens.operators import profile_rules as R
from tablelens.plans.fixtures import fixture, with_fixtures
from tablelens.sources.tables import read_table

# F3 columns as (name, kind, is_float, spark type name); l_suppkey is the segment.
F3_COLS = [
    ("l_orderkey", "numeric", False, "bigint"),
    ("l_partkey", "numeric", False, "bigint"),
    ("l_suppkey", "numeric", False, "bigint"),
    ("l_linenumber", "numeric", False, "int"),
    ("l_extendedprice", "numeric", True, "double"),
    ("l_quantity", "numeric", True, "double"),
    ("l_tax", "numeric", True, "double"),
    ("l_discount", "numeric", True, "double"),
    ("l_returnflag", "categorical", False, "string"),
    ("label", "categorical", False, "string"),
]
F3_SEG_COLS = [c for c in F3_COLS if c[0] != "l_suppkey"]
PART_COLS = [
    ("p_partkey", "numeric", False, "bigint"),
    ("p_name", "categorical", False, "string"),
    ("p_brand", "categorical", False, "string"),
    ("p_type", "categorical", False, "string"),
    ("p_size", "numeric", False, "int"),
    ("p_retailprice", "numeric", True, "double"),
]


# --------------------------------------------------------------------------- oracle SQL builders
def _colstats_ctes(src: str, cols, segment: str | None) -> str:
    seg = f"{segment} AS seg" if segment else "0 AS seg"
    vals = ", ".join(
        f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}" if fl else c for c, _, fl, _ in cols
    )
    aggs = ", ".join(f"count(*) - count({c}) AS m_{i}, count(DISTINCT {c}) AS u_{i}" for i, (c, *_r) in enumerate(cols))
    longs = "\n UNION ALL ".join(
        f"SELECT seg, {i} AS ci, '{c}' AS column_name, '{k}' AS kind, n_rows, m_{i} AS n_missing, u_{i} AS n_unique FROM wide"
        for i, (c, k, _f, _t) in enumerate(cols)
    )
    return (
        f"base AS (SELECT {seg}, {vals} FROM {src}),\n"
        f"wide AS (SELECT seg, count(*) AS n_rows, {aggs} FROM base GROUP BY seg),\n"
        f"cs AS ({longs})"
    )


def _with(body: str, fx_names) -> str:
    return with_fixtures(body, *fx_names) if fx_names else f"WITH {body}"


def _profile_sql(fx: str, cols, target: str, segment: str | None, confidence: str = "high", fx_names=None) -> str:
    fx_names = (fx,) if fx_names is None else fx_names
    names = [c[0] for c in cols]
    t = names.index(target)
    feats = [c for c in cols if c[0] != target]
    n_num = sum(1 for c in feats if c[1] == "numeric")
    fc = max(len(cols) - 1, 1)
    n_cat = len(cols) - 1 - n_num
    nr, cr = n_num / fc, n_cat / fc
    fp_tail = f"x{len(cols)}|target={target}|{','.join(names)}|{','.join(c[3] for c in cols)}"
    target_object_like = cols[t][1] == "categorical"
    hc_cond = (
        f"kind = 'categorical' AND ci <> {t} AND "
        "n_unique > least(50, greatest(20, floor(greatest(n_rows, 1) * 0.1)))"
    )
    seg_out = f"seg AS {segment}, " if segment else ""
    clf = "TRUE" if target_object_like else "(coalesce(c.t_unique, 0) <= greatest(20, floor(greatest(s.n_rows, 1) * 0.05)))"
    body = f"""
{_colstats_ctes(fx, cols, segment)},
seg AS (
  SELECT seg, max(n_rows) AS n_rows, avg(n_missing * 1.0 / n_rows) * 100 AS overall_raw,
         max(round(100.0 * n_missing / n_rows, 2)) AS max_pct,
         coalesce(string_agg(CASE WHEN {hc_cond} THEN column_name END, '|' ORDER BY ci), '') AS hc_names,
         count(CASE WHEN {hc_cond} THEN 1 END) AS hc_count
  FROM cs GROUP BY seg),
cls AS (
  SELECT seg, count(*) AS t_unique, max(n) AS t_max, min(n) AS t_min
  FROM (SELECT seg, {target} AS v, count(*) AS n FROM base WHERE {target} IS NOT NULL GROUP BY seg, {target}) x
  GROUP BY seg),
p0 AS (
  SELECT s.*, coalesce(c.t_unique, 0) AS t_unique, c.t_max, c.t_min, {clf} AS is_classification,
         CASE WHEN s.n_rows < 300 THEN 'tiny' WHEN s.n_rows < 3000 THEN 'small'
              WHEN s.n_rows < 30000 THEN 'medium' ELSE 'large' END AS size_bucket,
         CASE WHEN s.overall_raw >= 25 OR s.max_pct >= 60 THEN 'severe'
              WHEN s.overall_raw >= 10 OR s.max_pct >= 35 THEN 'high'
              WHEN s.overall_raw >= 3 OR s.max_pct >= 15 THEN 'medium' ELSE 'low' END AS missing_severity,
         ({fc} > greatest(80, floor(sqrt(greatest(s.n_rows, 1)) * 6)) OR {fc} > s.n_rows) AS high_dimensional
  FROM seg s LEFT JOIN cls c ON s.seg = c.seg),
p1 AS (
  SELECT *,
    CASE WHEN is_classification THEN t_unique ELSE 0 END AS num_classes,
    CASE WHEN NOT is_classification THEN NULL WHEN t_unique >= 2 THEN t_max * 1.0 / greatest(t_min, 1) ELSE 1.0 END AS imbalance_raw,
    CASE WHEN NOT is_classification THEN 0 WHEN t_unique >= 1 THEN t_min ELSE 0 END AS minority_class_count,
    CASE WHEN NOT is_classification THEN 0 WHEN t_unique >= 2 THEN t_max WHEN t_unique = 1 THEN t_min ELSE 0 END AS majority_class_count,
    ((n_rows < 500 AND {fc} > greatest(floor(n_rows / 5), 10))
      OR (missing_severity IN ('high', 'severe') AND hc_count > 0) OR '{confidence}' = 'low') AS weak_signal_risk
  FROM p0),
p2 AS (SELECT *, round(imbalance_raw, 3) AS imbalance_ratio, round(max_pct, 3) AS max_missing FROM p1)
SELECT {seg_out}
  concat('fp_', substring(md5(concat('shape=', CAST(n_rows AS VARCHAR), '{fp_tail}')), 1, 12)) AS profile_id,
  CAST(n_rows AS BIGINT) AS n_rows, CAST({len(cols)} AS BIGINT) AS n_cols, CAST({fc} AS BIGINT) AS feature_count,
  '{target}' AS target, '{cols[t][3]}' AS target_dtype, is_classification,
  CAST({n_num} AS BIGINT) AS numeric_count, CAST({n_cat} AS BIGINT) AS categorical_count,
  round(overall_raw, 3) AS overall_missing, max_missing, missing_severity,
  round({nr}, 3) AS numeric_ratio, round({cr}, 3) AS categorical_ratio,
  CASE WHEN {nr} > 0.7 THEN 'numeric' WHEN {cr} > 0.7 THEN 'categorical' ELSE 'mixed' END AS dominant_feature_type,
  hc_names AS high_cardinality_features, CAST(hc_count AS BIGINT) AS high_cardinality_count,
  size_bucket, high_dimensional, round({fc} * 1.0 / greatest(n_rows, 1), 4) AS feature_to_row_ratio,
  '{confidence}' AS target_confidence,
  CAST(num_classes AS BIGINT) AS num_classes, imbalance_ratio,
  CAST(minority_class_count AS BIGINT) AS minority_class_count,
  CAST(majority_class_count AS BIGINT) AS majority_class_count,
  (is_classification AND minority_class_count >= 3) AS safe_for_stratified_cv,
  weak_signal_risk,
  concat_ws('|',
    CASE WHEN size_bucket = 'tiny' THEN '{R.NOTE_TINY}' END,
    CASE WHEN size_bucket = 'small' THEN '{R.NOTE_SMALL}' END,
    CASE WHEN high_dimensional THEN '{R.NOTE_HIGH_DIM}' END,
    CASE WHEN hc_count > 0 THEN '{R.NOTE_HIGH_CARD}' END,
    CASE WHEN missing_severity IN ('high', 'severe') THEN '{R.NOTE_MISSING}' END,
    CASE WHEN '{confidence}' = 'low' THEN '{R.NOTE_TARGET_LOW}' END,
    CASE WHEN is_classification AND imbalance_raw >= 3.0 THEN '{R.NOTE_IMBALANCE}' END,
    CASE WHEN is_classification AND minority_class_count < 20 THEN '{R.NOTE_MINORITY}' END,
    CASE WHEN NOT is_classification THEN '{R.NOTE_NOT_CLASSIFICATION}' END,
    CASE WHEN weak_signal_risk THEN '{R.NOTE_WEAK_SIGNAL}' END) AS notes,
  {_flags_sql("coalesce(imbalance_ratio, 1.0)", "num_classes", "size_bucket", "hc_count",
              f"(CASE WHEN {nr} > 0.7 THEN 'numeric' WHEN {cr} > 0.7 THEN 'categorical' ELSE 'mixed' END)",
              "max_missing", "minority_class_count")}
FROM p2"""
    return _with(body, fx_names)


def _flags_sql(imb, ncls, bucket, hc, dom, maxm, minority) -> str:
    small = f"{bucket} IN ('tiny', 'small')"
    boost = f"({dom} <> 'categorical' AND {bucket} <> 'large')"
    return ",\n  ".join(
        [
            f"{imb} >= 3.0 AS use_class_weight",
            f"{hc} > 0 AS group_rare_categories",
            f"({small} OR coalesce({minority}, 0) < 25) AS enable_cv",
            f"({bucket} = 'tiny' OR coalesce({minority}, 0) < 15) AS compare_on_cv",
            f"{bucket} = 'tiny' AS prefer_simple_models",
            "FALSE AS expand_model_diversity",
            f"({small} AND {dom} <> 'categorical' AND NOT ({hc} > 0)) AS include_kernel_model",
            f"{boost} AS include_boosting",
            "TRUE AS include_extra_trees",
            f"{boost} AS include_gradient_boosting",
            f"(coalesce({ncls}, 0) = 2 AND {imb} >= 4.0) AS tune_decision_threshold",
            f"{maxm} >= 40.0 AS drop_high_missing_features",
            "CAST(0 AS BIGINT) AS replan_count",
        ]
    )


def _colstats_sql(fx: str, cols, select: str, segment: str | None = None, fx_names=None) -> str:
    fx_names = (fx,) if fx_names is None else fx_names
    return _with(f"{_colstats_ctes(fx, cols, segment)}\n{select}", fx_names)


# --------------------------------------------------------------------------- Spark side
def _flat(df):
    out = P.flatten_profile(df)
    return out.withColumn("replan_count", F.col("replan_count").cast("long"))


def q_profile_table(spark, sf):
    return _flat(P.profile_dataset(fixture(spark, sf, "f3"), "label"))


def q_profile_by_segment(spark, sf):
    return _flat(P.profile_dataset(fixture(spark, sf, "f3"), "label", segment_cols=["l_suppkey"]))


def q_missing_pct_by_column(spark, sf):
    return P.missing_by_column(fixture(spark, sf, "f3"))


def q_missingness_summary(spark, sf):
    return P.missingness_summary(fixture(spark, sf, "f3"))


def q_missing_severity(spark, sf):
    return P.missingness_summary(fixture(spark, sf, "f3"), segment_cols=["l_suppkey"])


def q_n_unique_by_column(spark, sf):
    return P.column_stats(fixture(spark, sf, "f3")).select("column_name", "kind", "n_unique")


def q_class_counts(spark, sf):
    return P.class_counts(fixture(spark, sf, "f3"), "label")


def q_class_imbalance(spark, sf):
    prof = P.profile_dataset(fixture(spark, sf, "f3"), "label")
    return prof.select(
        "num_classes", "majority_class_count", "minority_class_count", "imbalance_ratio", "safe_for_stratified_cv"
    )


def q_profile_shape(spark, sf):
    prof = P.profile_dataset(fixture(spark, sf, "f3"), "label")
    return prof.select("n_rows", F.col("n_cols").cast("long").alias("n_cols"), F.col("feature_count").cast("long").alias("feature_count"))


def q_segment_size_bucket(spark, sf):
    prof = P.profile_dataset(fixture(spark, sf, "f3"), "label", segment_cols=["l_suppkey"])
    return prof.select("l_suppkey", "n_rows", "size_bucket", "high_dimensional", "feature_to_row_ratio")


def q_high_cardinality_columns(spark, sf):
    part = read_table(spark, sf, "part")
    prof = P.profile_dataset(part, "p_size")
    return prof.select(F.explode("high_cardinality_features").alias("column_name"))


def q_feature_balance(spark, sf):
    prof = P.profile_dataset(read_table(spark, sf, "part"), "p_size")
    return prof.select("numeric_ratio", "categorical_ratio", "dominant_feature_type", "is_classification", "num_classes")


def _f5_rules(spark, sf):
    return R.facts_rules(fixture(spark, sf, "f5"))


def q_weak_signal_risk(spark, sf):
    return _f5_rules(spark, sf).select(
        "dataset_id", "size_bucket", "missing_severity", "dominant_feature_type", "high_dimensional", "weak_signal_risk"
    )


def q_profile_notes(spark, sf):
    return _f5_rules(spark, sf).select(
        "dataset_id", F.posexplode("notes").alias("position", "note")
    ).select("dataset_id", F.col("position").cast("long").alias("position"), "note")


def q_strategy_flags(spark, sf):
    df = _f5_rules(spark, sf)
    return df.select(
        "dataset_id",
        *[F.col(f"strategy_flags.{n}").alias(n) for n in R.FLAG_NAMES],
        F.col("strategy_flags.replan_count").cast("long").alias("replan_count"),
    )


def q_dataset_fingerprint(spark, sf):
    f3 = P.profile_dataset(fixture(spark, sf, "f3"), "label").select(F.lit("f3").alias("dataset"), "profile_id")
    part = P.profile_dataset(read_table(spark, sf, "part"), "p_size").select(F.lit("part").alias("dataset"), "profile_id")
    return f3.unionByName(part)


def q_filter_labelled_rows(spark, sf):
    return P.filter_labelled_rows(fixture(spark, sf, "f3"), "label")


def q_project_features(spark, sf):
    return P.project_features(fixture(spark, sf, "f2"), "label")


def q_n_unique_approx(spark, sf):
    return P.n_unique_approx(fixture(spark, sf, "f3"))


def q_profile_record(spark, sf):
    """The nested record of each supplier segment, its column list and class map as text."""
    rec = P.profile_record(fixture(spark, sf, "f3"), "label", segment_cols=["l_suppkey"])
    pct = lambda c: F.round(c["missing_pct"] * 100).cast("long").cast("string")
    column = lambda c: F.concat_ws(":", c["name"], c["dtype"], pct(c), c["n_unique"].cast("string"))
    return rec.select(
        "l_suppkey", "profile_id", "n_rows", "num_classes",
        F.array_join(F.transform("columns", column), "|").alias("columns"),
        F.array_join("feature_types.numeric", "|").alias("numeric_features"),
        F.array_join("feature_types.categorical", "|").alias("categorical_features"),
        F.array_join(F.transform(F.array_sort(F.map_entries("class_counts")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), "|").alias("class_counts"),
        F.col("target_inference.method").alias("method"))


def q_n_unique_sketch(spark, sf):
    """Sketches of two batches and all suppliers, united; each estimate within 3 standard errors of the exact count."""
    f3 = fixture(spark, sf, "f3")
    names = [c for c in f3.columns if c != "l_suppkey"]
    halves = [P.distinct_sketches(f3.filter(F.col("l_orderkey") % 2 == i), ["l_suppkey"], names) for i in (0, 1)]
    whole = P.sketch_counts(P.merge_sketches(halves[0].unionByName(halves[1])))
    exact = P.column_stats(f3, columns=names).select("column_name", "n_unique")
    error = 3 * 1.04 / 2 ** 7
    return exact.join(whole, "column_name").select(
        "column_name", "n_unique", (F.abs(F.col("n_unique_approx") - F.col("n_unique")) <= F.col("n_unique") * error).alias("within"))


QUERIES = {
    "profile_record": q_profile_record,
    "n_unique_sketch": q_n_unique_sketch,
    "n_unique_approx": q_n_unique_approx,
    "profile_table": q_profile_table,
    "profile_by_segment": q_profile_by_segment,
    "missing_pct_by_column": q_missing_pct_by_column,
    "missingness_summary": q_missingness_summary,
    "missing_severity": q_missing_severity,
    "n_unique_by_column": q_n_unique_by_column,
    "class_counts": q_class_counts,
    "class_imbalance": q_class_imbalance,
    "profile_shape": q_profile_shape,
    "segment_size_bucket": q_segment_size_bucket,
    "high_cardinality_columns": q_high_cardinality_columns,
    "feature_balance": q_feature_balance,
    "weak_signal_risk": q_weak_signal_risk,
    "profile_notes": q_profile_notes,
    "strategy_flags": q_strategy_flags,
    "dataset_fingerprint": q_dataset_fingerprint,
    "filter_labelled_rows": q_filter_labelled_rows,
    "project_features": q_project_features,
}


def _f5_rules_sql(select: str) -> str:
    return with_fixtures(
        f"""
r0 AS (SELECT *,
  CASE WHEN n_rows < 300 THEN 'tiny' WHEN n_rows < 3000 THEN 'small' WHEN n_rows < 30000 THEN 'medium' ELSE 'large' END AS size_bucket,
  CASE WHEN overall_missing >= 25 OR max_missing >= 60 THEN 'severe' WHEN overall_missing >= 10 OR max_missing >= 35 THEN 'high'
       WHEN overall_missing >= 3 OR max_missing >= 15 THEN 'medium' ELSE 'low' END AS missing_severity,
  CASE WHEN numeric_ratio > 0.7 THEN 'numeric' WHEN categorical_ratio > 0.7 THEN 'categorical' ELSE 'mixed' END AS dominant_feature_type,
  (feature_count > greatest(80, floor(sqrt(greatest(n_rows, 1)) * 6)) OR feature_count > n_rows) AS high_dimensional,
  CASE WHEN is_classification THEN minority_class_count ELSE 0 END AS minority_eff,
  CASE WHEN is_classification THEN imbalance_ratio END AS imbalance_eff,
  CASE WHEN is_classification THEN num_classes ELSE 0 END AS classes_eff
FROM f5),
r1 AS (SELECT *, ((n_rows < 500 AND feature_count > greatest(floor(n_rows / 5), 10))
   OR (missing_severity IN ('high', 'severe') AND high_cardinality_count > 0) OR target_confidence = 'low') AS weak_signal_risk
FROM r0)
{select}""",
        "f5",
    )


_F5_NOTES = f"""
SELECT dataset_id, CAST(pos - 1 AS BIGINT) AS position, note FROM (
  SELECT dataset_id, generate_subscripts(arr, 1) AS pos, unnest(arr) AS note FROM (
    SELECT dataset_id, list_filter([
      CASE WHEN size_bucket = 'tiny' THEN '{R.NOTE_TINY}' END,
      CASE WHEN size_bucket = 'small' THEN '{R.NOTE_SMALL}' END,
      CASE WHEN high_dimensional THEN '{R.NOTE_HIGH_DIM}' END,
      CASE WHEN high_cardinality_count > 0 THEN '{R.NOTE_HIGH_CARD}' END,
      CASE WHEN missing_severity IN ('high', 'severe') THEN '{R.NOTE_MISSING}' END,
      CASE WHEN target_confidence = 'low' THEN '{R.NOTE_TARGET_LOW}' END,
      CASE WHEN is_classification AND imbalance_eff >= 3.0 THEN '{R.NOTE_IMBALANCE}' END,
      CASE WHEN is_classification AND minority_eff < 20 THEN '{R.NOTE_MINORITY}' END,
      CASE WHEN NOT is_classification THEN '{R.NOTE_NOT_CLASSIFICATION}' END,
      CASE WHEN weak_signal_risk THEN '{R.NOTE_WEAK_SIGNAL}' END], lambda x: x IS NOT NULL) AS arr
    FROM r1) a) b"""


def _oracles() -> dict[str, str]:
    o = {}
    o["profile_table"] = _profile_sql("f3", F3_COLS, "label", None)
    o["profile_by_segment"] = _profile_sql("f3", F3_SEG_COLS, "label", "l_suppkey")
    o["missing_pct_by_column"] = _colstats_sql(
        "f3", F3_COLS, "SELECT column_name, round(100.0 * n_missing / n_rows, 2) AS missing_pct FROM cs"
    )
    summary = """SELECT {seg}round(avg(n_missing * 1.0 / n_rows) * 100, 3) AS overall_pct,
       round(max(round(100.0 * n_missing / n_rows, 2)), 3) AS max_pct,
       CASE WHEN avg(n_missing * 1.0 / n_rows) * 100 >= 25 OR max(round(100.0 * n_missing / n_rows, 2)) >= 60 THEN 'severe'
            WHEN avg(n_missing * 1.0 / n_rows) * 100 >= 10 OR max(round(100.0 * n_missing / n_rows, 2)) >= 35 THEN 'high'
            WHEN avg(n_missing * 1.0 / n_rows) * 100 >= 3 OR max(round(100.0 * n_missing / n_rows, 2)) >= 15 THEN 'medium'
            ELSE 'low' END AS severity
FROM cs GROUP BY seg"""
    o["missingness_summary"] = _colstats_sql("f3", F3_COLS, summary.format(seg=""))
    o["missing_severity"] = _colstats_sql("f3", F3_SEG_COLS, summary.format(seg="seg AS l_suppkey, "), "l_suppkey")
    o["n_unique_by_column"] = _colstats_sql("f3", F3_COLS, "SELECT column_name, kind, n_unique FROM cs")
    o["class_counts"] = with_fixtures(
        "SELECT coalesce(label, 'nan') AS class_label, count(*) AS n FROM f3 GROUP BY 1", "f3"
    )
    prof = _profile_sql("f3", F3_COLS, "label", None)
    o["class_imbalance"] = (
        f"SELECT num_classes, majority_class_count, minority_class_count, imbalance_ratio, safe_for_stratified_cv "
        f"FROM ({prof}) q"
    )
    o["profile_shape"] = f"SELECT n_rows, n_cols, feature_count FROM ({prof}) q"
    segp = _profile_sql("f3", F3_SEG_COLS, "label", "l_suppkey")
    o["segment_size_bucket"] = (
        f"SELECT l_suppkey, n_rows, size_bucket, high_dimensional, feature_to_row_ratio FROM ({segp}) q"
    )
    dtype = "CASE ci " + " ".join(f"WHEN {i} THEN '{c[3]}'" for i, c in enumerate(F3_SEG_COLS)) + " END"
    feats = lambda kind: "|".join(c[0] for c in F3_SEG_COLS if c[1] == kind and c[0] != "label")
    o["profile_record"] = f"""WITH prof AS ({segp}),
cols AS (SELECT seg, string_agg(concat(column_name, ':', {dtype}, ':', CAST(CAST(round(round(100.0 * n_missing / n_rows, 2) * 100) AS BIGINT) AS VARCHAR),
                                       ':', CAST(n_unique AS VARCHAR)), '|' ORDER BY ci) AS columns
         FROM ({_colstats_sql("f3", F3_SEG_COLS, "SELECT * FROM cs", "l_suppkey")}) c GROUP BY seg),
cc AS (SELECT seg, string_agg(concat(class_label, '=', CAST(n AS VARCHAR)), '|' ORDER BY class_label) AS class_counts
       FROM ({with_fixtures("SELECT l_suppkey AS seg, coalesce(label, 'nan') AS class_label, count(*) AS n FROM f3 GROUP BY 1, 2", "f3")}) x GROUP BY seg)
SELECT p.l_suppkey, p.profile_id, p.n_rows, p.num_classes, cols.columns, '{feats("numeric")}' AS numeric_features,
       '{feats("categorical")}' AS categorical_features, cc.class_counts, 'given' AS method
FROM prof p JOIN cols ON p.l_suppkey IS NOT DISTINCT FROM cols.seg JOIN cc ON p.l_suppkey IS NOT DISTINCT FROM cc.seg"""
    o["n_unique_sketch"] = _colstats_sql("f3", F3_SEG_COLS, "SELECT column_name, n_unique, TRUE AS within FROM cs")
    part_sql = _profile_sql("part", PART_COLS, "p_size", None, fx_names=())
    o["high_cardinality_columns"] = (
        f"SELECT unnest(string_split(high_cardinality_features, '|')) AS column_name FROM ({part_sql}) q "
        f"WHERE high_cardinality_features <> ''"
    )
    o["feature_balance"] = (
        f"SELECT numeric_ratio, categorical_ratio, dominant_feature_type, is_classification, num_classes FROM ({part_sql}) q"
    )
    o["weak_signal_risk"] = _f5_rules_sql(
        "SELECT dataset_id, size_bucket, missing_severity, dominant_feature_type, high_dimensional, weak_signal_risk FROM r1"
    )
    o["profile_notes"] = _f5_rules_sql(_F5_NOTES)
    o["strategy_flags"] = _f5_rules_sql(
        "SELECT dataset_id,\n  "
        + _flags_sql("coalesce(imbalance_eff, 1.0)", "classes_eff", "size_bucket", "high_cardinality_count",
                     "dominant_feature_type", "max_missing", "minority_eff")
        + "\nFROM r1"
    )
    o["dataset_fingerprint"] = (
        f"SELECT 'f3' AS dataset, profile_id FROM ({prof}) a UNION ALL "
        f"SELECT 'part' AS dataset, profile_id FROM ({part_sql}) b"
    )
    o["filter_labelled_rows"] = with_fixtures("SELECT * FROM f3 WHERE label IS NOT NULL", "f3")
    o["project_features"] = with_fixtures(
        "SELECT row_key, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment FROM f2", "f2"
    )
    return o


ORACLES = _oracles()
