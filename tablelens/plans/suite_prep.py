"""Registered queries for splits (D1-D5), feature preparation (E1-E10) and extras (A1-A5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelens.functions.columns import r6
from tablelens.operators import prep as E
from tablelens.operators import split as D
from tablelens.operators.profile import missing_stats
from tablelens.plans.fixtures import fixture, with_fixtures
from tablelens.sources.tables import read_table

SEED = 42
F3_FILL = ["l_quantity", "l_tax", "l_discount"]
F3_SCALE = ["l_extendedprice", "l_quantity", "l_tax", "l_discount"]
PART_CATS = ["p_name", "p_brand", "p_type"]
F2_CATS = ["o_orderpriority", "c_mktsegment"]
F2_FEATURES = ["o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment"]
F1_NUMERIC = ["n_chars", "n_words", "quality", "score"]


def _f2_split(spark, sf):
    return D.stratified_split(fixture(spark, sf, "f2"), "label", "row_key", 0.2, SEED)


def q_split_stratified(spark, sf):
    return _f2_split(spark, sf).select("row_key", "label", "split")


def q_split_plain(spark, sf):
    return D.plain_split(fixture(spark, sf, "f2"), "row_key", 0.2, SEED).select("row_key", "split")


def q_split_validation(spark, sf):
    train = _f2_split(spark, sf).filter(F.col("split") == "train").drop("split")
    return D.validation_split(train, "label", "row_key", SEED).select("row_key", "label", "split")


def q_stratified_folds(spark, sf):
    train = _f2_split(spark, sf).filter(F.col("split") == "train").drop("split")
    return D.stratified_folds(train, "label", "row_key", 3, SEED).select("row_key", "label", "fold")


def q_split_info(spark, sf):
    split, stratified = D.holdout_split(fixture(spark, sf, "f2"), "label", "row_key", 0.2, SEED)
    return D.split_info(split, stratified)


def _f3_keys(df, cols):
    return df.select("l_orderkey", "l_linenumber", *[r6(F.col(c)).alias(c) for c in cols])


def q_impute_mean(spark, sf):
    f3 = fixture(spark, sf, "f3")
    return _f3_keys(E.apply_fill(f3, E.fit_means(f3, F3_FILL)), F3_FILL)


def q_impute_median(spark, sf):
    f3 = fixture(spark, sf, "f3")
    return _f3_keys(E.apply_fill(f3, E.fit_medians(f3, F3_FILL)), F3_FILL)


def _auto_filled(spark, sf):
    f3 = fixture(spark, sf, "f3")
    max_pct = missing_stats(f3).agg(F.max("missing_pct")).first()[0]
    return E.apply_fill(f3, E.fit_imputer(f3, F3_SCALE, max_pct))


def q_impute_auto(spark, sf):
    return _f3_keys(_auto_filled(spark, sf), F3_SCALE)


def q_standard_scale(spark, sf):
    filled = _auto_filled(spark, sf)
    return _f3_keys(E.apply_scaler(filled, E.fit_scaler(filled, F3_SCALE)), F3_SCALE)


def q_impute_mode(spark, sf):
    return E.fit_modes(fixture(spark, sf, "f3"), ["l_returnflag", "label"])


def q_one_hot_long(spark, sf):
    split = _f2_split(spark, sf)
    train, test = split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")
    cats = E.category_counts(train, F2_CATS)
    return E.one_hot_long(test, "row_key", F2_CATS, cats)


def _part_rare(spark, sf, cap):
    part = read_table(spark, sf, "part")
    n = part.count()
    return E.rare_category_table(part, PART_CATS, profile_rows=n, n_train=n, max_categories=cap)


def q_group_rare_categories(spark, sf):
    return _part_rare(spark, sf, None)


def q_cap_categories(spark, sf):
    return _part_rare(spark, sf, 25)


def q_class_weights(spark, sf):
    return E.class_weights(fixture(spark, sf, "f1"), "label")


def q_missing_indicators(spark, sf):
    f3 = fixture(spark, sf, "f3")
    out = E.missing_indicators(f3, [c for c in f3.columns if c != "label"])
    return out.select("l_orderkey", "l_linenumber", *[c for c in out.columns if c.startswith("missing_")])


def q_drop_high_missing(spark, sf):
    f3 = fixture(spark, sf, "f3")
    feats = [c for c in f3.columns if c not in ("label", "l_suppkey")]
    return E.high_missing_columns(f3, ["l_suppkey"], feats).select("l_suppkey", "column_name", "missing_pct")


def q_leaky_columns(spark, sf):
    return E.leaky_columns(fixture(spark, sf, "f2"), "label", F2_FEATURES)


def q_feature_selection(spark, sf):
    return E.correlation_ranking(fixture(spark, sf, "f1"), "label", F1_NUMERIC)


INFO_COLS = ["l_returnflag", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_tax"]


def q_feature_information(spark, sf):
    return E.information_ranking(fixture(spark, sf, "f3"), "label", INFO_COLS)


def q_regression_metrics(spark, sf):
    return E.regression_metrics(fixture(spark, sf, "f1"), "label", "score", ["lang"])


def q_scan_csv_typed(spark, sf):
    """F2 written as header CSV to the shared scratch folder, read back with type inference."""
    import uuid

    from tablelens.session import checkpoint_dir
    from tablelens.sources.csv import read_csv_typed

    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    fixture(spark, sf, "f2").write.option("header", True).csv(path)
    return read_csv_typed(spark, path)


def q_normalise_missing_tokens(spark, sf):
    """F3's 'NA' and '' return flags become NULL."""
    from tablelens.sources.csv import normalise_missing_tokens

    f3 = fixture(spark, sf, "f3")
    return normalise_missing_tokens(f3, ["l_returnflag"]).select("l_orderkey", "l_linenumber", "l_returnflag", "l_tax")


QUERIES = {
    "scan_csv_typed": q_scan_csv_typed,
    "normalise_missing_tokens": q_normalise_missing_tokens,
    "split_stratified": q_split_stratified,
    "split_plain": q_split_plain,
    "split_validation": q_split_validation,
    "stratified_folds": q_stratified_folds,
    "split_info": q_split_info,
    "impute_mean": q_impute_mean,
    "impute_median": q_impute_median,
    "impute_auto": q_impute_auto,
    "standard_scale": q_standard_scale,
    "impute_mode": q_impute_mode,
    "one_hot_long": q_one_hot_long,
    "group_rare_categories": q_group_rare_categories,
    "cap_categories": q_cap_categories,
    "class_weights": q_class_weights,
    "missing_indicators": q_missing_indicators,
    "drop_high_missing": q_drop_high_missing,
    "leaky_columns": q_leaky_columns,
    "feature_selection": q_feature_selection,
    "feature_information": q_feature_information,
    "regression_metrics": q_regression_metrics,
}

# ------------------------------------------------------------------------- oracles
_RANK = "row_number() OVER (PARTITION BY {part} ORDER BY md5(concat('{seed}', ':', CAST(row_key AS VARCHAR))), row_key)"
_F2_SPLIT = f"""sp AS (
  SELECT *, CASE WHEN {_RANK.format(part='label', seed=SEED)} <= round(0.2 * count(*) OVER (PARTITION BY label))
                 THEN 'test' ELSE 'train' END AS split
  FROM f2)"""


def _clean(c):
    return f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"


def _f3_fill_sql(stat: str, cols) -> str:
    stats = ", ".join(f"{stat}({_clean(c)}) AS s_{c}" for c in cols)
    sel = ", ".join(f"round(coalesce({_clean(c)}, s.s_{c}), 6) AS {c}" for c in cols)
    return with_fixtures(f"SELECT l_orderkey, l_linenumber, {sel} FROM f3, (SELECT {stats} FROM f3) s", "f3")


def _scale_sql() -> str:
    # auto rule: F3's max missing% is read from the data, as in the Spark side
    fills = ", ".join(
        f"CASE WHEN mx >= 15 THEN med_{c} ELSE avg_{c} END AS s_{c}" for c in F3_SCALE
    )
    stats = ", ".join(f"median({_clean(c)}) AS med_{c}, avg({_clean(c)}) AS avg_{c}" for c in F3_SCALE)
    floats = {"l_extendedprice", "l_quantity", "l_tax", "l_discount"}
    maxm = " , ".join(f"round(100.0 * (count(*) - count({_clean(c) if c in floats else c})) / count(*), 2)" for c in
                      ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity",
                       "l_tax", "l_discount", "l_returnflag", "label"])
    filled = ", ".join(f"coalesce({_clean(c)}, s_{c}) AS {c}" for c in F3_SCALE)
    return f"""st AS (SELECT {stats}, greatest({maxm}) AS mx FROM f3),
fl AS (SELECT {fills} FROM st),
filled AS (SELECT l_orderkey, l_linenumber, {filled} FROM f3, fl)"""


def _oracles():
    from tablelens.sources.csv import MISSING_TOKENS
    o = {}
    o["scan_csv_typed"] = with_fixtures("SELECT * FROM f2", "f2")
    tokens = ", ".join("'" + t.replace("'", "''") + "'" for t in MISSING_TOKENS)
    o["normalise_missing_tokens"] = with_fixtures(
        f"SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IN ({tokens}) THEN NULL ELSE l_returnflag END AS l_returnflag, "
        "CASE WHEN isnan(l_tax) THEN NULL ELSE l_tax END AS l_tax FROM f3", "f3")
    o["split_stratified"] = with_fixtures(f"{_F2_SPLIT}\nSELECT row_key, label, split FROM sp", "f2")
    o["split_plain"] = with_fixtures(
        f"SELECT row_key, CASE WHEN row_number() OVER (ORDER BY md5(concat('{SEED}', ':', CAST(row_key AS VARCHAR))), row_key)"
        " <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM f2",
        "f2",
    )
    o["split_validation"] = with_fixtures(
        f"""{_F2_SPLIT},
tr AS (SELECT * FROM sp WHERE split = 'train')
SELECT row_key, label,
  CASE WHEN {_RANK.format(part='label', seed=f'{SEED}:valid')} <= round(0.2 * count(*) OVER (PARTITION BY label))
       THEN 'valid' ELSE 'fit' END AS split
FROM tr""",
        "f2",
    )
    o["stratified_folds"] = with_fixtures(
        f"""{_F2_SPLIT},
tr AS (SELECT * FROM sp WHERE split = 'train')
SELECT row_key, label, CAST(({_RANK.format(part='label', seed=f'{SEED}:fold')} - 1) % 3 AS INTEGER) AS fold FROM tr""",
        "f2",
    )
    o["split_info"] = with_fixtures(
        f"""{_F2_SPLIT}
SELECT count(CASE WHEN split = 'train' THEN 1 END) AS train_rows, count(CASE WHEN split = 'test' THEN 1 END) AS test_rows,
       (SELECT min(n) >= 2 FROM (SELECT count(*) AS n FROM f2 GROUP BY label) x) AS stratified
FROM sp""",
        "f2",
    )
    o["impute_mean"] = _f3_fill_sql("avg", F3_FILL)
    o["impute_median"] = _f3_fill_sql("median", F3_FILL)
    o["impute_auto"] = with_fixtures(
        f"{_scale_sql()}\nSELECT l_orderkey, l_linenumber, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in F3_SCALE) + " FROM filled",
        "f3",
    )
    scaled = ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN coalesce(s_{c}, 0) = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in F3_SCALE
    )
    mstats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in F3_SCALE)
    o["standard_scale"] = with_fixtures(
        f"{_scale_sql()},\nms AS (SELECT {mstats} FROM filled)\nSELECT l_orderkey, l_linenumber, {scaled} FROM filled, ms",
        "f3",
    )
    o["impute_mode"] = with_fixtures(
        """c AS (SELECT 'l_returnflag' AS column_name, l_returnflag AS category, count(*) AS n FROM f3 WHERE l_returnflag IS NOT NULL GROUP BY 2
       UNION ALL SELECT 'label', label, count(*) FROM f3 WHERE label IS NOT NULL GROUP BY 2),
r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, category) AS rn FROM c)
SELECT column_name, category AS mode FROM r WHERE rn = 1""",
        "f3",
    )
    o["one_hot_long"] = with_fixtures(
        f"""{_F2_SPLIT},
lg AS (SELECT row_key, split, 'o_orderpriority' AS column_name, o_orderpriority AS category FROM sp
       UNION ALL SELECT row_key, split, 'c_mktsegment', c_mktsegment FROM sp),
cats AS (SELECT DISTINCT column_name, category FROM lg WHERE split = 'train' AND category IS NOT NULL)
SELECT row_key, column_name, category FROM lg
WHERE split = 'test' AND (column_name, category) IN (SELECT column_name, category FROM cats)""",
        "f2",
    )
    rare = """WITH c AS (SELECT 'p_name' AS column_name, p_name AS category, count(*) AS n FROM part GROUP BY 2
  UNION ALL SELECT 'p_brand', p_brand, count(*) FROM part GROUP BY 2
  UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY 2),
k AS (SELECT CASE WHEN count(*) >= 1000 THEN 0.01 * count(*) ELSE 2 END AS cut FROM part),
t AS (SELECT c.*, c.n >= k.cut AS freq,
        sum(CASE WHEN c.n >= k.cut THEN 1 ELSE 0 END) OVER (PARTITION BY column_name) AS nf,
        row_number() OVER (PARTITION BY column_name ORDER BY n DESC, category DESC) AS pos
      FROM c, k)
SELECT column_name, category, n, CASE WHEN {keep} THEN category ELSE '__infrequent__' END AS encoded FROM t"""
    o["group_rare_categories"] = rare.format(keep="freq")
    o["cap_categories"] = rare.format(keep="CASE WHEN nf + 1 > 25 THEN freq AND pos <= 24 ELSE freq END")
    o["class_weights"] = with_fixtures(
        """c AS (SELECT label, count(*) AS n FROM f1 WHERE label IS NOT NULL GROUP BY label)
SELECT label, n, round(sum(n) OVER () * 1.0 / (count(*) OVER () * n), 6) AS weight FROM c""",
        "f1",
    )
    o["missing_indicators"] = with_fixtures(
        "SELECT l_orderkey, l_linenumber, CAST(l_quantity IS NULL AS INTEGER) AS missing_l_quantity, "
        "CAST(l_tax IS NULL OR isnan(l_tax) AS INTEGER) AS missing_l_tax, "
        "CAST(l_discount IS NULL AS INTEGER) AS missing_l_discount FROM f3",
        "f3",
    )
    feats = ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_tax", "l_discount",
             "l_returnflag"]
    floats = {"l_extendedprice", "l_quantity", "l_tax", "l_discount"}
    drop_rows = "\n UNION ALL ".join(
        f"SELECT l_suppkey, '{c}' AS column_name, round(100.0 * (count(*) - count({_clean(c) if c in floats else c})) / count(*), 2) AS missing_pct FROM f3 GROUP BY l_suppkey"
        for c in feats
    )
    o["drop_high_missing"] = with_fixtures(f"SELECT * FROM ({drop_rows}) x WHERE missing_pct >= 35.0", "f3")
    lk = "\n UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS v, label FROM f2 WHERE label IS NOT NULL" for c in F2_FEATURES
    )
    o["leaky_columns"] = with_fixtures(
        f"""lg AS ({lk}),
pv AS (SELECT column_name, v, min(label) <> max(label) AS mixed, count(*) AS n FROM lg WHERE v IS NOT NULL GROUP BY 1, 2)
SELECT column_name FROM pv GROUP BY column_name
HAVING max(CAST(mixed AS INTEGER)) = 0 AND count(*) < sum(n)""",
        "f2",
    )
    corr = "\n UNION ALL ".join(
        f"SELECT '{c}' AS column_name, abs(corr(CAST({c} AS DOUBLE), CAST(label AS DOUBLE))) AS a FROM f1" for c in F1_NUMERIC
    )
    o["feature_selection"] = with_fixtures(
        f"SELECT column_name, round(a, 6) AS abs_corr, row_number() OVER (ORDER BY a DESC, column_name) AS rank FROM ({corr}) x",
        "f1",
    )
    cells = "\n UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS v, label AS y FROM f3 WHERE label IS NOT NULL AND {c} IS NOT NULL"
        + (f" AND NOT isnan({c})" if c in ("l_quantity", "l_tax") else "") for c in INFO_COLS)
    o["feature_information"] = with_fixtures(f"""
long AS ({cells}),
joint AS (SELECT column_name, v, y, count(*) AS n FROM long GROUP BY 1, 2, 3),
sums AS (SELECT *, sum(n) OVER (PARTITION BY column_name, v) AS nv, sum(n) OVER (PARTITION BY column_name, y) AS ny,
                sum(n) OVER (PARTITION BY column_name) AS total FROM joint),
mi AS (SELECT column_name, round(greatest(sum(n * 1.0 / total * ln(n * 1.0 * total / (nv * 1.0 * ny))), 0.0), 6) AS information FROM sums GROUP BY column_name)
SELECT column_name, information, row_number() OVER (ORDER BY information DESC, column_name) AS rank FROM mi""", "f3")
    o["regression_metrics"] = with_fixtures(
        "SELECT lang, round(sqrt(avg((label - score) * (label - score))), 6) AS rmse, round(avg(abs(label - score)), 6) AS mae "
        "FROM f1 GROUP BY lang",
        "f1",
    )
    return o


ORACLES = _oracles()
