"""Fixtures F1-F11: inputs built from the test-data tables.

Each fixture is one SQL text that Spark SQL and DuckDB both run unchanged, so
the Spark side of a query and its DuckDB oracle start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablelens.sources.tables import register_tables

F1 = """
SELECT d.doc_id AS row_key, d.lang, d.source, d.n_chars,
       CAST(length(d.text) - length(replace(d.text, ' ', '')) + 1 AS BIGINT) AS n_words,
       l.quality, l.toxic AS label,
       CAST((d.doc_id * 7919 + d.n_chars * 31) % 1000 AS DOUBLE) / 1000 * 0.6 + 0.4 * l.toxic AS score
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

F2 = """
SELECT o.o_orderkey AS row_key, o.o_totalprice, c.c_acctbal, o.o_orderpriority, c.c_mktsegment, o.o_orderstatus AS label
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

F3 = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
       CASE WHEN l_partkey % 10 < 3 THEN NULL ELSE l_quantity END AS l_quantity,
       CASE WHEN l_partkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS l_tax,
       CASE WHEN l_partkey % 3 = 0 AND l_suppkey % 4 = 0 THEN NULL ELSE l_discount END AS l_discount,
       CASE WHEN l_orderkey % 11 = 0 THEN 'NA' WHEN l_orderkey % 13 = 0 THEN '' ELSE l_returnflag END AS l_returnflag,
       CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_linestatus END AS label
FROM lineitem
"""

F4 = """
SELECT vec_id AS row_key, embedding, label, CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM embeddings
"""

F5 = """
SELECT p_partkey AS dataset_id,
       CASE p_size % 4 WHEN 0 THEN 20 + p_partkey % 280 WHEN 1 THEN 300 + p_partkey % 2700
                       WHEN 2 THEN 3000 + p_partkey % 27000 ELSE 30000 + p_partkey * 13 END AS n_rows,
       CASE WHEN p_partkey % 17 = 0 THEN 100 + p_partkey % 400 ELSE 1 + p_partkey % 40 END AS feature_count,
       CAST(p_partkey % 11 AS DOUBLE) / 10 AS numeric_ratio,
       CAST(10 - p_partkey % 11 AS DOUBLE) / 10 AS categorical_ratio,
       CAST(p_partkey * 37 % 300 AS DOUBLE) / 10 AS overall_missing,
       CAST(p_partkey * 37 % 300 AS DOUBLE) / 10 + CAST(p_partkey * 53 % 400 AS DOUBLE) / 10 AS max_missing,
       CASE WHEN p_partkey % 6 = 0 THEN 1 + p_partkey % 4 ELSE 0 END AS high_cardinality_count,
       CASE WHEN p_partkey % 9 = 8 THEN 0 ELSE 2 + p_partkey % 3 END AS num_classes,
       CAST(10 + p_partkey * 29 % 60 AS DOUBLE) / 10 AS imbalance_ratio,
       p_partkey * 7 % 60 AS minority_class_count,
       CASE p_partkey % 5 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS target_confidence,
       p_partkey % 9 <> 8 AS is_classification
FROM part
"""

F6 = """
SELECT l_suppkey AS run_id,
       CASE WHEN l_linenumber = 1 THEN 'DummyMostFrequent' ELSE concat('m', CAST(l_linenumber AS STRING)) END AS model,
       CASE WHEN (l_orderkey + l_partkey) % 5 = 0 THEN 'test' ELSE 'train' END AS split,
       CAST(l_orderkey % 3 AS INT) AS fold,
       l_returnflag AS label,
       CASE WHEN l_linenumber = 1 THEN 'N'
            WHEN (l_orderkey * 7 + l_partkey) % 10 < 2 + l_linenumber THEN l_returnflag
            WHEN l_partkey % 2 = 0 THEN 'A' ELSE 'R' END AS prediction,
       CAST((l_orderkey * 7919 + l_partkey * 31) % 1000 AS DOUBLE) / 1000 AS score
FROM lineitem
"""

F7 = """
SELECT run_id, attempt, model,
       CAST((h * 13 + attempt * 101) % 1000 AS DOUBLE) / 1000 AS accuracy,
       CAST((h * 17 + attempt * 211) % 1000 AS DOUBLE) / 1000 AS balanced_accuracy,
       CAST((h * 19 + attempt * 307) % 1000 AS DOUBLE) / 1000 AS f1_macro,
       CAST((h * 23 + attempt * 401) % 1000 AS DOUBLE) / 1000 AS train_balanced_accuracy,
       CASE WHEN model = 'm7' THEN NULL ELSE CAST((h * 29 + attempt) % 1000 AS DOUBLE) / 1000 END AS fold0,
       CASE WHEN model = 'm7' THEN NULL ELSE CAST((h * 31 + attempt) % 1000 AS DOUBLE) / 1000 END AS fold1,
       CASE WHEN model = 'm7' THEN NULL ELSE CAST((h * 37 + attempt) % 1000 AS DOUBLE) / 1000 END AS fold2
FROM (SELECT l_suppkey AS run_id,
             CASE WHEN l_linenumber = 1 THEN 'DummyMostFrequent' ELSE concat('m', CAST(l_linenumber AS STRING)) END AS model,
             CAST(sum(l_partkey) AS BIGINT) AS h
      FROM lineitem GROUP BY l_suppkey, l_linenumber) a
CROSS JOIN (SELECT 0 AS attempt UNION ALL SELECT 1 AS attempt) b
"""

F8 = """
SELECT o_orderkey AS run_id, concat('fp_', CAST(o_custkey % 50 AS STRING)) AS fingerprint, o_orderdate AS ts,
       CASE o_orderkey % 4 WHEN 0 THEN 'RandomForest' WHEN 1 THEN 'LogisticRegression' WHEN 2 THEN 'LinearSVC' ELSE 'KNN' END AS best_model,
       CAST(o_orderkey * 37 % 1000 AS DOUBLE) / 1000 AS best_score,
       o_orderkey % 3 = 0 AS use_class_weight, o_orderkey % 5 = 0 AS group_rare_categories, o_orderkey % 2 = 0 AS enable_cv,
       CASE WHEN o_orderkey % 7 = 0 THEN 'weak_features' END AS cause_1,
       CASE WHEN o_orderkey % 6 = 0 THEN 'imbalance_handling' END AS cause_2
FROM orders
"""

# Two classes far apart in every numeric column: any sound candidate must return the label.
F9 = """
SELECT c_custkey AS row_key, c_custkey % 3 = 0 AS vip,
       CASE WHEN c_custkey % 3 = 0 THEN 10.0 ELSE 0.0 END + CAST(c_custkey % 10 AS DOUBLE) / 10 AS x1,
       CASE WHEN c_custkey % 3 = 0 THEN -8.0 ELSE 0.0 END + CAST(c_custkey % 7 AS DOUBLE) / 7 AS x2,
       CAST(c_custkey % 5 AS DOUBLE) / 5 AS x3, CAST(NULL AS DOUBLE) AS x4, 7 AS x5, c_mktsegment AS segment,
       CASE WHEN c_custkey % 3 = 0 THEN 'yes' ELSE 'no' END AS label
FROM customer
"""

# Three classes, each apart from the other two; one has two rows, so none of it is held out.
F10 = """
SELECT c_custkey AS row_key,
       CASE WHEN c_custkey > 1 AND c_custkey % 4 = 0 THEN 10.0 ELSE 0.0 END + CAST(c_custkey % 10 AS DOUBLE) / 10 AS x1,
       CASE WHEN c_custkey <= 1 THEN 10.0 ELSE 0.0 END + CAST(c_custkey % 7 AS DOUBLE) / 7 AS x2,
       CASE WHEN c_custkey > 1 AND c_custkey % 4 > 0 THEN 10.0 ELSE 0.0 END + CAST(c_custkey % 3 AS DOUBLE) / 3 AS x3,
       CASE WHEN c_custkey <= 1 THEN 'B' WHEN c_custkey % 4 = 0 THEN 'A' ELSE 'C' END AS label
FROM customer
"""

# NULL and repeated segments, NULL keys, boolean, constant and all-missing columns.
F11 = """
SELECT CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey END AS row_key,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 5 END AS seg,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS flag, 3.5 AS constant, CAST(NULL AS DOUBLE) AS nothing,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice END AS price,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS label
FROM orders
"""

# Constant features: no candidate can beat the majority, so an attempt fails and another gains nothing.
F12 = """
SELECT s_suppkey AS row_key, 1.5 AS x1, 7 AS x2, CASE WHEN s_suppkey % 5 < 2 THEN 'yes' ELSE 'no' END AS label FROM supplier
"""

FIXTURES = {"f12": F12, "f9": F9, "f10": F10, "f11": F11, "f1": F1, "f2": F2, "f3": F3, "f4": F4, "f5": F5, "f6": F6, "f7": F7, "f8": F8}

# Column order of each fixture (used where an operator needs the schema order).
F3_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
    "l_quantity", "l_tax", "l_discount", "l_returnflag", "label",
]


# Tables each fixture reads (only these are registered for it).
FIXTURE_TABLES = {
    "f1": ["documents", "labels"], "f2": ["orders", "customer"], "f3": ["lineitem"], "f4": ["embeddings"],
    "f5": ["part"], "f6": ["lineitem"], "f7": ["lineitem"], "f8": ["orders"], "f9": ["customer"], "f10": ["customer"], "f11": ["orders"], "f12": ["supplier"],
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Run fixture ``name`` ('f1'..'f12') over the tables in ``sf_dir``."""
    register_tables(spark, sf_dir, FIXTURE_TABLES[name])
    return spark.sql(FIXTURES[name])


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with ``WITH f1 AS (...), ...`` for the DuckDB oracle."""
    ctes = ",\n".join(f"{n} AS ({FIXTURES[n].strip()})" for n in names)
    body = sql.lstrip()
    # a body that does not start with SELECT continues the CTE list
    sep = "\n" if body[:6].upper() in ("SELECT", "(SELEC") else ",\n"
    return f"WITH {ctes}{sep}{body}"
