"""Registered queries for target inference (T1-T4) over several test-data tables."""

from __future__ import annotations

from functools import reduce

from tablelens.operators import target as TG
from tablelens.plans.fixtures import fixture, with_fixtures
from tablelens.plans.suite_profile import PART_COLS, _colstats_ctes
from tablelens.sources.tables import read_table

CUSTOMER_COLS = [
    ("c_custkey", "numeric", False, "bigint"),
    ("c_name", "categorical", False, "string"),
    ("c_nationkey", "numeric", False, "int"),
    ("c_acctbal", "numeric", True, "double"),
    ("c_mktsegment", "categorical", False, "string"),
]
ORDERS_COLS = [
    ("o_orderkey", "numeric", False, "bigint"),
    ("o_custkey", "numeric", False, "bigint"),
    ("o_orderstatus", "categorical", False, "string"),
    ("o_totalprice", "numeric", True, "double"),
    ("o_orderdate", "categorical", False, "timestamp_ntz"),
    ("o_orderpriority", "categorical", False, "string"),
]
SUPPLIER_COLS = [
    ("s_suppkey", "numeric", False, "bigint"),
    ("s_name", "categorical", False, "string"),
    ("s_nationkey", "numeric", False, "int"),
    ("s_acctbal", "numeric", True, "double"),
]
SCORED = {"customer": CUSTOMER_COLS, "orders": ORDERS_COLS, "part": PART_COLS, "supplier": SUPPLIER_COLS}
# (dataset, target) pairs for the classification test
CLF_PAIRS = [
    ("customer", "c_mktsegment"),
    ("customer", "c_nationkey"),
    ("orders", "o_totalprice"),
    ("part", "p_size"),
    ("lineitem", "l_quantity"),
    ("f1", "label"),
]


def _load(spark, sf, name):
    return fixture(spark, sf, name) if name.startswith("f") and len(name) == 2 else read_table(spark, sf, name)


def q_target_scores(spark, sf):
    parts = [TG.target_scores(_load(spark, sf, d), d).select("dataset", "column_name", "score") for d in SCORED]
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_target_inferred_top3(spark, sf):
    parts = [TG.infer_target(_load(spark, sf, d), d) for d in ["f1", *SCORED]]
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_is_classification(spark, sf):
    parts = [TG.is_classification(_load(spark, sf, d), d, t) for d, t in CLF_PAIRS]
    return reduce(lambda a, b: a.unionByName(b), parts)


QUERIES = {
    "target_scores": q_target_scores,
    "target_inferred_top3": q_target_inferred_top3,
    "is_classification": q_is_classification,
}


def _scores_sql(name, cols) -> str:
    last = cols[-1][0]
    return f"""(WITH {_colstats_ctes(name, cols, None)}
SELECT '{name}' AS dataset, column_name,
  (CASE WHEN kind = 'categorical' THEN 1.0 ELSE 0.0 END
   + CASE WHEN n_unique <= greatest(50, floor(greatest(n_rows, 1) * 0.05)) THEN 1.0 ELSE 0.0 END
   + CASE WHEN n_unique * 1.0 / greatest(n_rows, 1) < 0.20 THEN 0.5 ELSE 0.0 END
   + CASE WHEN n_missing * 100.0 / n_rows < 30.0 THEN 0.25 ELSE 0.0 END
   + CASE WHEN column_name = '{last}' THEN 0.5 ELSE 0.0 END) AS score
FROM cs)"""


def _oracles():
    scores = "\nUNION ALL\n".join(f"SELECT * FROM {_scores_sql(n, c)}" for n, c in SCORED.items())
    top3 = f"""WITH s AS ({scores}),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY score DESC, column_name DESC) AS rn FROM s)
SELECT dataset,
  max(CASE WHEN rn = 1 AND score >= 1.25 THEN column_name END) AS target,
  max(CASE WHEN rn = 1 THEN CASE WHEN score >= 1.25 THEN 'heuristic_score' ELSE 'failed' END END) AS method,
  max(CASE WHEN rn = 1 THEN CASE WHEN score >= 2.0 THEN 'medium' ELSE 'low' END END) AS confidence,
  string_agg(column_name, '|' ORDER BY rn) AS candidates
FROM r WHERE rn <= 3 GROUP BY dataset
UNION ALL SELECT 'f1', 'label', 'known_name', 'high', 'label'"""
    clf_rows = []
    for d, t in CLF_PAIRS:
        src = d
        obj = {"c_mktsegment": True}.get(t, False)
        rule = "TRUE" if obj else "count(DISTINCT {t}) <= greatest(20, floor(greatest(count(*), 1) * 0.05))".format(t=t)
        clf_rows.append(
            f"SELECT '{d}' AS dataset, '{t}' AS target, count(DISTINCT {t}) AS n_unique, {rule} AS is_classification FROM {src}"
        )
    clf = with_fixtures("\nUNION ALL\n".join(clf_rows), "f1")
    return {"target_scores": scores, "target_inferred_top3": top3, "is_classification": clf}


ORACLES = _oracles()
