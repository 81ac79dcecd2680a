"""Registered queries against their DuckDB oracles on the smallest scale."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tablelens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
NAMES = [
    "profile_by_segment", "missing_pct_by_column", "target_inferred_top3", "split_stratified", "stratified_folds",
    "impute_median", "cap_categories", "threshold_sweep", "classification_report", "leaderboard",
    "selection_rationale", "diagnose_runs", "replan_steps", "plan_steps", "candidate_pool",
    "profile_record", "n_unique_sketch", "feature_information", "rolled_model_outcomes", "rolled_last_runs",
    "similar_datasets_top3", "history_votes", "order_candidates", "knn_vote", "predict_majority",
]


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, Counter(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    exp = con.execute(entry.oracle_sql()[name]).df()
    assert _rows(got) == _rows(exp)


def test_every_query_has_callable_and_most_have_oracles():
    qs, orc = entry.queries(), entry.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(orc) >= len(qs) - 15


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "profile_id" in df.columns
