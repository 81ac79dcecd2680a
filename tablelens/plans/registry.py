"""All registered queries and their DuckDB oracles, gathered from the suites."""

from __future__ import annotations

import importlib

SUITES = [
    "tablelens.plans.suite_profile",
    "tablelens.plans.suite_target",
    "tablelens.plans.suite_prep",
    "tablelens.plans.suite_metrics",
    "tablelens.plans.suite_diagnose",
    "tablelens.plans.suite_history",
    "tablelens.plans.suite_models",
    "tablelens.plans.suite_dirty",
]


def _load():
    queries, oracles = {}, {}
    for name in SUITES:
        mod = importlib.import_module(name)
        for key, fn in mod.QUERIES.items():
            if key in queries:
                raise ValueError(f"duplicate query name {key}")
            queries[key] = fn
        oracles.update(getattr(mod, "ORACLES", {}))
    return queries, oracles


def all_queries():
    return _load()[0]


def all_oracles():
    return _load()[1]
