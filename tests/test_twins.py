"""Registered queries against their SQL twins in a second engine, at the smallest scale.

Set FEW_TWINS=1 for one or two of each family."""

import os

import duckdb
import pytest

from riskloom.plans.oracles import all_oracles
from riskloom.plans.queries import all_queries

SOME = [
    "raw_projection", "raw_dedup", "quarantine", "features_full", "history_with_ties", "idle_reset",
    "rolling_scores", "time_split", "prepared_features", "roc_curve", "evaluation_report", "risk_factors",
    "alert_stats", "drift_report", "increase_1h", "latency_quantiles",
]


@pytest.fixture(scope="module")
def twin(tables):
    con = duckdb.connect()
    for t in ("events", "orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet'")
    return con


def comparable(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_twin_has_its_query():
    assert set(all_oracles()) <= set(all_queries())


@pytest.mark.parametrize("name", SOME if os.environ.get("FEW_TWINS") else sorted(all_oracles()))
def test_twin(spark, tables, twin, name):
    df = all_queries()[name](spark, tables)
    found = twin.execute(all_oracles()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert comparable(df.collect(), df.columns) == comparable(found.fetchall(), columns)
