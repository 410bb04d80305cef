from __future__ import annotations

import glob
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import table_of  # noqa: E402

from corpuslab.plans.queries import REGISTRY as QUERIES  # noqa: E402

# Fitted and streamed queries are compared by tools/check_oracle.py, which runs every twin.
SLOW = {n for n in QUERIES if n.startswith(("nb_", "stream_", "url_inf", "prediction_", "linear_", "fitted_", "sweep_"))}


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_of_the_library_has_a_twin():
    assert not set(QUERIES) - set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_its_twin(spark, sf, db, name):
    got = QUERIES[name](spark, sf)
    cursor = db.execute(contract.oracle_sql()[name])
    want = table_of([d[0] for d in cursor.description], cursor.fetchall())
    assert table_of(got.columns, [tuple(r) for r in got.collect()]) == want


def test_entry_runs(spark):
    row = contract.entry(spark).collect()[0]
    assert row["model_name"] == "nb" and 0.0 <= row["f1"] <= 1.0
