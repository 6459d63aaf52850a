"""Every registered query against its SQL."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from conftest import DATA, plan, rows  # noqa: E402
from viaduct.plans import ORACLES, QUERIES  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
# Operators that would pair everything with everything, or leave the JVM.
UNWANTED = ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")
WITHOUT_SQL = {"train_linear_all_features", "train_forest", "train_gbt", "train_boosted_subsampled"}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    yield connection
    connection.close()


def by_name(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in found), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_its_sql_gives(spark, oracle, name):
    frame = QUERIES[name](spark, DATA)
    text = plan(frame)
    assert not [bad for bad in UNWANTED if bad in text]
    expected = oracle.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(frame.columns) == sorted(columns)
    assert by_name(frame.columns, [tuple(r) for r in frame.collect()]) == by_name(columns, expected.fetchall())


def test_the_contract_lists_them_all():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_only_fitted_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL


def test_fitted_model_is_evaluated(spark):
    found = rows(QUERIES["train_linear_all_features"](spark, DATA))
    assert len(found) == 1 and found[0][0] > 0


def test_entry(spark):
    report = contract.entry(spark)
    assert 0 < report.count() <= 25 and report.columns[0] == "report_type"


def test_no_two_test_files_share_a_name():
    from pathlib import Path

    names = [p.name for p in Path(__file__).parent.rglob("test_*.py")]
    assert len(names) == len(set(names))
