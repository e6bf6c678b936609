"""Every registered query against its DuckDB SQL, plus plan-shape checks."""

import importlib.util
import os

import pytest

from conftest import ROOT, SF_SMALL
from quarterlens.plans.oracle import oracle_sql
from quarterlens.plans.registry import queries

spec = importlib.util.spec_from_file_location("oracle_check",
                                              os.path.join(ROOT, "tools", "oracle_check.py"))
oracle_check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(oracle_check)


@pytest.fixture(scope="module")
def duck():
    return oracle_check.duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert len(queries()) >= 45


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_oracle(spark, duck, key):
    duck.execute(f"CREATE OR REPLACE VIEW of_key AS {oracle_sql()[key]}")  # it must do as a view
    res = oracle_check.check(spark, duck, SF_SMALL, key, queries()[key], oracle_sql()[key])
    assert res["status"] == "ok", res


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["waterfall", "nrr_cohorts", "arr_movements", "dim_customers",
                                 "stg_invoices", "dq_not_null"])
def test_plan_has_no_python_udf_or_cartesian(spark, key):
    df = queries()[key](spark, SF_SMALL)
    plan = _plan(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, (key, bad)


def test_calendar_is_broadcast_and_scans_are_pruned(spark):
    df = queries()["arr_movements"](spark, SF_SMALL)
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan
    # the orders scan reads only the four columns the mapping needs
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double," \
           "o_orderdate:timestamp_ntz>" in plan
    assert "o_orderpriority" not in plan


def test_entry_smoke(spark):
    import importlib
    import sys
    sys.path.insert(0, ROOT)
    entry_mod = importlib.import_module("__spark_entry__")
    df = entry_mod.entry(spark)
    assert df.columns[0] == "fiscal_quarter"
    assert df.count() == 27
