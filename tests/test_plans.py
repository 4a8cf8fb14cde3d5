"""Plan checks: no cartesian or nested-loop joins, no Python in
the query plans, filters reach the parquet scans, and accrual numbering is
not planned as a single-partition window."""

import pytest

import __spark_entry__ as entry
from lorry import registry

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "MapInArrow",
             "FlatMapGroupsIn", "FlatMapCoGroupsIn", "AggregateInPandas", "WindowInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", list(registry.queries()))
def test_no_forbidden_nodes(spark, sf_dir, key):
    p = plan(entry.queries()[key](spark, sf_dir))
    assert [n for n in FORBIDDEN if n in p] == []


@pytest.mark.parametrize("key", ["ap_v1_header", "ap_v2_header", "ap_register_header", "ar_header_all"])
def test_numbering_is_distributed(spark, sf_dir, key):
    df = entry.queries()[key](spark, sf_dir)
    df.collect()
    p = plan(df)
    assert "SinglePartition" not in p


def test_filters_pushed_to_scan(spark, sf_dir):
    from lorry.plans import ar
    from lorry.sources.tables import Tables

    t = Tables.at(spark, sf_dir)
    # the bills feeding the numbering: batch and child filters reach the TLORDER scan
    p = plan(ar._bills(t, "latest"))
    assert "GreaterThan(interface_status_f,0)" in p
    assert "IsNotNull(extra_stops)" in p  # (the plan string truncates the rest)
    assert "ReadSchema: struct<detail_line_id:bigint,bill_number:string,interface_status_f:int" in p
    # the company filter reaches the BILLGL scan (after the numbering checkpoint)
    p = plan(ar.ar_header_current(t, "control"))
    assert "PushedFilters: [In(acct_code, [01-2200-00,01-2210-00,01-3000-00,01-3100-00])" in p
