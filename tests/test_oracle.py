"""Every registered query against its DuckDB oracle (row count, columns,
order-insensitive values), as the driver checks it."""

import pytest

import __spark_entry__ as entry
from lorry import registry
from compare import canon, duck


KEYS = list(registry.queries())


def test_every_query_has_an_oracle():
    missing = sorted(set(KEYS) - set(registry.oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, sf_dir, key):
    df = entry.queries()[key](spark, sf_dir)
    s_cols = [c.lower() for c in df.columns]
    s_rows = [tuple(r) for r in df.collect()]
    d_cols, d_rows, _ = duck(entry.oracle_sql()[key], sf_dir)
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["cntbtch", "cntitem", "idcust", "idinvc", "texttrx", "custpo", "amtinvctot", "swmantx"]
    assert df.count() > 0
