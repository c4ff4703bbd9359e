"""Every registered key against its DuckDB oracle (sf0.001): columns, rows, values."""

import pytest

import __spark_entry__ as E
from groundstop.plans import ORACLES, QUERIES
from tools.oracle_check import canon


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["op_carrier", "count_total", "count_delays", "delay_percent"]


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    s_cols = [c.lower() for c in df.columns]
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[key])
    d_cols = [d[0].lower() for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert canon(s_cols, s_rows) == canon(d_cols, d_rows)
