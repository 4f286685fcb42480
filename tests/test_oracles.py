"""Every registered query against its DuckDB oracle (row count + value hash), like the driver."""

from tests.conftest import SF001
from tests.oracle_check import compare


def test_all_queries_match_oracles(spark):
    from __spark_entry__ import oracle_sql

    res = compare(spark, SF001, list(oracle_sql()))
    bad = {k: v for k, v in res.items() if v[0] != "ok"}
    assert not bad, bad
    assert len(res) >= 25
