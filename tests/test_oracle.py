"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver's correctness gate, at the smallest scale)."""

import os

import pytest

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_contract(spark):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    df = E.entry(spark)
    assert df.columns[0] == "campaign_id" and df.count() > 0


def test_queries_match_oracle(spark):
    from tools.check_oracle import run

    results = run(spark, SF, verbose=False)
    failing = {k: v for k, v in results.items() if v}
    assert not failing, failing
