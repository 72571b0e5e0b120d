"""Every registered query against its DuckDB oracle (sf0.001), as the driver does at sf0.01."""

import pytest

import __spark_entry__ as E
from prismark.plans import catalog
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.ORACLE)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["decade", "n", "pct"]


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res.startswith("OK"), res


def test_rows_only_queries_run(spark):
    for name in sorted(set(catalog.QUERIES) - set(catalog.ORACLE)):
        assert catalog.QUERIES[name](spark, SF).count() >= 0
