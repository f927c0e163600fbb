"""Every registered query against its DuckDB statement (sf0.001), as the driver gate does."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from paydw.plans.registry import QUERIES  # noqa: E402
from compare import digest, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()
NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(df.columns) > 0
        return
    dcols, drows = duck(SF, ORACLE[name])
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "faturamento_total" in df.columns
