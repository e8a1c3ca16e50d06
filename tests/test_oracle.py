"""Every registered query against its DuckDB oracle on the smallest supplied tables."""

import os

import pytest

from compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_all_queries_match_oracle(spark):
    from vacanta.plans.queries import QUERIES

    res = compare(spark, SF, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "rows-only")}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    from vacanta.plans.oracle_queries import SQL
    from vacanta.plans.queries import QUERIES

    assert set(SQL) == set(QUERIES)                         # every query of the library's own has oracle SQL
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())
