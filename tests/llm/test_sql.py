"""The queries that SQL can express, against it, on the smallest supplied tables."""

from compare import compare

from vacanta.llm.queries import SQL

SF = "/root/testdata/sf0.001"


def test_queries_match_sql(spark):
    bad = {k: v for k, v in compare(spark, SF, list(SQL), verbose=False).items() if v[0] != "ok"}
    assert not bad, bad
