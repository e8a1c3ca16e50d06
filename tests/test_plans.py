"""Plan properties the design relies on, checked on executed plans."""

import pytest
from pyspark.sql import functions as F

from vacanta.operators import star
from vacanta.plans import postings as P
from vacanta.plans import silver as S
from vacanta.sources.batches import write_layer
from vacanta.sources.tables import table

SF = "/root/testdata/sf0.001"


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]                   # the adaptive final plan


def test_silver_one_shuffle_no_text_no_python(spark):
    s = S.build_silver(P.postings(table(spark, SF, "documents")), "2026-10-01 02:00:00")
    plan = _final_plan(s)
    exchanges = [l for l in plan.split("\n") if "Exchange hashpartitioning" in l]
    assert len(exchanges) == 1                                  # only the keyed dedupe shuffles
    assert "WindowGroupLimit" in plan and "Partial" in plan      # partial limit before the shuffle
    assert "PythonUDF" not in plan and "EvalPython" not in plan  # all rules are JVM expressions
    shuffle_input = plan.split("Exchange hashpartitioning")[1].split("\n")[1]
    assert "raw_description" not in shuffle_input and "text#" not in shuffle_input


def test_fact_join_without_hints_and_scan_pushdown(spark, tmp_dir):
    s = S.build_silver(P.postings(table(spark, SF, "documents")), "2026-10-01 02:00:00")
    write_layer(s, tmp_dir + "/silver", partition_by=("year", "month"))
    silver = spark.read.parquet(tmp_dir + "/silver")
    for name, dim in star.build_gold(silver, ("dim_company", "dim_location")).items():
        write_layer(dim, f"{tmp_dir}/{name}")
    fact = star.fact_internships(silver, spark.read.parquet(tmp_dir + "/dim_company"), spark.read.parquet(tmp_dir + "/dim_location"))
    plan = _final_plan(fact)
    assert "ResolvedHint" not in fact._jdf.queryExecution().analyzed().toString()
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l and "is_internship" in l][0]
    assert "PushedFilters: [IsNotNull(is_internship), EqualTo(is_internship,true)]" in scan
    assert "raw_description" not in scan


@pytest.mark.parametrize("hot_share", [3])
def test_hot_key_dedupe_keeps_one_row_per_task_before_shuffle(spark, hot_share):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % hot_share == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id")).repartition(8)
    from vacanta.operators.dedup import dedupe
    out = dedupe(df, ["k"], [F.col("id").desc()])
    rows = {r.k: r.id for r in out.collect()}
    assert rows["hot"] == max(i for i in range(n) if i % hot_share == 0)
    assert len(rows) == 1 + sum(1 for i in range(n) if i % hot_share)
