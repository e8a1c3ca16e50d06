"""Quality checks that return a report DataFrame, and a gate that blocks on it.

The table-wide numbers (row count, null keys, future dates, distinct keys) come
from one aggregate pass; the domain check is an anti-join against a small
allow-list. The report is one row per check: (check, severity, observed, passed).
Only the gate looks at the report on the driver, and the report has five rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import vocab as V

CRITICAL, WARNING = "critical", "warning"


class QualityGateError(RuntimeError):
    """Raised by :func:`gate` when a critical check fails."""


def allowed_domains(spark: SparkSession, domains=V.ALLOWED_DOMAINS) -> DataFrame:
    return spark.createDataFrame([(d,) for d in domains], "domain string")


def invalid_domains(df: DataFrame, allowed: DataFrame, col: str = "primary_domain") -> DataFrame:
    """Distinct values of ``col`` not in the allow-list; null counts as invalid
    (null-safe comparison). The allow-list is a fixed small table, so it is broadcast."""
    observed = df.select(F.col(col).alias("domain")).distinct()
    return observed.join(F.broadcast(allowed.withColumnRenamed("domain", "_ok")),
                         observed["domain"].eqNullSafe(F.col("_ok")), "left_anti")


def duplicate_keys(df: DataFrame, key: str = "job_fingerprint") -> DataFrame:
    """Offending keys with their row counts (partial counts are combined map-side,
    so a hot key does not concentrate rows in one task)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def run_checks(df: DataFrame, as_of_date, key: str = "job_fingerprint", id_col: str = "source_job_id",
               date_col: str = "publication_date", domain_col: str = "primary_domain",
               allowed: DataFrame | None = None) -> DataFrame:
    """Report of the five silver checks."""
    spark = df.sparkSession
    allowed = allowed if allowed is not None else allowed_domains(spark)
    stats = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(key).isNull() | F.col(id_col).isNull()).alias("null_keys"),
        # distinct keys with null counted as one key, as select(key).distinct().count()
        (F.count_distinct(F.col(key)) + F.max(F.col(key).isNull().cast("int"))).alias("distinct_keys"),
        F.count_if(C.in_future(F.col(date_col), as_of_date)).alias("future_dates"),
    )
    total = F.col("total")
    dup = total - F.coalesce(F.col("distinct_keys"), F.lit(0))

    def row(name, severity, observed):
        return F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"),
                        observed.cast("long").alias("observed"), (observed == 0).alias("passed"))

    table_rows = stats.select(F.inline(F.array(
        F.struct(F.lit("non_empty").alias("check"), F.lit(CRITICAL).alias("severity"),
                 total.cast("long").alias("observed"), (total > 0).alias("passed")),
        row("key_completeness", CRITICAL, F.col("null_keys")),
        row("key_uniqueness", CRITICAL, dup),
        row("future_dates", WARNING, F.col("future_dates")),
    )))
    domain_row = (invalid_domains(df, allowed, domain_col)
                  .agg(F.count(F.lit(1)).alias("n"))
                  .select(F.inline(F.array(row("domain_validity", CRITICAL, F.col("n"))))))
    return table_rows.unionByName(domain_row)


def gate(report: DataFrame) -> DataFrame:
    """Raise :class:`QualityGateError` when a critical check failed; warnings never block.
    Returns the report's rows as they were judged (one per check), so reading it again doesn't
    audit the table again."""
    rows = report.collect()
    failed = [r for r in rows if r["severity"] == CRITICAL and not r["passed"]]
    if failed:
        detail = ", ".join(f"{r['check']}={r['observed']}" for r in failed)
        raise QualityGateError(f"critical quality checks failed: {detail}")
    return report.sparkSession.createDataFrame(rows, report.schema)
