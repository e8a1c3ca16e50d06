"""The gated daily composition: bronze -> silver -> quality gate -> gold.

Each layer is written and the next layer reads the written table, so a lost
executor only costs the tasks of the current layer (no long lineage), the gold
job gets parquet pushdown on the silver table, and a failed gate stops before
gold is touched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import quality, star
from ..session import checkpoint_dir
from ..sources.batches import REJECTS, original_layout_paths, read_batches, write_layer
from . import silver as S


def silver_layer(spark: SparkSession, bronze_root: str, silver_path: str, run_ts=None,
                 multi_line: bool = False, original_layout: bool = False, rejects_path: str | None = None,
                 required: Sequence[str] = ()) -> DataFrame:
    """Read all sources, build silver, write it partitioned by year/month.
    Returns a one-row summary (total, internships) computed from the written table.

    Rejected envelopes and records are written to ``rejects_path`` (default: beside the silver
    table), with a row for every source without a folder. A missing source in ``required``
    stops the run before silver is touched: it would vanish from the rebuilt table."""
    paths = original_layout_paths(bronze_root) if original_layout else None
    unified, rejects, skipped = read_batches(spark, bronze_root, multi_line=multi_line, paths=paths)
    lost = sorted(set(required) & set(skipped))
    if lost:
        raise FileNotFoundError(f"sources without a bronze folder: {', '.join(lost)}")
    missing = spark.createDataFrame([(s, None, "missing source", None) for s in skipped], REJECTS)
    write_layer(rejects.unionByName(missing), rejects_path or silver_path.rstrip("/") + "_rejects")
    write_layer(S.build_silver(unified, run_ts), silver_path, partition_by=("year", "month"))
    written = spark.read.parquet(silver_path)
    return written.agg(F.count(F.lit(1)).alias("total_records"),
                       F.count_if(F.col("is_internship")).alias("internships"))


def quality_gate(spark: SparkSession, silver_path: str, as_of_date) -> DataFrame:
    """The report's rows, evaluated once; raises on a failed critical check."""
    return quality.gate(quality.run_checks(spark.read.parquet(silver_path), as_of_date))


def gold_layer(spark: SparkSession, silver: str | DataFrame, gold_path: str, keys_root: str | None = None) -> DataFrame:
    """Build and write the star schema; returns the layer summary of the written tables.
    The facts are joined to the dimensions as written, so those are computed once.

    With ``keys_root`` the dimensions' keys come from registries kept there (``operators.key_registry``):
    a member keeps its key from run to run. Otherwise each run numbers its members anew."""
    silver, base = spark.read.parquet(silver) if isinstance(silver, str) else silver, gold_path.rstrip("/")
    dims = star.build_gold(silver, star.DIMENSIONS) if keys_root is None else star.registered_dimensions(silver, keys_root)
    for name, dim in dims.items():
        write_layer(dim, f"{base}/{name}")
    dims = [spark.read.parquet(f"{base}/{name}") for name in ("dim_company", "dim_location")]
    for name, make in (("fact_job_postings", star.fact_job_postings), ("fact_internships_pfe", star.fact_internships)):
        write_layer(make(silver, *dims), f"{base}/{name}", partition_by=("year", "month"))
    return star.layer_summary({name: spark.read.parquet(f"{base}/{name}") for name in star.GOLD if name != "dim_taxonomy"})


def prepared(spark: SparkSession) -> SparkSession:
    """The cluster's session with what the layers rely on: UTC dates, adaptive plans with
    skew handling, a shared checkpoint folder."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    checkpoint_dir(spark)
    return spark


def run_daily(spark: SparkSession, bronze_root: str, silver_path: str, gold_path: str, run_ts=None,
              as_of_date=None, multi_line: bool = False, original_layout: bool = False,
              ingest: Callable[[str], None] | None = None, required: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All layers in order: ``ingest`` (captures the day's batches into the bronze root, see
    ``plans.ingest``), silver, gate, gold; :class:`quality.QualityGateError` stops before gold."""
    if as_of_date is None:
        as_of_date = C.run_timestamp(run_ts).cast("date")
    if ingest is not None:
        ingest(bronze_root)
    out = {"silver": silver_layer(spark, bronze_root, silver_path, run_ts, multi_line, original_layout, required=required)}
    out["quality"] = quality_gate(spark, silver_path, as_of_date)
    out["gold"] = gold_layer(spark, silver_path, gold_path)
    return out


def main(argv: list[str] | None = None) -> int:
    """``spark-submit daily_job.py --bronze B --silver S --gold G [--run-ts T] [--as-of D]``.

    ``--candidates`` (raw postings as Parquet, columns of ``plans.ingest``) captures the day's new postings into
    bronze first, against the seen keys under ``--state``. ``--incremental`` keeps silver as audited versions, of which a
    run writes what its new bronze runs touch, and gold's keys in registries (``plans.incremental``).

    Uses the session the cluster provides (its ``spark.checkpoint.dir`` included).
    Exit code 1 when the quality gate blocks, as a scheduler expects."""
    import argparse

    from . import incremental, ingest

    p = argparse.ArgumentParser(prog="vacanta.plans.daily")
    p.add_argument("--bronze", required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--gold", required=True)
    p.add_argument("--run-ts", default=None, help="run instant (default: now)")
    p.add_argument("--as-of", default=None, help="as-of date for the future-date check (default: run date)")
    p.add_argument("--multi-line", action="store_true", help="bronze files hold one pretty-printed envelope")
    p.add_argument("--original-layout", action="store_true", help="source folders named as by the original capture jobs")
    p.add_argument("--require", action="append", default=[], help="source that must have a bronze folder (repeatable)")
    p.add_argument("--incremental", action="store_true", help="--silver holds versions; only what new bronze runs touch is written")
    p.add_argument("--keys", default=None, help="folder of the key registries (with --incremental; default: beside silver)")
    p.add_argument("--candidates", default=None, help="raw postings to capture before the layers")
    p.add_argument("--state", default=None, help="landed keys of earlier captures, and their compact copy (with --candidates)")
    p.add_argument("--run-id", default=None, help="id of the capture; a run repeated under its id replaces what it landed")
    a = p.parse_args(argv)
    if a.candidates and not (a.state and a.run_id and a.run_ts):
        p.error("--candidates needs --state, --run-id and --run-ts")
    if a.incremental and (a.original_layout or a.require):
        p.error("--incremental reads run folders of this library's layout and takes what there is")
    spark = prepared(SparkSession.builder.appName("vacanta-daily").getOrCreate())
    try:
        if a.candidates:
            ingest.capture_day(spark, spark.read.parquet(a.candidates), a.bronze, a.state, a.run_id, a.run_ts)
        if a.incremental:
            out = incremental.run_incremental(spark, a.bronze, a.silver, a.gold, a.keys or a.silver.rstrip("/") + "_keys", a.run_ts, a.as_of, a.multi_line)
        else:
            out = run_daily(spark, a.bronze, a.silver, a.gold, a.run_ts, a.as_of, a.multi_line, a.original_layout, required=a.require)
        for report in filter(None, out.values()):
            report.show(truncate=False)
    except quality.QualityGateError as e:
        print(f"quality gate blocked the gold layer: {e}")
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
