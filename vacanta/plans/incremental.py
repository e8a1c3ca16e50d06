"""Silver by increments: only new bronze runs are derived, only touched partitions are written, and a
version is public only after its audit.

A run (:func:`increment`):

1. finds the bronze run folders that the published version doesn't cover, and derives silver rows from those,
2. joins their fingerprints with the published table's (narrow columns) and decides each one's survivor by the
   same order as a full rebuild,
3. writes the year/month partitions that gain or lose a row, as new folders; all other partitions of the new version
   are the folders of the version before,
4. audits the staged version from per-partition numbers, of which only the written partitions' are new,
5. publishes it by one rename. A blocked or killed run leaves readers with the version before, and its bronze
   runs uncovered, so the next run takes them again.

A survivor is decided once for every fingerprint that new rows touch, so versions equal a rebuild from all
bronze runs, up to rows that tie in publication date, source and id (the published one stays)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators import quality
from ..operators.dedup import dedupe, silver_survivor
from ..operators.mapping import DEFAULT_SPECS
from ..session import scratch_table
from ..sources import versions as V
from ..sources.batches import REJECTS, read_batches, source_path, write_layer
from . import daily
from . import silver as S

KEY, PARTS = "job_fingerprint", ["year", "month"]
NARROW = [KEY, "publication_date", "source", "source_job_id", *PARTS]
#: Lists of covered bronze runs that gather before they are written as one.
LISTS = 32


# ----------------------------------------------------------------- versions of the silver table

def part_name(year: int, month: int) -> str:
    return f"year={year}/month={month}"


def _read_parts(spark: SparkSession, root: str, content: dict, names=None) -> DataFrame:
    schema = T.StructType.fromJson(content["schema"])
    folders = [p["folder"] for name, p in content["parts"].items() if names is None or name in names]
    if not folders:
        return spark.createDataFrame([], schema)
    with_part = T.StructType([*schema.fields, T.StructField("part", T.StringType())])
    return spark.read.schema(with_part).option("basePath", f"{root.rstrip('/')}/data").parquet(*folders).drop("part").select(*schema.names)


def read_silver(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest published silver table, or an earlier version that still has its files."""
    manifest = V.read_manifest(spark, root, version)
    if manifest is None:
        raise FileNotFoundError(f"no silver version was published under {root}")
    return _read_parts(spark, root, manifest.content)


@dataclass
class Staged:
    """A version that is written but not public."""

    base: V.Manifest | None
    content: dict
    touched: list[str]  #: names of the partitions written for it


# ----------------------------------------------------------------- bronze runs

def bronze_runs(spark: SparkSession, bronze_root: str) -> dict[str, list[str]]:
    """Run folders by source, relative to the root."""
    out = {}
    for source in DEFAULT_SPECS:
        top = source_path(bronze_root, source)
        runs = [f"{d}/{r}" for d in V.list_folder(spark, top) if d.startswith("ingest_date=") for r in V.list_folder(spark, f"{top}/{d}") if r.startswith("run=")]
        if runs:
            out[source] = runs
    return out


def uncovered_runs(spark: SparkSession, bronze_root: str, base: V.Manifest | None) -> dict[str, list[str]]:
    runs = bronze_runs(spark, bronze_root)
    if base is None or not runs:
        return runs
    listed = spark.createDataFrame([(s, r) for s, names in runs.items() for r in names], "source string, run string")
    covered = spark.read.schema("source string, run string").parquet(*base.content["covered"])
    out: dict[str, list[str]] = {}
    for row in listed.join(covered, ["source", "run"], "left_anti").orderBy("source", "run").collect():  # the runs since the last version
        out.setdefault(row["source"], []).append(row["run"])
    return out


# ----------------------------------------------------------------- staging

def stage(spark: SparkSession, bronze_root: str, root: str, run_ts=None, multi_line: bool = False) -> Staged | None:
    """Writes the next version's new folders; None when no bronze run is new."""
    base = V.read_manifest(spark, root)
    runs = uncovered_runs(spark, bronze_root, base)
    if not runs:
        return None
    paths = {s: [f"{source_path(bronze_root, s)}/{r}" for r in names] for s, names in runs.items()}
    unified, rejects, _ = read_batches(spark, bronze_root, specs={s: DEFAULT_SPECS[s] for s in runs}, multi_line=multi_line, paths=paths)
    delta = scratch_table(S.build_silver(unified, run_ts), "silver-delta")
    content = dict(base.content) if base else {"parts": {}, "schema": delta.schema.jsonValue(), "covered": []}
    rows, touched = merge(spark, root, content, delta)
    parts = dict(content["parts"])
    if touched:
        folder = V.stage_folder(root, base)
        seen = Observation("silver")
        write_layer(rows.observe(seen, *_numbers()), folder, partition_by=PARTS)
        numbers = partition_numbers(spark.read.schema(rows.schema).parquet(folder))
        if {k: sum(p[k] for p in numbers.values()) for k in COUNTS} != {k: seen.get[k] or 0 for k in COUNTS}:
            raise RuntimeError("the staged files don't hold the rows that were written")
        for name in touched:
            parts.pop(name, None)  # also where a partition has lost its last row
        parts |= {name: p | {"folder": f"{folder}/{name}"} for name, p in numbers.items()}
    refused = V.stage_folder(root, base)
    rejects.select(*[c.split()[0] for c in REJECTS.split(", ")]).write.parquet(refused)
    covered = V.stage_folder(root, base)
    spark.createDataFrame([(s, r) for s, names in runs.items() for r in names], "source string, run string").coalesce(1).write.parquet(covered)
    lists = [*content["covered"], covered]
    if len(lists) >= LISTS:
        one = V.stage_folder(root, base)
        spark.read.schema("source string, run string").parquet(*lists).coalesce(1).write.parquet(one)
        lists = [one]
    return Staged(base, content | {"parts": parts, "covered": lists, "rejects": refused}, touched)


def merge(spark: SparkSession, root: str, content: dict, delta: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows of all partitions that ``delta`` touches, and the partitions' names.

    The published table is read for its narrow columns only, and whole in the touched partitions."""
    published = _read_parts(spark, root, content).select(*NARROW)
    met = scratch_table(published.join(delta.select(KEY), KEY, "left_semi"), "silver-met")
    both = met.withColumn("fresh", F.lit(False)).unionByName(delta.select(*NARROW).withColumn("fresh", F.lit(True)))
    winners = scratch_table(dedupe(both, [KEY], [*silver_survivor(), F.col("fresh")]).filter("fresh").select(KEY), "silver-winners")
    added = delta.join(winners, KEY, "left_semi")
    lost = met.join(winners, KEY, "left_semi")
    touched = sorted({part_name(*r) for r in added.select(*PARTS).unionByName(lost.select(*PARTS)).distinct().collect()})  # a row per month
    kept = _read_parts(spark, root, content, set(touched)).join(lost.select(KEY), KEY, "left_anti")
    return kept.unionByName(added), touched


# ----------------------------------------------------------------- audit

COUNTS = ("rows", "null_keys", "invalid_rows")


def _numbers(allowed=quality.V.ALLOWED_DOMAINS):
    """Numbers of a partition that the audit adds up."""
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(KEY).isNull() | F.col("source_job_id").isNull()).alias("null_keys"),
            F.count_if(~F.coalesce(F.col("primary_domain").isin(list(allowed)), F.lit(False))).alias("invalid_rows"),
            F.date_format(F.max("publication_date"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("latest")]


def partition_numbers(rows: DataFrame) -> dict[str, dict]:
    made = rows.groupBy(*PARTS).agg(*_numbers()).collect()  # a row per month
    return {part_name(r["year"], r["month"]): {k: r[k] for k in (*COUNTS, "latest")} for r in made}


def audit(spark: SparkSession, root: str, staged: Staged, as_of_date) -> DataFrame:
    """The report of ``quality.run_checks`` on a staged version, added up from its partitions' numbers.

    Whole scans: the fingerprint column, for uniqueness. Partitions with dates after ``as_of_date`` or with
    unknown domains are read for those columns."""
    parts, C_, W_ = staged.content["parts"], quality.CRITICAL, quality.WARNING
    total, null_keys = (sum(p[k] for p in parts.values()) for k in ("rows", "null_keys"))
    keys = _read_parts(spark, root, staged.content).select(KEY)
    distinct = keys.agg(F.count_distinct(KEY) + F.max(F.col(KEY).isNull().cast("int"))).first()[0] or 0
    late = {n for n, p in parts.items() if p["latest"] and p["latest"][:10] >= str(as_of_date)[:10]}
    future = _read_parts(spark, root, staged.content, late).filter(C.in_future(F.col("publication_date"), as_of_date)).count() if late else 0
    odd = {n for n, p in parts.items() if p["invalid_rows"]}
    invalid = quality.invalid_domains(_read_parts(spark, root, staged.content, odd), quality.allowed_domains(spark)).count() if odd else 0
    rows = [("non_empty", C_, total, total > 0), ("key_completeness", C_, null_keys, null_keys == 0), ("key_uniqueness", C_, total - distinct, total == distinct),
            ("domain_validity", C_, invalid, invalid == 0), ("future_dates", W_, future, future == 0)]
    return spark.createDataFrame(rows, "check string, severity string, observed long, passed boolean")


def partition_report(spark: SparkSession, root: str) -> DataFrame:
    """The published version's numbers by partition."""
    manifest = V.read_manifest(spark, root)
    rows = [(name, *[p[k] for k in (*COUNTS, "latest")]) for name, p in (manifest.content["parts"] if manifest else {}).items()]
    return spark.createDataFrame(rows, "partition string, rows long, null_keys long, invalid_rows long, latest string")


# ----------------------------------------------------------------- runs

def increment(spark: SparkSession, bronze_root: str, root: str, as_of_date, run_ts=None, multi_line: bool = False,
              staged: Staged | None = None, report: DataFrame | None = None) -> DataFrame | None:
    """Stages, audits, publishes; returns the audit's report, None when no bronze run is new.
    Raises ``quality.QualityGateError`` before the publish when a critical check fails.

    A version that the caller has staged, and its ``audit``, can be handed in: they are not made a second time. A version
    published in between makes the publish fail, as for any staged one."""
    staged = stage(spark, bronze_root, root, run_ts, multi_line) if staged is None else staged
    if staged is None:
        return None
    report = quality.gate(audit(spark, root, staged, as_of_date) if report is None else report)
    V.publish(spark, root, staged.base, staged.content)
    return report


def run_incremental(spark: SparkSession, bronze_root: str, silver_root: str, gold_path: str, keys_root: str, run_ts=None, as_of_date=None,
                    multi_line: bool = False) -> dict[str, DataFrame | None]:
    """The daily run by increments: silver version, gate, publish, gold with registered keys."""
    if as_of_date is None:
        as_of_date = spark.range(1).select(C.run_timestamp(run_ts).cast("date")).first()[0]
    report = increment(spark, bronze_root, silver_root, as_of_date, run_ts, multi_line)
    return {"quality": report, "gold": None if report is None else daily.gold_layer(spark, read_silver(spark, silver_root), gold_path, keys_root)}
