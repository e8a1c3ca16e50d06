"""Bronze batches: envelope JSON ``{metadata, records[]}`` per source and run.

Sink: records are packed into envelopes of at most ``chunk_rows`` records (one
per line, so files stay splittable), under
``<root>/source=<name>/ingest_date=<yyyy-MM-dd>/run=<HHmmss>/``. Nothing is
written for an empty batch; writing the same run again replaces its folders.

Scan: per source a declared schema (no inference job, no drift), permissive
``from_json`` parsing with a corrupt-record column whose rows go to a reject
table, all files beneath the source folder at any depth. A source whose folder is missing is
skipped; the load fails only when no source loads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab as V
from ..operators.mapping import DEFAULT_SPECS, Spec, map_to_canonical, union_sources

CORRUPT = "_corrupt_record"

ANALYTICS = T.StructType([
    T.StructField("is_internship", T.BooleanType()),
    T.StructField("internship_type", T.StringType()),
    T.StructField("internship_duration", T.StringType()),
    T.StructField("is_remunerated", T.BooleanType()),
    T.StructField("work_mode", T.StringType()),
])

METADATA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("pipeline_stage", T.StringType()),
    T.StructField("ingestion_timestamp_utc", T.StringType()),
    T.StructField("new_records_count", T.LongType()),
    T.StructField("internships_count", T.LongType()),
    T.StructField("domains_covered", T.ArrayType(T.StringType())),
])

_TAGS = [T.StructField("matched_domains", T.ArrayType(T.StringType())),
         T.StructField("matched_roles", T.ArrayType(T.StringType())),
         T.StructField("analytics_metadata", ANALYTICS)]

API_RECORD = T.StructType([
    T.StructField("id", T.StringType()),  # a JSON number is read as its text
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("created", T.StringType()),
    T.StructField("contract_type", T.StringType()),
    T.StructField("company", T.StructType([T.StructField("display_name", T.StringType())])),
    T.StructField("location", T.StructType([T.StructField("area", T.ArrayType(T.StringType())),
                                            T.StructField("display_name", T.StringType())])),
    *_TAGS,
])

PAGE_RECORD = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("job_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("raw_metadata", T.StringType()),
    T.StructField("location_city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
    *_TAGS,
])


def envelope_schema(record: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("metadata", METADATA),
                         T.StructField("records", T.ArrayType(record)),
                         T.StructField(CORRUPT, T.StringType())])


RECORD_SCHEMAS = {"adzuna_api": API_RECORD, "rekrute_scraper": PAGE_RECORD,
                  "emploima_scraper": PAGE_RECORD, "dreamjob_scraper": PAGE_RECORD}


# ---------------------------------------------------------------------------
# sink
# ---------------------------------------------------------------------------

def _pack_envelopes(chunk_rows: int, domains: list[str]):
    """Arrow function for ``mapInArrow``: consecutive records of one source inside a
    task become envelopes of at most ``chunk_rows`` records. Envelopes end with the Arrow
    batch, whose bytes Spark bounds (``spark.sql.execution.arrow.maxBytesPerBatch``). Each leaves the
    task on its own: beside the batch, one envelope is copied at a time."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            src = rb.column("source")
            first = {c: rb.column(c)[0].as_py() for c in ("run_iso", "ingest_date", "run")}
            for value in pc.unique(src).to_pylist():
                idx = pc.indices_nonzero(pc.equal(src, pa.scalar(value, pa.string()))
                                         if value is not None else pc.is_null(src))
                for start in range(0, len(idx), chunk_rows):
                    piece = rb.take(idx.slice(start, chunk_rows))
                    records = pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), piece.column("record"))
                    interns = pc.sum(pc.fill_null(piece.column("is_internship"), False).cast(pa.int64())).as_py() or 0
                    metadata = pa.StructArray.from_arrays([
                        pa.array([value], pa.string()),
                        pa.array([piece.column("country")[0].as_py()], pa.string()),
                        pa.array(["bronze_delta"], pa.string()),
                        pa.array([first["run_iso"]], pa.string()),
                        pa.array([piece.num_rows], pa.int64()),
                        pa.array([interns], pa.int64()),
                        pa.array([domains], pa.list_(pa.string())),
                    ], names=["source", "country", "pipeline_stage", "ingestion_timestamp_utc", "new_records_count",
                              "internships_count", "domains_covered"])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([value], pa.string()), metadata, records,
                        pa.array([first["ingest_date"]], pa.string()),
                        pa.array([first["run"]], pa.string()),
                    ], names=["source", "metadata", "records", "ingest_date", "run"])

    return run


def write_envelopes(records: DataFrame, root: str, run_ts: Column, chunk_rows: int = 1000,
                    country: Column | None = None) -> None:
    """Pack ``records`` (columns: ``source``, ``record`` struct, ``is_internship``)
    into envelopes under ``root``. An empty batch writes no envelope.

    Envelopes are cut inside each task from consecutive records of one source
    (``mapInArrow``), so no envelope holds more than ``chunk_rows`` records, no
    source is collected into a single task, and the record text is never shuffled."""
    record_type = records.schema["record"].dataType
    out_schema = T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("metadata", METADATA),
        T.StructField("records", T.ArrayType(record_type)),
        T.StructField("ingest_date", T.StringType()),
        T.StructField("run", T.StringType()),
    ])
    staged = records.select(
        "source", "record", "is_internship",
        (country if country is not None else F.lit(V.MOROCCO)).alias("country"),
        F.date_format(run_ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("run_iso"),
        F.date_format(run_ts, "yyyy-MM-dd").alias("ingest_date"),
        F.date_format(run_ts, "HHmmss").alias("run"))
    envelopes = staged.mapInArrow(_pack_envelopes(chunk_rows, list(V.TAXONOMY)), out_schema)
    # each run owns its source/ingest_date/run folders; re-running the same run
    # replaces them (dynamic partition overwrite) instead of appending twice
    (envelopes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("source", "ingest_date", "run").json(root))


# ---------------------------------------------------------------------------
# scan
# ---------------------------------------------------------------------------

def read_envelopes(spark: SparkSession, path: str | list[str], record: T.StructType, multi_line: bool = False) -> DataFrame:
    """Envelopes under ``path`` (one or several folders, any depth) with the declared schema; ``records`` hold each
    record's JSON text.

    Files are read as text — one envelope per line, or with ``multi_line`` one per
    file (pretty-printed documents) — and parsed with ``from_json`` in permissive
    mode: a malformed envelope keeps its text in ``_corrupt_record`` (and the
    source file name), so the reject table needs no second pass over the files."""
    raw = (spark.read.option("recursiveFileLookup", True).text(path, wholetext=multi_line)
           .filter(F.trim(F.col("value")) != F.lit("")))
    parsed = F.from_json(F.col("value"), envelope_schema(T.StringType()), {"mode": "PERMISSIVE",
                                                                          "columnNameOfCorruptRecord": CORRUPT})
    return raw.select(parsed.alias("e"), F.input_file_name().alias("file")).select("e.*", "file")


def read_records(envelopes: DataFrame, record: T.StructType) -> DataFrame:
    """One row per record of the sound envelopes: ``r``, the file, and the record's text where
    it doesn't fit the schema (one bad record costs itself, not its envelope)."""
    schema = T.StructType(record.fields + [T.StructField(CORRUPT, T.StringType())])
    texts = envelopes.filter(F.col(CORRUPT).isNull()).select("file", F.explode("records").alias("text"))
    return texts.select("file", F.from_json("text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))


def undeclared_fields(envelopes: DataFrame, record: T.StructType) -> DataFrame:
    """(file, pos, field, value) of the records' fields that the declared schema leaves out: what a source sent beyond it,
    kept on landing. ``value`` is a VARIANT: it has the type that it has in the record, and is read with ``variant_get``
    or ``try_variant_get``. Records that aren't JSON objects have none (they are in the reject table)."""
    declared = [f.name for f in record.fields]
    texts = envelopes.filter(F.col(CORRUPT).isNull()).select("file", F.posexplode("records").alias("pos", "text"))
    fields = texts.select("file", "pos", F.explode(F.from_json("text", "map<string,variant>")).alias("field", "value"))
    return fields.filter(~F.col("field").isin(declared))


def field_drift(fields: DataFrame) -> DataFrame:
    """(field, type, n): the types under which each undeclared field came, most narrow form (``BIGINT``, ``STRING``, ``OBJECT<...>``)."""
    return fields.groupBy("field", F.coalesce(F.schema_of_variant("value"), F.lit("VOID")).alias("type")).agg(F.count(F.lit(1)).alias("n"))


def source_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/source={source}"


# FIXED VALUES — folder names of the original bronze layout (one folder per source,
# then plain date folders holding pretty-printed envelope files).
ORIGINAL_LAYOUT = {
    "adzuna_api": "api_adzuna",
    "rekrute_scraper": "scraper_rekrute",
    "emploima_scraper": "scraper_emploima",
    "dreamjob_scraper": "scraper_dreamjob",
}


def original_layout_paths(root: str) -> dict[str, str]:
    """``paths`` for :func:`read_batches` over the original layout (use ``multi_line=True``)."""
    return {name: f"{root.rstrip('/')}/{folder}" for name, folder in ORIGINAL_LAYOUT.items()}


REJECTS = "source string, file string, reason string, raw string"


def read_batches(spark: SparkSession, root: str, specs: dict[str, Spec] | None = None,
                 schemas: dict[str, T.StructType] | None = None, multi_line: bool = False,
                 paths: dict[str, str | list[str]] | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Canonical rows of all sources that load, the rejected envelopes and records
    (source, file, reason, raw), and the names of skipped sources (no folder)."""
    specs = specs or DEFAULT_SPECS
    schemas = schemas or RECORD_SCHEMAS
    good, bad, skipped = [], [], []
    for name, spec in specs.items():
        path = (paths or {}).get(name, source_path(root, name))
        try:
            env = read_envelopes(spark, path, schemas[name], multi_line)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            skipped.append(name)
            continue
        records = read_records(env, schemas[name])
        sound = F.col(f"r.{CORRUPT}").isNull()
        good.append(map_to_canonical(records.filter(sound), spec))
        bad.append(env.filter(F.col(CORRUPT).isNotNull())
                      .select(F.lit(name).alias("source"), "file", F.lit("envelope").alias("reason"), F.col(CORRUPT).alias("raw")))
        bad.append(records.filter(~sound).select(F.lit(name).alias("source"), "file", F.lit("record").alias("reason"), F.col(f"r.{CORRUPT}").alias("raw")))
    if not good:
        raise FileNotFoundError(f"no bronze source found under {root}")
    return union_sources(good), union_sources(bad), skipped


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet layer write (snappy). Partitioned layers get a ``rebalance`` hint on
    their partition columns: rows of one partition value go to few writers (few
    files), and AQE splits a value that holds a large share of the rows over
    several tasks instead of one."""
    w = df.hint("rebalance", *partition_by) if partition_by else df
    writer = w.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
