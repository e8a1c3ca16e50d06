"""Capture end to end: two days, a replay, and a day without news."""

from pyspark.sql import functions as F

from vacanta.plans import ingest
from vacanta.plans import postings as P
from vacanta.sources.batches import read_batches
from vacanta.sources.tables import table

TS = "2024-08-01 02:00:00"


def test_days_replays_and_rejects(spark, tmp_dir):
    raw = P.raw_postings(table(spark, "/root/testdata/sf0.001", "documents"))
    root = tmp_dir + "/lake"
    def run(day, rows):
        ts = F.lit(f"2024-08-0{day} 02:00:00").cast("timestamp")
        return sorted(r.source_job_id for r in ingest.capture_run(spark, rows, root + "/bronze", root + "/state", f"day{day}", ts, TS, [F.col("doc_id")]).select("source_job_id").collect())
    landed = lambda: sorted(r.source_job_id for r in read_batches(spark, root + "/bronze")[0].select("source_job_id").collect())
    one = run(1, raw.filter("doc_id % 2 = 0"))
    two = run(2, raw)
    assert one and two and not set(one) & set(two)
    assert landed() == sorted(one + two)
    assert run(3, raw) == []                                  # nothing new
    assert run(2, raw) == two and landed() == sorted(one + two)   # a replay lands the same
    assert ingest.rejected(raw).count() == raw.filter("source_job_id is null").count() > 0


def test_unread_fields_of_api_records_are_landed(spark, tmp_dir):
    raw = P.raw_postings(table(spark, "/root/testdata/sf0.001", "documents")).withColumn("salary_min", F.col("doc_id") * 10)
    ts = F.lit(TS).cast("timestamp")
    kept = ingest.capture_run(spark, raw, tmp_dir + "/bronze", tmp_dir + "/state", "r1", ts, TS, [F.col("doc_id")])
    api = kept.filter("source = 'adzuna_api'")
    rows = spark.read.json(tmp_dir + "/bronze/source=adzuna_api").select(F.explode("records").alias("r")).select("r.id", "r.salary_min")
    assert sorted((r.id, r.salary_min) for r in rows.collect()) == sorted((r.source_job_id, r.salary_min) for r in api.collect()) != []
