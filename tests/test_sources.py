"""Bronze envelopes: sink, scan, rejects, missing sources; layer writes."""

import os

from pyspark.sql import functions as F

from vacanta.operators.mapping import api_spec
from vacanta.sources import batches as B


def _page_records(spark, n, source="rekrute_scraper"):
    rows = [(source, (source, f"https://x/{i}", f"title {i}", None if i % 3 == 0 else f"C{i}", f"sum {i}",
                      "stage | 6 mois", None, "Maroc", "2024-01-02T10:00:00Z", ["DATA_SCIENCE"], ["data scientist"],
                      (i % 2 == 0, "STAGE", None, None, "SUR_SITE")), i % 2 == 0) for i in range(n)]
    return spark.createDataFrame(rows, f"source string, record {B.PAGE_RECORD.simpleString()}, is_internship boolean")


def test_envelopes_roundtrip_and_empty_batch(spark, tmp_dir):
    root = tmp_dir + "/bronze"
    run_ts = F.lit("2024-01-02 02:00:00").cast("timestamp")
    B.write_envelopes(_page_records(spark, 0), root, run_ts)
    assert not any(d.startswith("source=") for d in os.listdir(root))   # no envelope for an empty batch
    B.write_envelopes(_page_records(spark, 25), root, run_ts, chunk_rows=10)
    env = B.read_envelopes(spark, B.source_path(root, "rekrute_scraper"), B.PAGE_RECORD)
    sizes = [r.n for r in env.select(F.size("records").alias("n")).collect()]
    assert sum(sizes) == 25 and max(sizes) <= 10          # bounded envelopes
    meta = env.agg(F.sum("metadata.new_records_count"), F.sum("metadata.internships_count")).first()
    assert tuple(meta) == (25, 13)
    unified, rejects, skipped = B.read_batches(spark, root)
    assert set(skipped) == {"adzuna_api", "emploima_scraper", "dreamjob_scraper"}
    rows = unified.collect()
    assert len(rows) == 25
    assert {r.location_city for r in rows} == {"Maroc"}
    assert sum(r.company_name == "Non spécifié" for r in rows) == 9
    assert rows[0].raw_description.endswith("stage | 6 mois")
    assert rejects.count() == 0


def test_truncated_and_reference_shaped_files(spark, tmp_dir):
    root = tmp_dir + "/bronze"
    api = os.path.join(root, "source=adzuna_api", "2024-01-02")
    os.makedirs(api)
    # a pretty-printed multi-line envelope as the capture jobs write it, a numeric id,
    # an empty location area, and a truncated file
    with open(os.path.join(api, "adzuna_delta_020000.json"), "w") as f:
        f.write('{\n  "metadata": {"source": "adzuna_api"},\n  "records": [\n    {"id": 42, "title": "Data Engineer",'
                ' "created": "2024-01-02T10:00:00Z", "company": {"display_name": null},'
                ' "location": {"area": [], "display_name": "Paris"}, "matched_domains": []}\n  ]\n}\n')
    with open(os.path.join(api, "adzuna_delta_030000.json"), "w") as f:
        f.write('{\n  "metadata": {"source": "adzuna_api"},\n  "records": [\n    {"id": 43, "tit')
    unified, rejects, skipped = B.read_batches(spark, root, specs={"adzuna_api": api_spec()}, multi_line=True)
    rows = unified.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.source_job_id, r.company_name, r.location_country, r.location_city) == ("42", "Non spécifié", "France",
                                                                                      "Paris")
    assert r.raw_description == "" and r.raw_contract == ""
    assert rejects.count() == 1


def test_envelope_run_is_idempotent(spark, tmp_dir):
    root = tmp_dir + "/bronze"
    run_ts = F.lit("2024-01-02 02:00:00").cast("timestamp")
    B.write_envelopes(_page_records(spark, 12), root, run_ts, chunk_rows=5)
    B.write_envelopes(_page_records(spark, 12), root, run_ts, chunk_rows=5)       # replay of the run
    B.write_envelopes(_page_records(spark, 3, "dreamjob_scraper"), root, run_ts)  # another source, same run
    unified, _, _ = B.read_batches(spark, root)
    counts = {r.source: r["count"] for r in unified.groupBy("source").count().collect()}
    assert counts == {"rekrute_scraper": 12, "dreamjob_scraper": 3}


def test_original_layout_paths(spark, tmp_dir):
    root = tmp_dir + "/bronze"
    folder = os.path.join(root, "scraper_dreamjob", "2024-01-02")
    os.makedirs(folder)
    with open(os.path.join(folder, "dreamjob_delta_020000.json"), "w") as f:
        f.write('{\n  "metadata": {"source": "dreamjob_scraper"},\n  "records": [\n    {"source": "dreamjob_scraper",'
                ' "job_url": "https://x/emploi/1", "title": "Data Engineer", "company": "Acme",'
                ' "summary": "stage 6 mois", "raw_metadata": "kw=data", "location_city": "Rabat",'
                ' "country": "Maroc", "scraped_at": "2024-01-02T10:00:00+00:00",'
                ' "matched_domains": ["DATA_ENGINEERING_PLATFORMS"], "matched_roles": ["data engineer"]}\n  ]\n}\n')
    unified, rejects, skipped = B.read_batches(spark, root, paths=B.original_layout_paths(root), multi_line=True)
    assert sorted(skipped) == ["adzuna_api", "emploima_scraper", "rekrute_scraper"]
    r = unified.collect()[0]
    assert (r.source, r.source_job_id, r.location_city, r.raw_description) == (
        "dreamjob_scraper", "https://x/emploi/1", "Rabat", "stage 6 mois kw=data")
    assert rejects.count() == 0


def test_one_bad_record_costs_itself(spark, tmp_dir):
    root = tmp_dir + "/bronze"
    folder = os.path.join(root, "source=rekrute_scraper")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.json"), "w") as f:
        f.write('{"metadata": {"source": "rekrute_scraper"}, "records": [{"job_url": "u1", "title": "t1"}, {"job_url": "u2", "matched_domains": "no list"}, {"job_url": "u3"}]}\n')
        f.write('{"metadata": {"source": "rekrute_scraper"}, "records": [{"job_url": "u4"\n')
    unified, rejects, skipped = B.read_batches(spark, root)
    assert sorted(r.source_job_id for r in unified.collect()) == ["u1", "u3"]
    assert sorted(r.reason for r in rejects.collect()) == ["envelope", "record"]
    assert len(skipped) == 3


def test_undeclared_fields_keep_their_types(spark, tmp_dir):
    import json

    records = [{"id": "1", "title": "t", "salary_min": 1000, "latitude": 3.5, "category": {"tag": "it"}}, {"id": "2", "salary_min": "n/a", "o'x": [1, 2], 'q"': True, "none": None}, {"id": "3"}, 7, "s"]
    with open(tmp_dir + "/a.json", "w") as f:
        f.write(json.dumps({"metadata": {"source": "adzuna_api"}, "records": records}) + "\n{broken\n")
    envelopes = B.read_envelopes(spark, tmp_dir, B.API_RECORD)
    fields = B.undeclared_fields(envelopes, B.API_RECORD)
    got = {(r["pos"], r["field"]): json.loads(r["v"]) for r in fields.select("pos", "field", F.to_json("value").alias("v")).collect()}
    assert got == {(0, "salary_min"): 1000, (0, "latitude"): 3.5, (0, "category"): {"tag": "it"}, (1, "salary_min"): "n/a", (1, "o'x"): [1, 2], (1, 'q"'): True, (1, "none"): None}
    drift = {(r["field"], r["type"]): r["n"] for r in B.field_drift(fields).collect()}
    assert drift[("salary_min", "BIGINT")] == drift[("salary_min", "STRING")] == drift[("category", "OBJECT<tag: STRING>")] == 1
    assert fields.filter("field = 'category'").select(F.try_variant_get("value", "$.tag", "string")).first()[0] == "it"


def test_each_envelope_leaves_the_task_on_its_own():
    import pyarrow as pa

    n = 25
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["a" if k % 5 else None for k in range(n)]), pa.array([{"t": f"r{k}"} for k in range(n)]), pa.array([True, None, False, False, True] * 5), pa.array([f"c{k}" for k in range(n)]),
         *[pa.array([v] * n) for v in ("iso", "day", "run")]], names=["source", "record", "is_internship", "country", "run_iso", "ingest_date", "run"])
    out = list(B._pack_envelopes(8, ["D"])(iter([batch.slice(0, 0), batch])))
    assert [o.num_rows for o in out] == [1] * 4 and all(o.column("records").values.nbytes < batch.column("record").nbytes for o in out)
    rows = [o.to_pylist()[0] for o in out]
    assert sorted(r["t"] for row in rows for r in row["records"]) == sorted(f"r{k}" for k in range(n))
    assert [(r["source"], r["metadata"]["country"], r["metadata"]["new_records_count"], r["metadata"]["internships_count"]) for r in rows] == [
        (None, "c0", 5, 5), ("a", "c1", 8, 2), ("a", "c11", 8, 2), ("a", "c21", 4, 1)]
