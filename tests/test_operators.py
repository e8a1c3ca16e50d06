"""Dedupe, dense keys, capture, quality gate, star schema invariants."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vacanta.operators import capture, quality, star
from vacanta.operators.dedup import dedupe, dedupe_postings
from vacanta.operators.keys import dense_key


def test_dense_key_equals_row_number(spark):
    rows = [(f"k{i % 37:02d}", i % 5 if i % 7 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "a string, b int")
    got = dense_key(df, ["a", "b"], "id", num_partitions=6)
    expected = (df.distinct().withColumn(
        "id", F.row_number().over(Window.orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first())))
        .withColumn("id", F.col("id").cast("long")))
    assert set(map(tuple, got.collect())) == set(map(tuple, expected.select("a", "b", "id").collect()))
    ids = sorted(r.id for r in got.collect())
    assert ids == list(range(1, len(ids) + 1))


def test_dense_key_repeatable_other_partitioning(spark):
    df = spark.createDataFrame([(f"c{i % 50}",) for i in range(300)], "a string")
    k1 = {r.a: r.id for r in dense_key(df, ["a"], "id", num_partitions=3).collect()}
    k2 = {r.a: r.id for r in dense_key(df.repartition(7), ["a"], "id", num_partitions=11).collect()}
    k3 = {r.a: r.id for r in dense_key(df.repartition(5), ["a"], "id").collect()}   # single ordered window
    assert k1 == k2 == k3


def test_dedupe_survivor(spark):
    rows = [("fp1", "2024-01-02", "b", "2"), ("fp1", "2024-01-03", "a", "1"), ("fp1", None, "a", "0"),
            ("fp2", None, "z", "9"), ("fp2", None, "a", None), ("fp2", None, "a", "5")]
    df = spark.createDataFrame(rows, "job_fingerprint string, d string, source string, source_job_id string")
    df = df.withColumn("publication_date", F.col("d").cast("timestamp"))
    got = {r.job_fingerprint: (r.source, r.source_job_id) for r in dedupe_postings(df).collect()}
    assert got == {"fp1": ("a", "1"), "fp2": ("a", "5")}


def test_dedupe_plans_partial_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id"))
    plan = dedupe(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def _events(spark, rows):
    return spark.createDataFrame(rows, "key string, pos int, keep boolean")


def test_capture_batches_and_replay(spark, tmp_dir):
    root = tmp_dir + "/landed"
    b1 = _events(spark, [("a", 1, True), ("b", 2, False), ("a", 3, True), ("c", 4, True)])
    out1 = capture.capture_batch(spark, b1, root, "1", ["key"], [F.col("pos")], keep=F.col("keep"))
    assert sorted((r.key, r.pos) for r in out1.collect()) == [("a", 1), ("c", 4)]
    # rejected key b is looked at again; a is seen
    b2 = _events(spark, [("b", 5, True), ("a", 6, True), ("d", 7, True)])
    out2 = capture.capture_batch(spark, b2, root, "2", ["key"], [F.col("pos")], keep=F.col("keep"))
    assert sorted((r.key, r.pos) for r in out2.collect()) == [("b", 5), ("d", 7)]
    # replaying batch 2 gives the same folder content
    again = capture.capture_batch(spark, b2, root, "2", ["key"], [F.col("pos")], keep=F.col("keep"))
    assert sorted((r.key, r.pos) for r in again.collect()) == [("b", 5), ("d", 7)]
    # a rerun of everything as a new batch adds nothing
    out3 = capture.capture_batch(spark, b1.unionByName(b2), root, "3", ["key"], [F.col("pos")], keep=F.col("keep"))
    assert out3.count() == 0
    assert spark.read.parquet(root).count() == 4


def test_capture_history_equals_sequential_runs(spark):
    rows = [("a", 1, False, 1), ("a", 2, True, 1), ("b", 3, True, 1), ("a", 4, True, 2), ("c", 5, False, 2),
            ("c", 6, True, 3)]
    df = spark.createDataFrame(rows, "key string, pos int, keep boolean, batch int")
    first = capture.first_capture_history(df, ["key"], "batch", [F.col("pos")], keep=F.col("keep"))
    assert sorted((r.key, r.batch) for r in first.collect()) == [("a", 1), ("b", 1), ("c", 3)]


def _silver_rows(spark, rows):
    return spark.createDataFrame(rows, "job_fingerprint string, source_job_id string, primary_domain string, "
                                       "publication_date timestamp")


def test_quality_report_and_gate(spark):
    import datetime as dt
    today, tomorrow = dt.datetime(2024, 5, 1, 12), dt.datetime(2024, 5, 2, 0, 0, 1)
    ok = _silver_rows(spark, [("a", "1", "DATA_SCIENCE", today), ("b", "2", "NON_CLASSE", None)])
    rep = {r.check: (r.observed, r.passed) for r in quality.run_checks(ok, "2024-05-01").collect()}
    assert rep["future_dates"] == (1, False)          # anything after midnight of the as-of day
    assert all(v[1] for k, v in rep.items() if k != "future_dates")
    quality.gate(quality.run_checks(ok, "2024-05-01"))  # warnings never block
    bad = _silver_rows(spark, [("a", None, "DATA_SCIENCE", tomorrow), ("a", "1", "UNKNOWN", None),
                               (None, "3", None, None)])
    rep = {r.check: (r.observed, r.passed) for r in quality.run_checks(bad, "2024-05-01").collect()}
    assert rep["key_completeness"] == (2, False)
    assert rep["key_uniqueness"] == (1, False)        # null counts as one key
    assert rep["domain_validity"] == (2, False)       # unknown and null
    with pytest.raises(quality.QualityGateError):
        quality.gate(quality.run_checks(bad, "2024-05-01"))
    empty = _silver_rows(spark, [])
    rep = {r.check: (r.observed, r.passed) for r in quality.run_checks(empty, "2024-05-01").collect()}
    assert rep["non_empty"] == (0, False)


def test_star_invariants(spark):
    rows = [("f1", "s", "1", "t", "Acme", "Maroc", "Rabat", None, "CDI", False, None, None, "x", None, "SUR_SITE",
             "DATA_SCIENCE", ["data scientist"], ["data scientist"], 2026, 10),
            ("f2", "s", "2", "t", "Acme", "France", "Paris", None, "STAGE", True, "PFE", 6, "x", True, "HYBRID",
             "NON_CLASSE", [], [], 2026, 10),
            ("f3", "s", "3", "t", "Beta", "Maroc", "Rabat", None, "STAGE", True, "PFE", 6, "x", True, "HYBRID",
             "NON_CLASSE", None, None, 2026, 10)]
    schema = ("job_fingerprint string, source string, source_job_id string, job_title_clean string, "
              "company_name string, location_country string, location_city string, publication_date timestamp, "
              "contract_type string, is_internship boolean, internship_category string, duration_months int, "
              "duration_bracket string, is_remunerated boolean, work_mode string, primary_domain string, "
              "matched_domains array<string>, matched_roles array<string>, year int, month int")
    silver = spark.createDataFrame(rows, schema)
    g = star.build_gold(silver)
    comp = {r.company_name: (r.company_id, r.total_jobs_posted) for r in g["dim_company"].collect()}
    assert comp == {"Acme": (1, 2), "Beta": (2, 1)}
    assert sum(v[1] for v in comp.values()) == g["fact_job_postings"].count()
    loc = {(r.location_country, r.location_city): (r.location_id, r.is_morocco) for r in g["dim_location"].collect()}
    assert loc == {("France", "Paris"): (1, False), ("Maroc", "Rabat"): (2, True)}
    tax = sorted((r.domain, r.role_keyword) for r in g["dim_taxonomy"].collect())
    assert tax == [("DATA_SCIENCE", "data scientist"), ("NON_CLASSE", "Generaliste")]
    facts = g["fact_job_postings"].collect()
    assert all(r.company_id is not None and r.location_id is not None for r in facts)
    assert g["fact_internships_pfe"].count() == 2


def test_capture_stream_exactly_once(spark, tmp_dir):
    from vacanta.streaming.capture import capture_stream

    src = tmp_dir + "/incoming"
    rows = [(k, i, i % 4 != 0) for i, k in enumerate(["a", "b", "a", "c", "d", "b", "e", "a", "f", "c"])]
    df = spark.createDataFrame(rows, "key string, pos int, keep boolean")
    for part in range(3):  # three files arriving
        df.filter(F.col("pos") % 3 == part).coalesce(1).write.mode("append").parquet(src)
    landed = tmp_dir + "/landed"
    q = capture_stream(spark, src, df.schema, landed, ["key"], order_by=lambda: [F.col("pos")],
                       keep=lambda: F.col("keep"), max_files_per_trigger=1)
    q.awaitTermination()
    got = spark.read.parquet(landed)
    keys = sorted(r.key for r in got.collect())
    assert keys == sorted({k for k, i, keep in rows if keep})   # each kept key once
    assert got.select("batch_id").distinct().count() >= 2


def test_daily_gate_blocks_and_passes(spark, tmp_dir):
    from vacanta.plans import daily
    from vacanta.sources import batches as B

    def records(null_id):
        rows = [("rekrute_scraper", ("rekrute_scraper", None if (null_id and i == 0) else f"https://x/{i}",
                                     f"Data Engineer {i}", f"C{i}", "stage 6 mois", "", None, "Maroc",
                                     "2024-01-02T10:00:00Z", ["DATA_ENGINEERING_PLATFORMS"], ["data engineer"],
                                     (True, "STAGE", None, None, "SUR_SITE")), True) for i in range(6)]
        return spark.createDataFrame(rows, f"source string, record {B.PAGE_RECORD.simpleString()}, "
                                           "is_internship boolean")

    ts = F.lit("2024-01-03 02:00:00").cast("timestamp")
    bad, good = tmp_dir + "/bad", tmp_dir + "/good"
    B.write_envelopes(records(True), bad + "/bronze", ts)
    with pytest.raises(quality.QualityGateError):
        daily.run_daily(spark, bad + "/bronze", bad + "/silver", bad + "/gold", "2024-01-03 02:00:00", "2024-01-03")
    B.write_envelopes(records(False), good + "/bronze", ts)
    out = daily.run_daily(spark, good + "/bronze", good + "/silver", good + "/gold", "2024-01-03 02:00:00",
                          "2024-01-03")
    summary = {r.table: r.rows for r in out["gold"].collect()}
    assert summary == {"dim_company": 6, "dim_location": 1, "fact_job_postings": 6, "fact_internships_pfe": 6}
    assert spark.read.parquet(good + "/silver").columns[-2:] == ["year", "month"]


def test_compact_state(spark, tmp_dir):
    root = tmp_dir + "/landed"
    df = _events(spark, [("a", 1, True), ("b", 2, True)])
    capture.capture_batch(spark, df, root, "1", ["key"], [F.col("pos")])
    capture.capture_batch(spark, _events(spark, [("c", 3, True), ("a", 4, True)]), root, "2", ["key"], [F.col("pos")])
    state = capture.compact_state(spark, root, ["key"], tmp_dir + "/state")
    assert sorted((r.key, str(r.first_batch_id)) for r in state.collect()) == [("a", "1"), ("b", "1"), ("c", "2")]


def test_read_seen_state_of_original_jobs(spark, tmp_dir):
    import json
    import os

    path = os.path.join(tmp_dir, "state.json")
    with open(path, "w") as f:
        json.dump({"updated_at": "2024-01-01T00:00:00+00:00", "total_seen": 2, "seen_urls": ["u1", "u2"]}, f, indent=2)
    seen = capture.read_seen_state(spark, path, "rekrute_scraper", "seen_urls")
    assert sorted((r.source, r.key) for r in seen.collect()) == [("rekrute_scraper", "u1"), ("rekrute_scraper", "u2")]
    assert capture.read_seen_state(spark, tmp_dir + "/missing.json", "x").count() == 0
    cand = spark.createDataFrame([("rekrute_scraper", "u1", 1), ("rekrute_scraper", "u3", 2)],
                                 "source string, key string, pos int")
    new = capture.capture_new(cand, seen, ["source", "key"], [F.col("pos")])
    assert [r.key for r in new.collect()] == ["u3"]


def test_silver_independent_of_input_order_and_partitioning(spark):
    from vacanta.plans import postings as P
    from vacanta.plans import silver as S
    from vacanta.sources.tables import table

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    a = S.build_silver(P.postings(docs), "2026-10-01 02:00:00")
    b = S.build_silver(P.postings(docs.repartition(5).orderBy(F.rand(3))), "2026-10-01 02:00:00")

    def rows(df):
        return sorted(tuple(str(v) for v in r) for r in df.collect())

    assert rows(a) == rows(b)
    g1, g2 = star.build_gold(a), star.build_gold(b)
    for name in ("dim_company", "dim_location", "dim_taxonomy", "fact_job_postings"):
        assert rows(g1[name]) == rows(g2[name]), name


def test_capture_stream_state_store(spark, tmp_dir):
    from vacanta.streaming.capture import capture_stream_state

    src = tmp_dir + "/incoming"
    rows = [(k, i, i % 4 != 0) for i, k in enumerate(["a", "b", "a", "c", "d", "b", "e", "a", "f", "c"])]
    df = spark.createDataFrame(rows, "key string, pos int, keep boolean")
    for part in range(3):
        df.filter(F.col("pos") % 3 == part).coalesce(1).write.mode("append").parquet(src)
    sink = tmp_dir + "/captured"
    q = capture_stream_state(spark, src, df.schema, sink, ["key"], keep=lambda: F.col("keep"),
                             max_files_per_trigger=1)
    q.awaitTermination()
    keys = sorted(r.key for r in spark.read.parquet(sink).collect())
    assert keys == sorted({k for k, i, keep in rows if keep})      # each kept key exactly once


def test_history_equals_sequential_landed_runs(spark, tmp_dir):
    import random

    rnd = random.Random(5)
    rows = [(f"k{rnd.randint(0, 14)}", i, rnd.random() < 0.7, rnd.randint(1, 4)) for i in range(120)]
    df = spark.createDataFrame(rows, "key string, pos int, keep boolean, batch int")
    root = tmp_dir + "/landed"
    for b in range(1, 5):
        capture.capture_batch(spark, df.filter(F.col("batch") == b), root, str(b), ["key"], [F.col("pos")],
                              keep=F.col("keep"))
    landed = sorted((r.key, r.pos) for r in spark.read.parquet(root).select("key", "pos").collect())
    history = capture.first_capture_history(df, ["key"], "batch", [F.col("pos")], keep=F.col("keep"))
    assert landed == sorted((r.key, r.pos) for r in history.collect())


def test_capture_with_compact_state_equals_full_history(spark, tmp_dir):
    root, state = tmp_dir + "/landed", tmp_dir + "/state"
    b1 = _events(spark, [("a", 1, True), ("b", 2, True)])
    b2 = _events(spark, [("c", 3, True), ("a", 4, True)])
    b3 = _events(spark, [("a", 5, True), ("c", 6, True), ("d", 7, True)])
    b4 = _events(spark, [("d", 8, True), ("e", 9, True), ("b", 10, True)])
    capture.capture_batch(spark, b1, root, "1", ["key"], [F.col("pos")])
    capture.capture_batch(spark, b2, root, "2", ["key"], [F.col("pos")])
    capture.compact_state(spark, root, ["key"], state)                     # covers batches 1-2
    out3 = capture.capture_batch(spark, b3, root, "3", ["key"], [F.col("pos")], state_path=state)
    out4 = capture.capture_batch(spark, b4, root, "4", ["key"], [F.col("pos")], state_path=state)
    assert [r.key for r in out3.collect()] == ["d"]                       # a, c seen in the compact copy
    assert [r.key for r in out4.collect()] == ["e"]                       # d seen in batch 3 (after it)
    again = capture.capture_batch(spark, b2, root, "2", ["key"], [F.col("pos")], state_path=state)
    assert sorted(r.key for r in again.collect()) == ["c"]               # replay of a compacted batch


def test_state_covers_batches_by_id_not_by_order(spark, tmp_dir):
    root, state = tmp_dir + "/landed", tmp_dir + "/state"
    run = lambda b, *rows: [r.key for r in capture.capture_batch(spark, _events(spark, [(k, i, True) for i, k in enumerate(rows)]), root, b, ["key"], [F.col("pos")], state_path=state).orderBy("key").collect()]
    assert run("b9", "a") == ["a"] and run("b10", "a", "b") == ["b"]
    capture.compact_state(spark, root, ["key"], state)
    assert run("b11", "c") == ["c"] and run("b12", "c", "a", "b", "d") == ["d"]
    assert run("007", "e") == ["e"] and run("7", "e", "f") == ["f"]               # ids stay text
    assert run("run-2", "f", "g") == ["g"]


def test_empty_rerun_clears_its_own_batch_and_broken_state_fails(spark, tmp_dir):
    root = tmp_dir + "/landed"
    one, none = _events(spark, [("a", 1, True)]), _events(spark, [("a", 1, False)])
    assert capture.capture_batch(spark, one, root, "1", ["key"], [F.col("pos")], keep=F.col("keep")).count() == 1
    assert capture.capture_batch(spark, none, root, "1", ["key"], [F.col("pos")], keep=F.col("keep")).count() == 0
    assert capture.capture_batch(spark, one, root, "2", ["key"], [F.col("pos")], keep=F.col("keep")).count() == 1
    with pytest.raises(ValueError):
        capture.land_batch(one, root, "../x")
    with open(tmp_dir + "/broken", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        capture.seen_keys(spark, tmp_dir + "/broken", ["key"]).collect()


def test_null_keys_are_rejected_not_collapsed(spark):
    df = spark.createDataFrame([(None, 1, True), (None, 2, True), ("a", 3, True)], "key string, pos int, keep boolean")
    assert [r.key for r in capture.capture_new(df, None, ["key"], [F.col("pos")]).collect()] == ["a"]
    assert capture.null_key_rejects(df, ["key"]).count() == 2


def test_rejected_rows_are_filtered_before_the_window(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("key"), F.col("id").alias("pos"), (F.col("id") % 2 == 0).alias("keep"))
    plan = capture.capture_new(df, None, ["key"], [F.col("pos")], keep=F.col("keep"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Filter (((id") if "Filter (((id" in plan else "Filter" in plan.split("Window")[-1]
