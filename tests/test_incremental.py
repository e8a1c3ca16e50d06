"""Silver by increments against a rebuild; audit before publish; keys that stay."""

import random

import pytest
from pyspark.sql import functions as F

from vacanta.operators import key_registry, quality, star
from vacanta.plans import daily, incremental as I
from vacanta.plans import silver as S
from vacanta.sources import batches as B
from vacanta.sources import versions as V

TS = "2024-06-01 02:00:00"


def land(spark, root, day, posts):
    """``posts``: (url, title, company, date)."""
    rows = [("rekrute_scraper", ("rekrute_scraper", url, title, company, "stage 6 mois", "", None, "Maroc", date,
                                 ["DATA_ENGINEERING_PLATFORMS"], ["data engineer"], (True, "STAGE", None, None, "SUR_SITE")), True) for url, title, company, date in posts]
    df = spark.createDataFrame(rows, f"source string, record {B.PAGE_RECORD.simpleString()}, is_internship boolean")
    B.write_envelopes(df, root + "/bronze", F.lit(f"2024-06-{day:02d} 02:00:00").cast("timestamp"))


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*S.SILVER_COLUMNS).collect())


def rebuilt(spark, root):
    unified, _, _ = B.read_batches(spark, root + "/bronze")
    return rows(S.build_silver(unified, TS))


def step(spark, root):
    return I.increment(spark, root + "/bronze", root + "/silver", "2024-12-01", TS)


def test_deltas_equal_a_rebuild_and_write_touched_partitions_only(spark, tmp_dir):
    rnd, n = random.Random(3), 0
    for day in range(1, 5):
        posts = []
        for _ in range(12):
            n += 1
            date = rnd.choice([None, "2024-01-02T00:00:00Z", "2024-02-02T00:00:00Z", "2024-03-03T00:00:00Z", "bad"])
            posts.append((f"https://x/{n}", f"Title {rnd.randint(0, 8)}", f"C{rnd.randint(0, 2)}", date))
        land(spark, tmp_dir, day, posts)
        before = V.read_manifest(spark, tmp_dir + "/silver")
        staged = I.stage(spark, tmp_dir + "/bronze", tmp_dir + "/silver", TS)
        V.publish(spark, tmp_dir + "/silver", staged.base, staged.content)
        assert rows(I.read_silver(spark, tmp_dir + "/silver")) == rebuilt(spark, tmp_dir)
        if before:
            same = [p for p in before.content["parts"] if p not in staged.touched]
            assert all(staged.content["parts"][p] == before.content["parts"][p] for p in same)
    report = {r.partition: r.rows for r in I.partition_report(spark, tmp_dir + "/silver").collect()}
    assert sum(report.values()) == I.read_silver(spark, tmp_dir + "/silver").count()
    assert I.stage(spark, tmp_dir + "/bronze", tmp_dir + "/silver", TS) is None  # nothing new
    V.vacuum(spark, tmp_dir + "/silver", keep=1)
    assert rows(I.read_silver(spark, tmp_dir + "/silver")) == rebuilt(spark, tmp_dir)


def test_a_late_date_moves_a_survivor_between_partitions(spark, tmp_dir):
    land(spark, tmp_dir, 1, [("u1", "Only one", "C", "2024-01-05T00:00:00Z"), ("u2", "Other", "C", "2024-02-05T00:00:00Z")])
    step(spark, tmp_dir)
    land(spark, tmp_dir, 2, [("u3", "Only one", "C", "2024-03-05T00:00:00Z"), ("u4", "Other", "C", "2024-01-01T00:00:00Z")])
    staged = I.stage(spark, tmp_dir + "/bronze", tmp_dir + "/silver", TS)
    assert staged.touched == ["year=2024/month=1", "year=2024/month=3"] and "year=2024/month=1" not in staged.content["parts"]  # it lost its last row
    V.publish(spark, tmp_dir + "/silver", staged.base, staged.content)
    got = {r.job_title_clean: (r.source_job_id, r.month) for r in I.read_silver(spark, tmp_dir + "/silver").collect()}
    assert got == {"only one": ("u3", 3), "other": ("u2", 2)} and rows(I.read_silver(spark, tmp_dir + "/silver")) == rebuilt(spark, tmp_dir)


def test_blocked_versions_stay_invisible(spark, tmp_dir):
    land(spark, tmp_dir, 1, [("u1", "One", "C", None)])
    step(spark, tmp_dir)
    before = rows(I.read_silver(spark, tmp_dir + "/silver"))
    land(spark, tmp_dir, 2, [(None, "Two", "C", None), ("u3", "Three", "C", None)])
    with pytest.raises(quality.QualityGateError, match="key_completeness=1"):
        step(spark, tmp_dir)
    assert rows(I.read_silver(spark, tmp_dir + "/silver")) == before and V.versions(spark, tmp_dir + "/silver") == [1]
    land(spark, tmp_dir, 2, [("u2", "Two", "C", None), ("u3", "Three", "C", None)])
    assert all(r.passed for r in step(spark, tmp_dir).collect())
    assert rows(I.read_silver(spark, tmp_dir + "/silver")) == rebuilt(spark, tmp_dir) and I.read_silver(spark, tmp_dir + "/silver").count() == 3


@pytest.mark.parametrize("owner,name", [(I, "write_layer"), (I, "partition_numbers"), (I, "audit"), (V, "publish")])
def test_a_killed_run_changes_nothing(spark, tmp_dir, monkeypatch, owner, name):
    land(spark, tmp_dir, 1, [("u1", "One", "C", None)])
    step(spark, tmp_dir)
    land(spark, tmp_dir, 2, [("u2", "Two", "C", "2024-01-05T00:00:00Z"), ("u3", "One", "C", "2024-01-05T00:00:00Z")])

    def dies(*args, **kw):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(owner, name, dies)
        with pytest.raises(KeyboardInterrupt):
            step(spark, tmp_dir)
    assert I.read_silver(spark, tmp_dir + "/silver").count() == 1
    step(spark, tmp_dir)
    assert rows(I.read_silver(spark, tmp_dir + "/silver")) == rebuilt(spark, tmp_dir)


def test_audit_equals_the_checks_on_the_table(spark, tmp_dir):
    for day, posts in ((1, [("u1", "One", "C", "2024-05-05T00:00:00Z"), (None, "Two", "C", "2024-01-05T00:00:00Z")]), (2, [(None, "Three", "C", "2025-01-05T00:00:00Z"), ("u1", "One", "D", None)])):
        land(spark, tmp_dir, day, posts)
        staged = I.stage(spark, tmp_dir + "/bronze", tmp_dir + "/silver", TS)
        table = I._read_parts(spark, tmp_dir + "/silver", staged.content)
        for as_of in ("2023-01-01", "2024-05-05", "2024-05-06", "2030-01-01"):
            assert sorted(map(tuple, I.audit(spark, tmp_dir + "/silver", staged, as_of).collect())) == sorted(map(tuple, quality.run_checks(table, as_of).collect()))
        V.publish(spark, tmp_dir + "/silver", staged.base, staged.content)


def test_daily_run_by_increments(spark, tmp_dir):
    paths = (tmp_dir + "/bronze", tmp_dir + "/silver", tmp_dir + "/gold", tmp_dir + "/keys")
    land(spark, tmp_dir, 1, [("u1", "One", "M", None), ("u2", "Two", "Z", None)])
    I.run_incremental(spark, *paths, TS, "2024-12-01")
    ids = {r.company_name: r.company_id for r in spark.read.parquet(paths[2] + "/dim_company").collect()}
    land(spark, tmp_dir, 2, [("u3", "Three", "A", None)])
    out = I.run_incremental(spark, *paths, TS, "2024-12-01")
    later = {r.company_name: r.company_id for r in spark.read.parquet(paths[2] + "/dim_company").collect()}
    assert ids == {"M": 1, "Z": 2} and later == {"M": 1, "Z": 2, "A": 3}
    assert {r.table: r.rows for r in out["gold"].collect()}["fact_job_postings"] == 3
    facts = {r.job_title: r.company_id for r in spark.read.parquet(paths[2] + "/fact_job_postings").collect()}
    assert facts == {"one": 1, "two": 2, "three": 3}
    assert I.run_incremental(spark, *paths, TS, "2024-12-01") == {"quality": None, "gold": None}


def test_registry_keeps_keys_through_crashes(spark, tmp_dir, monkeypatch):
    members = lambda *names: spark.createDataFrame([(n,) for n in names], "name string")
    got = lambda df: {r["name"]: r["id"] for r in df.collect()}
    assert got(key_registry.extend(members("m", None, "z", "m"), tmp_dir, ["name"], "id")) == {None: 1, "m": 2, "z": 3}
    with monkeypatch.context() as m:
        m.setattr(V, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            key_registry.extend(members("a", "b"), tmp_dir, ["name"], "id")
    assert got(key_registry.read(spark, tmp_dir)) == {None: 1, "m": 2, "z": 3}
    assert got(key_registry.extend(members("z", "b", None), tmp_dir, ["name"], "id")) == {None: 1, "m": 2, "z": 3, "b": 4}
    assert V.versions(spark, tmp_dir) == [1, 2]
    assert got(key_registry.extend(members("z"), tmp_dir, ["name"], "id")) == {None: 1, "m": 2, "z": 3, "b": 4} and V.versions(spark, tmp_dir) == [1, 2]
    monkeypatch.setattr(key_registry, "FOLDERS", 3)
    assert got(key_registry.extend(members("c", "a"), tmp_dir, ["name"], "id")) == {None: 1, "m": 2, "z": 3, "b": 4, "a": 5, "c": 6}
    assert len(V.read_manifest(spark, tmp_dir).content["folders"]) == 1


def test_registered_dimensions_of_an_empty_first_day(spark, tmp_dir):
    land(spark, tmp_dir, 1, [("u1", "One", "M", None)])
    unified, _, _ = B.read_batches(spark, tmp_dir + "/bronze")
    silver = S.build_silver(unified, TS)
    none = star.registered_dimensions(silver.limit(0), tmp_dir + "/keys")
    assert none["dim_company"].count() == 0
    assert [r.company_id for r in star.registered_dimensions(silver, tmp_dir + "/keys")["dim_company"].collect()] == [1]


def test_command_line(spark, tmp_dir, monkeypatch):
    raw = spark.createDataFrame([("rekrute_scraper", "u1", "Data engineer", "stage 6 mois", "stage", "C", None, None, "2024-05-30T00:00:00Z")],
                                "source string, source_job_id string, raw_title string, raw_description string, raw_contract string, company string, location_country string, city string, created string")
    raw.write.parquet(tmp_dir + "/cand")
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    args = ["--bronze", tmp_dir + "/bronze", "--silver", tmp_dir + "/silver", "--gold", tmp_dir + "/gold", "--incremental", "--run-ts", TS, "--candidates", tmp_dir + "/cand", "--state", tmp_dir + "/state"]
    assert daily.main([*args, "--run-id", "d1"]) == 0 and daily.main([*args, "--run-id", "d2"]) == 0
    assert I.read_silver(spark, tmp_dir + "/silver").count() == 1 and len(V.versions(spark, tmp_dir + "/silver")) == 1


def test_a_staged_and_audited_version_is_not_made_again(spark, tmp_dir, monkeypatch):
    land(spark, tmp_dir, 1, [("u1", "One", "C", None)])
    staged = I.stage(spark, tmp_dir + "/bronze", tmp_dir + "/silver", TS)
    report = I.audit(spark, tmp_dir + "/silver", staged, "2024-12-01")
    with monkeypatch.context() as m:
        m.setattr(I, "stage", None)
        m.setattr(I, "audit", None)
        got = I.increment(spark, tmp_dir + "/bronze", tmp_dir + "/silver", "2024-12-01", TS, staged=staged, report=report)
    assert got.count() == 5 and rows(I.read_silver(spark, tmp_dir + "/silver")) == rebuilt(spark, tmp_dir)
    land(spark, tmp_dir, 2, [(None, "Two", "C", None)])
    bad = I.stage(spark, tmp_dir + "/bronze", tmp_dir + "/silver", TS)
    with pytest.raises(quality.QualityGateError, match="key_completeness=1"):
        I.increment(spark, tmp_dir + "/bronze", tmp_dir + "/silver", "2024-12-01", TS, staged=bad, report=I.audit(spark, tmp_dir + "/silver", bad, "2024-12-01"))
    assert V.versions(spark, tmp_dir + "/silver") == [1]
    land(spark, tmp_dir, 3, [("u3", "Three", "C", None)])
    with pytest.raises(V.ConcurrentPublish):  # the version it was staged on is no longer the newest
        I.increment(spark, tmp_dir + "/bronze", tmp_dir + "/silver", "2024-12-01", TS, staged=staged, report=report)
