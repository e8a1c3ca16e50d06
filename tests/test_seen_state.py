"""The versioned, bucketed state of seen keys: crashes, replays, merges, plans."""

import random

import pytest
from pyspark.sql import functions as F

from vacanta.operators import capture, seen_state
from vacanta.sources import versions


def events(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, pos int")


def run(spark, root, state, batch, *keys):
    out = capture.capture_batch(spark, events(spark, keys), root, batch, ["key"], [F.col("pos")], state_path=state)
    return sorted(r.key for r in out.collect())


def compact(spark, root, state, **kw):
    return capture.compact_state(spark, root, ["key"], state, **kw)


class Killed(RuntimeError):
    pass


#: The steps of a compaction: what is replaced by a crash, and whether the step itself still happens.
STEPS = [("write_run", False), ("write_run", True), ("write_bucketed", False), ("write_bucketed", True), ("publish", False), ("_merge_levels", False)]


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("step,happens", STEPS)
def test_a_killed_compaction_loses_no_key(spark, tmp_dir, monkeypatch, step, happens, first):
    root, state = tmp_dir + "/landed", tmp_dir + "/state"
    assert run(spark, root, state, "1", "a", "b") == ["a", "b"]
    if not first:
        compact(spark, root, state)
    assert run(spark, root, state, "2", "b", "c") == ["c"]
    owner = versions if step == "publish" else seen_state
    real = getattr(owner, step)

    def dies(*args, **kw):
        if happens:
            real(*args, **kw)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(owner, step, dies)
        with pytest.raises(Killed):
            compact(spark, root, state)
    assert run(spark, root, state, "3", "a", "b", "c", "d") == ["d"]
    compact(spark, root, state)
    assert run(spark, root, state, "4", "a", "b", "c", "d") == []
    assert {r.key: r.first_batch_id for r in seen_state.open_state(spark, state).table().collect()} == {"a": "1", "b": "1", "c": "2", "d": "3"}


def test_a_draft_manifest_is_no_version(spark, tmp_dir):
    import os

    root, state = tmp_dir + "/landed", tmp_dir + "/state"
    run(spark, root, state, "1", "a")
    compact(spark, root, state)
    with open(f"{state}/manifests/_000000000002.json.x", "w") as f:
        f.write("{half")
    assert versions.read_manifest(spark, state).version == 1
    with open(f"{state}/manifests/000000000002.json", "w") as f:
        f.write("{half")
    with pytest.raises(ValueError):  # an unreadable state isn't an empty one
        run(spark, root, state, "2", "a")
    os.remove(f"{state}/manifests/000000000002.json")


def test_only_one_of_two_writers_publishes(spark, tmp_dir):
    base = versions.publish(spark, tmp_dir, None, {"a": 1})
    assert versions.publish(spark, tmp_dir, base, {"a": 2}).version == 2
    with pytest.raises(versions.ConcurrentPublish):
        versions.publish(spark, tmp_dir, base, {"a": 3})
    assert versions.read_manifest(spark, tmp_dir).content == {"a": 2}
    assert versions.read_manifest(spark, tmp_dir, 1).content == {"a": 1}


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_runs_equal_the_history(spark, tmp_dir, seed):
    rnd = random.Random(seed)
    root, state, plain, seen = tmp_dir + "/landed", tmp_dir + "/state", tmp_dir + "/plain", {}
    for b in range(9):
        keys = [f"k{rnd.randint(0, 30)}" for _ in range(rnd.randint(0, 8))]
        new = sorted({k for k in keys if k not in seen})
        assert run(spark, root, state, str(b), *keys) == new == run(spark, plain, None, str(b), *keys)
        seen |= {k: str(b) for k in new}
        if rnd.random() < 0.8:
            compact(spark, root, state, fanout=2)
    compact(spark, root, state, fanout=2)
    now = seen_state.open_state(spark, state)
    assert {r.key: r.first_batch_id for r in now.table().collect()} == seen
    assert sorted(r.batch_id for r in now.covered().collect()) == sorted(map(str, range(9)))
    assert len(now.runs) <= 4 and len({r["level"] for r in now.runs}) == len(now.runs)  # one run a level
    gone = versions.vacuum(spark, state, keep=1)
    assert gone and {r.key: r.first_batch_id for r in seen_state.open_state(spark, state).table().collect()} == seen


def test_a_compaction_reads_new_batches_only(spark, tmp_dir, monkeypatch):
    root, state, read = tmp_dir + "/landed", tmp_dir + "/state", []
    real = seen_state.read_landed
    monkeypatch.setattr(seen_state, "read_landed", lambda s, r, ids: read.append(list(ids)) or real(s, r, ids))
    for b in "1", "2", "3":
        run(spark, root, None, b, b)
        compact(spark, root, state)
    assert read == [["1"], ["2"], ["3"]]
    assert compact(spark, root, state).count() == 3 and len(read) == 3  # nothing new: nothing read, nothing published
    assert versions.versions(spark, state) == [1, 2, 3]


def test_the_state_is_joined_without_an_exchange(spark, tmp_dir):
    root, state = tmp_dir + "/landed", tmp_dir + "/state"
    for b in "1", "2":
        run(spark, root, None, b, *[f"{b}-{k}" for k in range(50)])
        compact(spark, root, state)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = capture.seen_keys(spark, root, ["key"], state_path=state)
        plan = capture.capture_new(events(spark, ["x"] * 5), seen, ["key"], [F.col("pos")])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Bucketed: true") == 2
    assert plan.count("Exchange") == 1 and "WindowGroupLimit" in plan.split("Exchange")[1]  # only the candidates move


def test_batches_without_rows(spark, tmp_dir):
    root, state = tmp_dir + "/landed", tmp_dir + "/state"
    assert compact(spark, root, state) is None  # nothing was ever landed
    assert run(spark, root, state, "0") == [] and compact(spark, root, state).count() == 0  # covered, without a key
    assert run(spark, root, state, "1", "a") == ["a"]
    compact(spark, root, state)
    assert run(spark, root, state, "2") == []
    assert compact(spark, root, state).count() == 1 and seen_state.uncovered_ids(spark, root, seen_state.open_state(spark, state)) == []
    with pytest.raises(ValueError):
        run(spark, root, state, "3", "b")
        capture.compact_state(spark, root, ["pos"], state)


def test_runs_that_share_keys_merge_to_one_row(spark, tmp_dir):
    root, state = tmp_dir + "/landed", tmp_dir + "/state"
    keys = [f"k{i}" for i in range(200)]
    for b in "2", "1":
        capture.land_batch(events(spark, keys), root, b)
        compact(spark, root, state)
    rows = seen_state.open_state(spark, state).table().collect()
    assert sorted(r.key for r in rows) == sorted(keys) and {r.first_batch_id for r in rows} == {"1"}
    assert run(spark, root, state, "3", *keys, "new") == ["new"]
