"""The keyed stream: survivors whatever the file order, expiry, restarts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from vacanta.streaming.keyed import EPOCH, FirstArrival, capture_stream_keyed

SCHEMA = "key string, pos int, at timestamp, keep boolean"
DAY = dt.datetime(2024, 1, 1)


def deliver(spark, path, rows, files=1):
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.mode("append").parquet(path)


def run(spark, src, sink, **kw):
    capture_stream_keyed(spark, src, spark.createDataFrame([], SCHEMA).schema, sink, ["key"], ["pos"], "at", keep=lambda: F.col("keep"), **kw).awaitTermination()
    return sorted((r.key, r.pos) for r in spark.read.schema(SCHEMA).parquet(sink).collect())


def test_first_by_position_in_every_micro_batch(spark, tmp_dir):
    rnd = random.Random(2)
    src, sink, first = tmp_dir + "/in", tmp_dir + "/out", {}
    for delivery in range(3):
        rows = [(rnd.choice([None, "hot", "hot", "hot", *"abcdefgh"]), 100 * delivery + rnd.randint(0, 99), DAY + dt.timedelta(days=delivery) if rnd.random() < 0.9 else None, rnd.random() < 0.7) for _ in range(60)]
        deliver(spark, src, rows, files=4)
        now = {}
        for key, pos, _, keep in rows:
            if keep and key is not None and key not in first:
                now[key] = min(pos, now.get(key, pos))
        first |= now
        assert run(spark, src, sink) == sorted(first.items())


def test_state_expires_with_recency(spark, tmp_dir):
    src, sink = tmp_dir + "/in", tmp_dir + "/out"
    at = lambda days: DAY + dt.timedelta(days=days)
    deliver(spark, src, [("a", 1, at(0), True), ("n", 2, None, True)])
    assert run(spark, src, sink, max_age="10 days") == [("a", 1), ("n", 2)]
    deliver(spark, src, [("b", 3, at(30), True), ("a", 4, at(5), True)])
    assert run(spark, src, sink, max_age="10 days") == [("a", 1), ("b", 3), ("n", 2)]  # known until the watermark passes it
    deliver(spark, src, [("a", 5, at(1), True), ("c", 6, at(31), True), ("n", 7, at(31), True)])
    assert run(spark, src, sink, max_age="10 days") == [("a", 1), ("b", 3), ("c", 6), ("n", 2)]  # too old: late; no time: no expiry
    deliver(spark, src, [("a", 8, at(32), True)])
    assert run(spark, src, sink, max_age="10 days") == [("a", 1), ("a", 8), ("b", 3), ("c", 6), ("n", 2)]  # a new posting under a forgotten key


def test_a_key_costs_its_rows_and_no_frame():
    """The state's side of a key: plain rows in, the first by position out (nulls first), one state value, one timer."""
    from pyspark.sql import Row

    class State:
        value, timers = None, []

        def getValueState(self, name, schema):
            return self

        def exists(self):
            return self.value is not None

        def update(self, value):
            self.value = value

        def registerTimer(self, at):
            self.timers.append(at)

    state, row = State(), Row("key", "pos", "at", "_micros")
    first = FirstArrival(["pos", "_micros"], "at", ["key", "pos", "at"])
    first.init(state)
    rows = [row("a", 2, DAY, 9_000), row("a", None, DAY, 8_000), row("a", None, DAY, 7_000)]
    assert [r.asDict() for r in first.handleInputRows(("a",), iter(rows), None)] == [{"key": "a", "pos": None, "at": 7_000}]
    assert state.timers == [7] and state.value == (EPOCH + dt.timedelta(microseconds=7_000),)
    assert list(first.handleInputRows(("a",), iter(rows), None)) == []
