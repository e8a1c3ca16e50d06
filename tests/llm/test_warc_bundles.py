import io

import pytest
import zstandard
from pyspark.sql import functions as F

from vacanta.llm import warc_bundles as W
from vacanta.session import scratch_path

PAGES = "page_id long, url string, html string"


def archived(spark, rows, rules=W.BundleRules(), schema=PAGES):
    folder = scratch_path(spark, "warc-test")
    W.write_bundles(rows if not isinstance(rows, list) else spark.createDataFrame(rows, schema), folder, rules)
    return folder, sorted((tuple(r) for r in W.read_bundles(spark, folder).collect()), key=repr)


def expected(rows, least=0):
    """Page by page: what stands first among equal payloads is the response."""
    import hashlib

    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    seen, out = {}, []
    for page, url, html in sorted(rows, key=key):
        data = (html or "").encode()
        name = None if page is None else str(page)
        first = seen.setdefault(data, (name,)) if len(data) >= least else None
        if first is None or first == (name,) and data not in [x[-1] for x in out]:
            out.append((name, len(data), W.digest(hashlib.sha1(data).digest()), "response", None, data))
        else:
            out.append((name, len(data), W.digest(hashlib.sha1(data).digest()), "revisit", first[0], data))
    return sorted((x[:-1] for x in out), key=repr)


EDGE = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (2, "http://a/0", "<p>é</p>"), (3, None, None), (4, "http://a/4", ""), (5, "http://a/5", "x" * 3_000_000), (6, "http://a/6\r\nWARC-Type: spoof", "q"),
        (7, "http://b", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"), (None, "http://n", "no id"), (None, "http://n", "no id"), (None, None, "<p>é</p>"), (8, "http://c", "same"), (8, "http://c", "same"), (8, "http://c", "same"), (0, "http://c", "same")]


@pytest.mark.parametrize("least", [0, 5])
def test_records_of_edge_rows(spark, least):
    rules = W.BundleRules(min_bytes=least, frame_bytes=200, bundle_bytes=400)
    folder, got = archived(spark, EDGE, rules)
    assert got == expected(EDGE, least)
    ids = [r["record_id"] for r in spark.read.parquet(f"{folder}/index").collect()]
    assert len(ids) == len(set(ids)) == len(EDGE)


def test_hot_payload(spark):
    rows = spark.range(6000).select(F.col("id").alias("page_id"), F.lit("http://h").alias("url"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("html"))
    _, got = archived(spark, rows.withColumn("payload", F.lit(1)).withColumn("sha", F.lit("x")).withColumn("n", F.lit(2)))
    hot = [r for r in got if r[1] == 3 and r[2] == W.digest(__import__("hashlib").sha1(b"hot").digest())]
    assert len(got) == 6000 and len(hot) == 2000 and sum(r[3] == "response" for r in hot) == 1 and {r[4] for r in hot} == {None, "0"}


def test_bundles_are_plain_zstandard_and_seekable(spark):
    folder, _ = archived(spark, [(k, f"http://a/{k}", f"page {k} " * (k % 50)) for k in range(500)], W.BundleRules(frame_bytes=4096, bundle_bytes=20_000))
    bundles = spark.read.parquet(f"{folder}/bundles").collect()
    places = {r["record_id"]: r for r in spark.read.parquet(f"{folder}/index").collect()}
    n = 0
    for b in bundles:
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(b["data"]), read_across_frames=True).read()  # the seek table is skipped
        at, table = 0, W.seek_table(b["data"])
        assert sum(p[2] for p in table) == len(whole)
        while at < len(whole):
            headers, _, end = W.parse_record(whole, at)
            place = places[headers["WARC-Record-ID"]]
            start = table[place["frame"]][0]
            assert place["bundle"] == b["bundle"] and start == place["frame_start"]
            alone = zstandard.ZstdDecompressor().decompressobj().decompress(b["data"][start:])  # that frame only
            assert alone[place["offset"]:place["offset"] + place["length"]] == whole[at:end]
            at, n = end, n + 1
    assert n == 500 == len(places)


def test_fetch_by_identifier(spark):
    rows = [(k, f"http://a/{k}", f"page {k}") for k in range(300)]
    folder, _ = archived(spark, rows, W.BundleRules(frame_bytes=1000, bundle_bytes=2000))
    ids = spark.read.parquet(f"{folder}/index").filter(F.col("record_id").rlike(":=(7|70|299):")).select("record_id")
    got = {W.page_of(r["record_id"]): W.parse_record(bytes(r["record"]), 0)[1].split(b"\r\n\r\n")[1] for r in W.fetch(spark, folder, ids.unionByName(ids)).collect()}
    assert got == {k: f"page {k}".encode() for k in ("7", "70", "299")}
    assert W.fetch(spark, folder, ids.limit(0)).count() == 0


def test_damage_is_found(spark):
    bundle = W.Bundle(W.BundleRules())
    bundle.add("<urn:page:=1:t:0>", W.warc_record("<urn:page:=1:t:0>", "http://a", 3, b"\0" * 20, b"abc", None, "d"))
    data, _ = bundle.close()
    with pytest.raises(ValueError):
        [W.described(*r) for r in W.records_of(data)]
    with pytest.raises(ValueError):
        W.seek_table(data[:-1])


def test_empty_table(spark):
    _, got = archived(spark, [])
    assert got == []
