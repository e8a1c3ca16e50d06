"""Web archives as seekable Zstandard bundles.

Every page becomes one WARC record. Payloads are told apart by their SHA-256; of equal ones
the record of the smallest page id is a ``response`` with the payload, the others are
``revisit`` records that name it. Payloads under ``min_bytes`` are always responses.

A bundle is a multi-frame Zstandard file. Records are packed into frames of about
``frame_bytes``; each frame is compressed alone, so it can be read alone. Behind the frames
stands a skippable frame with the seek table (compressed and plain size of each frame) and its
footer, in the public seekable format: any Zstandard reader sees one WARC file, and a reader of
the footer finds each frame. The index maps a record's identifier to bundle, frame, the frame's
start in the bundle, and the record's place in the plain frame.

Storage: ``<folder>/bundles`` (Parquet, a row per bundle: name and bytes) and
``<folder>/index`` (a row per record, in ranges of the identifier). A bundle is closed at
``bundle_bytes``, so a task holds one bundle and one batch; one larger record is a frame and a
bundle of its own.

Skew: equal payloads meet in a partial aggregate, so a payload that a third of the pages share
costs each task one copy. Only narrow rows (no payload) are joined, and Spark splits their hot keys.

Edge cases: a null html is an empty payload; a null page id is larger than any other and its
record's id says ``null``; of equal page ids the smaller url (null last) comes first; rows equal
in all three are numbered copies, one of them a response at most; a null url leaves its header
out; control characters in urls are percent-encoded; further columns are not archived; an empty
table makes no bundle.
"""

from __future__ import annotations

import hashlib
import struct
from base64 import b32encode
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_code
from .common import stored

# Fixed values of the public formats: the seek table's skippable frame, and the revisit profile.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BUNDLES = "bundle string, n_records long, data binary, records array<struct<record_id:string, frame:int, frame_start:long, offset:long, length:long>>"
ENTRY = pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("frame_start", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
READ = "page string, payload_bytes long, payload_digest string, record_type string, refers_to string"


@dataclass(frozen=True)
class BundleRules:
    min_bytes: int = 0  #: smaller payloads are never revisits
    frame_bytes: int = 256 << 10  #: plain bytes per frame, about
    bundle_bytes: int = 4 << 20  #: compressed bytes per bundle, about
    bundle_records: int = 20_000  #: records per bundle at most
    level: int = 3
    date: str = "1970-01-01T00:00:00Z"  #: WARC-Date of the records: the run's instant


# ----------------------------------------------------------------- records

def record_id(page: str | None, tag: str, copy: int) -> str:
    """Identifier of a record; ``tag`` tells rows with one page id apart, ``copy`` equal rows."""
    return f"<urn:page:{'null' if page is None else quote('=' + page, safe='=')}:{tag}:{copy}>"


def page_of(identifier: str) -> str | None:
    page = identifier.split(":")[2]
    return None if page == "null" else unquote(page[1:])


def digest(sha1: bytes) -> str:
    return b32encode(sha1).decode()


def warc_record(identifier: str, url: str | None, n_bytes: int, sha1: bytes, payload: bytes | None, refers_to: str | None, date: str) -> bytes:
    """A response record with its payload, or (``refers_to``) a revisit record without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    head = [f"WARC/1.1\r\nWARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {identifier}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else quote(c) for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest(sha1)}")
    if refers_to:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload or b'')}"]
    return b"".join(("\r\n".join(head).encode(), b"\r\n\r\n", http, payload or b"", b"\r\n\r\n"))


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """The record that begins at ``at``: its headers, its block, where the next begins."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) for line in lines)
    start = end + 4
    stop = start + int(headers["Content-Length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError("a record must end with two line ends")
    return headers, data[start:stop], stop + 4


def described(headers: dict[str, str], block: bytes) -> tuple[str | None, int, str, str, str | None]:
    """(page, payload bytes, payload digest, type, page referred to) of a parsed record."""
    http, payload = block.split(b"\r\n\r\n", 1)
    page, kind, named = page_of(headers["WARC-Record-ID"]), headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    n = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    if kind == "revisit":
        return page, n, named, kind, page_of(headers["WARC-Refers-To"])
    if (found := digest(hashlib.sha1(payload).digest())) != named or len(payload) != n:
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload doesn't have the digest or length of its header")
    return page, len(payload), found, kind, None


# ----------------------------------------------------------------- bundles

class Bundle:
    """Records packed into frames; ``close`` gives the file and its index entries."""

    def __init__(self, rules: BundleRules):
        self.rules, self.packer = rules, zstandard.ZstdCompressor(level=rules.level, write_checksum=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.entries: list[dict] = []
        self.open: list[bytes] = []
        self.filled = self.size = 0

    def add(self, identifier: str, record: bytes) -> None:
        self.entries.append({"record_id": identifier, "frame": len(self.frames), "frame_start": self.size, "offset": self.filled, "length": len(record)})
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= self.rules.frame_bytes:
            self.end_frame()

    def end_frame(self) -> None:
        if self.open:
            frame = self.packer.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.filled))
            self.size += len(frame)
            self.open, self.filled = [], 0

    def full(self) -> bool:
        return self.size >= self.rules.bundle_bytes or len(self.entries) >= self.rules.bundle_records

    def close(self) -> tuple[bytes, list[dict]]:
        self.end_frame()
        table = b"".join(struct.pack("<II", *pair) for pair in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        return b"".join([*self.frames, struct.pack("<II", SKIPPABLE_MAGIC, len(table)), table]), self.entries


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, read from the end of a bundle."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("no seek table at the end of the bundle")
    at, out = 0, []
    for packed, plain in struct.iter_unpack("<II", data[-9 - 8 * n:-9]):
        out.append((at, packed, plain))
        at += packed
    if struct.unpack_from("<II", data, at) != (SKIPPABLE_MAGIC, 8 * n + 9):
        raise ValueError("the seek table doesn't begin where the frames end")
    return out


def frame(data: bytes, place: tuple[int, int, int]) -> bytes:
    """One frame's plain bytes; no other frame is touched."""
    start, packed, plain = place
    return zstandard.ZstdDecompressor().decompress(data[start:start + packed], max_output_size=plain)


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    for place in seek_table(data):
        plain, at = frame(data, place), 0
        while at < len(plain):
            headers, block, at = parse_record(plain, at)
            yield headers, block


# ----------------------------------------------------------------- tables

def _rows(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return (pages.select(F.col("page_id").alias("page"), "url", payload.alias("payload"))
                 .withColumn("n", F.octet_length("payload").cast("long")).withColumn("sha", F.sha2("payload", 256)))


def _rank(page: Column, url: Column) -> Column:
    """Smallest page id first, then url; nulls last."""
    return F.struct(page.isNull().alias("no_page"), page.alias("page"), url.isNull().alias("no_url"), url.alias("url"))


def _tag(url: Column, sha: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("\n", sha, url), 256), 1, 16)


def warc_rows(pages: DataFrame, rules: BundleRules = BundleRules()) -> DataFrame:
    """A row per page: what its record holds. ``to_page`` and ``to_tag`` name the response that
    a revisit (``again``) refers to; only responses carry a payload."""
    rows, rank = _rows(pages), _rank(F.col("page"), F.col("url"))
    shared = rows.filter(F.col("n") >= rules.min_bytes)
    none = F.lit(None)
    page = rows.schema["page"].dataType
    first = (shared.groupBy("sha").agg(F.min(rank).alias("r"), F.first("n").alias("n"), F.first("payload").alias("payload"))
             .select("r.page", "r.url", "sha", "n", F.unhex(F.sha1("payload")).alias("sha1"), "payload", F.lit(0).cast("long").alias("copy"),
                     F.lit(False).alias("again"), none.cast(page).alias("to_page"), none.cast("string").alias("to_tag")))
    # the revisits: rows of each payload, equal ones counted, less the response; none carries a payload
    narrow = shared.withColumn("sha1", F.unhex(F.sha1("payload"))).groupBy("page", "url", "sha", "n", "sha1").agg(F.count(F.lit(1)).alias("rows"))
    narrow = stored(narrow, "warc-rows")
    repeated = (narrow.groupBy("sha").agg(F.sum("rows").alias("all"), F.min(rank).alias("r")).filter("all > 1")
                .select("sha", F.col("r.page").alias("to_page"), F.col("r.url").alias("to_url")))
    is_first = F.col("page").eqNullSafe(F.col("to_page")) & F.col("url").eqNullSafe(F.col("to_url"))
    revisits = (narrow.join(repeated, "sha").withColumn("at", F.when(is_first, F.lit(1)).otherwise(F.lit(0)).cast("long"))
                .filter("rows > at").withColumn("copy", F.explode(F.sequence("at", F.col("rows") - 1)))
                .select("page", "url", "sha", "n", "sha1", none.cast("binary").alias("payload"), "copy", F.lit(True).alias("again"), "to_page",
                        _tag(F.col("to_url"), F.col("sha")).alias("to_tag")))
    out = first.unionByName(revisits)
    if rules.min_bytes > 0:
        small = rows.filter(F.col("n") < rules.min_bytes).groupBy("page", "url", "sha", "n", "payload").agg(F.count(F.lit(1)).alias("rows"))
        out = out.unionByName(small.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
                              .select("page", "url", "sha", "n", F.unhex(F.sha1("payload")).alias("sha1"), "payload", "copy", F.lit(False).alias("again"),
                                      none.cast(page).alias("to_page"), none.cast("string").alias("to_tag")))
    return out.select(F.col("page").cast("string").alias("page"), "url", _tag(F.col("url"), F.col("sha")).alias("tag"), "copy", "n", "sha1", "payload", "again",
                      F.col("to_page").cast("string").alias("to_page"), "to_tag")


def write_bundles(pages: DataFrame, folder: str, rules: BundleRules = BundleRules()) -> None:
    """Archives all pages under ``folder`` (bundles, then their index)."""
    spark = pages.sparkSession
    ship_code(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle(rules)
        for batch in batches:
            for r in batch.to_pylist():
                identifier = record_id(r["page"], r["tag"], r["copy"])
                to = record_id(r["to_page"], r["to_tag"], 0) if r["again"] else None
                bundle.add(identifier, warc_record(identifier, r["url"], r["n"], r["sha1"], r["payload"], to, rules.date))
                if bundle.full():
                    yield _written(bundle)
                    bundle = Bundle(rules)
        if bundle.entries:
            yield _written(bundle)

    warc_rows(pages, rules).mapInArrow(run, BUNDLES).write.parquet(f"{folder}/bundles")
    places = spark.read.schema(BUNDLES).parquet(f"{folder}/bundles").select("bundle", F.inline("records"))
    places.repartitionByRange("record_id").sortWithinPartitions("record_id").write.parquet(f"{folder}/index")


def _written(bundle: Bundle) -> pa.RecordBatch:
    data, entries = bundle.close()
    name = hashlib.sha256(data).hexdigest()[:32] + ".warc.zst"
    cols = [pa.array([name]), pa.array([len(entries)], pa.int64()), pa.array([data], pa.binary()), pa.array([entries], pa.list_(ENTRY))]
    return pa.RecordBatch.from_arrays(cols, names=["bundle", "n_records", "data", "records"])


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives, read frame by frame: page, payload_bytes, payload_digest
    (computed from a response's payload), record_type, refers_to (the response's page)."""
    ship_code(spark)
    data = spark.read.schema(BUNDLES).parquet(f"{folder}/bundles").select("data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column("data"):
                rows = [described(*record) for record in records_of(cell.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), *[pa.string()] * 3))],
                                                 names=["page", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return data.mapInArrow(run, READ)


def fetch(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(record_id, record) of the ``record_id``s in ``wanted``: the index gives their places, each
    bundle's wanted frames are decompressed, its others are not."""
    ship_code(spark)
    index = spark.read.schema("bundle string, record_id string, frame int, frame_start long, offset long, length long").parquet(f"{folder}/index")
    asked = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    places = asked.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("frame", "offset", "length", "record_id"))).alias("places"))  # at most a bundle's records
    found = spark.read.schema(BUNDLES).parquet(f"{folder}/bundles").select("bundle", "data").join(places, "bundle")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data, at, plain, out = batch.column("data")[row].as_py(), -1, b"", []
                table = seek_table(data)
                for p in batch.column("places")[row].as_py():
                    if p["frame"] != at:
                        at, plain = p["frame"], frame(data, table[p["frame"]])
                    out.append((p["record_id"], plain[p["offset"]:p["offset"] + p["length"]]))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())], names=["record_id", "record"])

    return found.select("data", "places").mapInArrow(run, "record_id string, record binary")
