"""Near-duplicate groups by SuperMinHash.

Signature: every element runs one random permutation of the slots (Fisher-Yates driven by
its hash); in round k it offers k plus a random fraction to the k-th slot of its
permutation, and a slot keeps the least offer. A document stops as soon as no later round
can lower any slot. Bands of the signature give buckets.

Grouping: equal sets are one node. In each bucket the member that shares the most bucket
places with others is the hub; all members are checked against it on their full sets and
linked, and components follow. Pairs of one bucket that still lie in two components are
decided without forming them all: members of a hub's buckets are known by their edits, the
symmetric difference with the hub's set. Two sets differ by the symmetric difference of their
edits, so a link between a member x that isn't linked to the hub and any member y needs
many common edits: more than half of y's, and x's excess over the limit. By the prefix
principle such a pair shares an edit among the first few of either in a common order;
elements that the hub lacks come first, as they are rare. Of the pairs that share one, the join
itself drops those whose edits differ in more places of a parity bitmap than linked sets
may differ in elements (a lower bound that is exact, whatever the hashing). What is left is
checked on the full sets, all others cannot link. So a large group of near copies costs one
check each, not one for every pair, and no candidate link between components is lost. With 32
bands of 5 rows a pair of similarity 0.8 meets in no bucket with probability 3e-6.

Edge cases: null and empty texts have no shingles and stay alone; texts shorter than a
shingle are one shingle of their own length; rows with one doc_id are nodes by their texts;
rows without doc_id group like others but never name a component that has an id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_chunks, stored, text_bytes
from .components import components, joined_components

GOLDEN, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
NO_ID = -(1 << 63)
PARITY_BITS = 1024


@dataclass(frozen=True)
class NearRules:
    words: int = 4  #: per shingle
    percent: int = 80  #: of the union that the intersection must reach
    bands: int = 32
    rows: int = 5  #: signature slots per band
    block: int = 20_000  #: elements in work at a time
    chunk_bytes: int = 2 << 20  #: text in work at a time

    @property
    def slots(self) -> int:
        return self.bands * self.rows


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(h))
    out = np.full(len(h) - span + 1, span, np.uint64)
    for j in range(span):
        out = mix(out * GOLDEN + h[j: len(h) - span + 1 + j])
    return np.unique(out)


def words_of(raw: bytes) -> list[bytes]:
    """ASCII letters lower-cased, cut at ASCII white space (the methods of bytes do exactly that)."""
    return raw.lower().split()


def super_min_hash(sets: list[np.ndarray], slots: int, block: int = 40_000) -> np.ndarray:
    """One row of slot values (round in the high half, fraction in the low half) per set; empty sets have none set."""
    unset = np.uint64(0xFFFFFFFFFFFFFFFF)
    sig = np.full((len(sets), slots), unset)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    first = np.arange(slots, dtype=np.uint16)
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for at in range(0, len(elements), block):
        e, doc = elements[at:at + block], owner[at:at + block]
        low = doc[0]
        own = sig[low:doc[-1] + 1]
        flat = own.reshape(-1)
        perm = np.tile(first, len(e)).reshape(len(e), slots)
        row = np.arange(len(e))
        base = (doc - low) * slots
        for k in range(slots):
            if k:  # a document goes on while an offer of this round could still win
                open_ = (own.max(1) >> np.uint64(32)) >= np.uint64(k)
                row = row[open_[doc[row] - low]]
                if not len(row):
                    break
            x = mix(e[row] + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF))
            j = k + (((x >> np.uint64(32)) * np.uint64(slots - k)) >> np.uint64(32)).astype(np.int64)
            slot = perm[row, j]
            perm[row, j] = perm[row, k]
            np.minimum.at(flat, base[row] + slot, (np.uint64(k) << np.uint64(32)) | (x & np.uint64(0xFFFFFFFF)))
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit bucket per band; the band's number is part of it."""
    parts = sig.reshape(len(sig), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)) * MIX2
    for r in range(rows):
        out = mix(out * GOLDEN + parts[:, :, r])
    return out


def signatures(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """(doc_id, n_shingles, node, buckets): node is the digest of the set, null for no shingles."""
    def run(part):
        sets = [shingles(words_of(raw), rules.words) for raw in part.column("text").to_pylist()]
        keys = band_keys(super_min_hash(sets, rules.slots, rules.block), rules.bands, rules.rows).view(np.int64)
        return {"n_shingles": [len(s) for s in sets], "node": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "buckets": [k.tolist() if len(s) else [] for k, s in zip(keys, sets)]}

    return map_chunks(text_bytes(docs, "doc_id"), "n_shingles long, node binary, buckets array<long>", run, limit=rules.chunk_bytes)


def full_sets(docs: DataFrame, wanted: DataFrame, rules: NearRules) -> DataFrame:
    """(node, elements) of the nodes in ``wanted`` (node, id), read again from their texts."""
    def run(part):
        sets = [shingles(words_of(raw), rules.words) for raw in part.column("text").to_pylist()]
        return {"found": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], "elements": [s.tobytes() for s in sets]}

    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text").join(wanted, "id")
    made = map_chunks(text_bytes(texts, "node"), "found binary, elements binary", run, carry="node", limit=rules.chunk_bytes)
    return made.filter("found = node").select("node", "elements")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity; each set travels once per pair."""
    def run(part):
        out = []
        for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            small, large = (x, y) if len(x) < len(y) else (y, x)
            near = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[near] == small).sum())
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return {"linked": out, "a": part.column("a"), "b": part.column("b")}

    rows = with_sets(pairs, sets).select("a", "b", "x", "y")
    return map_chunks(rows, "linked boolean, a binary, b binary", run, carry=None, sized="y").filter("linked").select("a", "b").distinct()


def edits(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, node, elements, short, long, parity) for pairs (a: a hub, b, node: carried): the first edits
    of b against a, and the parity of the number of all its edits in each of 1024 places. ``short`` of them suffice to meet any member that isn't linked to the hub, ``long``
    (0 if b is linked to it) to meet any member at all."""
    limit = (100 - percent) / (100 + percent)  # of two sets' sizes, that linked sets differ by at most

    def run(part):
        elements, short, long, parity = [], [], [], []
        for hub, own in zip(part.column("x").to_pylist(), part.column("y").to_pylist()):
            hub, own = np.frombuffer(hub, np.uint64), np.frombuffer(own, np.uint64)
            added, removed = np.setdiff1d(own, hub, assume_unique=True), np.setdiff1d(hub, own, assume_unique=True)
            d, excess = len(added) + len(removed), len(added) + len(removed) - limit * (len(hub) + len(own))
            few = d - math.floor((d + limit * (len(hub) - len(own))) / 2 - 1e-9)
            many = d - max(1, math.ceil(excess / 2 - 1e-9)) + 1 if excess > -1e-9 else 0
            elements.append(np.concatenate((added, removed))[:max(few, many)].view(np.int64).tolist())
            short.append(few)
            long.append(many)
            odd = np.bincount(np.concatenate((added, removed)) % np.uint64(PARITY_BITS), minlength=PARITY_BITS) % 2
            parity.append(np.packbits(odd.astype(np.uint8)).view(np.int64).tolist())
        return {"elements": elements, "short": short, "long": long, "parity": parity}

    joined = with_sets(pairs, sets).select(F.struct("a", "node").alias("pair"), "x", "y")
    return map_chunks(joined, "elements array<long>, short int, long int, parity array<long>", run, carry="pair", sized="y").select("pair.*", "elements", "short", "long", "parity")


def with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b, ...) with their elements x and y."""
    joined = pairs.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b")
    return joined.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a")


def near_groups(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    sig = stored(signatures(docs, rules), "signatures")
    nodes = stored(sig.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets")), "nodes")
    places = nodes.select("node", "n", F.explode("buckets").alias("bucket"))
    shared = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(places.join(shared, "bucket"), "members")
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = members.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node", "n")).alias("hub"))
    ratio = F.lit(100) * F.least("n", "m") >= F.lit(rules.percent) * F.greatest("n", "m")
    hubs = hubs.select("bucket", F.col("hub.node").alias("a"), F.col("hub.n").alias("m"))
    members = stored(members.join(hubs, "bucket").filter(F.col("node") != F.col("a")), "members")
    tried = stored(members.filter(ratio).select("a", F.col("node").alias("b")).distinct(), "tried")
    links, sets = checked(docs, nodes, tried, rules)

    first = stored(components(links), "components")
    roots = first.select(F.col("node").alias("a"), F.col("root").alias("hub_root"))
    placed = members.filter("size > 2").join(first, "node", "left").withColumn("root", F.coalesce("root", "node")).join(roots, "a", "left").withColumn("hub_root", F.coalesce("hub_root", "a"))
    split = placed.filter("root <> hub_root").select("bucket").distinct()
    grouped = stored(placed.join(split, "bucket").select("a", "node", "n", "root").distinct(), "open")
    known = sets.select("node").distinct()
    pairs = grouped.select("a", F.col("node").alias("b"), F.struct("node", "n", "root").alias("node"))
    unread = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(known, "node", "left_anti")
    sets = sets.unionByName(read_sets(docs, nodes, unread, rules))
    own = stored(edits(pairs, sets, rules.percent), "edits")
    words = range(PARITY_BITS // 64)
    first_edits = own.select("a", "node", "short", "long", F.posexplode("elements").alias("at", "element"), *[F.get("parity", F.lit(k)).alias(f"p{k}") for k in words])
    x = first_edits.filter("at < long").select("a", "element", "node.node", "node.n", "node.root", *[f"p{k}" for k in words])
    y = first_edits.filter("at < short").select("a", "element", F.col("node.node").alias("b"), F.col("node.n").alias("m"), F.col("node.root").alias("other"), *[F.col(f"p{k}").alias(f"q{k}") for k in words])
    apart = reduce(add, [F.bit_count(F.col(f"p{k}").bitwiseXOR(F.col(f"q{k}"))) for k in words])
    near = F.lit(100 + rules.percent) * apart <= F.lit(100 - rules.percent) * (F.col("n") + F.col("m"))
    rest = x.join(y, ["a", "element"]).filter((F.col("root") != F.col("other")) & ratio & near).select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    more, _ = checked(docs, nodes, stored(rest, "rest"), rules)
    roots = joined_components(first, more)
    named = nodes.select("node", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("id").alias("component_id"))
    of_node = named.join(names, "root").select("node", "component_id")
    out = sig.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def read_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, rules: NearRules) -> DataFrame:
    """Elements of the wanted nodes, written once."""
    named = wanted.join(nodes.select("node", F.coalesce("id", F.lit(NO_ID)).alias("id")), "node")
    return stored(full_sets(docs, named, rules), "sets")


def checked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, rules: NearRules) -> tuple[DataFrame, DataFrame]:
    """The pairs that are links, and the sets read for it."""
    sets = read_sets(docs, nodes, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), rules)
    return stored(confirmed(pairs, sets, rules.percent), "confirmed"), sets
