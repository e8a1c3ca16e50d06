"""Merkle manifest of a dataset, checked by a recursive query.

A leaf is the hash of a row's fields, each as its UTF-8 byte count, a colon and the value (null:
a hyphen). Leaves of one language stand in order of their ids; every two consecutive nodes become
the hash of their hex texts (the last run may be one node) until one node is left, the language's
subroot. The subroots in order of the languages give the root the same way.

Built levels are stored as node rows linked to their parents. Rows are kept for every
``stride``-th level: a row has its hash, its link to the node ``stride`` levels up (less below
a top) and the siblings met on the way there, so a climb takes one join per ``stride`` levels and the
rows above the leaves are 2^-stride of them. The climb is a recursive common table expression
of Spark: it begins at the leaves' rows, joins each leaf with its parent's row, appends that row's
siblings to the leaf's proof, folds the leaf's (perhaps tampered) hash with them, and ends where a row has
no parent. The subroots are the leaves of the upper tree, so the same query climbs both.

Scale: positions come from a range partitioning with per-partition offsets; a block of
2^stride nodes is built in one task; no language, however large, is. In the climb all leaves meet few upper
rows: a sort-merge join whose hot keys Spark splits (the hint keeps the planner, which knows no sizes inside
a recursion, from broadcasting).

Edge cases: null ids come first, equal ids are ordered by their leaves, equal rows are leaves of their own;
a null language is a language of its own, before the others; null fields are hyphens; one row is leaf,
subroot and root at once; further columns aren't hashed; an empty table has no node and no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from ..session import ship_code
from .common import stored

#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels between stored node rows.
STRIDE = 10

NODE = "tree long, level int, idx long, hash string, up_tree long, up_level int, up_idx long, steps array<binary>, top boolean, n long, doc_id {id}, altered string"


def framed(col: Column) -> Column:
    """A value with its length before it (null: a hyphen), so that no two rows read alike."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def doc_leaves(docs: DataFrame, altered: Column | None = None, changed: str = "n_chars") -> DataFrame:
    """(lang, doc_id, hash, altered): each row's leaf, and the leaf it has with ``altered`` in the
    field ``changed`` (null where ``altered`` is)."""
    fields = {f: F.col(f) for f in FIELDS}
    other = F.lit(None).cast("string") if altered is None else F.when(altered.isNotNull(), leaf_hash([altered if f == changed else c for f, c in fields.items()]))
    return docs.select("lang", "doc_id", leaf_hash(list(fields.values())).alias("hash"), other.alias("altered"))


# ----------------------------------------------------------------- levels

def parents(hashes: list[str]) -> list[str]:
    return [hashlib.sha256("".join(hashes[i:i + 2]).encode()).hexdigest() for i in range(0, len(hashes), 2)]


def climb_block(hashes: list[str], levels: int) -> tuple[list[list[bytes]], str]:
    """What each node of a block meets on ``levels`` levels, and the block's top. A step is a
    side (``<`` or ``>``: where the sibling stands) and the sibling's digest, or ``=`` for a lone node."""
    steps: list[list[bytes]] = [[] for _ in hashes]
    for level in range(levels):
        raw = [bytes.fromhex(h) for h in hashes]
        met = [b"=" if (k ^ 1) >= len(raw) else (b"<" if k & 1 else b">") + raw[k ^ 1] for k in range(len(raw))]
        for i, own in enumerate(steps):
            own.append(met[i >> level])
        hashes = parents(hashes)
    return steps, hashes[0]


def _block_rows(level: int, stride: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, n, members in zip(*(batch.column(c) for c in ("tree", "block", "n", "members"))):
                tree, block, n = tree.as_py(), block.as_py(), n.as_py()
                kids = members.values
                hashes, k = kids.field("hash").to_pylist(), len(kids)
                last = n <= 1 << stride  # the block that ends in the tree's top
                steps, top = climb_block(hashes, (n - 1).bit_length() if last else stride)
                if not last:
                    up = (tree, level + 1, block)
                else:
                    up = (0, 0, tree - 1) if tree else (None, None, None)
                node = {"tree": tree, "level": level + 1, "idx": block, "hash": top, "top": True, "n": 0 if last else -(-n >> stride)}
                cols = {"tree": [tree] * k + [tree], "level": [level] * k + [level + 1], "idx": [(block << stride) + i for i in range(k)] + [block], "hash": hashes + [top],
                        "up_tree": [up[0]] * k + [None], "up_level": [up[1]] * k + [None], "up_idx": [up[2]] * k + [None], "steps": steps + [None],
                        "top": [False] * k + [True], "n": [n] * k + [node["n"]], "doc_id": None, "altered": kids.field("altered").to_pylist() + [None]}
                cols["doc_id"] = pa.concat_arrays([kids.field("doc_id").cast(id_type), pa.nulls(1, id_type)])
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.bool_(), pa.int64(), id_type, pa.string())
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols.values(), kinds)], names=list(cols))

    return run


def _built(nodes: DataFrame, largest: int, stride: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Node rows of all stored levels over ``nodes`` (tree, idx, n, hash, doc_id, altered), and the trees' tops."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = nodes.schema["doc_id"].dataType
    schema, arrow = NODE.format(id=kind.simpleString()), to_arrow_type(kind)
    rows, tops, level = [], [], 0
    while True:
        # a block is at most 2^stride nodes
        member = F.struct("idx", "hash", "doc_id", "altered")
        blocks = nodes.groupBy("tree", F.shiftright("idx", stride).alias("block"), "n").agg(F.sort_array(F.collect_list(member)).alias("members"))
        made = stored(blocks.mapInArrow(_block_rows(level, stride, arrow), schema), f"merkle-{level}")
        rows.append(made.filter("not top"))
        tops.append(made.filter("top and n = 0"))
        if largest <= 1 << stride:
            return rows, tops
        nodes, largest, level = made.filter("top and n > 0").select("tree", "idx", "n", "hash", "doc_id", "altered"), -(-largest >> stride), level + 1


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@dataclass
class Manifest:
    """``leaves`` and ``upper``: node rows; ``subroots``: (lang, subroot); ``root``: the hash of it all."""

    leaves: DataFrame
    upper: DataFrame
    subroots: DataFrame
    root: str | None


def build(leaves: DataFrame, stride: int = STRIDE) -> Manifest:
    """The manifest over (lang, doc_id, hash, altered)."""
    spark = leaves.sparkSession
    ship_code(spark)
    # a seeded salt deals equal rows (which may stand in any order) over partitions, too
    placed = dense_key(leaves.withColumn("salt", F.rand(7)), ["lang", "doc_id", "hash", "salt"], "place", distinct=False)
    langs = stored(dense_key(placed.groupBy("lang").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), ["lang"], "tree", distinct=False), "merkle-langs")
    size = langs.agg(F.max("n").alias("largest"), F.count(F.lit(1)).alias("langs")).first()
    if not size["langs"]:
        empty = spark.createDataFrame([], NODE.format(id=leaves.schema["doc_id"].dataType.simpleString()))
        return Manifest(empty, empty, spark.createDataFrame([], "lang string, subroot string"), None)
    named = langs.withColumnRenamed("lang", "of")
    nodes = placed.join(named, placed.lang.eqNullSafe(named.of)).select("tree", (F.col("place") - F.col("first")).alias("idx"), "n", "hash", "doc_id", "altered")
    rows, tops = _built(nodes, size["largest"], stride)
    tops = _all(tops).select("tree", "hash")
    over = tops.select(F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("idx"), F.lit(size["langs"]).cast("long").alias("n"), "hash",
                       F.lit(None).cast(leaves.schema["doc_id"].dataType).alias("doc_id"), F.lit(None).cast("string").alias("altered"))
    upper, top = _built(over, size["langs"], stride)
    subroots = langs.join(tops, "tree").select("lang", F.col("hash").alias("subroot"))
    return Manifest(rows[0], _all([*rows[1:], *upper]), subroots, _all(top).first()["hash"])


# ----------------------------------------------------------------- the climb

PAIR = "CASE WHEN length(s) = 1 THEN acc WHEN substring(s, 1, 1) = cast('<' AS binary) THEN concat(lower(hex(substring(s, 2))), acc) ELSE concat(acc, lower(hex(substring(s, 2)))) END"
FOLD = f"aggregate({{steps}}, {{hash}}, (acc, s) -> sha2({PAIR}, 256))"
MET = "aggregate({steps}, cast('' AS binary), (acc, s) -> concat(acc, substring(s, 2)))"

CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT doc_id, hash AS leaf, {FOLD.format(steps='steps', hash='coalesce(altered, hash)')} AS folded, {MET.format(steps='steps')} AS proof,
    cast(NULL AS string) AS subroot, up_tree, up_level, up_idx
  FROM {{leaves}}
  UNION ALL
  SELECT /*+ MERGE(c, u) */ c.doc_id, c.leaf, {FOLD.format(steps='u.steps', hash='c.folded')}, concat(c.proof, {MET.format(steps='u.steps')}),
    CASE WHEN u.tree = 0 AND u.level = 0 THEN u.hash ELSE c.subroot END, u.up_tree, u.up_level, u.up_idx
  FROM climb c JOIN {{upper}} u ON c.up_tree = u.tree AND c.up_level = u.level AND c.up_idx = u.idx)
SELECT doc_id, leaf, subroot, sha2(lower(hex(proof)), 256) AS proof_sha256, folded FROM climb WHERE up_tree IS NULL"""


def climb(manifest: Manifest) -> DataFrame:
    """Every leaf's way to the root: doc_id, leaf, subroot, root, proof_sha256 (all as built),
    folded_root (the altered leaf, else the leaf, folded with the siblings), verified.

    The rows are written before they are returned: the limit on a recursion's rows is the
    session's, and is lifted only while this query runs."""
    spark = manifest.leaves.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        rows = stored(spark.sql(CLIMB, leaves=manifest.leaves, upper=manifest.upper), "merkle-climb")
    finally:
        spark.conf.set(limit, before)
    root = F.lit(manifest.root).cast("string")
    return rows.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", F.col("folded").alias("folded_root"), (F.col("folded") == root).alias("verified"))
