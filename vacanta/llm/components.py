"""Connected components of link tables, never gathered in one place.

A union-find inside each task first replaces its links by stars; then alternating
star steps over the shuffled links (each node's greater neighbours are hung on its
least one, then each node's lesser ones) run until nothing changes. Every step works on
partially aggregated minima and on joins that Spark splits when a hub is hot.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def local_stars(links: DataFrame) -> DataFrame:
    """(a, b) links -> (u, v) with v < u: each task's union-find forest, flattened to stars."""
    kind = links.schema["a"].dataType

    def run(batches):
        for batch in batches:
            parent: dict = {}

            def find(x):
                root = x
                while (up := parent.setdefault(root, root)) != root:
                    root = up
                while parent[x] != root:
                    parent[x], x = root, parent[x]
                return root

            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                ra, rb = find(a), find(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
            rows = [(x, root) for x in parent if (root := find(x)) != x]
            if rows:
                at = batch.schema.field("a").type
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], at), pa.array([r[1] for r in rows], at)], names=["u", "v"])

    return links.select("a", "b").mapInArrow(run, f"u {kind.simpleString()}, v {kind.simpleString()}")


def settled(edges: DataFrame) -> bool:
    """Whether the edges (u, v < u) are stars: no node hangs on one and has others hanging on it."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))).alias("e")).select("e.*")
    several = edges.groupBy("u").agg(F.min("v").alias("a"), F.max("v").alias("b")).filter("a <> b")
    return ends.groupBy("node").agg(F.max("hangs").alias("hangs"), F.max("holds").alias("holds")).filter("hangs = 1 and holds = 1").isEmpty() and several.isEmpty()


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root): every node of ``links`` (columns a, b) with the least node it reaches."""
    edges = stored(local_stars(links).distinct(), "links")
    for _ in range(max_rounds):
        if settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = stored(small.filter("u <> v").distinct(), "links")
    else:
        raise RuntimeError("links did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def joined_components(first: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of ``first`` after ``links`` between its components (or nodes outside them): only
    the components that the links touch are looked at again."""
    by_a, by_b = (first.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
    named = links.join(by_a, "a", "left").join(by_b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).filter("a <> b").distinct()
    again = stored(components(named), "joined")
    moved = first.join(again.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return moved.unionByName(again.join(first, "node", "left_anti").select("node", "root"))
