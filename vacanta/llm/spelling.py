"""Spelling variants: words one edit apart, found through pairs of trie nodes.

The words (distinct, with their counts) are put into two tries, of the words and of the reversed
words, whose nodes are numbered. A word with a position left out is a pair of integers: the forward
node of what stands before, the backward node of what stands after. A word split between
two positions is such a pair, too. Words with equal pairs are neighbours, and all neighbours have one:

* two left-out pairs: the words differ in the character left out (a replacement),
* a left-out pair and a split pair: the first word has one character more (an insertion or deletion).

Both nodes together determine what is left of the word, so equal pairs need no check. A pair holds at
most one split word, and of left-out words one for each letter, so a pair's group is bounded by the
alphabet; no pairs of words are listed: a group gives each member its number of neighbours there and
the best of them. Of a run of equal letters only the last one's left-out pair meets split words
(leaving out any of them gives the same word), so no neighbour counts twice.

Numbering: the words are put into sorted ranges. Within a range, a word shares its predecessor's nodes up
to their common prefix, and the rest are new. Nodes that ranges share lie on the way to a range's last
word, so they are numbered by the first range that has them and their depth; the last words (one for each
range) are sent to all tasks.

Word text crosses no shuffle after the numbering: pairs, ranks and counts are integers. A rank in the
forward order stands for the word, so ties fall in code-point order.

Edge cases: null and empty texts have no words; a null id counts as the empty text; equal rows and ties
count as often as they stand there; very long runs cost in proportion to their length; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_code
from .common import broadcast_value, stored

#: Fixed by the task: letters of a run, and the lower-casing of A-Z only.
LETTERS = "A-Za-z\\u00C0-\\u00FF"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class SpellingRules:
    slip: int = 97  #: a run loses a letter if the hash of id and run is a multiple of this
    min_length: int = 5  #: code points of a word
    min_count: int = 3  #: occurrences of a word
    ratio: int = 2  #: a form is at least so many times as frequent as its variant


def spelled_words(docs: DataFrame, rules: SpellingRules = SpellingRules()) -> DataFrame:
    """(word, n): the words of all texts with their occurrences."""
    # a shorter run can't give a word, and a run is either matched whole or not at all
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"[{LETTERS}]{{{rules.min_length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h, at = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")), F.col("h") % F.length("run")
    slipped = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", (at + 2).cast("int"), F.length("run")))
    rows = rows.withColumn("h", h).select(F.when(F.col("h") % rules.slip == 0, slipped).otherwise(F.col("run")).alias("word"))
    return rows.filter(F.length("word") >= rules.min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= rules.min_count)


# ----------------------------------------------------------------- numbered tries

def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    if (n := min(len(a), len(b))) and a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is shared, a[:high] isn't (or n is 0)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


RANGE_BITS = 34


class Boundaries:
    """The last words of sorted ranges: which range numbers a node that several ranges share."""

    def __init__(self, lasts: dict[int, str]):
        self.lasts, self.owners, before = lasts, {}, None
        for k in sorted(lasts):
            # (depth, range): the nodes of the last word down to that depth are the range's own
            runs: list[tuple[int, int]] = []
            if before is not None:
                shared = common(lasts[before], lasts[k])
                for depth, owner in self.owners[before]:
                    runs.append((min(depth, shared), owner))
                    if depth >= shared:
                        break
            if not runs or runs[-1][0] < len(lasts[k]):
                runs.append((len(lasts[k]), k))
            self.owners[k], before = runs, k
        self.order = sorted(lasts)

    def path(self, k: int) -> list[int]:
        """Numbers of the nodes on the way to the last word of range ``k``."""
        out: list[int] = []
        for depth, owner in self.owners[k]:
            out += [(owner << RANGE_BITS) + 2 * d + 1 for d in range(len(out), depth + 1)]
        return out

    def before(self, k: int) -> int | None:
        at = self.order.index(k)
        return self.order[at - 1] if at else None


class RangeNumbers:
    """Numbers the nodes of a range's words, which come in order."""

    def __init__(self, k: int, ends: Boundaries):
        self.base, before = k << RANGE_BITS, ends.before(k)
        self.last, self.own = ends.lasts[k], ends.path(k)
        self.left, self.behind = (None, []) if before is None else (ends.lasts[before], ends.path(before))
        self.word, self.path, self.new = "", self.own[:1], 0

    def number(self, word: str) -> list[int]:
        """The nodes on the way to ``word``, the root's first."""
        keep = common(word, self.word)
        path = self.path[:keep + 1]
        shared, ahead = (-1 if self.left is None else common(word, self.left)), common(word, self.last)
        for depth in range(keep + 1, len(word) + 1):
            if depth <= shared:
                path.append(self.behind[depth])
            elif depth <= ahead:
                path.append(self.own[depth])
            else:
                path.append(self.base + 2 * self.new)
                self.new += 1
        self.word, self.path = word, path
        return path


#: Nodes that a task holds before it hands them on.
HELD = 1 << 18


def numbered_trie(words: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """``keep``, ``nodes`` (the trie's nodes on the way to the word), ``rank`` (in the order of the
    words) and ``inner`` (whether the letter at each position equals the next)."""
    checkpoint_dir(words.sparkSession)
    ship_code(words.sparkSession)
    ranged = words.repartitionByRange(column).sortWithinPartitions(column).withColumn("range", F.spark_partition_id()).checkpoint(eager=True)
    lasts = {r["range"]: r["last"] for r in ranged.groupBy("range").agg(F.max(column).alias("last")).collect()}  # one row per range
    ends = broadcast_value(words, Boundaries(lasts))
    kept = [ranged.schema[c] for c in keep]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "rank long, nodes array<long>, inner array<boolean>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, row = None, 0
        for batch in batches:
            start, paths, inner, held = 0, [], [], 0
            for i, word in enumerate(batch.column(column).to_pylist()):
                if numbers is None:
                    k = batch.column("range")[0].as_py()
                    numbers = RangeNumbers(k, ends.value)
                paths.append(numbers.number(word))
                inner.append([a == b for a, b in zip(word, word[1:])] + [False])
                held += len(word)
                if held >= HELD or i + 1 == batch.num_rows:
                    part = batch.slice(start, i + 1 - start)
                    ranks = pa.array((k << RANGE_BITS) + np.arange(row, row + part.num_rows), pa.int64())
                    yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), ranks, pa.array(paths, pa.list_(pa.int64())), pa.array(inner, pa.list_(pa.bool_()))],
                                                     names=[*(f.name for f in kept), "rank", "nodes", "inner"])
                    start, row, paths, inner, held = i + 1, row + part.num_rows, [], [], 0

    return ranged.mapInArrow(run, schema)


# ----------------------------------------------------------------- neighbours

def node_pairs(forward: DataFrame) -> DataFrame:
    """(before, after, kind, n, rank): the pairs of every word of the numbered forward trie. ``kind`` 2:
    split; 1: a position left out that split words meet; 0: one that they don't."""
    back = numbered_trie(forward.select(F.reverse("word").alias("turned"), F.col("rank").alias("of")), "turned", ["of"])
    both = forward.join(back.select("of", F.reverse("nodes").alias("after")), forward["rank"] == F.col("of"))
    whole = F.transform(F.arrays_zip(F.col("nodes").alias("before"), F.col("after")), lambda x: F.struct(x["before"].alias("before"), x["after"].alias("after"), F.lit(2).alias("kind")))
    letters = F.size("inner")
    left_out = F.transform(F.arrays_zip(F.slice("nodes", F.lit(1), letters).alias("before"), F.slice("after", F.lit(2), letters).alias("after"), F.col("inner")),
                           lambda x: F.struct(x["before"].alias("before"), x["after"].alias("after"), F.when(x["inner"], F.lit(0)).otherwise(F.lit(1)).alias("kind")))
    return both.select("n", "rank", F.inline(F.concat(whole, left_out)))


def neighbours(pairs: DataFrame) -> DataFrame:
    """(rank, n_near, best): each word's number of neighbours, and the best of them: ``best.n``, and
    ``best.back``, the negative of its rank. Words without neighbours have no row."""
    one = F.struct("n", (-F.col("rank")).alias("back"), "kind")
    groups = pairs.groupBy("before", "after").agg(F.sort_array(F.collect_list(F.when(F.col("kind") < 2, one)), asc=False).alias("out"), F.max(F.when(F.col("kind") == 2, one)).alias("split"))
    groups = groups.filter("size(out) > 1 or (size(out) = 1 and split is not null)")
    open_, best = F.filter("out", lambda x: x["kind"] == 1), lambda x: F.struct(x["n"].alias("n"), x["back"].alias("back"))
    others = F.transform("out", lambda x: F.struct(
        (-x["back"]).alias("rank"), (F.size("out") - 1 + F.when((x["kind"] == 1) & F.col("split").isNotNull(), 1).otherwise(0)).alias("n_near"),
        F.greatest(F.when((x["kind"] == 1), best(F.col("split"))), best(F.get("out", F.when(F.get("out", F.lit(0))["back"] == x["back"], F.lit(1)).otherwise(F.lit(0))))).alias("best")))
    split = F.when(F.col("split").isNotNull() & (F.size("open") > 0), F.array(F.struct((-F.col("split.back")).alias("rank"), F.size("open").alias("n_near"), best(F.get("open", F.lit(0))).alias("best"))))
    rows = groups.withColumn("open", open_).select(F.explode(F.concat(others, F.coalesce(split, F.filter(others, lambda x: F.lit(False))))).alias("r")).select("r.*")
    return rows.filter("n_near > 0").groupBy("rank").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def roots(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(rank, form) -> (rank, root) by pointer doubling; a form is more frequent than its variant, so no
    chain ends where it began, and its length is the logarithm of a count."""
    at = stored(links.select("rank", F.col("form").alias("root")), "forms")
    for _ in range(max_rounds):
        onward = at.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        moved = at.join(onward, "root", "left").select("rank", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = stored(moved, "forms")
        if moved.filter("moved").isEmpty():
            return moved.select("rank", "root")
        at = moved.select("rank", "root")
    raise RuntimeError("chains of forms did not end")


def variants(words: DataFrame, rules: SpellingRules = SpellingRules()) -> DataFrame:
    """Distinct words (word, n) -> word, n, n_near (neighbours), form (the most frequent neighbour, the
    first in code-point order of equal ones, if it is ``ratio`` times as frequent), form_n, and root
    (the end of the chain of forms, the word itself if it has none)."""
    forward = stored(numbered_trie(words.select("word", "n"), "word", ["word", "n"]), "forward-trie")
    near = neighbours(node_pairs(forward)).select(F.col("rank").alias("of"), "n_near", F.col("best.n").alias("best_n"), (-F.col("best.back")).alias("best"))
    all_ = forward.select("rank", "word", "n").join(near, F.col("rank") == F.col("of"), "left").drop("of")
    has = F.col("best_n") >= rules.ratio * F.col("n")
    all_ = stored(all_.select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best")).alias("form_rank"), F.when(has, F.col("best_n")).alias("form_n")), "variants")
    linked = all_.filter("form_rank is not null")
    ends = roots(linked.select("rank", F.col("form_rank").alias("form"))).join(linked.select("rank", "form_rank"), "rank")
    named = all_.select(F.col("rank").alias("at"), F.col("word").alias("name"))
    ends = (ends.join(named, F.col("form_rank") == F.col("at")).select("rank", "root", F.col("name").alias("form"))
                .join(named, F.col("root") == F.col("at")).select("rank", "form", F.col("name").alias("root")))
    out = all_.join(ends, "rank", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
