"""Benchmark decontamination: rare word n-grams as seeds, Smith-Waterman alignment as proof.

Test items are taken in blocks of a bounded size, which are sent to all tasks; every
document is held against each block in one pass without a shuffle, so a passage that a
third of all documents share is no hot key. A seed is an n-gram whose words, by their
frequencies in the whole corpus, would rarely meet by chance; besides these, the rarest
n-gram of every stretch of the item is one, so that an item of frequent words (as those
that leaked most are) has seeds all over it. (The frequency of the n-gram itself isn't used: it would
hide the items that leaked most.) Around each seed the item is aligned locally with the
document's words: edited, cut or stretched copies keep most of the score.

Words are ASCII-lower-cased and cut at ASCII white space. Edge cases: null or empty texts
and items align with nothing; items shorter than the n-gram are one seed and must be
found whole; repeated rows and items get a result each; an empty benchmark matches nothing.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_value, chunks, map_chunks, text_bytes

MATCHES = "matches array<struct<item_id:bigint,score:int,similarity:double,start_word:int,end_word:int>>"


@dataclass(frozen=True)
class AlignRules:
    words: int = 3  #: per seed
    chance: float = 1e-7  #: per place, that the words of a seed meet by chance
    stretch: int = 6  #: n-grams in a row, of which one at least is a seed
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    similarity: float = 0.4  #: least score over that of the whole item
    least_words: int = 8  #: an alignment is worth at least so many matches (or the whole shorter item)
    slack: int = 8  #: words beyond the item's length that are aligned on either side of a seed
    block_bytes: int = 8 << 20  #: bound of the item texts sent to the tasks at a time


def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def item_blocks(items: DataFrame, rules: AlignRules):
    """Lists of (item_id, words) whose texts hold about ``block_bytes`` each."""
    items = items.select("item_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / rules.block_bytes))
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        found = sorted(((r["item_id"], words_of(bytes(r["text"]))) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        yield [(i, w) for i, w in found if w]


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """How often the words of ``vocabulary`` (one block's) occur in all documents, and the number of all words."""
    shared = broadcast_value(docs, vocabulary)

    def run(batches):
        seen, total = Counter(), 0
        for batch in batches:
            for part in chunks(batch):
                for raw in part.column("text").to_pylist():
                    words = words_of(raw)
                    total += len(words)
                    seen.update(filter(shared.value.__contains__, words))
        yield pa.RecordBatch.from_arrays([pa.array([*seen, None], pa.binary()), pa.array([*seen.values(), total], pa.int64())], names=["word", "n"])

    rows = text_bytes(docs).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {None if r["word"] is None else bytes(r["word"]): r["n"] for r in rows}
    return counts, counts.pop(None, 0)


class Seeds:
    """One block of items, prepared for lookup."""

    def __init__(self, items: list, counts: dict[bytes, int], total: int, rules: AlignRules):
        self.rules, self.n = rules, rules.words
        self.ids = {w: k for k, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.items = [(i, np.array([self.ids[w] for w in ws])) for i, ws in items]
        if len(self.ids) ** self.n >= 1 << 62:
            raise ValueError("block_bytes is too large for this seed length")
        share = np.array([max(counts.get(w, 0), 1) / max(total, 1) for w in self.ids])
        where: dict[int, list[int]] = defaultdict(list)
        self.short: dict[tuple, list[int]] = defaultdict(list)
        for k, (_, ws) in enumerate(self.items):
            if len(ws) < self.n:
                self.short[tuple(ws.tolist())].append(k)
                continue
            grams = np.lib.stride_tricks.sliding_window_view(ws, self.n)
            odds = np.log(share[grams]).sum(1)
            rare = np.flatnonzero(odds <= math.log(rules.chance))
            spread = [at + int(odds[at:at + rules.stretch].argmin()) for at in range(0, len(odds), rules.stretch)]
            for g in sorted({*rare.tolist(), *spread}):
                where[self.key(grams[g])].append(k)
        self.keys = np.array(sorted(where), np.int64)
        self.of_key = [sorted(set(where[key])) for key in self.keys.tolist()]

    def key(self, gram) -> int:
        out = 0
        for g in gram:
            out = out * len(self.ids) + int(g)
        return out

    def hits(self, ids: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """(document, item) -> places of seeds, for the word ids of several documents in a row."""
        found: dict[tuple[int, int], list[int]] = defaultdict(list)
        m = len(ids) - self.n + 1
        if m > 0 and len(self.keys):
            ok = doc[:m] == doc[self.n - 1:]
            for j in range(self.n):
                ok &= ids[j:m + j] >= 0
            at = np.flatnonzero(ok)
            key = np.zeros(len(at), np.int64)
            for j in range(self.n):
                key = key * len(self.ids) + ids[at + j]
            near = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            for p, s in zip(at[self.keys[near] == key].tolist(), near[self.keys[near] == key].tolist()):
                for k in self.of_key[s]:
                    found[int(doc[p]), k].append(p)
        for gram, items in self.short.items():
            m = len(ids) - len(gram) + 1
            ok = doc[:max(m, 0)] == doc[len(gram) - 1:] if m > 0 else np.zeros(0, bool)
            for j, g in enumerate(gram):
                ok = ok & (ids[j:m + j] == g) if m > 0 else ok
            for p in np.flatnonzero(ok).tolist():
                for k in items:
                    found[int(doc[p]), k].append(p)
        return found


def align(item: np.ndarray, text: np.ndarray, rules: AlignRules) -> tuple[int, int, int]:
    """(score, item words used, end in text) of the best local alignment with linear gaps."""
    gaps = np.arange(len(text) + 1) * -rules.gap
    row = np.zeros(len(text) + 1, np.int64)
    best = (0, 0, 0)
    for k, w in enumerate(item.tolist(), 1):
        new = np.maximum(row + rules.gap, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(text == w, rules.match, rules.mismatch))
        new = np.maximum.accumulate(new + gaps) - gaps  # gaps along the text
        top = int(new.argmax())
        if new[top] > best[0]:
            best = (int(new[top]), k, top)
        row = new
    return best


def best_place(item: np.ndarray, ids: np.ndarray, places: list[int], rules: AlignRules) -> tuple[int, int, int] | None:
    """(score, start, end) of the item's best alignment near the seeds, in words of the document."""
    reach = len(item) + rules.slack
    found, lo, hi = None, None, None
    spans = []
    for p in places:
        if lo is not None and p - reach <= hi:
            hi = max(hi, p + reach)
        else:
            if lo is not None:
                spans.append((lo, hi))
            lo, hi = p - reach, p + reach
    spans.append((lo, hi))
    for lo, hi in spans:
        lo, hi = max(lo, 0), min(hi, len(ids))
        score, used, end = align(item, ids[lo:hi], rules)
        if found is None or score > found[0]:
            found = (score, used, lo, lo + end)
    score, used, lo, end = found
    if score < max(rules.similarity * rules.match * len(item), rules.match * min(rules.least_words, len(item))):
        return None
    back = align(item[:used][::-1], ids[lo:end][::-1], rules)
    return score, end - back[2], end


def aligned(docs: DataFrame, items: list, rules: AlignRules = AlignRules(), carry="doc_id") -> DataFrame:
    """``carry`` and the matches of every document with one block of items."""
    counts, total = word_counts(docs, {w for _, ws in items for w in ws})
    shared = broadcast_value(docs, Seeds(items, counts, total, rules))

    def run(part):
        seeds: Seeds = shared.value
        words = [words_of(raw) for raw in part.column("text").to_pylist()]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.fromiter(map(seeds.ids.get, chain.from_iterable(words), repeat(-1)), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        out: list[list] = [[] for _ in words]
        for (d, k), places in sorted(seeds.hits(ids, np.repeat(np.arange(len(words)), sizes)).items()):
            item_id, item = seeds.items[k]
            at = int(starts[d])
            place = best_place(item, ids[at:at + int(sizes[d])], sorted(p - at for p in places), rules)
            if place:
                score, start, end = place
                out[d].append({"item_id": item_id, "score": score, "similarity": score / (rules.match * len(item)), "start_word": start, "end_word": end})
        return {"matches": out}

    df = text_bytes(docs, carry)
    return map_chunks(df, MATCHES, run, df.columns[0])


def contaminated(docs: DataFrame, items: DataFrame, rules: AlignRules = AlignRules()) -> DataFrame:
    """(doc_id, item_id, score, similarity, start_word, end_word) for every document and item that align."""
    out = None
    for block in item_blocks(items, rules):
        found = aligned(docs, block, rules).select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
        out = found if out is None else out.unionByName(found)
    return out


def without_matches(docs: DataFrame, items: DataFrame, rules: AlignRules = AlignRules()) -> DataFrame:
    """``docs`` less the documents that align with any item."""
    from .common import whole_row

    for block in item_blocks(items, rules):
        docs = aligned(docs, block, rules, carry=whole_row()).filter(F.size("matches") == 0).select("row.*")
    return docs
