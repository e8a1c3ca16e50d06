"""Quality rules by distribution divergence.

References: for every language with enough words of its own, however small its share of
the corpus, the histogram of character classes and of its most common words, counted over
its distinct texts (copies count once). A document whose language has no reference is left
to the base rule. Any other document, also one without a language,
is held against every reference by the Jensen-Shannon distance (square root of the
divergence in bits) and takes the nearest one; too far in either histogram rejects it.
Short texts, whose histograms say little, are guarded by minimum lengths.

Base figures beside it: code points in words, symbol characters, repeated lines, words
inside 8-word windows found twice or more. Windows are compared by 64-bit keys.

Edge cases: a null or empty text has no words and fails the base rule; null languages
count towards no reference; without any reference only the base rule decides; a
repeated row gets a row each.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from functools import lru_cache
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bitmap, broadcast_value, chunks, map_chunks, may_hold, release, stored, text_bytes

WINDOW = 8
#: Bytes of text that a task works on at a time: words and code points as objects take many times that.
SLICE = 1 << 20
#: Character classes: space, line end, lower-case, upper-case, letters without case, digits,
#: sentence marks, quotes and brackets, the counted symbols, other marks, controls and the rest.
SYMBOLS = "#*$%&|<>"
CLASSES = 11


@dataclass(frozen=True)
class DivergenceRules:
    common_words: int = 40  #: most common words of each reference
    reference_words: int = 10_000  #: in distinct texts, that a language with a reference has at least
    char_distance: float = 0.31  #: largest distance of character classes
    word_distance: float = 0.14  #: largest distance of common words, in a text without end
    word_allowance: float = 2.3  #: for chance, over the root of the number of words
    min_chars: int = 100  #: shorter texts aren't held against character classes
    min_words: int = 40  #: shorter texts aren't held against common words
    fewest_words: int = 20  #: the base rule
    repeat_percent: int = 30


@lru_cache(1)
def class_table() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, 10, np.uint8)
    kinds = {"Ll": 2, "Lu": 3, "Lt": 3, "Lo": 4, "Lm": 4, "Mn": 4, "Mc": 4, "Nd": 5, "Nl": 5, "No": 5}
    for cp in range(0x30000):
        kind = unicodedata.category(chr(cp))
        out[cp] = kinds.get(kind, 9 if kind[0] in "PS" else 0 if kind == "Zs" else 10)
    for chars, k in ((" \t\v\f\r", 0), ("\n", 1), (".,;:!?", 6), ("\"'()[]{}-«»„“”‘’", 7), (SYMBOLS, 8)):
        for c in chars:
            out[ord(c)] = k
    return out


def code_points(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), "<u4")


def repeated_words(words: list[list[bytes]], width: int = WINDOW) -> np.ndarray:
    """For every text, its words inside a window of ``width`` words that the text has twice or more."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    out = np.zeros(len(words), np.int64)
    if total < width:
        return out
    h = np.fromiter((hash(w) for ws in words for w in ws), np.int64, total).view(np.uint64)
    doc = np.repeat(np.arange(len(words)), sizes)
    inside = doc[: total - width + 1] == doc[width - 1:]
    key = np.zeros(total - width + 1, np.uint64)
    for j in range(width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + (h[j: total - width + 1 + j] ^ (h[j: total - width + 1 + j] >> np.uint64(29)))
    at = np.flatnonzero(inside)
    key = (key[at] ^ (key[at] >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + doc[at].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    near = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    hits = at[twice[near] == key]
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + width, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[covered], minlength=len(words))


def distinct_texts(docs: DataFrame) -> tuple[DataFrame, object]:
    """(lang, text, digest) of the texts with a language, and a bitmap in which the digests of all texts with copies are."""
    digest = F.xxhash64("lang", F.coalesce("text", F.lit("")))
    docs = docs.filter("lang is not null")
    copies = docs.select(digest.alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return text_bytes(docs, "lang", digest.alias("digest")).select("lang", "text", "digest"), broadcast_value(docs, bitmap(copies))


def partial_counts(docs: DataFrame, flush: int = 150_000, remembered: int = 200_000) -> DataFrame:
    """(lang, kind, key, n): character classes (kind c) and lower-cased words (kind w) of distinct texts,
    summed within tasks up to ``flush`` keys before they are shuffled. Texts that surely have no copy are counted
    where they lie, by the worker that sorts them out; all others are brought together (most copies are dropped
    before that shuffle) and come sorted, so one digest is remembered."""
    texts, shared = distinct_texts(docs)

    def copied(batches):
        seen = set()
        for batch in batches:
            keys = batch.column("digest").to_numpy()
            chosen = may_hold(shared.value, keys.view(np.uint64))
            for k in np.flatnonzero(chosen).tolist():
                chosen[k] = keys[k] not in seen
                seen.add(keys[k])
            if len(seen) > remembered:
                seen.clear()
            yield batch.filter(pa.array(chosen))
        release()

    def run(batches, single):
        last = None
        table, words, chars = class_table(), defaultdict(Counter), defaultdict(lambda: np.zeros(CLASSES, np.int64))

        def rows(lang, kind, keys, n):
            same = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(keys), np.int32))) for x in (lang, kind)]
            return pa.RecordBatch.from_arrays([*same, pa.array(keys, pa.binary()), pa.array(n, pa.int64())], names=["lang", "kind", "key", "n"])

        def emit():
            while words:
                lang, found = words.popitem()
                yield rows(lang, "w", list(found), list(found.values()))
            while chars:
                lang, found = chars.popitem()
                yield rows(lang, "c", [str(k).encode() for k in np.flatnonzero(found).tolist()], found[found > 0])

        for batch in batches:
            for part in chunks(batch, limit=SLICE):
                if single:
                    part = part.filter(pa.array(~may_hold(shared.value, part.column("digest").to_numpy().view(np.uint64))))
                for lang, raw, digest in zip(*(part.column(c).to_pylist() for c in ("lang", "text", "digest"))):
                    if single or digest != last:
                        last = digest
                        words[lang].update(raw.lower().split())
                        chars[lang] += np.bincount(table[code_points(raw)], minlength=CLASSES)
                if sum(map(len, words.values())) > flush:
                    yield from emit()
        yield from emit()
        release()

    schema = "lang string, kind string, key binary, n long"
    again = texts.mapInArrow(copied, texts.schema).repartition("digest").sortWithinPartitions("digest")
    return texts.mapInArrow(lambda batches: run(batches, True), schema).unionByName(again.mapInArrow(lambda batches: run(batches, False), schema))


def references(docs: DataFrame, rules: DivergenceRules = DivergenceRules()) -> dict[str, tuple[list[float], dict[bytes, float]]]:
    """language -> (share of each character class, share of each common word).

    ``common_words`` words of each language with a reference reach the driver."""
    counts = partial_counts(docs).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    rows = stored(counts, "language-counts")
    totals = rows.filter("kind = 'w'").groupBy("lang").agg(F.sum("n").alias("total"))
    totals = {r["lang"]: r["total"] for r in totals.filter(F.col("total") >= F.lit(max(1, rules.reference_words))).collect()}
    kept = rows.filter(F.col("lang").isin(list(totals)))
    common = kept.filter("kind = 'w'").withColumn("r", F.row_number().over(top)).filter(F.col("r") <= rules.common_words).collect()
    classes = kept.filter("kind = 'c'").collect()
    out = {g: ([0.0] * CLASSES, {}) for g in sorted(totals)}
    for r in common:
        out[r["lang"]][1][bytes(r["key"])] = r["n"] / totals[r["lang"]]
    for r in classes:
        out[r["lang"]][0][int(r["key"])] = float(r["n"])
    return {g: ([x / (sum(c) or 1) for x in c], w) for g, (c, w) in out.items()}


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of each row of ``p`` from ``q`` (rows sum to 1)."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum(-1) + np.where(q > 0, q * np.log2(q / m), 0).sum(-1)
    return np.sqrt(np.maximum(d / 2, 0))


def judge(docs: DataFrame, refs: dict, rules: DivergenceRules = DivergenceRules(), carry="doc_id") -> DataFrame:
    """One row per document: base figures, the two distances, the nearest language, kept."""
    shared = broadcast_value(docs, refs)
    schema = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean, char_distance double, word_distance double, nearest string")

    def run(part):
        table, langs = class_table(), list(shared.value)
        listed = {w: k for k, w in enumerate(sorted({w for _, ws in shared.value.values() for w in ws}))}
        ref_chars = np.array([c for c, _ in shared.value.values()]).reshape(len(langs), CLASSES)
        ref_words = np.zeros((len(langs), len(listed) + 1))
        for g, (_, ws) in enumerate(shared.value.values()):
            for w, share in ws.items():
                ref_words[g, listed[w]] = share
            ref_words[g, -1] = 1 - sum(ws.values())
        texts = part.column("text").to_pylist()
        words = [raw.split() for raw in texts]
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        chars, lines, found = np.zeros((len(texts), CLASSES), np.int64), [], np.zeros((len(texts), len(listed) + 1))
        spaces = np.zeros(len(texts), np.int64)
        for k, raw in enumerate(texts):
            points = code_points(raw)
            chars[k] = np.bincount(table[points], minlength=CLASSES)
            spaces[k] = sum(map(raw.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
            full = [x for x in raw.split(b"\n") if x.strip()]
            lines.append(len(full) - len(set(full)))
            hit = [listed[w] for w in raw.lower().split() if w in listed]
            found[k] = np.bincount(hit, minlength=len(listed) + 1)
            found[k, -1] = n_words[k] - len(hit)
        repeat, total = repeated_words(words), chars.sum(1)
        failed = (n_words < rules.fewest_words) | (100 * repeat > rules.repeat_percent * n_words)
        if langs:
            p, q = chars / np.maximum(total, 1)[:, None], found / np.maximum(n_words, 1)[:, None]
            by_char = np.stack([js_distance(p, r) for r in ref_chars], 1)
            by_word = np.stack([restricted(q, r) for r in ref_words], 1)
            nearest = (by_char + by_word).argmin(1)
            d_char, d_word = (x[np.arange(len(texts)), nearest] for x in (by_char, by_word))
            names = [langs[k] for k in nearest]
        else:
            d_char = d_word = np.zeros(len(texts))
            names = [None] * len(texts)
        far = ((total >= rules.min_chars) & (d_char > rules.char_distance)) | ((n_words >= rules.min_words) & (d_word > rules.word_distance + rules.word_allowance / np.sqrt(np.maximum(n_words, 1))))
        far &= ~np.fromiter((g is not None and g not in shared.value for g in part.column("lang").to_pylist()), bool, len(texts))
        return {"n_words": n_words, "word_chars": total - spaces, "n_symbols": chars[:, 8], "n_dup_lines": lines,
                "n_repeat_words": repeat, "base_failed": failed, "kept": ~failed & ~far, "char_distance": d_char, "word_distance": d_word, "nearest": names}

    df = text_bytes(docs, carry, "lang")
    return map_chunks(df, schema, run, df.columns[0], limit=SLICE)


def restricted(q: np.ndarray, ref: np.ndarray) -> np.ndarray:
    """Distance over one language's common words; all other words are one bucket."""
    own = np.flatnonzero(ref[:-1] > 0)
    p = q[:, own]
    return js_distance(np.column_stack([p, 1 - p.sum(1)]).clip(0, 1), np.append(ref[own], ref[-1]))
