"""Quality by compression.

Two zstandard dictionaries are built from good and from bad labelled texts. A document is
compressed with either; the size it saves with the good one against the bad one, over its
own size, is turned into a probability by a monotone calibration fitted on labelled
documents that the dictionaries haven't seen. A text lends the dictionaries a few
pieces spread over all of it, so a long one doesn't rule a dictionary, and the larger class
lends at most ``ratio`` pieces for each of the smaller one's (more would make its dictionary
fit any text better), from the texts of least hash.

Edge cases: null and empty texts save nothing and get the calibration's value at 0;
without labels of both kinds every score is the share of good ones (0.5 without any);
repeated rows and null ids get a row each.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from .common import broadcast_value, map_chunks, text_bytes
from .labelled import held_out, training_sample


@dataclass(frozen=True)
class CompressionRules:
    sample_rows: int = 12_000  #: bound of the labelled sample that is fitted
    sample_bytes: int = 48 << 20  #: bound of its texts together
    piece_bytes: int = 600  #: the dictionaries are built from pieces of the sample texts of this size
    text_pieces: int = 8  #: pieces that a text lends
    ratio: int = 2  #: pieces of the larger class for each of the smaller one's
    dictionary_bytes: int = 64 << 10
    level: int = 3
    threshold: float = 0.3


class Pair:
    """Compressors with the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes, level: int):
        self.both = [zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (good, bad)]

    def saving(self, raw: bytes) -> float:
        """Bytes saved by the good dictionary against the bad one, per byte of text."""
        good, bad = (len(c.compress(raw)) for c in self.both)
        return (bad - good) / max(len(raw), 1)


def dictionary(pieces: list[bytes], rules: CompressionRules) -> bytes:
    try:
        return zstandard.train_dictionary(rules.dictionary_bytes, pieces, level=rules.level).as_bytes()
    except zstandard.ZstdError:  # too few or too short texts to train on: their own bytes serve
        return b"".join(pieces)[-rules.dictionary_bytes:].ljust(8, b" ")


def lent_pieces(texts: list[bytes], rules: CompressionRules) -> list[list[bytes]]:
    """Each text's pieces, evenly spread over it; texts in the order of their hashes, whatever their ids."""
    out = []
    for t in sorted(texts, key=lambda t: (zlib.crc32(t), t)):
        n = max(1, -(-len(t) // rules.piece_bytes))
        some = min(n, rules.text_pieces)
        out.append([t[k * n // some * rules.piece_bytes:][:rules.piece_bytes] for k in range(some)])
    return out


def balanced(good: list[bytes], bad: list[bytes], rules: CompressionRules) -> list[list[bytes]]:
    """Pieces of either class, the larger one's up to ``ratio`` for each of the other's."""
    lent = [lent_pieces(texts, rules) for texts in (good, bad)]
    most = rules.ratio * min(sum(map(len, own)) for own in lent)
    return [[p for own in texts for p in own][:most] for texts in lent]


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots of the best non-decreasing fit of y over x (pool adjacent violators), smoothed by one row of each label."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for xi, yi in zip(x[order], y[order]):
        blocks.append([xi, xi, yi, 1.0])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    knots_x, knots_y = [], []
    for lo, hi, good, n in blocks:
        p = (good + 0.5) / (n + 1)
        knots_x += [float(lo), float(hi)]
        knots_y += [float(p), float(p)]
    return knots_x, np.maximum.accumulate(knots_y).tolist()


def fit(sample: list[tuple[int, str, int]], rules: CompressionRules = CompressionRules()) -> dict:
    """Dictionaries from two thirds of the sample, calibration from the rest."""
    rows = [(t.encode("utf-8", "replace"), int(y == 1)) for _, t, y in sample]
    built, kept = [r for k, r in enumerate(rows) if k % 3], rows[::3]
    good, bad = [t for t, y in built if y], [t for t, y in built if not y]
    share = (sum(y for _, y in rows) + 0.5) / (len(rows) + 1)
    if not good or not bad:
        return {"constant": share}
    model = dict(zip(("good", "bad"), (dictionary(own, rules) for own in balanced(good, bad, rules))))
    pair = Pair(model["good"], model["bad"], rules.level)
    x, y = np.array([pair.saving(t) for t, _ in kept]), np.array([float(y) for _, y in kept])
    model["x"], model["y"] = isotonic(x, y)
    return model


def score(docs: DataFrame, model: dict, rules: CompressionRules = CompressionRules(), carry="doc_id") -> DataFrame:
    """Per document: saving, score, predicted."""
    shared = broadcast_value(docs, model)
    holder: list[Pair] = []

    def run(part):
        texts, m = part.column("text").to_pylist(), shared.value
        if "constant" in m:
            x, p = np.zeros(len(texts)), np.full(len(texts), m["constant"])
        else:
            if not holder:
                holder.append(Pair(m["good"], m["bad"], rules.level))
            x = np.array([holder[0].saving(t) for t in texts])
            p = np.interp(x, m["x"], m["y"])
        return {"saving": x, "score": p, "predicted": (p >= rules.threshold).astype(np.int32)}

    df = text_bytes(docs, carry)
    return map_chunks(df, "saving double, score double, predicted int", run, df.columns[0])


def quality_documents(docs: DataFrame, labels: DataFrame, rules: CompressionRules = CompressionRules()) -> DataFrame:
    """Scores of all documents by a model fitted on the labels' training fold."""
    model = fit(training_sample(docs, labels, "quality", rules.sample_rows, rules.sample_bytes), rules)
    return score(docs, model, rules).select("doc_id", held_out().alias("held_out"), "score", "predicted", "saving")
