"""Toxicity by multiple-instance learning.

Only documents are labelled. A document is a bag of sentences; each sentence has a
probability from the weights of its words and of the words' first letters (so inflected
and compound forms count), and the document's probability is their noisy-or: it is toxic
unless every sentence is clean. The weights are trained through the noisy-or from the
documents' labels; afterwards the sentences' own probabilities locate the offence.

A clean sentence keeps a small probability, and thousands of them would add up to a toxic
text with nothing to point at. Sentences under ``least_evidence`` are therefore one
instance together, the strongest of them, however long the text is.

Edge cases: null, empty and wordless texts have one empty sentence, scored by the bias;
without training labels of both kinds every score is the same; repeated rows and null
ids get a row each.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_value, map_chunks, text_bytes
from .labelled import held_out, training_sample

SENTENCE_END = re.compile(r"[.!?\n]+")
STRIPPED = " .,;:!?\"'()[]{}*&$#%|<>-_/\\"


@dataclass(frozen=True)
class MilRules:
    sample_rows: int = 6000  #: bound of the labelled sample that is fitted
    sample_bytes: int = 24 << 20  #: bound of its texts together
    least_evidence: float = 0.05  #: sentences of a smaller probability count once, by the strongest of them
    stems: tuple[int, ...] = (4, 5, 6)  #: first letters taken as features
    min_docs: int = 6  #: documents of the sample that have a feature
    rounds: int = 300
    rate: float = 0.2
    shrink: float = 4e-5  #: pull of every weight towards 0
    bias: float = -5.0  #: at the start
    least_weight: float = 0.05  #: smaller weights are dropped from the model


def features(word: str, stems: tuple[int, ...]) -> list[str]:
    """The bare word and its first letters (marked so that they aren't taken for words)."""
    bare = word.strip(STRIPPED)
    if not bare or bare.isdigit():
        return []
    return [bare] + [bare[:n] + "~" for n in stems if len(bare) > n]


def sentences(text: str) -> list[list[str]]:
    return [s.split() for s in SENTENCE_END.split(text.lower())]


def train(sample: list[tuple[int, str, int]], rules: MilRules = MilRules()) -> dict:
    """{"bias": ..., "weights": {feature: weight}} by gradient ascent through the noisy-or."""
    if len({y for _, _, y in sample}) < 2:
        return {"bias": rules.bias, "weights": {}}
    ids: dict[str, int] = {}
    of_word: dict[str, list[int]] = {}
    cols, of_sentence, of_doc, seen = array("i"), array("i"), array("i"), array("i")
    for d, (_, text, _) in enumerate(sample):
        own: set[int] = set()
        for s in sentences(text):
            found: set[int] = set()
            for w in s:
                if w not in of_word:
                    of_word[w] = [ids.setdefault(f, len(ids)) for f in features(w, rules.stems)]
                found.update(of_word[w])
            cols.extend(sorted(found))
            of_sentence.extend([len(of_doc)] * len(found))
            of_doc.append(d)  # also without features: the bias is learnt from all sentences
            own |= found
        seen.extend(own)
    names, of_word = list(ids), {}
    cols, of_sentence, of_doc = (np.array(x) for x in (cols, of_sentence, of_doc))
    common = np.bincount(np.array(seen), minlength=len(names)) >= rules.min_docs
    index = np.cumsum(common) - 1
    kept = common[cols]
    cols, of_sentence = index[cols[kept]].astype(np.int32), of_sentence[kept]
    names = [f for f, ok in zip(names, common) if ok]
    y = np.array([y for _, _, y in sample])
    weight = np.where(y == 1, (len(y) - y.sum()) / y.sum(), 1.0) ** 0.5  # the rarer label counts more, by the root
    size = len(names)
    w, b = np.zeros(size), rules.bias
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rules.rounds + 1):
        z = np.bincount(of_sentence, w[cols], len(of_doc)) + b
        p = 1 / (1 + np.exp(-z.clip(-30, 30)))
        clean = np.exp(np.bincount(of_doc, np.log1p(-p.clip(0, 1 - 1e-9)), len(y)))
        toxic = (1 - clean).clip(1e-9)
        slope = weight[of_doc] * np.where(y[of_doc] == 1, p * clean[of_doc] / toxic[of_doc], -p) / len(y)
        g = np.append(np.bincount(cols, slope[of_sentence], size) - rules.shrink * np.sign(w), slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = rules.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
        w, b = w + move[:-1], b + move[-1]
        w = np.where(np.abs(w) < rules.rate * 0.02, 0, w)
    kept = np.flatnonzero(np.abs(w) >= rules.least_weight)
    return {"bias": float(b), "weights": {names[i]: float(w[i]) for i in kept}}


class WordWeights(dict):
    """word -> sum of its features' weights; bounded, refilled on demand."""

    def __init__(self, weights: dict[str, float], stems: tuple[int, ...], limit: int = 300_000):
        super().__init__()
        self.weights, self.stems, self.limit = weights, stems, limit

    def __missing__(self, word: str) -> float:
        if len(self) >= self.limit:
            self.clear()
        value = sum(self.weights.get(f, 0.0) for f in features(word, self.stems))
        self[word] = value
        return value


def noisy_or(z: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """Probability of each document that a sentence of it is toxic; its sentences' log-odds are
    ``z[at[k]:at[k + 1]]``. Those of a probability under ``least`` count as the strongest of them."""
    doubt, strong = np.logaddexp(0, z), z >= np.log(least / (1 - least))
    evidence = np.add.reduceat(np.where(strong, doubt, 0.0), at[:-1])
    return -np.expm1(-evidence - np.maximum.reduceat(np.where(strong, 0.0, doubt), at[:-1]))


def score(docs: DataFrame, model: dict, rules: MilRules = MilRules(), carry="doc_id") -> DataFrame:
    """Per document: score (noisy-or over all sentences), predicted, and the offending
    sentences as (start, end, p) in code points, where p is 0.5 or more."""
    shared = broadcast_value(docs, model)
    holder: list[WordWeights] = []

    def run(part):
        if not holder:
            holder.append(WordWeights(shared.value["weights"], rules.stems))
        get, bias = holder[0].__getitem__, shared.value["bias"]
        texts = [raw.decode("utf-8", "replace").lower() for raw in part.column("text").to_pylist()]
        cut = [SENTENCE_END.split(t) for t in texts]
        sums = [sum(map(get, set(s.split()))) for ss in cut for s in ss]
        z = (np.array(sums) + bias).clip(-30, 30)
        at = np.cumsum([0] + [len(ss) for ss in cut])
        toxic = noisy_or(z, at, rules.least_evidence)
        spans: list[list[tuple]] = [[] for _ in texts]
        hot = np.flatnonzero(z >= 0)
        for i in hot.tolist():
            d = int(np.searchsorted(at, i, "right")) - 1
            if not spans[d]:
                spans[d] = located(texts[d], z[at[d]:at[d + 1]])
        return {"score": toxic, "predicted": (toxic >= 0.5).astype(np.int32), "offending": spans}

    df = text_bytes(docs, carry)
    return map_chunks(df, "score double, predicted int, offending array<struct<start:int,end:int,p:double>>", run, df.columns[0])


def located(text: str, z: np.ndarray) -> list[tuple[int, int, float]]:
    """Offending sentences of one text. Lower-casing can lengthen a text by letters whose lower
    case is two characters; positions are those of the lower-cased text."""
    starts = [0] + [m.end() for m in SENTENCE_END.finditer(text)]
    ends = [m.start() for m in SENTENCE_END.finditer(text)] + [len(text)]
    return [(s, e, float(1 / (1 + np.exp(-v)))) for s, e, v in zip(starts, ends, z) if v >= 0]


def toxic_documents(docs: DataFrame, labels: DataFrame, rules: MilRules = MilRules()) -> DataFrame:
    """Scores of all documents by a model trained on the labels' training fold."""
    model = train(training_sample(docs, labels, "toxic", rules.sample_rows, rules.sample_bytes), rules)
    return score(docs, model, rules).select("doc_id", held_out().alias("held_out"), "score", "predicted", "offending")
