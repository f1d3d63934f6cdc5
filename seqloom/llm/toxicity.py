"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence is toxic with probability sigmoid(bias + sum of its distinct
words' weights); the document's probability is the noisy-or of its sentences. The weights are learnt from
document labels alone by maximising the likelihood of the labels, which are taken to be wrong at a small
fixed rate, so that long clean documents and stray labels don't raise the bias. The rarer toxic documents weigh more, up to
``most_weight`` times. The trained model
then scores every whole text and locates the sentences that carry the score.

The classifier is fitted on a bounded sample of the labelled rows (``positives`` and ``negatives``, in seeded
order) and on the ``features`` word features that tell the classes apart best; both bounds are parameters.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import stage

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
THRESHOLD = 0.7
SCORED = "doc_id long, score double, sentences array<struct<start:int,end:int,p:double>>"


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the training."""

    positives: int = 4000
    negatives: int = 8000
    features: int = 4096
    least_documents: int = 5
    rounds: int = 300
    rate: float = 0.05
    shrink: float = 2e-4
    wrong: float = 0.01
    most_weight: float = 4.0


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id's text modulo 3 is 1."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def features_of(word: str) -> list[str]:
    """The word itself, its first three to six letters and its last four."""
    return [f"={word}", *(f"{word[:n]}*" for n in range(3, 7) if len(word) >= n), f"*{word[-4:]}"]


def _distinct(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen[toxic].update({f for w in _distinct(text or "") for f in features_of(w)})
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][n] for n in names]), pa.array([seen[0][n] for n in names])], ["f", "pos", "neg"])


def _encode(known: dict[str, int]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                sentences = SENTENCE.findall((text or "").lower())
                bags = [[known[f] for w in set(WORD.findall(s)) for f in features_of(w) if f in known] for s in sentences]
                bags = [b for b in bags if b]
                rows.append((int(toxic), len(sentences) - len(bags), [len(b) for b in bags], [f for b in bags for f in b]))
            yield pd.DataFrame(rows, columns=["toxic", "plain", "sizes", "flat"])

    return run


def fit_noisy_or(toxic: np.ndarray, plain: np.ndarray, sizes: list[np.ndarray], flat: np.ndarray, start: np.ndarray, fit: Fit) -> tuple[np.ndarray, float]:
    """Weights and bias: ``sizes[i]`` are the feature counts of document i's sentences that have any,
    ``plain[i]`` counts its other sentences, ``flat`` lists all features in order."""
    bags = np.concatenate(sizes) if len(sizes) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(toxic)), [len(s) for s in sizes])
    row = np.repeat(np.arange(len(bags)), bags)
    x = np.concatenate([start, [-6.0]])
    m, v = np.zeros_like(x), np.zeros_like(x)
    e = fit.wrong
    more = float(np.clip((toxic == 0).sum() / max(1, (toxic == 1).sum()), 1.0, fit.most_weight))
    share = np.where(toxic == 1, more, 1.0)
    share /= max(1.0, share.sum())
    for t in range(1, fit.rounds + 1):
        w, b = x[:-1], x[-1]
        z = b + np.bincount(row, w[flat], minlength=len(bags))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p0 = 1 / (1 + math.exp(-max(-30.0, min(30.0, b))))
        clean = np.exp(np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(toxic)) + plain * math.log1p(-p0))
        q = e + (1 - 2 * e) * (1 - clean)
        outer = -(toxic / q - (1 - toxic) / (1 - q)) * (1 - 2 * e) * clean * share
        dz = outer[owner] * p
        grad = np.concatenate([np.bincount(flat, dz[row], minlength=len(w)), [dz.sum() + (outer * plain * p0).sum()]])
        grad[:-1] += fit.shrink * w
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        x = x - fit.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return x[:-1], float(x[-1])


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> tuple[dict[str, float], float]:
    """(weight by feature, bias) from labels(doc_id, toxic) of rows that aren't held out; ({}, -30) without both classes.

    An id enters the sample once: where rows share it, with the greatest of their texts and of its labels.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("o", F.xxhash64("doc_id"))
    pick = lambda c, n: known.where(F.col("toxic") == c).orderBy("o", "doc_id").limit(n)
    chosen = stage(pick(1, fit.positives).union(pick(0, fit.negatives)).select("doc_id", "toxic"), "toxic-chosen")
    sample = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").cast("int").alias("toxic")).select("text", "toxic").repartition(12), "toxic-sample")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return {}, -30.0
    odds = F.log((F.col("pos") + 0.5) / (n[1] + 1)) - F.log((F.col("neg") + 0.5) / (n[0] + 1))
    table = sample.mapInArrow(_count, "f string, pos long, neg long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    table = table.where(F.col("pos") + F.col("neg") >= fit.least_documents).withColumn("odds", odds)
    table = table.withColumn("z", F.abs(F.col("odds")) / F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5)))
    best = table.orderBy(F.desc("z"), "f").limit(fit.features).select("f", "odds").collect()
    names = [r["f"] for r in best]
    if not names:
        return {}, -30.0
    rows = sample.mapInPandas(_encode({f: i for i, f in enumerate(names)}), "toxic int, plain int, sizes array<int>, flat array<int>").toPandas()
    flat = np.concatenate([np.asarray(f, np.int64) for f in rows["flat"]])
    start = np.clip(np.array([r["odds"] for r in best]), -1.0, 4.0) / 2
    w, b = fit_noisy_or(rows["toxic"].to_numpy(float), rows["plain"].to_numpy(float), [np.asarray(s, np.int64) for s in rows["sizes"]], flat, start, fit)
    return {f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 1e-3}, b


class Scorer:
    """Scores texts; keeps the weights of words it has seen, up to a bound."""

    def __init__(self, weights: dict[str, float], bias: float, keep: int = 1 << 19):
        self.weights, self.bias, self.keep, self.words = weights, bias, keep, {}

    def weight(self, word: str) -> float:
        have = self.words.get(word)
        if have is None:
            if len(self.words) >= self.keep:
                self.words = {}
            have = self.words[word] = sum(self.weights.get(f, 0.0) for f in features_of(word))
        return have

    def score(self, text: str) -> tuple[float, list[dict]]:
        """Noisy-or of all sentences, and the spans of those that are likelier toxic than not."""
        lower = text.lower() if len(text.lower()) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        telling = {w for w in set(WORD.findall(lower)) if self.weight(w) != 0.0}
        found, clean = [], 0.0
        for m in SENTENCE.finditer(lower):
            z = self.bias + (sum(self.words.get(w, 0.0) if w in self.words else self.weight(w) for w in telling.intersection(WORD.findall(m[0]))) if telling else 0.0)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            clean += math.log1p(-min(p, 1 - 1e-12))
            if p >= 0.5:
                found.append({"start": m.start(), "end": m.end(), "p": p})
        return -math.expm1(clean), found


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in batches:
            out = [scorer.score(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in out], pa.float64()), pa.array([f for _, f in out], kind)], ["doc_id", "score", "sentences"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """doc_id, held_out, score, predicted (score of at least 0.7) and the offending ``sentences`` of every row.

    Null and empty texts score 0. Repeated rows are scored each. Without labelled rows of both classes every
    score is (nearly) 0. Only the text enters a score; other columns are ignored. Empty input, empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, fit))
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scored(model), SCORED)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "sentences")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic; all columns stay, whatever their names.

    Null and empty texts and rows without an id are scored like others (they aren't toxic) and repeated rows each; an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        at = names.index("text")
        for batch in batches:
            keep = [scorer.score(t or "")[0] < THRESHOLD for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
