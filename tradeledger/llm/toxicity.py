"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A bounded labelled sample is learned row by row in a task, with a rate for every coordinate and an L1
penalty that leaves few weights; they are broadcast as pairs of coordinate and weight. The sample may
be dealt out to several tasks, whose weights are averaged; one is more accurate for the default bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import HASHES, add_fields, mixed, odd_numbers, texts_of, windows
from tradeledger.llm.decontaminate import words_of
from tradeledger.llm.labelled import held_out, training_sample

#: Bits of a hashed coordinate.
BITS = 20


def coordinates(text: bytes | None) -> np.ndarray:
    """Coordinates of words, word pairs and pairs with one word between, with repeats."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.int64)
    hashes = HASHES.of(words)
    first, second = odd_numbers(21, 2)
    skips = mixed(hashes[:-2] * first + hashes[2:] * second) if len(hashes) > 2 else hashes[:0]
    every = np.concatenate([mixed(hashes), windows(hashes, 2), skips])
    return (every >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """Follow the regularised leader, one sparse binary row at a time."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)  # the last is the bias

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == 2**BITS, 0.0, self.l1)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def train(
    sample: DataFrame, shards: int = 1, epochs: int = 5, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0,
    l2: float = 0.0,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Coordinates, weights and bias: the mean over the shards, at most 2**BITS weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for text, y in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                rows.append((np.append(np.unique(coordinates(text)), 2**BITS), y))
        if not rows:
            return
        model = Ftrl(alpha, beta, l1, l2)
        for _ in range(epochs):
            for at, y in rows:
                model.learn(at, y)
        w = model.weights(np.arange(2**BITS + 1))
        at = np.flatnonzero(w)
        # Each shard also reports itself, for the mean.
        at, w = np.append(at, 2**BITS + 1), np.append(w[at], 1.0)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w, pa.float64())], names=["at", "w"])

    shard = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(shards))
    dealt = sample.withColumn("shard", shard).repartition(shards, "shard")
    dealt = dealt.sortWithinPartitions("shard", F.xxhash64("doc_id", F.lit(5))).select("text", "y")
    summed = dealt.mapInArrow(run, "at bigint, w double").groupBy("at").agg(F.sum("w").alias("w"))
    found = {r["at"]: r["w"] for r in summed.collect()}
    used = found.pop(2**BITS + 1, 1.0)
    bias = found.pop(2**BITS, 0.0) / used
    at = np.array(sorted(found), np.int64)
    return at, np.array([found[i] / used for i in at.tolist()], np.float64), bias


def score_toxicity(
    docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, bound: int = 20000, folds: int = 4,
    fold: int = 2, **options,
) -> DataFrame:
    """Columns ``keep`` (all by default) with held_out, score and predicted.

    Learned from at most ``bound`` labelled rows that are not held out; whole texts are scored. Empty
    and NULL texts get the bias alone, and 0.5 without any labels. Repeated rows get equal scores.
    ``predicted`` is 1 from a score of 0.3 on. Columns of docs with the new names are replaced.
    """
    found = train(training_sample(docs, labels, "toxic", folds, fold, bound), **options)
    sent = docs.sparkSession.sparkContext.broadcast(found)
    keep = list(docs.columns) if keep is None else keep
    keep = [c for c in keep if c.lower() not in ("held_out", "predicted")]

    def work(texts):
        at, w, bias = sent.value
        dense = _dense(at, w)
        sums = []
        for text in texts_of(texts):
            found = coordinates(text)
            found = np.unique(found[dense[found] != 0])
            sums.append(bias + dense[found].sum())
        return (1 / (1 + np.exp(-np.clip(np.array(sums, np.float64), -35, 35))),)

    scored = add_fields(docs, ["text"], keep, [("score", "double", pa.float64())], work)
    return scored.withColumn("held_out", held_out("doc_id", folds, fold)).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int")
    )


_DENSE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _dense(at: np.ndarray, w: np.ndarray) -> np.ndarray:
    """All coordinates of the weights last used by this worker."""
    key = id(at)
    if key not in _DENSE or _DENSE[key][0] is not at:
        _DENSE.clear()
        full = np.zeros(2**BITS)
        full[at] = w
        _DENSE[key] = (at, full)
    return _DENSE[key][1]
