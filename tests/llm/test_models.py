"""Votes and updates of the learned operators against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeledger.llm import quality, toxicity
from tradeledger.llm.batches import prepare

VOCABULARY = [f"w{i}" for i in range(60)] + ["Ünï", "A-b", "7", "x!"]


def texts(n, seed):
    pick = random.Random(seed)
    return [" ".join(pick.choices(VOCABULARY, k=pick.randrange(1, 40))) for _ in range(n)]


def test_votes_of_the_nearest_labelled_vectors():
    """Each text next to every labelled vector, one cosine at a time."""
    rng = np.random.default_rng(4)
    idf = rng.random(quality.WORDS).astype(np.float32)
    axes = rng.standard_normal((quality.TERMS, 6)).astype(np.float32)
    labelled = texts(40, 1)
    labels = rng.integers(0, 2, 40).astype(np.float32)

    def vector(text):
        row = quality.terms(text.encode()).astype(np.float64)
        words = row[: quality.WORDS] * idf
        row[: quality.WORDS] = words * quality.WORD_WEIGHT / max(math.sqrt((words * words).sum()), 1e-9)
        found = [sum(float(r) * float(a) for r, a in zip(row[row != 0], axes[row != 0, k])) for k in range(6)]
        size = math.sqrt(sum(x * x for x in found))
        return [x / size for x in found]

    vectors = [vector(t) for t in labelled]
    model = quality.Model(idf, axes, np.array(vectors, np.float32), labels, neighbours=7)
    asked = texts(30, 2)
    want = []
    for text in asked:
        mine = vector(text)
        cosines = [(sum(a * b for a, b in zip(mine, v)), y) for v, y in zip(vectors, labels)]
        near = sorted(cosines, reverse=True)[:7]
        weights = [max(c, 1e-6) for c, _ in near]
        want.append(sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights))
    assert model.scores([t.encode() for t in asked], block=8) == pytest.approx(want, abs=1e-4)
    share = labels.mean()
    assert model.scores([None, b"", b" \n"]).tolist() == [share] * 3


def test_coordinates_are_words_pairs_and_skips():
    words = ["one", "two", "three", "four"]
    found = toxicity.coordinates(" ".join(words).encode())
    assert len(found) == 4 + 3 + 2
    # A pair and the same words with one between are told apart.
    assert len(set(toxicity.coordinates(b"one two")) & set(toxicity.coordinates(b"one x two"))) == 2
    assert toxicity.coordinates(None).tolist() == toxicity.coordinates(b" .,").tolist() == []


@pytest.mark.parametrize("l1", [0.0, 0.3])
def test_updates_of_every_coordinate(spark, l1):
    """FTRL-proximal in dictionaries, one coordinate at a time, over the same rows in the same order."""
    prepare(spark)
    alpha, beta, l2, epochs = 0.7, 1.2, 0.05, 2
    rows = [(i, t, int("w1 " in t or "w7" in t)) for i, t in enumerate(texts(60, 3))] + [(900, None, 0), (901, "", 1)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, y int").repartition(3)
    at, weights, bias = toxicity.train(sample, epochs=epochs, alpha=alpha, beta=beta, l1=l1, l2=l2)
    order = [(r.text, r.y) for r in sample.orderBy(F.xxhash64("doc_id", F.lit(5))).collect()]
    z, n = {}, {}

    def weight(c):
        penalty = 0.0 if c == "bias" else l1
        if abs(z.get(c, 0.0)) <= penalty:
            return 0.0
        return -(z[c] - math.copysign(penalty, z[c])) / ((beta + math.sqrt(n[c])) / alpha + l2)

    for _ in range(epochs):
        for text, y in order:
            used = [*dict.fromkeys(toxicity.coordinates(text.encode() if text else None).tolist()), "bias"]
            held = {c: weight(c) for c in used}
            g = 1 / (1 + math.exp(-sum(held.values()))) - y
            for c in used:
                before = n.get(c, 0.0)
                sigma = (math.sqrt(before + g * g) - math.sqrt(before)) / alpha
                z[c] = z.get(c, 0.0) + g - sigma * held[c]
                n[c] = before + g * g
    want = {c: weight(c) for c in z if c != "bias" and weight(c)}
    assert set(at.tolist()) == set(want) and (l1 == 0 or len(want) < len(z) - 1)
    assert dict(zip(at.tolist(), weights.tolist())) == pytest.approx(want)
    assert bias == pytest.approx(weight("bias"))
