"""Quality by nearest-neighbour voting over latent-semantic vectors.

Texts become weighted counts of hashed words and word shapes; a truncated singular value
decomposition of a labelled sample gives the latent axes. Words weigh by their rarity among all documents. The
labelled vectors are broadcast, every document is compared with all of them block by block, and its
nearest ones vote with their cosine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import CACHE_WORDS, add_fields, pick, texts_of
from tradeledger.llm.labelled import held_out, training_sample

WORDS, SHAPES = 4096, 1024
#: After words and shapes: words equal to the one before, and distinct words.
TERMS = WORDS + SHAPES + 2

#: Share of the words' part against that of the shapes.
WORD_WEIGHT = 0.4

#: Longest word, in bytes, that a worker remembers.
CACHE_BYTES = 64

# A for upper case, a for lower case and bytes beyond ASCII, 0 for digits.
_KINDS = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


class TermCodes(dict):
    """Bucket and shape of a word in one number; a shape keeps marks and shortens runs of letters."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        shape = _RUN.sub(rb"\1", word.translate(_KINDS))
        bucket = xxhash.xxh3_64_intdigest(word.lower()) % WORDS
        found = bucket * SHAPES + xxhash.xxh3_64_intdigest(shape) % SHAPES
        if len(word) <= CACHE_BYTES:
            self[word] = found
        return found


CODES = TermCodes()


def terms(text: bytes | None) -> np.ndarray:
    """Logarithmic counts of word buckets, then square roots of the shares of shapes."""
    out = np.zeros(TERMS, np.float32)
    words = text.split() if text else []
    if not words:
        return out
    codes = np.fromiter(map(CODES.__getitem__, words), np.int64, len(words))
    out[:WORDS] = np.log1p(np.bincount(codes // SHAPES, minlength=WORDS))
    out[WORDS : WORDS + SHAPES] = np.sqrt(np.bincount(codes % SHAPES, minlength=SHAPES) / len(codes))
    same = codes[1:] == codes[:-1]
    out[-2] = np.sqrt(same.mean()) if len(same) else 0
    out[-1] = np.sqrt(len(np.unique(codes)) / len(codes)) / 2
    return out


def weighed(matrix: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows with words by rarity and of length WORD_WEIGHT, shapes of about 1."""
    out = matrix.copy()
    out[:, :WORDS] *= idf
    norm = np.linalg.norm(out[:, :WORDS], axis=1, keepdims=True)
    out[:, :WORDS] *= WORD_WEIGHT / np.maximum(norm, 1e-9)
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    """Axes and labelled vectors; its size follows the sample's bound, not the corpus."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def scores(self, texts: list[bytes | None], block: int = 256) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors."""
        out = np.full(len(texts), self.labels.mean() if len(self.labels) else 0.5)
        k = min(self.neighbours, len(self.labels))
        for i in range(0, len(texts) if k else 0, block):
            rows = np.stack([terms(t) for t in texts[i : i + block]])
            full = rows.any(axis=1)
            cosines = _unit(weighed(rows, self.idf) @ self.axes) @ self.vectors.T
            near = np.argpartition(cosines, len(self.labels) - k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6)
            votes = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
            out[i : i + block][full] = votes[full]
        return out


def rarity(docs: DataFrame) -> np.ndarray:
    """Logarithm of the number of texts over those that hold a word of the bucket, over all documents.

    Each task counts its own texts, so one row per task and bucket is shuffled and one per bucket collected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(WORDS + 1, np.int64)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                words = set(text.split()) if text else ()
                if words:
                    codes = np.fromiter(map(CODES.__getitem__, words), np.int64, len(words))
                    held[np.unique(codes // SHAPES)] += 1
                    held[WORDS] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(WORDS + 1)), pa.array(held)], names=["bucket", "n"])

    counts = pick(docs, "text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    seen = np.zeros(WORDS + 1)
    for row in counts.collect():
        seen[row["bucket"]] = row["n"]
    return np.log((1 + seen[WORDS]) / (1 + seen[:WORDS])).astype(np.float32)


def fit(sample: DataFrame, idf: np.ndarray, axes: int = 48, neighbours: int = 21, seed: int = 7) -> Model:
    """Latent axes by randomised subspace iteration over the rows of a bounded sample; ``idf`` of ``rarity``."""
    def work(texts):
        at, values = [], []
        for text in texts_of(texts):
            row = terms(text)
            at.append(np.flatnonzero(row).astype("<i4").tobytes())
            values.append(row[row != 0].astype("<f4").tobytes())
        return at, values

    fields = [("at", "binary", pa.binary()), ("value", "binary", pa.binary())]
    rows = add_fields(sample, ["text"], ["doc_id", "y"], fields, work).orderBy("doc_id").collect()
    matrix = np.zeros((len(rows), TERMS), np.float32)
    for i, r in enumerate(rows):
        matrix[i, np.frombuffer(r["at"], "<i4")] = np.frombuffer(r["value"], "<f4")
    labels = np.array([r["y"] for r in rows], np.float32)
    matrix = weighed(matrix, idf)
    start = np.random.default_rng(seed).standard_normal((TERMS, min(axes + 8, TERMS))).astype(np.float32)
    basis = start
    if len(rows):
        for _ in range(4):
            basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
        _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
        basis = (basis @ turn.T)[:, :axes]
    basis = np.ascontiguousarray(basis[:, :axes], np.float32)
    return Model(idf, basis, _unit(matrix @ basis).astype(np.float32), labels, neighbours)


def score_quality(
    docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, bound: int = 6000, folds: int = 5, fold: int = 0
) -> DataFrame:
    """Columns ``keep`` (all by default) with held_out, score and predicted.

    The model is fitted on at most ``bound`` labelled rows that are not held out, words weigh by the
    number of all documents that hold them; every text is then scored in whole. Empty and NULL texts, and texts without any known term, get the sample's share of
    label 1; without labels every score is 0.5. Repeated rows get equal scores. ``predicted`` is 1
    from a score of 0.3 on. Columns of docs with the new names are replaced.
    """
    model = fit(training_sample(docs, labels, "quality", folds, fold, bound), rarity(docs))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = list(docs.columns) if keep is None else keep
    keep = [c for c in keep if c.lower() not in ("held_out", "predicted")]

    def work(texts):
        return (sent.value.scores(texts_of(texts)),)

    scored = add_fields(docs, ["text"], keep, [("score", "double", pa.float64())], work)
    return scored.withColumn("held_out", held_out("doc_id", folds, fold)).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int")
    )
