"""Shared steps of the text operators: columns by exact name, Arrow batches, word hashes."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tradeledger

#: Rows an Arrow batch may hold, so that a batch of long texts stays small.
BATCH_ROWS = 500

#: Words a worker remembers; beyond it the memory starts anew.
CACHE_WORDS = 400_000


_SENT: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches for tables of texts, and this package on the workers' path.

    The package is sent by Spark as a zip file of its sources, once per application, so executors
    need not have it installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    application, root = spark.sparkContext.applicationId, os.path.dirname(tradeledger.__file__)
    if application in _SENT or not os.path.isdir(root):
        return
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), "tradeledger_sources.zip")
    with zipfile.ZipFile(path, "w") as sources:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    sources.write(file, os.path.relpath(file, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SENT.add(application)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """These columns by exact name, also where others differ only in case or share a name."""
    found = df.columns
    lost = [n for n in names if n not in found]
    if lost:
        raise ValueError(f"columns {lost} are missing, there are {found}")
    plain = df.toDF(*(f"c{i}" for i in range(len(found))))
    return plain.select(*(F.col(f"c{found.index(n)}").alias(n) for n in names))


def texts_of(column: pa.Array) -> list[bytes | None]:
    """Strings of a batch as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


Field = tuple[str, str, pa.DataType]


def add_fields(
    df: DataFrame, inputs: list[str], keep: list[str], fields: list[Field], work: Callable[..., Iterable]
) -> DataFrame:
    """Columns ``keep`` and the new ``fields``; ``work`` gets the input arrays of a batch.

    It returns one list or array per field with a value for each row. A kept column of the name of
    a new one is left out.
    """
    names = {f[0].lower() for f in fields}
    keep = [c for c in keep if c.lower() not in names]
    read = list(dict.fromkeys([*inputs, *keep]))
    rows = pick(df, *read)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"`{n}` {ddl}" for n, ddl, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(*(batch.column(c) for c in inputs))
            arrays = [batch.column(c) for c in keep]
            arrays += [
                x if isinstance(x, pa.Array) else pa.array(x, kind)
                for x, (_, _, kind) in zip(made, fields, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *(f[0] for f in fields)])

    return rows.mapInArrow(run, schema)


class WordHashes(dict):
    """64-bit hashes of words, each computed once while the worker remembers it."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


HASHES = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(seed: int, n: int) -> np.ndarray:
    """Fixed odd multipliers from a seed."""
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words, by order of position."""
    if len(hashes) < n:
        return hashes[:0]
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for i, factor in enumerate(odd_numbers(11, n)):
        total += hashes[i : len(hashes) - n + 1 + i] * factor
    return mixed(total)
