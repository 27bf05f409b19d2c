"""Hierarchical multi-length packing of tokenized documents.

A document is routed to the smallest context size that holds it; what exceeds the largest size fills
whole windows of it. Each task packs its rows tier by tier, the longest first: a window starts with a
document of its tier and its gap is filled from shorter tiers, whole documents that fit best first,
then a cut one. Every window is full, so none is padded; what is left at the end of a task is cut at
powers of two. Step groups then get equal numbers of tokens of one tier.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeledger.llm.batches import pick, texts_of
from tradeledger.session import cut_lineage

TIERS = (256, 512, 1024, 2048)

#: Tokens a task packs at a time.
CHUNK_TOKENS = 1_000_000

#: Text pieces whose ids a worker remembers.
CACHE_CHUNKS = 500_000

# Letters whose lower case and composition are plain, then ASCII marks other than the apostrophe.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


def _byte_names() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b if b in shown else 256 + hidden.index(b)) for b in range(256)]


class ChunkIds(dict):
    """Ids of text between blanks as little-endian 32-bit values.

    The tokenizer drops white space, so the ids of a text are those of its chunks. ``plain`` says that
    it lowers case and splits letters from marks, so that simple chunks need only its merges.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.names = _byte_names()
        self.parts: dict[str, bytes] = {"": b""}

    def part(self, text: str) -> bytes:
        found = self.parts.get(text)
        if found is None:
            if len(self.parts) >= CACHE_CHUNKS:
                self.parts = {"": b""}
            shown = text if text.isascii() else "".join(self.names[b] for b in text.encode())
            found = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
            self.parts[text] = found
        return found

    def __missing__(self, chunk: bytes) -> bytes:
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        text = chunk.decode()
        simple = _PLAIN.fullmatch(text)
        if simple:
            found = self.part(simple[1].lower()) + self.part(simple[2])
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = np.array(ids, "<u4").tobytes()
        self[chunk] = found
        return found

    def of(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.replace(b"\n", b" ").split(b" ")))


_LOADED: dict[int, ChunkIds] = {}


def _ids_of(definition: str) -> ChunkIds:
    """One tokenizer per worker, kept between tasks."""
    key = hash(definition)
    if key not in _LOADED:
        _LOADED[key] = ChunkIds(definition)
    return _LOADED[key]


class Pool:
    """Pieces (document, start, length) that wait for a place, by length."""

    def __init__(self, pieces: list[tuple[int, int, int]]):
        self.pieces = sorted(pieces, key=lambda p: p[2])
        self.lengths = [p[2] for p in self.pieces]

    def __len__(self) -> int:
        return len(self.pieces)

    def take(self, at: int) -> tuple[int, int, int]:
        self.lengths.pop(at)
        return self.pieces.pop(at)

    def put(self, piece: tuple[int, int, int]) -> None:
        at = bisect_left(self.lengths, piece[2])
        self.lengths.insert(at, piece[2])
        self.pieces.insert(at, piece)

    def fill(self, gap: int) -> list[tuple[int, int, int]]:
        """Pieces for a gap: the longest that fit, then the start of the shortest that does not."""
        out = []
        while gap > 0 and self.pieces:
            at = bisect_right(self.lengths, gap) - 1
            doc, start, length = self.take(max(at, 0))
            used = min(length, gap)
            if used < length:
                self.put((doc, start + used, length - used))
            out.append((doc, start, used))
            gap -= used
        return out


def pack(pieces: list[tuple[int, int, int]], tiers: tuple[int, ...]):
    """Full windows as (tier, pieces), and the pieces left when none can be filled."""
    windows, rest = [], []
    longest = max(tiers)
    for doc, start, length in pieces:
        while length >= longest:
            windows.append((longest, [(doc, start, longest)]))
            start, length = start + longest, length - longest
        if length:
            rest.append((doc, start, length))
    pool, total = Pool(rest), sum(p[2] for p in rest)
    for tier in sorted(tiers, reverse=True):
        shorter = max((t for t in tiers if t < tier), default=0)
        while total >= tier and pool.pieces and pool.lengths[-1] > shorter:
            doc, start, length = pool.take(len(pool) - 1)
            used = min(length, tier)
            if used < length:  # A longer tier could not be filled any more.
                pool.put((doc, start + used, length - used))
            windows.append((tier, [(doc, start, used), *pool.fill(tier - used)]))
            total -= tier
    return windows, pool.pieces


def powers(pieces: list[tuple[int, int, int]], longest: int):
    """The pieces one after another in windows of a power of two, long ones first."""
    total, windows, at = sum(p[2] for p in pieces), [], 0
    queue = list(pieces)
    while total:
        size = min(longest, 1 << (total.bit_length() - 1))
        window, need = [], size
        while need:
            doc, start, length = queue[at]
            used = min(length, need)
            window.append((doc, start, used))
            need -= used
            if used == length:
                at += 1
            else:
                queue[at] = (doc, start + used, length - used)
        windows.append((size, window))
        total -= size
    return windows


def pack_documents(
    docs: DataFrame, definition: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS, id_column: str = "doc_id"
) -> DataFrame:
    """Rows of pieces: id, start, length, ids, doc_tokens, sequence_id, offset, tier, number.

    ``definition`` is the JSON of a tokenizer that drops white space and lowers case; every document is
    its ids and ``end_id``. A NULL or empty text has ``end_id`` alone. ``ids`` holds little-endian
    unsigned 32-bit values. Each id lies in one piece, pieces of a sequence lie without gaps from
    offset 0, and every sequence is a power of two long. ``number`` counts the sequences of a tier in a
    task. Repeated rows are packed each.

    Rows stay in their tasks: no shuffle, and a task holds about ``CHUNK_TOKENS`` tokens.
    """
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    rows = pick(docs, id_column, "text")
    kind = rows.schema[0].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()
    longest = max(tiers)
    schema = (
        f"`{id_column}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, tier int, number bigint"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _ids_of(sent.value)
        sequence = TaskContext.get().partitionId() << 36
        held: dict[int, tuple[object, bytes]] = {}  # number in the task: id, ids
        waiting: list[tuple[int, int, int]] = []
        made: Counter[int] = Counter()  # sequences of each tier so far
        number, tokens, id_type = 0, 0, None

        def rows_of(windows) -> pa.RecordBatch:
            nonlocal sequence
            out = [[] for _ in range(9)]
            for tier, pieces in windows:
                offset = 0
                for doc, start, length in pieces:
                    name, ids = held[doc]
                    piece = ids[4 * start : 4 * (start + length)]
                    row = (name, start, length, piece, len(ids) // 4, sequence, offset, tier, made[tier])
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    offset += length
                sequence += 1
                made[tier] += 1
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            names = [id_column, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "number"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for name, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                ids = (encode.of(text) if text else b"") + end
                held[number] = (name, ids)
                waiting.append((number, 0, len(ids) // 4))
                tokens += len(ids) // 4
                number += 1
                if tokens >= CHUNK_TOKENS:
                    windows, waiting = pack(waiting, tiers)
                    yield rows_of(windows)
                    held = {p[0]: held[p[0]] for p in waiting}
                    tokens = sum(p[2] for p in waiting)
        if waiting:
            windows, waiting = pack(waiting, tiers)
            yield rows_of(windows + powers(waiting, longest))

    return rows.mapInArrow(run, schema)


def balance_steps(pieces: DataFrame, step_tokens: int = 65536) -> DataFrame:
    """``step`` in place of ``number``: sequences of one tier in groups of ``step_tokens`` tokens, over all tasks.

    ``pieces`` must be written, as its sequence ids must not change. Sequences are numbered where they
    are packed, so only one row per task and tier, the first number of each, is shuffled; it is written,
    and joined by its size.
    """
    task = F.shiftright("sequence_id", 36).alias("task")
    counts = pieces.where(F.col("offset") == 0).groupBy("tier", task).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tier").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut_lineage(counts.select("tier", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    per_step = F.greatest(F.lit(1).cast("bigint"), F.expr(f"{step_tokens} div tier"))
    step = F.floor((F.col("first") + F.col("number")) / per_step).cast("bigint")
    met = pieces.withColumn("task", task).join(starts, ["tier", "task"])
    return met.select(*[c for c in pieces.columns if c != "number"], step.alias("step"))


def pack_with_steps(docs: DataFrame, definition: str, step_tokens: int = 65536, **options) -> DataFrame:
    """Packed pieces with ``ids_crc32`` in place of the ids, and their step groups."""
    pieces = pack_documents(docs, definition, **options)
    return balance_steps(cut_lineage(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")), step_tokens)
