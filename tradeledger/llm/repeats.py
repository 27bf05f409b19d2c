"""Removal of long byte strings that occur more than once, by content-defined anchors.

No suffix array is built and nothing is sorted as text. A suffix is kept for each position whose 8 bytes have the least hash among those that follow some
start: every string of ``length`` bytes holds such an anchor, at the same place wherever it occurs.
A run of the family is grouped by a fingerprint of the first bytes of the suffix (all suffixes with
fewer in common are of no interest) and by one of its whole context, with the number of places and
one of them. New batches become runs of level 0; two runs of a level are merged into one of the next.
A merge adds up places, so at the end each context has its total. Suffixes of one fingerprint whose
contexts differ are compared window by window, which finds where their matches begin and end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import mixed, odd_numbers, pick, texts_of
from tradeledger.session import cut_lineage, drop_stage

#: Bytes a task hashes at a time; a longer text is hashed alone.
BLOCK_BYTES = 2_000_000

#: Contexts of one fingerprint that one task compares; windows of more are counted by hash over all tasks.
GROUP_CONTEXTS = 20_000


#: Words of a passage that is reported however few bytes it has, and of the windows that stand for it.
PASSAGE_WORDS, WINDOW_WORDS = 50, 26


class Prefixes:
    """Hashes of any substring of a byte array."""

    _table = odd_numbers(31, 256)
    _factor = odd_numbers(32, 1)[0]
    _inverse = np.uint64(pow(int(_factor), -1, 2**64))

    def __init__(self, data: np.ndarray):
        powers = np.full(len(data), self._factor, np.uint64)
        if len(data):
            powers[0] = 1
        np.cumprod(powers, out=powers)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._table[data] * powers, out=self.sums[1:])

    def _back(self, at: np.ndarray) -> np.ndarray:
        """The inverse factor to these powers, by squaring."""
        out, square, left = np.ones(len(at), np.uint64), self._inverse, at.astype(np.uint64)
        while left.any():
            out[(left & np.uint64(1)) == 1] *= square
            square = np.uint64(int(square) ** 2 % 2**64)
            left = left >> np.uint64(1)
        return out

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self._back(start) + (end - start).astype(np.uint64))

    def sliding(self, start: int, end: int, length: int) -> np.ndarray:
        """Hashes of the windows that begin at start, start + 1, ... end - 1."""
        at = np.arange(start, end)
        powers = np.full(end - start, self._inverse, np.uint64)
        powers[0] = self._back(np.array([start]))[0]
        np.cumprod(powers, out=powers)
        return mixed((self.sums[at + length] - self.sums[at]) * powers + np.uint64(length))


def anchors_of(data: np.ndarray, reach: int) -> np.ndarray:
    """For each start, the position of the least hash of 8 bytes among the next ``reach`` positions."""
    n = len(data) - 7
    grams = np.ndarray((n,), "<u8", buffer=data.tobytes(), strides=(1,))
    ranked = (mixed(grams * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    size = -(-n // reach) * reach
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = ranked
    blocks = padded.reshape(-1, reach)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - reach + 1
    least = np.minimum(after[:count], before[reach - 1 : reach - 1 + count])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def suffixes(texts: list[tuple[int, bytes]], length: int, reach: int):
    """Columns k, f, text, lo, hi: the starts lo to hi of a text share an anchor.

    k is the fingerprint of the suffix at the anchor, f that of all bytes of these windows.
    """
    data = np.frombuffer(b"".join(t for _, t in texts), np.uint8)
    sizes = np.array([len(t) for _, t in texts])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    starts = np.concatenate([np.arange(b, b + s - length + 1) for b, s in zip(begins, sizes, strict=True)])
    owner = np.repeat(np.arange(len(texts)), sizes - length + 1)
    anchor = anchors_of(data, reach)[starts]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.concatenate([new[1:], [len(starts)]]) - 1
    lo, hi, at, own = starts[new], starts[last], anchor[new], owner[new]
    prefix = Prefixes(data)
    k = prefix.of(at, at + length - reach + 1)
    f = prefix.of(lo, hi + length)
    names = np.array([name for name, _ in texts], np.int64)
    return k.view(np.int64), f.view(np.int64), names[own], lo - begins[own], hi - begins[own]


def _blocks(items: Iterator[tuple[int, bytes]], length: int) -> Iterator[list[tuple[int, bytes]]]:
    held, size = [], 0
    for name, text in items:
        if len(text) < length:
            continue
        held.append((name, text))
        size += len(text)
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def suffix_table(texts: DataFrame, length: int, reach: int) -> DataFrame:
    """The kept suffixes of rows (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True)

        for block in _blocks(items(), length):
            columns = suffixes(block, length, reach)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k", "f", "key", "lo", "hi"])

    long_enough = texts.where(F.octet_length("text") >= length)
    return long_enough.mapInArrow(run, "k bigint, f bigint, key bigint, lo bigint, hi bigint")


def _run_of(rows: DataFrame) -> DataFrame:
    """One row per context: how many places, and one of them."""
    return rows.groupBy("k", "f").agg(F.sum("places").alias("places"), F.min("place").alias("place"))


class IndexFamily:
    """Runs of contexts by level; equal levels merge, so a context is rewritten log(batches) times."""

    def __init__(self):
        self.levels: dict[int, DataFrame] = {}

    def add(self, suffix_rows: DataFrame) -> None:
        place = F.struct("key", "lo", "hi")
        run = _run_of(suffix_rows.select("k", "f", F.lit(1).cast("bigint").alias("places"), place.alias("place")))
        level = 0
        merged = []
        # A run that meets an equal level is merged before anything is written.
        while level in self.levels:
            merged.append(self.levels.pop(level))
            run = _run_of(run.unionByName(merged[-1]))
            level += 1
        self.levels[level] = cut_lineage(run)
        for old in merged:
            drop_stage(old)

    def scan(self) -> DataFrame:
        """All contexts with their places over all levels."""
        runs = list(self.levels.values())
        merged = runs[0]
        for run in runs[1:]:
            merged = merged.unionByName(run)
        return _run_of(merged) if len(runs) > 1 else merged


def contexts(texts: DataFrame, length: int) -> DataFrame:
    """One row per context listed in ``edges`` of rows (key, text, edges), with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, edges in zip(
                batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(2).to_pylist(), strict=True
            ):
                rows += [(key, e["k"], e["places"], e["lo"], text[e["lo"] : e["hi"] + length]) for e in edges]
            names = ["key", "k", "places", "lo", "bytes"]
            kinds = [*[pa.int64()] * 4, pa.binary()]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return texts.mapInArrow(run, "key bigint, k bigint, places bigint, lo bigint, bytes binary")


def window_rows(texts: DataFrame, length: int) -> DataFrame:
    """(hash, key, at, alone) for each window of the contexts listed in ``edges`` of rows (key, text, edges)."""

    def columns_of(key: int, text: bytes, edges: list[dict]):
        prefix = Prefixes(np.frombuffer(text, np.uint8))
        for e in edges:
            n = e["hi"] + 1 - e["lo"]
            hashes = prefix.sliding(e["lo"], e["hi"] + 1, length).view(np.int64)
            yield hashes, np.full(n, key, np.int64), np.arange(e["lo"], e["hi"] + 1), np.full(n, e["places"] == 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["hash", "key", "at", "alone"])

        held, size = [], 0
        for batch in batches:
            for row in zip(
                batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(2).to_pylist(), strict=True
            ):
                for part in columns_of(*row):
                    held.append(part)
                    size += len(part[0])
                    if size >= BLOCK_BYTES // 8:
                        yield out(held)
                        held, size = [], 0
        if held:
            yield out(held)

    return texts.mapInArrow(run, "hash bigint, key bigint, at bigint, alone boolean")


def count_windows(windows: DataFrame) -> DataFrame:
    """(key, lo, hi) as ``compare`` gives them, from window rows counted by hash: no task holds a fingerprint."""
    several = windows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hit = windows.where("alone").join(several, "hash", "left_semi")
    return hit.select("key", F.col("at").alias("lo"), F.col("at").alias("hi"))


def _repeated(rows: list[tuple], length: int):
    """Starts of windows found in more than one place among the contexts, as ranges of the text."""
    data = np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8)
    sizes = np.array([len(r["bytes"]) for r in rows])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    counts = sizes - length + 1
    at = np.concatenate([np.arange(b, b + c) for b, c in zip(begins, counts, strict=True)])
    own = np.repeat(np.arange(len(rows)), counts)
    hashes = Prefixes(data).sliding(0, len(data) - length + 1, length)[at]
    _, where, n = np.unique(hashes, return_inverse=True, return_counts=True)
    alone = np.array([r["places"] == 1 for r in rows])[own]
    hit = (n[where] > 1) & alone
    at, own = at[hit], own[hit]
    if not len(at):
        return []
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (own[1:] != own[:-1])]))
    last = np.concatenate([cut[1:], [len(at)]]) - 1
    shift = np.array([r["lo"] for r in rows])[own] - begins[own]
    keys = np.array([r["key"] for r in rows])[own]
    return list(zip(keys[cut].tolist(), (at + shift)[cut].tolist(), (at + shift)[last].tolist(), strict=True))


def compare(found: DataFrame, length: int) -> DataFrame:
    """(key, lo, hi): starts of windows of single contexts that other contexts hold too."""
    sized = found.repartition("k").sortWithinPartitions("k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            made = _repeated(rows, length)
            columns = list(zip(*made, strict=True)) if made else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "lo", "hi"])

        held, size, group = [], 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if size >= BLOCK_BYTES // 2 and row["k"] != group:
                    yield out(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
                group = row["k"]
        if held:
            yield out(held)

    return sized.mapInArrow(run, "key bigint, lo bigint, hi bigint")


def least_of(values: np.ndarray, span: int) -> np.ndarray:
    """Distinct minima of all runs of ``span`` values."""
    if len(values) < span:
        return values[:0]
    low, size = values, 1
    while 2 * size <= span:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    count = len(values) - span + 1
    return np.unique(np.minimum(low[:count], low[span - size : span - size + count]))


_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_windows(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words of the texts, in order, and where those of each text begin.

    Words lie between ASCII blanks, whatever their number. A run is hashed by its bytes without them.
    """
    data = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
    solid = ~_BLANK[data]
    first = solid & ~np.concatenate([[False], solid[:-1]])
    places = np.cumsum(solid) - 1
    at = np.flatnonzero(first)
    begins = np.searchsorted(at, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]))
    data = data[solid]
    edges = np.append(places[at], len(data))
    prefix = Prefixes(data)
    # Words that start a run which stays in their text.
    words = np.diff(begins)
    runs = np.maximum(words - n + 1, 0)
    firsts = np.concatenate([[0], np.cumsum(runs)])
    which = np.arange(firsts[-1]) + np.repeat(begins[:-1] - firsts[:-1], runs)
    start, end = edges[which], edges[which + n]
    back = np.full(len(data) + 1, Prefixes._inverse, np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    return mixed((prefix.sums[end] - prefix.sums[start]) * back[start] + (end - start).astype(np.uint64)), firsts


def passage_windows(texts: DataFrame, words: int, window: int) -> DataFrame:
    """(key, hash) of rows (key, text): windows of ``window`` words, so many that every run of ``words`` words holds one.

    Of neighbouring windows the one of least hash is taken, wherever the run occurs. Words lie between ASCII
    blanks. A row has each hash once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = word_windows(texts_of(batch.column(1)), window)
            found = [least_of(values[a:b], words - window + 1) for a, b in zip(at[:-1], at[1:])]
            keys = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(x) for x in found])
            hashes = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(hashes)], names=["key", "hash"])

    return texts.mapInArrow(run, "key bigint, hash bigint")


def shared_passages(texts: DataFrame, words: int, window: int) -> DataFrame:
    """(key, n_shared) of rows (key, text): the taken windows of a text that more than one row holds.

    Windows are computed twice instead of being written: only their counts are shuffled, and the list of those
    held more than once is written, so that Spark joins it by its size.
    """
    held = passage_windows(texts, words, window)
    several = cut_lineage(held.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"))
    hits = held.join(several, "hash", "left_semi")
    return cut_lineage(hits.groupBy("key").agg(F.count_distinct("hash").alias("n_shared")))


def _kept(text: bytes, ranges: list[tuple[int, int]], length: int) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs and the bytes left, for ranges of window starts."""
    runs: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi + length)
        else:
            runs.append([lo, hi + length])
    left, at = [], 0
    for start, end in runs:
        left.append(text[at:start])
        at = end
    left.append(text[at:])
    kept = b"".join(left)
    return len(text) - len(kept), len(runs), kept


def remove_repeats(
    docs: DataFrame, length: int = 400, reach: int = 300, batches: int = 4, id_column: str = "doc_id",
    group: int = GROUP_CONTEXTS, digest: bool = False,
) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept (the remaining bytes), n_shared.

    With ``digest`` the SHA-256 of the remaining bytes (``kept_sha256``, lowercase hex) replaces them,
    so that whole texts need not be written again.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else, in any text or the
    same one, overlaps included; strings are judged on the input. A NULL text counts as empty, shorter
    texts than ``length`` stay whole, repeated rows remove each other, a NULL id is kept as it is. Equal
    texts have equal results, so the work is joined by text hash. Substrings are compared by 64-bit
    hashes. The remaining bytes need not be valid UTF-8.

    A passage that repeats in fewer than ``length`` bytes is left in the text, but reported: ``n_shared`` counts
    the windows of ``WINDOW_WORDS`` words, of those that stand for passages of ``PASSAGE_WORDS`` words, that other
    rows hold too. It is positive wherever rows share such a passage, and 0 where they share no window.

    Contexts of a fingerprint that has at most ``group`` of them meet in one task; the windows of more are
    counted by hash over all tasks.
    """
    if length < reach + 7:
        raise ValueError("length must exceed reach by the 8 bytes that an anchor is chosen by")
    rows = pick(docs, id_column, "text")
    rows = rows.select(F.col(id_column).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text", F.octet_length("text")))
    stage = cut_lineage(suffix_table(rows.select("key", "text"), length, reach))
    family = IndexFamily()
    for i in range(batches):
        family.add(stage.where(F.pmod("key", F.lit(batches)) == i))
    index = family.scan()
    several = index.groupBy("k").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1")
    repeated = stage.join(index.where("places > 1").select("k", "f"), ["k", "f"], "left_semi")
    whole = repeated.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    place = F.struct("k", "places", "place.lo", "place.hi")
    edges = index.join(several, "k").select("place.key", (F.col("contexts") > group).alias("large"), place.alias("e"))
    edges = edges.groupBy("key").agg(
        F.collect_list(F.when(~F.col("large"), F.col("e"))).alias("edges"),
        F.collect_list(F.when(F.col("large"), F.col("e"))).alias("many"),
    )
    edges = edges.select("key", *(F.when(F.size(c) > 0, F.col(c)).alias(c) for c in ("edges", "many")))
    shared = shared_passages(rows.select("key", "text"), PASSAGE_WORDS, WINDOW_WORDS)
    listed = whole.join(edges, "key", "full").join(shared, "key", "full")
    met = rows.join(listed, "key", "left")
    touched = F.col("ranges").isNotNull() | F.col("edges").isNotNull() | F.col("many").isNotNull()
    data = F.col("text").cast("binary")
    done = F.when(~touched, F.sha2(data, 256) if digest else data)
    met = cut_lineage(
        met.select("id", "key", F.octet_length("text").cast("bigint").alias("n_bytes"), done.alias("whole"),
                   F.when(touched, F.col("text")).alias("text"), "ranges", "edges", "many",
                   F.coalesce("n_shared", F.lit(0)).alias("n_shared"))
    )
    # Equal texts need to be compared once.
    open_texts = met.where("edges is not null").select("key", "text", "edges").dropDuplicates(["key"])
    many_texts = met.where("many is not null").select("key", "text", F.col("many").alias("edges")).dropDuplicates(["key"])
    windows = cut_lineage(window_rows(many_texts, length))
    hits = compare(contexts(open_texts, length), length).union(count_windows(windows))
    more = hits.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("more"))
    final = met.where("text is not null").join(more, "key", "left")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            removed, spans, left = [], [], []
            lists = (part.column(i).to_pylist() for i in (3, 4))
            for text, *ranges in zip(texts_of(part.column(2)), *lists, strict=True):
                found = [(x["lo"], x["hi"]) for one in ranges for x in one or ()]
                n, runs, kept = _kept(text, found, length)
                removed.append(n)
                spans.append(runs)
                left.append(hashlib.sha256(kept).hexdigest() if digest else kept)
            arrays = [part.column(0), part.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())]
            arrays += [pa.array(left, pa.string() if digest else pa.binary()), part.column(5)]
            names = ["id", "n_bytes", "n_removed", "n_spans", result, "n_shared"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    result = "kept_sha256" if digest else "kept"
    kind = rows.schema["id"].dataType.simpleString()
    left_kind = "string" if digest else "binary"
    changed = final.select("id", "n_bytes", "text", "ranges", "more", "n_shared").mapInArrow(
        run, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, {result} {left_kind}, n_shared bigint"
    )
    zero = F.lit(0).cast("bigint")
    same = met.where("text is null").select("id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"),
                                            F.col("whole").alias(result), "n_shared")
    return changed.union(same).withColumnRenamed("id", id_column)
