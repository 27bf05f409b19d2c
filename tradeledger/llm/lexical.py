"""Ranked lexical search by range-maximum tables over posting lists.

Documents are indexed block by block: every term of the queries has a posting list (document, impact) in a
block, and a sparse table that names the list's greatest impact in any range. A search starts with one
interval, the whole block. The sum over the query's terms of the greatest impact inside an interval bounds the
score of every document there. The intervals of highest bound are taken first: each is split at the
document of its greatest single impact, that document is scored in full, and both sides come back
with bounds of their own. Intervals that cannot beat the k-th best document so far are dropped, and
the search of a block ends when none is left. A task carries its best documents from block to block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeledger.llm.batches import pick, texts_of
from tradeledger.session import cut_lineage

#: Postings of a block of documents; a document with more is a block of its own.
BLOCK_POSTINGS = 1_000_000

#: Terms (with repeats over queries) that are searched for at a time; more queries are searched in rounds.
ROUND_TERMS = 500_000

#: Intervals split in one step.
STEP = 256

# Lower case for A-Z, a blank for other ASCII characters that are no digits or letters.
_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of letters, digits and characters beyond ASCII; A-Z lower-cased."""
    return text.translate(_TERMS).split()


# ------------------------------------------------------------------ index of a block


class Block:
    """Posting lists of a block's documents with their range-maximum tables.

    ``term`` and ``doc`` (places in ``ids``) are sorted by term, then document; ``impact`` is positive.
    """

    def __init__(self, ids: np.ndarray, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int):
        self.ids, self.term, self.doc, self.impact = ids, term, doc, impact
        self.size = len(ids)
        self.keys = term * np.int64(self.size) + doc
        self.starts = np.searchsorted(term, np.arange(terms + 1))
        longest = int(np.diff(self.starts).max(initial=0))
        self.log = np.zeros(longest + 2, np.int64)
        self.log[2:] = np.floor(np.log2(np.arange(2, longest + 2))).astype(np.int64)
        # Entry j, i: place of the greatest of 2**j impacts from place i on. Lists are never crossed by a question.
        table = [np.arange(len(term), dtype=np.int32)]
        for j in range(int(self.log[longest])):
            half, low = 1 << j, table[-1]
            high = np.append(low[half:], np.full(min(half, len(low)), len(low) - 1, np.int32))
            table.append(np.where(impact[high] > impact[low], high, low))
        self.table = np.stack(table)

    def greatest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Place of the greatest impact in each range [lo, hi) of postings; any place where it is empty."""
        level = self.log[np.maximum(hi - lo, 0)]
        last = len(self.term) - 1
        one = self.table[level, np.minimum(lo, last)]
        two = self.table[level, np.clip(hi - (1 << level), 0, last)]
        return np.where(self.impact[two] > self.impact[one], two, one)

    def maxima(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Greatest impact in each range, 0 where it is empty."""
        return np.where(hi > lo, self.impact[self.greatest(lo, hi)], 0)


class Best:
    """The k best documents of a query so far: score descending, then id ascending, a NULL id last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    @property
    def full(self) -> bool:
        return len(self.scores) == self.k

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = scores > 0
        if self.full:
            some &= (scores > self.scores[-1]) | ((scores == self.scores[-1]) & (ids < self.ids[-1]))
        if some.any():
            scores, ids = np.append(self.scores, scores[some]), np.append(self.ids, ids[some])
            order = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]

    def open(self, bounds: np.ndarray, least_ids: np.ndarray) -> np.ndarray:
        """Which intervals may hold a document that belongs to the best."""
        if not self.full:
            return bounds > 0
        return (bounds > self.scores[-1]) | ((bounds == self.scores[-1]) & (least_ids < self.ids[-1]))


def search(block: Block, query: np.ndarray, best: Best, step: int = STEP) -> int:
    """Offer ``best`` every document of the block that can belong to it; ``query`` has distinct terms.

    Documents of a block lie in the order of their ids, so the first of an interval has the least. Returns the
    number of intervals that were split.
    """
    starts, ends = block.starts[query], block.starts[query + 1]
    query = query[ends > starts]
    if not len(query):
        return 0
    low, high = block.starts[query][None, :], block.starts[query + 1][None, :]
    first, stop = np.zeros(1, np.int64), np.full(1, block.size)
    bound = block.maxima(low, high).sum(axis=1)
    splits = 0
    while True:
        keep = np.flatnonzero(best.open(bound, block.ids[np.minimum(first, block.size - 1)]) & (stop > first))
        if not len(keep):
            return splits
        # The highest bounds next; among equal ones those of the smaller ids.
        order = keep[np.lexsort((first[keep], -bound[keep]))]
        now, later = order[:step], order[step:]
        parts = [tuple(x[later] for x in (first, stop, low, high, bound))]
        parts += _split(block, query, first[now], stop[now], low[now], high[now], best)
        splits += len(now)
        first, stop, low, high, bound = (np.concatenate(x) for x in zip(*parts, strict=True))


def _split(block: Block, query: np.ndarray, first, stop, low, high, best: Best):
    """Both sides of each interval without the document of its greatest impact, which is scored."""
    place = block.greatest(low, high)
    value = np.where(high > low, block.impact[place], 0)
    rows = np.arange(len(low))
    middle = block.doc[place[rows, value.argmax(axis=1)]]
    at = np.searchsorted(block.keys, query[None, :] * np.int64(block.size) + middle[:, None])
    found = (at < high) & (block.doc[np.minimum(at, len(block.doc) - 1)] == middle[:, None])
    best.offer(np.where(found, block.impact[np.minimum(at, len(block.doc) - 1)], 0).sum(axis=1), block.ids[middle])
    left = (first, middle, low, at)
    right = (middle + 1, stop, at + found, high)
    return [(*side, block.maxima(side[2], side[3]).sum(axis=1)) for side in (left, right)]


# ------------------------------------------------------------------ the whole table


def _posting_blocks(docs: DataFrame, vocabulary: list[bytes], block_postings: int) -> DataFrame:
    """Written rows, one per block: ids, lengths, postings (term, doc, times) and the block's documents per term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: i for i, term in enumerate(sent.value)}
        ids: list[int | None] = []
        lengths: list[int] = []
        terms: list[np.ndarray] = []
        times: list[np.ndarray] = []
        held = words = filled = 0

        def block() -> pa.RecordBatch:
            named = np.array([i is not None for i in ids])
            numbers = np.array([0 if i is None else i for i in ids], np.int64)
            order = np.lexsort((numbers, ~named))
            new = np.empty(len(ids), np.int64)
            new[order] = np.arange(len(ids))
            doc = np.repeat(new, [len(t) for t in terms])
            term, n = np.concatenate(terms), np.concatenate(times)
            sort = np.lexsort((doc, term))
            used, documents = np.unique(term, return_counts=True)
            blobs = (numbers[order], named[order], np.array(lengths, np.int64)[order], term[sort], doc[sort], n[sort])
            kinds = ("<i8", "u1", "<i8", "<i4", "<i4", "<i8")
            arrays = [pa.array([x.astype(kind).tobytes()], pa.binary()) for x, kind in zip(blobs, kinds, strict=True)]
            arrays += [
                pa.array([used], pa.list_(pa.int32())), pa.array([documents], pa.list_(pa.int64())),
                pa.array([filled], pa.int64()), pa.array([words], pa.int64()),
            ]
            names = ["ids", "named", "lengths", "term", "doc", "times", "used", "documents", "filled", "words"]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                found = terms_of(text) if text else []
                known = [place[t] for t in found if t in place]
                words += len(found)
                filled += bool(found)
                if not known:
                    continue
                if held and held + len(known) > block_postings:
                    yield block()
                    ids, lengths, terms, times, held = [], [], [], [], 0
                    words, filled = 0, 0
                term, n = np.unique(np.array(known, np.int64), return_counts=True)
                ids.append(name)
                lengths.append(len(found))
                terms.append(term)
                times.append(n)
                held += len(term)
        if ids:
            yield block()
        elif filled:
            # No document of the task holds a term of the queries: only the totals count.
            nothing = [pa.array([b""], pa.binary())] * 6 + [pa.array([[]], pa.list_(k)) for k in (pa.int32(), pa.int64())]
            totals = [pa.array([x], pa.int64()) for x in (filled, words)]
            names = ["ids", "named", "lengths", "term", "doc", "times", "used", "documents", "filled", "words"]
            yield pa.RecordBatch.from_arrays(nothing + totals, names=names)

    blobs = ", ".join(f"{c} binary" for c in ("ids", "named", "lengths", "term", "doc", "times"))
    schema = f"{blobs}, used array<int>, documents array<bigint>, filled bigint, words bigint"
    return cut_lineage(docs.mapInArrow(run, schema))


def _impacts(lengths: np.ndarray, doc: np.ndarray, times: np.ndarray, weight: np.ndarray, total: int, words: int):
    """Impact of each posting: weight * (10**9 tf div (1000 tf + 8 m)), with m from the document's length."""
    distinct, which = np.unique(lengths, return_inverse=True)
    # Python's integers, as the product of a length and the corpus may pass 64 bits.
    m = np.array([10 + 90 * int(n) * total // words for n in distinct], np.int64)[which]
    return weight * (1_000_000_000 * times // (1000 * times + 8 * m[doc]))


def _search_blocks(blocks: DataFrame, sent, k: int) -> DataFrame:
    """(query, score, id, named): the best of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries, total, words = sent.value
        found = [Best(k) for _ in queries]
        # A NULL id is last.
        null_id = np.iinfo(np.int64).max
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8").copy()
                ids[np.frombuffer(row["named"], "u1") == 0] = null_id
                term, doc, lengths, times = (
                    np.frombuffer(row[c], kind).astype(np.int64)
                    for c, kind in (("term", "<i4"), ("doc", "<i4"), ("lengths", "<i8"), ("times", "<i8"))
                )
                impact = _impacts(lengths, doc, times, weights[term], total, words)
                some = impact > 0
                if some.any():
                    block = Block(ids, term[some], doc[some], impact[some], len(weights))
                    for query, best in zip(queries, found, strict=True):
                        search(block, query, best)
        rows = [(i, s, d) for i, best in enumerate(found) for s, d in zip(best.scores.tolist(), best.ids.tolist())]
        columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], []]
        names = [None if d == null_id else d for d in columns[2]]
        arrays = [pa.array(c, pa.int64()) for c in (columns[0], columns[1], names)]
        yield pa.RecordBatch.from_arrays(arrays, names=["query", "score", "id"])

    held = blocks.where("octet_length(term) > 0").select("ids", "named", "lengths", "term", "doc", "times")
    return held.mapInArrow(run, "query bigint, score bigint, id bigint")


def _query_terms(queries: DataFrame) -> DataFrame:
    """Written rows (number, item, terms): distinct terms of each query row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            lists = [sorted(set(terms_of(t))) if t else [] for t in texts_of(batch.column(1))]
            arrays = [
                pa.array(range(number, number + len(lists)), pa.int64()), batch.column(0),
                pa.array([[t.decode() for t in x] for x in lists], pa.list_(pa.string())),
            ]
            number += len(lists)
            yield pa.RecordBatch.from_arrays(arrays, names=["number", "item", "terms"])

    kind = queries.schema["item"].dataType.simpleString()
    return cut_lineage(queries.mapInArrow(run, f"number bigint, item {kind}, terms array<string>").where("size(terms) > 0"))


def rank_documents(
    docs: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "doc_id", query_column: str = "item_id",
    block_postings: int = BLOCK_POSTINGS, round_terms: int = ROUND_TERMS,
) -> DataFrame:
    """The ``k`` best documents of each query: query id, rank (from 1), document id, score.

    Terms are maximal runs of ASCII letters and digits and characters beyond ASCII, A-Z lower-cased, in
    whole texts. With N documents that have a term, L terms in them, n terms in a document, a term in df
    documents and tf times in one: the term's weight is floor(1000 ln((2N+2) / (2df+1))), m is
    100-90 + 90nN div L, and the score sums weight * (10**9 tf div (1000 tf + 8m)) over a query's distinct terms.
    Scores of 0 are left out; equal scores rank by ascending document id, a NULL id last. Document ids
    are integers.

    A NULL or empty text has no terms: it is no document that counts, or a query without rows. Rows repeated
    with one id are documents, or queries, each. Other columns are not read. Empty tables give no rows.

    The texts are read once per ``round_terms`` terms of the queries (with repeats); only the terms of such a
    round are broadcast, with the number of documents that hold each. A task holds one block of postings.
    """
    spark = docs.sparkSession
    rows = pick(docs, id_column, "text").toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.select(F.col("id").cast("bigint"), "text")
    asked = _query_terms(pick(queries, query_column, "text").toDF("item", "text"))
    terms = asked.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    rounds = max(1, -(-terms // round_terms))
    best = None
    for i in range(rounds):
        part = asked if rounds == 1 else asked.where(F.pmod(F.xxhash64("number"), F.lit(rounds)) == i)
        found = _round(spark, rows, part.select("number", "terms").collect(), k, block_postings)
        best = found if best is None else best.unionByName(found)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    met = ranked.join(asked.select(F.col("number").alias("query"), "item"), "query")
    return met.select(
        F.col("item").alias(query_column), "rank", F.col("id").cast(kind).alias(id_column), "score"
    )


def _round(spark, rows: DataFrame, asked: list, k: int, block_postings: int) -> DataFrame:
    """(query, score, id) of the tasks' best for these queries."""
    vocabulary = sorted({t for r in asked for t in r["terms"]})
    blocks = _posting_blocks(rows, [t.encode() for t in vocabulary], block_postings)
    totals = blocks.agg(F.sum("filled").alias("n"), F.sum("words").alias("w")).first()
    total, words = totals["n"] or 0, totals["w"] or 0
    listed = blocks.select(F.inline(F.arrays_zip("used", "documents")))
    counts = listed.groupBy("used").agg(F.sum("documents").alias("n")).collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for r in counts:
        weights[r["used"]] = math.floor(1000 * math.log((2 * total + 2) / (2 * r["n"] + 1)))
    place = {t: i for i, t in enumerate(vocabulary)}
    queries = [np.array([place[t] for t in r["terms"]], np.int64) for r in asked]
    queries = [q[weights[q] > 0] for q in queries]
    found = _search_blocks(blocks, spark.sparkContext.broadcast((weights, queries, total, words)), k)
    numbers = np.array([r["number"] for r in asked], np.int64)
    named = spark.createDataFrame(list(enumerate(numbers.tolist())), "at bigint, number bigint")
    met = found.join(named, found["query"] == named["at"])
    return met.select(F.col("number").alias("query"), "score", "id")
