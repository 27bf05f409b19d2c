"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are windows of consecutive words of the benchmark items. For each pattern length there is
one table of shifts by block (the last two words looked at) and one of buckets by suffix block. A
block that ends no pattern moves the search on by its shift; one that does selects a bucket, whose
patterns with the same first word are compared word by word.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import add_fields, pick, texts_of
from tradeledger.session import cut_lineage

#: Windows in one set of tables sent to the executors; more are searched for set by set.
BLOCK_WINDOWS = 200_000

#: Bytes that belong to words once A-Z are lowered: digits, a-z and everything beyond ASCII.
_TO_SPACE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text, A-Z lowered; none without a text."""
    return text.lower().translate(_TO_SPACE).split() if text else []


def item_windows(items: DataFrame, gram: int) -> DataFrame:
    """(window, item): every run of ``gram`` words, or all words of a shorter item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owners = [], []
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                words = words_of(text)
                if words:
                    of = {b" ".join(words[i : i + gram]) for i in range(max(1, len(words) - gram + 1))}
                    found += of
                    owners += [item] * len(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), pa.array(owners, pa.string())], names=["window", "item"]
            )

    read = pick(items, "item_id", "text").withColumn("item_id", F.col("item_id").cast("string"))
    return read.mapInArrow(run, "window binary, item string")


class Tables:
    """Shift and bucket tables of the patterns of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]]):
        self.length = len(next(iter(patterns)))
        self.block = min(2, self.length)
        self.step = self.length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        buckets = defaultdict(lambda: defaultdict(list))
        for words, owners in patterns.items():
            for end in range(self.block, self.length + 1):
                key = words[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.step), self.length - end)
            buckets[words[-self.block :]][words[0]].append((words, owners))
        self.buckets = {k: dict(v) for k, v in buckets.items()}

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start of every occurrence with the items of the pattern."""
        length, block, step, shift = self.length, self.block, self.step, self.shift
        end, n = length, len(words)
        while end <= n:
            key = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            skip = shift.get(key, step)
            if skip:
                end += skip
                continue
            start = end - length
            for pattern, owners in self.buckets[key].get(words[start], ()):
                if pattern == tuple(words[start:end]):
                    yield start, owners
            end += 1


def tables_of(rows: list[tuple[bytes, list[str]]]) -> list[Tables]:
    by_length = defaultdict(dict)
    for window, owners in rows:
        words = tuple(window.split(b" "))
        by_length[len(words)][words] = owners
    return [Tables(by_length[n]) for n in sorted(by_length)]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


#: Columns that a search adds.
FIELDS = [
    ("n_words", "bigint", pa.int64()),
    ("spans", "array<struct<start:bigint,end:bigint>>", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", "array<string>", pa.list_(pa.string())),
]


def find_items(
    docs: DataFrame, items: DataFrame, gram: int = 10, keep: list[str] | None = None, block: int = BLOCK_WINDOWS
) -> DataFrame:
    """Columns ``keep`` of docs (all by default) with what occurs of the benchmark items in each text.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence), ``spans`` (merged word ranges, end
    exclusive), ``items`` (distinct ids as strings, sorted) and ``contaminated``; a column of docs of
    such a name is replaced. A row without text has no words. Items without words or text have no
    windows, an item without id marks words and is not listed. Repeated rows are judged each.

    The windows are counted first. Up to ``block`` of them are one set of tables, searched for as the rows
    pass by. More are searched for set by set: each round holds one set only, and writes the hits of the
    distinct texts, which are then joined back by text hash.
    """
    keep = list(docs.columns) if keep is None else keep
    taken = {f[0] for f in FIELDS} | {"n_hit", "contaminated"}
    keep = [c for c in keep if c.lower() not in taken]
    grams = item_windows(items, gram).groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    rounds = max(1, math.ceil(grams.count() / block))
    out = _search(docs, grams, keep)[0] if rounds == 1 else _search_in_rounds(docs, cut_lineage(grams), keep, rounds)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return out.withColumn("n_hit", hit).withColumn("contaminated", F.col("n_hit") > 0)


def _search(docs: DataFrame, grams: DataFrame, keep: list[str]) -> tuple[DataFrame, Broadcast]:
    """Columns ``keep`` with n_words, spans and items for the windows of one set, and the tables sent out."""
    sent = docs.sparkSession.sparkContext.broadcast(tables_of([(bytes(r.window), r["items"]) for r in grams.collect()]))

    def work(texts):
        counts, all_spans, all_items = [], [], []
        for text in texts_of(texts):
            words = words_of(text)
            hits, found = [], set()
            for table in sent.value:
                for start, owners in table.search(words):
                    hits.append((start, start + table.length))
                    found.update(owners)
            counts.append(len(words))
            all_spans.append([{"start": a, "end": b} for a, b in _merged(hits)])
            all_items.append(sorted(found))
        return counts, all_spans, all_items

    return add_fields(docs, ["text"], keep, FIELDS, work), sent


def _search_in_rounds(docs: DataFrame, grams: DataFrame, keep: list[str], rounds: int) -> DataFrame:
    """The same for sets of windows one after another: a round is written before the next one's tables are built."""
    texts = pick(docs, "text").where(F.col("text").isNotNull())
    texts = texts.select("text", F.xxhash64("text").alias("key"), F.octet_length("text").alias("size"))
    parts = []
    for i in range(rounds):
        found, sent = _search(texts, grams.where(F.pmod(F.xxhash64("window"), F.lit(rounds)) == i), ["key", "size"])
        # Copies of a text have equal hits.
        parts.append(cut_lineage(found.where(F.size("spans") > 0).dropDuplicates(["key", "size"])))
        sent.destroy()
    hits = reduce(DataFrame.unionByName, parts).groupBy("key", "size").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    through = list(dict.fromkeys([*keep, "text"]))
    rows = add_fields(docs, ["text"], through, FIELDS[:1], lambda t: ([len(words_of(x)) for x in texts_of(t)],))
    hits = hits.toDF("key_", "size_", "spans", "items")
    met = rows.join(hits, (F.xxhash64("text") == F.col("key_")) & (F.octet_length("text") == F.col("size_")), "left")
    spans, names = (F.array().cast(ddl) for _, ddl, _ in FIELDS[1:])
    return met.select(
        *(F.col(f"`{c}`") for c in keep), "n_words",
        F.coalesce(_joined(F.col("spans")), spans).alias("spans"), F.coalesce("items", names).alias("items"),
    )


def _joined(spans: Column) -> Column:
    """Sorted spans with overlapping and touching ones made one."""

    def step(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        apart = (F.size(done) == 0) | (x["start"] > last["end"])
        return F.when(apart, F.concat(done, F.array(x))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        )

    return F.aggregate(spans, F.array().cast(FIELDS[1][1]), step)
