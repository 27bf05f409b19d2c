"""MinHash near-duplicates: banded minima, signature check, full check, connected components.

Documents of equal shingle sets are one class; the work is on one row per class. Members of a bucket
are compared with its smallest one, not with each other. Where they then still lie in several
components, those outside the bucket's main component are compared with all of it, block by block on
full sets, so no link is lost however large a bucket is, and only links that join components are
returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import HASHES, add_fields, odd_numbers, pick, texts_of, windows
from tradeledger.session import cut_lineage

BANDS, ROWS = 30, 5

#: Shingles of a bucket's members that one task holds on either side when a bucket is compared.
BLOCK = 1_000_000

#: Cells of a table of members and shingles.
CELLS = 16_000_000


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words are one shingle, none has none."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = HASHES.of(words)
    return np.unique(windows(hashes, min(n, len(hashes))))


def minima(hashes: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Upper 32 bits of the minimum of every universal hash function."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        part = hashes[i : i + 2048]
        np.minimum(out, (factors[:, None] * part + offsets[:, None]).min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def sketch(docs: DataFrame, keep: list[str], words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Columns ``keep`` with n_shingles, set_id, the signature and a key for each band."""
    factors, offsets = odd_numbers(1, bands * rows), odd_numbers(2, bands * rows)
    fields = [
        ("n_shingles", "bigint", pa.int64()),
        ("set_id", "binary", pa.binary()),
        ("signature", "binary", pa.binary()),
        ("bands", "array<bigint>", pa.list_(pa.int64())),
    ]

    def work(texts):
        counts, ids, signatures, keys = [], [], [], []
        for text in texts_of(texts):
            found = shingles(text, words)
            counts.append(len(found))
            if not len(found):
                ids.append(None)
                signatures.append(None)
                keys.append([])
                continue
            ids.append(xxhash.xxh3_128_digest(found.tobytes()))
            least = minima(found, factors, offsets)
            signatures.append(least.tobytes())
            band = least.reshape(bands, rows).astype(np.uint64)
            keys.append(windows_by_row(band).view(np.int64).tolist())
        return counts, ids, signatures, keys

    return add_fields(docs, ["text"], keep, fields, work)


def windows_by_row(band: np.ndarray) -> np.ndarray:
    """A key for each band that holds its number too."""
    total = np.arange(1, len(band) + 1, dtype=np.uint64) * odd_numbers(5, 1)[0]
    for column, factor in zip(band.T, odd_numbers(6, band.shape[1]), strict=True):
        total = (total ^ column) * factor
        total ^= total >> np.uint64(29)
    return total


def likely(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose signatures agree in at least the share ``least`` of the minima."""
    left = sketches.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32) for i in (2, 3))
            same = (sa == sb).reshape(batch.num_rows, -1).mean(axis=1) if batch.num_rows else np.zeros(0)
            yield batch.select([0, 1]).filter(pa.array(same >= least))

    return both.mapInArrow(run, "a bigint, b bigint")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) with den * intersection >= num * union, over the full shingle sets."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None  # many pairs in a row share a pivot
        for batch in batches:
            linked = []
            for a, ta, tb in zip(
                batch.column(0).to_pylist(), texts_of(batch.column(2)), texts_of(batch.column(3)), strict=True
            ):
                if a != last:
                    last, kept = a, shingles(ta, words)
                other = shingles(tb, words)
                common = len(np.intersect1d(kept, other, assume_unique=True))
                linked.append(den * common >= num * (len(kept) + len(other) - common))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for all nodes of the edges (a, b).

    Large-star links every larger neighbour of a node to the smallest one, small-star the smaller
    ones; they alternate until all nodes hang on the smallest of theirs. Minima are aggregates and
    edges single rows, so no task gathers the neighbours of a node.
    """
    edges = cut_lineage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        edges = cut_lineage(small.distinct())
        # Done when no node has two parents and no parent has one.
        open_nodes = edges.groupBy("u").count().where("count > 1").select("u")
        open_nodes = open_nodes.union(edges.join(edges.select(F.col("v").alias("u")).distinct(), "u").select("u"))
        if open_nodes.isEmpty():
            break
    heads = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(heads)


def _distinct_buckets(members: DataFrame) -> DataFrame:
    """Members of one bucket of those that have equal members."""
    alike = members.groupBy("key").agg(F.bit_xor(F.xxhash64("node")).alias("x"), F.count(F.lit(1)).alias("n"))
    return members.join(alike.groupBy("x", "n").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Sizes of all intersections as tables, with the first row and column of each.

    No table has more than CELLS cells, unless one row alone does.
    """
    at = 0
    while at < len(left):
        end, size = at + 1, len(left[at])
        while end < len(left) and size + len(left[end]) <= 100_000 and (end + 1 - at) * (size + len(left[end])) <= CELLS:
            size += len(left[end])
            end += 1
        part = left[at:end]
        terms = np.unique(np.concatenate(part))
        rows = np.zeros((len(part), len(terms)), np.float32)
        for row, found in zip(rows, part, strict=True):
            row[np.searchsorted(terms, found)] = 1
        step = max(1, CELLS // max(len(terms), len(part)))
        for first in range(0, len(right), step):
            others = right[first : first + step]
            table = np.zeros((len(others), len(terms)), np.float32)
            for row, found in zip(table, others, strict=True):
                places = np.searchsorted(terms, found)
                places[places == len(terms)] = 0
                row[places[terms[places] == found]] = 1
            yield at, first, rows @ table.T
        at = end


def bucket_links(group: list[tuple], num: int, den: int) -> list[tuple[int, int]]:
    """Links that join components; rows (node, component, outside, set) of a bucket or a part of it."""
    left, right = [r for r in group if r[2]], [r for r in group if not r[2]]
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    out = []
    sizes = np.array([len(r[3]) for r in right])
    if not left or not right:
        return out
    for at, first, common in _common([r[3] for r in left], [r[3] for r in right]):
        own = np.array([len(r[3]) for r in left[at : at + len(common)]])
        common = common.astype(np.int64)
        union = own[:, None] + sizes[None, first : first + common.shape[1]] - common
        for i, j in np.argwhere(den * common >= num * union).tolist():
            a, b = left[at + i], right[first + j]
            x, y = root(a[1]), root(b[1])
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((a[0], b[0]))
    return out


def compare_buckets(rest: DataFrame, texts: DataFrame, words: int, num: int, den: int, block: int) -> DataFrame:
    """Links (a, b) between components that meet in a bucket; ``rest`` has key, node, component, n_shingles.

    A bucket of more than ``block`` shingles is dealt out, every block of members outside its main
    component with every block of all members.
    """
    buckets = _distinct_buckets(rest)
    parts = buckets.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    top = parts.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.ceil(F.sum("w") / block).cast("int").alias("blocks"),
    )
    sized = buckets.join(top, "key").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    outside = sized.where("component <> main").select(
        "key", F.col("own").alias("x"), every.alias("y"), "node", "component", F.lit(True).alias("outside")
    )
    inside = sized.select("key", every.alias("x"), F.col("own").alias("y"), "node", "component", F.lit(False).alias("outside"))
    held = outside.select("key", "x", "y").distinct()
    rows = outside.unionByName(inside.join(held, ["key", "x", "y"], "left_semi")).join(texts, "node")
    rows = rows.select("key", "x", "y", "node", "component", "outside", "text")
    dealt = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(group):
            found = bucket_links(group, num, den)
            columns = list(zip(*found, strict=True)) if found else [[], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        held, group, known = [], None, {}
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(6))
            for key, x, y, node, component, outside, text in zip(*columns, texts_of(batch.column(6)), strict=True):
                if (key, x, y) != group:
                    if held:
                        yield out(held)
                    held, group, known = [], (key, x, y), {}
                if node not in known:
                    known[node] = shingles(text, words)
                held.append((node, component, outside, known[node]))
        if held:
            yield out(held)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def link(
    docs: DataFrame, sketches: DataFrame, words: int, num: int, den: int, block: int = BLOCK
) -> DataFrame:
    """(node, component) of linked classes; ``sketches`` has node, n_shingles, signature and bands per class.

    ``docs`` has node and text of the documents of each class.
    """
    share = num / den
    least = max(0.0, share - 6 * math.sqrt(share * (1 - share) / (BANDS * ROWS)))
    members = sketches.select("node", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = cut_lineage(members.join(shared, "key"))
    nodes = members.select("node").distinct()
    known = cut_lineage(sketches.select("node", "signature", "n_shingles").join(nodes, "node", "left_semi"))
    texts = docs.select("node", "text").join(nodes, "node", "left_semi")
    texts = cut_lineage(texts.withColumn("x", F.xxhash64("text")).dropDuplicates(["node", "x"]).drop("x"))
    smallest = members.groupBy("key").agg(F.min("node").alias("a"))
    pairs = members.join(smallest, "key").where("a < node").select("a", F.col("node").alias("b")).distinct()
    edges = cut_lineage(confirmed(likely(pairs, known, least), texts, words, num, den))
    found = components(edges)
    rest = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = rest.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    rest = rest.join(split.select("key"), "key", "left_semi").join(known.select("node", "n_shingles"), "node")
    more = cut_lineage(compare_buckets(cut_lineage(rest), texts, words, num, den, block))
    return components(edges.union(more))


def judged(docs: DataFrame, words: int, num: int, den: int, id_column: str) -> DataFrame:
    """id, text_hash, n_shingles, set_id, component_id and kept of every row."""
    rows = pick(docs, id_column, "text").select(F.col(id_column).cast("bigint").alias("id"), "text")
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    stage = cut_lineage(sketch(hashed, ["id", "text_hash"], words))
    # A class is worked on by the row of its smallest id; equal sets have equal sketches.
    classes = stage.where(F.col("set_id").isNotNull() & F.col("id").isNotNull()).groupBy("set_id")
    sketches = cut_lineage(
        classes.agg(*[F.first(c).alias(c) for c in ("n_shingles", "signature", "bands")], F.min("id").alias("node"))
    )
    found = link(rows.withColumnRenamed("id", "node"), sketches.drop("set_id"), words, num, den)
    place = sketches.select("set_id", "node").join(found, "node", "left")
    place = place.select("set_id", F.coalesce("component", "node").alias("component_id"))
    out = stage.select("id", "text_hash", "n_shingles", "set_id").join(place, "set_id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        "id", "text_hash", "n_shingles", "set_id", component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )


def near_duplicates(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_column: str = "doc_id"
) -> DataFrame:
    """One row per row of docs: id, n_shingles, set_id, component_id, kept.

    Shingles are of ``words`` words (A-Z lowered, split at ASCII white space); a text of fewer words is
    one shingle, a NULL or blank one has none and links with nothing. Two documents are linked if
    den * |intersection| >= num * |union|; ``component_id`` is the smallest id reachable and ``kept``
    marks the row that has it. Repeated rows share their id and are marked alike. A row without id
    has the smallest id of its component, if any row of equal shingles has one, and is kept only if
    none has. An id with several texts has the component of each text. Shingles are compared by 64-bit
    hashes.
    """
    found = judged(docs, words, num, den, id_column)
    return found.select(F.col("id").alias(id_column), "n_shingles", "set_id", "component_id", "kept")


def keep_one(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_column: str = "doc_id") -> DataFrame:
    """Rows of docs with one row of each group of near-duplicates, that of the smallest id.

    Rows without words all stay. Of rows that share id and group the one of the least text hash stays.
    """
    found = cut_lineage(judged(docs, words, num, den, id_column).where("kept"))
    solid = found.where(F.col("set_id").isNotNull())
    group = ["id", F.when(F.col("id").isNull(), F.col("set_id")).alias("g")]
    chosen = solid.groupBy(*group).agg(F.min("text_hash").alias("h_"), F.count(F.lit(1)).alias("n")).drop("g")
    chosen = cut_lineage(chosen.withColumnRenamed("id", "id_"))
    blank = found.where(F.col("set_id").isNull()).select(F.col("id").alias("id_"), F.col("text_hash").alias("h_")).distinct()
    names = docs.columns
    rows = pick(docs, *names).withColumn("hash_", F.xxhash64("text"))
    on = F.col(id_column).eqNullSafe(F.col("id_")) & (F.col("hash_") == F.col("h_"))
    out = rows.join(chosen.select("id_", "h_").union(blank), on, "left_semi")
    if not chosen.where("n > 1").isEmpty():
        # Equal rows: blank ones keep their number, of others the first stays.
        empty = F.coalesce(F.btrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit("")) == ""
        out = out.where(~empty).dropDuplicates([id_column, "hash_"]).union(out.where(empty))
    return out.select(*[F.col(f"`{c}`") for c in names])
