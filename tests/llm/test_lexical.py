"""Ranked search against plain scores of every document."""

import math
import random
import re
from collections import Counter

import brute
import numpy as np
import pytest

from tradeledger.llm import lexical
from tradeledger.llm.batches import prepare

WORD = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def plain(docs, items, k=10):
    """(item, rank, doc, score) by scoring every document in full."""
    counts = [(doc, Counter(re.findall(WORD, brute.lower(text or "")))) for doc, text, *_ in docs]
    total, words = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    spread = Counter(t for _, c in counts for t in c)
    out = []
    for item, text, *_ in items:
        found = []
        for doc, c in counts:
            score = 0
            for t in set(re.findall(WORD, brute.lower(text or ""))) & set(c):
                m = 100 - 90 + 90 * sum(c.values()) * total // words
                weight = math.floor(1000 * math.log((2 * total + 2) / (2 * spread[t] + 1)))
                score += weight * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, i + 1, doc, -less) for i, (less, _, doc) in enumerate(sorted(found, key=lambda x: (x[:2], x[2] or 0))[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


DOCS = [
    (5, "The cat sat on the mat."), (3, "the CAT sat on the mat"), (4, "a dog"), (9, None), (8, ""), (7, " .,! \n"),
    (None, "the cat sat on the mat"), (3, "the CAT sat on the mat"), (1, "ÀÉ ß x́ 日本 ½ ＡＢ cat"), (2, "mat " * 50_000 + "end"),
    (6, "日本 àé dog dog"),
]
ITEMS = [(1, "cat mat"), (2, None), (3, ""), (4, "nowhere"), (None, "DOG 日本"), (5, "ÀÉ àé x́"), (6, "the the the " * 1000), (1, "cat mat")]


@pytest.mark.parametrize(("parts", "block", "terms", "k"), [(1, 10**6, 10**6, 10), (4, 6, 3, 10), (11, 1, 1, 2), (2, 10**6, 2, 1)])
def test_cases_in_any_blocks_and_rounds(spark, parts, block, terms, k):
    prepare(spark)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in DOCS], "doc_id long, text string, SCORE string, term int")
    items = spark.createDataFrame([(i, "y", t) for i, t in ITEMS], "item_id long, doc_id string, text string")
    found = lexical.rank_documents(docs.repartition(parts), items, k, block_postings=block, round_terms=terms)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert got(found) == plain(DOCS, ITEMS, k)


@pytest.mark.parametrize(("parts", "block"), [(1, 10**6), (3, 500)])
def test_copies_hold_a_third_of_all_rows(spark, parts, block):
    """Equal scores in thousands: the smallest ids win, and few intervals are split for them."""
    prepare(spark)
    pick = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [
        (pick.randrange(10**9), "w1 w2 w3 w3 w50" if i % 3 == 0 else " ".join(pick.choices(vocabulary, k=pick.randrange(1, 30))))
        for i in range(3000)
    ]
    rows = list(dict(rows).items())
    items = [(i, " ".join(pick.choices(vocabulary, k=8))) for i in range(20)] + [(99, "w1 w2 w3"), (98, "w50")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    found = lexical.rank_documents(docs, spark.createDataFrame(items, "item_id long, text string"), block_postings=block)
    assert got(found) == plain(rows, items)


def test_intervals_are_bounded_and_few():
    """Range maxima against slices, and a search that leaves most documents unscored."""
    pick = np.random.default_rng(2)
    size, terms = 4000, 12
    held = pick.random((terms, size)) < 0.3
    term, doc = (x.astype(np.int64) for x in np.nonzero(held))
    impact = pick.integers(1, 1000, len(term)) ** 2
    block = lexical.Block(np.arange(size) * 3, term, doc, impact, terms)
    lists = [block.starts[t : t + 2] for t in pick.integers(0, terms, 500)]
    for lo, hi in lists:
        a, b = sorted(pick.integers(lo, hi + 1, 2))
        assert block.maxima(np.array([a]), np.array([b]))[0] == impact[a:b].max(initial=0)
    # Documents that share the query's terms with high impact stand in one place.
    query = np.arange(6)
    impact[(term < 6) & (doc >= 1000) & (doc < 1010)] = 10**7
    block = lexical.Block(np.arange(size) * 3, term, doc, impact, terms)
    best = lexical.Best(5)
    splits = lexical.search(block, query, best, step=8)
    scores = np.bincount(doc, weights=np.where(term < 6, impact, 0), minlength=size).astype(np.int64)
    order = np.lexsort((np.arange(size), -scores))[:5]
    assert best.ids.tolist() == (order * 3).tolist() and best.scores.tolist() == scores[order].tolist()
    assert splits < size // 20


def test_empty_tables(spark):
    prepare(spark)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.rank_documents(docs.limit(0), items).collect() == []
    assert lexical.rank_documents(docs, items.limit(0)).collect() == []
    assert lexical.rank_documents(docs.where("doc_id in (7, 8, 9)"), items).collect() == []
