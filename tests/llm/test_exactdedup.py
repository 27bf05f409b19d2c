"""Exact duplicates against a plain version, on hand-made rows, random rows and every number of runs."""

import random
import re

import brute
import pytest

from tradeledger.llm import exactdedup
from tradeledger.llm.batches import prepare

SCHEMA = "doc_id long, text string, lang string"


def plain(rows):
    """(id, id that stays, size, hash) of distinct ids."""
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((-len(text or ""), doc is None, doc))
    out = []
    for doc, text, *_ in rows:
        key = re.sub("[\x20\x09-\x0d]", "", text or "")
        stays = min(groups[key])[2]
        out.append((doc, stays, len(groups[key]), doc == stays, brute.sha(key)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


ROWS = [
    (1, "one two", "en"), (2, "onetwo", "de"), (3, "one  two", None), (4, "one\ttwo\n", "en"), (5, None, "en"),
    (6, "", "en"), (7, " \x0b\x0c\r ", None), (8, "One two", "en"), (None, "one two", "en"), (9, "o ne two", "en"),
    (10, "ÀÉ ß x́   ½ ＡＢ", "fr"), (11, "ÀÉß x́ ½ＡＢ", "fr"), (12, "word " * 200_000, "en"),
    (13, "word" * 200_000, "en"),
]


@pytest.mark.parametrize(("parts", "fan"), [(1, 2), (3, 2), (9, 2), (9, 16), (20, 3)])
def test_hand_made_rows(spark, parts, fan):
    prepare(spark)
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(parts)
    found = exactdedup.exact_duplicates(docs, fan=fan)
    assert got(found) == plain(ROWS)


@pytest.mark.parametrize("parts", [1, 7])
def test_a_third_of_all_rows_are_copies(spark, parts):
    prepare(spark)
    pick = random.Random(parts)
    rows = [(i, "the same text" if i % 3 == 0 else f"text {pick.randrange(400)}" + " " * pick.randrange(3), "en") for i in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert got(exactdedup.exact_duplicates(docs, fan=2)) == plain(rows)
    # At every level an entry stands for all copies below it, so at most ``fan`` of a text meet.
    levels = exactdedup.merge_runs(exactdedup.digest_rows(docs, "doc_id", []), fan=2)
    for lower, upper in zip(levels, levels[1:]):
        assert lower.groupBy("run", "digest").count().agg({"count": "max"}).first()[0] == 1
        assert upper.count() <= lower.count()
    assert levels[-1].agg({"rows": "sum"}).first()[0] == len(rows)
    assert levels[-1].select("run").distinct().count() == 1


def test_repeated_rows_leave_one(spark):
    prepare(spark)
    rows = [(1, "a b", "en")] * 4 + [(None, "c", "en")] * 2
    found = exactdedup.exact_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), fan=2).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in found) == [
        (0, 0, 2, False), (0, 0, 2, True), (1, 1, 4, False), (1, 1, 4, False), (1, 1, 4, False), (1, 1, 4, True),
    ]


def test_kept_columns_and_clashing_names(spark):
    prepare(spark)
    docs = spark.createDataFrame([(2, "a b", "x", 1, 5), (1, "ab", "y", 2, 6)], "doc_id long, text string, lang string, KEPT int, Run int")
    clash = docs.withColumn("digest", docs["lang"]).toDF("doc_id", "text", "lang", "KEPT", "Run", "LANG")
    found = exactdedup.exact_duplicates(clash, keep=["text", "lang", "KEPT", "Run"])
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "text", "lang", "Run"]
    assert sorted(r[:] for r in found.select("doc_id", "kept", "text", "lang", "Run").collect()) == [
        (1, False, "ab", "y", 6), (2, True, "a b", "x", 5),
    ]


def test_empty_table_and_text_ids(spark):
    prepare(spark)
    assert exactdedup.exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([("b", "x y"), ("a", "x\ny"), ("c", "z")], "name string, text string")
    found = exactdedup.exact_duplicates(docs, id_column="name")
    assert sorted((r.name, r.keep_id, r.kept) for r in found.collect()) == [("a", "a", True), ("b", "a", False), ("c", "c", True)]
    with pytest.raises(ValueError):
        exactdedup.exact_duplicates(docs, id_column="name", fan=1)
