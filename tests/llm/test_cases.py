"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random
from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeledger.llm import decontaminate, linedup, neardup, packing, quality, repeats, secrets, textrules, toxicity, urlrules
from tradeledger.llm.batches import prepare
from tradeledger.llm.queries import tokenizer_definition

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, seed=0):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 9))) for _ in range(n))


LONG = prose(30_000, 9)
CASES = [
    (1, prose(120, 1), "en", "a"), (2, prose(120, 1), "en", "a"), (3, prose(120, 1) + " more words", "de", "b"),
    (3, prose(120, 1) + " more words", "de", "b"), (4, None, "en", None), (5, "", None, "a"), (6, " \n\t ", "en", "a"),
    (7, "one", "en", "a"), (None, prose(60, 2), "en", "a"), (None, None, None, None), (9, LONG, "en", "a"),
    (10, "Line one is here\nline two is here\nline three is here\nother", "en", "a"),
    (11, "Line one is here\nline two is here\n\nline three is here\nnew", "en", "a"),
    (12, "ÀÉ ß 'tis don't <|endoftext|> x\u0301 \u2003 ½ ＡＢ", "fr", "a"),
    (13, 'token = "abcdefghijkl123" AKIA' + "A" * 14 + " " + "0f" * 10, "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame([(*r, 7) for r in CASES], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, prose(120, 1)[:200]), (2, None), (3, ""), (None, "line two is"), (4, "one"), (4, "Line ONE is")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in (1, 2, 3, 6, 7, 9, 10, 11, 12)] + [(None, 1, 1), (4, None, None), (1, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def got(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


TEXTS = [(r[0], r[1]) for r in CASES]


def test_each_round_of_a_large_benchmark_is_written(docs, items):
    """No plan holds the tables of two rounds; the rows of the rounds meet by text hash."""
    plan = decontaminate.find_items(docs, items, keep=["doc_id"], block=7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


@pytest.mark.parametrize("block", [200_000, 7])
def test_decontaminate(docs, items, block):
    found = decontaminate.find_items(docs, items, keep=["doc_id"], block=block)
    found = found.withColumn("n_items", F.size("items")).withColumn("sha", F.sha2(F.array_join("items", ","), 256))
    want = brute.decontaminated(TEXTS, [tuple(r) for r in items.collect()])
    assert got(found, "doc_id", "n_words", "n_hit", "n_items", "sha", "contaminated") == sorted(want, key=str)


def test_pack(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_definition())
    pieces = packing.pack_documents(docs, tokenizer_definition()).collect()
    ids = Counter()
    for _, text in TEXTS:
        for i in [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]:
            ids[i] += 1
    found = Counter(i for p in pieces for i in np.frombuffer(p["ids"], "<u4").tolist())
    assert found == ids
    lengths = Counter()
    for p in pieces:
        lengths[p.sequence_id] += p.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in lengths.values())


def test_secrets(docs):
    rows = secrets.scan_secrets(docs).collect()
    assert len(rows) == len(CASES)
    for r in rows:
        if r.doc_id == 13:
            assert [(s["kind"], s["start"], s["end"]) for s in r.secrets] == brute.base_secrets(CASES[-1][1])


def test_opaque_tokens_of_many_owners_are_examples(spark):
    value = "Xk3vQ9zLm2PwT7rBn4Yc"
    rows = [(i, f"use {value} here", "en", f"s{i}", 1) for i in range(4)] + [(9, "my aB3dE6gH9jK2mN5pQ8sT key", "en", "s1", 1)]
    found = {r.doc_id: r.secrets for r in secrets.scan_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [len(found[i]) for i in (0, 1, 2, 3, 9)] == [0, 0, 0, 0, 1]
    assert found[9][0]["live"]


def test_near_duplicates(docs, spark):
    found = neardup.near_duplicates(docs, 3, 85, 100)
    assert found.count() == len(CASES)
    want = {d: (n, c, k) for d, n, c, k in brute.near_duplicates([x for x in dict(TEXTS).items() if x[0] is not None])}
    for r in found.collect():
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]
    kept = neardup.keep_one(docs).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in kept} == {1: 1, None: 2, **dict.fromkeys((4, 5, 6, 7, 9, 10, 12, 13), 1)}


def test_large_group_of_near_copies(spark):
    """Copies with random edits, some linked only through others; small blocks give the same links."""
    pick, base = random.Random(3), prose(60, 5).split()
    rows = []
    for i in range(300):
        words = list(base)
        for at in pick.sample(range(60), pick.choice([0, 1, 1, 2, 3, 4])):
            words[at] = f"w{pick.randint(0, 3)}"
        rows.append((i, " ".join(words)))
    want = {d: c for d, _, c, _ in brute.near_duplicates(rows)}
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got_one = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame, 3, 85, 100).collect()}
    assert got_one == want
    assert len(set(want.values())) > 1
    hashed = frame.withColumn("text_hash", F.xxhash64("text"))
    sketches = neardup.sketch(hashed, ["doc_id"], 3).withColumnRenamed("doc_id", "node")
    small = neardup.link(frame.withColumnRenamed("doc_id", "node"), sketches, 3, 85, 100, block=900)
    found = {r.node: r.component for r in small.collect()}
    assert {d: found.get(d, d) for d in want} == want


def test_classifiers(docs, labels):
    for found in (quality.score_quality(docs, labels), toxicity.score_toxicity(docs, labels)):
        rows = found.collect()
        assert len(rows) == len(CASES)
        assert all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    none = labels.where("false")
    assert {r.score for r in quality.score_quality(docs, none, keep=["doc_id"]).collect()} == {0.5}
    assert {r.score for r in toxicity.score_toxicity(docs, none, keep=["doc_id"]).collect()} == {0.5}


def test_urls(spark):
    urls = [None, "", "x", "http://", "http://Example.NET/en/?a#b", "a://b.org/fr/x", "http://net", "http://net/",
            "http://m.net?x/", "http://ads-track.example.org/q", "http://É.NET/a://b", "http://example.org/é\nx.EXE",
            "http://u.example.com/a.exe?z", "http://badadult.com/"]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate([*urls, *urls])], "page_id int, url string, html string, verdict string")
    for r in urlrules.judge_urls(pages).collect():
        host, path, rule, verdict = brute.url_base(urls[r.page_id % len(urls)])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        wanted = verdict or ("block" if r.page_id % len(urls) in (9, 11, 12) else "allow")
        assert r.verdict == wanted


def test_text_rules(docs):
    rows = textrules.judge_texts(docs, keep=["doc_id", "text"]).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert len(rows) == len(CASES)
    for r in rows:
        assert tuple(r[n] for n in names) == brute.text_base(r.text)
        assert not (r.base_failed and r.kept)


def test_repeated_windows(spark):
    texts = ["a b c d e a b c d e f", "a " * 40, "a b c d e f g a b c d e", "x\ny\nx\n \n \nx", "a b c"]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    rows = textrules.text_statistics(frame, ["doc_id", "text"]).collect()
    for r in rows:
        assert (r.n_repeat_words, r.n_dup_lines) == (brute.text_base(r.text)[4], brute.text_base(r.text)[3])


def test_lines(docs, spark):
    named = [r for r in TEXTS if r[0] is not None]
    found = linedup.remove_repeated_lines(docs).where("doc_id is not null")
    want = {d: (n, gone, left) for d, n, gone, left in brute.without_lines(list(dict(named).items()))}
    for r in found.collect():
        assert (r.n_lines, r.n_removed, r.text or "") == want[r.doc_id]
    pick = random.Random(4)
    rows = [(i, "\n".join(pick.choice("abcdef") for _ in range(pick.randint(0, 25)))) for i in range(40)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, N_LINES long")
    want = sorted((d, n, gone, left) for d, n, gone, left in brute.without_lines(rows))
    assert got(linedup.remove_repeated_lines(frame), "doc_id", "n_lines", "n_removed", "text") == sorted(want, key=str)


def test_repeats(docs, spark):
    found = repeats.remove_repeats(docs, digest=True)
    want = brute.without_repeats(TEXTS, 400)
    assert got(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=str)
    pick = random.Random(6)
    parts = [bytes(pick.choice(b"abc") for _ in range(30)).decode() for _ in range(6)]
    rows = [(i, "".join(pick.choice(parts) for _ in range(pick.randint(0, 9))) + "é" * i) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for batches, group in ((4, 20_000), (3, 2)):
        found = repeats.remove_repeats(frame, length=50, reach=20, batches=batches, group=group)
        out = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in found.collect()]
        assert sorted(out) == sorted(brute.without_repeats(rows, 50))


def test_empty_tables(spark, items, labels):
    none = spark.createDataFrame([], SCHEMA)
    results = [
        decontaminate.find_items(none, items), decontaminate.find_items(none, items.where("false")),
        packing.pack_with_steps(none, tokenizer_definition()), secrets.scan_secrets(none), neardup.near_duplicates(none),
        quality.score_quality(none, labels), toxicity.score_toxicity(none, labels), textrules.judge_texts(none),
        linedup.remove_repeated_lines(none), repeats.remove_repeats(none), neardup.keep_one(none),
        urlrules.judge_urls(spark.createDataFrame([], "page_id long, url string")),
    ]
    assert [df.count() for df in results] == [0] * len(results)


def test_clashing_columns(spark, items, labels):
    schema = SCHEMA + ", TEXT string, n_words long, score double, kept boolean, N_HIT long, key string, node long"
    frame = spark.createDataFrame([(1, prose(30), "en", "a", 1, "x", 5, 0.5, True, 3, "k", 2)], schema)
    assert decontaminate.find_items(frame, items, keep=["doc_id", "n_words"]).columns.count("n_words") == 1
    for found in (
        packing.pack_documents(frame, tokenizer_definition()), secrets.scan_secrets(frame), neardup.near_duplicates(frame),
        quality.score_quality(frame, labels, keep=["doc_id", "score"]), toxicity.score_toxicity(frame, labels, keep=["doc_id"]),
        textrules.judge_texts(frame), repeats.remove_repeats(frame),
    ):
        assert found.collect()[0]["doc_id"] == 1


def test_pipeline(spark, tmp_path):
    from conftest import SMALL

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sizes = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{i}")
        made = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert made.columns == docs.columns
            docs = made
            sizes.append(made.count())
    assert sizes == sorted(sizes, reverse=True)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert not any(r[5] for r in brute.decontaminated(texts, items))
    assert all(r[3] for r in brute.near_duplicates(texts, 5, 80, 100))
    assert {r.doc_id for r in made.collect()} == {d for d, _ in texts}
    assert made.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()
