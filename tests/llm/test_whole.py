"""Cases in which a text operator once did less than its whole job."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeledger.llm import neardup, packing, quality, repeats, secrets, textrules
from tradeledger.llm.batches import prepare


@pytest.mark.parametrize("beside", [0, 1, 50, 255, 300])
def test_pack_single_documents_of_any_length(beside):
    """One document alone in a task, or beside a short one: every token once, windows full, no negative pieces."""
    for length in range(257, 2048):
        pieces = [(0, 0, length)] + ([(1, 0, beside)] if beside else [])
        windows, left = packing.pack(pieces, packing.TIERS)
        windows += packing.powers(left, max(packing.TIERS))
        covered = {0: [], 1: []}
        for size, held in windows:
            assert size & (size - 1) == 0 and sum(n for _, _, n in held) == size
            for doc, start, n in held:
                assert n > 0
                covered[doc].append((start, n))
        for doc, whole in ((0, length), (1, beside)):
            at = 0
            for start, n in sorted(covered[doc]):
                assert start == at
                at += n
            assert at == whole


def test_repeats_gather_no_large_fingerprint(spark, monkeypatch):
    """A notice shorter than the window with unique text around it; a third of the texts share one long passage."""
    prepare(spark)
    pick = random.Random(8)

    def letters(n):
        return "".join(pick.choice("abcdefgh ") for _ in range(n))

    notice, passage = letters(40), letters(70)
    rows = [(i, letters(60 + i % 7) + (passage if i % 3 == 0 else notice) + letters(60)) for i in range(90)]
    gathered, compare = [], repeats.compare

    def counting(found, length):
        gathered.extend(r["count"] for r in found.groupBy("k").count().collect())
        return compare(found, length)

    monkeypatch.setattr(repeats, "compare", counting)
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=50, reach=20, group=5)
    out = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in found.collect()]
    assert sorted(out) == sorted(brute.without_repeats(rows, 50))
    assert any(r[2] for r in out) and not all(r[2] for r in out)
    assert max(gathered, default=0) <= 5


def test_text_rules_reject_repeated_short_lines(spark):
    """40 to 60 % duplicate short lines in a clean group; one repeated heading in a short text is no fault."""
    prepare(spark)
    pick = random.Random(5)

    def words(n):
        return " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randint(3, 7))) for _ in range(n))

    rows = [(i, "\n".join(words(12) for _ in range(10))) for i in range(200)]
    # Short lines come again, with other lines between: 40, 45, 50 and 60 % of the lines.
    for i, (short, times) in enumerate([(1, 5), (1, 10), (2, 4), (2, 10)]):
        blocks = ["\n".join(["read more", "next page"][:short] + [words(12)]) for _ in range(times)]
        rows.append((1000 + i, "\n".join(blocks)))
    heading = words(8)
    rows.append((2000, "\n".join([heading, words(45), heading, words(45)])))
    frame = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in textrules.judge_texts(frame).collect()}
    assert not any(r.base_failed for r in found.values())
    assert [found[1000 + i].kept for i in range(4)] == [False] * 4
    assert found[2000].n_dup_lines == 1 and found[2000].n_repeat_words > 0 and found[2000].kept
    assert all(found[i].kept for i in range(200))
    assert abs(textrules.consistency(0.75) - 1.4865) < 0.001


def test_secret_in_many_documents_of_one_owner(spark):
    """One value in 100 documents of one source, 40 of them copies; one in the texts of three sources."""
    prepare(spark)
    own, shared = "Xk3vQ9zLm2PwT7rBn4Yc", "aB3dE6gH9jK2mN5pQ8sT"
    rows = [(i, f"page {min(i, 60)} uses {own} here", "s") for i in range(100)]
    rows += [(200 + i, f"use {shared} here", f"s{i}") for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r.secrets for r in secrets.scan_secrets(frame).collect()}
    assert all([(s["kind"], s["owners"], s["repositories"], s["live"]) for s in found[i]] == [("opaque", 1, 61, True)] for i in range(100))
    assert [found[200 + i] for i in range(3)] == [[]] * 3


def test_spread_of_a_value_inside_its_owners(spark):
    """A template of one owner, an example that two owners share, a credential that leaked to a second owner."""
    prepare(spark)
    template, example, leaked = "Xk3vQ9zLm2PwT7rBn4Yc", "aB3dE6gH9jK2mN5pQ8sT", "Zq8wE5rT2yU7iO4pA1sD"
    rows = [(i, f"page {i} uses {template} here", "s") for i in range(150)]
    rows += [(1000 + i, f"text {i} shows {example}", "t" if i % 2 else "u") for i in range(8)]
    rows += [(2000 + i, f"note {i} has {leaked}", "v" if i else None) for i in range(5)]
    rows += [(3000 + i, f"more text {i}", "s") for i in range(1350)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def listed(**limits):
        found = secrets.scan_secrets(frame, **limits).where(F.size("secrets") > 0).select("doc_id").collect()
        return sorted(r.doc_id for r in found)

    # 150 of the 1,500 texts of its owner are a tenth of them, and no more.
    assert listed() == [*range(150), *range(2000, 2005)]
    assert listed(template_share=0.09) == [*range(2000, 2005)]
    assert listed(main_share=0.5, few=150) == [*range(150), *range(1000, 1008), *range(2000, 2005)]


def test_tables_of_a_bucket_are_bounded(monkeypatch):
    """Short template texts, ten shingles each and three of their own, in small tables on both sides."""
    monkeypatch.setattr(neardup, "CELLS", 5000)
    sets = [np.array([*range(7), *range(100 + 3 * i, 103 + 3 * i)], np.int64) for i in range(300)]
    made, zeros, sizes = [], np.zeros, np.zeros((300, 300), np.int64)

    def counting(shape, *args):
        made.append(int(np.prod(shape)))
        return zeros(shape, *args)

    monkeypatch.setattr(neardup.np, "zeros", counting)
    for row, column, table in neardup._common(sets, sets):
        made.append(table.size)
        sizes[row : row + table.shape[0], column : column + table.shape[1]] += table.astype(np.int64)
    assert (sizes == np.where(np.eye(300, dtype=bool), 10, 7)).all()
    assert max(made) <= 5000


def test_passages_below_the_byte_length_are_reported(spark):
    """Every row that shares 50 words with another has shared windows; a row that shares no 26 words has none."""
    prepare(spark)
    pick = random.Random(12)

    def words(n):
        return ["".join(pick.choice("abcdefgh") for _ in range(pick.randint(1, 5))) for _ in range(n)]

    rows, passages = [], [words(50) for _ in range(8)]
    for i in range(60):
        middle = passages[i % 8] if i < 30 else []
        rows.append((i, " ".join(words(pick.randrange(0, 90)) + middle + words(pick.randrange(0, 90)))))
    rows += [(100, " ".join(passages[0])), (100, "x"), (101, None), (102, ""), (None, " \n ".join(passages[1])), (103, " ".join(passages[0][:25]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.remove_repeats(docs, digest=True)
    texts = [(t or "").split() for _, t in rows]

    def runs(n):
        held = Counter(w for t in texts for w in {tuple(t[i : i + n]) for i in range(len(t) - n + 1)})
        return [any(held[tuple(t[i : i + n])] > 1 for i in range(len(t) - n + 1)) for t in texts]

    got = sorted((r.n_bytes, r.n_shared > 0) for r in found.collect())
    sizes = [len((t or "").encode()) for _, t in rows]
    assert got == sorted(zip(sizes, runs(50))) == sorted(zip(sizes, runs(26)))
    assert sum(x for _, x in got) >= 30 and found.agg({"n_removed": "sum"}).first()[0] == 0


def test_shapes_of_whole_words(spark):
    """Words alike in their first bytes differ in shape; long words are not remembered."""
    codes = quality.TermCodes()
    start = b"abcdefghijklmnopqrst"
    shapes = {codes[start + end] % quality.SHAPES for end in (b"", b"7", b"-x", b"X", b"!?")}
    assert len(shapes) == 5 and codes[start] % quality.SHAPES == codes[b"zz"] % quality.SHAPES
    codes[b"x" * 5000]
    assert max(map(len, codes)) < 100


def test_rarity_is_counted_over_all_documents(spark):
    prepare(spark)
    rows = [("common word",)] * 30 + [("rare common",), (None,), ("",), ("  \n",)]
    found = quality.rarity(spark.createDataFrame(rows, "text string").repartition(4))
    bucket = {w: quality.TermCodes()[w] // quality.SHAPES for w in (b"common", b"word", b"rare", b"nowhere")}
    for word, n in ((b"common", 31), (b"word", 30), (b"rare", 1), (b"nowhere", 0)):
        assert found[bucket[word]] == pytest.approx(np.log(32 / (1 + n)))
    assert quality.rarity(spark.createDataFrame([], "text string")).tolist() == [0.0] * quality.WORDS


def test_a_long_repeated_line_is_no_heading(spark):
    """18 % of the words in one repeated line of 40 are a fault; a heading of three words is none."""
    prepare(spark)
    pick = random.Random(3)

    def words(n):
        return " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randint(3, 7))) for _ in range(n))

    rows = [(i, "\n".join(words(11) for _ in range(40))) for i in range(400)]
    long, heading = words(40), words(3)
    rows.append((1000, "\n".join([long, *(words(12) for _ in range(31)), long])))
    rows.append((1001, "\n".join([heading, *(words(12) for _ in range(18)), heading, *(words(12) for _ in range(18))])))
    frame = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in textrules.judge_texts(frame).collect()}
    assert not found[1000].base_failed and found[1000].n_repeat_words == 80 and not found[1000].kept
    assert found[1001].n_dup_lines == 1 and found[1001].kept and all(found[i].kept for i in range(400))


def least_determinant(x, share=0.75):
    """The estimate in plain numpy: three starts of two steps, the least goes on until it settles."""
    n, ridge = len(x), np.diag(textrules.RIDGE)
    ordered = np.sort(x, axis=0)
    q1, q2, q3 = (ordered[max(0, int(np.ceil(p * n)) - 1)] for p in (0.25, 0.5, 0.75))

    def step(centre, scatter):
        d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
        part = x[d <= np.sort(d)[int(np.ceil(share * n)) - 1]]
        return part.mean(axis=0), textrules.consistency(share) * np.cov(part.T, bias=True) + ridge

    def logdet(e):
        return np.linalg.slogdet(e[1])[1]

    starts = [(q2, ridge), (q2, np.diag(((q3 - q1) / 1.349) ** 2) + ridge), (x.mean(axis=0), np.cov(x.T, bias=True) + ridge)]
    ends = [step(*step(*s)) for s in starts]
    best = min(ends, key=logdet)
    while True:
        found = min(best, step(*best), key=logdet)
        if logdet(best) - logdet(found) < 1e-3:
            return [logdet(e) for e in ends], logdet(found), found[0]
        best = found


def test_least_determinant_of_several_starts(spark):
    """Two groups, one without a name; a third of the rows lies elsewhere and would draw a start from the means."""
    made = {}
    for name, seed in (("a", 1), (None, 5)):
        rng = np.random.default_rng(seed)
        near = rng.normal(0, [1, 0.05, 0.6, 0.4], (200, 4))
        near[:, 2] += 0.9 * near[:, 0]
        made[name] = np.concatenate([near, rng.normal([4, 1, -3, 2], 0.3, (100, 4))])
    rows = [(name, *map(float, r)) for name, x in made.items() for r in x]
    frame = spark.createDataFrame(rows, "g string, " + ", ".join(f"{f} double" for f in textrules.FEATURES))
    found = {r.g: r for r in textrules.robust_scatter(frame, ["g"]).collect()}
    assert set(found) == set(made)
    for name, x in made.items():
        ends, least, centre = least_determinant(x)
        assert max(ends) - min(ends) > 0.01
        assert abs(found[name].logdet - least) < 0.01
        assert np.allclose([found[name][f"m{i}"] for i in range(4)], centre, atol=0.02)
    assert textrules.robust_scatter(frame.where("false"), ["g"]).count() == 0
