"""Registered queries against the plain versions on a small table."""

import struct
import zlib
from collections import defaultdict

import brute
import pyarrow.parquet as pq
import pytest
from conftest import SMALL

from tradeledger.llm.queries import QUERIES, tokenizer_definition


def table(name, *columns):
    found = pq.read_table(f"{SMALL}/{name}.parquet", columns=list(columns)).to_pydict()
    return list(zip(*found.values(), strict=True))


DOCS = table("documents", "doc_id", "text")


def got(spark, key, *columns):
    return sorted(tuple(r) for r in QUERIES[key](spark, SMALL).select(*columns).collect())


def test_decontaminate(spark):
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute.decontaminated(DOCS, table("benchmark", "item_id", "text"))
    assert got(spark, "op1_decontaminate", *columns) == sorted(want)
    assert any(r[2] for r in want)


def test_pack_holds_every_id_once(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_definition())
    ids = {doc: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1] for doc, text in DOCS}
    rows = QUERIES["op2_pack"](spark, SMALL).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id])
        assert len(part) == r.length
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, of in ids.items():
        at = 0
        for start, length in sorted(pieces[doc]):
            assert start == at
            at += length
        assert at == len(of)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        assert at & (at - 1) == 0


def test_secrets(spark):
    rows = {r.doc_id: r for r in QUERIES["op3_secrets"](spark, SMALL).collect()}
    for doc, text in DOCS:
        base = brute.base_secrets(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = rows[doc]
        kinds = [k for k, _, _ in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(kinds.count, ("assign", "access", "hex")))
        assert r.base_sha256 == brute.sha(joined)
        assert {x for x in joined.split(",") if x} <= set(r.spans.split(","))


def test_near_duplicates(spark):
    want = brute.near_duplicates(DOCS)
    assert got(spark, "op4_neardup", "doc_id", "n_shingles", "component_id", "kept") == sorted(want)
    assert not all(r[3] for r in want)


@pytest.mark.parametrize(("key", "label", "folds", "fold"), [
    ("op5_quality", "quality", 5, 0), ("op10_toxicity", "toxic", 4, 2),
])
def test_classifiers_on_held_out_rows(spark, key, label, folds, fold):
    folder = SMALL.replace("sf0.001", "sf0.1")
    labels = dict(zip(*(pq.read_table(f"{folder}/labels.parquet")[c].to_pylist() for c in ("doc_id", label)), strict=True))
    rows = QUERIES[key](spark, folder).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (brute.crc_fold(r.doc_id, folds) == fold) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    right = [r.predicted == labels[r.doc_id] for r in held]
    assert sum(right) / len(right) > 0.95


def test_urls(spark):
    columns = ("page_id", "host", "path", "rule", "verdict")
    rows = {r.page_id: r for r in QUERIES["op6_urls"](spark, SMALL).select(*columns).collect()}
    pages = table("pages", "page_id", "url")
    assert len(rows) == len(pages)
    for page, url in pages:
        host, path, rule, verdict = brute.url_base(url)
        r = rows[page]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert any(r.rule is None and r.verdict == "block" for r in rows.values())


def test_text_rules(spark):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got(spark, "op7_textrules", *columns) == sorted((doc, *brute.text_base(text)) for doc, text in DOCS)
    assert not any(base and kept for base, kept in got(spark, "op7_textrules", "base_failed", "kept"))


def test_line_dedup(spark):
    want = [(d, n, gone, brute.sha(left)) for d, n, gone, left in brute.without_lines(DOCS)]
    assert got(spark, "op8_linedup", "doc_id", "n_lines", "n_removed", "kept_sha256") == sorted(want)
    assert any(r[2] for r in want)


def test_repeats(spark):
    want = brute.without_repeats(DOCS, 400)
    assert got(spark, "op9_repeats", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want)
    assert any(r[2] for r in want)
