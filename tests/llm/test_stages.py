"""Every pipeline stage on NULL, empty, repeated and clashing rows, and on an empty table."""

from collections import Counter

import corpus_pipeline
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_cases import CASES, SCHEMA

CLASHING = ["score", "predicted", "held_out", "y", "n_lines", "n_removed", "key_", "id", "text_hash", "kept", "h_", "items", "n_words", "contaminated", "C0"]
FILTERS = dict(corpus_pipeline.STAGES[:4])


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame([(*r, len(r[1] or "")) for r in CASES], SCHEMA)
    return rows.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHING])


@pytest.mark.parametrize("name", list(FILTERS))
def test_rows_of_every_kind(spark, docs, name):
    found = FILTERS[name](spark, docs, SMALL)
    assert found.columns == docs.columns and found.schema.simpleString() == docs.schema.simpleString()
    rows = found.collect()
    for r in rows:
        assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for c in CLASHING)
        assert name == "line_dedup" or r.n_chars == len(r.text or "")
    left, given = Counter(r.doc_id for r in rows), Counter(r[0] for r in CASES)
    assert not left - given
    texts = {(r.doc_id, r.text) for r in rows}
    if name == "line_dedup":
        assert {r.text for r in rows if r.doc_id == 4} == {None} and {r.n_chars for r in rows if r.doc_id == 5} == {0}
        assert {r.text for r in rows if r.doc_id == 7} == {"one"}
    if name == "near_dedup":
        assert {1, 4, 5, 6, 7} <= set(left) and not {2, 3} & set(left) and (None, None) in texts
    if name == "decontaminate":
        assert left == given


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, docs, name):
    found = dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), SMALL)
    assert found.collect() == [] and (name == "packing" or found.columns == docs.columns)


def test_packing_of_rows_of_every_kind(spark, docs):
    rows = corpus_pipeline.packing(spark, docs, SMALL).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r[0] for r in CASES)
    assert all(r.doc_tokens == 1 for r in rows if r.doc_id in (4, 5))
