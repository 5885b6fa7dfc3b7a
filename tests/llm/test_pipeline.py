"""The pipeline's stages against plain Python, each on what the one before it kept."""

import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SMALL
from llm_cases import none, odd  # noqa: F401
from test_exact_secrets_chat import brute_spans
from test_similar import brute_links, runs_of
from test_tokens import check_packed
from wakeline.llm import packing, secrets, toxicity
from wakeline.llm.common import DOCUMENT_COLUMNS, table

STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returns over the small table."""
    out, docs = {"documents": table(spark, SMALL, "documents").cache()}, table(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
        out[name] = docs
    return out


def rows(df):
    return sorted(df.select(*DOCUMENT_COLUMNS).collect(), key=lambda r: r.doc_id)


def test_toxic_documents_go(spark, kept):
    docs = table(spark, SMALL, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, SMALL, "labels"))).select("doc_id", "score").collect()
    assert {r.doc_id for r in rows(kept["toxicity"])} == {r.doc_id for r in scored if r.score < 0.5}


def test_one_of_equal_texts_stays(kept):
    best = {}
    for r in rows(kept["toxicity"]):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r)
    assert rows(kept["exact_dedup"]) == sorted(best.values(), key=lambda r: r.doc_id)


def test_one_of_near_copies_stays(kept):
    before = rows(kept["exact_dedup"])
    _, ties = brute_links([runs_of(r.text) for r in before], 0.8)
    assert rows(kept["ngram_jaccard"]) == [r for i, r in enumerate(before) if ties.find(i) == i]


def test_secrets_are_marked_and_the_rest_is_left(kept):
    before, after = rows(kept["ngram_jaccard"]), rows(kept["secrets"])
    assert len(before) == len(after)
    for a, b in zip(before, after):
        spans = brute_spans(a.text, secrets.RULES)
        if not spans:
            assert a == b
        else:
            assert b.text.count("[secret]") >= 1 and b.n_chars == len(b.text)
            assert all(a.text[s:e] not in b.text for s, _, e in spans)


def test_all_that_is_kept_is_packed(kept):
    found = Tokenizer.from_file(packing.VOCABULARY)
    found.encode_special_tokens = True
    check_packed(kept["packing"].collect(), [r.text for r in rows(kept["secrets"])], found)


def test_run_gives_the_last_stage(spark, kept):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, SMALL).select(*columns).collect()) == sorted(kept["packing"].select(*columns).collect())


@pytest.mark.parametrize("name", list(STAGE))
def test_odd_rows_and_no_rows(spark, odd, none, name):
    out = STAGE[name](spark, odd, SMALL)
    if name != "packing":
        assert out.columns == list(DOCUMENT_COLUMNS)
    assert out.count() > 0
    if name != "packing":
        assert out.where(F.col("doc_id") == 7).count() == 1
    assert STAGE[name](spark, none, SMALL).count() == 0


def test_texts_reach_python_in_small_batches(spark):
    """10,000 whole documents at once are more memory than a task may take; a smaller setting of the user stays."""
    from wakeline.llm import packing, toxicity
    from wakeline.llm.common import BATCH_ROWS, TEXT_ROWS

    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(5)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    before = spark.conf.get(BATCH_ROWS)
    try:
        for step in (lambda: packing.pack(docs), lambda: toxicity.score(docs, toxicity.fit(docs, labels))):
            for given, expected in (("10000", TEXT_ROWS), ("0", TEXT_ROWS), ("7", 7)):
                spark.conf.set(BATCH_ROWS, given)
                assert step().count() == 5
                assert int(spark.conf.get(BATCH_ROWS)) == expected
    finally:
        spark.conf.set(BATCH_ROWS, before)
