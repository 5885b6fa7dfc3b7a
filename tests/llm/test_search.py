"""Operator 13 against a plain ranking, and the rows it must take."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from llm_cases import none, odd  # noqa: F401
from wakeline.llm import search
from wakeline.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(items, docs, top=10):
    """items and docs: (key, text). (item, rank, doc, score) of all."""
    counts = [(k, Counter(terms(t))) for k, t in docs]
    held = Counter(t for _, c in counts for t in c)
    n, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    out = []
    for item, text in items:
        scores = []
        for key, c in counts:
            m = 10 + 90 * sum(c.values()) * n // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return Counter(out)


def pairs(df, key):
    return [tuple(r) for r in df.select(key, "text").collect()]


@pytest.mark.parametrize("postings", [search.BLOCK_POSTINGS, 900])
def test_small_tables(spark, postings):
    items, docs = table(spark, SMALL, "benchmark"), table(spark, SMALL, "documents")
    found = search.search(items, docs.repartition(5), block_postings=postings)
    assert Counter(map(tuple, found.collect())) == brute(pairs(items, "item_id"), pairs(docs, "doc_id"))


def test_odd_rows_ties_and_lists(spark, odd):
    items = spark.createDataFrame([
        (1, "ONE two tail", "x"), (1, "one two tail", "x"), (2, None, "x"), (3, "", "x"), (None, "café 北京", "x"), (4, "word1 and3", "x"),
    ], "item_id int, text string, score string")
    found = search.search(items, odd, top=3)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == brute(pairs(items, "item_id"), pairs(odd, "doc_id"), 3)


def test_equal_scores_go_by_key(spark):
    docs = spark.createDataFrame([(k, "same words here") for k in [9, 4, 7, 1, None, 30, 2]], "doc_id long, text string")
    items = spark.createDataFrame([("a", "words"), ("b", "none")], "item_id string, text string")
    # a word that all documents hold has a small weight still above 0
    got = [r.doc_id for r in search.search(items, docs.repartition(7), top=4).sort("rank").collect()]
    assert got in ([1, 2, 4, 7], [])
    assert bool(got) == bool(brute([("a", "words")], [(1, "same words here")] * 7))


def test_empty_tables(spark, none):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert search.search(items, none).count() == 0
    assert search.search(items.limit(0), none).columns == ["item_id", "rank", "doc_id", "score"]


def test_tasks_send_lists_not_documents(spark):
    docs = table(spark, SMALL, "documents").repartition(6)
    items = search.Items.build([(1, "the and of"), (2, "in on")])
    index = spark.sparkContext.broadcast(items)
    texts = docs.select(F.col("doc_id").alias("key"), "text")
    stats = search.statistics(texts, index)
    assert stats[0] <= docs.count()
    assert search.best_of_tasks(texts, index, "bigint", *stats, 5).count() <= 6 * 2 * 5
