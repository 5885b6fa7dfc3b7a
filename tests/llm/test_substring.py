"""Operator 11 against plain sets of windows, and the rows it must take."""

import re

import numpy as np
import pytest

from conftest import SMALL
from llm_cases import none, odd  # noqa: F401
from wakeline.llm import substring
from wakeline.llm.common import table

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """Sorted (key, n_words, spans, kept text) of (key, text) rows."""
    words = [(float("inf") if k is None else k, SPACE.findall(t or "")) for k, t in rows]
    first = {}
    for k, w in words:
        for i in range(len(w) - window + 1):
            at = tuple(w[i:i + window])
            first[at] = min(first.get(at, k), k)
    out = []
    for (key, _), (k, w) in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < k:
                gone[i:i + window] = [True] * window
        edges = [i for i in range(len(w) + 1) if (gone[i - 1] if i else False) != (gone[i] if i < len(w) else False)]
        out.append((key, len(w), list(zip(edges[::2], edges[1::2])), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def found(df, **how):
    return sorted(((r[0], r.n_words, [tuple(s) for s in r.spans], r.kept_text) for r in substring.substring_dedup(df, **how).collect()), key=repr)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture
def tiny(monkeypatch):
    """Blocks, partitions and ranges so small that a few texts fill many."""
    monkeypatch.setattr(substring, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(substring, "RANGE_WINDOWS", 50)


def test_small_table(spark, tiny):
    docs = table(spark, SMALL, "documents")
    assert found(docs.repartition(3)) == brute(rows_of(docs), 50)


def test_small_table_in_one_block(spark):
    docs = table(spark, SMALL, "documents")
    assert found(docs) == brute(rows_of(docs), 50)


def test_odd_rows(spark, odd, tiny):
    assert found(odd, window=4) == brute(rows_of(odd), 4)
    assert found(odd) == brute(rows_of(odd), 50)


def test_overlaps_repeats_and_equal_keys(spark, tiny):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):  # few words, so that windows of every kind of overlap repeat
        rows.append((int(rng.integers(0, 120)), " ".join(f"w{x}" for x in rng.integers(0, 3, int(rng.integers(0, 40))))))
    rows += [(7, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (None, "z z z z z z"), (None, "z z z z z z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for window in (1, 2, 5):
        assert found(df, window=window) == brute(rows, window)


def test_one_passage_in_a_third_of_all_rows(spark, tiny):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(30)) + (" " + passage if i % 3 == 0 else "")) for i in range(1, 200)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert got == brute(rows, 50)
    assert [r[0] for r in got if r[2]] == [k for k in sorted((i for i, _ in rows), key=str) if k % 3 == 0 and k != 3]


def test_white_space_and_words_are_those_of_the_pattern(spark):
    text = "a b c\x1cd\x85e\tf\x0bg"
    assert found(spark.createDataFrame([(1, text)], "doc_id long, text string")) == brute([(1, text)], 50)


def test_empty_table(spark, none):
    assert substring.substring_dedup(none).count() == 0


def test_blocks_are_read_without_a_shuffle(spark, tiny):
    docs = table(spark, SMALL, "documents")
    blocks, bits = substring.in_blocks(docs, "text", "doc_id")
    assert bits > 0
    counted = blocks.groupBy("block").applyInArrow(lambda t: t.select(["block"]), "block long")
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()


def test_rolling_hash_is_the_same_wherever_a_window_begins():
    codes = np.random.default_rng(1).integers(0, 2**63, 200).astype(np.uint64)
    twice = np.concatenate([codes, codes[:7], codes])
    h = substring.rolling(twice, substring.BASES[0], 20)
    assert (h[:181] == h[207:388]).all() and len(set(h[:181].tolist())) == 181
