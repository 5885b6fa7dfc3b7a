"""Operators 1 and 10 against the tokenizer libraries."""

import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SMALL
from llm_cases import none, odd  # noqa: F401
from wakeline.llm import bpe, packing
from wakeline.llm.common import table


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(bpe.RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_matches_library_on_any_text(ranks, library):
    replay, find = bpe.MergeReplay(ranks), regex.compile(public_tokenizers.PATTERN).findall

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(max_size=40), max_size=4))
    def check(texts):
        table_ = bpe.WordTable(replay)
        ids, counts = table_.encode([find(t) for t in texts])
        for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1]) if texts else []):
            assert part.tolist() == library.encode_ordinary(text)

    check()


def test_replay_with_merges_that_enable_lower_ranks():
    # (a, b) merges at 300 and only then makes (ab, c) possible, at a lower rank; runs of one letter overlap.
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 300, b"abc": 280, b"aa": 290, b"aaa": 310, b"ca": 305}
    library = tiktoken.Encoding("tiny", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    replay = bpe.MergeReplay(ranks)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.text("abc", min_size=1, max_size=14), min_size=1, max_size=6))
    def check(words):
        ids, counts = replay.encode([w.encode() for w in words])
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [library.encode_ordinary(w) for w in words]

    check()


@pytest.mark.parametrize("long", [0, 3, 256])
def test_long_words_rank_by_rank_and_short_ones_side_by_side(ranks, library, monkeypatch, long):
    monkeypatch.setattr(bpe, "LONG", long)
    monkeypatch.setattr(bpe, "BAND", 4)
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 60)
    replay = bpe.MergeReplay(ranks)
    odd_words = ["a" * 300, " " * 700, "ab" * 150, "日本語" * 90, "e\u0301" * 40, "x", "\x00\x00\x00", "0" * 257, "Zé" * 85 + "z"]

    @settings(max_examples=100, deadline=None)
    @given(st.lists(st.one_of(st.text(min_size=1, max_size=30), st.text("aeinrst", min_size=1, max_size=400),
                              st.sampled_from(odd_words)), max_size=8))
    def check(words):
        ids, counts = replay.encode([w.encode() for w in words])
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if words else []
        assert got == [library._core_bpe.encode_single_piece(w.encode()) for w in words]

    check()


def test_pairs_lead_to_every_token_and_to_nothing_else(ranks):
    pairs = bpe.Pairs(ranks)
    some = np.random.default_rng(1).integers(0, len(ranks), (2, 50_000))
    token = {rank: t for t, rank in ranks.items()}
    want = [ranks.get(token[a] + token[b], -1) for a, b in some.T.tolist()]
    assert pairs.merge(some[0], some[1]).tolist() == want
    split = [(ranks[t[:1]], ranks[t[1:]], rank) for t, rank in ranks.items() if len(t) > 1 and t[1:] in ranks]
    left, right, merged = np.array(split).T
    assert (pairs.merge(left, right) == merged).all()
    assert (pairs.merge(np.append(left, -1), np.append(np.full(len(left), -1), 97)) == -1).all()
    assert bpe.Pairs({bytes([i]): i for i in range(256)}).merge(left, right).max() == -1


def test_new_words_are_replayed_without_a_step_of_python_for_each(ranks, library):
    letters = np.random.default_rng(2).choice(list("aeionrstlmdu"), (20_000, 9))
    words = ["".join(w).encode() for w in letters]
    replay, calls = bpe.MergeReplay(ranks), []
    sys.setprofile(lambda frame, event, _: calls.append(event))
    try:
        ids, counts = replay.encode(words)
    finally:
        sys.setprofile(None)
    assert len(calls) < len(words)
    for word, part in list(zip(words, np.split(ids, np.cumsum(counts)[:-1])))[::50]:
        assert part.tolist() == library._core_bpe.encode_single_piece(word)


def test_op1_on_the_table_and_odd_rows(spark, odd, none, library):
    for docs in (table(spark, SMALL, "documents"), odd):
        rows = bpe.decode(bpe.encode(docs)).select("text", "ids", "decoded").collect()
        assert len(rows) == docs.count()
        for row in rows:
            assert row.ids == library.encode_ordinary(row.text or "")
            assert bytes(row.decoded) == (row.text or "").encode()
    assert bpe.decode(bpe.encode(none)).count() == 0
    assert set(odd.columns) <= set(bpe.encode(odd).columns)


def test_decode_gives_null_for_null_and_refuses_unknown_ids(spark):
    rows = spark.createDataFrame([([64, 65],), (None,), ([],)], "ids array<int>")
    assert [r.decoded is None for r in bpe.decode(rows).collect()] == [False, True, False]
    with pytest.raises(Exception):
        bpe.decode(spark.createDataFrame([([10_000_000],)], "ids array<int>")).collect()


def test_small_blocks_give_the_same_ids(spark, monkeypatch, library):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 700)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    for row in bpe.encode(table(spark, SMALL, "documents").limit(40)).select("text", "ids").collect():
        assert row.ids == library.encode_ordinary(row.text)


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(packing.VOCABULARY)
    found.encode_special_tokens = True
    return found


def test_word_ids_match_library(tokenizer):
    known = packing.WordIds(open(packing.VOCABULARY, encoding="utf-8").read())
    extra = st.sampled_from(["don't", "A.B", "x..,", "ÉCOLE", "ﬁn", "İi", "1st", "a\x1cb", "é", "!?", "ΟΔΟΣ", "<|endoftext|>", "Straße,", "ŉŁĿ", "Àé.",
                             "ſs", "A\u0301b", "ª", "µ"])

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.one_of(st.text(max_size=12), extra), max_size=8))
    def check(parts):
        text = " ".join(parts)
        places = known.places(packing.words_of(text))
        known.learn()
        assert known.ids(places).tolist() == tokenizer.encode(text, add_special_tokens=False).ids

    check()
    letters = " ".join(chr(c) + chr(d) for c in range(0x21, 0x300) for d in (c, 0x61, 0x2E))
    places = known.places(packing.words_of(letters))
    known.learn()
    assert known.ids(places).tolist() == tokenizer.encode(letters, add_special_tokens=False).ids


def test_letters_with_punctuation_behind_need_no_splitting(tokenizer):
    """All runs of two ASCII marks behind plain and accented words, without a call of the splitter or of translate."""
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    words = [stem + a + b for stem in ("word", "Éçole", "s", "ŉß") for a in marks for b in ["", *marks, "'###"]]
    known, called = packing.WordIds(open(packing.VOCABULARY, encoding="utf-8").read()), set()
    known.units = packing.Units(known.tokenizer)
    places = known.places(words)
    sys.setprofile(lambda frame, event, of: called.add(of.__name__) if event == "c_call" else None)
    try:
        known.learn()
    finally:
        sys.setprofile(None)
    assert not called & {"pre_tokenize_str", "normalize_str", "translate"}
    assert known.ids(places).tolist() == tokenizer.encode(" ".join(words), add_special_tokens=False).ids


def test_units_are_kept_between_tasks_and_forgotten_when_too_many(tokenizer, monkeypatch):
    vocabulary = open(packing.VOCABULARY, encoding="utf-8").read()
    monkeypatch.setattr(packing, "KEPT", 5)
    for words in (["Some", "words,", "çà!!", "1st", (49407,), "don't"], ["words", "Some.", "other", "ÇÀ", (49406,)], [(49407,), "1st"]):
        known = packing.WordIds(vocabulary)
        places = known.places(words)
        known.learn()
        want = [i for w in words for i in (w if isinstance(w, tuple) else tokenizer.encode(w, add_special_tokens=False).ids)]
        assert known.ids(places).tolist() == want
        assert known.units is packing.worker_memory(vocabulary)
        known.units.trim()
        assert len(known.units) == len(known.units.size) <= 5


def check_packed(rows, texts, tokenizer, capacity=packing.CAPACITY):
    """Every id in exactly one piece, offsets gapless, no sequence too long; returns tokens and padded length."""
    want = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END], "<u4") for t in texts]
    left = sorted((zlib.crc32(w[s:s + capacity].tobytes()), s, len(w[s:s + capacity]), len(w))
                  for w in want for s in range(0, len(w), capacity))
    assert sorted((r.ids_crc32, r.start, r.length, r.doc_tokens) for r in rows) == left
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(map(len, want)), len(sequences) * capacity


def test_op10_on_the_table_and_odd_rows(spark, odd, none, tokenizer):
    for docs in (table(spark, SMALL, "documents"), odd):
        texts = [r.text for r in docs.select("text").collect()]
        tokens, room = check_packed(packing.digest(packing.pack(docs)).collect(), texts, tokenizer)
        assert room - tokens < 0.06 * tokens + 2 * packing.CAPACITY
    assert packing.pack(none).count() == 0


def test_packing_crosses_groups_and_blocks(spark, monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "GROUP", 4)
    monkeypatch.setattr(packing, "BLOCK_BYTES", 900)
    monkeypatch.setattr(packing, "REMEMBERED", 100)
    monkeypatch.setattr(packing, "KEPT", 30)
    docs = table(spark, SMALL, "documents").repartition(3, "doc_id").cache()
    rows = packing.digest(packing.pack(docs, capacity=512)).collect()
    check_packed(rows, [r.text for r in docs.select("text").collect()], tokenizer, 512)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
def test_windows_stay_within_capacity_and_near_equal(sizes):
    window = packing.balanced(np.array(sizes), 100)
    sums = np.bincount(window, weights=sizes)
    assert (window >= 0).all() and sums.max() <= 100
    assert len(sums) <= 2 * -(-sum(sizes) // 100)


def test_differencing_known_case():
    # 8 7 6 5 4 in two ways: largest differencing ends with 16 and 14.
    way = packing.differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(way, weights=[8, 7, 6, 5, 4])) == [14, 16]


def test_added_tokens_are_one_id_as_by_default_settings(spark, tmp_path):
    """op10 and the pipeline's stage against a tokenizer as the library loads it."""
    default = Tokenizer.from_file(packing.VOCABULARY)
    known = packing.WordIds(open(packing.VOCABULARY, encoding="utf-8").read())
    added = packing.AddedTokens(default)
    part = st.one_of(st.text(max_size=6), st.sampled_from(
        ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "<|", "|>", "\u0301", "don", "'t", " ", "\x1c"]))

    @settings(max_examples=300, deadline=None)
    @given(st.lists(part, max_size=8))
    def check(parts):
        text = "".join(parts)
        places = known.places(added.words_of(text))
        known.learn()
        assert known.ids(places).tolist() == default.encode(text, add_special_tokens=False).ids

    check()
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|><|endoftext|>y" * 3000, "plain", "", None]
    rows = [(i, t, "en", "a", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    check_packed(packing.op10(spark, str(tmp_path)).collect(), texts, default)
    check_packed(corpus_pipeline.pack(spark, docs, SMALL).collect(), texts, default)
