"""Operator 10, packing: token sequences of near-equal length by multiway differencing."""

from __future__ import annotations

import heapq
import re
import sys
import types
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain, islice
from string import punctuation

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wakeline.llm.bpe import blocks, gather
from wakeline.llm.common import bounded_batches, quoted, store, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CAPACITY, END = 4096, 2
#: Sequences that are balanced together, and the tokens up to which neighbouring short pieces are balanced as one.
GROUP, CRUMB = 256, 64
#: Bytes of text tokenised together, words that a task remembers, and words and units it keeps when they are too many.
BLOCK_BYTES, REMEMBERED, KEPT = 2_000_000, 300_000, 120_000

#: The last letter of the Latin blocks whose letters are composed, and never combine.
LAST_LATIN = "\u017f"
#: How byte-level tokenizers show a byte: as itself where it prints, else as the next letter from 256 on.
_PRINTS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTS]
SHOWN = "".join(chr(256 + _OTHERS.index(b) if b in _OTHERS else b) for b in range(256))


def differencing(sizes: np.ndarray, ways: int) -> np.ndarray:
    """The way (0 to ways-1) of each item, by Karmarkar and Karp's differencing.

    Each partial partition is a row of ``ways`` sums in rising order. The two whose largest and smallest sums differ
    most are merged with opposing order, the largest sum of one on the smallest of the other, until one is left.
    """
    if ways == 1 or len(sizes) == 0:
        return np.zeros(len(sizes), np.int64)
    # A node is an item or the union of two nodes; a partial partition of one item is kept as that item.
    lefts: list[np.ndarray] = []
    rights: list[np.ndarray] = []
    nodes = len(sizes)
    made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    queue = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(queue)
    tie = len(sizes)

    def taken(i: int) -> tuple[np.ndarray, np.ndarray]:
        if i in made:
            return made.pop(i)
        sums, held = np.zeros(ways, np.int64), np.full(ways, -1, np.int64)
        sums[-1], held[-1] = sizes[i], i
        return sums, held

    while len(queue) > 1:
        _, i = heapq.heappop(queue)
        _, j = heapq.heappop(queue)
        (a, na), (b, nb) = taken(i), taken(j)
        b, nb = b[::-1], nb[::-1]
        both = (na >= 0) & (nb >= 0)
        held = np.where(na >= 0, na, nb)
        if count := int(both.sum()):
            lefts.append(na[both])
            rights.append(nb[both])
            held[both] = np.arange(nodes, nodes + count)
            nodes += count
        sums = a + b
        order = np.argsort(sums, kind="stable")
        sums, held = sums[order], held[order]
        made[tie] = sums, held
        heapq.heappush(queue, (-int(sums[-1] - sums[0]), tie))
        tie += 1
    _, held = taken(queue[0][1])
    way = np.full(nodes, -1, np.int64)
    way[held[held >= 0]] = np.flatnonzero(held >= 0)
    if lefts:
        left, right = np.concatenate(lefts), np.concatenate(rights)
        for k in range(len(left) - 1, -1, -1):  # a union was made after its parts
            way[left[k]] = way[right[k]] = way[len(sizes) + k]
    return way[: len(sizes)]


def balanced(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each piece; no window passes the capacity. Pieces of full capacity are windows by themselves."""
    window = np.full(len(lengths), -1, np.int64)
    full = np.flatnonzero(lengths >= capacity)
    window[full] = np.arange(len(full))
    rest = np.flatnonzero(lengths < capacity)
    if not len(rest):
        return window
    # Neighbouring crumbs go together: the items of a group stay fewer than its tokens / CRUMB x 2.
    size = lengths[rest]
    item, held, at = np.zeros(len(rest), np.int64), 0, -1
    for k, s in enumerate(size):
        if not (held and held + s <= min(CRUMB, capacity)):
            at, held = at + 1, 0
        item[k], held = at, held + s
    sizes = np.bincount(item, weights=size).astype(np.int64)
    ways = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        way = differencing(sizes, ways)
        most = int(np.bincount(way, weights=sizes, minlength=ways).max())
        if most <= capacity:
            break
        # More windows, by as much as the fullest stood out, are enough unless the next balance is worse.
        ways = max(ways + 1, -(-most * ways // capacity))
    window[rest] = len(full) + way[item]
    return window


def words_of(text: str) -> list[str]:
    """text at white space; the four separators that only Python takes for white space stay in the words."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [w for w in re.split(r"[^\S\x1c-\x1f]+", text) if w]
    return text.split()


class Units(dict):
    """The place of each unit that the tokenizer splits words into, and the ids of the units by place.

    A unit is written in the letters of byte-level tokenizers, or it is a tuple of ids that stands for these.
    """

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.fresh: list[str | tuple[int, ...]] = []
        self.flat, self.begin, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, unit: str | tuple[int, ...]) -> int:
        self[unit] = place = len(self)
        self.fresh.append(unit)
        return place

    def learn(self) -> None:
        """Have the model tokenise the units seen since the last time."""
        tokenize = self.tokenizer.model.tokenize
        found = [unit if isinstance(unit, tuple) else [t.id for t in tokenize(unit)] for unit in self.fresh]
        size = np.fromiter(map(len, found), np.int64, len(found))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), "<u4", int(size.sum()))])
        self.fresh = []

    def trim(self) -> None:
        """Keep the units that were met first, which are the frequent ones, if there are too many."""
        if len(self) > KEPT:
            kept = list(islice(self.items(), KEPT))
            self.clear()
            self.update(kept)
            self.begin, self.size = self.begin[:KEPT], self.size[:KEPT]
            self.flat = self.flat[:int(self.size.sum())]

    def ids(self, places: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.begin[places], self.size[places])


def worker_memory(vocabulary: str) -> Units:
    """The tokenizer and the units it has met, kept by a Python worker from task to task.

    A unit's ids depend on the vocabulary alone, so what is remembered never changes a result.
    """
    memory = sys.modules.setdefault("packing_worker_memory", types.ModuleType("packing_worker_memory")).__dict__
    if memory.get("vocabulary") != vocabulary:
        memory.update(vocabulary=vocabulary, units=Units(Tokenizer.from_str(vocabulary)))
    return memory["units"]


class AddedTokens:
    """Cuts texts where they hold the content of an added token, as the tokenizer does before its other steps."""

    def __init__(self, tokenizer: Tokenizer):
        tokens = tokenizer.get_added_tokens_decoder()
        for token in tokens.values():
            if token.normalized or token.lstrip or token.rstrip or token.single_word:
                raise ValueError(f"only added tokens that match as they are can be cut out, not {token.content!r}")
        self.ids = {token.content: i for i, token in tokens.items()}
        longest_first = sorted(self.ids, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})")

    def words_of(self, text: str) -> list[str | tuple[int]]:
        """The words between added tokens; each of these is a tuple of its id."""
        if not any(content in text for content in self.ids):
            return words_of(text)
        words: list[str | tuple[int]] = []
        for n, part in enumerate(self.cut.split(text)):
            words += [(self.ids[part],)] if n % 2 else words_of(part)
        return words


class WordIds(dict):
    """The place of each word, in the order of first sight, and the ids of the words by place.

    A tuple of ids in place of a word stands for these ids.
    """

    def __init__(self, vocabulary: str):
        super().__init__()
        self.units = worker_memory(vocabulary)
        self.tokenizer = self.units.tokenizer
        self.fresh: list[str | tuple[int]] = []
        self.flat, self.begin, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, word: str | tuple[int]) -> int:
        self[word] = place = len(self)
        self.fresh.append(word)
        return place

    def forget(self) -> None:
        """Keep the words and units that were met first, which are the frequent ones."""
        kept = list(islice(self.items(), KEPT))
        self.clear()
        self.update(kept)
        self.begin, self.size = self.begin[:len(kept)], self.size[:len(kept)]
        self.flat = self.flat[:int(self.size.sum())]
        self.units.trim()

    def places(self, words: list[str | tuple[int]]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def learn(self) -> None:
        """Tokenise the words seen since the last time, by the tokenizer's own three steps.

        A word of Latin letters with ASCII punctuation behind it needs no splitting by the tokenizer: the letters, in
        lower case, are one unit, the punctuation another; composed letters are in normal form already. All other words
        are normalised and split by it, joined by blanks.
        """
        if not self.fresh:
            return
        units, at, count, hard = self.units, [], [], []
        for n, word in enumerate(self.fresh):
            if isinstance(word, tuple):
                at.append(units[word])
                count.append(1)
                continue
            stem = word.rstrip(punctuation)
            unit = stem.lower()
            if not (stem.isalpha() and (stem.isascii() or max(stem) <= LAST_LATIN and unit.isalpha())):
                hard.append(n)
                count.append(0)
                continue
            if not unit.isascii():
                unit = charmap_decode(unit.encode(), "strict", SHOWN)[0]
            at.append(units[unit])
            if len(stem) < len(word):
                at.append(units[word[len(stem):]])
                count.append(2)
            else:
                count.append(1)
        owner = np.repeat(np.arange(len(count)), count)
        if hard:
            joined = self.tokenizer.normalizer.normalize_str(" ".join([self.fresh[i] for i in hard]))
            parts = joined.split(" ")
            if len(parts) != len(hard):
                raise ValueError("normalising made or removed a blank inside a word")
            ends = np.cumsum(np.fromiter((len(w) + 1 for w in parts), np.int64, len(parts)))
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str(joined)
            begins = np.fromiter((o[0] for _, o in split), np.int64, len(split))
            at += [units[unit] for unit, _ in split]
            owner = np.concatenate([owner, np.array(hard)[np.searchsorted(ends, begins, side="right")]])
        units.learn()
        order = np.argsort(owner, kind="stable")
        at, owner = np.array(at, np.int64)[order], owner[order]
        size = np.bincount(owner, weights=units.size[at], minlength=len(count)).astype(np.int64)
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, units.ids(at)])
        self.fresh = []

    def ids(self, places: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.begin[places], self.size[places])


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def id_type(vocabulary: str, end: int = END) -> str:
    """Two bytes hold the ids of vocabularies up to 65,536 tokens: between tasks they travel in as few as they can."""
    size = Tokenizer.from_str(vocabulary).get_vocab_size(with_added_tokens=True)
    return "<u2" if max(size, end + 1) <= 1 << 16 else "<u4"


def token_pieces(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY,
                 end: int = END, longest: int = CAPACITY, added_tokens: bool = False) -> DataFrame:
    """(part, before, key, start, length, doc_tokens, ids): each text's tokens and its end id, cut every ``longest``.

    ids are little-endian unsigned numbers, of as many bytes as ``id_type`` says for the vocabulary. part and before (tokens before the piece in its part) give the
    order. The tokenizer drops white space and never joins what it parts, so words at white space are tokenised once
    for each task, as far as it remembers, and looked up; the vocabulary file travels as a broadcast of its size.

    With ``added_tokens`` the content of an added token, such as <|endoftext|>, becomes its one id, as the library's
    ``encode`` has it by default; without, it is text like any other (``encode_special_tokens = True``).
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    narrow = id_type(shared.value, end)
    kind = docs.select(F.col(quoted(key)).alias("key"))
    schema = f"part int, before long, key {kind.dtypes[0][1]}, start long, length long, doc_tokens long, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds(shared.value)
        words = AddedTokens(known.tokenizer).words_of if added_tokens else words_of
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            row = 0
            for held in blocks(texts, sizes, BLOCK_BYTES):
                if len(known) > REMEMBERED:
                    known.forget()
                places = [known.places(words(t or "")) for t in held.to_pylist()]
                known.learn()
                rows = []
                for at in places:
                    ids = np.append(known.ids(at), np.uint32(end)).astype(narrow)
                    for start in range(0, len(ids), longest):
                        piece = ids[start:start + longest]
                        rows.append((row, before, start, len(piece), len(ids), piece.tobytes()))
                        before += len(piece)
                    row += 1
                at, befores, starts, lengths, totals, pieces = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(rows), pa.int32()), pa.array(befores, pa.int64()), keys.take(pa.array(at)),
                    pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(totals, pa.int64()),
                    pa.array(pieces, pa.binary())], names=["part", "before", "key", "start", "length", "doc_tokens", "ids"])
        known.units.trim()

    return docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")).mapInArrow(cut, schema)


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, **tokens) -> DataFrame:
    """(key, start, length, doc_tokens, sequence_id, offset, ids): where every piece of every document goes.

    Pieces are numbered by a running sum of tokens (within tasks, then over one row for each task), which deals them
    into groups of GROUP x capacity tokens. Each group is packed on its own: ``differencing`` makes the fewest windows
    that the tokens could fill near equal, and one more while any passes the capacity. A group's memory is bounded,
    whatever documents it holds; sequences come from one group, the last group being shorter. ids are little-endian
    unsigned 32-bit numbers.

    Null and empty texts have the end id alone. Null keys and repeated rows are documents of their own. Other columns
    are not read. An empty table gives no rows.
    """
    pieces = store(token_pieces(docs, text, key, longest=capacity, **tokens), "pieces")
    narrow = id_type(read_vocabulary(tokens.get("vocabulary", VOCABULARY)), tokens.get("end", END))
    ends = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.groupBy("part").agg(F.sum("length").alias("sum")).select(
        "part", F.coalesce(F.sum("sum").over(ends), F.lit(0)).alias("base"))
    # The bases have a row for each task that read documents, 12 bytes each: small enough to send at any size.
    dealt = pieces.join(F.broadcast(bases), "part").withColumn(
        "group", F.floor((F.col("base") + F.col("before")) / F.lit(GROUP * capacity)))
    schema = ", ".join(f"{c} {t}" for c, t in pieces.select(
        "key", "start", "length", "doc_tokens").dtypes) + ", sequence_id long, offset long, ids binary"

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "before"], kind="stable")
        length = group["length"].to_numpy()
        window = balanced(length, capacity)
        order = np.argsort(window, kind="stable")
        ends = np.cumsum(length[order])
        opens = np.concatenate([[True], np.diff(window[order]) != 0])
        offset = np.empty(len(length), np.int64)
        offset[order] = ends - length[order] - np.repeat((ends - length[order])[opens], np.diff(
            np.append(np.flatnonzero(opens), len(order))))
        ids = [np.frombuffer(x, narrow).astype("<u4").tobytes() for x in group["ids"]]
        return group.assign(sequence_id=group["group"] * (1 << 21) + window, offset=offset, ids=ids)[
            ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]]

    return dealt.groupBy("group").applyInPandas(place, schema).withColumnRenamed("key", key)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents").select("doc_id", "text"), added_tokens=True))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
