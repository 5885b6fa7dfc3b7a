"""Operator 1, byte-level BPE: merges replayed over a whole block of words from an index of token pairs."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import put, quoted, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes whose new words are replayed together, words a worker remembers from earlier blocks, and pairs it remembers.
BLOCK_BYTES, REMEMBERED, PAIRS = 1_000_000, 200_000, 300_000
#: Entries that are taken out of the index together at least, and bytes up to which a word takes part in that.
BAND, LONG = 4_096, 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


#: Two numbers below WIDE = 1 << HALF are kept as one: a pair of tokens, or a rank and a slot.
HALF = 32
WIDE = 1 << HALF


class Pairs:
    """All pairs of tokens that merge and what they merge to, in an open hash table of arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = np.array(left, np.int64) * WIDE + np.array(right, np.int64)
        bits = (4 * len(keys) + 16).bit_length()
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.merged = np.full(1 << bits, -1, np.int64)
        at, todo = self.places(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] < 0]
            self.keys[at[free]] = keys[free]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & self.last
        self.merged[at] = merged

    def places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair merges to, -1 if there is none."""
        keys = left * WIDE + right
        at = self.places(keys)
        held = self.keys[at]
        found = np.where(held == keys, self.merged[at], -1)
        todo = np.flatnonzero((held != keys) & (held >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.last
            held = self.keys[at[todo]]
            found[todo] = np.where(held == keys[todo], self.merged[at[todo]], -1)
            todo = todo[(held != keys[todo]) & (held >= 0)]
        return found


class MergeReplay:
    """Applies the merges of a rank table to many words at once, in rank order."""

    def __init__(self, ranks: dict[bytes, int], merging: Pairs | None = None):
        self.ranks = ranks
        self.merging = merging or Pairs(ranks)
        self.token = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        self.of_bytes = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        self.pairs: dict[int, int] = {}

    def rank(self, left: int, right: int) -> int:
        """The token that two neighbours merge to, -1 if there is none."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        found = self.pairs[left * WIDE + right] = self.ranks.get(self.token[left] + self.token[right], -1)
        return found

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words one after the other, and the number of tokens of each word.

        Words of up to LONG bytes are replayed side by side, longer ones rank by rank: a word takes one merge of each
        step that it shares with others, so a long one would keep them waiting.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        short = size <= LONG
        parts = [np.flatnonzero(~short)] + [np.flatnonzero(short & (part == p)) for part in [np.cumsum(size) // BLOCK_BYTES]
                                            for p in np.unique(part)]
        ids, length, begin, done = [np.zeros(0, np.int32)], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        for n, part in enumerate(parts):
            if len(part):
                found, counts = (self.side_by_side if n else self.by_rank)([words[i] for i in part.tolist()])
                ids.append(found)
                length[part], begin[part] = counts, done + np.cumsum(counts) - counts
                done += len(found)
        return gather(np.concatenate(ids), begin, length), length

    def side_by_side(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of bounded length, a merge of every word at a time.

        The index holds rank * WIDE + slot for each pair that merges, so it leads from a pair to its slots, lowest rank
        and leftmost slot first. Its lowest part, of whole ranks, is taken out, and of that part each word's first entry
        is merged in each step; words do not touch, so their order does not matter. Only the two pairs at each merged
        slot are entered anew, in the part at hand if they are low enough, whatever rank was merged before. An entry
        whose pair has changed is passed by. The slot after the last stands for none.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        count, ends = len(raw), np.cumsum(size)
        word = np.repeat(np.arange(len(words)), size)
        tokens = np.append(self.single[raw], -1)
        first = np.append(np.diff(word, prepend=-1) != 0, True)
        before = np.where(first, count, np.arange(count + 1) - 1)
        after = np.append(np.where(first[1:], count, np.arange(count) + 1), count)
        merged = np.full(count + 1, -1, np.int64)
        inner = np.flatnonzero(~first[1:])
        merged[inner] = self.of_bytes[raw[inner], raw[inner + 1]]
        slots = np.flatnonzero(merged >= 0)
        index = merged[slots] * WIDE + slots
        none = np.iinfo(np.int64).max
        least = np.full(len(words), none)
        while len(index):
            most = min(len(index) - 1, max(len(index) // 4, BAND))
            limit = ((np.partition(index, most)[most] >> HALF) + 1) << HALF
            taken = index < limit
            part, later = index[taken], [index[~taken]]
            while len(part):
                slot = part & (WIDE - 1)
                live = merged[slot] == part >> HALF
                part, owner = part[live], word[slot[live]]
                np.minimum.at(least, owner, part)
                lowest = least[owner] == part
                least[owner] = none
                now, part = part[lowest], part[~lowest]
                rank, slot = now >> HALF, now & (WIDE - 1)
                right, leads = after[slot], before[slot]
                follows = after[right]
                tokens[slot], tokens[right], merged[right] = rank, -1, -1
                after[slot], before[follows] = follows, slot
                here, there = self.merging.merge(rank, tokens[follows]), self.merging.merge(tokens[leads], rank)
                merged[slot], merged[leads] = here, there
                entered = np.concatenate([(here * WIDE + slot)[here >= 0], (there * WIDE + leads)[there >= 0]])
                taken = entered < limit
                later.append(entered[~taken])
                part = np.concatenate([part, entered[taken]])
            index = np.concatenate(later)
        left = tokens[:count] >= 0
        per_word = np.concatenate([[0], np.cumsum(left)])
        return tokens[:count][left].astype(np.int32), per_word[ends] - per_word[ends - size]

    def by_rank(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of any length, a rank at a time.

        All words lie in one row of slots; ``waiting`` maps each pair that occurs (by the token it merges to) to the
        slots where it begins. The lowest rank is taken out, its slots are merged from left to right, and only the
        two pairs at each merged slot are entered anew. An entry that a neighbouring merge has outdated is passed by.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        count = len(raw)
        ends = np.cumsum(size)
        first = np.zeros(count + 1, bool)
        first[ends - size] = True
        first[count] = True
        slots = np.arange(count)
        before = np.where(first[:count], -1, slots - 1).tolist()
        after = np.where(first[1:], -1, slots + 1).tolist()
        tokens = self.single[raw].tolist()

        inner = np.flatnonzero(~first[1:count]) if count else slots
        found = self.of_bytes[raw[inner], raw[inner + 1]]
        inner, found = inner[found >= 0], found[found >= 0]
        order = np.argsort(found, kind="stable")
        inner, found = inner[order], found[order]
        cuts = np.flatnonzero(np.diff(found)) + 1
        waiting = {int(r): x.tolist() for r, x in zip(found[np.append(0, cuts)], np.split(inner, cuts))} if len(found) else {}
        heap = list(waiting)
        heapq.heapify(heap)

        known, wide, rank = self.pairs.get, WIDE, self.rank
        while heap:
            r = heapq.heappop(heap)
            here = waiting.pop(r)
            here.sort()
            for slot in here:
                left, right = tokens[slot], after[slot]
                if left < 0 or right < 0:
                    continue
                old = known(left * wide + tokens[right])
                if (rank(left, tokens[right]) if old is None else old) != r:
                    continue
                tokens[slot], tokens[right] = r, -1
                after[slot] = follows = after[right]
                low = r
                if follows >= 0:
                    before[follows] = slot
                    new = known(r * wide + tokens[follows])
                    if new is None:
                        new = rank(r, tokens[follows])
                    if new > r:
                        if new in waiting:
                            waiting[new].append(slot)
                        else:
                            waiting[new] = [slot]
                            heapq.heappush(heap, new)
                    elif new >= 0:
                        low = new
                leads = before[slot]
                if leads >= 0:
                    new = known(tokens[leads] * wide + r)
                    if new is None:
                        new = rank(tokens[leads], r)
                    if new > r:
                        if new in waiting:
                            waiting[new].append(leads)
                        else:
                            waiting[new] = [leads]
                            heapq.heappush(heap, new)
                    elif new >= 0:
                        low = new
                if low < r:  # a merge of lower rank became possible: this word goes on alone
                    self.finish(slot, tokens, before, after)
        tokens = np.array(tokens, np.int32)
        left = tokens >= 0
        per_word = np.concatenate([[0], np.cumsum(left)])
        return tokens[left], per_word[ends] - per_word[ends - size]

    def finish(self, slot: int, tokens: list[int], before: list[int], after: list[int]) -> None:
        """Merge one word to its end, always the lowest rank and of equals the leftmost."""
        while before[slot] >= 0:
            slot = before[slot]
        while True:
            best, at, here = -1, -1, slot
            while after[here] >= 0:
                r = self.rank(tokens[here], tokens[after[here]])
                if r >= 0 and (best < 0 or r < best):
                    best, at = r, here
                here = after[here]
            if best < 0:
                return
            right = after[at]
            tokens[at], tokens[right], after[at] = best, -1, after[right]
            if after[at] >= 0:
                before[after[at]] = at


class WordTable:
    """Words met so far and their tokens, as one flat array; when it is full, words met only once are forgotten."""

    def __init__(self, replay: MergeReplay):
        self.replay = replay
        self.place: dict[str, int] = Places()
        self.flat = np.zeros(0, np.int32)
        self.length = np.zeros(0, np.int64)
        self.begin = np.zeros(0, np.int64)
        self.met = np.zeros(0, np.int64)

    def trim(self) -> None:
        """Keep the words met again since they came, the more frequent ones if these are more than half of the table."""
        order = np.argsort(-self.met, kind="stable")[:REMEMBERED // 2]
        kept = np.sort(order[self.met[order] > 1])
        names = list(self.place)
        self.place = Places(zip([names[i] for i in kept.tolist()], range(len(kept))))
        self.flat = gather(self.flat, self.begin[kept], self.length[kept])
        self.length, self.met = self.length[kept], np.ones(len(kept), np.int64)
        self.begin = np.cumsum(self.length) - self.length

    def encode(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after the other, and the number of tokens of each text."""
        if len(self.place) > REMEMBERED:
            self.trim()
        known = len(self.place)
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64)
        fresh = list(islice(self.place, known, None))
        if fresh:
            ids, length = self.replay.encode([word.encode() for word in fresh])
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(length) - length])
            self.length = np.concatenate([self.length, length])
            self.flat = np.concatenate([self.flat, ids])
            self.met = np.concatenate([self.met, np.zeros(len(fresh), np.int64)])
        self.met += np.bincount(at, minlength=len(self.met))
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        tokens = np.concatenate([[0], np.cumsum(self.length[at])])
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return gather(self.flat, self.begin[at], self.length[at]), np.diff(tokens[edges])


class Places(dict):
    """Word -> its number; a word that is asked for the first time gets the next one."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def gather(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[begin[0]:begin[0]+length[0]], flat[begin[1]:...], ... in one array."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(begin - (ends - length), length) + np.arange(total)]


def blocks(batch: pa.Array, sizes: np.ndarray, most: int) -> Iterator[pa.Array]:
    """Slices of whole rows whose sizes add up to about ``most``."""
    part = np.cumsum(sizes) // most
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(batch)]]) if len(batch) else [0, 0]
    for begin, end in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(begin, end - begin)


def encode(docs: DataFrame, text: str = "text", output: str = "ids", ranks: str = RANKS,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """docs with an array of token ids for each text.

    Words are the matches of the pattern. A worker takes blocks of whole texts; the distinct words of a block that it
    does not remember are merged together by ``MergeReplay``, and the ids of texts are gathered from the table of
    words. Merges never cross words, so the ids do not depend on which words share a block: no shuffle is needed, and
    a task that runs again gives the same ids. The rank file is read by the driver and sent as a broadcast of its
    size; memory is bounded by a block (or one text, if longer), the table of words and an Arrow batch.

    Null and empty texts give an empty array. Repeated rows are encoded each. An empty table gives no rows. A column
    of docs that has the output's name gives way to it.
    """
    by_token = read_ranks(ranks)
    shared = docs.sparkSession.sparkContext.broadcast((by_token, Pairs(by_token)))

    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, find = WordTable(MergeReplay(*shared.value)), regex.compile(pattern).findall
        for batch in batches:
            ids, counts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
            sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for held in blocks(batch, sizes, BLOCK_BYTES):
                found, sizes = words.encode([find(t or "") for t in held.to_pylist()])
                ids.append(found)
                counts.append(sizes)
            yield pa.ListArray.from_arrays(
                pa.array(np.cumsum(np.concatenate(counts)).astype(np.int32)), pa.array(np.concatenate(ids)))

    return put(docs, {output: to_ids(F.col(quoted(text)))})


def decode(docs: DataFrame, ids: str = "ids", output: str = "decoded", ranks: str = RANKS) -> DataFrame:
    """docs with the bytes that each array of token ids stands for. Null gives null; an unknown id is an error."""
    by_rank = {rank: token for token, rank in read_ranks(ranks).items()}
    shared = docs.sparkSession.sparkContext.broadcast([by_rank.get(i) for i in range(max(by_rank) + 1)])

    @F.arrow_udf("binary")
    def to_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = shared.value
        length = np.fromiter((-1 if t is None else len(t) for t in tokens), np.int64, len(tokens))
        begin = np.cumsum(np.maximum(length, 0)) - np.maximum(length, 0)
        flat = np.frombuffer(b"".join(t or b"" for t in tokens), np.uint8)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, data = [np.zeros(1, np.int64)], []
            for held, size in zip(blocks(batch, sizes, BLOCK_BYTES), blocks(pa.array(sizes), sizes, BLOCK_BYTES)):
                at = held.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                if len(at) and (at.min() < 0 or at.max() >= len(tokens) or length[at].min() < 0):
                    raise ValueError("an id that the ranks do not have")
                data.append(gather(flat, begin[at], length[at]))
                bytes_to = np.concatenate([[0], np.cumsum(length[at])])
                ends.append(ends[-1][-1] + bytes_to[np.cumsum(size.to_numpy())])
            buffers = [pa.py_buffer(np.concatenate(ends).astype(np.int64)), pa.py_buffer(np.concatenate([flat[:0], *data]))]
            valid = pc.is_valid(batch)
            whole = pa.Array.from_buffers(pa.large_binary(), len(batch), [None, *buffers])
            yield pc.if_else(valid, whole, None).cast(pa.binary())

    return put(docs, {output: to_bytes(F.col(quoted(ids)))})


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode(encode(docs))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
