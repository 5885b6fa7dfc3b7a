"""Operator 11, repeated passages: Rabin-Karp hashes of every window of words, counted, then cut out as intervals."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import quoted, shuffle_partitions, store, table
from wakeline.session import shared_dir

WINDOW = 50
#: Text in one block of documents, in one partition of blocks, and windows in one range of hashes, all on average.
BLOCK_BYTES, PARTITION_BYTES, RANGE_WINDOWS = 4 << 20, 32 << 20, 4 << 20
#: A partition of the stored blocks is a bucket of a table; Spark takes so many.
MOST_BUCKETS = 100_000
#: Words a worker remembers.
REMEMBERED = 500_000
#: Odd multipliers of the two rolling hashes; a hash is a polynomial in one of them, modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
NULL_KEY = 2**63 - 1


class Words(dict):
    """Word -> row of ``codes``, two 64-bit numbers of its digest. Grows as words are met."""

    def __init__(self):
        super().__init__()
        self.digests = bytearray()

    def __missing__(self, word: bytes) -> int:
        self.digests += hashlib.blake2b(word, digest_size=16).digest()
        self[word] = at = len(self)
        return at

    def codes(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
            self.digests = bytearray()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(bytes(self.digests), "<u8").reshape(-1, 2)[at]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose high bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


def rolling(codes: np.ndarray, base: int, window: int) -> np.ndarray:
    """Rabin-Karp: the hash of every ``window`` consecutive codes, from differences of one running sum.

    The sum of code[i] * base^i over a window is divided by base^begin, which an odd base allows modulo 2^64, so equal
    windows have equal hashes wherever they begin.
    """
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers(base, len(codes)), dtype=np.uint64)])
    count = len(codes) - window + 1
    return mixed((sums[window:] - sums[:count]) * powers(pow(base, -1, 2**64), count))


class Block:
    """The words of a block's documents one after another, and the windows that lie within one document."""

    def __init__(self, texts: list[str | None], keys: list[int | None], words: Words, window: int):
        self.words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.window = window
        flat = [w for doc in self.words for w in doc]
        here = np.arange(max(0, len(flat) - window + 1))
        doc = np.repeat(np.arange(len(texts)), self.sizes)
        self.at = here[doc[:len(here)] == doc[window - 1:][:len(here)]] if len(here) else here
        key = np.array([NULL_KEY if k is None else k for k in keys], np.int64)
        self.key = key[doc[self.at]]
        if len(self.at):
            codes = words.codes(flat)
            self.h1, self.h2 = (rolling(np.ascontiguousarray(codes[:, i]), BASES[i], window)[self.at] for i in (0, 1))
        else:
            self.h1 = self.h2 = np.zeros(0, np.uint64)

    def ranges(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, short hashes, window -> its short hash): the distinct first bits + 32 bits of the hashes, sorted.

        Range r holds short[starts[r]:starts[r + 1]]."""
        short, back = np.unique(self.h1 >> np.uint64(32 - bits), return_inverse=True)
        starts = np.searchsorted(short, np.arange(2**bits + 1, dtype=np.uint64) << np.uint64(32))
        return starts, short, back

    def groups(self, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(h1, h2, least key, window -> group) over the windows at ``where``: equal windows are one group."""
        order = where[np.lexsort((self.h2[where], self.h1[where]))]
        h1, h2 = self.h1[order], self.h2[order]
        new = np.ones(len(order), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        first = np.flatnonzero(new)
        least = np.minimum.reduceat(self.key[order], first) if len(order) else np.zeros(0, np.int64)
        group = np.full(len(self.at), -1, np.int64)
        group[order] = np.cumsum(new) - 1
        return h1[first], h2[first], least, group

    def spans(self, gone: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each document the maximal intervals of words covered by the windows that are gone."""
        edge = np.zeros(int(self.sizes.sum()) + 1, np.int64)
        np.add.at(edge, self.at[gone], 1)
        np.add.at(edge, self.at[gone] + self.window, -1)
        covered = np.cumsum(edge) > 0
        out = []
        for begin, size in zip(self.begin, self.sizes):
            inside = np.concatenate([[False], covered[begin:begin + size], [False]])
            turns = np.flatnonzero(inside[1:] != inside[:-1]).tolist()
            out.append(list(zip(turns[::2], turns[1::2])))
        return out


def packed(values: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as the bytes of their steps, byte by byte: what few bits differ in compresses well."""
    steps = np.diff(values.astype(np.uint32), prepend=np.uint32(0))
    return pa.compress(steps.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, count: int) -> np.ndarray:
    steps = np.frombuffer(pa.decompress(data, count * 4, "zstd", asbytes=True), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u4").ravel(), dtype=np.uint32)


def in_blocks(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, int]:
    """Documents dealt to blocks, as a bucketed table; and the bits that number the ranges of hashes.

    A block is the same set of documents whenever it is read, and the blocks need no shuffle to meet what is known
    about them. A row's block comes from its place in the input, so repeated rows part.
    """
    rows = docs.select(F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(text)).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    buckets = int(min(MOST_BUCKETS, max(size // PARTITION_BYTES + 1, shuffle_partitions(docs.sparkSession))))
    # A window takes about six bytes of text: only the sizes of ranges depend on this.
    bits = max(0, (size // 6 // RANGE_WINDOWS).bit_length())
    name = f"passages_{uuid.uuid4().hex}"
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    (dealt.repartition(buckets, "block").write.bucketBy(buckets, "block").option("compression", "zstd")
     .option("path", f"{shared_dir(docs.sparkSession)}/llm/{name}").saveAsTable(name))
    return docs.sparkSession.table(name), bits


def told(replies: Iterator[pa.RecordBatch] | pa.Table, starts: np.ndarray) -> np.ndarray:
    """The flags of a block's hashes from the replies of the ranges that had something to say."""
    flags = np.zeros(int(starts[-1]), bool)
    for at, bits in zip(replies.column("range").to_pylist(), replies.column("flags").to_pylist()):
        count = int(starts[at + 1] - starts[at])
        flags[starts[at]:starts[at + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=count).astype(bool)
    return flags


def shared_windows(blocks: DataFrame, bits: int, window: int) -> DataFrame:
    """(block, range, flags): which of a block's short hashes other blocks have too. Ranges without any give no row."""
    words = Words()

    def tell(rows: pa.Table) -> pa.Table:
        block = Block(rows.column("text").to_pylist(), rows.column("key").to_pylist(), words, window)
        starts, short, _ = block.ranges(bits)
        at = np.flatnonzero(np.diff(starts))
        return pa.table({
            "block": pa.array([rows.column("block")[0].as_py()] * len(at), pa.int64()), "range": pa.array(at, pa.int64()),
            "count": pa.array(np.diff(starts)[at], pa.int64()),
            "hashes": pa.array([packed(short[starts[r]:starts[r + 1]] & np.uint64(2**32 - 1)) for r in at], pa.binary())})

    def count(rows: pa.Table) -> pa.Table:
        own = [unpacked(*x) for x in zip(rows.column("hashes").to_pylist(), rows.column("count").to_pylist())]
        whole = np.sort(np.concatenate(own))
        often = np.unique(whole[1:][whole[1:] == whole[:-1]])
        flags = [often[np.minimum(np.searchsorted(often, x), len(often) - 1)] == x if len(often) else x != x for x in own]
        return _replies(rows, flags)

    sent = blocks.groupBy("block").applyInArrow(tell, "block long, range long, count long, hashes binary")
    return store(sent.groupBy("range").applyInArrow(count, REPLIES), "passages-shared")


REPLIES = "block long, range long, flags binary"


def _replies(rows: pa.Table, flags: list[np.ndarray]) -> pa.Table:
    at = [i for i, f in enumerate(flags) if f.any()]
    return pa.table({
        "block": rows.column("block").take(pa.array(at, pa.int64())), "range": rows.column("range").take(pa.array(at, pa.int64())),
        "flags": pa.array([np.packbits(flags[i]).tobytes() for i in at], pa.binary())})


def candidates(block: Block, replies: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups (as of ``Block.groups``) of the windows that other blocks may have, with the starts of their ranges."""
    starts, _, back = block.ranges(bits)
    where = np.flatnonzero(told(replies, starts)[back]) if len(back) else np.zeros(0, np.int64)
    h1, h2, least, group = block.groups(where)
    high = h1 >> np.uint64(64 - bits) if bits else np.zeros(len(h1), np.uint64)
    return h1, h2, least, group, np.searchsorted(high, np.arange(2**bits + 1, dtype=np.uint64))


def earlier_windows(blocks: DataFrame, shared: DataFrame, bits: int, window: int) -> DataFrame:
    """(block, range, flags): which of a block's candidate windows start in another block at a smaller key."""
    words = Words()

    def tell(rows: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(rows.column("text").to_pylist(), rows.column("key").to_pylist(), words, window)
        h1, h2, least, _, starts = candidates(block, replies, bits)
        at = np.flatnonzero(np.diff(starts))

        def cut(values: np.ndarray) -> pa.Array:
            return pa.array([values[starts[r]:starts[r + 1]].tobytes() for r in at], pa.binary())

        return pa.table({
            "block": pa.array([rows.column("block")[0].as_py() if rows.num_rows else 0] * len(at), pa.int64()),
            "range": pa.array(at, pa.int64()), "h1": cut(h1), "h2": cut(h2), "least": cut(least)})

    def compare(rows: pa.Table) -> pa.Table:
        def column(name: str, kind: str) -> list[np.ndarray]:
            return [np.frombuffer(x, kind) for x in rows.column(name).to_pylist()]

        own = column("least", "<i8")
        h1, h2, least = (np.concatenate(x) for x in (column("h1", "<u8"), column("h2", "<u8"), own))
        order = np.lexsort((h2, h1))
        new = np.ones(len(order), bool)
        new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        low = np.minimum.reduceat(least[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        smaller = np.zeros(len(order), bool)
        smaller[order] = low < least[order]
        return _replies(rows, np.split(smaller, np.cumsum([len(x) for x in own])[:-1]))

    # Blocks without replies have nothing to tell: the cogroup passes them with an empty table.
    sent = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        tell, "block long, range long, h1 binary, h2 binary, least binary")
    return store(sent.groupBy("range").applyInArrow(compare, REPLIES), "passages-earlier")


def substring_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """(key, n_words, spans, kept_text): each document without the passages that a document with a smaller key has.

    Words are runs of characters other than ``[\\x20\\x09-\\x0D]``. A word goes if it lies in a window of ``window``
    consecutive words of its document that also starts in a document with a smaller key; windows are judged on the
    input. spans are the maximal intervals of words that go (start, stop; stop exclusive); kept_text joins the other words
    by one space.

    Every window of a block of documents gets a rolling hash. Blocks send the first bits of their distinct hashes,
    sorted and as steps, to ranges of hashes, where those that two blocks have are found; for these alone the whole 128
    bits and the smallest key go there, and the answer says which of them another block has at a smaller key. A window
    that a third of all documents hold is one entry for each block. Answers are bits in the order of the block's hashes.
    Windows count as equal if 128 bits of two polynomials over 128-bit digests of the words agree.

    Null and empty texts have no words. Keys are integers; a null key is larger than any other, and equal keys (repeated
    rows too) take nothing from each other. A very long text is a block of its own size, in memory as a whole. Other
    columns are not read. An empty table gives no rows.
    """
    blocks, bits = in_blocks(docs, text, key)
    shared = shared_windows(blocks, bits, window)
    earlier = earlier_windows(blocks, shared, bits, window)
    replies = shared.withColumn("step", F.lit(1)).unionByName(earlier.withColumn("step", F.lit(2)))
    words = Words()

    def cut(rows: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(rows.column("text").to_pylist(), rows.column("key").to_pylist(), words, window)
        steps = replies.column("step").to_numpy()
        of_step = [replies.filter(pa.array(steps == s)) for s in (1, 2)]
        _, _, _, group, starts = candidates(block, of_step[0], bits)
        gone = np.append(told(of_step[1], starts), False)[group]
        _, _, least, own = block.groups(np.arange(len(block.at)))
        gone |= least[own] < block.key
        spans = block.spans(gone)
        kept = [b" ".join([w for begin, end in zip([0, *[s[1] for s in cut]], [*[s[0] for s in cut], len(doc)])
                           for w in doc[begin:end]]) for doc, cut in zip(block.words, spans)]
        return pa.table({
            "key": rows.column("key"), "n_words": pa.array(block.sizes, pa.int64()),
            "spans": pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], SPANS),
            "kept_text": pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string())})

    out = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        cut, "key long, n_words long, spans array<struct<start:long,stop:long>>, kept_text string")
    return out.withColumnRenamed("key", key)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 49], ' ') AS passage FROM p),
g AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY passage) < doc_id AS gone FROM h),
r AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM g WHERE gone),
k AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
o AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM k ANTI JOIN r USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN o USING (doc_id)
"""
