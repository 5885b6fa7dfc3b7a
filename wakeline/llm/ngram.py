"""Operator 5, n-gram Jaccard join: candidates from MinHash bands, pruned by their posterior, verified exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import by_run, connected, quoted, settle, spread, store, table

WORDS, THRESHOLD = 5, 0.8
#: 32 bands of 5 values: a pair at the threshold shares no band with a chance of 3 in a million.
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Values compared at a time, and the posterior chance of reaching the threshold below which a pair is dropped.
STEP, TOLERANCE = 16, 1e-6
#: Members of a bucket or candidate group that are compared in one piece, and the bytes of text they may have.
MEMBERS, MEMBER_BYTES, VERIFIED = 4096, 8_000_000, 1024

_draw = np.random.default_rng(5)
MULTIPLY = (_draw.integers(0, 1 << 32, HASHES, dtype=np.uint64) | 1).astype(np.uint32)
ADD = _draw.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's runs of words, in lower case; a shorter text is one run."""
    digest = xxhash.xxh3_64_intdigest
    each = np.array([digest(w) for w in (text or "").lower().split()], np.uint64)
    if not len(each):
        return each
    width = min(words, len(each))
    out = np.full(len(each) - width + 1, width, np.uint64)
    for j in range(width):
        out = (out ^ each[j:len(each) - width + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """16 bits of each MinHash value; blocks of shingles keep the memory even for very long texts."""
    small = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(small), 2048):
        part = small[begin:begin + 2048]
        np.minimum(low, (MULTIPLY[:, None] * part[None, :] + ADD[:, None]).min(axis=1), out=low)
    return ((low * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """At n compared values (STEP, 2 STEP, ...): the matches below which a pair is dropped.

    With an even prior the similarity after m matches of n is Beta(m + 1, n - m + 1); its chance of reaching the
    threshold is a binomial sum.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return np.array(out)


def survivors(signatures: np.ndarray, row: int, others: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Those of the others that the row may be similar to, dropped step by step as their posterior falls."""
    matches = np.zeros(len(others), np.int64)
    for step, least_here in enumerate(least):
        part = slice(step * STEP, (step + 1) * STEP)
        matches = matches + (signatures[others, part] == signatures[row, part]).sum(axis=1)
        alive = matches >= least_here
        if not alive.all():
            others, matches = others[alive], matches[alive]
        if not len(others):
            break
    return others


def features(docs: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """(id, row_key, node, n, signature) for each row; node is a digest of the set of shingles, null if it is empty."""
    kind = "struct<node:binary,n:int,signature:binary>"

    @F.arrow_udf(kind)
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for begin in range(0, len(batch), 256):
                for t in batch.slice(begin, 256).to_pylist():
                    found = shingles(t, words)
                    out.append({"node": xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None,
                                "n": len(found), "signature": signature(found).tobytes()})
            yield pa.array(out, pa.struct([("node", pa.binary()), ("n", pa.int32()), ("signature", pa.binary())]))

    told = docs.select(F.col(quoted(key)).alias("id"), row_key(docs, text, key).alias("row_key"),
                       describe(F.col(quoted(text))).alias("d"))
    return told.select("id", "row_key", "d.node", "d.n", "d.signature")


def row_key(docs: DataFrame, text: str, key: str):
    """128 bits of a row's key and whole text, null told from empty: what rows are joined and taken out by."""
    def part(name: str):
        return F.coalesce(F.concat(F.lit("+"), F.col(quoted(name)).cast("string")), F.lit("-"))

    return F.unhex(F.md5(F.concat(part(key), F.lit("\n"), part(text))))


def dealt(rows: DataFrame, blocks: str, node: str, keys: list[str]) -> DataFrame:
    """Each row once for every pair of blocks that its own block is in: keys, lo and hi name what is compared."""
    own = F.pmod(F.xxhash64(node), F.col(blocks)).cast("int")
    return rows.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")))).select(
        *keys, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        *[c for c in rows.columns if c not in (*keys, blocks)], "own")


def candidate_edges(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(a, b): a spanning forest of the pairs that share a band and whose posterior survives all values.

    Buckets are counted first and those of one node dropped, so only nodes that meet others carry their signature
    on. A large bucket is compared as pairs of blocks. Within a block, pairs that are already tied are passed by:
    the forest has at most one row for each member, whatever the bucket's pairs.
    """
    least = least_matches(threshold, tolerance)
    bands = nodes.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring("signature", b * 2 * ROWS + 1, F.lit(2 * ROWS))))).alias("bucket"))
    sizes = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = bands.join(sizes, "bucket").withColumn("blocks", F.ceil(F.col("members") / MEMBERS)).drop("members")
    rows = dealt(met, "blocks", "node", ["bucket"]).join(nodes.select("node", "signature"), "node")

    def tie(run: pd.DataFrame) -> pd.DataFrame:
        found = np.frombuffer(b"".join(run["signature"]), np.uint16).reshape(len(run), HASHES)
        labels = np.arange(len(run))
        own, lo, hi = run["own"].to_numpy(), run["lo"].iloc[0], run["hi"].iloc[0]
        left = np.flatnonzero(own == lo)
        right = left if lo == hi else np.flatnonzero(own == hi)
        for i in left:
            others = right[(labels[right] != labels[i]) & ((right > i) | (lo != hi))]
            if len(others) and len(near := survivors(found, i, others, least)):
                spread(labels, i, near)
        tied = np.flatnonzero(labels != np.arange(len(run)))
        node = run["node"].to_numpy()
        return pd.DataFrame({"a": node[labels[tied]], "b": node[tied]})

    return by_run(rows, ["bucket", "lo", "hi"], tie, "a binary, b binary").distinct()


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared elements of the sets of each pair (left[k], right[k])."""
    if len(left) <= 8 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right)])
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    values = values[counts > 1]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    places = [np.searchsorted(values, s) for s in sets]
    hits = [p[(p < len(values))][values[p[p < len(values)]] == s[p < len(values)]] for p, s in zip(places, sets)]
    for begin in range(0, len(values), 4096):
        part = np.zeros((len(sets), min(4096, len(values) - begin)), np.float32)
        for i, h in enumerate(hits):
            part[i, h[(h >= begin) & (h < begin + 4096)] - begin] = 1
        shared += part @ part.T  # counts below 2**24 are exact
    return shared[left, right].astype(np.int64)


def verified_links(members: DataFrame, threshold: float, tolerance: float, words: int) -> DataFrame:
    """(node, tied, links): partial sums of the copies linked to a node, and a forest of the links.

    members has component, node, copies, signature, text and blocks. All pairs of a candidate component are compared
    once, in the pair of blocks that holds them: first by the posterior, then by the whole sets of shingles.
    """
    least = least_matches(threshold, tolerance)
    rows = dealt(members, "blocks", "node", ["component"])

    def verify(run: pd.DataFrame) -> pd.DataFrame:
        run = run.drop_duplicates("node", ignore_index=True)
        found = np.frombuffer(b"".join(run["signature"]), np.uint16).reshape(len(run), HASHES)
        sets = [shingles(t, words) for t in run["text"]]
        size = np.array([len(s) for s in sets])
        labels, links = np.arange(len(run)), np.zeros(len(run), np.int64)
        own, lo, hi = run["own"].to_numpy(), run["lo"].iloc[0], run["hi"].iloc[0]
        copies = run["copies"].to_numpy()
        left = np.flatnonzero(own == lo)
        right = left if lo == hi else np.flatnonzero(own == hi)
        pairs = []
        for i in left:
            others = right[(right > i) | (lo != hi)]
            near = survivors(found, i, others[np.minimum(size[others], size[i]) >= threshold * np.maximum(
                size[others], size[i]) - 1e-9], least)
            pairs.append(np.stack([np.full(len(near), i), near]))
        a, b = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        if len(a):
            both = intersections(sets, a, b)
            real = both >= threshold * (size[a] + size[b] - both) - 1e-9
            a, b = a[real], b[real]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            for i in np.unique(a):
                spread(labels, i, b[a == i])
        node = run["node"].to_numpy()
        told = np.flatnonzero(links > 0)
        return pd.DataFrame({"node": node[told], "tied": node[labels[told]], "links": links[told]})

    return by_run(rows, ["component", "lo", "hi"], verify, "node binary, tied binary, links long")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS,
                    threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(key, row_key, class_id, n_links, kept) for each row of docs; row_key is ``row_key`` of its id and text.

    Two documents are linked if the Jaccard similarity of their sets of word runs is at least the threshold. Rows with
    one set are one node with a number of copies, so copies meet no one. Nodes that share a MinHash band are compared
    value by value and dropped when the posterior chance of reaching the threshold falls below the tolerance; what
    survives falls into components, inside which every pair is pruned alike and the rest verified on whole texts.
    class_id is the smallest key that links reach, n_links the documents linked directly, kept the row with that key.

    A pair at the threshold is missed by all bands with a chance of 3e-6; links in the result are exact. Null and
    empty texts have no word runs and link with nothing. A null key is larger than any other; if all keys of a class
    are null, so is class_id. Rows with equal key and text are one document: they stay or go together. Other columns
    are not read. An empty table gives no rows.
    """
    told = store(features(docs, text, key, words), "shingles")
    low = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row_key")).alias("low")
    nodes = store(told.where(F.col("node").isNotNull()).groupBy("node").agg(
        low, F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature")), "nodes")
    groups = connected(candidate_edges(nodes, threshold, tolerance), "candidates")

    inside = groups.withColumnRenamed("node", "at").join(nodes, F.col("at") == F.col("node")).select(
        "component", "node", "copies", "signature", F.col("low.row_key").alias("row_key"))
    texts = docs.select(row_key(docs, text, key).alias("row_key"), F.col(quoted(text)).alias("text"))
    members = store(texts.join(inside, "row_key").drop("row_key"), "members")
    sizes = members.groupBy("component").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / VERIFIED), F.ceil(F.sum(F.octet_length("text")) / MEMBER_BYTES)).alias("blocks"))
    links = store(verified_links(members.join(sizes, "component"), threshold, tolerance, words), "links")

    out = settle(told.select("id", "row_key", "node"), nodes, links, "classes")
    alone = F.col("class_low").isNull()
    return out.select(
        F.col("id").alias(key), "row_key", F.when(alone, F.col("id")).otherwise(F.col("class_low.id")).alias("class_id"),
        "n_links",
        (alone | (F.col("row_key") == F.col("class_low.row_key"))).alias("kept"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "n_links", "kept")
