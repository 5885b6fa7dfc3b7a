"""Operator 13, ranked lexical search turned round: the items are indexed, and the documents stream through them."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import quoted, store, table

#: Documents an item keeps, and postings (item terms) of one block of items: what is sent to every task.
TOP, BLOCK_POSTINGS = 10, 500_000
#: Lists of tasks are merged in this many parts for each item first, then the parts.
PARTS = 64
#: Bytes of UTF-8: letters and digits of ASCII stay, A-Z as a-z, all others of ASCII become a blank.
TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TO_TERMS).split()


@dataclass
class Items:
    """Inverted index of one block of items: for term t the items posted[begin[t]:begin[t + 1]]."""

    keys: list
    terms: dict[bytes, int]
    begin: np.ndarray
    posted: np.ndarray

    @classmethod
    def build(cls, rows: list[tuple]) -> Items:
        """rows are (key, text); a term counts once for an item."""
        lists: dict[bytes, list[int]] = {}
        for i, (_, text) in enumerate(rows):
            for term in set(terms_of(text)):
                lists.setdefault(term, []).append(i)
        begin = np.concatenate([[0], np.cumsum([len(x) for x in lists.values()])]).astype(np.int64)
        posted = np.array([i for x in lists.values() for i in x], np.int64)
        return cls([k for k, _ in rows], {t: i for i, t in enumerate(lists)}, begin, posted)

    def scores(self, found: dict[int, int], weight: list[int], m: int, out: np.ndarray) -> np.ndarray:
        """Add the shares of the found terms (term -> occurrences) to out, zeros for every item."""
        at = [self.posted[self.begin[t]:self.begin[t + 1]] for t in found]
        share = [weight[t] * (1_000_000_000 * tf // (1000 * tf + 8 * m)) for t, tf in found.items()]
        np.add.at(out, np.concatenate(at), np.repeat(np.array(share, np.int64), [len(x) for x in at]))
        return out


class Heaps:
    """The best TOP documents of each item so far; ``least`` is the score that a further document must reach."""

    def __init__(self, items: int, top: int):
        self.top, self.rows, self.least = top, [[] for _ in range(items)], np.ones(items, np.int64)

    def offer(self, scores: np.ndarray, order: tuple, key) -> None:
        """order sorts documents of equal score: the smaller comes first."""
        for i in np.flatnonzero(scores >= self.least):
            heap, entry = self.rows[i], (int(scores[i]), Backwards(order), key)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry[:2] > heap[0][:2]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[i] = heap[0][0]


class Backwards(tuple):
    """A tuple that sorts the other way round."""

    def __new__(cls, of: tuple):
        return super().__new__(cls, (of,))

    def __lt__(self, other):
        return self[0] > other[0]

    def __gt__(self, other):
        return self[0] < other[0]


def item_blocks(items: DataFrame, key: str, text: str, postings: int) -> DataFrame:
    """(key, text, block): items in blocks of about so many terms, an item of more being a block of its own.

    Items are numbered by their running sum of text lengths within tasks; a term has at least one character, so a
    block's postings are bounded by its characters, and its texts by four bytes for each.
    """
    rows = items.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")).withColumn(
        "part", F.spark_partition_id())
    before = F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).over(
        Window.partitionBy("part").orderBy("key", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return store(rows.withColumn("block", F.struct("part", F.floor(before / F.lit(postings)).alias("n"))), "items")


def statistics(texts: DataFrame, index) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and for each item term the documents that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = index.value.terms
        docs, total, held = 0, 0, np.zeros(len(terms), np.int64)
        for batch in batches:
            for text in batch.column(0):
                words = terms_of(text.as_py())
                docs += bool(words)
                total += len(words)
                held[[terms[w] for w in terms.keys() & set(words)]] += 1
        here = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(here, [-1, -2])), pa.array(np.append(held[here], [docs, total]))], names=["term", "n"])

    # Tasks send sums for the terms of one block of items, and the result has one row for each: bounded by the block.
    got = dict(texts.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    return got.get(-1, 0), got.get(-2, 0), np.array([got.get(i, 0) for i in range(len(index.value.terms))], np.int64)


def best_of_tasks(texts: DataFrame, index, kind: str, docs: int, total: int, held: np.ndarray, top: int) -> DataFrame:
    """(item, part, key, score): for each task and item of the block the best documents of the task."""
    weight = [math.floor(1000 * math.log((2 * docs + 2) / (2 * int(df) + 1))) for df in held]
    key_type = texts.schema["key"].dataType

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        items = index.value
        terms, known = items.terms, items.terms.keys()
        heaps, part = Heaps(len(items.keys), top), TaskContext.get().partitionId()
        out = np.zeros(len(items.keys), np.int64)
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                words = terms_of(text.as_py())
                counts = Counter(words)
                found = {terms[w]: counts[w] for w in known & counts.keys()}
                if not found:
                    continue
                out[:] = 0
                key = key.as_py()
                m = 10 + 90 * len(words) * docs // total
                heaps.offer(items.scores(found, weight, m, out), (key is None, 0 if key is None else key), key)
        rows = [(i, key, score) for i, heap in enumerate(heaps.rows) for score, _, key in heap]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), pa.array([part] * len(rows), pa.int32()),
            pa.array([r[1] for r in rows], to_arrow_type(key_type)), pa.array([r[2] for r in rows], pa.int64()),
        ], names=["item", "part", "key", "score"])

    return texts.select("key", "text").mapInArrow(stream, f"item int, part int, key {kind}, score long")


def search(items: DataFrame, docs: DataFrame, item_key: str = "item_id", item_text: str = "text", key: str = "doc_id",
           text: str = "text", top: int = TOP, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """(item_key, rank, key, score): the ``top`` documents of each item with a score above 0, best first.

    The items, not the documents, are indexed: blocks of items of bounded size are sent to every task, and each
    document's term counts go through the index once. A task keeps a heap of ``top`` documents for each item; heaps are
    merged in parts, then as a whole, so no document and no posting is shuffled. Documents are read twice for a block:
    for the statistics (documents, terms, documents holding an item's term), then for the scores.

    Null and empty texts have no terms: such documents are never found, such items find nothing. Very long texts are
    read whole, one at a time. Documents of equal score rank by ascending key, a null key last; rows repeated in docs
    are documents of their own, rows repeated in items are items of their own with a list each. Other columns are not
    read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    kind, item_kind = dict(texts.dtypes)["key"], items.select(F.col(quoted(item_key))).dtypes[0][1]
    blocks = item_blocks(items, item_key, item_text, block_postings)
    found = []
    # One row for each block_postings characters of items: the list of blocks grows with the query set alone.
    for (block,) in blocks.select("block").distinct().sort("block").collect():
        rows = [tuple(r) for r in blocks.where((F.col("block.part") == block.part) & (F.col("block.n") == block.n))
                .select("key", "text").sort("key", "text").collect()]
        index = spark.sparkContext.broadcast(Items.build(rows))
        stats = statistics(texts, index)
        best = store(best_of_tasks(texts, index, kind, *stats, top), "best")
        order = [F.desc("score"), F.col("key").asc_nulls_last()]
        parts = best.withColumn("rank", F.row_number().over(
            Window.partitionBy("item", F.col("part") % PARTS).orderBy(*order))).where(F.col("rank") <= top)
        ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(
            F.col("rank") <= top)
        names = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(rows)], f"item int, item_key {item_kind}")
        found.append(ranked.join(F.broadcast(names), "item").select(
            F.col("item_key").alias(item_key), "rank", F.col("key").alias(key), "score"))
    if not found:
        return spark.createDataFrame([], f"{quoted(item_key)} {item_kind}, rank int, {quoted(key)} {kind}, score long")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents").select("doc_id", "text"))


OP13_SQL = r"""
WITH i AS (
    SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
t AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
c AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY term),
r AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
    FROM i JOIN c USING (term) JOIN w USING (term) JOIN n USING (doc_id), s GROUP BY item_id, doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""
