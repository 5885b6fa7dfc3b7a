"""Operator 4, exact duplicates: sort the normalised texts, compare neighbours, keep the smallest identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import free_names, put, quoted, shuffle_partitions, table

#: Splitters and sort order start with this many characters, then a hash: what the driver samples stays small.
HEAD = 48


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with keep_id, group_size, kept and text_sha256, one row for each row of docs.

    The rows are range-partitioned by sampled splitters over the head of the normalised text and its hash, sorted
    within partitions by the whole text, and told apart by full comparison of neighbours. The row with the smallest
    key of each run stays. A text with more copies than a quarter of an average partition is dealt over several
    ranges by a salt of the key; its partial runs are stitched by an aggregate that is combined before its shuffle.

    Null and empty texts are one and the same text. A null key is larger than any other. Of rows with equal key and
    text one stays, whichever; their keys are equal, so keep_id does not tell. An empty table gives no rows. Columns
    of docs are kept; one that has the name of an output gives way to it.
    """
    norm, hashed, head, parts, salt, rank, low, size, sha, all_low, all_size = free_names(
        docs, "norm", "hashed", "head", "parts", "salt", "rank", "low", "size", "sha", "all_low", "all_size")
    few = max(1.0, docs.count() / (4.0 * shuffle_partitions(docs.sparkSession)))
    rows = docs.withColumn(norm, normalised(F.col(quoted(text)))).withColumn(hashed, F.xxhash64(norm))

    # At most 4 x shuffle partitions texts can have more than `few` copies: this is what makes the broadcasts safe.
    hot = (rows.groupBy(hashed).agg(F.count(F.lit(1)).alias(size)).where(F.col(size) > few)
           .select(hashed, F.ceil(F.col(size) / few).alias(parts)))
    stitched = (rows.join(F.broadcast(hot), hashed, "left_semi").groupBy(hashed, norm)
                .agg(F.min(quoted(key)).alias(all_low), F.count(F.lit(1)).alias(all_size))
                .select(F.sha2(norm, 256).alias(sha), all_low, all_size))

    dealt = rows.join(F.broadcast(hot), hashed, "left").select(
        *[quoted(c) for c in docs.columns], norm, hashed, F.substring(norm, 1, HEAD).alias(head),
        F.when(F.col(parts).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(quoted(key)), F.col(parts))).alias(salt))
    runs = Window.partitionBy(head, hashed, norm, salt)
    ordered = runs.orderBy(F.col(quoted(key)).asc_nulls_last())
    local = dealt.repartitionByRange(head, hashed, salt).select(
        *[quoted(c) for c in docs.columns], F.sha2(norm, 256).alias(sha),
        F.row_number().over(ordered).alias(rank), F.first(quoted(key)).over(ordered).alias(low),
        F.count(F.lit(1)).over(runs).alias(size))
    whole = local.join(F.broadcast(stitched), sha, "left")
    keep = F.when(F.col(all_size).isNull(), F.col(low)).otherwise(F.col(all_low))
    out = put(whole, {
        "keep_id": keep, "group_size": F.coalesce(all_size, size),
        "kept": (F.col(rank) == 1) & F.col(quoted(key)).eqNullSafe(keep), "text_sha256": F.col(sha),
    })
    return out.drop(rank, low, size, all_low, all_size, *([] if sha == "text_sha256" else [sha]))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d
"""
