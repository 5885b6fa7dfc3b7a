"""What the operators share: reading tables, tables written between steps, names that cannot clash, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.session import shared_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
BATCH_ROWS, TEXT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a step's rows to the shared folder and read them back: a lost executor then costs no earlier step.

    Every call takes a folder of its own, so repeated and concurrent runs do not meet.
    """
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names for internal use that df does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def put(df: DataFrame, outputs: dict[str, Column]) -> DataFrame:
    """df with the outputs at its end; a column of df that has an output's name gives way to it."""
    lowered = {k.lower() for k in outputs}
    kept = [F.col(quoted(c)) for c in df.columns if c.lower() not in lowered]
    return df.select(*kept, *[v.alias(k) for k, v in outputs.items()])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_batches(spark: SparkSession) -> None:
    """Send whole texts to Python by TEXT_ROWS rows at most, from here on in this session.

    Spark's own 10,000 rows of a few kilobytes each are some 40 MB, held by the executor, while its buffers double, and
    by the Python worker, for every task at once. A smaller number set by the user stays.
    """
    rows = int(spark.conf.get(BATCH_ROWS))
    if not 0 < rows <= TEXT_ROWS:
        spark.conf.set(BATCH_ROWS, str(TEXT_ROWS))


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge; edges has columns a and b.

    Alternating large-star and small-star rounds, each a grouped minimum plus a join, so no node's neighbours are
    gathered in one place; every round is written to the shared folder. The rounds grow with the logarithm of the
    longest chain, not with the rows.
    """
    a, b = F.col("a"), F.col("b")
    live = store(edges.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), name)

    def star(links: DataFrame, small: bool) -> DataFrame:
        """Tie each node's larger (or its smaller) neighbours to the smallest node around it."""
        both = links.select(b.alias("n"), a.alias("m"))
        if not small:
            both = both.unionAll(links.select(a.alias("n"), b.alias("m")))
        low = both.groupBy("n").agg(F.least(F.min("m"), F.first("n")).alias("low"))
        tied = both.join(low, "n")
        if small:
            rows = tied.select(F.col("low").alias("a"), F.col("m").alias("b")).unionAll(
                low.select(F.col("low").alias("a"), F.col("n").alias("b")))
        else:
            rows = tied.where(F.col("m") > F.col("n")).select(F.col("low").alias("a"), F.col("m").alias("b"))
        return rows.where(a != b).distinct()

    def mark(links: DataFrame):
        h = F.xxhash64("a", "b").cast("decimal(20,0)")
        return tuple(links.agg(F.count(F.lit(1)), F.sum(h)).first())

    seen = mark(live)
    while seen[0]:
        live = store(star(store(star(live, small=False), name), small=True), name)
        now = mark(live)
        if now == seen:
            break
        seen = now
    return live.select(b.alias("node"), a.alias("component")).unionAll(
        live.select(a.alias("node"), a.alias("component")).distinct())


def by_run(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """fn over each set of rows with equal keys, many sets a task: for sets that are small, many and of bounded size."""

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            new = np.zeros(len(batch), bool)
            for k in keys:
                new |= (batch[k] != batch[k].shift()).to_numpy()
            new[0] = last is None or tuple(batch[k].iloc[0] for k in keys) != last
            cuts = np.flatnonzero(new)
            done = []
            for begin, end in zip(np.append(0, cuts) if not new[0] else cuts, np.append(cuts if not new[0] else cuts[1:], len(batch))):
                if new[begin] and held:
                    done.append(fn(pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]))
                    held = []
                held.append(batch.iloc[begin:end].reset_index(drop=True))
            last = tuple(batch[k].iloc[-1] for k in keys)
            if done:
                yield pd.concat(done, ignore_index=True)
        if held:
            yield fn(pd.concat(held, ignore_index=True) if len(held) > 1 else held[0])

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(stream, schema)


def spread(labels: np.ndarray, row: int, near: np.ndarray) -> None:
    """Give row and all that are near it one label, the lowest that they or those joined to them have."""
    joined = np.unique(np.append(labels[near], labels[row]))
    if len(joined) > 1:
        labels[np.isin(labels, joined)] = joined[0]


def settle(told: DataFrame, nodes: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """told with n_links and class_low: what links between nodes mean for every row.

    told has id and node (null: the row links with nothing); nodes has node, copies and low, the smallest of its rows
    as a struct; links has node, links (documents linked, in parts) and tied (a forest of the links).
    """
    classes = connected(links.select(F.col("tied").alias("a"), F.col("node").alias("b")), name)
    by_node = nodes.select("node", "low", "copies").join(
        links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(classes, "node", "left").select(
        "node", "low", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("class"))
    lowest = by_node.groupBy("class").agg(F.min("low").alias("class_low"))
    final = by_node.join(lowest, "class").select("node", "n_links", "class_low")
    return told.join(final, "node", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))
