"""Operator 6, quality: a document's evidence, with the record of its host and path shrunk towards what is above them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import quoted, store, table
from wakeline.llm.toxicity import held_out

#: Imagined documents behind each bin of a feature, and the farthest that one bin may move the log odds.
BIN_PRIOR, MOST = 4.0, 3.0
#: Bounds of the estimated strength of a level: a record of so many documents counts as much as the level above.
WEAKEST, STRONGEST = 1.0, 10_000.0


def features(text: Column) -> dict[str, Column]:
    """Shares between 0 and 1 that tell prose from junk, whatever the language."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    chars = F.greatest(F.char_length(text), F.lit(1))
    count = F.greatest(F.size(words), F.lit(1))
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / chars
    return {
        "distinct_words": F.size(F.array_distinct(words)) / count,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "capitals": share(r"\p{Lu}"),
        "marks": share(r"[^\p{L}\p{N}\s.,]") * 4,
        "digits": share(r"\p{N}") * 4,
        "stops": F.regexp_count(text, F.lit(r"[.!?](\s|$)")) / count * 3,
        "word_length": chars / count / 20,
        "length": F.log10(count) / 5,
    }


def log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def chance(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def shrunk(rows: DataFrame, keys: list[str], above: Column, name: str) -> DataFrame:
    """rows with the posterior of their group, their own part in it left out, drawn to ``above`` where it is sparse.

    The strength of the draw comes from the groups themselves, by moments: the more the groups' means differ beyond
    what chance makes them differ, the less they are drawn in. Groups are summed before any shuffle of their rows, and
    the sums come back by a join that splits a group with many rows.
    """
    groups = rows.groupBy(*keys).agg(F.sum("belief").alias(f"{name}_sum"), F.count(F.lit(1)).cast("double").alias(f"{name}_n"))
    n, s = F.col(f"{name}_n"), F.col(f"{name}_sum")
    total = groups.agg(F.sum(n).alias("n"), F.sum(s).alias("s"), F.count(F.lit(1)).alias("g"), F.sum(n * n).alias("nn"),
                       F.sum(s * s / n).alias("ss")).first()
    strength = STRONGEST
    if total["n"] and total["g"] > 1:
        p = min(max(total["s"] / total["n"], 1e-6), 1 - 1e-6)
        # Between-group sum of squares: chance alone gives (groups - 1) p (1 - p).
        extra = total["ss"] - total["n"] * p * p - (total["g"] - 1) * p * (1 - p)
        spread = max(extra / (total["n"] - total["nn"] / total["n"]), 0.0) if total["nn"] < total["n"] ** 2 else 0.0
        strength = min(max(p * (1 - p) / spread - 1, WEAKEST), STRONGEST) if spread > 0 else STRONGEST
    joined = rows.alias("r").join(groups.alias("g"), reduce(
        lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]))
    own = F.col("belief")
    return joined.select("r.*", ((s - own + strength * above) / (n - 1 + strength)).alias(f"{name}_posterior"),
                         n.cast("long").alias(f"{name}_docs"))


def quality(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source",
            path: str = "lang", label: str = "quality") -> DataFrame:
    """(key, score, evidence, host_posterior, path_posterior, host_docs, path_docs, kept) for each row of docs.

    Evidence is a log likelihood ratio from the counts of labelled documents in the bins of each feature, every bin
    drawn to the middle as if BIN_PRIOR more documents had been seen. A document's belief is its label where it may be
    learnt from, else the chance that evidence and the global share of good documents give. Beliefs summed over hosts,
    and over paths within hosts, give posteriors: host shrunk to the global share, path to its host. The score is the
    path's posterior, without the document itself, moved by its evidence; kept from 0.5 on.

    One labelled row in five (crc32 of the key) is held out. Null and empty texts have evidence like other short
    texts; null hosts and paths are groups of their own. A key with several labels counts as good if one is. Without
    labels the evidence is 0 and every score a half. Repeated rows are rows each. An empty table gives no rows. Other
    columns are not read.
    """
    k = F.col(quoted(key))
    known = labels.where(F.col(label).isNotNull() & k.isNotNull() & ~held_out(k)).groupBy(k.alias("at")).agg(
        F.max(label).cast("double").alias("good"))
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    made = features(body)
    bins = docs.select(k.alias("id"), F.col(quoted(host)).alias("host"), F.col(quoted(path)).alias("path"), *[
        F.floor(F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)) * 20).cast("int").alias(f) for f, v in made.items()])
    seen = store(bins.join(known, F.col("id") == F.col("at"), "left").drop("at"), "quality-bins")

    learnt = seen.where(F.col("good").isNotNull())
    good, n = learnt.agg(F.coalesce(F.sum("good"), F.lit(0.0)), F.count(F.lit(1))).first()
    share = (good + 0.5) / (n + 1)
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in made]))
    counts = learnt.select("good", pairs.alias("p")).groupBy("p.feature", "p.bin").agg(
        F.sum("good").alias("g"), F.count(F.lit(1)).alias("n")).collect()  # 21 bins for each of the features
    table_of = {f: {} for f in made}
    for row in counts:
        p = (row.g + BIN_PRIOR * share) / (row.n + BIN_PRIOR)
        table_of[row.feature][row.bin] = p
    evidence = F.lit(0.0)
    for f, found in table_of.items():
        if found:
            tables = F.create_map(*[F.lit(x) for kv in found.items() for x in kv])
            move = log_odds(F.coalesce(F.try_element_at(tables, F.col(f)), F.lit(share))) - log_odds(F.lit(share))
            evidence = evidence + F.greatest(F.least(move, F.lit(MOST)), F.lit(-MOST))
    believed = store(seen.withColumn("evidence", evidence).select(
        "id", "host", "path", "evidence", F.coalesce(
            (F.col("good") * (n + 1) + share) / (n + 2), chance(F.col("evidence") + log_odds(F.lit(share)))).alias("belief")), "quality-beliefs")

    by_host = store(shrunk(believed, ["host"], F.lit(share), "host"), "quality-hosts")
    by_path = shrunk(by_host, ["host", "path"], F.col("host_posterior"), "path")
    bounded = F.least(F.greatest(F.col("path_posterior"), F.lit(1e-6)), F.lit(1 - 1e-6))
    score = chance(F.col("evidence") + log_odds(bounded))
    return by_path.select(F.col("id").alias(key), score.alias("score"), "evidence", "host_posterior", "path_posterior",
                          "host_docs", "path_docs", (score >= 0.5).alias("kept"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality(docs, table(spark, sf_dir, "labels"))
