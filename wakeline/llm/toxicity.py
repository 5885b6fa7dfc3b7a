"""Operator 2, toxicity: votes of the nearest labelled examples by exact TF-IDF cosine, over a block-max index."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import bounded_batches, put, quoted, table

#: What is learnt from is bounded: labelled rows, in the order of a hash of their id, and terms, by association.
MAX_EXAMPLES, MAX_TERMS = 8192, 2048
#: Least chi-square of a term with the label, least examples that have it, letters of a word's stems.
LEAST_CHI2, LEAST_EXAMPLES, STEMS = 30.0, 3, (4,)
NEIGHBOURS, BLOCK, SHOWN = 16, 64, 3
WORDS = re.compile(r"\w+")


def held_out(key: Column) -> Column:
    """One row in five is never learnt from; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0


def terms_of(text: str | None, only: dict[str, int] | None = None) -> Counter:
    """Words, and the stems of longer words, with their counts; only those asked for."""
    out: Counter = Counter()
    for word, count in Counter(WORDS.findall((text or "").lower())).items():
        if only is None or word in only:
            out[word] += count
        size = len(word)
        for letters in STEMS:
            if size <= letters:
                break
            stem = word[:letters] + "*"
            if only is None or stem in only:
                out[stem] += count
    return out


def vector(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term ids in order and their weights, of length 1; both are empty if no term occurs."""
    at = np.array(sorted(counts), np.int64)
    weight = np.array([1 + math.log(counts[i]) for i in at]) * idf[at] if len(at) else np.zeros(0)
    return at, weight / np.linalg.norm(weight) if len(at) else weight


class BlockMaxIndex:
    """Exact nearest vectors: postings by term and block of vectors, each with the largest weight in the block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        # Neighbouring vectors with the same strongest terms make blocks whose bounds are tight.
        strongest = [tuple(t[np.argsort(-w, kind="stable")][:3]) for t, w in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=lambda i: (strongest[i], i)), np.int64)
        self.blocks = -(-len(vectors) // BLOCK)
        lists: dict[int, list[tuple[int, float]]] = {}
        for place, i in enumerate(self.order):
            for t, w in zip(*vectors[i]):
                lists.setdefault(int(t), []).append((place, float(w)))
        self.postings: dict[int, tuple] = {}
        for t, held in lists.items():
            place = np.array([p for p, _ in held])
            weight = np.array([w for _, w in held])
            opens = np.flatnonzero(np.diff(place // BLOCK, prepend=-1))
            self.postings[t] = (
                place // BLOCK, opens, place[opens] // BLOCK, np.maximum.reduceat(weight, opens), place, weight)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, besides: int = -1) -> list[tuple[float, int]]:
        """(cosine, vector) of the k nearest with a cosine above 0, nearest first, of equals the lower number first."""
        lists = [(w, self.postings[int(t)]) for t, w in zip(terms, weights) if int(t) in self.postings]
        bound = np.zeros(self.blocks)
        for w, (_, _, block, most, _, _) in lists:
            bound[block] += w * most
        best: list[tuple[float, int]] = []  # smallest first: (cosine, -vector)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(best) == k and bound[b] < best[0][0] - 1e-9:
                break
            score = np.zeros(BLOCK)
            for w, (_, opens, block, _, place, weight) in lists:
                at = np.searchsorted(block, b)
                if at < len(block) and block[at] == b:
                    stretch = slice(opens[at], opens[at + 1] if at + 1 < len(opens) else len(place))
                    score[place[stretch] - b * BLOCK] += w * weight[stretch]
            for i in np.flatnonzero(score > 0):
                vector = int(self.order[b * BLOCK + i])
                if vector == besides:
                    continue
                entry = (float(min(1.0, score[i])), -vector)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(s, -v) for s, v in sorted(best, reverse=True)]


@dataclass
class Model:
    """What fitting gives: bounded by MAX_EXAMPLES and MAX_TERMS, so it may be broadcast."""

    terms: dict[str, int]
    idf: np.ndarray
    index: BlockMaxIndex
    keys: list
    toxic: np.ndarray
    prior: float
    alone: float  # the score where no labelled example shares a term
    steps: tuple[np.ndarray, np.ndarray]  # calibration: votes in rising order and their scores

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Neighbours weigh by the inverse of their distance; the prior has the weight of a distant one."""
        weight = np.array([1 / (1.05 - c) for c, _ in near])
        label = self.toxic[[v for _, v in near]]
        return float((weight @ label + self.prior) / (weight.sum() + 1))

    def score(self, near: list[tuple[float, int]]) -> float:
        if not near or not len(self.steps[0]):
            return self.alone
        return float(np.interp(self.vote(near), *self.steps))


def rising(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the rising steps that fit the labels best, each drawn in by one half each way."""
    pools: list[list[float]] = []
    for v in np.unique(votes):
        here = votes == v
        pools.append([float(labels[here].sum()), float(here.sum()), v, v])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    xs = [x for p in pools for x in ([p[2], p[3]] if p[3] > p[2] else [p[2]])]
    ys = [(p[0] + 0.5) / (p[1] + 1) for p in pools for _ in range(2 if p[3] > p[2] else 1)]
    return np.array(xs), np.maximum.accumulate(np.array(ys)) if ys else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
        examples: int = MAX_EXAMPLES, most_terms: int = MAX_TERMS) -> Model:
    """Learn from at most ``examples`` labelled rows; document frequencies come from every row of docs.

    Terms are kept if their presence goes with the label (chi-square), as cosines over all words would be ruled by
    words that say nothing. The score of a vote is the share of toxic examples at that vote, found by leaving each
    example out of its own neighbours.
    """
    bounded_batches(docs.sparkSession)
    k, t = F.col(quoted(key)), F.col(quoted(text))
    train = (labels.where(F.col(label).isNotNull() & k.isNotNull() & ~held_out(k)).groupBy(k.alias("key"))
             .agg(F.max(label).cast("int").alias("toxic")).orderBy(F.xxhash64(F.lit(20), "key"), "key").limit(examples))
    texts = docs.select(k.alias("key"), t.alias("text"))
    counted = F.arrow_udf(_all_terms, "array<struct<term:string,count:int>>")
    # The sample has at most `examples` rows of two numbers, so it may be sent; a repeated id counts once.
    sample = (texts.join(F.broadcast(train), "key").groupBy("key", "toxic").agg(F.min("text").alias("text"))
              .withColumn("terms", counted("text")))
    n, pos = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = (pos + 0.5) / (n + 1)
    empty = Model({}, np.zeros(0), BlockMaxIndex([]), [], np.zeros(0), prior, prior, (np.zeros(0), np.zeros(0)))
    if not 0 < pos < n:
        return empty
    c, s = F.col("c"), F.col("s")
    chi2 = n * (s * (n - c - pos + s) - (c - s) * (pos - s)) ** 2 / (c * (n - c) * F.lit(float(pos)) * (n - pos))
    chosen = (sample.select("toxic", F.explode("terms.term").alias("term")).groupBy("term")
              .agg(F.count(F.lit(1)).cast("double").alias("c"), F.sum("toxic").cast("double").alias("s"))
              .where((c >= LEAST_EXAMPLES) & (c < n)).withColumn("chi2", chi2).where(F.col("chi2") >= LEAST_CHI2)
              .orderBy(F.desc("chi2"), "term").limit(most_terms))
    terms = {row.term: i for i, row in enumerate(chosen.select("term").collect())}
    if not terms:
        return empty
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    @F.arrow_udf("array<int>")
    def present(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([[shared.value[x] for x in terms_of(t, shared.value)] for t in batch.to_pylist()], pa.list_(pa.int32()))

    rows = docs.count()
    df = dict(texts.select(F.explode(present("text")).alias("term")).groupBy("term").count().collect())
    idf = np.array([math.log((1 + rows) / (1 + df.get(i, 0))) + 1 for i in range(len(terms))])

    held = sample.select("key", "toxic", F.filter("terms", lambda x: x["term"].isin(list(terms))).alias("terms")).orderBy("key").collect()
    vectors = [vector({terms[x.term]: x["count"] for x in row.terms}, idf) for row in held]
    toxic = np.array([row.toxic for row in held], float)
    model = Model(terms, idf, BlockMaxIndex(vectors), [row.key for row in held], toxic, prior, prior, (np.zeros(0), np.zeros(0)))
    near = [model.index.nearest(*v, NEIGHBOURS, besides=i) for i, v in enumerate(vectors)]
    voted = np.array([bool(x) for x in near])
    model.alone = float((toxic[~voted].sum() + 0.5) / ((~voted).sum() + 1))
    if voted.any():
        model.steps = rising(np.array([model.vote(x) for x in near if x]), toxic[voted])
    return model


def _all_terms(texts: pa.Array) -> pa.Array:
    return pa.array([[{"term": a, "count": b} for a, b in terms_of(t).items()] for t in texts.to_pylist()],
                    pa.list_(pa.struct([("term", pa.string()), ("count", pa.int32())])))


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with score (0 to 1), predicted (1 from 0.5 on) and evidence (the nearest examples and shared terms).

    Null and empty texts, and texts without a learnt term, have no neighbours and get the share of toxic examples
    among such. Ties between neighbours go to the smaller key. Without labels of both kinds every score is the prior,
    a half if there are no labels at all. Repeated rows are scored each; an empty table gives no rows. A column with
    an output's name gives way to it.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.select(F.col(quoted(key))).dtypes[0][1]

    @F.arrow_udf(f"struct<score:double,evidence:array<struct<example:{kind},cosine:double,toxic:int>>>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in batches:
            out = []
            for t in batch.to_pylist():
                counts = terms_of(t, m.terms)
                near = m.index.nearest(*vector({m.terms[x]: c for x, c in counts.items()}, m.idf), NEIGHBOURS) if counts else []
                out.append({"score": m.score(near), "evidence": [
                    {"example": m.keys[v], "cosine": c, "toxic": int(m.toxic[v])} for c, v in near[:SHOWN]]})
            yield pa.array(out, pa_type)

    pa_type = _arrow_type(docs, key)
    judged = put(docs, {"judged": judge(F.col(quoted(text)))}) if "judged" not in docs.columns else docs.withColumn(
        "judged", judge(F.col(quoted(text))))
    return put(judged, {"score": F.col("judged.score"), "predicted": (F.col("judged.score") >= 0.5).cast("int"),
                        "evidence": F.col("judged.evidence")}).drop("judged")


def _arrow_type(docs: DataFrame, key: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    own = to_arrow_type(docs.schema[key].dataType)
    return pa.struct([("score", pa.float64()), ("evidence", pa.list_(pa.struct([
        ("example", own), ("cosine", pa.float64()), ("toxic", pa.int32())])))])


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")
