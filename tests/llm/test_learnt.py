"""Operators 2 and 6: exact neighbours, held-out accuracy, odd rows."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from llm_cases import none, odd, some_labels  # noqa: F401
from wakeline.llm import quality, toxicity
from wakeline.llm.common import table

MIDDLE = "/root/testdata/sf0.1"


@pytest.mark.parametrize("block", [2, 64])
def test_block_max_index_is_exact(block, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(1)
    vectors = []
    for _ in range(150):
        t = np.sort(rng.choice(40, rng.integers(0, 9), replace=False))
        w = rng.random(len(t)) + 0.1
        vectors.append((t, w / np.linalg.norm(w) if len(t) else w))
    vectors += vectors[:10]  # ties
    dense = np.zeros((len(vectors), 40))
    for row, (t, w) in zip(dense, vectors):
        row[t] = w
    index = toxicity.BlockMaxIndex(vectors)
    for i, (t, w) in enumerate(vectors):
        cosine = dense @ dense[i]
        want = sorted(((c, -j) for j, c in enumerate(cosine) if c > 0 and j != i), reverse=True)[:5]
        got = index.nearest(t, w, 5, besides=i)
        assert np.allclose([c for c, _ in got], [c for c, _ in want])
        assert {v for c, v in got if c > want[-1][0] + 1e-9} == {-j for c, j in want if c > want[-1][0] + 1e-9}


def test_rising_steps():
    x, y = toxicity.rising(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]))
    assert (np.diff(y) >= 0).all() and x[0] == 0.1 and 0 < y[0] < y[-1] < 1


def accuracy(spark, rows, labels, label):
    known = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("truth"))
    held = rows.join(known, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    return held


def test_toxicity_held_out(spark):
    docs, labels = table(spark, MIDDLE, "documents").select("doc_id", "text"), table(spark, MIDDLE, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).select("doc_id", "score", "predicted", "evidence")
    held = accuracy(spark, scored, labels, "toxic")
    clean, toxic = [r for r in held if not r.truth], [r for r in held if r.truth]
    assert np.mean([r.predicted == r.truth for r in held]) > 0.96
    assert np.mean([r.predicted for r in toxic]) > 0.8 and np.mean([r.predicted for r in clean]) < 0.02
    # calibrated: the mean score is near the share of toxic documents
    assert abs(np.mean([r.score for r in held]) - np.mean([r.truth for r in held])) < 0.03
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held)
    assert all(r.evidence for r in held if r.predicted)


def test_held_out_is_the_crc_of_the_id(spark):
    rows = spark.range(500).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_toxicity_odd_rows(spark, odd, none, some_labels):
    for labels in (some_labels, some_labels.limit(0), some_labels.where("toxic = 1")):
        model = toxicity.fit(odd, labels)
        rows = toxicity.score(odd, model).collect()
        assert len(rows) == odd.count()
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.score(none, toxicity.fit(none, some_labels)).count() == 0


def test_labels_held_out_do_not_matter(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.score(docs, toxicity.fit(docs, x)).select("doc_id", "score").orderBy("doc_id").collect() for x in (labels, turned))
    assert a == b


def test_quality_held_out(spark):
    labels = table(spark, MIDDLE, "labels")
    held = accuracy(spark, quality.op6(spark, MIDDLE), labels, "quality")
    good, bad = [r for r in held if r.truth], [r for r in held if not r.truth]
    assert np.mean([r.kept for r in good]) > 0.98 and np.mean([r.kept for r in bad]) < 0.2


def test_quality_odd_rows(spark, odd, none, some_labels):
    for labels in (some_labels, some_labels.limit(0)):
        rows = quality.quality(odd, labels).collect()
        assert len(rows) == odd.count()
        assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in rows)
    assert quality.quality(none, some_labels).count() == 0


def test_sparse_groups_are_drawn_to_what_is_above(spark):
    rng = np.random.default_rng(2)
    rows = [(h, float(rng.random() < p)) for h, p, n in [("good", 0.95, 400), ("bad", 0.2, 400), ("mid", 0.6, 400)] for _ in range(n)]
    rows += [("few", 1.0), ("few", 1.0), (None, 0.0)]
    frame = spark.createDataFrame(rows, "host string, belief double")
    above = np.mean([b for _, b in rows])
    found = {r.host: r for r in quality.shrunk(frame, ["host"], F.lit(float(above)), "host").collect()}
    assert len(found) == 5 and found["few"].host_docs == 2
    assert abs(found["good"].host_posterior - 0.95) < 0.05 and abs(found["bad"].host_posterior - 0.2) < 0.06
    assert above < found["few"].host_posterior < 1
    assert found[None].host_posterior == pytest.approx(above)


def plain_features(text):
    import regex

    words = [w for w in regex.split(r"[ \t\n\x0b\f\r]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" ")]
    chars, count = max(len(text), 1), max(len(words), 1)
    share = lambda pattern: len(regex.findall(pattern, text)) / chars
    values = {
        "distinct_words": len(set(words)) / count, "distinct_lines": len(set(lines)) / max(len(lines), 1),
        "capitals": share(r"\p{Lu}"), "marks": share(r"[^\p{L}\p{N} \t\n\x0b\f\r.,]") * 4, "digits": share(r"\p{N}") * 4,
        "stops": len(regex.findall(r"[.!?](?:[ \t\n\x0b\f\r]|$)", text)) / count * 3, "word_length": chars / count / 20,
        "length": math.log10(count) / 5,
    }
    return {f: int(math.floor(min(max(v, 0.0), 1.0) * 20)) for f, v in values.items()}


def plain_quality(docs, labels):
    """docs: (id, text, host, path); labels: (id, good). The whole model over again, in plain loops."""
    log_odds = lambda p: math.log(p / (1 - p))
    chance = lambda x: 1 / (1 + math.exp(-x))
    known = {}
    for key, good in labels:
        if key is not None and good is not None and zlib.crc32(str(key).encode()) % 5:
            known[key] = max(known.get(key, 0), good)
    rows = [(d[0], d[2], d[3], plain_features(d[1] or ""), known.get(d[0])) for d in docs]
    learnt = [r for r in rows if r[4] is not None]
    share = (sum(r[4] for r in learnt) + 0.5) / (len(learnt) + 1)
    counts = defaultdict(lambda: [0, 0])
    for r in learnt:
        for f, b in r[3].items():
            counts[f, b][0] += r[4]
            counts[f, b][1] += 1
    believed = []
    for key, host, path, bins, good in rows:
        moves = [log_odds((counts[fb][0] + 4 * share) / (counts[fb][1] + 4)) - log_odds(share) for fb in bins.items() if fb in counts]
        evidence = sum(min(max(m, -3.0), 3.0) for m in moves)
        belief = chance(evidence + log_odds(share)) if good is None else (good * (len(learnt) + 1) + share) / (len(learnt) + 2)
        believed.append((key, host, path, evidence, belief))

    def level(of, above):
        sums = defaultdict(lambda: [0.0, 0])
        for b in believed:
            sums[of(b)][0] += b[4]
            sums[of(b)][1] += 1
        n, s = sum(g[1] for g in sums.values()), sum(g[0] for g in sums.values())
        nn, ss, strength = sum(g[1] ** 2 for g in sums.values()), sum(g[0] ** 2 / g[1] for g in sums.values()), 10_000.0
        if len(sums) > 1:
            p = s / n
            extra = ss - n * p * p - (len(sums) - 1) * p * (1 - p)
            spread = max(extra / (n - nn / n), 0.0)
            strength = min(max(p * (1 - p) / spread - 1, 1.0), 10_000.0) if spread > 0 else 10_000.0
        return [(sums[of(b)][0] - b[4] + strength * a) / (sums[of(b)][1] - 1 + strength) for b, a in zip(believed, above)]

    host = level(lambda b: b[1], [share] * len(believed))
    path = level(lambda b: (b[1], b[2]), host)
    return {b[0]: (chance(b[3] + log_odds(min(max(p, 1e-6), 1 - 1e-6))), b[3], h, p) for b, h, p in zip(believed, host, path)}


def test_quality_equals_plain_loops(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    want = plain_quality([tuple(r) for r in docs.select("doc_id", "text", "source", "lang").collect()],
                         [tuple(r) for r in labels.select("doc_id", "quality").collect()])
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.score, r.evidence, r.host_posterior, r.path_posterior) == pytest.approx(want[r.doc_id], rel=1e-9, abs=1e-12)
        assert r.kept == (r.score >= 0.5)
