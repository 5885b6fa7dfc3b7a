"""Operators 5 and 8 against brute force: links, classes and the row that stays."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from llm_cases import none, odd  # noqa: F401
from wakeline.llm import embeddings, ngram
from wakeline.llm.common import connected, table


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def tie(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self[b] = a


def runs_of(text, n=5):
    w = (text or "").lower().split()
    return {" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_links(sets, threshold):
    """(links of each row, root of each row) by comparing all pairs."""
    links, ties = Counter(), Union()
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                ties.tie(i, j)
    return links, ties


def check_near(rows, threshold=0.8):
    """rows: (id, text, class_id, n_links, kept) of all documents."""
    links, ties = brute_links([runs_of(r.text) for r in rows], threshold)
    classes = defaultdict(list)
    for i, r in enumerate(rows):
        assert r.n_links == links[i], r
        classes[ties.find(i)].append(r)
    for members in classes.values():
        low = min((m.doc_id for m in members if m.doc_id is not None), default=None)
        assert {m.class_id for m in members} == {low}
        stays = [m for m in members if m.kept]
        assert len({(m.doc_id, m.text) for m in stays}) == 1 and stays[0].doc_id == low


def joined(docs, found):
    """Membership with texts: row_key stands for id and text."""
    keyed = docs.select("doc_id", "text", ngram.row_key(docs, "text", "doc_id").alias("row_key"))
    texts = keyed.withColumn("n", F.row_number().over(_in_key()))
    told = found.withColumn("n", F.row_number().over(_in_key())).drop("doc_id")
    return texts.join(told, ["row_key", "n"]).collect()


def _in_key():
    from pyspark.sql import Window

    return Window.partitionBy("row_key").orderBy(F.lit(1))


def family(size, words=120, seed=1):
    """Texts that differ from a common one in a few words: a group of near copies, all of them different."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}x{seed}" for i in range(words)]
    out = []
    for k in range(size):
        own = list(base)
        for at in rng.choice(words, 1 + k % 3, replace=False):
            own[at] = f"edit{k}y{at}"
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="module")
def families(spark):
    shared = " ".join(f"passage{i}" for i in range(60))
    texts = family(40) + family(3, 300, 2) + ["few words", "few words", "FEW  words", "x"] + [
        shared + " " + " ".join(f"own{k}z{i}" for i in range(80)) for k in range(30)]
    return spark.createDataFrame([(1000 - i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("which", ["table", "families", "odd"])
def test_near_duplicates_match_brute_force(spark, families, odd, which):
    docs = {"table": table(spark, SMALL, "documents"), "families": families, "odd": odd}[which]
    rows = joined(docs, ngram.near_duplicates(docs))
    assert len(rows) == docs.count()
    empty = [r for r in rows if not runs_of(r.text)]
    assert all((r.class_id, r.n_links, r.kept) == (r.doc_id, 0, True) for r in empty)
    check_near([r for r in rows if runs_of(r.text)])


def test_blocks_of_large_buckets_and_components(families, monkeypatch):
    monkeypatch.setattr(ngram, "MEMBERS", 7)
    monkeypatch.setattr(ngram, "VERIFIED", 9)
    check_near(joined(families, ngram.near_duplicates(families)))


def test_no_documents_have_no_links(none):
    assert ngram.near_duplicates(none).count() == 0


def test_posterior_keeps_pairs_at_the_threshold():
    least = ngram.least_matches(0.8, ngram.TOLERANCE)
    rng = np.random.default_rng(3)
    agree = np.cumsum((rng.random((200_000, ngram.HASHES)) < 0.8).reshape(200_000, -1, ngram.STEP).sum(axis=2), axis=1)
    assert (agree < least).any(axis=1).mean() < 5e-5
    far = np.cumsum((rng.random((20_000, ngram.HASHES)) < 0.3).reshape(20_000, -1, ngram.STEP).sum(axis=2), axis=1)
    assert (far < least).any(axis=1).mean() > 0.999


def test_dense_and_pairwise_intersections_agree():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 300, 80)).astype(np.uint64) for _ in range(20)]
    a, b = np.triu_indices(20, 1)
    want = [len(set(sets[i]) & set(sets[j])) for i, j in zip(a, b)]
    assert ngram.intersections(sets, a, b).tolist() == want
    assert ngram.intersections(sets, a[:50], b[:50]).tolist() == want[:50]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(500, 700)] + [(3, 3), (160, 100), (900, 901)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(500, 700)]} | {900: 900, 901: 900}


def near_pairs(rng, groups, dims):
    """Vectors about the threshold: groups around a centre, at cosines from 0.85 to 1."""
    out = []
    for g in range(groups):
        centre = rng.standard_normal(dims)
        centre /= np.linalg.norm(centre)
        for k in range(8):
            aside = rng.standard_normal(dims)
            aside -= centre * (aside @ centre)
            aside /= np.linalg.norm(aside)
            angle = np.arccos(0.94 + 0.06 * rng.random())
            out.append((np.cos(angle) * centre + np.sin(angle) * aside) * rng.uniform(0.1, 9))
    return out


@pytest.mark.parametrize("members", [2048, 25])
def test_vectors_match_brute_force(spark, members, monkeypatch):
    monkeypatch.setattr(embeddings, "MEMBERS", members)
    rng = np.random.default_rng(6)
    vectors = [(int(i), [float(x) for x in v], int(rng.integers(0, 3))) for i, v in enumerate(near_pairs(rng, 60, 24))]
    vectors += [(1000 + i, vectors[5][1], vectors[5][2]) for i in range(20)]  # copies
    vectors += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 24, 1), (2003, [float("nan")] + [1.0] * 23, 1),
                (2004, [None] + [1.0] * 23, 1), (2005, [float("inf")] + [1.0] * 23, 1), (2006, vectors[5][1], None),
                (None, vectors[9][1], vectors[9][2]), (2007, vectors[5][1][:12], vectors[5][2]), (2007, [1e-38] * 24, 7),
                (2008, [1e38] * 24, 7)]
    frame = spark.createDataFrame([(*v, "n") for v in vectors], "vec_id long, embedding array<float>, label int, node string")
    frame = frame.repartition(3).cache()
    rows = frame.collect()
    found = embeddings.near_vectors(frame).collect()
    assert len(found) == len(rows)
    usable = [r for r in rows if r.label is not None and r.embedding and None not in r.embedding
              and np.isfinite(r.embedding).all() and np.any(r.embedding)]
    links, ties = Counter(), Union()
    for i, a in enumerate(usable):
        for b in usable[:i]:
            if a.label == b.label and len(a.embedding) == len(b.embedding):
                x, y = np.array(a.embedding) / np.abs(a.embedding).max(), np.array(b.embedding) / np.abs(b.embedding).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    links[id(a)] += 1
                    links[id(b)] += 1
                    ties.tie(id(a), id(b))
    # Ids in this table are unique but for one that has no links with itself, so links compare as a multiset by id.
    want = Counter((r.vec_id, links[id(r)]) for r in rows)
    got = Counter((r.vec_id, r.n_links) for r in found)
    missed = sum((want - got).values())
    assert sum(r.n_links for r in found) <= sum(links.values())
    assert sum(r.n_links for r in found) >= 0.97 * sum(links.values()) > 0
    if not missed:
        for r in found:
            assert r.kept == (r.vec_id == r.component_id)
    alone = {r.vec_id for r in rows} - {r.vec_id for r in usable}
    assert all((r.n_links, r.component_id) == (0, r.vec_id) for r in found if r.vec_id in alone)


def test_recall_on_the_table(spark):
    rows = table(spark, SMALL, "embeddings").collect()
    found = {r.vec_id: r.n_links for r in embeddings.op8(spark, SMALL).collect()}
    assert len(found) == len(rows)
    by_label = defaultdict(list)
    for r in rows:
        by_label[r.label].append(r)
    for label, members in by_label.items():
        m = np.array([r.embedding for r in members], float)
        m /= np.linalg.norm(m, axis=1)[:, None]
        for r, n in zip(members, (m @ m.T >= 0.93).sum(axis=1) - 1):
            assert found[r.vec_id] <= n
            assert label is None or found[r.vec_id] == n


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_vectors(empty).count() == 0


def test_calibration_is_the_binomial_tail():
    rng = np.random.default_rng(9)
    count = embeddings.calibrated_count(0.999)
    x = np.zeros(64)
    x[0] = 1
    y = np.zeros(64)
    y[:2] = 0.93, np.sqrt(1 - 0.93**2)
    met = [(np.abs((x - y) @ rng.standard_normal((64, embeddings.PROJECTIONS))) <= embeddings.distance_at(0.93)).sum()
           for _ in range(4000)]
    assert (np.array(met) >= count).mean() >= 0.996


def test_text_labels_that_look_like_components_do_not_meet(spark):
    df = spark.createDataFrame([(1, "a,1.0", [2.0]), (2, "a", [1.0, 2.0]), (3, "a", [1.0, 2.0])],
                               "vec_id long, label string, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}
    assert got == {1: (0, 1), 2: (1, 2), 3: (1, 2)}


def test_row_keys_tell_null_from_empty_and_have_128_bits(spark):
    rows = [(None, None), (None, ""), (None, "-"), (1, None), (1, ""), (11, ""), (1, "1"), (1, "\n+")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = {bytes(r[0]) for r in df.select(ngram.row_key(df, "text", "doc_id")).collect()}
    assert len(keys) == len(rows) and {len(k) for k in keys} == {16}
