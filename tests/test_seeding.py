import hashlib
import math

import numpy as np
import pytest

from tessera.operators import cluster, seeding


def draw(i, seed, turn):
    return (int(hashlib.md5(f"{seed}:{turn}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52


def brute(x, k, rounds, factor, seed):
    """Seeds by the rules of the module, one document after the other."""
    n = len(x)
    unit = 2.0 ** (math.ceil(math.log2((x ** 2).sum(1).max())) - seeding.DIGITS)
    q = lambda a, b: math.floor(((x[a] - x[b]) ** 2).sum() / unit + 0.5)
    found = [min(range(n), key=lambda i: (draw(i, seed, 0), i))]
    turn = 1
    while True:
        far = [min(q(i, c) for c in found) for i in range(n)]
        total = sum(far)
        if not total or (turn > rounds and len(found) >= k):
            break
        found += [i for i in range(n) if draw(i, seed, turn) * float(total) < factor * k * far[i]]
        turn += 1
    near = [min(range(len(found)), key=lambda c: (q(i, found[c]), c)) for i in range(n)]
    weights = {c: near.count(c) for c in set(near)}
    draws = [{c: draw(found[c], seed, -s) for c in weights} for s in range(1, k + 1)]
    chosen = seeding.reduce_candidates(weights, lambda a, b: q(found[a], found[b]), draws, k)
    return found, [found[c] for c in chosen]


def frames(spark, x, parts=3):
    rows = [(i, f"t{j}", float(x[i, j])) for i in range(len(x)) for j in range(x.shape[1]) if x[i, j]]
    entries = spark.createDataFrame(rows, "doc_id long, term string, val double").repartition(parts)
    return spark.range(len(x)).withColumnRenamed("id", "doc_id"), entries


def table(seed):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.integers(m, m + 4, size=(30, 6)) * (rng.random((30, 6)) < 0.7) for m in (0, 10, 30, 60)]).astype(float)
    x[7] = 0                    # a document without terms
    x[40:50] = x[40]            # copies
    return x


@pytest.mark.parametrize("k, rounds, factor, seed", [(4, 3, 2, 42), (5, 0, 1, 7)])
def test_equals_one_document_after_the_other(spark, k, rounds, factor, seed):
    x = table(seed)
    docs, entries = frames(spark, x)
    found, chosen = brute(x, k, rounds, factor, seed)
    assert seeding.candidates(docs, entries, k, rounds, factor, seed)[0] == found
    assert seeding.parallel_seeds(docs, entries, k, rounds, factor, seed) == chosen
    assert len(chosen) == k


def test_partitioning_joins_and_hot_terms_do_not_matter(spark, monkeypatch):
    from tessera.operators import skew
    x = table(3)
    docs, entries = frames(spark, x, 1)
    want = seeding.parallel_seeds(docs, entries, 4)
    assert seeding.parallel_seeds(docs.repartition(9).union(docs), entries.repartition(13), 4) == want   # ids repeated
    monkeypatch.setattr(skew, "BROADCAST_MAX_BYTES", 0)
    monkeypatch.setattr(skew, "DEFAULT_THRESHOLD", 20)      # every term is hot
    assert seeding.parallel_seeds(docs, entries, 4) == want


def test_race_follows_the_weights():
    """Chances of the first draw are the weights, of the second weight times squared distance."""
    rng = np.random.default_rng(1)
    weights, where = {0: 1, 1: 2, 2: 5}, {0: 0.0, 1: 1.0, 2: 3.0}
    pairs = [tuple(seeding.reduce_candidates(weights, lambda i, j: (where[i] - where[j]) ** 2, rng.random((2, 3)), 2))
             for _ in range(20000)]
    for i in weights:
        assert abs(sum(p[0] == i for p in pairs) / 20000 - weights[i] / 8) < 0.02
    second = [p[1] for p in pairs if p[0] == 0]
    assert abs(second.count(1) / len(second) - 2 / (2 + 45)) < 0.02


def test_seeds_lead_sparse_lloyd_to_the_groups(spark):
    x = table(42)
    docs, entries = frames(spark, x)
    seeds = seeding.parallel_seeds(docs, entries, 4)
    got, _ = cluster.sparse_lloyd(docs, entries, seeds, 10)
    rows = got.collect()
    spread = sum(r["dist2"] for r in rows)
    bad, _ = cluster.sparse_lloyd(docs, entries, [0, 1, 2, 3], 10)
    assert spread <= sum(r["dist2"] for r in bad.collect()) + 1e-6


def test_few_documents_copies_and_nothing(spark):
    docs, entries = frames(spark, np.ones((6, 2)))
    assert len(seeding.parallel_seeds(docs, entries, 3)) == 1          # one vector
    docs, entries = frames(spark, np.array([[1.0], [3.0]]))
    assert sorted(seeding.parallel_seeds(docs, entries, 8)) == [0, 1]
    none = spark.createDataFrame([], "doc_id long, term string, val double")
    assert len(seeding.parallel_seeds(docs, none, 2)) == 1             # all without terms
    assert seeding.parallel_seeds(spark.range(0).withColumnRenamed("id", "doc_id"), none, 2) == []
    with pytest.raises(ValueError):
        seeding.parallel_seeds(docs, entries, 0)
