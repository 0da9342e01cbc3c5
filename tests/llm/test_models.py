"""The classifiers' learning and inference against plain loops and enumeration."""

import itertools
import math

import numpy as np
import pyarrow as pa

from tessera.llm import quality, toxicity


def plain_ftrl(examples, epochs):
    """Follow the regularised leader, one coordinate at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return -(z[i] - sign * quality.L1) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(epochs):
        for label, bucket, value in examples:
            w = [weight(i) for i in bucket]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, value))))
            for i, x, own in zip(bucket, value, w):
                g = (p - label) * x
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / quality.ALPHA * own
    return {i: weight(i) for i in z}


def test_ftrl_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    examples = []
    for _ in range(60):
        bucket = np.sort(rng.choice(40, rng.integers(1, 12), replace=False)).astype(np.int64)
        examples.append((int(rng.integers(0, 2)), bucket, rng.random(len(bucket))))
    got = quality.ftrl(examples, 3)
    want = plain_ftrl([(y, b.tolist(), v.tolist()) for y, b, v in examples], 3)
    assert any(w == 0 for w in want.values()) and any(w != 0 for w in want.values())
    for i, w in want.items():
        assert abs(got[i] - w) < 1e-6
    assert not np.delete(got, list(want)).any()


def test_quality_scores_are_sparse_dot_products():
    rng = np.random.default_rng(4)
    weights = rng.normal(size=quality.BUCKETS + 1)
    texts = ["", None, "one", "one two one two", "a a a b, c! " * 50]
    got = quality.score_texts(pa.array(texts, pa.string()), weights)
    for text, score in zip(texts, got):
        total, dot = 0, 0.0
        for _, _, h, doc, *_ in quality.tokens(pa.array([text], pa.string())):
            for b in quality.gram_buckets(h, doc)[0].tolist():
                total, dot = total + 1, dot + weights[b]
        want = 1 / (1 + math.exp(-(weights[-1] + dot / math.sqrt(max(total, 1)))))
        assert abs(score - want) < 1e-9


def enumerated(score, move):
    """``(marginals, pair marginals)`` of one chain over all its tag sequences."""
    n = len(score)
    total, one, two = 0.0, np.zeros(n), np.zeros((max(n - 1, 0), 2, 2))
    for tags in itertools.product((0, 1), repeat=n):
        mass = math.exp(sum(s for s, t in zip(score, tags) if t))
        for a, b in zip(tags, tags[1:]):
            mass *= move[a, b]
        total += mass
        one += mass * np.array(tags)
        for k, pair in enumerate(zip(tags, tags[1:])):
            two[k][pair] += mass
    return one / total, two / total


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(5)
    sizes = [1, 2, 7, 1, 10, 3]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    score = rng.normal(size=sum(sizes)) * 2
    move = toxicity.transition_matrix(np.array([0.0, -0.7, 0.4, 1.3]))
    _, _, p = toxicity.forward_backward(score, first, move)
    for a, n in zip(first, sizes):
        assert np.abs(p[a:a + n] - enumerated(score[a:a + n], move)[0]).max() < 1e-12


def test_field_steps_follow_the_enumerated_gradient(monkeypatch):
    """One gradient step from zero weights: expected counts of words and transitions by enumeration."""
    monkeypatch.setattr(toxicity, "STEPS", 1)
    sizes = [4, 1, 6]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    rng = np.random.default_rng(6)
    bucket = rng.integers(0, 9, size=(1, sum(sizes))).astype(np.int32)
    toxic = rng.integers(0, 2, sum(sizes))
    w, extra = toxicity.fit_field(bucket, first, toxic)
    start = np.zeros(toxicity.EXTRA)
    start[0] = -2.0
    move = toxicity.transition_matrix(start)
    grad, some = np.zeros(toxicity.BUCKETS), np.zeros(4)
    for a, n in zip(first, sizes):
        one, two = enumerated(np.full(n, -2.0), move)
        own = toxic[a:a + n]
        np.add.at(grad, bucket[0, a:a + n], own - one)
        some[0] += (own - one).sum()
        for k in range(n - 1):
            some[own[k] * 2 + own[k + 1]] += own[k] * 2 + own[k + 1] > 0
            some[1:] -= two[k].ravel()[1:]
    some -= toxicity.L2 * start[:4]
    step = toxicity.RATE * grad / np.sqrt(1e-3 + grad * grad)
    assert np.abs(w - step).max() < 1e-9
    assert np.abs(extra[:4] - (start[:4] + toxicity.RATE * some / np.sqrt(1e-3 + some * some))).max() < 1e-9


def test_score_fit_is_the_penalised_optimum():
    rng = np.random.default_rng(7)
    x = np.column_stack([np.ones(300), rng.normal(size=(300, 3))])
    y = (rng.random(300) < 1 / (1 + np.exp(-x @ [0.3, 1.0, -2.0, 0.0]))).astype(np.int64)
    c = toxicity.fit_score(x, y)
    p = 1 / (1 + np.exp(-x @ c))
    assert np.abs(x.T @ (y - p) - 0.1 * c).max() < 1e-8
