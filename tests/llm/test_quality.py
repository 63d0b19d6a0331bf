"""Forward-backward marginals against the sum over all labellings."""

from itertools import product

import numpy as np

from spokeline.llm import quality


def test_marginals_against_enumeration():
    rnd = np.random.default_rng(6)
    sizes = [3, 1, 6, 2, 1, 5]
    first = np.concatenate([[0], np.cumsum(sizes)])
    unary, pair = rnd.normal(size=(first[-1], 2)) * 2, rnd.normal(size=(2, 2))
    expected, pairs = np.zeros_like(unary), np.zeros((2, 2))
    for a, b in zip(first, first[1:]):
        weights = {}
        for labels in product((0, 1), repeat=b - a):
            score = sum(unary[a + t, x] for t, x in enumerate(labels))
            weights[labels] = np.exp(score + sum(pair[x, y] for x, y in zip(labels, labels[1:])))
        for labels, weight in weights.items():
            p = weight / sum(weights.values())
            for t, x in enumerate(labels):
                expected[a + t, x] += p
            for x, y in zip(labels, labels[1:]):
                pairs[x, y] += p
    probability, joint = quality.marginals(unary, pair, first)
    assert np.allclose(probability, expected) and np.allclose(joint, pairs)
