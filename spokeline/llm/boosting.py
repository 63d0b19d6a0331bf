"""Gradient-boosted trees: fitted on rows or counted cells of a grid, applied as a SQL expression."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

TREES = 24
DEPTH = 3
RATE = 0.3
BINS = 32
LEAST = 5
SHRINK = 1.0


@dataclass
class Node:
    """A leaf with its value, or a test: feature <= cut goes left."""

    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    left: "Node | None" = None
    right: "Node | None" = None


@dataclass
class Trees:
    """Log odds: the start value and the sum of a leaf of each tree."""

    start: float
    trees: list[Node]

    def odds(self, inputs: np.ndarray) -> np.ndarray:
        out = np.full(len(inputs), self.start)
        for tree in self.trees:
            out += _values(tree, inputs)
        return out

    def column(self, features: list[Column]) -> Column:
        """The log odds of rows whose features are these columns."""
        out = F.lit(self.start)
        for tree in self.trees:
            out = out + _case(tree, features)
        return out


def _values(node: Node, inputs: np.ndarray) -> np.ndarray:
    if node.left is None:
        return np.full(len(inputs), node.value)
    low = inputs[:, node.feature] <= node.cut
    return np.where(low, _values(node.left, inputs), _values(node.right, inputs))


def _case(node: Node, features: list[Column]) -> Column:
    if node.left is None:
        return F.lit(node.value)
    low = features[node.feature] <= F.lit(node.cut)
    return F.when(low, _case(node.left, features)).otherwise(_case(node.right, features))


def fit(
    inputs: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None, cuts: list | None = None
) -> Trees:
    """Trees for 0/1 labels by second-order boosting of the logistic loss on binned features.

    counts: how many rows each input stands for; then both labels weigh the same in total. cuts: where
    each feature may be cut (quantiles of the inputs). Without rows the log odds are 0; with one class
    only, those of its smoothed share."""
    counts, weights = (np.ones(len(labels)),) * 2 if counts is None else (counts, _balanced(labels, counts))
    n = weights.sum()
    share = ((weights * labels).sum() + 0.5) / (n + 1) if n else 0.5
    model = Trees(float(np.log(share / (1 - share))), [])
    if not n or labels.min() == labels.max():
        return model
    cuts = cuts or [np.unique(np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for x in inputs.T]
    binned = np.stack([np.searchsorted(c, x) for c, x in zip(cuts, inputs.T, strict=True)], axis=1)
    odds = np.full(len(labels), model.start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        tree = _grow(binned, cuts, weights * (labels - p), weights * (p * (1 - p)), counts, np.arange(len(labels)), DEPTH)
        model.trees.append(tree)
        odds += _values(tree, inputs)
    return model


def _balanced(labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights that add up to half of all counts for either label, if both have some."""
    ones = (counts * labels).sum()
    if not 0 < ones < counts.sum():
        return counts
    return counts * counts.sum() / 2 / np.where(labels == 1, ones, counts.sum() - ones)


def _grow(
    binned: np.ndarray, cuts: list, slope: np.ndarray, curve: np.ndarray, counts: np.ndarray, rows: np.ndarray, depth: int
) -> Node:
    g, h, n = slope[rows].sum(), curve[rows].sum(), counts[rows].sum()
    leaf = Node(value=float(RATE * g / (h + SHRINK)))
    if not depth or n < 2 * LEAST:
        return leaf
    best, choice = 1e-6, None
    for feature, points in enumerate(cuts):
        at = binned[rows, feature]
        size = len(points) + 1
        gl = np.cumsum(np.bincount(at, slope[rows], size))[:-1]
        hl = np.cumsum(np.bincount(at, curve[rows], size))[:-1]
        nl = np.cumsum(np.bincount(at, counts[rows], size))[:-1]
        gain = gl**2 / (hl + SHRINK) + (g - gl) ** 2 / (h - hl + SHRINK) - g**2 / (h + SHRINK)
        gain[(nl < LEAST) | (n - nl < LEAST)] = 0
        if len(gain) and gain.max() > best:
            best, choice = gain.max(), (feature, int(gain.argmax()))
    if choice is None:
        return leaf
    feature, point = choice
    low = binned[rows, feature] <= point
    return Node(
        feature=feature,
        cut=float(cuts[feature][point]),
        left=_grow(binned, cuts, slope, curve, counts, rows[low], depth - 1),
        right=_grow(binned, cuts, slope, curve, counts, rows[~low], depth - 1),
    )
