"""M9: the model with the lowest margin, without the margins of all models.

A ball tree over the weight vectors of one block of models.  A node holds the mean ``c`` of its
weight vectors, the largest distance ``r`` of one of them from it and their smallest intercept ``b``;
by Cauchy-Schwarz no margin of a row ``x`` below the node is under ``c . x - r * |x| + b``.  Rows
go through the tree together: first each row down to one leaf, by the lower bound of the two children,
which gives it a first margin; then once from the root, where a node keeps only the rows whose bound
there is not above their lowest margin so far.  A matrix product per node serves all rows kept.

The result is exact.  Bounds and products carry an allowance for rounding (``slack``); models within it
of the lowest are compared by ``margin_of``, a sum whose order depends on the width alone, so class
and margin do not depend on blocks, batches or the tree.  Equal margins go to the first model (models
come in name order); equal models count once.  Where the bounds cut nothing off (unrelated
weight vectors of high dimension) every margin is computed, as without a tree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Models of a leaf: fewer cost more small products, more leave less to cut off.
LEAF_MODELS = 32
# Bytes of the vectors gathered at once for exact margins.
PAIR_BYTES = 16 << 20


def margin_of(X: np.ndarray, W: np.ndarray, intercept: np.ndarray) -> np.ndarray:
    """Margins of rows with one model each: X (n, d), W (n, d), intercept (n,)."""
    return (X * W).sum(axis=1) + intercept


@dataclass
class Node:
    """Models ``low`` to ``high`` of the tree's order; a leaf has no children."""

    low: int
    high: int
    center: np.ndarray
    radius: float
    intercept: float
    children: tuple = ()


class BallTree:
    """Models W (m, d) with their intercepts, in name order; ``margins`` counts the margins computed."""

    def __init__(self, W: np.ndarray, intercept: np.ndarray, leaf_models: int = LEAF_MODELS):
        models = np.concatenate([W, intercept[:, None]], axis=1)
        first = np.sort(np.unique(models, axis=0, return_index=True)[1])
        self.order, self.leaf_models, self.margins = first, leaf_models, 0
        self.W, self.intercept = np.ascontiguousarray(W[first]), intercept[first]
        with np.errstate(over="ignore", invalid="ignore"):
            self.root = self._node(0, len(first))
            self.reach = np.sqrt((self.W**2).sum(axis=1).max(initial=0.0))
        self.shift = np.abs(self.intercept).max(initial=0.0)

    def _node(self, low: int, high: int) -> Node:
        some = self.W[low:high]
        center = some.mean(axis=0) if high > low else np.zeros(self.W.shape[1])
        far = np.sqrt(((some - center) ** 2).sum(axis=1))
        node = Node(low, high, center, float(far.max(initial=0.0)), float(self.intercept[low:high].min(initial=np.inf)))
        if high - low > self.leaf_models:
            # the model farthest from the mean and the one farthest from that: each takes the models nearer to
            # it, at least an eighth of them
            one = some[np.argmax(far)]
            other = some[np.argmax(((some - one) ** 2).sum(axis=1))]
            along = (some - (one + other) / 2) @ (other - one)
            by = np.argsort(along, kind="stable")
            for held in (self.order, self.W, self.intercept):
                held[low:high] = held[low:high][by]
            least = (high - low + 7) // 8
            middle = low + min(max(int((along < 0).sum()), least), high - low - least)
            node.children = (self._node(low, middle), self._node(middle, high))
        return node

    def slack(self, norms: np.ndarray) -> np.ndarray:
        """What rounding may add to or take from a margin or bound of a row of that norm."""
        width = self.W.shape[1] + 8
        return 16 * width * np.finfo(float).eps * (self.reach * norms + self.shift)

    def lowest(self, X: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(model or -1, margin) of every row of X (n, d): the lowest margin, unless it is above ``known``
        (n,), the lowest one of models seen before; an equal one is given.  A margin that is no number never wins."""
        X = np.ascontiguousarray(X)
        best, low = np.full(len(X), -1, np.int64), known.astype(np.float64)
        if not len(X) or not len(self.order):
            return best, low
        with np.errstate(over="ignore", invalid="ignore"):
            norms = np.sqrt((X**2).sum(axis=1))
            walk = _Walk(self, X, norms, self.slack(norms), best, low)
            rows = walk.kept(self.root, np.arange(len(X)))
            walk.seed(self.root, rows)
            walk.descend(self.root, rows)
        return best, low


class _Walk:
    """Rows on their way through a tree; ``best`` and ``low`` are updated in place."""

    def __init__(self, tree: BallTree, X, norms, slack, best, low):
        self.tree, self.X, self.norms, self.slack, self.best, self.low = tree, X, norms, slack, best, low
        self.seen = np.full(len(X), -1, np.int64)  # first model of the leaf that gave a row its first margin

    def bound(self, node: Node, rows) -> np.ndarray:
        return self.X[rows] @ node.center - node.radius * self.norms[rows] + node.intercept

    def kept(self, node: Node, rows) -> np.ndarray:
        """Rows that may have a margin at the node not above their lowest; a bound that is no number keeps its row."""
        return rows[~(self.bound(node, rows) > self.low[rows] + self.slack[rows])]

    def seed(self, node: Node, rows) -> None:
        if not len(rows):
            return
        if not node.children:
            self.seen[rows] = node.low
            self.leaf(node, rows)
            return
        left, right = node.children
        goes = self.bound(left, rows) <= self.bound(right, rows)
        self.seed(left, rows[goes])
        self.seed(right, rows[~goes])

    def descend(self, node: Node, rows) -> None:
        if not node.children:
            rows = rows[self.seen[rows] != node.low]
            if len(rows):
                self.leaf(node, rows)
            return
        for child in node.children:
            some = self.kept(child, rows)
            if len(some):
                self.descend(child, some)

    def leaf(self, node: Node, rows) -> None:
        """All margins of the leaf by one product; those that may be the lowest again by ``margin_of``."""
        tree = self.tree
        margins = self.X[rows] @ tree.W[node.low : node.high].T + tree.intercept[node.low : node.high]
        tree.margins += margins.size
        limit = np.minimum(self.low[rows], margins.min(axis=1)) + 2 * self.slack[rows]
        at, model = np.nonzero(~(margins > limit[:, None]))
        step = max(1, PAIR_BYTES // (8 * max(1, tree.W.shape[1])))
        for start in range(0, len(at), step):
            row, held = rows[at[start : start + step]], node.low + model[start : start + step]
            exact, place = margin_of(self.X[row], tree.W[held], tree.intercept[held]), tree.order[held]
            # the lowest of each row, the first name among equals
            by = np.lexsort((place, exact, row))
            ahead = by[np.r_[True, row[by][1:] != row[by][:-1]]]
            row, exact, place = row[ahead], exact[ahead], place[ahead]
            # an equal margin of an earlier block leaves ``best`` at -1; the caller compares names
            before = self.best[row]
            wins = (exact < self.low[row]) | ((exact == self.low[row]) & ((before < 0) | (place < before)))
            self.best[row[wins]], self.low[row[wins]] = place[wins], exact[wins]
