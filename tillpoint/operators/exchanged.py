"""Scores of customers one of whose features has another customer's value, for every feature.

A boosted tree only asks on which side of its thresholds a value lies. So a customer is a short row of small numbers, the bin of each feature
among all thresholds of the model, and an exchanged value is one such number. Every bin of a feature rules out a set of a tree's leaves
(one bit each); what all features leave is the leaf. The leaves without one feature are known from the others, so its exchanged value
costs one look-up in each tree that asks for it, and trees that do not keep their leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Leaves that one number has bits for.
WORD = 64
#: Customers scored together: what they need stays in a core's cache.
ROWS = 4096


@dataclass
class Tree:
    """Leaf values from left to right (weighted), and for each feature asked the leaves that every bin leaves: features x bins."""

    values: np.ndarray
    features: list[int]
    left: list[np.ndarray]


def _walk(of: dict, spans: dict[int, tuple[int, int]], at: int, values: list[float]) -> None:
    """Numbers a node's leaves from left to right."""
    node, first = of[at], len(values)
    if node["leftChild"] < 0:
        values.append(node["prediction"])
    else:
        _walk(of, spans, node["leftChild"], values)
        _walk(of, spans, node["rightChild"], values)
    spans[at] = (first, len(values))


class Scorer:
    """A boosted classifier over bins. ``nodes``: of each tree, by number, as ``explanations.tree_nodes`` returns them."""

    def __init__(self, nodes: dict[int, dict], weights: list[float], features: int):
        found: list[set] = [set() for _ in range(features)]
        for of in nodes.values():
            for node in of.values():
                if node["leftChild"] >= 0:
                    if node["split"]["numCategories"] != -1:
                        raise ValueError("explanations need continuous features")
                    found[node["split"]["featureIndex"]].add(node["split"]["leftCategoriesOrThreshold"][0])
        #: a value's bin is the number of thresholds below it
        self.thresholds = [np.array(sorted(v)) for v in found]
        self.trees = [self._tree(nodes[t], weights[t]) for t in sorted(nodes)]

    def _tree(self, of: dict, weight: float) -> Tree:
        values: list[float] = []
        spans: dict[int, tuple[int, int]] = {}
        _walk(of, spans, 0, values)
        words = -(-len(values) // WORD)
        left: dict[int, np.ndarray] = {}

        def bits(span: tuple[int, int]) -> np.ndarray:
            return np.array([sum(1 << (i - w * WORD) for i in range(max(span[0], w * WORD), min(span[1], (w + 1) * WORD))) for w in range(words)], dtype="uint64")

        for node in of.values():
            if node["leftChild"] >= 0:
                f, at = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
                table = left.setdefault(f, np.full((len(self.thresholds[f]) + 1, words), np.uint64(2 ** 64 - 1)))
                place = int(np.searchsorted(self.thresholds[f], at))  # bins up to here go left
                table[:place + 1] &= ~bits(spans[node["rightChild"]])
                table[place + 1:] &= ~bits(spans[node["leftChild"]])
        return Tree(np.array(values) * weight, sorted(left), [left[f] for f in sorted(left)])

    @property
    def kind(self) -> str:
        """The smallest type of numbers that holds every bin."""
        return "<u1" if max((len(t) for t in self.thresholds), default=0) < 256 else "<u4"

    def bins(self, matrix: np.ndarray) -> np.ndarray:
        """Customers x features; NaN lies above every threshold, as in the model."""
        return np.stack([np.searchsorted(t, matrix[:, f], side="left") for f, t in enumerate(self.thresholds)], axis=1).astype(self.kind)

    @staticmethod
    def _values(tree: Tree, kept: np.ndarray) -> np.ndarray:
        """The value of the leaf that is left of each row: the lowest bit."""
        place = np.zeros(len(kept), dtype="int64")
        open_ = np.ones(len(kept), dtype=bool)
        for w in range(kept.shape[1]):
            word = kept[:, w]
            here = open_ & (word != 0) if kept.shape[1] > 1 else slice(None)
            lowest = word[here] & (~word[here] + np.uint64(1))
            place[here] = np.frexp(lowest.astype("float64"))[1] - 1 + w * WORD
            if kept.shape[1] > 1:
                open_ &= word == 0
        return tree.values[place]

    def margins(self, bins: np.ndarray, wanted: list[int], other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(margin of each row, and for each wanted feature the margin with the bin that ``other`` has for it): rows, and rows x wanted.

        Trees are added up in their order in either case, so a row whose leaves stay has the same margin to the last digit.
        """
        own, exchanged = np.zeros(len(bins)), np.zeros((len(wanted), len(bins)))
        at = {f: i for i, f in enumerate(wanted)}
        for tree in self.trees:
            masks = [t[bins[:, f]] for f, t in zip(tree.features, tree.left)]
            full = np.full((len(bins), 1 if not masks else masks[0].shape[1]), np.uint64(2 ** 64 - 1))
            before = [full]
            for m in masks:
                before.append(before[-1] & m)
            value = self._values(tree, before[-1])
            own += value
            touched = [at[f] for f in tree.features if f in at]
            untouched = np.setdiff1d(np.arange(len(wanted)), touched)
            exchanged[untouched] += value
            after = full
            for i in range(len(masks) - 1, -1, -1):
                f = tree.features[i]
                if f in at:
                    exchanged[at[f]] += self._values(tree, before[i] & after & tree.left[i][other[:, at[f]]])
                after = after & masks[i]
        return own, exchanged.T

    def scores(self, bins: np.ndarray, wanted: list[int], other: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """``margins`` as probabilities, some thousand rows at a time."""
        for start in range(0, len(bins), ROWS):
            rows = slice(start, min(start + ROWS, len(bins)))
            own, exchanged = self.margins(bins[rows], wanted, other[rows])
            yield rows, _probability(own), _probability(exchanged)


def _probability(margin: np.ndarray) -> np.ndarray:
    """As the model has it: what the probability of the other class leaves of 1."""
    with np.errstate(over="ignore"):
        return 1.0 - 1.0 / (1.0 + np.exp(2.0 * margin))
