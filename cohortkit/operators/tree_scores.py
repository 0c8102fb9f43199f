"""Scores of a random forest in whole batches, for explanations that ask for many variants of a row.

A forest splits a feature at few thresholds, so a row is one small number per feature: how many thresholds it exceeds.  Per
feature, number and tree, a 64-bit mask holds the leaves still open; the lowest bit of the masks' AND is the row's leaf.  A variant of a row with one
feature replaced needs that feature's masks alone.  The lowest bit times a de Bruijn number has a leaf's own place in its upper six bits, where
the leaf's votes are looked up.  Votes are added in the model's own order, so predictions equal ``model.transform``'s.

Forests of two classes, numeric splits and at most 64 leaves a tree; for others ``forest_of`` returns None.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from cohortkit.operators.tree_shap import _nodes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: every six bits in a row of it are another number.
DE_BRUIJN = np.uint64(0x03F79D71B4CB0A89)
BLOCK = 1024  # rows scored at a time, so that their masks stay in a core's cache


@dataclass
class Forest:
    cuts: list[np.ndarray]     # per feature its thresholds, ascending
    masks: list[np.ndarray]    # per feature: trees x (thresholds exceeded), the open leaves
    shares: np.ndarray         # trees x leaves x 2: a leaf's shares of the classes
    looked_up: np.ndarray = field(init=False)  # trees x places: both shares as one complex number

    def __post_init__(self):
        self.looked_up = np.zeros((len(self.shares), 64), np.complex128)
        place = ((np.uint64(1) << np.arange(64, dtype=np.uint64)) * DE_BRUIJN >> np.uint64(58)).astype(int)
        self.looked_up[:, place[:self.shares.shape[1]]] = self.shares[:, :, 0] + 1j * self.shares[:, :, 1]

    def places(self, x: np.ndarray, feature: int) -> np.ndarray:
        """Thresholds that values exceed; a missing one exceeds all, as in Spark."""
        return np.searchsorted(self.cuts[feature], x).astype(np.uint16)

    def open(self, feature: int, places: np.ndarray) -> np.ndarray:
        return np.take(self.masks[feature], places, axis=1)

    def without_each(self, places: np.ndarray) -> list[np.ndarray]:
        """Per feature the leaves that all other features leave open; ``places``: rows x features."""
        own = [self.open(j, places[:, j]) for j in range(len(self.cuts))]
        full = np.full((len(self.shares), len(places)), ~np.uint64(0))
        after = [full]
        for m in own[:0:-1]:
            after.append(after[-1] & m)
        before, out = full, []
        for m, rest in zip(own, after[::-1]):
            out.append(before & rest)
            before = before & m
        return out

    def votes(self, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The votes for both classes of rows with these leaves open."""
        place = ((left & (~left + np.uint64(1))) * DE_BRUIJN >> np.uint64(58)).view(np.int64)
        total = np.zeros(left.shape[1], np.complex128)
        for t in range(len(place)):
            total += self.looked_up[t].take(place[t])
        return total.real, total.imag


def forest_of(model, n_features: int, spark: SparkSession) -> Forest | None:
    stage = model.stages[-1] if isinstance(model, PipelineModel) else model
    if type(stage).__name__ != "RandomForestClassificationModel" or stage.numFeatures != n_features or stage.numClasses != 2 or stage.isDefined(stage.thresholds):
        return None
    trees, _, _ = _nodes(stage, spark)
    found = [[] for _ in range(n_features)]       # per feature: threshold, tree, leaves left of it
    shares = []
    for t, (_, nodes) in enumerate(sorted(trees.items())):
        leaves: list[tuple[float, float]] = []

        def walk(node) -> int:
            """The leaves below ``node`` as bits."""
            if node["leftChild"] < 0:
                stats = node["impurityStats"]
                total = sum(stats)
                leaves.append(tuple(s / total for s in stats) if total else (0.0, 0.0))
                return 1 << (len(leaves) - 1)
            left = walk(nodes[node["leftChild"]])
            split = node["split"]
            found[split["featureIndex"]].append((split["leftCategoriesOrThreshold"][0] if split["numCategories"] < 0 else None, t, left))
            return left | walk(nodes[node["rightChild"]])

        walk(nodes[0])
        shares.append(leaves)
    if any(len(s) > 64 for s in shares) or any(c is None for f in found for c, _, _ in f):
        return None
    cuts = [np.unique([c for c, _, _ in f]) for f in found]
    masks = []
    for f, at in zip(found, cuts):
        m = np.full((len(shares), len(at) + 1), ~np.uint64(0))
        for c, t, left in f:
            m[t, np.searchsorted(at, c) + 1:] &= np.uint64(~left & 0xFFFFFFFFFFFFFFFF)
        masks.append(m)
    table = np.zeros((len(shares), 64, 2))
    for t, s in enumerate(shares):
        table[t, :len(s)] = s
    return Forest(cuts, masks, table)
