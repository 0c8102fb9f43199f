"""Exact path-dependent Shapley values of decision trees, forests and boosted trees.

A leaf of value v is a product of conditions, one per distinct feature of its path: met or not by a row (o, 1 or 0), and
met by the share z of training rows (product of the shares of children on the path).  Its part of feature j's Shapley value is

    v (o_j - z_j) sum over sets S of the other features of |S|! (m - |S| - 1)! / m! prod_{S} o prod_{not S} z,

where m counts the path's features; the sum over sets is read from the coefficients of prod (z + o t).  As it depends on a row
only through which conditions hold, the formula is worked out once per pattern of conditions, before any row is read: neighbouring leaves share most of
their conditions, so they are put together while their joint patterns are few, and a row takes the sum of a group's leaves from one table.  Leaves
with sets of categories or more patterns than a table holds are worked out per batch, for the patterns that occur.

What is attributed: the probability of class 1 for a tree or a forest, the margin (``rawPrediction[1]``) for boosted trees.  The values
of a row add up to its score less ``base``, the mean of the leaves by training rows.  A missing value goes right at every split, as in Spark.
The model goes to the tasks as a broadcast of its leaves; rows are neither shuffled nor collected.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.session import checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Condition:
    """What a path asks of one feature, and the share of training rows that meet it."""
    feature: int
    share: float = 1.0
    above: float = -np.inf                       # right of these thresholds: not (x <= above),
    upto: float = np.inf                         # left of these: x <= upto
    bounded: list[bool] = field(default_factory=lambda: [False, False])
    sets: list[tuple[frozenset, bool]] = field(default_factory=list)  # categories, and whether x must be one of them

    def met(self, x: np.ndarray) -> np.ndarray:
        ok = np.ones(len(x), bool)
        if self.bounded[0]:
            ok &= ~(x <= self.above)
        if self.bounded[1]:
            ok &= x <= self.upto
        for values, wanted in self.sets:
            ok &= np.isin(x, list(values)) == wanted
        return ok


@dataclass
class Leaf:
    value: float
    conditions: list[Condition]


def _nodes(model, spark: SparkSession) -> tuple[dict, list[float], bool]:
    """Nodes by tree, tree weights, and whether trees are boosted.  A saved model is a table of its nodes."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tree-model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    single = "nodeData" not in data.columns
    rows = data.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData")) if single else data
    trees: dict[int, dict] = {}
    for r in rows.collect():  # the model, whose size does not depend on the data scored
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    weights = [1.0] if single else list(model.treeWeights)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return trees, weights, type(model).__name__.startswith("GBT")


def leaves_of(trees: dict, weights: list[float], boosted: bool) -> list[Leaf]:
    """Every leaf with its conditions merged by feature."""
    out = []
    cover = (lambda n: n["impurityStats"][0]) if boosted else (lambda n: sum(n["impurityStats"]))

    def walk(nodes, node, conditions, weight):
        if node["leftChild"] < 0:
            stats = node["impurityStats"]
            value = node["prediction"] if boosted else stats[1] / sum(stats) if sum(stats) else 0.0
            out.append(Leaf(weight * value, list(conditions.values())))
            return
        split = node["split"]
        f, numbers = split["featureIndex"], split["leftCategoriesOrThreshold"]
        for child, left in ((nodes[node["leftChild"]], True), (nodes[node["rightChild"]], False)):
            had = conditions.get(f, Condition(f))
            now = Condition(f, had.share * cover(child) / cover(node), had.above, had.upto, list(had.bounded), list(had.sets))
            if split["numCategories"] >= 0:
                now.sets.append((frozenset(numbers), left))
            elif left:
                now.upto, now.bounded[1] = min(now.upto, numbers[0]), True
            else:
                now.above, now.bounded[0] = max(now.above, numbers[0]), True
            walk(nodes, child, {**conditions, f: now}, weight)

    for tree, nodes in sorted(trees.items()):
        walk(nodes, nodes[0], {}, weights[tree] if boosted else 1.0 / len(trees))
    return out


def leaf_values(met: np.ndarray, shares: np.ndarray, value: float) -> np.ndarray:
    """Shapley values (patterns x features of the path) of one leaf for rows of 0/1 ``met``."""
    patterns, m = met.shape
    out = np.zeros((patterns, m))
    ways = np.array([factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)])
    for j in range(m):
        terms = np.zeros((patterns, m))
        terms[:, 0] = 1.0
        for i in range(m):
            if i != j:
                moved = terms * met[:, i:i + 1]
                terms *= shares[i]
                terms[:, 1:] += moved[:, :-1]
        out[:, j] = value * (met[:, j] - shares[j]) * (terms @ ways)
    return out


def shapley_values(x: np.ndarray, leaves: list[Leaf]) -> np.ndarray:
    """Values of every row and feature of ``x``."""
    out = np.zeros(x.shape)
    for leaf in leaves:
        if not leaf.conditions or not leaf.value:
            continue
        met = np.column_stack([c.met(x[:, c.feature]) for c in leaf.conditions])
        packed = np.packbits(met, axis=1)
        kinds, place = np.unique(packed, axis=0, return_inverse=True) if packed.shape[1] > 1 else np.unique(packed[:, 0], return_inverse=True)
        bits = np.unpackbits(kinds.reshape(len(kinds), -1), axis=1)[:, :met.shape[1]].astype(np.float64)
        values = leaf_values(bits, np.array([c.share for c in leaf.conditions]), leaf.value)
        out[:, [c.feature for c in leaf.conditions]] += values[place.reshape(-1)]
    return out


# Patterns of a group's table, and rows whose places in all tables are held at a time.
PATTERNS, BLOCK = 256, 1024


@dataclass
class Tables:
    """The Shapley values of groups of leaves by the pattern of their conditions."""
    cuts: list[np.ndarray]       # per feature the thresholds of all leaves, ascending
    steps: list[np.ndarray]      # per feature: (thresholds exceeded) x groups, what it adds to a group's place in ``table``
    table: np.ndarray            # places x features
    rest: list[Leaf]             # leaves in no group

    def values(self, x: np.ndarray) -> np.ndarray:
        """Values of every row and feature of ``x``."""
        out = shapley_values(x, self.rest) if len(x) else np.zeros(x.shape)
        for at in range(0, len(x) if len(self.table) else 0, BLOCK):
            part, total = x[at:at + BLOCK], out[at:at + BLOCK]
            # A missing value exceeds all thresholds: it goes right.
            place = sum(s[np.searchsorted(c, part[:, j])] for j, (c, s) in enumerate(zip(self.cuts, self.steps)))
            for of in np.ascontiguousarray(place.T):
                total += self.table.take(of, axis=0)
        return out


def tables_of(leaves: list[Leaf], n_features: int, patterns: int = PATTERNS) -> Tables:
    usable = [leaf for leaf in leaves if leaf.conditions and leaf.value and not any(c.sets for c in leaf.conditions) and 2 ** len(leaf.conditions) <= patterns]
    held = {id(leaf) for leaf in usable}
    rest = [leaf for leaf in leaves if id(leaf) not in held]
    cuts = [np.unique([t for leaf in usable for c in leaf.conditions if c.feature == j for t, b in zip((c.above, c.upto), c.bounded) if b]) for j in range(n_features)]

    def met(c: Condition) -> np.ndarray:
        """By the number of thresholds exceeded."""
        n = np.arange(len(cuts[c.feature]) + 1)
        ok = np.ones(len(n), bool)
        if c.bounded[0]:
            ok &= n > np.searchsorted(cuts[c.feature], c.above)
        if c.bounded[1]:
            ok &= n <= np.searchsorted(cuts[c.feature], c.upto)
        return ok

    # A group: its leaves, and per feature the kind of each place, that is which of the group's conditions hold there.
    groups: list[tuple[list[Leaf], dict[int, np.ndarray]]] = []
    for leaf in usable:
        own = {c.feature: met(c) for c in leaf.conditions}
        if groups:
            known = groups[-1][1]
            both = known | {j: np.unique(2 * known[j] + m if j in known else m, return_inverse=True)[1] for j, m in own.items()}
            if np.prod([int(k.max()) + 1 for k in both.values()], dtype=float) <= patterns:
                groups[-1] = (groups[-1][0] + [leaf], both)
                continue
        groups.append(([leaf], {j: np.unique(m, return_inverse=True)[1] for j, m in own.items()}))
    steps = [np.zeros((len(c) + 1, len(groups)), np.int64) for c in cuts]
    table, begin = [], 0
    for g, (some, kinds) in enumerate(groups):
        feats = sorted(kinds)
        shape = [int(kinds[j].max()) + 1 for j in feats]
        stride = np.cumprod([1, *shape[:0:-1]])[::-1]
        for j, by in zip(feats, stride):
            steps[j][:, g] = kinds[j] * by
        steps[feats[0]][:, g] += begin
        place = dict(zip(feats, np.unravel_index(np.arange(int(np.prod(shape))), shape)))
        part = np.zeros((len(place[feats[0]]), n_features))
        for leaf in some:
            of = [c.feature for c in leaf.conditions]
            # A kind of places meets a condition or not as any of its places does.
            bits = np.column_stack([met(c)[np.unique(kinds[c.feature], return_index=True)[1]][place[c.feature]] for c in leaf.conditions]).astype(np.float64)
            part[:, of] += leaf_values(bits, np.array([c.share for c in leaf.conditions]), leaf.value)
        table.append(part)
        begin += len(part)
    return Tables(cuts, steps, np.concatenate(table) if table else np.zeros((0, n_features)), rest)


def base_value(leaves: list[Leaf]) -> float:
    return float(sum(leaf.value * np.prod([c.share for c in leaf.conditions]) for leaf in leaves))


def tree_attributions(model, df: DataFrame, features: Sequence[str], key: Sequence[str] = ("id",)) -> tuple[DataFrame, float]:
    """``(key..., feature, value, attribution)`` for every row and feature, and the base value.

    ``model`` is a decision tree, random forest or boosted-tree classifier of two classes, or a pipeline that ends in one and assembles ``features``
    in their order."""
    key, features = list(key), list(features)
    spark = df.sparkSession
    stage = model.stages[-1] if isinstance(model, PipelineModel) else model
    leaves = leaves_of(*_nodes(stage, spark))
    shipped = spark.sparkContext.broadcast(tables_of(leaves, len(features)))

    def explain(batches):
        known = shipped.value
        for b in batches:
            x = np.column_stack([np.asarray(b[f"_ck_x{i}"].fill_null(float("nan")), np.float64) for i in range(len(features))]) if b.num_rows else np.zeros((0, len(features)))
            values = known.values(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(features)).cast(pa.list_(pa.float64()))],
                                             names=[*b.schema.names, "_ck_a"])

    rows = df.select(*key, *[F.col(f).cast("double").alias(f"_ck_x{i}") for i, f in enumerate(features)])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", _ck_a array<double>"
    done = rows.mapInArrow(explain, schema)
    long = done.select(*key, F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_ck_x{i}").alias("value"), F.col("_ck_a")[i].alias("attribution"))
                                                for i, f in enumerate(features)])).alias("_ck_r"))
    return long.select(*key, "_ck_r.*"), base_value(leaves)
