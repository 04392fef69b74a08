"""A random forest whose trees are a table of nodes.

Everything that Spark ML's forest draws per partition follows from keys here, so
the forest is the same on any layout and any number of cores, and plain SQL can
repeat it:

* Bagging: a row's weight in a tree is Poisson(1) by a hash of its key and the tree.
* Split candidates: up to ``bins`` - 1 quantiles of each feature over a sample of
  ``SAMPLE`` rows (those with the smallest hashes; all rows, if there are fewer).
* Growth is by levels.  A pass over the rows routes each through the trees so far
  and counts weights per (tree, node, feature, bin, class); the counts of a task
  are bounded by the forest's shape, not by its rows, and are summed by Spark.  A
  second step, a group per tree, finds the best split of each open node: the
  largest sum of squared class weights over the weight of each side (Gini), ties
  to the smaller feature, then bin.  A node considers the square root of the
  features, chosen by a hash.
* The driver holds the nodes: at most 2 ** (depth + 1) a tree.

A row is predicted by the majority of its trees' leaves (ties: the smaller class).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed parameters of the key hash: a quadratic one modulo a prime, twice.
PRIME = 2**31 - 1
FACTORS = (48271, 69621, 40692, 16807)
SAMPLE = 10_000
POISSON = tuple(int(PRIME * sum(math.exp(-1) / math.factorial(i) for i in range(n + 1))) for n in range(9))
SAMPLE_TREE = 1 << 20           # the "tree" whose hashes choose the sample
SUBSET_TREE = 1 << 21           # added to a tree's number where features are chosen


def mixed(key, tree, seed: int):
    """The hash of whole numbers, below ``PRIME``: for NumPy arrays and columns."""
    h = (key % PRIME * FACTORS[0] + tree * FACTORS[1] + seed) % PRIME
    h = (h * h + h * FACTORS[2] + tree) % PRIME
    return (h * h + h * FACTORS[3] + seed) % PRIME


def mixed_sql(key: str, tree: str, seed: int) -> str:
    h = f"((CAST({key} AS BIGINT) % {PRIME} * {FACTORS[0]} + CAST({tree} AS BIGINT) * {FACTORS[1]} + {seed}) % {PRIME})"
    h = f"(({h} * {h} + {h} * {FACTORS[2]} + ({tree})) % {PRIME})"
    return f"(({h} * {h} + {h} * {FACTORS[3]} + {seed}) % {PRIME})"


class Forest(NamedTuple):
    """``feature`` and ``cut`` of each (tree, node), feature -1 for a leaf, and the
    majority class of each node; node 1 is the root, 2 i and 2 i + 1 the children."""
    features: tuple[str, ...]
    thresholds: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    majority: np.ndarray
    classes: int
    seed: int


def split_thresholds(rows: DataFrame, key: str, features: Sequence[str], bins: int = 32, seed: int = 42,
                     sample: int = SAMPLE) -> list[np.ndarray]:
    """Ascending split values of each feature: those at places ceil(j n / bins) of
    the sample's n sorted values without null."""
    k = F.col(key).cast("bigint")
    h = mixed(F.pmod(k, F.lit(PRIME)), F.lit(SAMPLE_TREE).cast("bigint"), seed)
    some = rows.where(F.col(key).isNotNull()).select(h.alias("_h"), k.alias("_k"), *features).orderBy("_h", "_k").limit(sample)
    table = some.toPandas()                                    # ``sample`` rows at most
    out = []
    for f in features:
        v = np.sort(table[f].dropna().to_numpy(np.float64))
        at = {(j * len(v) + bins - 1) // bins - 1 for j in range(1, bins)}
        out.append(np.unique(v[sorted(i for i in at if i >= 0)]) if len(v) else v)
    return out


def subset_size(n: int) -> int:
    return max(1, math.isqrt(n - 1) + 1) if n > 1 else 1


def chosen_features(tree: int, node: int, n: int, seed: int) -> list[int]:
    """The features that a node considers, ascending."""
    ranked = sorted(range(n), key=lambda f: (mixed(node * n + f, tree + SUBSET_TREE, seed), f))
    return sorted(ranked[:subset_size(n)])


def _binned(batch: pa.RecordBatch, forest: Forest) -> np.ndarray:
    """Bin numbers (rows x features): how many thresholds are below the value; a
    missing value is below all."""
    out = np.empty((batch.num_rows, len(forest.features)), np.int64)
    for j, f in enumerate(forest.features):
        v = batch.column(batch.schema.get_field_index(f)).to_numpy(zero_copy_only=False).astype(np.float64)
        out[:, j] = np.searchsorted(forest.thresholds[j], np.where(np.isnan(v), -np.inf, v), "left")
    return out


def _routed(bins: np.ndarray, forest: Forest, steps: int) -> np.ndarray:
    """The node of each row in each tree after ``steps`` levels."""
    trees = np.arange(len(forest.feature))
    node = np.ones((len(bins), len(trees)), np.int64)
    for _ in range(steps):
        f = forest.feature[trees, node]
        right = np.take_along_axis(bins, np.maximum(f, 0), 1) > forest.cut[trees, node]
        node = np.where(f >= 0, 2 * node + right, node)
    return node


def _slices(batches, rows: int = 4096):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _count_pass(forest: Forest, level: int, open_features: np.ndarray, bins: int):
    """Weights per ``(tree, cell)`` of a task; a cell is (node, feature, bin, class)
    of the level, and ``open_features`` says which a node of a tree considers."""
    trees, n_features, classes = len(forest.feature), len(forest.features), forest.classes
    first = 1 << level
    shape = (trees, first, n_features, bins, classes)

    def run(batches):
        total = np.zeros(math.prod(shape), np.int64)
        for batch in _slices(batches):
            key = batch.column(0).to_numpy()
            label = batch.column(1).to_numpy()
            b = _binned(batch, forest)
            node = _routed(b, forest, level) - first
            weight = np.searchsorted(POISSON, mixed(key[:, None] % PRIME, np.arange(trees)[None, :], forest.seed), "right")
            row, tree = np.nonzero((node >= 0) & (weight > 0))
            place, weight = node[row, tree], weight[row, tree]
            for f in range(n_features):
                on = open_features[tree, place, f]
                cell = np.ravel_multi_index((tree[on], place[on], np.full(on.sum(), f), b[row[on], f], label[row[on]]), shape)
                total += np.bincount(cell, weight[on], len(total)).astype(np.int64)
        held = np.nonzero(total)[0]
        per_tree = len(total) // trees
        yield pa.RecordBatch.from_arrays([pa.array((held // per_tree).astype(np.int32)), pa.array((held % per_tree).astype(np.int64)),
                                          pa.array(total[held])], ["tree", "cell", "n"])

    return run


def _best_splits(shape: tuple, level: int):
    """The best split of each node of a tree, from its counted cells; nodes without
    a split that gains have feature -1."""
    def find(cells: pd.DataFrame) -> pd.DataFrame:
        count = np.zeros(math.prod(shape), np.int64)
        count[cells["cell"].to_numpy()] = cells["n"].to_numpy()
        count = count.reshape(shape)                                    # node, feature, bin, class
        left = count.cumsum(axis=2)
        whole = left[:, :, -1:, :]
        right = whole - left
        nl, nr, n = left.sum(axis=3), right.sum(axis=3), whole.sum(axis=3)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = (left * left).sum(axis=3) / nl + (right * right).sum(axis=3) / nr
            bar = (whole * whole).sum(axis=3) / n
        score = np.where((nl > 0) & (nr > 0) & (score > bar), score, -1.0)
        rows = []
        for node in np.nonzero(n.max(axis=(1, 2)) > 0)[0]:
            f, b = np.unravel_index(int(score[node].argmax()), score[node].shape)      # the first of equals
            own = whole[node, int(n[node, :, 0].argmax()), 0]
            split = score[node, f, b] > 0
            rows.append(((1 << level) + node, f if split else -1, b if split else -1, int(own.argmax()),
                         int(left[node, f, b].argmax()) if split else -1, int(right[node, f, b].argmax()) if split else -1))
        out = pd.DataFrame(rows, columns=["node", "feature", "cut", "majority", "on_left", "on_right"]).astype("int32")
        out.insert(0, "tree", int(cells["tree"].iloc[0]))
        return out.astype("int32")

    return find


SPLITS = "tree int, node int, feature int, cut int, majority int, on_left int, on_right int"


def fit_forest(rows: DataFrame, key: str, label: str, features: Sequence[str], classes: int, trees: int = 100,
               depth: int = 5, bins: int = 32, seed: int = 42, sample: int = SAMPLE) -> Forest:
    """The forest of ``rows`` (written ones: they are read ``depth`` times) with whole
    ``key`` numbers and labels 0 to ``classes`` - 1.  Rows without a key or label
    are not learnt from; without rows every node predicts class 0."""
    nodes = 1 << (depth + 1)
    thresholds = split_thresholds(rows, key, features, bins, seed, sample)
    forest = Forest(tuple(features), thresholds, np.full((trees, nodes), -1), np.full((trees, nodes), -1),
                    np.zeros((trees, nodes), np.int64), max(classes, 1), seed)
    known = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).cast("bigint").alias("_key"), F.col(label).cast("bigint").alias("_label"), *features)
    for level in range(depth):
        first = 1 << level
        wanted = np.zeros((trees, first, len(features)), bool)
        for t in range(trees):
            for node in range(first):
                if level == 0 or forest.feature[t, (first + node) // 2] >= 0:
                    wanted[t, node, chosen_features(t, first + node, len(features), seed)] = True
        counted = known.mapInArrow(_count_pass(forest, level, wanted, bins), "tree int, cell bigint, n bigint")
        summed = counted.groupBy("tree", "cell").agg(F.sum("n").alias("n"))
        shape = (first, len(features), bins, forest.classes)
        grown = False
        for r in summed.groupBy("tree").applyInPandas(_best_splits(shape, level), SPLITS).collect():     # a row a node
            t, node = r["tree"], r["node"]
            forest.majority[t, node] = r["majority"]
            if r["feature"] >= 0:
                grown = True
                forest.feature[t, node], forest.cut[t, node] = r["feature"], r["cut"]
                forest.majority[t, 2 * node], forest.majority[t, 2 * node + 1] = r["on_left"], r["on_right"]
        if not grown:
            break
    return forest


def predict_forest(rows: DataFrame, forest: Forest, out: str = "prediction") -> DataFrame:
    """``rows`` with the class that most trees give (ties: the smaller class)."""
    depth = int(forest.feature.shape[1]).bit_length() - 2
    trees = np.arange(len(forest.feature))
    other = [c for c in rows.columns if c != out]
    kept = F.struct(*[F.col(f"`{c}`") for c in other]).alias("_row")
    table = rows.select(kept, *[F.col(f"`{f}`").cast("double").alias(f) for f in forest.features])

    def run(batches):
        for batch in _slices(batches):
            leaf = _routed(_binned(batch, forest), forest, depth)
            votes = forest.majority[trees, leaf]
            counts = np.stack([(votes == c).sum(axis=1) for c in range(forest.classes)], 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts.argmax(axis=1).astype(np.int32))], ["_row", out])

    schema = T.StructType([table.schema["_row"], T.StructField(out, T.IntegerType())])
    return table.mapInArrow(run, schema).select("_row.*", out)


def node_table(spark: SparkSession, forest: Forest) -> DataFrame:
    """The forest as rows ``(tree, node, feature, threshold, majority)``; feature and
    threshold (go left up to it) are null for leaves."""
    rows = []
    for t in range(len(forest.feature)):
        level = [1]
        while level:
            node = level.pop()
            f = int(forest.feature[t, node])
            at = float(forest.thresholds[f][forest.cut[t, node]]) if f >= 0 else None
            rows.append((t, node, forest.features[f] if f >= 0 else None, at, int(forest.majority[t, node])))
            level += [2 * node, 2 * node + 1] if f >= 0 else []
    return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, majority int")
