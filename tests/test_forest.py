import random
from collections import Counter

import numpy as np
import pytest

from basketry.operators import forest as FO

FEATURES = ("a", "b", "c")
SCHEMA = "k bigint, label int, a double, b double, c double"


def rows(seed=0, n=300):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        label = rng.randrange(3)
        a = float(rng.gauss(3 * label, 1)) if rng.random() < 0.95 else None
        out.append((k * 17 + 2**33, label, a, float(rng.randrange(4)), 1.0 if label == 2 else rng.random()))
    return out + [(None, 1, 0.0, 0.0, 0.0), (5, None, 1.0, 1.0, 1.0)]


def plain_forest(data, trees, depth, bins, seed, sample):
    """The same forest a row at a time: ``(nodes, thresholds)``."""
    known = [r for r in data if r[0] is not None]
    chosen = sorted(known, key=lambda r: (FO.mixed(r[0], FO.SAMPLE_TREE, seed), r[0]))[:sample]
    cuts = []
    for f in range(3):
        v = sorted(r[2 + f] for r in chosen if r[2 + f] is not None)
        cuts.append(sorted({v[-(-j * len(v) // bins) - 1] for j in range(1, bins) if -(-j * len(v) // bins) >= 1}))
    binned = {r[0]: [0 if x is None else sum(c < x for c in cuts[f]) for f, x in enumerate(r[2:])] for r in known}
    nodes = {}
    for t in range(trees):
        weight = {r[0]: sum(FO.mixed(r[0], t, seed) >= p for p in FO.POISSON) for r in known}
        level = {1: [r for r in known if r[1] is not None and weight[r[0]]]}
        for d in range(depth + 1):
            below = {}
            for node, members in level.items():
                count = Counter()
                for r in members:
                    count[r[1]] += weight[r[0]]
                nodes[t, node] = [None, None, min(count, key=lambda c: (-count[c], c))]
                if d == depth:
                    continue
                n = sum(count.values())
                best = (sum(x * x for x in count.values()) / n, None, None)
                for f in FO.chosen_features(t, node, 3, seed):
                    for b in range(bins):
                        left = Counter()
                        for r in members:
                            if binned[r[0]][f] <= b:
                                left[r[1]] += weight[r[0]]
                        right = count - left
                        if left and right:
                            score = sum(x * x for x in left.values()) / sum(left.values()) + \
                                sum(x * x for x in right.values()) / sum(right.values())
                            if score > best[0]:
                                best = (score, f, b)
                if best[1] is not None:
                    _, f, b = best
                    nodes[t, node][:2] = FEATURES[f], cuts[f][b]
                    below[2 * node] = [r for r in members if binned[r[0]][f] <= b]
                    below[2 * node + 1] = [r for r in members if binned[r[0]][f] > b]
            level = below
    return {k: tuple(v) for k, v in nodes.items()}


def plain_prediction(nodes, trees, values):
    votes = Counter()
    for t in range(trees):
        node = 1
        while nodes[t, node][0] is not None:
            x = values[FEATURES.index(nodes[t, node][0])]
            node = 2 * node + (x is not None and x > nodes[t, node][1])
        votes[nodes[t, node][2]] += 1
    return min(votes, key=lambda c: (-votes[c], c))


@pytest.mark.parametrize("parts, sample", [(1, 10_000), (5, 40)])
def test_equals_a_plain_forest_on_any_partitions(spark, parts, sample):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    forest = FO.fit_forest(df, "k", "label", FEATURES, 3, trees=6, depth=3, bins=8, seed=42, sample=sample)
    want = plain_forest(data, 6, 3, 8, 42, sample)
    got = {(r.tree, r.node): (r.feature, r.threshold, r.majority) for r in FO.node_table(spark, forest).collect()}
    assert got == want
    new = rows(1, 100)
    pred = FO.predict_forest(spark.createDataFrame(new, SCHEMA).withColumnRenamed("label", "x.y"), forest)
    assert pred.columns == ["k", "x.y", "a", "b", "c", "prediction"]
    assert Counter((r.k, r.prediction) for r in pred.collect()) == Counter((r[0], plain_prediction(want, 6, r[2:])) for r in new)


def test_learns(spark):
    df = spark.createDataFrame(rows(2, 600), SCHEMA)
    forest = FO.fit_forest(df, "k", "label", FEATURES, 3, trees=20, depth=4)
    new = FO.predict_forest(spark.createDataFrame(rows(3, 300)[:300], SCHEMA), forest).collect()
    assert sum(r.label == r.prediction for r in new) > 0.85 * len(new)


def test_without_rows_and_with_constant_features(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    forest = FO.fit_forest(df.where("false"), "k", "label", FEATURES, 3, trees=3, depth=2)
    assert {r.prediction for r in FO.predict_forest(df, forest).collect()} == {0}
    same = spark.createDataFrame([(i, i % 2, 1.0, 2.0, None) for i in range(50)], SCHEMA)
    forest = FO.fit_forest(same, "k", "label", FEATURES, 2, trees=3, depth=2)
    assert FO.node_table(spark, forest).count() == 3


def test_bags_are_poisson():
    w = np.searchsorted(FO.POISSON, FO.mixed(np.arange(200_000)[:, None], np.arange(3)[None, :], 1), "right")
    for t in range(3):
        share = np.bincount(w[:, t], minlength=4)[:4] / len(w)
        assert np.allclose(share, [0.3679, 0.3679, 0.1839, 0.0613], atol=0.01)
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.02
