"""The order-aware, factor and epoch models against plain versions of them."""
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import context as X
from basketry.operators import epochs as E
from basketry.operators import factors as FA
from basketry.operators.sequence import sequence_items

SCHEMA = "o bigint, at int, x int"


def baskets(seed=0, n=60, v=7, hot=0):
    rng = random.Random(seed)
    out = {}
    for o in range(n):
        items = [rng.randrange(v)]
        for _ in range(rng.randint(0, 8)):
            items.append((items[-1] + rng.choice((1, 1, 1, 2))) % v)
        out[o] = items
    if hot:
        out[10_000] = [rng.randrange(v) for _ in range(hot)]
    return out


def sequence(spark, found, parts=4):
    rows = [(o, i, x) for o, items in found.items() for i, x in enumerate(items)]
    random.Random(1).shuffle(rows)
    return sequence_items(spark.createDataFrame(rows, SCHEMA).repartition(parts), "o", ["at"], "x", keep_sort_cols=False)


def brute_counts(found, depth):
    counts = Counter()
    for items in found.values():
        for i, x in enumerate(items):
            for n in range(min(i, depth) + 1):
                counts[tuple(items[i - n:i]), x] += 1
    return counts


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_context_counts_and_predictions(spark, depth):
    train, test = baskets(1, hot=400), baskets(2, n=40)
    test[77], test[78] = [100, 101, 102], [5]
    counts = X.next_item_contexts(sequence(spark, train), "o", depth)
    want = brute_counts(train, depth)
    assert {(tuple(r.context), r.item): r.n for r in counts.collect()} == want
    by = defaultdict(list)
    for (context, x), n in want.items():
        by[context].append((-n, x))
    tree = {tuple(r.context): (r.total, r.best) for r in X.context_tree(counts).collect()}
    assert tree == {c: (-sum(n for n, _ in xs), min(xs)[1]) for c, xs in by.items()}
    top = Counter((tuple(r.context), r.rank, r.item) for r in X.context_topk(counts, 2).collect())
    assert top == Counter((c, i + 1, x) for c, xs in by.items() for i, (_, x) in enumerate(sorted(xs)[:2]))
    hidden = X.hidden_targets(X.item_windows(sequence(spark, test), "o", max(depth, 1)))
    found = X.context_predictions(X.context_tree(counts), hidden)
    hits, used = Counter(), Counter()
    for items in test.values():
        if len(items) > 1:
            n = max(n for n in range(min(len(items) - 1, max(depth, 1)) + 1) if tuple(items[len(items) - 1 - n:-1]) in by)
            used[n] += 1
            hits[n] += min(by[tuple(items[len(items) - 1 - n:-1])])[1] == items[-1]
    got = {r.context_len: (r.n_baskets, r.n_hits) for r in X.context_hit_rate(found).collect()}
    assert got.pop(None) == (sum(used.values()), sum(hits.values()))
    assert got == {n: (used[n], hits[n]) for n in used}


def test_context_of_one_order_is_spread(spark):
    """An order with a third of all items: its windows are grouped by position."""
    seq = sequence(spark, baskets(3, n=200, hot=500), parts=8)
    windows = X.item_windows(seq, "o", 3).repartition(16, "o", "pos")
    sizes = [r["count"] for r in windows.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * sum(sizes) / 16


def test_no_training_rows(spark):
    none = sequence(spark, {0: [1]}).where("false")
    tree = X.context_tree(X.context_counts(X.item_windows(none, "o", 2)))
    hidden = X.hidden_targets(X.item_windows(sequence(spark, {1: [2, 3]}), "o", 2))
    (row,) = X.context_predictions(tree, hidden).collect()
    assert row.context_len is None and row.predicted_item is None and row.n == 1


def brute_epochs(found, split, epochs, batches, rate):
    """The same model in floating point, a row at a time."""
    from basketry.functions.keys import KEY_MULTIPLIER, KEY_PRIME
    items = sorted({x for xs in found.values() for x in xs})
    v = len(items)
    rows = []
    for o, xs in found.items():
        if len(xs) > 1:
            x = np.zeros(2 * v + 1)
            for y in xs[:-1]:
                x[items.index(y)] += 1 / (len(xs) - 1)
            x[v + items.index(xs[-2])] = x[2 * v] = 1
            batch = (((o % KEY_PRIME) * KEY_MULTIPLIER + 11) % KEY_PRIME) % batches
            rows.append((split(o), batch, x, items.index(xs[-1])))
    w, m, s, step, out = np.zeros((2 * v + 1, v)), 0, 0, 0, []
    for epoch in range(epochs):
        losses = []
        for b in range(batches):
            grads = []
            for test, batch, x, label in rows:
                if not test and batch == b:
                    z = x @ w
                    p = np.exp(z - z.max())
                    p /= p.sum()
                    losses.append(-np.log(p[label]))
                    p[label] -= 1
                    grads.append(np.outer(x, p))
            if grads:
                g = np.mean(grads, axis=0)
                step += 1
                m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
                w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        tests = [(x, label) for test, _, x, label in rows if test]
        out.append((epoch + 1, np.mean(losses), sum(int((x @ w).argmax() == label) for x, label in tests), len(tests)))
    return out


def split_sequence(spark, found, parts=4):
    return sequence(spark, found, parts).withColumn("split", F.when(F.col("o") % 5 == 0, "test").otherwise("train"))


def test_epochs_equal_a_plain_version(spark):
    found = baskets(4, n=80, hot=300)
    got = E.train_epochs(split_sequence(spark, found), "o", epochs=3, batches=2)[2]
    want = brute_epochs(found, lambda o: o % 5 == 0, 3, 2, 0.1)
    for g, w in zip(got, want, strict=True):
        assert g[0] == w[0] and g[3] == w[3] and abs(g[2] - w[2]) <= 1 and g[1] == pytest.approx(w[1], rel=2e-3)
    assert got[-1][1] < got[0][1]


def test_epochs_do_not_depend_on_partitions(spark):
    found = baskets(5, n=70, hot=200)
    one = E.train_epochs(split_sequence(spark, found, 1), "o", epochs=2, batches=2)
    many = E.train_epochs(split_sequence(spark, found, 9), "o", epochs=2, batches=2)
    assert one[2] == many[2] and np.array_equal(one[0], many[0])


def test_epochs_without_rows_and_with_too_many_items(spark):
    found = split_sequence(spark, {1: [1], 2: [2]})
    assert E.train_epochs(found, "o", epochs=1, batches=2)[2] == [(1, None, 0, 0)]
    with pytest.raises(ValueError):
        E.item_table(found, max_items=1)


def test_factors_predict_better_than_chance_and_alike_on_any_layout(spark):
    rng = random.Random(6)
    found = {}
    for o in range(400):                       # two kinds of baskets without common items
        kind = rng.randrange(2) * 10
        found[o] = [kind + rng.randrange(10) for _ in range(rng.randint(3, 8))]
    got = [FA.factor_hit_rates(split_sequence(spark, found, p), "o", cut_offs=(1, 10), rank=4, sweeps=5).collect() for p in (2, 7)]
    assert sorted(map(tuple, got[0])) == sorted(map(tuple, got[1]))
    rates = {r.k: r.accuracy for r in got[0]}
    assert rates[10] > 0.9 and rates[1] > 0.05


def test_sweeps_by_sums_give_the_factors_of_als(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(o, (o % 3 * 4 + rng.randrange(6)) % 12) for o in range(300) for _ in range(rng.randint(1, 9))]
    rows += [(None, 1), (7, None), (1000, 3)]
    train = spark.createDataFrame(rows, "o bigint, item int").repartition(5)
    asked = []

    class Als(FA.ALS):
        def __init__(self, **options):
            asked.append(options["maxIter"])
            super().__init__(**options)

    monkeypatch.setattr(FA, "ALS", Als)
    monkeypatch.setattr(FA, "SLICE", 64)
    got = FA.fit_item_factors(train, "o", list(range(13)), rank=4, sweeps=6)
    assert asked == [1]                        # the orders' factors are shuffled in one sweep only
    monkeypatch.setattr(FA, "FEW_ITEMS", 0)
    want = FA.fit_item_factors(train, "o", list(range(13)), rank=4, sweeps=6)
    assert asked == [1, 6] and not got[12].any()
    assert got == pytest.approx(want, rel=1e-4, abs=1e-5)


def test_history_factors_solve_the_sweep(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(size=(6, 3))
    p, n = np.array([1, 4]), np.array([2.0, 1.0])
    got = FA.history_factors([p], [n], y, y.T @ y, 0.1, 4.0)[0]
    c = np.ones(6)
    c[p] += 4.0 * n
    pref = np.isin(np.arange(6), p).astype(float)
    want = np.linalg.solve(y.T @ np.diag(c) @ y + 0.2 * np.eye(3), y.T @ (c * pref))
    assert got == pytest.approx(want)


def test_orders_are_numbered(spark):
    df = spark.createDataFrame([(x,) for x in (7, 3, 3, 2**40, -1)], "o bigint").repartition(3)
    assert sorted(map(tuple, FA.number_orders(df, "o").collect())) == [(-1, 0), (3, 1), (7, 2), (2**40, 3)]
    with pytest.raises(ValueError):
        FA.number_orders(df, "o", limit=2)


def test_too_many_items_or_centroids_are_errors(spark):
    from basketry.operators import cluster as K
    from basketry.operators import nextitem as N
    seq = sequence(spark, {1: [1, 2, 3]})
    with pytest.raises(ValueError):
        N.item_index(seq, max_items=2)
    assert len(N.item_index(seq, max_items=3).labels) == 3
    points = spark.createDataFrame([(1, [0.0])], "id int, v array<double>")
    with pytest.raises(ValueError):
        K.nearest_centroid_expr(points, "v", [(i, [float(i)]) for i in range(K.MAX_LOCAL + 1)])
