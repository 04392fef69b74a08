import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import topk as K
from basketry.llm import vectorgraph as G

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def odd_vectors():
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], i % 3) for i in range(60)]
    rows += [(100 + i, [x + rng.gauss(0, .02) for x in rows[i % 5][1]], None) for i in range(40)]
    rows += [(200, rows[0][1], 1), (201, rows[0][1], 1), (201, rows[0][1], 1), (202, [2 * x for x in rows[1][1]], 1)]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 8, 1), (303, [NAN] + [1.0] * 7, 1), (304, [INF] + [1.0] * 7, 1),
             (305, [None] + [1.0] * 7, 1), (306, [1.0, 2.0], None), (None, rows[2][1], 1), (None, None, None), (3, rows[4][1], 1)]
    return rows


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def padded(v, n=8):
    return [float(np.float32(x)) for x in v] + [0.0] * (n - len(v))


def brute_links(rows, threshold=0.95):
    use = [i for i, (k, v, _) in enumerate(rows) if k is not None and good(v) and any(v)]
    x = np.array([padded(rows[i][1]) for i in use])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= threshold
    links, low = [0] * len(rows), {i: rows[i][0] for i in range(len(rows))}
    for a, i in enumerate(use):
        links[i] = int(close[a].sum()) - 1
    changed = True
    while changed:
        changed = False
        for a, i in enumerate(use):
            m = min(low[use[b]] for b in np.nonzero(close[a])[0])
            changed |= m < low[i]
            low[i] = m
    return [(k, links[i], low[i], k is None or k == low[i]) for i, (k, _, _) in enumerate(rows)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("block", [2048, 16])
def test_links_equal_brute_force(spark, block):
    rows = odd_vectors()
    got = G.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block).collect()
    assert order([tuple(r)[:4] for r in got]) == order(brute_links(rows))
    assert all(r.exact_links in (None, r.n_links) for r in got) and any(r.exact_links for r in got)


def test_a_hot_group_over_many_blocks(spark):
    rng = np.random.default_rng(2)
    one = rng.normal(size=32)
    x = np.concatenate([one + rng.normal(0, .12, (300, 32)), rng.normal(size=(300, 32)), np.repeat(one[None], 50, axis=0)])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in G.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), block=64).collect()}
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    true = (y @ y.T >= 0.95).sum(axis=1) - 1
    found = np.array([got[i].n_links for i in range(len(x))])
    assert found.sum() >= 0.9 * true.sum() and (found <= true).all()
    assert len({got[i].component for i in range(300) if true[i]}) == 1


def test_a_dense_group_of_different_vectors_is_linked_whole(spark, monkeypatch):
    """A third of all rows in one group, where no two nodes share their shards."""
    rng = np.random.default_rng(5)
    one = rng.normal(size=64)
    x = np.concatenate([one + rng.normal(0, .1, (400, 64)), rng.normal(size=(800, 64))])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    true = (y @ y.T >= 0.95).sum(axis=1) - 1
    assert true[:400].min() > 300
    got = {r.vec_id: r for r in G.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), block=16, tries=1).collect()}
    found = np.array([got[i].n_links for i in range(len(x))])
    assert found.sum() >= 0.97 * true.sum() and (found <= true).all()
    monkeypatch.setattr(G, "_all_links", lambda nodes, *rest: nodes.sparkSession.createDataFrame([], G.LINKS))
    with pytest.raises(RuntimeError):
        G.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), block=16, tries=1)


def test_the_audit_counts_linked_nodes(spark):
    """A heavy or large group does not hide the misses of the others, and the
    sample grows until it has linked nodes."""
    exact = spark.createDataFrame([(1, 90_000, 300), (2, 2, 2), (3, 1, 1), (4, 0, 0)], "node bigint, exact bigint, others bigint")
    found = spark.createDataFrame([(1, 90_000, 300)], "node bigint, links bigint, pairs bigint")
    assert G.audited(exact, found) == (300 / 303, 1 / 3)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 32))
    x[590:] = x[580:590] + rng.normal(0, .01, (10, 32))
    nodes = spark.createDataFrame([(i, i, 1, v.tolist()) for i, v in enumerate(x)], "node bigint, node_hash bigint, weight bigint, v array<double>")
    got = {r.node: r.others for r in G._exact_links(nodes, 600, 32, 0.95).collect()}
    assert len(got) == 600 and sum(got.values()) == 20


def test_robust_pruning_drops_what_a_kept_edge_covers():
    x = G.unit_rows(np.array([[1, 0], [1, .1], [1, .2], [0, 1.0]]))
    edges = G.robust_prune(x, np.array([0]), np.array([[1, 2, 3]]), 3)
    assert edges[0].tolist() == [1, 3, -1] or edges[0].tolist() == [1, -1, -1]


def test_empty_and_unusable(spark):
    assert G.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    got = G.near_duplicates(spark.createDataFrame([(1, None, 0), (2, [0.0], 0), (3, [1.0], 0)], SCHEMA)).collect()
    assert sorted(tuple(r)[:4] for r in got) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


# ---------------------------------------------------------------- top k

def brute_top(rows, is_query, k):
    use = sorted({(key, tuple(math.floor(256 * x) for x in padded(v))) for key, v, _ in rows if key is not None and good(v)})
    out = []
    for key, q in use:
        if is_query(key):
            scores = sorted({(-sum(a * b for a, b in zip(q, v)), other) for other, v in use if other != key})
            out += [(key, i + 1, other, -s) for i, (s, other) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("block,query_block", [(8192, 1024), (7, 2)])
def test_top_k_equals_brute_force(spark, block, query_block):
    rows = [r for r in odd_vectors() if r[:1] != (3,)]           # ids stand for one vector each
    got = K.top_k(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 20 == 0, 5, block=block, query_block=query_block)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, lambda i: i % 20 == 0, 5)


def test_ties_large_values_and_few_rows(spark):
    ties = [(i, [1.0, -2.0, 0.5], 0) for i in range(30)]
    got = K.top_k(spark.createDataFrame(ties, SCHEMA), F.col("vec_id") % 50 == 0, 5).collect()
    assert sorted(tuple(r) for r in got) == brute_top(ties, lambda i: i % 50 == 0, 5)
    large = [(0, [1e30, 1.0], 0), (1, [1e30, 0.0], 0), (2, [-1e30, 0.0], 0), (3, [1.0, 1.0], 0)]
    got = {r["rank"]: (r.vec_id, r.score) for r in K.top_k(spark.createDataFrame(large, SCHEMA), F.col("vec_id") == 0, 5).collect()}
    assert got == {1: (1, K.LONG_MAX), 2: (3, K.LONG_MAX), 3: (2, K.LONG_MIN)} or got[1] == (1, K.LONG_MAX) and got[3] == (2, K.LONG_MIN)
    assert K.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") == 0, 5).count() == 0
    assert K.top_k(spark.createDataFrame(large[:1], SCHEMA), F.col("vec_id") == 0, 5).count() == 0


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(0)
    rows = np.floor(rng.normal(0, 40, (3000, 64)))
    queries = rows[:20]
    got = K.best_k(rows, np.arange(3000), queries, np.arange(20), 5)
    for q in range(20):
        scores = rows @ queries[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:5]
        assert got[5 * q:5 * q + 5] == [(q, int(i), int(scores[i])) for i in best]
