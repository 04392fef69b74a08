import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from basketry.operators import gridkmeans as G


def plain(points, k, steps):
    """``{vector: weight}`` -> centres, in whole numbers."""
    xs = {tuple(round(round(a, 6) * G.SCALE) for a in v): 0 for v, _ in points}
    for v, w in points:
        xs[tuple(round(round(a, 6) * G.SCALE) for a in v)] += w
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    centres = [min(xs, key=lambda v: (-xs[v], v))]
    while len(centres) < k:
        best = min(xs, key=lambda v: (-float(xs[v]) * float(min(d2(v, c) for c in centres)), v))
        if not min(d2(best, c) for c in centres):
            break
        centres.append(best)
    for _ in range(steps):
        groups = [[] for _ in centres]
        for v, w in xs.items():
            groups[min(range(len(centres)), key=lambda i: (d2(v, centres[i]), i))].append((v, w))
        new = []
        for c, g in zip(centres, groups):
            n = sum(w for _, w in g)
            new.append(tuple((2 * sum(w * v[i] for v, w in g) + n) // (2 * n) for i in range(len(c))) if n else c)
        if new == centres:
            break
        centres = new
    return [list(c) for c in centres]


def points(seed=0, n=120):
    rng = random.Random(seed)
    out = [([rng.choice((0.0, 0.3, 0.6)) + rng.random() / 10 for _ in range(3)], rng.randint(1, 4)) for _ in range(n)]
    return out + [([0.25, 0.25, 0.25], 1)] * (n // 2)               # a hot point


def frame(spark, rows, parts):
    return spark.createDataFrame([(Vectors.dense(v), w) for v, w in rows], ["features", "w"]).repartition(parts)


@pytest.mark.parametrize("k, steps", [(1, 3), (5, 1), (8, 20)])
def test_equals_a_plain_version_on_any_partitions(spark, k, steps):
    rows = points()
    want = plain(rows, k, steps)
    for parts in (1, 6):
        df = frame(spark, rows, parts)
        assert G.fit_centres(G.grid_points(df, weight_col="w"), k, steps) == want
    got = G.assign(df, want).withColumn("v", G.on_grid("features")).collect()
    for r in got:
        d = ((np.array(want) - np.array(r.v)) ** 2).sum(axis=1)
        assert r.cluster == d.argmin()


def test_fewer_points_than_clusters_and_none(spark):
    rows = [([0.5, 0.5], 1), ([0.5, 0.5], 2), ([0.0, 1.0], 1)]
    df = frame(spark, rows, 2)
    assert len(G.fit_centres(G.grid_points(df), 5)) == 2
    none = df.where("false")
    assert G.fit_centres(G.grid_points(none), 5) == []
    assert [r.cluster for r in G.assign(df, []).collect()] == [None] * 3
    with pytest.raises(ValueError):
        G.fit_centres(G.grid_points(df), 0)


def test_seeds_come_from_the_heaviest_points(spark):
    rows = [([i / 100, 0.0], 1 + i % 7) for i in range(60)]
    pts = G.grid_points(frame(spark, rows, 3), weight_col="w")
    heavy = sorted(rows, key=lambda r: (-r[1], r[0]))[:10]
    got = G.seed_centres(pts, 4, candidates=10)
    assert got == plain(heavy, 4, 0) and len(got) == 4


def test_lloyd_steps_never_raise_the_cost(spark):
    pts = G.grid_points(frame(spark, points(3), 3), weight_col="w")
    from basketry.operators.cluster import nearest_centroid
    cost = lambda cs: nearest_centroid(pts, "v", list(enumerate(cs))).agg(F.sum(F.col("w") * F.col("distance"))).first()[0]
    centres, before = G.seed_centres(pts, 6), None
    for _ in range(4):
        now = cost(centres)
        assert before is None or now <= before * (1 + 1e-6)
        centres, before = G.lloyd_step(pts, centres), now
