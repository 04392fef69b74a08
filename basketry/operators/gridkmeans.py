"""KMeans that does not depend on partitions, cores or the order of rows.

Points are put on a grid of ``SCALE`` steps a unit and equal ones are one
weighted point, so sums of coordinates and squared distances are whole numbers:
exact in any order.  Nothing is drawn, so no layout has to be fixed first.

Seeding is farthest-first by weight over the ``CANDIDATES`` heaviest points, which
come to the driver: the heaviest one, then again and again the one with the largest
weight times squared distance to its nearest centre.  Lloyd steps over all points
follow as plain aggregates: the nearest centre of each point (ties: the
earlier centre), then weighted sums a centre; a centre without points stays.  The
driver holds the k centres only.  Steps end when no centre moves.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.cluster import MAX_LOCAL, nearest_centroid
from basketry.session import cut_lineage

SCALE = 10**6
CANDIDATES = 4096               # points that seeding chooses from


def on_grid(vector_col: str) -> Column:
    """A Spark ML vector as whole numbers of 1 / ``SCALE``."""
    return F.transform(vector_to_array(vector_col), lambda x: F.round(F.round(x, 6) * SCALE).cast("bigint"))


def grid_points(points: DataFrame, vector_col: str = "features", weight_col: str | None = None) -> DataFrame:
    """``(v, w)``: the different points with their summed weights, written."""
    weight = F.col(weight_col).cast("bigint") if weight_col else F.lit(1).cast("bigint")
    rows = points.select(on_grid(vector_col).alias("v"), weight.alias("w"))
    return cut_lineage(rows.groupBy("v").agg(F.sum("w").alias("w")), "grid-points")


def seed_centres(points: DataFrame, k: int, candidates: int = CANDIDATES) -> list[list[int]]:
    """Up to ``k`` different points of ``grid_points``, fewer if there are not as many
    among the ``candidates`` heaviest ones."""
    rows = points.orderBy(F.desc("w"), F.asc("v")).limit(max(candidates, k)).collect()
    if not rows:
        return []
    centres = [list(rows[0]["v"])]
    rows = sorted(rows, key=lambda r: r["v"])                   # the first of equal scores is the smaller point
    v = np.array([r["v"] for r in rows], np.int64).reshape(len(rows), -1)
    w = np.array([r["w"] for r in rows], np.float64)
    near = np.full(len(rows), np.iinfo(np.int64).max)
    while len(centres) < k:
        near = np.minimum(near, ((v - np.array(centres[-1], np.int64)) ** 2).sum(axis=1))
        best = int((w * near).argmax())
        if near[best] == 0:
            break
        centres.append(v[best].tolist())
    return centres


def lloyd_step(points: DataFrame, centres: list[list[int]]) -> list[list[int]]:
    """The weighted means of the points nearest to each centre, to the nearest grid
    place (halves up)."""
    near = nearest_centroid(points, "v", list(enumerate(centres)), out_id="c")
    weight = F.col("w").cast("decimal(38,0)")
    sums = [F.sum(weight * F.col("v")[i]).cast("decimal(38,0)").alias(f"s{i}") for i in range(len(centres[0]))]
    out = [list(c) for c in centres]
    for r in near.groupBy("c").agg(F.sum(weight).alias("n"), *sums).collect():        # a row a centre
        n = int(r["n"])
        out[r["c"]] = [(2 * int(r[f"s{i}"]) + n) // (2 * n) for i in range(len(centres[0]))]
    return out


def fit_centres(points: DataFrame, k: int, max_iter: int = 20) -> list[list[int]]:
    """The centres of ``grid_points`` after at most ``max_iter`` Lloyd steps."""
    if not 0 < k <= MAX_LOCAL:
        raise ValueError(f"k is 1 to {MAX_LOCAL}")
    centres = seed_centres(points, k)
    for _ in range(max_iter if centres else 0):
        moved = lloyd_step(points, centres)
        if moved == centres:
            break
        centres = moved
    return centres


def assign(points: DataFrame, centres: list[list[int]], vector_col: str = "features", out: str = "cluster") -> DataFrame:
    """``points`` with the number of the nearest centre (null without centres)."""
    near = nearest_centroid(points.withColumn("_grid", on_grid(vector_col)), "_grid", list(enumerate(centres)),
                            out_id=out, out_dist="_distance")
    return near.drop("_grid", "_distance")
