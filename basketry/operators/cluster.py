"""Clustering of products by their cleaned names, and nearest-centroid
assignment.

KMeans (Spark ML, k-means||) runs on the DISTINCT cleaned names weighted by
how many products carry each name: the objective is the same as clustering
every product row, the input is much smaller, and each name gets exactly one
cluster (so the later name -> cluster join cannot fan out).  The k-means||
initialisation samples per partition, so the input layout is fixed first
(hash partitioning + sort on the name) to make a seed reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators import tfidf
from basketry.session import cut_lineage, fixed_layout, layout_partitions

NAME = "processed_product_name"
MAX_LOCAL = 4096                # centroids that travel with a task


def name_features(products: DataFrame, n_words: int = 30, max_features: int = 1000) -> tuple[DataFrame, list[str]]:
    """Distinct cleaned names with their product count and a TF-IDF vector
    over the ``n_words`` best-scoring words.  Word scores are computed over
    all product rows (duplicates included)."""
    toks = tfidf.tokenize(products.select("product_id", NAME), NAME)
    corpus = tfidf.corpus(toks, "product_id", "tokens", max_features)
    words = [r["term"] for r in tfidf.top_words(corpus, n_words).orderBy("rank").collect()]
    names = (products.where(F.col(NAME).isNotNull())
                     .groupBy(NAME).agg(F.count(F.lit(1)).cast("double").alias("n_products")))
    named = tfidf.tokenize(names, NAME)
    # IDF over all product rows, as above; a name's vector does not depend on duplicates
    feats = tfidf.tfidf_vectors(named, "tokens", words, idf=corpus.idf(words))
    return feats.drop("tokens"), words


def fit_kmeans(points: DataFrame, k: int = 20, seed: int = 42, weight_col: str | None = None,
               layout_key: str | None = None, layout_parts: int | None = None, max_iter: int = 50) -> KMeansModel:
    """Seeded KMeans.  k-means|| draws per partition, so with ``layout_key`` the
    written points are put into a layout that follows from their number (or is
    given): the same clusters whatever the input's partitions and however many
    cores there are."""
    data = cut_lineage(points, "kmeans-points")
    if layout_key is not None:
        data = fixed_layout(data, layout_key, layout_parts or layout_partitions(data.count()))
    km = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster")
    if weight_col:
        km = km.setWeightCol(weight_col)
    return km.fit(data)


def cluster_names_exact(products: DataFrame, k: int = 20, n_words: int = 30, max_iter: int = 20) -> DataFrame:
    """As ``cluster_names``, by the KMeans of ``gridkmeans``: without draws, the same
    whatever the layout."""
    from basketry.operators import gridkmeans as G
    feats, _ = name_features(products, n_words=n_words)
    feats = cut_lineage(feats, "name-features")
    centres = G.fit_centres(G.grid_points(feats, weight_col="n_products"), k, max_iter)
    return (G.assign(feats, centres)
             .select(NAME, F.col("cluster").cast("int"), (F.col("cluster") + 1).cast("int").alias("virtual_product_id")))


def cluster_names(products: DataFrame, k: int = 20, seed: int = 42, n_words: int = 30) -> DataFrame:
    """``(processed_product_name, cluster, virtual_product_id)`` with
    virtual_product_id = cluster + 1."""
    feats, _ = name_features(products, n_words=n_words)
    model = fit_kmeans(feats, k=k, seed=seed, weight_col="n_products", layout_key=NAME)
    return (model.transform(feats)
                 .select(NAME, F.col("cluster").cast("int"), (F.col("cluster") + 1).cast("int").alias("virtual_product_id")))


def cluster_members(products: DataFrame, mapping: DataFrame) -> DataFrame:
    """Members of each cluster as rows ``(virtual_product_id, name, n_products)``."""
    return (products.join(mapping, NAME, "inner")
                    .groupBy("virtual_product_id", NAME).agg(F.count(F.lit(1)).alias("n_products")))


def label_centroids(points: DataFrame, vec_col: str, label_col: str) -> DataFrame:
    """``(id, v)``: the mean vector of each label (``Summarizer.mean``, partially
    aggregated).  Rows without a label belong to none."""
    return (points.where(F.col(label_col).isNotNull())
                  .select(F.col(label_col).alias("id"), array_to_vector(F.col(vec_col)).alias("_v"))
                  .groupBy("id").agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias("v")))


def nearest_centroid_expr(points: DataFrame, vec_col: str, centroids: DataFrame | Sequence[tuple],
                          out_id: str = "nearest_id", out_dist: str = "distance") -> DataFrame:
    """Nearest centroid as one SQL expression (higher-order functions over a
    literal centroid array).  Same result as ``nearest_centroid``; kept as the
    expression route for cross-checks (its lambdas are interpreted per element)."""
    if isinstance(centroids, DataFrame):
        centroids = [(r["id"], r["v"]) for r in centroids.limit(MAX_LOCAL + 1).collect()]
    if len(centroids) > MAX_LOCAL:
        raise ValueError(f"over {MAX_LOCAL} centroids: nearest_centroid takes any number")
    cents = F.array(*[F.struct(F.lit(cid).alias("id"), F.array(*[F.lit(float(x)) for x in vec]).alias("v"))
                      for cid, vec in centroids])

    def sqdist(c: Column) -> Column:
        diffs = F.zip_with(F.col(vec_col), c["v"], lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
        return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)

    best = F.array_min(F.transform(cents, lambda c: F.struct(sqdist(c).alias("d"), c["id"].alias("id"))))
    return points.withColumn("_best", best).select(
        "*", F.col("_best.id").alias(out_id), F.col("_best.d").alias(out_dist)).drop("_best")


def _block_nearest(x: np.ndarray, cmat: np.ndarray, block_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared distance to and place of the nearest centroid, the earlier on ties."""
    m, dim = x.shape
    step = max(1, block_bytes // max(1, m * dim * 8))
    bd, bj = np.full(m, np.inf), np.full(m, -1, dtype=np.int64)
    for s0 in range(0, len(cmat), step):
        d = ((x[:, None, :] - cmat[None, s0:s0 + step, :]) ** 2).sum(axis=2)
        j = d.argmin(axis=1)
        dj = d[np.arange(m), j]
        better = dj < bd
        bd[better], bj[better] = dj[better], j[better] + s0
    return bd, bj


def nearest_centroid(points: DataFrame, vec_col: str, centroids: DataFrame | Sequence[tuple],
                     out_id: str = "nearest_id", out_dist: str = "distance",
                     block_bytes: int = 64 << 20, max_local: int = MAX_LOCAL) -> DataFrame:
    """Nearest centroid by squared Euclidean distance, ties to the smallest id.

    ``centroids`` are ``(id, v)`` rows, ids of any sortable type; the id column
    of the result has the type of theirs.  Up to ``max_local`` centroids travel
    with the function and each Arrow batch computes its distances to blocks of
    them (``block_bytes`` caps the temporary array).  More stay a table: blocks
    of points meet blocks of centroids, one task a pair, and the best of a
    point's blocks wins.  A NULL vector and an empty list of centroids give
    NULL."""
    spark = points.sparkSession
    if not isinstance(centroids, DataFrame):
        known = [(i, [float(x) for x in v]) for i, v in centroids]
        kind = "int" if all(isinstance(i, int) and abs(i) < 2**31 for i, _ in known) else None
        centroids = spark.createDataFrame(known, f"id {kind}, v array<double>" if kind else ["id", "v"]) if known else \
            spark.createDataFrame([], "id int, v array<double>")
    id_type = centroids.schema["id"].dataType
    few = centroids.limit(max_local + 1).collect()
    if len(few) > max_local:
        return _nearest_in_table(points, vec_col, centroids, out_id, out_dist, block_bytes, max_local)
    ordered = sorted((r["id"], list(r["v"])) for r in few)
    ids, cmat = [c[0] for c in ordered], np.array([c[1] for c in ordered], dtype=np.float64)
    out_type = T.StructType([T.StructField("id", id_type), T.StructField("d", T.DoubleType())])

    @F.pandas_udf(out_type)
    def nearest(vecs: pd.Series) -> pd.DataFrame:
        best_id, best_d = [None] * len(vecs), np.full(len(vecs), np.nan)
        ok = np.nonzero(vecs.notna().to_numpy())[0]
        if len(ok) and len(ids):
            bd, bj = _block_nearest(np.stack(vecs.iloc[ok].to_numpy()).astype(np.float64), cmat, block_bytes)
            best_d[ok] = bd
            for row, j in zip(ok.tolist(), bj.tolist()):
                best_id[row] = ids[j] if j >= 0 else None
        return pd.DataFrame({"id": pd.Series(best_id, dtype=object), "d": pd.Series(best_d).astype(object).where(~np.isnan(best_d), None)})

    return (points.withColumn("_best", nearest(F.col(vec_col)))
                  .select("*", F.col("_best.id").alias(out_id), F.col("_best.d").alias(out_dist)).drop("_best"))


def _nearest_in_table(points: DataFrame, vec_col: str, centroids: DataFrame, out_id: str, out_dist: str,
                      block_bytes: int, block: int) -> DataFrame:
    """``nearest_centroid`` for any number of centroids: a group per pair of a
    block of points and a block of centroids, both of at most about ``block``."""
    id_type = centroids.schema["id"].dataType
    rows = cut_lineage(points.withColumn("_row", F.monotonically_increasing_id()), "nearest-points")
    known = cut_lineage(centroids.select("id", F.col("v").cast("array<double>").alias("v")), "nearest-centroids")
    n_p, n_c = max(1, -(-rows.count() // block)), max(1, -(-known.count() // block))
    places = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asks = (rows.where(F.col(vec_col).isNotNull())
            .select(F.pmod(F.xxhash64("_row"), F.lit(n_p)).cast("int").alias("p"), places(n_c).alias("c"), "_row",
                    F.lit(None).cast(id_type).alias("id"), F.col(vec_col).cast("array<double>").alias("v")))
    given = known.select(places(n_p).alias("p"), F.pmod(F.xxhash64("id"), F.lit(n_c)).cast("int").alias("c"),
                         F.lit(None).cast("bigint").alias("_row"), "id", "v")

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        mine, cents = pdf[pdf["_row"].notna()], pdf[pdf["_row"].isna()].sort_values("id")
        if not len(mine) or not len(cents):
            return pd.DataFrame({"_row": [], "id": [], "d": []})
        d, j = _block_nearest(np.stack(mine["v"].to_numpy()), np.stack(cents["v"].to_numpy()), block_bytes)
        return pd.DataFrame({"_row": mine["_row"].to_numpy(np.int64), "id": cents["id"].to_numpy()[j], "d": d})

    found = asks.unionByName(given).groupBy("p", "c").applyInPandas(
        best, T.StructType([T.StructField("_row", T.LongType()), T.StructField("id", id_type), T.StructField("d", T.DoubleType())]))
    least = found.groupBy("_row").agg(F.min(F.struct("d", "id")).alias("_best"))
    return (rows.join(least, "_row", "left").select(*points.columns, F.col("_best.id").alias(out_id), F.col("_best.d").alias(out_dist)))
