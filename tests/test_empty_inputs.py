"""Every operator accepts an empty input and returns an empty or neutral result."""

from basketry.operators import baskets as B
from basketry.operators import classify as CL
from basketry.operators import cluster as K
from basketry.operators import nextitem as N
from basketry.operators import profile as P
from basketry.operators import sequence as S
from basketry.operators.quantiles import exact_quantiles


def test_empty_inputs(spark):
    items = spark.createDataFrame([], "order_id long, line int, item int")
    assert B.build_baskets(items, {"items": "item"}, sort_cols=["line"]).count() == 0
    assert B.build_basket_chunks(items, {"items": "item"}, 5, sort_cols=["line"]).count() == 0
    assert B.leave_last_out_chunks(items, {"items": "item"}, 5, sort_cols=["line"]).count() == 0
    seq = S.sequence_items(items, "order_id", ["line"], "item")
    assert seq.count() == 0
    assert N.transition_predictions(seq, seq, "order_id").count() == 0
    assert exact_quantiles(items, "item", [0.25, 0.75]) == [None, None]
    assert P.null_counts(items).first().asDict() == {"order_id": 0, "line": 0, "item": 0}
    assert K.label_centroids(spark.createDataFrame([], "label int, v array<double>"), "v", "label").count() == 0
    r = N.hit_rate(spark.createDataFrame([], "target_item int, predicted_item int")).first()
    assert (r["n_baskets"], r["n_hits"], r["accuracy"]) == (0, 0, None)
    a = CL.accuracy_table(spark.createDataFrame([], "label double, prediction double")).first()
    assert (a["n"], a["n_correct"], a["accuracy"]) == (0, 0, None)
    f = B.mapping_fanout(spark.createDataFrame([], "name string"), "name").first()
    assert tuple(f) == (0, 0, 0)


def test_every_query_on_empty_tables(spark, tmp_path):
    """All catalogue queries but those that fit a model give a result of the
    usual columns on empty tables."""
    from basketry.plans import catalog as C
    from tests.conftest import SF001
    fits = {n for n in C.QUERIES if n.startswith(("rf_", "kmeans", "cluster_members", "cluster_labels", "model_save", "virtual",
                                                  "vocab_size_clusters", "next_item_classifier", "next_item_virtual"))}
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings"):
        spark.read.parquet(f"{SF001}/{t}.parquet").limit(0).coalesce(1).write.parquet(str(tmp_path / f"{t}.parquet"))
    for name in sorted(set(C.QUERIES) - fits):
        found = C.QUERIES[name](spark, str(tmp_path))
        assert found.columns, name
        found.collect()
    assert C.q_quartiles_exact(spark, str(tmp_path)).first()["q1"] is None
    assert C.q_iqr_outliers(spark, str(tmp_path)).count() == 0
