"""Values measured independently while surveying the workload (sf0.01)."""

from basketry.plans import catalog as C
from tests.conftest import SF01


def test_basket_counts(spark):
    assert C.q_baskets(spark, SF01).count() == 14_743
    assert C.q_baskets_min_size(spark, SF01).count() == 13_623


def test_iqr_outlier_count(spark):
    assert C.q_iqr_outliers(spark, SF01).count() == 95


def test_per_product_map_fanout(spark):
    r = C.q_cluster_map_fanout_count(spark, SF01).first()
    assert (r["n_products"], r["n_rows_per_product_map"], r["n_rows_distinct_map"]) == (2_000, 64_328, 2_000)
