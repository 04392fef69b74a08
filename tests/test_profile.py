import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.operators import profile as P
from basketry.operators.quantiles import exact_quantiles
from tests.conftest import SF01


def test_filter_equals_literal(spark):
    part = spark.read.parquet(f"{SF01}/part.parquet")
    assert P.filter_equals(part, "p_partkey", "1").count() == 1
    assert P.filter_equals(part, "p_partkey", "x").count() == 0


def test_null_counts_empty_is_zero(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert P.null_counts(df).first().asDict() == {"a": 0, "b": 0}
    df2 = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert P.null_counts(df2).first().asDict() == {"a": 1, "b": 2}


def test_describe_matches_summary(spark):
    c = spark.read.parquet(f"{SF01}/customer.parquet")
    d = {(r["column_name"], r["statistic"]): r for r in P.describe_long(c).collect()}
    assert d[("c_acctbal", "count")]["num_value"] == 1500
    assert d[("c_name", "mean")]["num_value"] is None
    assert d[("c_mktsegment", "min")]["str_value"] == c.agg(F.min("c_mktsegment")).first()[0]


def test_correlation_pairs_symmetric(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    rows = {(r[0], r[1]): r[2] for r in P.correlation_pairs(li, ["l_quantity", "l_extendedprice", "l_tax"]).collect()}
    assert len(rows) == 6
    assert rows[("l_quantity", "l_tax")] == rows[("l_tax", "l_quantity")]
    assert math.isclose(rows[("l_quantity", "l_extendedprice")], li.stat.corr("l_quantity", "l_extendedprice"))


def test_exact_quartiles_known_value(spark):
    c = spark.read.parquet(f"{SF01}/customer.parquet")
    assert exact_quantiles(c, "c_acctbal", [0.25, 0.75]) == [1701.23, 7359.63]


def _disc(values, p):
    s = sorted(values)
    return s[max(1, math.ceil(p * len(s))) - 1]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=300), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 1.0]))
def test_exact_quantiles_refinement_matches_sorting(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    # tiny histogram bound and bucket count force several refinement rounds
    got = exact_quantiles(df, "x", [p], max_collect=3, buckets=4)[0]
    assert got == float(_disc(values, p))


def test_exact_quantiles_hot_value(spark):
    values = [7.0] * 400 + [float(i) for i in range(800)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    got = exact_quantiles(df, "x", [0.25, 0.5, 0.75], max_collect=10, buckets=8)
    assert got == [float(_disc(values, p)) for p in (0.25, 0.5, 0.75)]


def test_exact_quantiles_nulls_and_empty(spark):
    df = spark.createDataFrame([(None,), (1.0,), (3.0,)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [1.0]
    assert exact_quantiles(df.where("x > 10"), "x", [0.5]) == [None]


def test_iqr_outliers_strict(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "x double")
    lo, hi = P.iqr_fences(2.0, 4.0)
    assert [r[0] for r in P.outside(df, "x", lo, hi).collect()] == [100.0]
    assert P.outside(df, "x", 1.0, 100.0).count() == 0


def test_label_codes_unknown_is_null(spark):
    df = spark.createDataFrame([("A",), ("Z",)], "f string")
    assert [r[0] for r in df.select(P.label_codes("f", {"A": "accepted"})).collect()] == ["accepted", None]


@pytest.mark.parametrize("n", [3, 4])
def test_repartition_report(spark, n):
    from basketry.operators.partitions import repartition_report
    r = repartition_report(spark.range(1000), n).first()
    assert r["n_partitions"] == n and r["n_rows"] == 1000


def test_exact_quantiles_infinities(spark):
    vals = [float("-inf")] * 3 + [1.0, 2.0, 3.0] + [float("inf")] * 2 + [float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, "x", [0.1, 0.4, 0.6, 0.8, 1.0], max_collect=1, buckets=4)
    want = [_disc_nan_last(vals, p) for p in (0.1, 0.4, 0.6, 0.8, 1.0)]
    assert [str(g) for g in got] == [str(w) for w in want]


def _disc_nan_last(values, p):
    s = sorted(values, key=lambda v: (math.isnan(v), v))
    return s[max(1, math.ceil(p * len(s))) - 1]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=200),
       st.lists(st.sampled_from([0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 1.0]), min_size=1, max_size=5))
def test_exact_quantiles_many_probs_share_passes(spark, values, probs):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, "x", probs, max_collect=5, buckets=4)
    assert got == [float(_disc(values, p)) for p in probs]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(min_value=-1e12, max_value=1e12, allow_nan=False, allow_infinity=False)
                | st.sampled_from([0.0, -0.5, 3.25]), min_size=1, max_size=150),
       st.sampled_from([0.01, 0.3, 0.5, 0.99]))
def test_exact_quantiles_floats(spark, values, p):
    # elements are arbitrary floats or frequently repeated values
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, "x", [p], max_collect=4, buckets=4)[0]
    assert got == _disc(values, p)


def test_exact_quantiles_of_wide_integers_and_decimals(spark):
    from decimal import Decimal

    from basketry.operators.quantiles import exact_quantiles
    big = 9_007_199_254_740_995
    values = [big + i for i in range(2000)] + [-big, 2**63 - 1, -2**63]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 1.0]
    import math
    want = [sorted(values)[max(1, math.ceil(p * len(values))) - 1] for p in probs]
    for most in (1, 256):
        assert exact_quantiles(df, "v", probs, max_collect=most, buckets=8) == want
    dec = spark.createDataFrame([(Decimal(v),) for v in values[:500]], "v decimal(30,2)")
    assert exact_quantiles(dec, "v", [0.5], max_collect=1, buckets=4) == [Decimal(sorted(values[:500])[249])]


def test_partition_report_counts_empty_partitions(spark):
    from basketry.operators.partitions import repartition_report
    r = repartition_report(spark.range(2), 4).first()
    assert (r["n_partitions"], r["n_rows"], r["min_rows_per_partition"]) == (4, 2, 0)
    assert tuple(repartition_report(spark.range(0), 3).first()) == (3, 0, 0, 0)


def test_split_by_predicate(spark):
    from pyspark.sql import functions as F

    from basketry.operators.classify import predicate_split
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    assert [r[1] for r in predicate_split(df, F.col("v") > 2).orderBy("v").collect()] == ["train", "train", "test"]
