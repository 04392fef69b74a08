import random

from pyspark.sql import functions as F

from basketry.operators.sequence import sequence_items, sequence_items_window


def _hot_items(spark):
    """One order holds a third of all rows; the rest are small orders."""
    rnd = random.Random(7)
    rows = [(0, i, rnd.randint(0, 9)) for i in range(600)]
    for o in range(1, 300):
        for i in range(rnd.randint(1, 7)):
            rows.append((o, i, rnd.choice([None, *range(10)])))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "order_id long, line int, item int")


def _sorted(df):
    return sorted(tuple(r) for r in df.select("order_id", "line", "item", "pos", "prev_item", "is_last").collect())


def test_range_sequence_equals_window_on_hot_group(spark):
    items = _hot_items(spark)
    want = _sorted(sequence_items_window(items, "order_id", ["line"], "item"))
    for parts in (1, 3, 8):
        got = _sorted(sequence_items(items, "order_id", ["line"], "item", partitions=parts))
        assert got == want, parts


def test_hot_group_is_split_across_partitions(spark):
    items = _hot_items(spark)
    ranged = items.repartitionByRange(8, "order_id", "line")
    per = ranged.where(F.col("order_id") == 0).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per) > 1


def test_sequence_positions_and_flags(spark):
    items = spark.createDataFrame([(1, 2, 20), (1, 1, 10), (2, 1, 5), (1, 3, 30)], "g int, s int, item int")
    got = _sorted(sequence_items(items, "g", ["s"], "item", partitions=2).withColumnRenamed("g", "order_id")
                  .withColumnRenamed("s", "line"))
    assert got == [(1, 1, 10, 1, None, False), (1, 2, 20, 2, 10, False), (1, 3, 30, 3, 20, True),
                   (2, 1, 5, 1, None, True)]


def test_dropping_sort_cols_keeps_positions(spark):
    items = _hot_items(spark)
    a = sequence_items(items, "order_id", ["line"], "item", partitions=5)
    b = sequence_items(items, "order_id", ["line"], "item", partitions=5, keep_sort_cols=False)
    assert "line" not in b.columns
    cols = ["order_id", "item", "pos", "prev_item", "is_last"]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, a.select(cols).collect()), key=key) == sorted(map(tuple, b.select(cols).collect()), key=key)


def test_null_groups_and_sort_values_match_window(spark):
    rows = [(None, i, i % 4) for i in range(40)] + [(1, None, 9), (1, 1, 8), (1, 2, None)] + \
           [(2, i, i) for i in range(30)]
    items = spark.createDataFrame(rows, "order_id long, line int, item int")
    want = _sorted_safe(sequence_items_window(items, "order_id", ["line"], "item"))
    for parts in (2, 7):
        got = _sorted_safe(sequence_items(items, "order_id", ["line"], "item", partitions=parts))
        assert got == want, parts


def _sorted_safe(df):
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    return sorted((tuple(r) for r in df.select("order_id", "line", "item", "pos", "prev_item", "is_last").collect()),
                  key=key)


def test_window_strategy_same_result(spark):
    items = _hot_items(spark)
    a = _sorted(sequence_items(items, "order_id", ["line"], "item", partitions=4))
    b = _sorted(sequence_items(items, "order_id", ["line"], "item", strategy="window"))
    assert a == b


def test_wide_ids_next_to_nulls_stay_exact(spark):
    """64-bit ids above 2^53 and NULLs in the group, item and carried columns."""
    big = 2**53
    rows = [(None if g % 5 == 0 else big + g, i, None if i % 4 == 1 else big + 2 * i + 1, None if i % 3 else big + i)
            for g in range(12) for i in range(9)]
    rows = [(g, 100 * k + i, item, extra) for k, (g, i, item, extra) in enumerate(rows)]
    items = spark.createDataFrame(rows, "o long, s int, item long, extra long")
    key = lambda r: tuple((v is None, v) for v in r)
    for parts in (1, 4, 9):
        a = sequence_items(items, "o", ["s"], "item", partitions=parts, carry=["extra"]).collect()
        b = sequence_items_window(items, "o", ["s"], "item", carry=["extra"]).collect()
        assert sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)


def test_groups_of_text_and_fractions(spark):
    rows = [("a" if i < 50 else None if i < 70 else "b", float("nan") if i % 2 else 0.5, i, f"t{i}") for i in range(100)]
    items = spark.createDataFrame(rows, "g string, f double, s int, item string")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    for group in ("g", "f"):
        a = sequence_items(items, group, ["s"], "item", partitions=6).collect()
        b = sequence_items_window(items, group, ["s"], "item").collect()
        assert sorted(map(tuple, a), key=key).__repr__() == sorted(map(tuple, b), key=key).__repr__()
