from pyspark.sql import functions as F

from basketry.functions.arrays import head, join_ints, one_hot_dense, tail


def test_slices(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([1],)], "a array<int>")
    rows = df.select(tail("a", 1).alias("t"), head("a", 1).alias("h")).collect()
    assert rows[0]["t"] == [3] and rows[0]["h"] == [1, 2]
    assert rows[1]["t"] == [1] and rows[1]["h"] == []


def test_size_of_null_array_fails_min_size(spark):
    df = spark.createDataFrame([(None,), ([1, 2],)], "a array<int>")
    assert df.filter(F.size("a") >= 2).count() == 1


def test_one_hot(spark):
    df = spark.createDataFrame([(2,), (None,), (9,)], "i int")
    rows = [r[0] for r in df.select(one_hot_dense("i", 4)).collect()]
    assert rows == [[0, 0, 1, 0], [0, 0, 0, 0], [0, 0, 0, 0]]


def test_join_ints(spark):
    df = spark.createDataFrame([([1, None, 3],)], "a array<int>")
    assert df.select(join_ints("a")).first()[0] == "1,NULL,3"
