import os
import threading

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from basketry.sources import versions as V


def test_versions_are_kept(spark, tmp_path):
    sink = str(tmp_path / "table")
    assert V.versions(spark, sink) == []
    with pytest.raises(FileNotFoundError):
        V.load_table(spark, sink)
    for n in (3, 5):
        V.save_table(spark.range(n), sink)
    assert V.versions(spark, sink) == [1, 2]
    assert V.load_table(spark, sink).count() == 5 and V.load_table(spark, sink, 1).count() == 3
    with pytest.raises(FileNotFoundError):
        V.load_table(spark, sink, 7)


def test_a_failed_write_changes_nothing(spark, tmp_path):
    """Some tasks of the second write succeed, one fails for good."""
    sink = str(tmp_path / "table")
    V.save_table(spark.range(10), sink)
    before = V.load_table(spark, sink)
    bad = spark.range(0, 100, 1, 5).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        V.save_table(bad.select(F.col("id").cast("long")), sink)
    assert V.versions(spark, sink) == [1] and before.count() == 10 and V.load_table(spark, sink).count() == 10
    assert len(os.listdir(f"{sink}/data")) == 1
    assert V.save_table(spark.range(2), sink) == 2


def test_a_killed_driver_leaves_data_without_a_version(spark, tmp_path):
    sink = str(tmp_path / "table")
    V.save_table(spark.range(4), sink)
    spark.range(9).write.parquet(f"{sink}/data/unfinished")         # written, never committed
    assert V.load_table(spark, sink).count() == 4
    assert V.discard_unfinished(spark, sink) == 1 and V.discard_unfinished(spark, sink) == 0
    assert V.load_table(spark, sink).count() == 4


def test_two_writers_get_two_versions(spark, tmp_path):
    sink = str(tmp_path / "table")
    got = []
    writers = [threading.Thread(target=lambda n=n: got.append((V.save_table(spark.range(n), sink), n))) for n in (1, 2, 3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(v for v, _ in got) == [1, 2, 3]
    assert all(V.load_table(spark, sink, v).count() == n for v, n in got)


def test_models_and_parameters(spark, tmp_path):
    model = VectorAssembler(inputCols=["a"], outputCol="f")
    assert V.save_model(spark, model, str(tmp_path / "m")) == 1
    assert V.load_model(spark, VectorAssembler, str(tmp_path / "m")).getInputCols() == ["a"]
    params = spark.createDataFrame([(1, 0.5)], "n int, rate double")
    V.save_params(params, str(tmp_path / "p"))
    V.save_params(params.withColumn("n", F.lit(2)), str(tmp_path / "p"))
    assert [tuple(r) for r in V.load_params(spark, str(tmp_path / "p"), params.schema).collect()] == [(2, 0.5)]
    assert V.load_params(spark, str(tmp_path / "p"), params.schema, 1).first()["n"] == 1
