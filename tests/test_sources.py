
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import functions as F

from basketry.operators import cluster as K
from basketry.operators import nextitem as N
from basketry.operators import tfidf as TF
from basketry.operators.sequence import sequence_items
from basketry.plans import catalog as C
from basketry.session import cut_lineage, scratch_path
from basketry.sources import csv as CSV
from basketry.sources import local as L
from basketry.sources import sinks as S
from tests.conftest import SF001, SF01


def test_csv_modes_roundtrip(spark):
    part = spark.read.parquet(f"{SF001}/part.parquet")
    path = CSV.write_csv(part, scratch_path(spark, "t-csv"))
    inferred = CSV.read_csv_inferred(spark, path)
    assert dict(inferred.dtypes)["p_partkey"] == "int" and dict(inferred.dtypes)["p_retailprice"] == "double"
    strings = CSV.read_csv_strings(spark, path)
    assert set(dict(strings.dtypes).values()) == {"string"}
    cast = CSV.cast_columns(strings, {"p_partkey": "int", "p_name": "int"})
    assert cast.where(F.col("p_partkey").isNull()).count() == 0
    assert cast.where(F.col("p_name").isNotNull()).count() == 0     # text that is not a number -> NULL


def test_local_frames_are_whole(spark):
    assert len(L.to_pandas(spark.range(20_000))) == 20_000
    pdf = L.to_pandas(spark.range(5))
    assert L.from_pandas(spark, pdf, "id long").count() == 5


def test_parquet_and_params_roundtrip(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    back = S.parquet_roundtrip(df, scratch_path(spark, "t-pq"))
    assert sorted(back.collect()) == sorted(df.collect())
    params = S.params_frame(spark, {"epochs": 10, "dropout_prob": 0.3}, spark.range(1).select(F.lit(21).alias("vocab_size")))
    again = S.write_params_json(params, scratch_path(spark, "t-json"))
    assert S.params_as_dict(again) == {"vocab_size": 21, "epochs": 10, "dropout_prob": 0.3}


def test_model_save_reload_same_predictions(spark):
    feats, _ = K.name_features(C.products(spark, SF01))
    model = K.fit_kmeans(feats, k=5, seed=1, weight_col="n_products", layout_key=K.NAME)
    again = S.load_model(KMeansModel, S.save_model(model, scratch_path(spark, "t-km")))
    a = model.transform(feats).select(K.NAME, "cluster")
    b = again.transform(feats).select(K.NAME, "cluster")
    assert sorted(a.collect()) == sorted(b.collect())


def test_cut_lineage_reads_back_the_same_rows(spark):
    df = spark.range(50).withColumn("y", F.col("id") % 7)
    assert sorted(cut_lineage(df).collect()) == sorted(df.collect())


def test_tfidf_and_transitions_invariant_to_repartition(spark):
    toks = C._part_tokens(spark, SF01)
    a = TF.tfidf_long(toks, "product_id", "tokens").withColumn("weight", F.round("weight", 9))
    b = TF.tfidf_long(toks.repartition(7), "product_id", "tokens").withColumn("weight", F.round("weight", 9))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    items = C.joined_items(spark, SF01)
    s1 = N.transition_counts(sequence_items(items, "order_id", ["line_no", "order_product_id", "line_price"], "department_id"))
    s2 = N.transition_counts(sequence_items(items.repartition(5), "order_id", ["line_no", "order_product_id", "line_price"],
                                            "department_id", partitions=11))
    assert s1.exceptAll(s2).count() == 0 and s2.exceptAll(s1).count() == 0


def test_recommended_conf_scales_with_input():
    from basketry.session import recommended_conf
    small = recommended_conf(40 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = recommended_conf(100 * 10**12, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(-(-100 * 10**12 // (256 << 20)))
    assert recommended_conf(100 * 10**12, 8000, max_partitions=200_000)["spark.sql.shuffle.partitions"] == "200000"
    assert "spark.basketry.scanPartitions" in small and "spark.basketry.scanPartitions" not in big
    mid = recommended_conf(10**12, 8)
    assert int(mid["spark.sql.shuffle.partitions"]) == -(-10**12 // (256 << 20))


def test_spread_is_explicit(spark):
    from basketry.session import spread
    one = spark.range(0, 100, 1, 1)
    assert spread(one, "id", 6).rdd.getNumPartitions() == 6
    assert spread(one, "id", None) is one


def test_shuffle_files_go_when_a_scratch_table_is_written(spark):
    import os

    from basketry import session
    key = next(k for k in session.WRITE_CONF if "shuffle" in k)
    last = {k: spark.conf.get(k, None) for k in session.WRITE_CONF}
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for d in manager.localDirsString() for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    before = files()
    shuffled = spark.range(100).repartition(3, "id")
    table = session.cut_lineage(shuffled, "probe")
    assert not files() - before
    assert spark.conf.get(key, None) == last[key] and {k: spark.conf.get(k, None) for k in last} == last
    assert shuffled.count() == table.count() == 100          # the frame can be used again


def test_scratch_tables_can_be_dropped(spark):
    import os

    from basketry.session import cut_lineage, discard
    table = cut_lineage(spark.range(5), "probe")
    place = table._scratch.removeprefix("file:")
    assert table.count() == 5 and os.path.isdir(place)
    discard(table)
    assert not os.path.exists(place)


def test_scratch_lives_under_the_checkpoint_dir(spark):
    from basketry.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = scratch_path(spark, "x")
    assert path.startswith(root + "/basketry-scratch/x-")
    assert scratch_path(spark, "x") != path


def test_scratch_needs_a_shared_folder_off_local():
    from types import SimpleNamespace

    import pytest

    from basketry.session import ensure_checkpoint_dir

    def session(master):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: default))
    for master in ("yarn", "k8s://x", "spark://x:1", "local-cluster[2,1,512]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(session(master))
