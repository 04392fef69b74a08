"""Columns whose names are not plain words, at every operator that keeps the
columns it does not use."""
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from basketry.llm import common, exactdup, importance, language, mixing, packing, passages, periodic, quality, simhash
from tests.llm.fixtures import documents, prose

ODD = ["a.b", "c d", "row", "__none"]


def odd(spark):
    import random
    rng = random.Random(1)
    shared = prose(rng, 70)
    rows = [(i, prose(rng, 40) + " " + shared, "en", "a", 1, i, f"x{i}") for i in range(6)]
    rows.append((None, None, None, None, None, None, None))
    docs = documents(spark, rows).withColumnRenamed("fp", "a.b").withColumnRenamed("size", "c d")
    return docs.withColumn("row", F.lit(1)).withColumn("__none", F.lit("n"))


@pytest.mark.parametrize("name", ["identify", "fingerprints", "score", "pieces", "runs", "keep_one", "keep_identified",
                                  "cut_passages", "mix"])
def test_odd_column_names(spark, name):
    docs = odd(spark)
    contents = {"en": b"the of and ing er th on re ed ha st tion" * 50, "fr": b"eau le qu oi ment ai eux ion" * 50}
    made = {
        "identify": lambda: language.identify(docs, contents),
        "fingerprints": lambda: simhash.with_fingerprints(docs),
        "score": lambda: quality.score(docs, quality.fit(docs, docs.select("doc_id", F.lit(1).alias("quality")))),
        "pieces": lambda: packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")),
        "runs": lambda: periodic.periodic_runs(docs),
        "keep_one": lambda: simhash.keep_one(docs),
        "keep_identified": lambda: language.keep_identified(docs, contents),
        "cut_passages": lambda: passages.cut_passages(docs),
        "mix": lambda: mixing.take_copies(mixing.mix_sources(docs)),
    }[name]()
    kept = [c for c in ODD if c in made.columns]
    assert kept == ODD
    found = {r["c d"]: r["a.b"] for r in made.collect()}
    assert found and all(v == (None if k is None else f"x{k}") for k, v in found.items())


def test_rest_of_no_columns(spark):
    one = spark.createDataFrame([("a b",), (None,)], "text string")
    assert simhash.with_fingerprints(one).columns == ["fp"] and simhash.with_fingerprints(one).count() == 2


def test_bounds_of_hashes():
    assert common.hash_bound(0.0) == -(1 << 63) and common.hash_bound(1.0) == (1 << 63) - 1 == common.hash_bound(7.0)
    assert common.hash_bound(0.5) == 0
    assert common.hash_bound(1e-12) - common.hash_bound(0.0) == int(1e-12 * 2.0**64) > 10**7      # no share is cut to none


def test_exact_and_importance_read_their_columns_only(spark, tmp_path):
    docs = odd(spark)
    docs.write.parquet(str(tmp_path / "d"))
    assert exactdup.exact_duplicates(spark, str(tmp_path / "d")).count() == docs.count()
    assert importance.resample(docs, docs, 50).count() == docs.count()
