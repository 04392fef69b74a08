import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketry.operators import tfidf as TF
from basketry.plans import catalog as C
from tests.conftest import SF01


def test_word_sums_known_values(spark):
    w = TF.tfidf_long(C._part_tokens(spark, SF01), "product_id", "tokens")
    scores = {r["term"]: r["score"] for r in TF.term_scores(w, 30).collect()}
    assert math.isclose(scores["anvil"], 164.76625, abs_tol=1e-4)
    assert math.isclose(scores["blue"], 179.7786, abs_tol=1e-4)
    assert math.isclose(scores["bolt"], 178.51098, abs_tol=1e-4)


def test_row_norms_are_zero_or_one(spark):
    w = TF.tfidf_long(C._part_tokens(spark, SF01), "product_id", "tokens")
    norms = w.groupBy("product_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n"))
    assert norms.where(F.abs(F.col("n") - 1) > 1e-9).count() == 0


def test_ml_route_equals_long_route(spark):
    toks = C._part_tokens(spark, SF01)
    words = ["anvil", "blue", "bolt", "red", "zzz-absent"]
    long = TF.tfidf_long(toks, "product_id", "tokens", vocabulary=words)
    vecs = TF.tfidf_vectors(toks, "tokens", words).select("product_id", vector_to_array("features").alias("a"))
    dense = vecs.select("product_id", F.posexplode("a").alias("i", "w")).where(F.col("w") != 0)
    names = F.array(*[F.lit(x) for x in words])
    dense = dense.select("product_id", names[F.col("i")].alias("term"), "w")
    j = dense.join(long, ["product_id", "term"], "full_outer")
    assert j.where(F.col("w").isNull() | F.col("weight").isNull() | (F.abs(F.col("w") - F.col("weight")) > 1e-9)).count() == 0


def test_rows_without_vocabulary_word_are_zero(spark):
    df = spark.createDataFrame([(1, ["anvil"]), (2, ["nothing"])], "id int, tokens array<string>")
    v = {r[0]: r[1] for r in TF.tfidf_vectors(df, "tokens", ["anvil"]).select("id", vector_to_array("features")).collect()}
    assert v[1] == [1.0] and v[2] == [0.0]


def test_stopwords_removed(spark):
    df = spark.createDataFrame([(1, "the cold and the blue a x")], "id int, t string")
    assert TF.tokenize(df, "t").first()["tokens"] == ["cold", "blue"]


def test_vector_route_scores_equal_long_route(spark):
    toks = C._part_tokens(spark, SF01)
    stats = TF.term_stats(toks, "product_id", "tokens")
    words = sorted(r["term"] for r in stats.tf.select("term").distinct().collect())
    long_scores = {r["term"]: r["score"] for r in TF.term_scores(TF.tfidf_long(stats, vocabulary=words), 100).collect()}
    vecs = TF.tfidf_vectors(toks, "tokens", words, idf=TF.idf_vector(stats, None, words))
    vec_scores = {r["term"]: r["score"] for r in TF.term_scores_from_vectors(vecs, words, 100).collect()}
    assert long_scores.keys() == vec_scores.keys()
    assert all(math.isclose(long_scores[t], vec_scores[t], rel_tol=1e-9) for t in words)


def test_corpus_route_equals_long_route_top_words(spark):
    toks = C._part_tokens(spark, SF01)
    a = {r["term"]: r["score"] for r in TF.top_words(TF.corpus(toks, "product_id", "tokens", 1000), 30).collect()}
    w = TF.tfidf_long(toks, "product_id", "tokens", max_features=1000)
    b = {r["term"]: r["score"] for r in TF.term_scores(w, 30).collect()}
    assert a.keys() == b.keys()
    assert all(math.isclose(a[t], b[t], rel_tol=1e-9) for t in a)
    c = TF.corpus(toks, "product_id", "tokens", 1000)
    assert c.idf(["anvil"]) == TF.idf_vector(toks, "tokens", ["anvil"])


def test_empty_corpus_and_vocabulary(spark):
    empty = spark.createDataFrame([], "id int, tokens array<string>")
    c = TF.corpus(empty, "id", "tokens")
    assert c.vocabulary == () and TF.top_words(c, 30).count() == 0
    docs = spark.createDataFrame([(1, ["a"])], "id int, tokens array<string>")
    assert TF.tfidf_vectors(docs, "tokens", []).first()["features"].size == 0
    assert TF.term_scores_from_vectors(TF.tfidf_vectors(docs.where("id < 0"), "tokens", ["a"]), ["a"], 5) \
             .first()["score"] == 0.0


def _zipf_tokens(spark, words, seed, flat=False):
    import random
    rng = random.Random(seed)
    weights = [1.0 if flat else 1 / (i + 1) for i in range(words)]
    rows = [(i, rng.choices([f"w{j}" for j in range(words)], weights, k=200)) for i in range(150)]
    return spark.createDataFrame(rows, "id int, tokens array<string>").repartition(5)


def _counted(df):
    from collections import Counter
    counts = Counter(t for r in df.collect() for t in r.tokens)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))


def test_frequent_terms_are_proven_by_the_sketch(spark):
    """Far more terms than the sketch keeps: the survivors alone are counted."""
    df = _zipf_tokens(spark, 5000, 1)
    want = _counted(df)
    assert len(want) > 1000 and want[9][1] > 2 * TF.sketch_error(600, 30_000)
    got = TF.frequent_terms(df, "tokens", 10, tracked=600)
    assert sorted(map(tuple, got.collect()), key=lambda x: (-x[1], x[0])) == want[:10]
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().toString() and got._scratch       # the counted survivors, written


def test_frequent_terms_fall_back_where_the_bound_proves_nothing(spark):
    df = _zipf_tokens(spark, 3000, 2, flat=True)
    want = _counted(df)
    assert want[9][1] <= 2 * TF.sketch_error(100, 30_000)
    for k, tracked in ((10, 100), (50, 20), (10_000, 100), (10_000, 20_000)):
        got = TF.frequent_terms(df, "tokens", k, tracked=tracked)
        assert sorted(map(tuple, got.collect()), key=lambda x: (-x[1], x[0])) == want[:k] and not hasattr(got, "_scratch")
    assert TF.frequent_terms(df.where("false"), "tokens", 5).count() == 0
