import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import language as L
from basketry.llm import quality as Q
from tests.llm.fixtures import SCHEMA, documents, odd_documents, prose


def corpus(n=240):
    rng = random.Random(9)
    return [(i, prose(rng, rng.randint(30, 200), lang), lang, "a", 1, 1, "x") for i in range(n) for lang in [("en", "de", "fr")[i % 3]]]


def test_held_out_accuracy_and_rejections(spark):
    docs = documents(spark, corpus() + [(1000, None, "en", "a", 1, 1, "x"), (1001, "123 !!", "en", "a", 1, 1, "x"),
                                        (1002, "", None, None, 1, 1, "x")])
    held = L.fold("doc_id", 5) == 0
    found = L.identify(docs, L.fit_dictionaries(docs.where(~held))).collect()
    true = {r[0]: r[2] for r in corpus()}
    out = [r for r in found if r.doc_id in true and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(out) > 30 and all(r.lang_pred == true[r.doc_id] and not r.lang_rejected for r in out)
    assert all(0 <= r.lang_score <= 1 for r in found)
    assert {(r.lang_pred, r.lang_score, r.lang_rejected) for r in found if r.doc_id >= 1000} == {("und", 0.0, True)}


def test_case_and_marks_do_not_matter(spark):
    encoder = L.Encoder(L.fit_dictionaries(documents(spark, corpus())))
    text = corpus()[1][1]
    shout = "!! ".join(text.upper().split())
    assert encoder.classify(text)[0] == encoder.classify(shout)[0] == "de"
    assert encoder.classify(text) == encoder.classify(text.replace(" ", " | ").replace(".", ""))


def test_one_language_none_and_odd_rows(spark):
    rows = documents(spark)
    none = L.identify(rows, L.fit_dictionaries(rows.where("false")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert none.count() == len(odd_documents())
    one = L.Encoder({"en": b"the of and"})
    assert one.classify("word") == ("en", 1.0, 1.0) and one.classify("你好")[0] == "en" and one.classify("12")[0] == "und"
    two = L.Encoder({"b": b"", "a": b""})
    assert two.classify("word")[0] == "a" and two.classify("word")[2] == 0
    kept = L.keep_identified(rows.withColumn("lang_pred", F.lit(1)).withColumn("lang_rejected", F.lit("z")),
                             L.fit_dictionaries(rows))
    assert kept.columns == [*rows.columns, "lang_pred", "lang_rejected"] and 0 < kept.count() < len(odd_documents())
    assert L.identify(spark.createDataFrame([], SCHEMA), {}).count() == 0


def test_blocks_cover_the_whole_text():
    text = "Ab é, " * 300_000
    whole = b"".join(L._blocks(text))
    assert len(whole) >= len(L.letters_only(text)) and whole.replace(b"  ", b" ") == L.letters_only(text)


# ---------------------------------------------------------------- quality

def test_linear_time_score_equals_all_pairs():
    rng = np.random.default_rng(0)
    n = Q.BUCKETS + Q.N_STATS
    m = Q.Machine(0.1, rng.normal(0, .3, n), rng.normal(0, .3, (n, Q.RANK)), np.zeros(Q.N_STATS), np.ones(Q.N_STATS))
    where, value, stats = Q.Featuriser()("some words, MORE words 12\nand a line".encode(), 30)
    i, x = m.row(where, value, stats)
    z = m.bias + m.weights[i] @ x + sum(m.factors[i[a]] @ m.factors[i[b]] * x[a] * x[b]
                                        for a in range(len(i)) for b in range(a))
    assert m.score(where, value, stats) == pytest.approx(1 / (1 + np.exp(-z)))


def test_gradients_fit_an_interaction():
    """Label 1 if both or neither of two words are there: only pairs tell."""
    rng = random.Random(1)
    featurise, rows = Q.Featuriser(), []
    for _ in range(600):
        a, b = rng.random() < .5, rng.random() < .5
        text = " ".join(["alpha"] * a + ["beta"] * b + ["gamma"])
        rows.append((*featurise(text.encode(), 5)[:2], np.zeros(Q.N_STATS), int(a == b)))
    m = Q.fit_machine(rows, epochs=60)
    assert np.mean([(m.score(*r[:3]) > 0.5) == r[3] for r in rows]) > 0.98


def test_held_out_quality(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.6
        text = prose(rng, rng.randint(20, 120))
        if not good:
            text = rng.choice([lambda t: t.upper().replace(" ", "!! "), lambda t: " | ".join(t.split()),
                               lambda t: (t.split()[0] + " ") * 60])(text)
        rows.append((i, text, None, None, len(text), 1, "x"))
        labels.append((i, int(good)))
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")
    held = L.fold("doc_id", 4) == 2
    m = Q.fit(docs.where(~held), marks.where(~held))
    got = {r.doc_id: r.quality_score for r in Q.score(docs, m).collect()}
    out = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.7) == labels[i][1] for i in out]) > 0.95
    again = Q.fit(docs.repartition(5).where(~held), marks.repartition(2).where(~held))
    assert np.array_equal(m.factors, again.factors)
    odd = Q.score(documents(spark), m).collect()
    assert len(odd) == len(odd_documents()) and all(0 <= r.quality_score <= 1 for r in odd)


def test_without_labels(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.quality_score for r in Q.score(docs, Q.fit(docs, none)).collect()} == {0.5}
    nulls = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id bigint, quality int")
    assert {r.quality_score for r in Q.score(docs, Q.fit(docs, nulls)).collect()} == {0.5}
    assert Q.score(spark.createDataFrame([], SCHEMA), Q.fit(docs, none)).count() == 0
