import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.operators import similarity as S
from basketry.operators import tfidf as TF


def brute(docs, k, least, max_features=1000):
    """All pairs of ``{id: tokens}``."""
    counts = {i: Counter(ts) for i, ts in docs.items()}
    total, df = Counter(), Counter()
    for c in counts.values():
        total.update(c)
        df.update(c.keys())
    vocab = set(sorted(total, key=lambda t: (-total[t], t))[:max_features])
    vecs = {}
    for i, c in counts.items():
        v = {t: n * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in c.items() if t in vocab}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vecs[i] = {t: x / norm for t, x in v.items()}
    out = []
    for i, v in vecs.items():
        near = [(-round(sum(x * w.get(t, 0) for t, x in v.items()), 6), j) for j, w in vecs.items() if j != i]
        near = sorted(n for n in near if -n[0] >= least)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return sorted(out)


def found(df):
    return sorted((r[0], r.rank, r.other, r.cosine) for r in df.collect())


def frame(spark, docs, parts=3):
    return spark.createDataFrame(list(docs.items()), "id bigint, tokens array<string>").repartition(parts)


def random_docs(n, seed, words=30, longest=12):
    rng = random.Random(seed)
    pick = lambda: f"w{min(rng.randrange(words), rng.randrange(words))}"
    return {i: [pick() for _ in range(rng.randint(0, longest))] for i in range(n)}


@pytest.mark.parametrize("least, block", [(0.2, 2048), (0.7, 16), (0.95, 4)])
def test_equals_all_pairs(spark, least, block):
    docs = random_docs(150, 1)
    docs |= {1000 + i: list(docs[i]) for i in range(20)}                # copies
    stats = TF.term_stats(frame(spark, docs), "id", "tokens")
    assert found(S.cosine_topk(stats, 4, least, block=block)) == brute(docs, 4, least)


def test_small_vocabulary_and_empty_rows(spark):
    docs = random_docs(80, 2) | {500: [], 501: ["rare"], 502: ["rare", "rare"]}
    stats = TF.term_stats(frame(spark, docs), "id", "tokens")
    assert found(S.cosine_topk(stats, 3, 0.5, max_features=10)) == brute(docs, 3, 0.5, 10)
    none = TF.term_stats(frame(spark, docs).where("false"), "id", "tokens")
    assert S.cosine_topk(none, 3, 0.5).count() == 0
    with pytest.raises(ValueError):
        S.cosine_topk(stats, 3, 0.0)


def test_text_ids(spark):
    docs = random_docs(40, 3)
    df = frame(spark, docs).withColumn("id", F.format_string("n%03d", "id"))
    got = S.cosine_topk(TF.term_stats(df, "id", "tokens"), 3, 0.4)
    assert sorted((int(r[0][1:]), r.rank, int(r.other[1:]), r.cosine) for r in got.collect()) == brute(docs, 3, 0.4)


def test_hot_term_and_hot_vector_stay_small(spark):
    """A word in all rows and a vector that a third of them have: far fewer
    comparisons than pairs, and no group of that size."""
    rng = random.Random(4)
    docs = {i: ["hot", f"a{rng.randrange(150)}", f"b{rng.randrange(150)}", f"c{rng.randrange(150)}"] for i in range(600)}
    docs |= {1000 + i: ["hot", "plain"] for i in range(300)}
    stats = TF.term_stats(frame(spark, docs), "id", "tokens")
    _, nodes = S.vector_nodes(stats)
    assert nodes.count() <= 601
    postings = S.prefix_postings(nodes, 0.7)
    hot = nodes.select(F.explode("tids").alias("tid")).groupBy("tid").count().orderBy(F.desc("count")).first()["tid"]
    assert postings.where(F.col("tid") == hot).count() < 30         # the hot word is never where a prefix ends
    dealt, pairs = S.deal_blocks(postings, 0.7, 32)
    sizes = {(r["tid"], r["blk"]): r["count"] for r in dealt.groupBy("tid", "blk").count().collect()}
    compared = sum(sizes[p.tid, p.l] * sizes[p.tid, p.r] for p in pairs.collect())
    assert compared < 900 * 900 / 20 and max(sizes.values()) <= 64
    assert found(S.cosine_topk(stats, 3, 0.7, block=32)) == brute(docs, 3, 0.7)


def test_filed_vectors_are_a_few_bytes_a_term(spark):
    """Every posting carries its vector to a task per pair of blocks: three bytes a
    term, and blocks of thousands of short vectors.  Counts over a byte are exact."""
    docs = random_docs(60, 5) | {1000: ["w1"] * 300 + ["w2"] * 2, 1001: ["w1"] * 299 + ["w2"] * 3}
    stats = TF.term_stats(frame(spark, docs), "id", "tokens")
    _, nodes = S.vector_nodes(stats)
    sizes = {r["node"]: (len(r["tids"]), max(r["tfs"])) for r in nodes.collect()}
    for r in S.prefix_postings(nodes, 0.5).collect():
        n, most = sizes[r["node"]]
        assert len(r["terms"]) == 2 * n and len(r["counts"]) == (n if most < 256 else 8 * n)
    assert S.block_rows(nodes) == S.LARGEST
    assert found(S.cosine_topk(stats, 4, 0.5)) == brute(docs, 4, 0.5)


def test_pairs_of_an_earlier_term_are_not_compared_exactly(monkeypatch):
    """Rows alike under a rare term, met again under a frequent one: there the
    products are made of the later terms only, and no pair is taken to double precision."""
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(3)
    idf, made, plain = np.ones(200), [], S._Side.dense
    def side(terms):
        rows = [np.array(t, np.uint16) for t in terms]
        return S._Side(pd.DataFrame({"terms": [t.tobytes() for t in rows], "counts": [np.ones(len(t), np.uint8).tobytes() for t in rows],
                                     "norm": [math.sqrt(len(t)) for t in rows], "a": 1.0, "b": 1.0}), idf)
    def dense(self, some, kind):
        made.append((len(some), np.dtype(kind)))
        return plain(self, some, kind)
    monkeypatch.setattr(S._Side, "dense", dense)
    alike = side([sorted({0, *range(100, 150)} - {int(rng.integers(101, 150))}) for _ in range(40)])
    i, j, sims = S._near_pairs(alike, alike, 0, 0.9, True)
    assert len(i) == 40 * 39 // 2 and sims.min() >= 0.9
    made.clear()
    assert not len(S._near_pairs(alike, alike, 100, 0.9, True)[0])
    assert not [k for n, k in made if k == np.float64] and all(n <= 50 for n, k in made if k == np.float32)
    # the same pairs as by all products, in tiles of all terms
    some = side([sorted(set(rng.integers(0, 12, 6).tolist())) for _ in range(50)])
    got = set()
    for term in range(12):
        i, j, sims = S._near_pairs(some, some, term, 0.5, True)
        got |= {(a, b, v) for a, b, v in zip(i.tolist(), j.tolist(), sims.tolist())}
    full = plain(some, np.arange(200), np.float64)
    product = np.round(full @ full.T, S.DIGITS)
    assert got == {(a, b, product[a, b]) for a in range(50) for b in range(a + 1, 50) if product[a, b] >= 0.5}
