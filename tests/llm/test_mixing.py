import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from basketry.llm import mixing as M
from tests.llm.fixtures import SCHEMA, documents, odd_documents


def brute_targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), cap=2):
    """sizes: source -> words.  Shares out again while a target is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full = share * sum(sizes.values()), set()
    while True:
        total = sum(w[s] for s in order if s not in full)
        now = {s: Fraction(cap * sizes[s]) if s in full else left * w[s] / total for s in order}
        above = {s for s in order if now[s] > cap * sizes[s]}
        if not above:
            return now
        full |= above
        left = share * sum(sizes.values()) - sum(cap * sizes[s] for s in full)


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 5, 100, 10_000, 9_999_999]) for s in ["a", "b", "É", "zz", "A", "\U0001F642", "￿", None]}
    got = M.source_targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "__source string, __size bigint")).collect()
    want = brute_targets(sizes)
    for r in got:
        assert r["__target"] == pytest.approx(float(want[r["__source"]]), rel=1e-9)


def rows(n, seed=0, sources=("a", "b", "c", None)):
    rng = random.Random(seed)
    return [(i, None, "en", sources[0] if rng.random() < 0.4 else rng.choice(sources), 1,
             int(rng.lognormvariate(5, 1.2)), "x") for i in range(n)]


@pytest.mark.parametrize("block_rows", [20_000, 100])
def test_totals_come_near_their_targets(spark, block_rows):
    mixed = M.mix_sources(documents(spark, rows(3000)), size=F.col("size").cast("bigint"), block_rows=block_rows)
    by = defaultdict(lambda: [0, 0, 0])
    for r in mixed.collect():
        assert 0 <= r.mix_copies <= 2 and r.mix_taken == r.mix_copies * r.size <= 2 * r.size
        s = by[r.source]
        s[0] += r.mix_taken
        s[1] += r.size
        s[2] = r.mix_target
    want = brute_targets({s: v[1] for s, v in by.items()})
    for s, (taken, _, target) in by.items():
        assert target == pytest.approx(float(want[s]))
        assert abs(taken - target) <= (0.002 if block_rows > 1000 else 0.01) * target


def test_reruns_agree_whatever_the_partitions(spark):
    data = rows(800, 1)
    run = lambda parts: sorted((r.doc_id, r.mix_copies) for r in
                               M.mix_sources(documents(spark, data, parts), size=F.col("size").cast("bigint"), block_rows=150).collect())
    assert run(1) == run(7)


def test_flight_keeps_probabilities_and_totals():
    rng = random.Random(2)
    taken = Counter()
    for trial in range(400):
        units = [[i, 0.3, 10 + i, rng.getrandbits(64)] for i in range(40)]
        M.land(sorted(units, key=lambda u: -u[2]))
        assert all(u[1] in (0, 1) for u in units)
        assert abs(sum(u[1] * u[2] for u in units) - 0.3 * sum(u[2] for u in units)) <= 60
        taken.update(u[0] for u in units if u[1])
    assert all(0.18 < taken[i] / 400 < 0.42 for i in range(40))


def test_odd_documents(spark):
    data = odd_documents()
    mixed = M.mix_sources(documents(spark))
    got = mixed.collect()
    assert mixed.columns[:7] == ["doc_id", "text", "lang", "source", "n_chars", "size", "fp"]
    assert len(got) == len(data)
    words = lambda t: len((t or "").encode().split())
    assert Counter((r.doc_id, r.mix_size) for r in got) == Counter((r[0], words(r[1])) for r in data)
    sizes = Counter()
    for r in data:
        sizes[r[3]] += words(r[1])
    want = brute_targets(sizes)
    for r in got:
        assert r.mix_target == pytest.approx(float(want[r.source])) and r.mix_source_size == sizes[r.source]
    copies = M.take_copies(mixed)
    assert copies.columns == mixed.columns[:7] and copies.count() == sum(r.mix_copies for r in got)


def test_empty_and_wordless(spark):
    assert M.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    silent = M.mix_sources(documents(spark, [(1, None, None, "a", 1, 1, "x"), (2, " ", None, None, 1, 1, "x")])).collect()
    assert [(r.mix_target, r.mix_copies, r.mix_taken) for r in silent] == [(0.0, 0, 0)] * 2
