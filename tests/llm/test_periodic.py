import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import periodic as P
from tests.llm.fixtures import documents, odd_documents


def brute_runs(words):
    """Maximal stretches with smallest period q and length >= max(6, 4 q)."""
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(6, 4 * q):
                part = words[at:end + q]
                if not any(all(part[i] == part[i + d] for i in range(len(part) - d)) for d in range(1, q)):
                    out.add((at, end + q - at, q))
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(words):
    gone = {i for s, n, q in brute_runs(words) for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 9), st.integers(1, 12), st.lists(st.integers(0, 2), max_size=20))
def test_runs_equal_brute_force(head, period, times, tail):
    words = head + (head[:period] * times if head else []) + tail
    assert [tuple(r) for r in P.find_runs(np.array(words, np.int64)).tolist()] == brute_runs(words)


def test_long_and_nested_runs():
    rng = random.Random(5)
    block = [rng.randrange(50) for _ in range(37)]
    nested = ([1] * 9 + [2]) * 8
    words = block * 6 + nested + block * 4 + [7] * 5 + [8] * 6 + block[:10] * 4 + [0]
    assert [tuple(r) for r in P.find_runs(np.array(words)).tolist()] == brute_runs(words)
    long = np.tile(np.arange(1000), 300)
    assert P.find_runs(long).tolist() == [[0, 300_000, 1000]]
    assert P.find_runs(np.zeros(100_000, np.int64)).tolist() == [[0, 100_000, 1]]
    # growth by letters: Fibonacci words hold many squares and cubes, no fourth powers beyond these
    a, b = [0], [0, 1]
    while len(b) < 2000:
        a, b = b, b + a
    assert P.find_runs(np.array(b)).tolist() == []


def test_documents_of_a_slice_do_not_meet():
    sizes, runs, texts = P.collapse([b"a a a", b"a a a a", None, b"", b"b b b b b b", b"b b"])
    assert sizes == [3, 4, 0, 0, 6, 2]
    assert runs == [[], [], [], [], [(0, 6, 1)], []]
    assert texts == [b"a a a", b"a a a a", b"", b"", b"b", b"b b"]


def with_runs():
    rows = odd_documents()
    rng = random.Random(8)
    for i in range(40):
        base = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        words = [rng.choice("abcd") for _ in range(5)] + base * rng.randint(1, 9) + [rng.choice("abcd") for _ in range(7)]
        rows.append((1000 + i, "\t ".join(words) + "\n", "en", "a", 1, 1, "z"))
    return rows


def test_operator_on_odd_rows(spark):
    rows = with_runs()
    docs = documents(spark, rows).withColumnRenamed("fp", "a.b").withColumnRenamed("size", "runs")
    got = P.periodic_runs(docs)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "a.b", "n_words", "runs", "collapsed"]
    want = []
    for r in rows:
        words = [w.decode() for w in (r[1] or "").encode().split()]
        want.append((r[0], len(words), brute_runs(words), brute_collapse(words)))
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()]
    assert sorted(found, key=str) == sorted(want, key=str) and sum(bool(w[2]) for w in want) > 10
    assert P.periodic_runs(docs.where("false")).count() == 0


def planted(key, words):
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_planted_runs(spark):
    rows = [r for r in with_runs() if r[0] is not None]
    got = documents(spark, rows).select("doc_id", "text", P.plant_runs("doc_id", "text").alias("made")).collect()
    assert any(r.made != r.text for r in got)
    for r in got:
        if r.text is None:
            assert r.made is None
        else:
            assert r.made.encode().split() == planted(r.doc_id, r.text.encode().split())


def test_query_equals_brute_force(spark):
    import hashlib
    from fractions import Fraction

    from basketry.llm.queries import QUERIES
    from tests.conftest import SF001
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = QUERIES["op12_periodic_runs"](spark, SF001).collect()
    assert len(got) == len(texts)
    some = 0
    for r in got:
        words = [w.decode() for w in (texts[r.doc_id] or "").encode().split()]
        words = planted(r.doc_id, words)
        if len(words) > 600:
            continue            # the brute force takes squares of the length
        runs = brute_runs(words)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        lines = "".join("%d,%d,%d\n" % x for x in runs)
        want = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapse(words).encode()).hexdigest())
        assert tuple(r)[1:] == want
        some += bool(runs)
    assert some > 5
