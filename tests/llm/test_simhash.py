import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st

from basketry.llm import simhash as S
from tests.llm.fixtures import SCHEMA, documents, odd_documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text, n=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(values, bits=2):
    """Smallest position reachable, over all pairs."""
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(values))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_the_code_is_perfect():
    words = np.random.default_rng(0).integers(0, 1 << 23, 2000)
    error = S._error_table()[S._syndromes(words)]
    assert (np.bitwise_count(error) <= 3).all() and not S._syndromes(words ^ error).any()
    row, _ = S.golay_keys(words)
    assert set(np.bincount(row)) == {1, 6}


@given(st.integers(0, (1 << 23) - 1), st.integers(0, 22), st.integers(0, 22))
def test_words_two_bits_apart_share_a_key(word, a, b):
    row, code = S.golay_keys(np.array([word, word ^ (1 << a) ^ (0 if a == b else 1 << b)]))
    assert set(code[row == 0]) & set(code[row == 1])


def test_bit_counts_over_many_hashes():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    starts = np.array([0, 1, 255, 256, 1000, 4999])
    want = [[sum(int(x) >> b & 1 for x in part) for b in range(64)] for part in np.split(h, starts[1:])]
    assert S.bit_counts(h, starts).tolist() == want


@pytest.mark.parametrize("limit", [1 << 22, 7])
def test_fingerprints_equal_brute_force(limit, monkeypatch):
    runs = S.word_runs
    monkeypatch.setattr(S, "word_runs", lambda t: runs(t, limit))      # also cut into tiny stretches
    texts = [r[1] for r in odd_documents()]
    got = S.fingerprints([None if t is None else t.encode() for t in texts])
    assert got.tolist() == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("max_bits,max_bucket", [(2, 64), (2, 1), (1, 64), (1, 1), (0, 64)])
def test_links_connect_exactly_the_close_fingerprints(spark, max_bits, max_bucket):
    rng = random.Random(max_bits)
    values = set()
    for _ in range(30):
        x = rng.getrandbits(64)
        values |= {x} | {x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64) if rng.random() < .5 else 0)
                         for _ in range(12)}
    values = sorted(map(signed, values))
    links = S.fingerprint_links(spark.createDataFrame([(v,) for v in values], "fp bigint"), max_bits, max_bucket).collect()
    at = {v: i for i, v in enumerate(values)}
    plain = [v % (1 << 64) for v in values]
    assert all((plain[at[a]] ^ plain[at[b]]).bit_count() <= max_bits for a, b in links)
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        x, y = sorted((find(at[a]), find(at[b])))
        parent[y] = x
    assert [find(i) for i in range(len(values))] == brute_roots(plain, max_bits)


def brute_groups(rows):
    prints = [brute_fingerprint(r[1]) for r in rows]
    roots = brute_roots(prints)
    low = {}
    for r, root in zip(rows, roots):
        low.setdefault(root, []).append(r[0])
    component = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return prints, roots, [component[r] for r in roots]


def key(row):
    return tuple((v is None, v) for v in row)


def test_odd_documents_equal_brute_force(spark):
    rows = odd_documents()
    prints, _, components = brute_groups(rows)
    got = [tuple(r) for r in S.near_duplicates(documents(spark)).collect()]
    want = [(r[0], signed(p), c) for r, p, c in zip(rows, prints, components)]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_keep_one_leaves_one_of_each_group(spark):
    rows = odd_documents()
    _, roots, _ = brute_groups(rows)
    kept = [tuple(r) for r in S.keep_one(documents(spark)).collect()]
    assert len(kept) == len(set(roots))
    by_row = {r: root for r, root in zip(rows, roots)}
    assert len({by_row[k] for k in kept}) == len(kept)
    for k in kept:                                   # the smallest id of its group
        ids = [r[0] for r, root in zip(rows, roots) if root == by_row[k] and r[0] is not None]
        assert k[0] == min(ids, default=None)


def test_a_large_group_of_near_copies_is_one(spark):
    rng = random.Random(5)
    words = prose(rng, 400).split()
    rows = []
    for i in range(150):
        w = list(words)
        w[rng.randrange(400)] = "changed%d" % i
        rows.append((i, " ".join(w), "en", "a", 1, 1, "x"))
    _, roots, components = brute_groups(rows)
    got = {r[0]: r["component"] for r in S.near_duplicates(documents(spark, rows), max_bucket=8).collect()}
    assert got == {r[0]: c for r, c in zip(rows, components)}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.near_duplicates(empty).count() == 0 and S.keep_one(empty).columns == empty.columns
    assert S.keep_one(empty).count() == 0
