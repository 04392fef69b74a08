import hashlib
import math
import random
import re
import zlib
from collections import Counter

from basketry.llm import importance as I
from tests.conftest import SF001
from tests.llm.fixtures import documents, odd_documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def features(text):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(rows, target, percent=5):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    out, able = [], []
    for k, text in rows:
        f = features(text)
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([k, len(f), weight, score, None])
        if len(words_of(text)) >= 20:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_features_of_stretches(monkeypatch):
    rng = random.Random(2)
    whole = I.word_runs
    for limit in (1, 5, 60, 1 << 20):
        monkeypatch.setattr(I, "word_runs", lambda t, limit=limit: whole(t, limit))
        for text in ("", "one", "one two", "A b-C d_e 9é 你好 `x` \x00\x7f z", prose(rng, 200)):
            for order in (1, 2, 3, 4):
                w = words_of(text)
                want = Counter(zlib.crc32(" ".join(w[i:i + n]).encode()) for n in range(1, order + 1) for i in range(len(w) - n + 1))
                found = list(I.feature_crcs(text.encode(), order))
                assert Counter(c for _, cs in found for c in cs) == want and sum(n for n, _ in found) == len(w)


def test_query_equals_brute_force(spark):
    from basketry.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = brute(rows, target)
    assert got(QUERIES["op13_importance_resampling"](spark, SF001)) == want
    assert sum(r[4] is not None for r in want) >= 5


def test_odd_rows_ties_and_empty_tables(spark):
    rng = random.Random(4)
    rows = odd_documents() + [(500 + i, prose(rng, 30), "en", "a", 1, 1, "x") for i in range(60)]
    docs = documents(spark, rows).withColumnRenamed("size", "a.b").withColumnRenamed("fp", "weight")
    target = documents(spark, rows[8:12] + [(1, None, None, None, None, None, None)])
    found = got(I.resample(docs, target, percent=30))
    ours = brute([(r[0], r[1]) for r in rows], [r[1] for r in rows[8:12]], 30)
    plain = lambda some: sorted((r[:4] for r in some), key=str)
    assert plain(found) == plain(ours)
    # rows of one key and score are ranked in any order
    drawn = lambda some: sorted((r[4], str(r[:4])) for r in some if r[4])
    assert drawn(found) == drawn(ours) and len(drawn(ours)) > 10
    none = docs.where("false")
    assert I.resample(none, target).count() == 0
    # without a target its counts are all smoothing
    assert plain(got(I.resample(docs, target.where("false"), percent=30))) == plain(brute([(r[0], r[1]) for r in rows], []))


def test_same_result_on_any_partitions(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 25), "en", "a", 1, 1, "x") for i in range(80)]
    target = documents(spark, rows[:3])
    assert got(I.resample(documents(spark, rows, 1), target, 20)) == got(I.resample(documents(spark, rows, 7), target, 20))
