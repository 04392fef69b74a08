import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from basketry.llm import exactdup as E
from tests.llm.fixtures import documents, odd_documents

SPACE = re.compile(r"[\x20\x09-\x0D]")


def brute(rows):
    """(doc_id, keep_id, group_size, digest) of (doc_id, text) rows, sorted."""
    groups = {}
    for k, t in rows:
        groups.setdefault(SPACE.sub("", t or ""), []).append((k, t or ""))
    out = []
    for body, members in groups.items():
        stays = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        out += [(k, stays[0], len(members), hashlib.sha256(body.encode()).hexdigest()) for k, _ in members]
    return sorted(out, key=str)


def found(df):
    rows = df.select("*", F.lower(F.hex("digest")).alias("hex")).collect()
    kept = {}
    for r in rows:
        if r.kept:
            assert r.hex not in kept and r[0] == r.keep_id
            kept[r.hex] = r
    assert len(kept) == len({r.hex for r in rows})
    return sorted(((r[0], r.keep_id, r.group_size, r.hex) for r in rows), key=str)


def write(df, path):
    df.write.mode("append").parquet(str(path))
    return str(path)


def many(seed=1):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(("a", "b", "ab", "é", "\t", "x\n")) for _ in range(rng.randint(0, 5))) for _ in range(150)]
    return list(enumerate(base + ["the hot text", "the hot  text"] * 60 + ["thehottext"]))


def test_equals_brute_force(spark, tmp_path):
    rows = many()
    path = write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), tmp_path / "docs")
    assert found(E.exact_duplicates(spark, path)) == brute(rows)


def test_odd_rows_and_a_single_file(spark, tmp_path):
    rows = [(r[0], r[1]) for r in odd_documents()]
    path = write(documents(spark), tmp_path / "docs")
    assert found(E.exact_duplicates(spark, path)) == brute(rows)
    one = write(documents(spark).coalesce(1), tmp_path / "one")
    single = next(str(p) for p in (tmp_path / "one").glob("part-*.parquet"))
    assert found(E.exact_duplicates(spark, single)) == brute(rows) and one
    none = write(documents(spark).where("false"), tmp_path / "none")
    assert E.exact_duplicates(spark, none).collect() == []


def test_clashing_column_names(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b", "x", 1), (2, "ab", None, 2)], "`doc.id` bigint, text string, digest string, row int")
    path = write(docs, tmp_path / "docs")
    got = E.exact_duplicates(spark, path, key="doc.id").collect()
    assert sorted((r[0], r.keep_id, r.kept) for r in got) == [(1, 1, True), (2, 1, False)]


def test_state_goes_on_over_new_files_and_batches(spark, tmp_path):
    rows = many(2)
    path, folder = tmp_path / "docs", str(tmp_path / "state")
    write(spark.createDataFrame(rows[:90], "doc_id bigint, text string").repartition(3), path)
    first = E.Deduplicator(spark, str(path), folder, batch_bytes=1).update()
    assert first.registry().count() == len({SPACE.sub("", t) for _, t in rows[:90]})
    write(spark.createDataFrame(rows[90:], "doc_id bigint, text string").repartition(3), path)
    # a new object, as after a restart: the checkpoints know what was read
    assert found(E.exact_duplicates(spark, str(path), folder=folder, batch_bytes=1)) == brute(rows)
    batches = list((tmp_path / "state" / "state-log" / "commits").glob("[0-9]*"))
    assert len(batches) > 2
    assert E.Deduplicator(spark, str(path), folder).update().documents().count() == len(rows)


@pytest.mark.parametrize("digest", [lambda b: F.unhex(F.substring(F.sha2(b, 256), 1, 2)), lambda b: F.unhex(F.lit("00"))])
def test_texts_decide_where_digests_collide(spark, tmp_path, digest):
    rows = many(3)
    path = write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), tmp_path / "docs")
    got = E.exact_duplicates(spark, path, digest=digest).collect()
    want = [w[:3] for w in brute(rows)]
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == sorted(want, key=str)
    assert sum(r.kept for r in got) == len({SPACE.sub("", t) for _, t in rows})


def test_no_python_worker_on_the_path(spark, tmp_path):
    path = write(spark.createDataFrame(many(4), "doc_id bigint, text string"), tmp_path / "docs")
    plan = E.exact_duplicates(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|ExternalRDD", plan)
