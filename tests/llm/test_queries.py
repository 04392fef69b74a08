"""The registered queries on the smallest tables: columns, types, SQL results,
and the pipeline stage by stage."""
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from basketry.llm.queries import ORACLES, QUERIES
from tests.conftest import SF001

CONTRACT = {
    1: {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    2: {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    3: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    4: {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    5: {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    7: {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
        "sequence_id": "bigint", "offset": "bigint"},
    9: {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    11: {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    12: {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
         "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    13: {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
}


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("number", sorted(CONTRACT))
def test_contract_columns(spark, number):
    name = next(q for q in QUERIES if q.startswith(f"op{number}_"))
    found = QUERIES[name](spark, SF001)
    kinds = dict(found.dtypes)
    assert {c: kinds.get(c) for c in CONTRACT[number]} == CONTRACT[number]
    table, key = ("embeddings", "vec_id") if number in (4, 5) else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(f"{SF001}/{table}.parquet").select(key).collect()}
    got = [r[0] for r in found.select("query_id" if number == 5 else key).collect()]
    assert set(got) == ({i for i in ids if i % 50 == 0} if number == 5 else ids)
    assert number in (5, 7) or len(got) == len(ids)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_results(spark, name):
    con = duckdb.connect()
    for table in ("conversations", "embeddings", "documents"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF001}/{table}.parquet'")
    found = QUERIES[name](spark, SF001)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert found.columns == names
    assert sorted(tuple(r) for r in found.collect()) == sorted(want.fetchall())


def test_pipeline_stages(spark, tmp_path):
    """Each stage on what the one before kept: its decisions take effect, clean
    documents stay."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF001).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        if name == "pack":
            break
        assert docs.columns == columns
        now = defaultdict(list)
        for r in rows:
            now[r.doc_id].append(r)
        assert set(now) <= set(before)
        if name == "language_id":
            assert len(now) > 0.95 * len(before) and all(now[i] == [before[i]] for i in now)
        if name == "simhash_neardup":
            from tests.llm.test_simhash import brute_fingerprint, brute_roots
            order = sorted(before)
            roots = brute_roots([brute_fingerprint(before[i].text) for i in order])
            assert sorted(now) == sorted({order[r] for r in roots})
        if name == "substring_dedup":
            seen: set = set()
            for i in sorted(now):
                words = now[i][0].text.encode().lower().split()
                grams = {tuple(words[p:p + 60]) for p in range(len(words) - 59)}
                assert not grams & seen and now[i][0].n_chars == len(now[i][0].text)
                seen |= grams
            assert sum(now[i][0].text == before[i].text for i in now) > 0.8 * len(before)
        if name == "mix_sources":
            assert all(r == before[r.doc_id] for r in rows) and max(map(len, now.values())) <= 2
            size = lambda some: sum(len(r.text.encode().split()) for r in some)
            assert size(rows) == pytest.approx(1.5 * size(before.values()), rel=0.05)
        before = {i: r[0] for i, r in now.items()}
        copies = Counter(r.doc_id for r in rows)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want: Counter = Counter()
    for i, n in copies.items():
        ids = whole.encode(before[i].text, add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            want[i, piece, zlib.crc32(np.array(ids[at:at + 4096], "<u4").tobytes())] += n
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in rows) == want
    fill = defaultdict(int)
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 4096 and len(fill) <= 1.02 * sum(fill.values()) / 4096 + 1


def test_pipeline_on_odd_and_empty_documents(spark, tmp_path):
    from tests.llm.fixtures import documents
    odd = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for n, docs in enumerate((odd, odd.where("false"))):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{n}-{name}")
            stage(spark, docs, SF001).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == (n == 0)
