import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm import matrices as X
from basketry.llm import packing as P
from basketry.llm.tokens import ByteTokenizer, WordTokenizer
from tests.llm.fixtures import SCHEMA, documents, odd_documents

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZERS = WordTokenizer(WORDS), ByteTokenizer(BYTES, public_tokenizers.PATTERN)
ODD = ["", " ", "Hi  there x\xa0y don't WE'LL 12 3½ <|endoftext|> a<|startoftext|>b École İstanbul ΣΑΣ 你好 🙂🙂",
       "x\x1cy x\x85y\ttab\r\nnl  ", "a\n\nb  c \n d", "É è ß ẞ ﬁ Ǆ", "é ́a e ́", "it's O'Re'll''s", "a b\nc d.\nE"]


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.sampled_from(ODD), st.text(), st.text(st.sampled_from("ab É'\n\t <|ß1.！́"))))
def test_ids_are_those_of_the_tokenizers(text):
    words, data = TOKENIZERS
    try:
        raw = text.encode()
    except UnicodeEncodeError:
        return
    for _ in range(2):                                  # the second time from the memo
        assert np.frombuffer(words.encode(raw), "<u4").tolist() == words.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(data.encode(text), "<u2").tolist() == data.coder.encode_ordinary(text)
    assert data.coder.decode_bytes(np.frombuffer(data.encode(text), "<u2").tolist()) == raw


def test_ids_with_a_small_memo(monkeypatch):
    """Entries leave the memo and come back; frequent ones stay in one of its halves."""
    from basketry.llm import tokens
    monkeypatch.setattr(tokens, "MEMO", 4)
    words = WordTokenizer(WORDS)
    rng = random.Random(9)
    for _ in range(40):
        text = " ".join(rng.choice(("Often", "don't", f"w{rng.randrange(9)}x", "Zürich,", "你好")) for _ in range(30))
        assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == words.whole.encode(text, add_special_tokens=False).ids
        assert len(words.memo.new) <= 4 and len(words.memo.old) <= 4


def test_a_tokenizer_of_another_kind_is_used_whole(tmp_path):
    import json
    spec = json.load(open(WORDS))
    spec["normalizer"] = None
    (tmp_path / "other.json").write_text(json.dumps(spec))
    words = WordTokenizer(str(tmp_path / "other.json"))
    for text in ODD + ["Upper lower"]:
        assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == words.whole.encode(text, add_special_tokens=False).ids


def check_plan(counts, width):
    plan = P.plan_packing(counts, width)
    length = np.concatenate([np.full(n, k) for k, n in counts.items()] or [np.empty(0, int)]).astype(np.int64)
    rank = np.concatenate([np.arange(n) for n in counts.values()] or [np.empty(0, int)]).astype(np.int64)
    sequence, offset = plan.place(length, rank)
    by = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist()):
        by[s].append((o, n))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= width
    assert len(by) == plan.sequences
    return plan.sequences


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_plans_are_whole_and_no_worse_than_best_fit(counts):
    used = check_plan(counts, 64)
    bound = -(-sum(k * n for k, n in counts.items()) // 64)
    plain = sum(n for _, n in P.best_fit_patterns(dict(counts), 64))
    assert bound <= used <= plain


def test_exact_combinations_are_found():
    assert check_plan({60: 1, 4: 1}, 64) == 1
    assert check_plan({50: 2, 10: 2, 4: 2}, 64) == 2
    assert check_plan({31: 3, 17: 3, 11: 3, 5: 3}, 64) == 3
    assert check_plan({32: 5}, 64) == 3
    assert check_plan({1: 1, 16: 4, 33: 5}, 64) == 5       # 4 x 16 is exact, but 33 needs them


def test_counts_best_fit_is_item_best_fit():
    rng = random.Random(0)
    for _ in range(50):
        counts = Counter(rng.randint(1, 50) for _ in range(rng.randint(1, 200)))
        free = []
        for n in sorted(counts.elements(), reverse=True):
            fits = [f for f in free if f >= n]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - n)
            else:
                free.append(64 - n)
        assert sum(n for _, n in P.best_fit_patterns(dict(counts), 64)) == len(free)


def expected_pieces(rows, encode, end, width):
    out = []
    for r in rows:
        ids = encode(r[1] or "") + [end]
        for i, at in enumerate(range(0, len(ids), width)):
            some = ids[at:at + width]
            out.append((r[0], i, at, len(some), zlib.crc32(np.array(some, "<u4").tobytes())))
    return Counter(out)


@pytest.mark.parametrize("part_rows", [2_000, 2])
def test_documents_are_packed_whole(spark, part_rows, monkeypatch):
    monkeypatch.setattr(P.pack, "__defaults__", (P.WIDTH, "length", part_rows))
    whole = Tokenizer.from_file(WORDS)
    for width in (64, 4096):
        got = P.pack_documents(documents(spark), WORDS, width=width, keep_ids=True).collect()
        want = expected_pieces(odd_documents(), lambda t: whole.encode(t, add_special_tokens=False).ids, 1, width)
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
        by = defaultdict(list)
        for r in got:
            by[r.sequence_id].append((r.offset, r.length))
        for parts in by.values():
            assert [o for o, _ in sorted(parts)] == [sum(n for o2, n in parts if o2 < o) for o, _ in sorted(parts)]
            assert sum(n for _, n in parts) <= width


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert P.pack_documents(empty, WORDS).count() == 0
    made = X.token_matrices(empty, BYTES, public_tokenizers.PATTERN)
    assert made.count() == 0 and X.segment_rows(made).count() == 0


# ---------------------------------------------------------------- matrices

def test_the_tree_finds_the_fullest_row():
    rng = random.Random(1)
    tree, rooms = X.RoomTree(100), []
    for row in range(3000):
        if rooms and rng.random() < 0.5:
            least = rng.randint(0, 100)
            fits = sorted(r for r, _ in rooms if r >= least)
            found = tree.take(least)
            assert (found is None) == (not fits)
            if found:
                assert found[0] == fits[0] and found in rooms
                rooms.remove(found)
        else:
            room = rng.randint(0, 100)
            tree.put(room, row)
            rooms.append((room, row))


@pytest.mark.parametrize("width,matrix_rows,buffer,shard_bytes", [(2048, 128, 1 << 21, 8 << 20), (32, 3, 200, 500)])
def test_matrices_round_trip(spark, width, matrix_rows, buffer, shard_bytes, monkeypatch):
    monkeypatch.setattr(X, "BUFFER", buffer)
    coder = ByteTokenizer(BYTES, public_tokenizers.PATTERN).coder
    made = X.token_matrices(documents(spark), BYTES, public_tokenizers.PATTERN, width=width, matrix_rows=matrix_rows,
                            shard_bytes=shard_bytes)
    rows, want = made.collect(), expected_pieces(odd_documents(), coder.encode_ordinary, 50_256, width)
    got, texts = Counter(), defaultdict(list)
    for m in rows:
        ids = np.frombuffer(m.ids, f"<u{m.id_bytes}").reshape(m.n_rows, m.width)
        assert m.width == width and m.n_rows <= matrix_rows
        assert m.cu_seqlens[0] == 0 and m.cu_seqlens[-1] == ids.size and m.resets == m.cu_seqlens[:-1]
        positions = X.position_ids(m.n_rows, m.width, m.resets)
        for s in m.segments:
            some = ids[s.row, s.offset:s.offset + s.length]
            at = s.row * width + s.offset
            assert at in m.resets and at + s.length in m.cu_seqlens
            assert positions[s.row, s.offset:s.offset + s.length].tolist() == list(range(s.length))
            got[s.doc_id if "doc_id" in s.asDict() else s.key, s.piece, s.start, s.length, zlib.crc32(some.astype("<u4").tobytes())] += 1
            texts[s.key, m.shard].append((s.start, some.tolist()))
    assert got == want
    again = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in X.segment_rows(made).collect())
    assert again == want
    alone = {r[0]: r[1] for r in odd_documents() if r[0] is not None and r[0] not in (3, 100)}
    for (k, _), parts in texts.items():
        if k in alone:                                  # the text comes back from the matrices
            ids = [i for _, some in sorted(parts) for i in some]
            assert ids[-1] == 50_256 and coder.decode(ids[:-1]) == (alone[k] or "")


def test_byte_tokenizer_equals_the_whole_one_at_any_white_space():
    from array import array
    coder, rng = TOKENIZERS[1], random.Random(8)
    for _ in range(5000):
        text = "".join(rng.choice("ab \n\t\xa0\x1c,") if rng.random() < 0.5 else rng.choice("ab \n") for _ in range(rng.randrange(1, 9)))
        assert coder.encode(text) == array(coder.kind, coder.coder.encode_ordinary(text)).tobytes()
