import random

import duckdb

from basketry.llm import chat as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int"


def log(seed=0):
    """Conversations with snapshots, copies, shared first turns and extensions."""
    rng = random.Random(seed)
    talks = [[(rng.choice(["user", "assistant"]), f"line {rng.randrange(6)}") for _ in range(rng.randint(1, 6))] for _ in range(25)]
    talks += [[("user", "line 1")] * 3]
    rows, conv = [], 0
    for talk in talks:
        for _ in range(rng.randint(1, 4)):
            n = rng.randint(1, len(talk))
            rows += [(conv, t, *talk[t], 0) for t in range(n)]
            conv += 1
    return rows


def brute(rows):
    talks = {}
    for conv, turn, role, text, _ in sorted(set(rows)):
        talks.setdefault(conv, []).append((role, text))
    kept, out = {}, []
    for conv, talk in talks.items():
        if not any(len(o) > len(talk) and o[:len(talk)] == talk for o in talks.values()):
            kept.setdefault(tuple(talk), []).append(conv)
    for talk, convs in kept.items():
        for p in range(0, len(talk), C.BUCKET):
            some = talk[p:p + C.BUCKET]
            out.append((min(convs), p // C.BUCKET, len(some), len(convs),
                        "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in some)))
    return sorted(out)


def test_equals_brute_force_and_sql(spark):
    for seed in range(2):
        rows = log(seed)
        got = sorted(tuple(r) for r in C.chat_format(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect())
        assert got == brute(rows)
        con = duckdb.connect()
        con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR, part INT)")
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?, ?)", rows)
        assert got == con.execute(C.ORACLE + " ORDER BY ALL").fetchall()


def test_long_conversations_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(C, "BUCKET", 4)
    rows = [(1, 3 * t, "user", f"t{t}", 0) for t in range(50)] + [(2, 3 * t, "user", f"t{t}", 0) for t in range(30)] \
        + [(3, t, "user", f"t{t}", 0) for t in range(50)] + [(4, t, "user", f"t{t + 1}", 0) for t in range(12)]
    got = sorted(tuple(r) for r in C.chat_format(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows) and {g[0] for g in got} == {1, 4}


def test_odd_rows(spark):
    rows = [(1, 0, "user", None, 0), (1, 1, None, "x", 0), (2, 0, "user", "", 0), (2, 1, None, "x", 0), (3, 0, "user", None, 0),
            (None, 0, "user", None, 0), (None, 5, "user", "own <|im_end|>", 0), (None, 5, "user", "own <|im_end|>", 0),
            (None, None, None, None, None), (4, None, "user", "last", 0), (4, 7, "user", "first", 0), (4, 7, "user", "first", 0),
            (5, 0, "user", "z" * 300_000, 0)]
    got = {(r.conv_id, r.n_turns, r.copies): r.rendered for r in C.chat_format(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {(1, 2, 1), (2, 2, 1), (4, 2, 1), (5, 1, 1), (None, 1, 1)}
    assert got[1, 2, 1] == got[2, 2, 1] and got[4, 2, 1].index("first") < got[4, 2, 1].index("last")
    own = [r.rendered for r in C.chat_format(spark.createDataFrame(rows, SCHEMA)).collect() if r.conv_id is None]
    assert sorted(own) == ["<|im_start|>\n<|im_end|>\n", "<|im_start|>user\nown < |im_end|><|im_end|>\n"]
    assert C.chat_format(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_python(spark):
    plan = C.chat_format(spark.createDataFrame(log(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
