"""Chat formatting after collapsing cumulative snapshots of conversations.

A log often holds a conversation many times, each time with its turns so far.
Every turn gets a hash of its place and content, and the running XOR of these
hashes (two 64-bit ones) names each prefix of each conversation.  A conversation
whose whole hash is the hash of a proper prefix of another is dropped by an
anti-join; of equal ones one is left.  What remains is rendered.

All of this runs on thin rows (ids and hashes) and in DataFrame operations only;
texts are shuffled once, for the conversations that remain.  The running values
are computed inside buckets of ``BUCKET`` turn numbers and the buckets' totals are
added, so one huge conversation is many tasks' work; prefixes and whole
conversations are made distinct before they meet, so a very frequent first turn
or conversation is one row.  A rendered row holds ``BUCKET`` turns at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.session import cut_lineage

BUCKET = 256
START, END = "<|im_start|>", "<|im_end|>"


def _content_hash(salt: int, *columns: Column) -> Column:
    """xxhash64 that tells a null from a missing column."""
    return F.xxhash64(F.lit(salt), *[x for c in columns for x in (c.isNull(), c)])


def _turns(log: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The log with ``c`` (conversation), ``own`` (set for rows without one),
    ``t`` (turn) and the content hashes ``h`` and ``g``."""
    content = [F.col(role), F.col(text)]
    rows = log.select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.col(role).alias("role"),
                      F.col(text).alias("text"), _content_hash(1, *content).alias("h"),
                      _content_hash(2, *content).alias("g"))
    own = F.when(F.col("c").isNull(), _content_hash(3, F.col("t"), F.col("h"), F.col("g"))).otherwise(F.lit(0))
    return rows.withColumn("own", own.cast("bigint"))


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """One row per distinct turn: its ``pos`` in the conversation from 1 on, the
    conversation's number of turns ``n`` and the hashes ``p`` and ``q`` of the
    prefix that ends with it."""
    conv, bucket = ["c", "own"], ["c", "own", "b"]
    rows = (turns.select("c", "own", "t", "h", "g").distinct()
            .withColumn("b", F.floor(F.col("t") / BUCKET)))
    within = Window.partitionBy(*bucket).orderBy(F.col("t").asc_nulls_last(), "h", "g")
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets_before = (Window.partitionBy(*conv).orderBy(F.col("b").asc_nulls_last())
                      .rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.select(*[F.col(x).alias(f"{x}_") for x in bucket],
                         F.coalesce(F.sum("size").over(buckets_before), F.lit(0)).alias("before"),
                         F.sum("size").over(Window.partitionBy(*conv)).alias("n"))
    same = F.expr(" and ".join(f"{x} <=> {x}_" for x in bucket))
    placed = (rows.withColumn("pos", F.row_number().over(within)).join(sizes, same)
              .withColumn("pos", F.col("pos") + F.col("before")).drop(*[f"{x}_" for x in bucket], "before"))
    placed = (placed.withColumn("x", F.xxhash64(F.lit(4), "pos", "h")).withColumn("y", F.xxhash64(F.lit(5), "pos", "g")))
    placed = cut_lineage(placed, "chat-turns")
    totals = placed.groupBy(*bucket).agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    totals = totals.select(*[F.col(k).alias(f"{k}_") for k in bucket],
                           *[F.coalesce(F.bit_xor(k).over(buckets_before), F.lit(0)).alias(f"{k}0") for k in "xy"])
    run = [(F.bit_xor(k).over(so_far)).alias(f"{k}1") for k in "xy"]
    return (placed.select("c", "own", "b", "t", "h", "g", "pos", "n", *run).join(totals, same)
            .select("c", "own", "t", "h", "g", "pos", "n", F.col("x1").bitwiseXOR(F.col("x0")).alias("p"),
                    F.col("y1").bitwiseXOR(F.col("y0")).alias("q")))


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """``(c, own, copies)`` of the conversations that prefix no longer one; of
    equal ones the smallest id (null last), with their number."""
    whole = (prefixes.where("pos = n").groupBy("n", "p", "q")
             .agg(F.min(F.struct(F.col("c").isNull().alias("none"), "c", "own")).alias("id"),
                  F.count(F.lit(1)).alias("copies")))
    proper = prefixes.where("pos < n").select(F.col("pos").alias("n"), "p", "q").distinct()
    return whole.join(proper, ["n", "p", "q"], "left_anti").select("id.c", "id.own", "copies")


def render_turn(role: Column, text: Column) -> Column:
    """One turn as chat markup.  Marks inside a role or text lose their bar, so
    a text cannot open or close a turn."""
    clean = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(START), clean(role), F.lit("\n"), clean(text), F.lit(END + "\n"))


def chat_format(log: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """Maximal conversations as chat markup: ``conv``, ``part`` (from 0; a part
    has ``BUCKET`` turns at most), ``n_turns`` (of the part), ``copies`` (equal
    conversations logged) and ``rendered``.

    Defined results: turns go by turn number (null last), rows of one number by
    a hash of their content; wholly repeated rows are one turn; a null role or
    text is not the same turn as an empty one, but renders like it; a row
    without a conversation id is a conversation of one turn, with a null id; an
    empty log gives an empty result; columns other than the four named are not
    read."""
    turns = _turns(log, conv, turn, role, text)
    prefixes = cut_lineage(turn_prefixes(turns), "chat-prefixes")
    kept = maximal_conversations(prefixes).select(F.col("c").alias("c_"), F.col("own").alias("own_"), "copies")
    places = (prefixes.join(kept, F.expr("c <=> c_ and own = own_"))
              .select(*[F.col(k).alias(f"{k}_") for k in ("c", "own", "t", "h", "g")], "pos", "copies"))
    # any of wholly equal rows will do: role and text are the same
    content = turns.groupBy("c", "own", "t", "h", "g").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    found = content.join(places, F.expr("c <=> c_ and own = own_ and t <=> t_ and h = h_ and g = g_"))
    shown = found.select("c", "own", "pos", "copies", F.floor((F.col("pos") - 1) / BUCKET).cast("int").alias("part"),
                         render_turn(F.col("role"), F.col("text")).alias("shown"))
    parts = shown.groupBy("c", "own", "part", "copies").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("pos", "shown"))).alias("turns"))
    return parts.select(F.col("c").alias(conv), "part", "n_turns", "copies",
                        F.array_join(F.col("turns.shown"), "").alias("rendered"))


ORACLE = f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
                  count(*) OVER (PARTITION BY conv_id) AS n FROM turns),
prefixes AS (SELECT *, string_agg(coalesce('r' || role, 'n') || chr(31) || coalesce('t' || text, 'n'), chr(30))
                       OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM placed),
whole AS (SELECT min(conv_id) AS conv_id, prefix, count(*) AS copies FROM prefixes WHERE pos = n GROUP BY prefix),
kept AS (SELECT * FROM whole WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE pos < n))
SELECT conv_id, CAST((pos - 1) // {BUCKET} AS INTEGER) AS part, count(*) AS n_turns, copies,
       string_agg('{START}' || replace(coalesce(role, ''), '<|', '< |') || chr(10)
                  || replace(coalesce(text, ''), '<|', '< |') || '{END}' || chr(10), '' ORDER BY pos) AS rendered
FROM kept JOIN placed USING (conv_id) GROUP BY conv_id, part, copies
"""
