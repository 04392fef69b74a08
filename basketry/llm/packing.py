"""Best-fit packing with exact-complement hashing.

Documents become token ids with an end id; longer ones than a sequence are cut
into full pieces and a rest.  Which piece of a length goes where does not matter
for the number of sequences, so the packing is planned on the table of lengths
and their counts (as many rows as a sequence has tokens, whatever the corpus):

1. longest first, a length takes the gap it leaves: filled exactly by one
   available length, by a pair, or by three (found in an index of single, pair
   and triple sums), as often as all its parts are available;
2. the rest goes best-fit decreasing, on counts, too.

Each planned pattern is a run of sequences with the same lengths.  The pieces
are then numbered per length (in salted parts, so that a frequent length is many
tasks' work) and looked up in the plan, whose size is bounded by the sequence
length and not by the corpus.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.llm.common import extended, rest_and, small, with_rest
from basketry.llm.tokens import word_tokenizer
from basketry.session import cut_lineage

WIDTH = 4096
END_ID = 1
PART_ROWS = 2_000


# ---------------------------------------------------------------- the plan

@dataclass
class Plan:
    """Rows sorted by (length, first): pieces ``first .. first + count * times``
    of a length fill ``count`` sequences from ``base`` on, ``times`` of them side
    by side from ``offset`` on."""
    length: np.ndarray
    first: np.ndarray
    times: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the rank-th piece of a length."""
        at = np.empty(len(length), np.int64)
        for one in np.unique(length):
            low, high = np.searchsorted(self.length, [one, one + 1])
            mine = length == one
            at[mine] = low + np.searchsorted(self.first[low:high], rank[mine], "right") - 1
        within = rank - self.first[at]
        return self.base[at] + within // self.times[at], self.offset[at] + within % self.times[at] * length


def exact_patterns(counts: dict[int, int], width: int, least: int = 1) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ``([(length, times)], sequences)`` that fill a sequence exactly
    with a length of at least ``least`` and one, two or three more; takes them
    out of ``counts``."""
    have = np.zeros(width + 1, np.int64)
    for length, n in counts.items():
        have[length] = n
    made = []

    def use(parts: list[int]) -> bool:
        """Take the parts as often as they are all there."""
        times = {p: parts.count(p) for p in parts}
        n = min(int(have[p]) // k for p, k in times.items())
        if n:
            for p, k in times.items():
                have[p] -= n * k
            made.append((sorted(times.items(), reverse=True), n))
        return n > 0

    if have[width]:
        use([width])
    for length in range(width - 1, least - 1, -1):              # single complements
        if have[length] and have[width - length]:
            use([length, width - length])

    def pairs(total: int) -> np.ndarray:
        """The larger parts of available pairs with this sum."""
        larger = np.arange((total + 1) // 2, total)
        there = (have[larger] > 0) & (have[total - larger] > 0)
        there &= (2 * larger != total) | (have[larger] > 1)
        return larger[there][::-1]

    for length in range(width - 1, least - 1, -1):              # pair sums
        gap = width - length
        for a in pairs(gap) if have[length] else ():
            if not have[length]:
                break
            use([length, int(a), gap - int(a)])
    sums = np.zeros(width + 1, bool)                            # index of pair sums; only loses entries from here on
    there = np.nonzero(have > 0)[0]
    for a in there:
        total = a + there
        sums[total[total <= width]] = True
    for length in range(width - 1, least - 1, -1):              # triple sums
        gap = width - length
        if not have[length] or gap < 3:
            continue
        third = np.arange(gap - 2, 0, -1)
        for a in third[(have[third] > 0) & sums[gap - third]]:
            rest = gap - int(a)
            found = pairs(rest)
            if not len(found):
                sums[rest] = False
                continue
            for b in found:
                if not have[length] or not have[a]:
                    break
                use([length, int(a), int(b), rest - int(b)])
            if not have[length]:
                break
    for length in list(counts):
        counts[length] = int(have[length])
    return made


def best_fit_patterns(counts: dict[int, int], width: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing of lengths with counts: bins of one pattern are kept
    as one entry with their number, so the work depends on the lengths only."""
    room: dict[int, list] = {}             # free tokens -> [pattern, bins]
    open_rooms: list[int] = []             # its keys, sorted

    def put(free: int, pattern: list, bins: int):
        if bins:
            if free not in room:
                room[free] = []
                insort(open_rooms, free)
            room[free].append((pattern, bins))

    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        n = counts[length]
        while n:
            i = bisect_left(open_rooms, length)
            if i < len(open_rooms):
                free = open_rooms[i]
                pattern, bins = room[free].pop()
                if not room[free]:
                    del room[free]
                    del open_rooms[i]
            else:
                free, pattern, bins = width, [], n
            fits = free // length
            full = min(bins, n // fits)
            put(free - fits * length, [*pattern, (length, fits)], full)
            n -= full * fits
            bins -= full
            if n and bins:                 # one more bin takes what is left
                put(free - n * length, [*pattern, (length, n)], 1)
                n, bins = 0, bins - 1
            if pattern:
                put(free, pattern, bins)
    return [x for free in room.values() for x in free]


def plan_packing(counts: dict[int, int], width: int = WIDTH) -> Plan:
    """The plan for ``counts`` pieces of each length.  Exact fillings by short
    lengths alone can take away what longer ones need, so they are planned from
    several least lengths on, and the plan with fewest sequences is taken (of
    equal ones that with most exact fillings)."""
    plans = []
    for least in (1, width // 4 + 1, width // 3 + 1, width // 2 + 1, width):
        left = dict(counts)
        plans.append(exact_patterns(left, width, least) + best_fit_patterns(left, width))
    patterns = min(plans, key=lambda plan: sum(bins for _, bins in plan))
    rows, taken, base = [], {}, 0
    for pattern, bins in patterns:
        offset = 0
        for length, times in pattern:
            rows.append((length, taken.get(length, 0), times, base, offset))
            taken[length] = taken.get(length, 0) + bins * times
            offset += length * times
        base += bins
    table = np.array(sorted(rows) or np.empty((0, 5)), np.int64).reshape(-1, 5)
    return Plan(*(np.ascontiguousarray(table[:, i]) for i in range(5)), base)


# ---------------------------------------------------------------- the jobs

def pieces(docs: DataFrame, tokenizer_path: str, text: str = "text", width: int = WIDTH, end_id: int = END_ID,
           keep_ids: bool = False) -> DataFrame:
    """The columns of ``docs`` but the text, once per piece, with ``piece``,
    ``start``, ``length``, ``ids_crc32`` and, if kept, ``ids`` (little-endian
    32-bit)."""
    added = "piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if keep_ids else "")
    taken = [f.split()[0] for f in added.split(", ")]
    rows = with_rest(docs, F.encode(F.col(f"`{text}`"), "UTF-8"), [text, *taken])
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encode = word_tokenizer(tokenizer_path).encode
        for batch in small(batches):
            row, number, crc, start, length, ids = [], [], [], [], [], []

            def out():
                kept = [c.take(pa.array(row, pa.int64())) for c in batch.columns[:-1]]
                made = [pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64())] + ([pa.array(ids, pa.binary())] if keep_ids else [])
                return pa.RecordBatch.from_arrays(kept + made, ["__row", *taken])

            for i, t in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                all_ids = encode(t) + end
                for n, at in enumerate(range(0, len(all_ids), 4 * width)):
                    some = all_ids[at:at + 4 * width]
                    row.append(i)
                    number.append(n)
                    start.append(at // 4)
                    length.append(len(some) // 4)
                    crc.append(zlib.crc32(some))
                    if keep_ids:
                        ids.append(some)
                        if len(ids) >= 2048:           # 32 MB at most
                            yield out()
                            row, number, crc, start, length, ids = [], [], [], [], [], []
            yield out()

    return rest_and(rows.mapInArrow(run, extended(rows.select("__row"), added)), taken)


def pack(made: DataFrame, order: list[Column | str], width: int = WIDTH, length: str = "length",
         part_rows: int = PART_ROWS) -> DataFrame:
    """``made`` (one row per piece; a table that can be read again) with
    ``sequence_id`` and ``offset``.  ``order`` settles which of the pieces of a
    length comes first; pieces equal in it are interchangeable.

    Defined results: an empty table gives an empty result; a length of 0 or
    above ``width`` is an error of the caller."""
    spark = made.sparkSession
    counts = {int(r[0]): int(r[1]) for r in made.groupBy(length).count().collect()}     # width rows at most
    plan = plan_packing(counts, width)
    parts = spark.createDataFrame([(k, -(-n // part_rows)) for k, n in counts.items()] or [(0, 1)],
                                  "__length bigint, __parts bigint")
    salted = (made.join(F.broadcast(parts), F.col(length) == F.col("__length"))
              .withColumn("__part", F.pmod(F.xxhash64(*order), F.col("__parts"))).drop("__length", "__parts"))
    sizes = salted.groupBy(length, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(length).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(length).alias("__l"), F.col("__part").alias("__p"),
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy(length, "__part").orderBy(*order))
    ranked = salted.withColumn("__within", within)
    ranked = ranked.join(starts, (F.col(length) == F.col("__l")) & (F.col("__part") == F.col("__p")))
    ranked = ranked.select(*made.columns, F.col(length).cast("bigint").alias("__length"),
                           (F.col("__start") + F.col("__within") - 1).cast("bigint").alias("__rank"))

    def run(batches):
        for batch in batches:
            n = batch.num_columns
            sequence, offset = plan.place(batch.column(n - 2).to_numpy(), batch.column(n - 1).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(sequence), pa.array(offset)],
                                             [*batch.schema.names[:-2], "sequence_id", "offset"])

    return ranked.mapInArrow(run, extended(made, "sequence_id bigint, offset bigint"))


def pack_documents(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
                   width: int = WIDTH, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece of a document: ``key``, ``piece``, ``start``,
    ``length``, ``ids_crc32`` (and ``ids``), ``sequence_id``, ``offset``.

    Defined results: a null text is packed like an empty one (the end id alone);
    repeated rows and null keys are packed one by one; an empty table gives an
    empty result; columns other than key and text are not read."""
    thin = docs.select(F.col(key).alias("__k"), F.col(text).alias("__t"))
    made = cut_lineage(pieces(thin, tokenizer_path, "__t", width, end_id, keep_ids), "pieces")
    return pack(made, ["__k", "piece", "ids_crc32"], width).withColumnRenamed("__k", key)
