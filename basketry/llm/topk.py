"""Exact top-k search by columnar branch-and-bound.

Vectors are whole numbers (floor of 256 times each component).  Candidates lie in
blocks of at most ``BLOCK`` vectors, stored by dimension.  For a query, scores are
accumulated some dimensions at a time; by Cauchy-Schwarz the rest of a score lies
within the product of the two remaining lengths.  Candidates whose upper bound is
below the k-th best lower bound are out, and the survivors are compacted before
the next dimensions are read.  The bounds only ever discard what cannot be among
the k best, so the result is exact.

Queries are dealt into blocks, too, and each block of queries meets each group of
candidate blocks in one task of bounded size: queries are a stated set of the
rows, and their number times the number of candidates is the work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import cut_lineage

BLOCK = 8192
QUERY_BLOCK = 1024
STEP = 16                        # dimensions read at a time
LONG_MAX, LONG_MIN = (1 << 63) - 1, -(1 << 63)


def usable(vector: str) -> Column:
    """Whether a vector is not null, not empty and all its components finite."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite


def as_matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, dims))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def whole_numbers(rows: np.ndarray) -> np.ndarray:
    return np.floor(rows * 256)


def _safe(rows: np.ndarray, queries: np.ndarray) -> bool:
    """Whether every partial sum is a whole number that a double holds."""
    top = lambda a: float(np.abs(a).max(initial=0))
    return top(rows) * top(queries) * max(1, rows.shape[1]) < 2.0 ** 52


def _rest_lengths(rows: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Length of each row from each cut on, rounded up."""
    squares = [(rows[:, a:] ** 2).sum(axis=1) for a in cuts]
    return np.sqrt(np.array(squares).reshape(len(cuts), len(rows))) * (1 + 1e-12)


def best_k(rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
           step: int = STEP) -> list[tuple[int, int, int]]:
    """(query id, id, score) of each query's k best rows, ties to smaller ids, a
    row never matching its own id; rows come as doubles with whole values."""
    if not len(rows) or not len(queries):
        return []
    if not _safe(rows, queries):
        return _best_k_large(rows, ids, queries, query_ids, k)
    order = np.argsort(-(np.abs(rows).mean(axis=0)), kind="stable")        # dimensions with most mass first
    columns = np.ascontiguousarray(rows[:, order].T)
    queries = queries[:, order]
    cuts = list(range(0, rows.shape[1], step))
    rest = _rest_lengths(columns.T, cuts[1:])
    query_rest = _rest_lengths(queries, cuts[1:])
    out = []
    first = queries[:, :step] @ columns[:step]
    for q, own in enumerate(query_ids):
        left = np.nonzero(ids != own)[0]
        score = first[q, left]
        for c, at in enumerate(cuts[1:]):
            if len(left) > k:
                slack = rest[c, left] * query_rest[c, q]
                low = score - slack
                kth = np.partition(low, len(low) - k)[len(low) - k]
                stay = score + slack >= kth
                if not stay.all():
                    left, score = left[stay], score[stay]
            score = score + queries[q, at:at + step] @ columns[at:at + step, left]
        if len(left) > k:
            kth = np.partition(score, len(score) - k)[len(score) - k]
            stay = score >= kth
            left, score = left[stay], score[stay]
        best = np.lexsort((ids[left], -score))[:k]
        out += [(int(own), int(ids[left[i]]), int(score[i])) for i in best]
    return out


def _best_k_large(rows, ids, queries, query_ids, k):
    """The same in Python's whole numbers, for components whose products leave
    a double; scores outside a bigint become its largest or smallest value."""
    exact = [[int(x) for x in row] for row in rows]
    out = []
    for query, own in zip(queries, query_ids):
        q = [int(x) for x in query]
        scores = [(-sum(a * b for a, b in zip(row, q)), int(i)) for row, i in zip(exact, ids) if i != own]
        out += [(int(own), i, max(LONG_MIN, min(LONG_MAX, -s))) for s, i in sorted(scores)[:k]]
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, key, score)``: for every row that ``is_query`` holds
    for, the k rows (all, if fewer) of other keys with the highest inner product
    of floor(256 x), ties to the smaller key.

    Defined results: vectors that are null, empty or hold a null or non-finite
    component take no part, nor do rows with a null key; a shorter vector counts
    as filled with zeros; of rows with one key that are all candidates each is
    one, and equal (query, key, score) rows are one; scores outside a bigint are
    its largest or smallest value; an empty table gives an empty result."""
    rows = (vectors.where(usable(vector) & F.col(key).isNotNull())
            .select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"),
                    F.coalesce(is_query, F.lit(False)).alias("ask")).distinct())
    rows = cut_lineage(rows, "topk-vectors")
    n, dims, asks = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if("ask")).first()
    blocks, ask_blocks = max(1, -(-n // block)), max(1, -(-asks // query_block))
    spot = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 40))
    # every pair (block of queries, block of candidates) is a group of bounded size
    given = (rows.withColumn("c", F.pmod(spot, F.lit(blocks))).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(ask_blocks - 1))))
             .select(F.lit(False).alias("asks"), "q", "c", "id", "v"))
    asked = (rows.where("ask").withColumn("q", F.pmod(spot, F.lit(ask_blocks)))
             .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select(F.lit(True).alias("asks"), "q", F.col("c").cast("bigint").alias("c"), "id", "v"))
    both = given.select("asks", F.col("q").cast("bigint").alias("q"), "c", "id", "v").unionByName(asked)
    width = int(dims or 0)

    def run(table: pa.Table) -> pa.Table:
        asks_here = np.array(table.column("asks").to_pylist(), bool)
        ids = table.column("id").to_numpy()
        x = whole_numbers(as_matrix(table.column("v"), width))
        found = best_k(x[~asks_here], ids[~asks_here], x[asks_here], ids[asks_here], k)
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.int64())})

    found = both.groupBy("q", "c").applyInArrow(run, "query_id bigint, id bigint, score bigint").distinct()
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(
        (-F.col("score").cast("decimal(20,0)")).alias("less"), "id", "score"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("col.id").alias(key), F.col("col.score").alias("score"))


ORACLE = """
WITH parts AS (SELECT vec_id, generate_subscripts(embedding, 1) AS d, unnest(embedding) AS x FROM embeddings),
good AS (SELECT vec_id FROM parts GROUP BY vec_id HAVING count(*) = count(x) AND bool_and(isfinite(x))),
whole AS (SELECT vec_id, d, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS w FROM parts SEMI JOIN good USING (vec_id)),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
           FROM whole q JOIN whole c ON q.d = c.d AND q.vec_id <> c.vec_id
           WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scores)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""
