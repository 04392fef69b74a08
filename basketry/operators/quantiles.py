"""Exact quantiles by distributed selection.

``percentile_disc`` semantics: for probability p over n non-NULL values the
answer is the value of rank ``max(1, ceil(p * n))`` in ascending order
(-inf first, then finite values, +inf, NaN last).

Neither ``approxQuantile(.., 0.0)`` nor ``percentile_disc`` is used: both keep
every distinct value in one aggregation buffer, which does not survive a table
of billions of rows.  Instead each wanted rank is located with partial
aggregates only:

1. one pass: counts (all, NaN, -inf, +inf) - scalar partial aggregates;
2. cut points from ``DataFrame.approxQuantile`` with a coarse error
   (1 / (4 * buckets)): its sketches are merged with a tree aggregate, so no
   single task receives one sketch per partition, and exactness does not
   depend on the cuts - they only need to split the range into pieces;
3. bucket counts between the cut points (``Bucketizer``; values equal to a
   cut point get their own bucket, so a value repeated by a third of all rows
   is resolved at once) narrow every rank to one bucket, again and again, until
   the bucket is one value or has at most ``max_collect`` rows;
4. one pass collects the value histogram of these few rows and reads off the
   ranks.

Values are compared and returned in the column's own type.  Bigints and
decimals are only turned into doubles to place cut points, as distances from the
bucket's smallest value, so ever narrower buckets tell any two values apart.
Only bucket counts and the final small histogram reach the driver.  All wanted
probabilities share the passes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_V, _X = "_qv", "_qx"
MAX_COLLECT = 20_000            # rows of the final histogram: a few hundred kilobytes, whatever the table


def _in_range(lo, hi) -> Column:
    return (F.col(_V) >= F.lit(lo)) & (F.col(_V) <= F.lit(hi))


def _cuts(values) -> list[float]:
    return sorted({float(c) for c in values if c is not None and math.isfinite(c)})


def _bucket_stats(sub: DataFrame, cuts: list[float]) -> list:
    """Rows ``(b, n, lo, hi)`` in value order: bucket 2j-1 holds values whose
    place equals the j-th cut, bucket 2j those strictly between cut j and cut
    j+1 (bucket 0: below the first cut)."""
    splits = [float("-inf"), *cuts, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=_X, outputCol="_j").transform(sub)
    bid = F.col("_j").cast("int") * 2 - F.col(_X).isin(cuts).cast("int")
    return (bucketed.groupBy(bid.alias("b"))
                    .agg(F.count(F.lit(1)).alias("n"), F.min(_V).alias("lo"), F.max(_V).alias("hi"))
                    .orderBy("b").collect())


class _Search:
    """One wanted rank ``k`` (1-based, among finite values) and the closed
    value range known to contain it."""

    def __init__(self, k: int, m: int, lo, hi):
        self.k, self.below, self.m = k, 0, m
        self.lo, self.hi = lo, hi
        self.value = lo if lo == hi else None

    def narrow(self, stats: list) -> None:
        acc = self.below
        for row in stats:
            if acc + row["n"] >= self.k:
                if row["lo"] == row["hi"]:
                    self.value = row["lo"]
                self.below, self.m, self.lo, self.hi = acc, row["n"], row["lo"], row["hi"]
                return
            acc += row["n"]
        raise RuntimeError("rank beyond data")


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], max_collect: int = MAX_COLLECT,
                    buckets: int = 512) -> list:
    """Exact ``percentile_disc`` values for ``probs`` (NULLs ignored), in the
    column's own type; None for an empty column."""
    v, kind = F.col(_V), df.schema[column].dataType
    exact = isinstance(kind, (T.IntegralType, T.DecimalType))
    # room for the distance of any two values
    wide = T.DecimalType(20, 0) if isinstance(kind, T.IntegralType) else kind
    base = df.select((F.col(column) if exact else F.col(column).cast("double")).alias(_V)).where(v.isNotNull())
    odd = [F.lit(False)] * 3 if exact else [F.isnan(v), v == float("-inf"), v == float("inf")]
    is_finite = F.lit(True) if exact else ~F.isnan(v) & (F.abs(v) != float("inf"))
    grid = [i / buckets for i in range(1, buckets)]
    first = base.agg(F.count(F.lit(1)), *[F.count_if(o) for o in odd], F.min(F.when(is_finite, v)),
                     F.max(F.when(is_finite, v))).first()
    n, n_nan, n_ninf, n_pinf, low, high = first
    n_finite = n - n_nan - n_ninf - n_pinf
    finite = base.where(is_finite)

    answers: list = []
    searches: dict[int, _Search] = {}
    for p in probs:
        k = max(1, math.ceil(p * n))
        if n == 0:
            answers.append(None)
        elif k <= n_ninf:
            answers.append(float("-inf"))
        elif k <= n_ninf + n_finite:
            kf = k - n_ninf
            searches.setdefault(kf, _Search(kf, n_finite, low, high))
            answers.append(("rank", kf))
        elif k <= n - n_nan:
            answers.append(float("inf"))
        else:
            answers.append(float("nan"))

    while open_ := [s for s in searches.values() if s.value is None and s.m > max_collect]:
        by_range: dict[tuple, list[_Search]] = {}
        for s in open_:
            by_range.setdefault((s.lo, s.hi), []).append(s)
        for (lo, hi), group in by_range.items():
            place = (v.cast(wide) - F.lit(lo).cast(wide)).cast("double") if exact else v
            sub = finite.where(_in_range(lo, hi)).withColumn(_X, place)
            ends = [0.0, float(hi - lo) / 2, float(hi - lo)] if exact else [lo, lo / 2 + hi / 2, hi]
            cuts = _cuts([*sub.approxQuantile(_X, grid, 1.0 / (4 * buckets)), *ends])
            stats = _bucket_stats(sub, cuts)
            for s in group:
                s.narrow(stats)

    pending = [s for s in searches.values() if s.value is None]
    if pending:
        ranges = {(s.lo, s.hi) for s in pending}
        sub = finite.where(reduce(lambda a, b: a | b, [_in_range(lo, hi) for lo, hi in ranges]))
        hist = sub.groupBy(_V).count().orderBy(_V).collect()       # <= max_collect rows per range
        for s in pending:
            acc = s.below
            for row in hist:
                if not s.lo <= row[_V] <= s.hi:
                    continue
                acc += row["count"]
                if acc >= s.k:
                    s.value = row[_V]
                    break
            else:
                raise RuntimeError("rank not found in histogram")
    return [searches[a[1]].value if isinstance(a, tuple) else a for a in answers]
