"""Item embeddings from baskets: implicit-feedback matrix factorisation in
blocks (Spark ML's ALS), and next-item prediction by the factors.

Orders are the rows and items the columns of the factorised counts.  An order
that was not in the fit gets its factors from its history by the same normal
equations that a sweep of the fit solves, with the item factors held fixed; so
test orders need no place in the model, and scoring is one pass over their
histories with the item factors (``MAX_ITEMS`` at most) at hand.

ALS sends each order's factors to the blocks of its items in every sweep.  For
``FEW_ITEMS`` items at most only the first sweep does: in the others a task solves
the orders it has, with the item factors at hand, and adds up the items' normal
equations, so that a sweep shuffles a row an item and part of the orders.

The input's layout and the numbers of blocks follow from the data, not from the
cores, so that the factors do not depend on them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.epochs import basket_features, item_table, TEST
from basketry.session import cut_lineage, discard, fixed_layout, layout_partitions

MAX_ITEMS = 200_000
FEW_ITEMS = 1024                # equations of so many items are added up in a task
PART_ROWS = 500_000             # counts in a part of the orders
SLICE = 1 << 14                 # counts multiplied at a time
BLOCKS = 8


def number_orders(orders: DataFrame, column: str, limit: int = 2**31 - 1) -> DataFrame:
    """``(column, number)``: the distinct values numbered from 0 in their order, by
    a range sort and the sizes of its partitions (a number each)."""
    rows = cut_lineage(orders.select(column).distinct().orderBy(column)
                       .withColumn("_at", F.monotonically_increasing_id()), "order-numbers")
    part = F.shiftright("_at", 33)
    starts, total = [], 0
    for p, n in sorted((r[0], r[1]) for r in rows.groupBy(part).count().collect()):
        starts.append((p, total))
        total += n
    if total > limit:
        raise ValueError(f"{total} orders: ALS numbers its rows up to {limit}; fit on a sample of orders")
    table = rows.sparkSession.createDataFrame(starts or [(0, 0)], "_part long, _start long")
    number = F.col("_start") + F.col("_at") - F.shiftleft(part, 33)
    return rows.withColumn("_part", part).join(F.broadcast(table), "_part").select(column, number.cast("int").alias("number"))


def fit_item_factors(train: DataFrame, order_col: str, items: list, rank: int = 16, sweeps: int = 10,
                     reg: float = 0.05, alpha: float = 4.0, seed: int = 42) -> np.ndarray:
    """One row of ``rank`` factors per place of ``items`` (zeros for an item that no
    order has), fitted to the counts of items per order of ``train``."""
    table = train.sparkSession.createDataFrame(list(enumerate(items)), "place int, item string").select(
        "place", F.col("item").cast(train.schema["item"].dataType).alias("item"))
    counts = train.join(F.broadcast(table), "item").groupBy(order_col, "place").agg(F.count(F.lit(1)).cast("float").alias("n"))
    counts = cut_lineage(counts.where(F.col(order_col).isNotNull()), "factor-counts")
    out = np.zeros((len(items), rank), np.float32)
    if counts.isEmpty():
        return out
    rated = cut_lineage(counts.join(number_orders(counts, order_col), order_col).select("number", "place", "n"), "factor-rows")
    n = rated.count()
    few = len(items) <= FEW_ITEMS
    als = ALS(rank=rank, maxIter=min(sweeps, 1) if few else sweeps, regParam=reg, alpha=alpha, implicitPrefs=True,
              numUserBlocks=BLOCKS, numItemBlocks=BLOCKS, userCol="number", itemCol="place", ratingCol="n", seed=seed)
    for r in als.fit(fixed_layout(rated, "number", layout_partitions(n))).itemFactors.collect():      # items x rank numbers
        out[r["id"]] = r["features"]
    if few and sweeps > 1:
        held = fixed_layout(rated, "number", layout_partitions(n, PART_ROWS)).groupBy("number").agg(
            F.array_sort(F.collect_list(F.struct("place", "n"))).alias("h"))
        held = cut_lineage(held.select(F.spark_partition_id().alias("part"), F.col("h.place").alias("places"),
                                       F.col("h.n").alias("counts")), "factor-orders")
        for _ in range(sweeps - 1):
            out = swept_factors(held, out, reg, alpha)
        discard(held)
    return out


def _equation_pass(factors: np.ndarray, reg: float, alpha: float):
    """``(place, part, sums)``: for each part of the orders and item the sums of
    its normal equation over the orders that have it, ``[matrix, right side, orders]``;
    place -1: the orders' products alone.  An order's factors are single numbers."""
    y = factors.astype(np.float64)
    items, rank = y.shape
    gram = y.T @ y

    def add(total, lengths, places, counts):
        starts = np.cumsum(lengths) - lengths
        row = np.repeat(np.arange(len(lengths)), lengths)
        weight = alpha * counts
        left, right = np.empty((len(lengths), rank, rank)), np.empty((len(lengths), rank))
        for n in np.unique(lengths):                 # orders of as many items at a time
            own = np.nonzero(lengths == n)[0]
            at = starts[own][:, None] + np.arange(n)
            some, w = y[places[at]], weight[at][:, :, None]
            left[own] = gram + (some * w).transpose(0, 2, 1) @ some + reg * n * np.eye(rank)
            right[own] = ((1 + w) * some).sum(axis=1)
        x = np.linalg.solve(left, right[:, :, None])[:, :, 0].astype(np.float32).astype(np.float64)
        total[items, :rank * rank] += (x.T @ x).ravel()
        order = np.argsort(places, kind="stable")
        row, place, weight = row[order], places[order], weight[order]
        cuts = np.concatenate([[0], np.nonzero(np.diff(place))[0] + 1, [len(place)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            own, w = x[row[a:b]], weight[a:b, None]
            total[place[a]] += np.concatenate([((own * w).T @ own).ravel(), ((1 + w) * own).sum(axis=0), [b - a]])

    def rows(part, total):
        some = np.nonzero(total.any(axis=1))[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.where(some == items, -1, some), pa.int32()), pa.array(np.full(len(some), part), pa.int32()),
             pa.array(total[some].tolist(), pa.list_(pa.float64()))], ["place", "part", "sums"])

    def run(batches):
        part, total = None, None
        for batch in batches:
            parts = batch.column(0).to_numpy()
            lists = [batch.column(c) for c in (1, 2)]
            lengths = np.diff(lists[0].offsets.to_numpy())
            places, counts = (c.flatten().to_numpy() for c in lists)
            ends = np.cumsum(lengths)
            cuts = np.nonzero((np.diff(parts) != 0) | (np.diff(ends // SLICE) != 0))[0] + 1
            cuts = [0, *cuts.tolist(), len(parts)] if len(parts) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if parts[a] != part:
                    if total is not None:
                        yield rows(part, total)
                    part, total = parts[a], np.zeros((items + 1, rank * rank + rank + 1))
                at = slice(ends[a] - lengths[a], ends[b - 1])
                add(total, lengths[a:b], places[at], counts[at].astype(np.float64))
        if total is not None:
            yield rows(part, total)

    return run


def _added_pass(batches):
    """Over partitions sorted by place: the sums of each place."""
    place, total = None, None
    for batch in batches:
        out: list = []
        for p, row in zip(batch.column(0).to_pylist(), batch.column(1)):
            if p != place:
                out += [(place, total)] if total is not None else []
                place, total = p, 0.0
            total = total + row.values.to_numpy()
        yield _sum_rows(out)
    yield _sum_rows([(place, total)] if total is not None else [])


def _sum_rows(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                       pa.array([r[1].tolist() for r in rows], pa.list_(pa.float64()))], ["place", "sums"])


def swept_factors(orders: DataFrame, factors: np.ndarray, reg: float, alpha: float) -> np.ndarray:
    """The item factors after a sweep of alternating least squares: the factors of
    ``orders`` (part, places, counts) from those of the items, and from them the
    items' new ones.  Items that no order has keep theirs."""
    sums = orders.mapInArrow(_equation_pass(factors, reg, alpha), "place int, part int, sums array<double>")
    added = (sums.repartition("place").sortWithinPartitions("place", "part").select("place", "sums")
             .mapInArrow(_added_pass, "place int, sums array<double>"))
    found = {r["place"]: np.array(r["sums"]) for r in added.collect()}        # FEW_ITEMS and one at most
    rank, out = factors.shape[1], factors.copy()
    gram = found.pop(-1)[:rank * rank] if found else None
    for place, s in found.items():
        left = (gram + s[:rank * rank]).reshape(rank, rank) + reg * s[-1] * np.eye(rank)
        out[place] = np.linalg.solve(left, s[rank * rank:-1])
    return out


def history_factors(places: list[np.ndarray], counts: list[np.ndarray], factors: np.ndarray, gram: np.ndarray,
                    reg: float, alpha: float) -> np.ndarray:
    """The factors of some histories: with confidence 1 + alpha n for an item that
    stands n times in one and 1 for all others, the least-squares solution."""
    rank = factors.shape[1]
    left, right = np.empty((len(places), rank, rank)), np.empty((len(places), rank))
    for i, (p, n) in enumerate(zip(places, counts)):
        y = factors[p]
        left[i] = gram + (y * (alpha * n)[:, None]).T @ y + reg * max(len(p), 1) * np.eye(rank)
        right[i] = ((1 + alpha * n)[:, None] * y).sum(axis=0)
    return np.linalg.solve(left, right[:, :, None])[:, :, 0]


def factor_ranks(features: DataFrame, factors: np.ndarray, reg: float = 0.05, alpha: float = 4.0) -> DataFrame:
    """``(label, place)`` per row of ``basket_features``: how many items score above
    the hidden one (0: it is predicted), ties to the smaller place."""
    y = factors.astype(np.float64)
    gram = y.T @ y

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                places = [np.array(x, np.int64) for x in batch.column(0).to_pylist()]
                counts = [np.array(x, np.float64) for x in batch.column(1).to_pylist()]
                label = batch.column(2).to_numpy()
                scores = np.round(history_factors(places, counts, y, gram, reg, alpha) @ y.T, 4)
                own = scores[np.arange(len(label)), label][:, None]
                ahead = (scores > own) | ((scores == own) & (np.arange(len(y)) < label[:, None]))
                yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(ahead.sum(axis=1), pa.int64())], ["label", "place"])

    return features.select("places", "counts", "label").mapInArrow(run, "label int, place bigint")


def factor_hit_rates(seq: DataFrame, order_col: str, cut_offs=(1, 5, 10), rank: int = 16, sweeps: int = 10,
                     reg: float = 0.05, alpha: float = 4.0, seed: int = 42, max_items: int = MAX_ITEMS) -> DataFrame:
    """``(k, n_baskets, n_hits, accuracy)``: how often the hidden last item of a
    test order is among the k best by the factors that the training orders give.
    ``seq`` has a ``split``; a history without known items has all factors zero."""
    items = item_table(seq, max_items=max_items)
    factors = fit_item_factors(seq.where("split <> 'test'"), order_col, items, rank, sweeps, reg, alpha, seed)
    test = basket_features(seq.where("split = 'test'"), order_col, items, 1).where(F.col("part") == TEST)
    places = cut_lineage(factor_ranks(test, factors, reg, alpha), "factor-places")
    ks = F.explode(F.array(*[F.lit(int(k)) for k in cut_offs])).alias("k")
    hits = places.select(ks, "place").groupBy("k").agg(
        F.count(F.lit(1)).alias("n_baskets"), F.sum((F.col("place") < F.col("k")).cast("bigint")).alias("n_hits"))
    return hits.withColumn("accuracy", F.try_divide(F.col("n_hits").cast("double"), F.col("n_baskets")))
