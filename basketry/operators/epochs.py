"""Next-item training by epochs of mini-batch gradient steps.

The model scores an item by a bias, a weight for the history's last item and a
weight for each item of the history by its share: softmax over all items, cross
entropy, Adam.  The rows of a mini-batch follow from a hash of the order, and are
read from a folder of their own.  A step is one Spark job: each task adds up the
gradients of its rows, the partial sums are aggregated by row of the parameters,
and the driver, which holds the parameters, takes the step.  The first step of an
epoch also scores the test rows with the parameters the last one left.

Results do not depend on partitions, cores or the order of rows: shares and
parameters enter the products as whole numbers of ``SHARE`` and ``UNIT``, so every
sum is exact in any order, and so are the gradients, which are rounded a row to
``UNIT`` first.

The parameters, (2 V + 1) x V numbers for V items, are what grows: ``MAX_ITEMS``
bounds them, and more items are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.keys import key_bucket
from basketry.session import scratch_path

SHARE = 1 << 12
UNIT = 1 << 22
MAX_ITEMS = 1024
ROWS = 1024                     # rows multiplied at a time: sums of whole numbers stay below 2 ** 53
TEST = -1


def item_table(*seqs: DataFrame, max_items: int = MAX_ITEMS) -> list:
    """The items of the sequences in ascending order, without null; at most ``max_items``."""
    found = seqs[0].select("item")
    for s in seqs[1:]:
        found = found.unionByName(s.select("item"))
    items = [r[0] for r in found.where("item is not null").distinct().limit(max_items + 1).collect()]
    if len(items) > max_items:
        raise ValueError(f"over {max_items} items: the model has a weight for each pair of two")
    return sorted(items)


def basket_features(seq: DataFrame, order_col: str, items: list, batches: int) -> DataFrame:
    """``(part, last, label, places, counts)`` per order of two or more: the places
    in ``items`` of the last history item and of the hidden one, the history's
    places with their counts, and the mini-batch of the order (``TEST`` for rows
    whose ``split`` is 'test').  A null or unknown item has no place; an order
    whose hidden item has none is left out."""
    spark = seq.sparkSession
    kind = seq.schema["item"].dataType
    table = F.broadcast(spark.createDataFrame(list(enumerate(items)), "place int, item string")
                        .select("place", F.col("item").cast(kind).alias("item")))       # at most MAX_ITEMS
    rows = seq.select(F.struct(F.col(order_col).alias("v")).alias("o"), "item", "prev_item", "is_last", "pos", "split")
    named = rows.join(table, "item", "left")
    # counts a place first: an order's list has a row an item at most
    held = (named.where("not is_last and place is not null").groupBy("o", "place").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("o").agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("h")))
    goal = named.where("is_last and pos > 1 and place is not null").select("o", F.col("place").alias("label"), "prev_item", "split")
    last = table.select(F.col("place").alias("last"), F.col("item").alias("prev_item"))
    goal = goal.join(last, "prev_item", "left")
    part = F.when(F.col("split") == "test", F.lit(TEST)).otherwise(
        F.coalesce(key_bucket(F.col("o.v"), batches, seed=11).cast("int"), F.lit(0)))
    return goal.join(held, "o", "left").select(
        part.alias("part"), F.coalesce("last", F.lit(-1)).alias("last"), "label",
        F.coalesce(F.col("h.place"), F.array().cast("array<int>")).alias("places"),
        F.coalesce(F.col("h.n"), F.array().cast("array<bigint>")).alias("counts"))


def _slice_scores(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(x, label, scores)``: the inputs of some rows in units of ``SHARE`` (shares,
    last item, bias), their labels and their scores in ``SHARE * UNIT``, exact."""
    n, v = batch.num_rows, weights.shape[1]
    column = lambda c: batch.column(batch.schema.get_field_index(c))
    x = np.zeros((n, 2 * v + 1))
    places, counts = column("places"), column("counts")
    row = np.repeat(np.arange(n), np.diff(places.offsets.to_numpy()))
    c = counts.flatten().to_numpy().astype(np.float64)
    total = np.bincount(row, c, n)
    x[row, places.flatten().to_numpy()] = np.rint(c / total[row] * SHARE)
    last = column("last").to_numpy()
    known = np.nonzero(last >= 0)[0]
    x[known, v + last[known]] = SHARE
    x[:, 2 * v] = SHARE
    return x, column("label").to_numpy(), x @ weights


def _step_pass(weights: np.ndarray):
    """Partial sums of a task: a row ``(kind, place, sums)`` per row of the gradient
    (kind 0, in ``SHARE * UNIT``), and ``[loss in UNIT, rows]`` and ``[hits, rows]``
    of the training and the test rows (kinds 1 and 2)."""
    v = weights.shape[1]

    def run(batches):
        grad, seen, hits = np.zeros((2 * v + 1, v), np.int64), [0, 0], [0, 0]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                batch = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in batch.columns], batch.schema.names)
                x, label, scores = _slice_scores(batch, weights)
                test = batch.column(batch.schema.get_field_index("part")).to_numpy() == TEST
                hits[0] += int((scores[test].argmax(axis=1) == label[test]).sum())
                hits[1] += int(test.sum())
                x, label, scores = x[~test], label[~test], scores[~test] / (SHARE * UNIT)
                if not len(x):
                    continue
                scores -= scores.max(axis=1, keepdims=True)
                e = np.exp(scores)
                total = e.sum(axis=1)
                own = np.arange(len(x)), label
                seen[0] += int(np.rint((np.log(total) - scores[own]) * UNIT).sum())
                seen[1] += len(x)
                g = e / total[:, None]
                g[own] -= 1
                grad += (x.T @ np.rint(g * UNIT)).astype(np.int64)
        rows = [(0, i, g.tolist()) for i, g in enumerate(grad) if g.any()] + [(1, 0, seen), (2, 0, hits)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                          pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["kind", "place", "sums"])

    return run


def _sums(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
    """Gradient, ``[loss, rows]`` and ``[hits, rows]`` of some rows at ``weights``."""
    parts = rows.mapInArrow(_step_pass(weights), "kind int, place int, sums array<bigint>")
    cells = parts.select("kind", "place", F.posexplode("sums").alias("j", "x"))
    # whole numbers of any size: no order of addition, no overflow
    added = cells.groupBy("kind", "place", "j").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    grad, out = np.zeros(weights.shape), {1: [0, 0], 2: [0, 0]}
    for kind, place, j, x in added.collect():                      # the size of the parameters
        if kind == 0:
            grad[place, j] = float(x)
        else:
            out[kind][j] = int(x)
    return grad / (SHARE * UNIT), out[1], out[2]


def train_epochs(seq: DataFrame, order_col: str, epochs: int = 10, batches: int = 4, learning_rate: float = 0.1,
                 max_items: int = MAX_ITEMS) -> tuple[np.ndarray, list, list[tuple]]:
    """``(weights, items, history)``; ``history`` has ``(epoch, mean_loss, hits, n)``
    per epoch: the mean loss of the training rows as the epoch's steps met them,
    and the hits among the ``n`` test rows after it.  ``seq`` has a ``split``.

    Without items or training rows there are no steps, and the losses are None."""
    items = item_table(seq, max_items=max_items)
    path = scratch_path(seq.sparkSession, "epoch-rows")
    basket_features(seq, order_col, items, batches).write.partitionBy("part").parquet(path)
    rows = seq.sparkSession.read.schema(
        "last int, label int, places array<int>, counts array<bigint>, part int").parquet(path)
    v = len(items)
    weights, first, second, step = np.zeros((2 * v + 1, v)), 0.0, 0.0, 0
    history, losses = [], []
    for epoch in range(epochs):
        loss, n = 0, 0
        for b in range(batches):
            wanted = [b, TEST] if b == 0 and epoch else [b]
            grad, seen, hits = _sums(rows.where(F.col("part").isin(wanted)), weights)
            if b == 0 and epoch:
                history.append((epoch, losses[-1], *hits))
            loss, n = loss + seen[0], n + seen[1]
            if not seen[1]:
                continue
            step += 1
            grad = grad / seen[1]
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad * grad
            move = (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
            weights = np.rint(weights - learning_rate * UNIT * move)
        losses.append(loss / UNIT / n if n else None)
    if epochs:
        history.append((epochs, losses[-1], *_sums(rows.where(F.col("part") == TEST), weights)[2]))
    return weights / UNIT, items, history


def epoch_table(seq: DataFrame, order_col: str, **options) -> DataFrame:
    """``(epoch, mean_loss, hits, n)`` of ``train_epochs`` as rows."""
    history = train_epochs(seq, order_col, **options)[2]
    return seq.sparkSession.createDataFrame(history, "epoch int, mean_loss double, hits bigint, n bigint")
