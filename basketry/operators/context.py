"""Next-item prediction from the order of the history: a context tree.

A context is a run of up to ``depth`` items that stood right before an item,
the empty one included.  The tree holds, for each context seen in training, how
often each item followed it; a history is predicted by the longest of its last
items' runs that training has seen (back-off down to the empty context), with
the item that followed it most often (ties: the smaller item).

The windows of an item and the items before it come from one grouping on (order,
position), which no single order can make uneven.  Contexts are counted with
partial sums, and test histories of equal last items are one row before they meet
the tree, so neither a hot item nor a hot order is one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import cut_lineage

ITEM = "item"


def item_windows(seq: DataFrame, order_col: str, depth: int) -> DataFrame:
    """``(order, pos, item, is_last, before)`` for each row of a sequence: ``before``
    has the up to ``depth`` items before it in the order, the nearest first."""
    if depth < 0:
        raise ValueError("depth is a number of items, 0 or more")
    far = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("far")
    rows = seq.select(F.col(order_col).alias("o"), "pos", ITEM, "is_last", far)
    held = F.struct("far", F.struct(ITEM).alias("v"), "is_last")
    found = rows.groupBy("o", (F.col("pos") + F.col("far")).alias("at")).agg(F.array_sort(F.collect_list(held)).alias("w"))
    own = F.get("w", F.lit(0))
    return found.where(own["far"] == 0).select(             # places after the last item have none of their own
        F.col("o").alias(order_col), F.col("at").alias("pos"), own["v"][ITEM].alias(ITEM), own["is_last"].alias("is_last"),
        F.transform(F.slice("w", 2, max(depth, 1)), lambda x: x["v"][ITEM]).alias("before"))


def _suffixes(before: Column) -> Column:
    """All contexts that end a history, the empty one first; the nearest item last."""
    return F.transform(F.sequence(F.lit(0), F.size(before)), lambda n: F.reverse(F.slice(before, 1, n)))


def context_counts(windows: DataFrame) -> DataFrame:
    """``(context, item, n)``: how often each item followed each context.  An
    order's first item follows the empty context too."""
    return (windows.select(F.explode(_suffixes(F.col("before"))).alias("context"), ITEM)
            .groupBy("context", ITEM).agg(F.count(F.lit(1)).alias("n")))


def context_topk(counts: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most frequent items after each context, with ``rank`` (ties: the
    smaller item, null first)."""
    order = Window.partitionBy("context").orderBy(F.desc("n"), F.asc(ITEM))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def context_tree(counts: DataFrame) -> DataFrame:
    """``(context, total, best)``: one row a context, with its most frequent item."""
    best = F.min(F.struct((-F.col("n")).alias("m"), ITEM))
    return counts.groupBy("context").agg(F.sum("n").alias("total"), best.alias("b")).select(
        "context", "total", F.col(f"b.{ITEM}").alias("best"))


def hidden_targets(windows: DataFrame) -> DataFrame:
    """``(before, target_item, n)``: the hidden last item of every order of two or
    more, with the last items of its history; equal ones are one row."""
    return (windows.where(F.col("is_last") & (F.size("before") > 0))
            .groupBy("before", F.col(ITEM).alias("target_item")).agg(F.count(F.lit(1)).alias("n")))


def context_predictions(tree: DataFrame, hidden: DataFrame) -> DataFrame:
    """``hidden`` with ``context_len`` (of the longest context that the tree has)
    and ``predicted_item``; both null where the tree is empty."""
    hidden = cut_lineage(hidden, "context-hidden")
    asked = hidden.select("before").distinct().select("before", F.explode(_suffixes(F.col("before"))).alias("context"))
    met = asked.join(tree.select("context", "best"), "context")
    longest = met.groupBy("before").agg(F.max(F.struct(F.size("context").alias("context_len"), F.struct("best").alias("v"))).alias("m"))
    return hidden.join(longest, "before", "left").select(
        "before", "target_item", "n", F.col("m.context_len").alias("context_len"), F.col("m.v.best").alias("predicted_item"))


def context_hit_rate(predictions: DataFrame) -> DataFrame:
    """``(context_len, n_baskets, n_hits, accuracy)`` per length of the context
    used, and for all of them in a row with a null length."""
    hit = F.when(F.col("target_item") == F.col("predicted_item"), F.col("n")).otherwise(0)
    out = predictions.rollup("context_len").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_baskets"),
                                                F.coalesce(F.sum(hit), F.lit(0)).alias("n_hits"))
    return out.withColumn("accuracy", F.try_divide(F.col("n_hits").cast("double"), F.col("n_baskets")))


def next_item_contexts(train: DataFrame, order_col: str, depth: int = 3) -> DataFrame:
    """``context_counts`` of training sequences, written."""
    return cut_lineage(context_counts(item_windows(train, order_col, depth)), "context-counts")
