"""Next-item prediction over ordered baskets.

Two models, both trained on the 'train' orders and scored on the last item of
each 'test' basket (the basket's earlier items are its history):

* transition model - first-order counts ``prev -> next`` over consecutive
  items of the training baskets; the prediction for a history is the most
  frequent successor of its last item (ties: smallest item id), falling back
  to the most frequent successor overall when the last item was never seen;
* classifier - multinomial logistic regression on the history's item counts
  plus a one-hot of its last item.

Everything works on the long form produced by ``sequence.sequence_items``
(one row per item with its position, predecessor and an is-last flag), so
no step needs a whole basket in one place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import cut_lineage

ITEM, PREV = "item", "prev_item"


def transition_counts(seq: DataFrame) -> DataFrame:
    """``(prev_item, item, n)`` over consecutive pairs (partial aggregation)."""
    return (seq.where(F.col(PREV).isNotNull())
               .groupBy(PREV, ITEM).agg(F.count(F.lit(1)).alias("n")))


def top_next(counts: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` successors per item with rank (ties: smallest item).  Each
    window group holds at most one row per distinct successor."""
    w = Window.partitionBy(PREV).orderBy(F.desc("n"), F.asc(ITEM))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def targets(seq: DataFrame, order_col: str) -> DataFrame:
    """For every basket of two or more items: the hidden last item and the
    last item of its history ``(order, context_item, target_item)``."""
    return (seq.where(F.col("is_last") & F.col(PREV).isNotNull())
               .select(order_col, F.col(PREV).alias("context_item"), F.col(ITEM).alias("target_item")))


def transition_predictions(train_seq: DataFrame, test_seq: DataFrame, order_col: str) -> DataFrame:
    """``(order, context_item, target_item, predicted_item)`` for the test baskets."""
    counts = transition_counts(train_seq)
    best = top_next(counts, 1).select(F.col(PREV).alias("context_item"), F.col(ITEM).alias("best_next"))
    overall = (counts.groupBy(ITEM).agg(F.sum("n").alias("n"))
                     .orderBy(F.desc("n"), F.asc(ITEM)).limit(1).collect())
    fallback = F.lit(overall[0][ITEM] if overall else None)
    scored = targets(test_seq, order_col).join(best, "context_item", "left")
    return scored.select(order_col, "context_item", "target_item",
                         F.coalesce(F.col("best_next"), fallback.cast(best.schema["best_next"].dataType))
                          .alias("predicted_item"))


def hit_rate(predictions: DataFrame, label_col: str = "target_item", prediction_col: str = "predicted_item") -> DataFrame:
    hit = (F.col(label_col) == F.col(prediction_col)).cast("bigint")
    out = predictions.agg(F.count(F.lit(1)).alias("n_baskets"),
                          F.coalesce(F.sum(hit), F.lit(0)).cast("bigint").alias("n_hits"))
    # NULL accuracy for no baskets (a plain division fails under ANSI mode)
    return out.withColumn("accuracy", F.try_divide(F.col("n_hits").cast("double"), F.col("n_baskets")))


MAX_ITEMS = 4096                # the classifier has 2 (V + 1) weights for each of V items


def item_index(*seqs: DataFrame, max_items: int = MAX_ITEMS) -> StringIndexerModel:
    """Index of the item ids that occur in the sequences: 0..V-1 by their text.
    Ids can be any numbers; the width of the features and of the model follows
    from how many there are, and more than ``max_items`` are an error."""
    items = reduce(DataFrame.unionByName, [s.select(F.col(ITEM).cast("string").alias("_item")) for s in seqs]).distinct()
    if items.limit(max_items + 1).count() > max_items:
        raise ValueError(f"over {max_items} items: use the transition model or the context tree")
    return StringIndexer(inputCol="_item", outputCol="_index", stringOrderType="alphabetAsc",
                         handleInvalid="keep").fit(items.where(F.col("_item").isNotNull()))


def _indexed(df: DataFrame, column: str, index: StringIndexerModel, out: str) -> DataFrame:
    """``df`` with the index of an item column (V for an unknown or NULL id)."""
    model = StringIndexerModel.from_labels(list(index.labels), inputCol="_text", outputCol=out, handleInvalid="keep")
    return model.transform(df.withColumn("_text", F.col(column).cast("string"))).drop("_text")


def _counts_vector(counts, width: int):
    """A vector of ``width`` places from an array of ``(_i, n)``: the numbers in
    order of their places with the zeros between them."""
    zeros = lambda upto, made: F.array_repeat(F.lit(0.0), upto - F.size(made))
    return array_to_vector(F.aggregate(
        F.sort_array(counts), F.array().cast("array<double>"),
        lambda made, x: F.concat(made, zeros(x["_i"], made), F.array(x["n"])),
        lambda made: F.concat(made, zeros(F.lit(width), made))))


def history_features(seq: DataFrame, order_col: str, index: StringIndexerModel) -> DataFrame:
    """One row per basket of two or more items: ``features`` = counts of each
    item in the history, then a one-hot of the last history item; ``label`` =
    the index of the hidden last item.

    Items are counted per basket and place first (partial counts map-side, so a
    large basket is many tasks' work), and the row of the hidden item goes with
    its count: a basket's list then has a row a place at most, and its vector,
    of the index's width, is made in the JVM in the same pass.  A basket without
    an order id is kept like any other."""
    width = len(index.labels) + 1
    named = _indexed(_indexed(seq.select(order_col, ITEM, PREV, "is_last"), ITEM, index, "_i"), PREV, index, "_c")
    goal = F.when(F.col("is_last") & F.col(PREV).isNotNull(), F.struct(
        F.col(PREV).alias("context_item"), F.col(ITEM).alias("target_item"), F.col("_c"), F.col("_i").alias("label")))
    counts = named.groupBy(order_col, F.col("_i").cast("int").alias("_i")).agg(
        F.sum(F.when(F.col("is_last"), 0.0).otherwise(1.0)).alias("n"), F.max(goal).alias("goal"))
    both = counts.groupBy(order_col).agg(
        F.collect_list(F.when(F.col("n") > 0, F.struct("_i", "n"))).alias("_held"), F.max("goal").alias("goal"))
    made = both.where("goal is not null").select(
        order_col, "goal.context_item", "goal.target_item", _counts_vector(F.col("_held"), width).alias("_counts"),
        _counts_vector(F.array(F.struct(F.col("goal._c").cast("int").alias("_i"), F.lit(1.0).alias("n"))), width).alias("_context"),
        "goal.label")
    # the sizes are told: the assembler would run the job for its first row to see them
    for c in ("_counts", "_context"):
        made = VectorSizeHint(inputCol=c, size=width, handleInvalid="optimistic").transform(made)
    made = VectorAssembler(inputCols=["_counts", "_context"], outputCol="features").transform(made)
    return made.select(order_col, "context_item", "target_item", "features", "label")


def fit_classifier(train_feats: DataFrame, max_iter: int = 50, reg_param: float = 0.01):
    """Multinomial logistic regression on ``history_features`` rows."""
    data = cut_lineage(train_feats.select("features", "label"))
    lr = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg_param,
                            featuresCol="features", labelCol="label")
    return lr.fit(data)


def classifier_predictions(model, feats: DataFrame, order_col: str, index: StringIndexerModel) -> DataFrame:
    """``(order, context_item, target_item, predicted_item)``."""
    scored = model.transform(feats)
    named = IndexToString(inputCol="prediction", outputCol="_name", labels=list(index.labels)).transform(scored)
    return named.select(order_col, "context_item", "target_item",
                        F.col("_name").cast(feats.schema["target_item"].dataType).alias("predicted_item"))


def loss_history(model) -> list[float]:
    return list(model.summary.objectiveHistory)
