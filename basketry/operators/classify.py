"""Supervised classification: features, deterministic splits, random forest,
accuracy (two routes) and confusion matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.keys import key_bucket
from basketry.session import fixed_layout, layout_partitions


def split_bucket(key: Column | str, seed: int = 42) -> Column:
    """A bucket in [0, 100) from an integer key (see ``functions.keys``)."""
    return key_bucket(key, 100, seed)


def hash_split(df: DataFrame, key: str, test_percent: int = 20, seed: int = 42, out: str = "split") -> DataFrame:
    """Label rows 'train'/'test' from their key alone: reproducible, and
    independent of partitioning (unlike ``randomSplit``)."""
    return df.withColumn(out, F.when(split_bucket(key, seed) < test_percent, F.lit("test")).otherwise(F.lit("train")))


def predicate_split(df: DataFrame, is_test: Column, out: str = "split") -> DataFrame:
    """Label rows 'test' where ``is_test`` holds and 'train' elsewhere (also
    where it is NULL): a split by file, date or any other property of the row."""
    return df.withColumn(out, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def random_split_stable(df: DataFrame, key: str, weights: Sequence[float], seed: int = 42,
                        partitions: int | None = None) -> list[DataFrame]:
    """``randomSplit`` after fixing the layout (hash partition + sort on the
    key), so that the same seed gives the same split on any input layout and
    number of cores.  ``partitions`` defaults to a number from the row count."""
    n = partitions or layout_partitions(df.count())
    return fixed_layout(df, key, n).randomSplit(list(weights), seed=seed)


def text_shape_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Four numeric text-shape features: characters, words, lines and
    non-ASCII characters."""
    t = F.col(text_col)
    return docs.withColumns({
        "f_chars": F.length(t).cast("double"),
        "f_words": F.regexp_count(t, F.lit(r"\S+")).cast("double"),   # counts without building a word array
        "f_lines": (F.regexp_count(t, F.lit("\n")) + 1).cast("double"),
        "f_non_ascii": F.regexp_count(t, F.lit(r"[^\x00-\x7F]")).cast("double"),   # no rewritten copy of the text
    })


FEATURES = ("f_chars", "f_words", "f_lines", "f_non_ascii")


def assemble(df: DataFrame, columns: Sequence[str] = FEATURES, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="keep").transform(df)


def index_labels(df: DataFrame, label_col: str, out: str = "label") -> tuple[DataFrame, list[str]]:
    """Label strings -> 0..k-1 in alphabetical order (deterministic)."""
    model = StringIndexer(inputCol=label_col, outputCol=out, stringOrderType="alphabetAsc").fit(df)
    return model.transform(df), list(model.labels)


def fit_random_forest(train: DataFrame, label_col: str = "label", features_col: str = "features",
                      num_trees: int = 100, seed: int = 42, layout_key: str | None = None,
                      layout_parts: int | None = None):
    """Random forest.  Trees draw their samples per partition, so with
    ``layout_key`` the rows are put into a layout that follows from their number
    (or is given): the same forest on any number of cores.  ``train`` should be
    a written table; Spark ML keeps its own copy of it while it iterates."""
    data = train
    if layout_key is not None:
        data = fixed_layout(train, layout_key, layout_parts or layout_partitions(train.count()))
    rf = RandomForestClassifier(labelCol=label_col, featuresCol=features_col, numTrees=num_trees, seed=seed)
    return rf.fit(data.select(label_col, features_col))


def evaluator_accuracy(predictions: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> float:
    return MulticlassClassificationEvaluator(labelCol=label_col, predictionCol=prediction_col,
                                             metricName="accuracy").evaluate(predictions)


def accuracy_table(predictions: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """One row: ``n``, ``n_correct``, ``accuracy`` (a fraction) and ``accuracy_pct``."""
    hit = (F.col(label_col) == F.col(prediction_col)).cast("bigint")
    out = predictions.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(hit), F.lit(0)).cast("bigint").alias("n_correct"))
    acc = F.try_divide(F.col("n_correct").cast("double"), F.col("n"))     # NULL when there are no rows
    return out.select("n", "n_correct", acc.alias("accuracy"), (acc * 100).alias("accuracy_pct"))


def confusion_matrix(predictions: DataFrame, label_col: str, prediction_col: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``; pairs that never occur are absent."""
    return (predictions.groupBy(label_col, prediction_col).agg(F.count(F.lit(1)).alias("n"))
                       .orderBy(label_col, prediction_col))
