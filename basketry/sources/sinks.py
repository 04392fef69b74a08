"""Sinks: parquet feature tables, fitted models and run parameters, all
written under a shared path and read back by Spark."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_roundtrip(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(model_cls, path: str):
    return model_cls.load(path)


def params_frame(spark: SparkSession, fixed: Mapping[str, object], computed: DataFrame | None = None) -> DataFrame:
    """One row of run parameters: the ``computed`` one-row frame (values
    measured by Spark) plus the ``fixed`` values as literal columns."""
    base = computed if computed is not None else spark.range(1).select()
    return base.select("*", *[F.lit(v).alias(k) for k, v in fixed.items()])


def write_params_json(params: DataFrame, path: str) -> DataFrame:
    """Write the one-row parameter frame as JSON and read it back with the
    same schema."""
    params.coalesce(1).write.mode("overwrite").json(path)
    return params.sparkSession.read.schema(params.schema).json(path)


def params_as_dict(params: DataFrame) -> dict:
    return json.loads(params.toJSON().first())
