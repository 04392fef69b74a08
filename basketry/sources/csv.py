"""CSV scans in the two modes the workload uses.

* inferred types: ``header`` + ``inferSchema`` (an extra pass over the files);
* all strings, then explicit casts: ids go through ``try_cast`` so that a bad
  value becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").csv(path)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast string columns with ``try_cast`` (invalid text -> NULL)."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})
