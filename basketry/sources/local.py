"""Driver-side frames, for results that are small by their definition.

``to_pandas`` brings a whole result to the driver as pandas (Spark's own
``spark.driver.maxResultSize`` stops one that is too large for it);
``from_pandas`` / ``from_rows`` build Spark frames from such results, with an
explicit schema where one is given.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def to_pandas(df: DataFrame) -> pd.DataFrame:
    return df.toPandas()


def from_pandas(spark: SparkSession, pdf: pd.DataFrame, schema: StructType | str | None = None) -> DataFrame:
    return spark.createDataFrame(pdf, schema=schema)


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema=schema)
