"""Explicit partition control (round-robin repartition) and its report."""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _count_pass(batches):
    rows = sum(b.num_rows for b in batches)
    yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([rows], pa.int64())],
                                     ["pid", "rows"])


def repartition_report(df: DataFrame, n: int) -> DataFrame:
    """Repartition round-robin into ``n`` partitions and report
    ``(n_partitions, n_rows, max_rows_per_partition, min_rows_per_partition)``;
    every partition reports itself, empty ones too.

    Only a constant crosses the exchange, but once for every row: each of the
    ``n`` reducers receives 1/n of them.  Choose ``n`` from the data volume
    (``session.recommended_conf``); a small fixed ``n`` is for small inputs."""
    per = df.select(F.lit(True).alias("x")).repartition(n).mapInArrow(_count_pass, "pid int, rows bigint")
    return per.agg(F.count(F.lit(1)).cast("bigint").alias("n_partitions"),
                   F.sum("rows").cast("bigint").alias("n_rows"),
                   F.max("rows").alias("max_rows_per_partition"),
                   F.min("rows").alias("min_rows_per_partition"))
