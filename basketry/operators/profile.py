"""Table profiling: schema as data, head, literal filters, grouped sums and
counts, describe, null counts, grouped moments, correlations, IQR outliers.

All aggregates are single ``agg`` calls so Spark runs them as one partial +
final aggregation (map-side combine, then a small shuffle) and one scan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schema_report(df: DataFrame) -> DataFrame:
    """The schema as rows ``(ordinal, column_name, data_type, nullable)``."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, column_name string, data_type string, nullable boolean")


def head_rows(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """First ``n`` rows under a total order (a bare ``limit`` is unspecified)."""
    return df.orderBy(*order_by).limit(n)


def filter_equals(df: DataFrame, column: str, literal: str) -> DataFrame:
    """``column == literal`` with the literal converted to the column's type;
    text that does not convert matches nothing instead of failing."""
    target = df.schema[column].dataType
    return df.filter(F.col(column) == F.lit(literal).try_cast(target))


def group_sum_sorted(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    return (df.groupBy(key).agg(F.sum(value).alias(alias))
              .orderBy(F.desc(alias), F.asc(key)))


def class_counts(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row, one column per input column: the number of NULLs (0 on empty input)."""
    return df.select([F.coalesce(F.sum(F.col(c).isNull().cast("int")), F.lit(0)).cast("bigint").alias(c)
                      for c in df.columns])


def describe_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``DataFrame.describe`` (count, mean, stddev, min, max) in long form:
    ``(column_name, statistic, num_value, str_value)``.  Numeric columns fill
    ``num_value``; for text columns count is numeric and min/max are text."""
    cols = list(columns or df.columns)
    wide = df.describe(*cols)
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in
               ("byte", "short", "integer", "long", "float", "double", "decimal")}
    long = wide.unpivot("summary", cols, "column_name", "value")
    is_num = F.col("column_name").isin(list(numeric)) if numeric else F.lit(False)
    as_num = is_num | (F.col("summary") == "count")
    return long.select(
        "column_name",
        F.col("summary").alias("statistic"),
        F.when(as_num, F.col("value").try_cast("double")).alias("num_value"),
        F.when(~as_num, F.col("value")).alias("str_value"),
    )


def group_moments(df: DataFrame, key: str, columns: Mapping[str, str], stddev: bool = True) -> DataFrame:
    """Mean (and sample stddev) per group; ``columns`` maps input -> short name."""
    aggs = [F.avg(c).alias(f"mean_{n}") for c, n in columns.items()]
    if stddev:
        aggs += [F.stddev_samp(c).alias(f"stddev_{n}") for c, n in columns.items()]
    return df.groupBy(key).agg(*aggs)


def label_codes(code: Column | str, mapping: Mapping) -> Column:
    """Map codes to labels with a literal map; unknown codes give NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    c = F.col(code) if isinstance(code, str) else code
    return F.create_map(*pairs)[c]


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation for every ordered pair of distinct columns.  Only the
    unique pairs are aggregated (one pass); the result is mirrored."""
    pairs = list(combinations(columns, 2))
    agg = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    parts = []
    for i, (a, b) in enumerate(pairs):
        parts += [f"'{a}'", f"'{b}'", f"c{i}", f"'{b}'", f"'{a}'", f"c{i}"]
    return agg.selectExpr(f"stack({2 * len(pairs)}, {', '.join(parts)}) as (column_a, column_b, corr)")


def iqr_fences(q1, q3, k: float = 1.5) -> tuple:
    """Lower and upper fence; none without quartiles (an empty column)."""
    if q1 is None or q3 is None:
        return None, None
    iqr = q3 - q1
    return float(q1) - k * float(iqr), float(q3) + k * float(iqr)


_INTEGRAL = ("byte", "short", "integer", "long")


def outside(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows strictly below ``low`` or strictly above ``high``.

    The bounds are literals in the column's own type, so the predicate is
    pushed into the parquet scan (row-group statistics skip whole groups).
    For an integer column x: x < low <=> x < ceil(low) and x > high <=>
    x > floor(high), which avoids casting the column to double.  Without bounds
    nothing lies outside."""
    if low is None or high is None:
        return df.where(F.lit(False))
    if df.schema[column].dataType.typeName() in _INTEGRAL and math.isfinite(low) and math.isfinite(high):
        lo, hi = F.lit(math.ceil(low)).cast("long"), F.lit(math.floor(high)).cast("long")
    else:
        lo, hi = F.lit(low), F.lit(high)
    return df.filter((F.col(column) < lo) | (F.col(column) > hi))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
