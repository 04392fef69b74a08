"""Ordered item sequences: one row per item with its 1-based position in its
group, its predecessor's value and whether it is the group's last item.

``sequence_items`` is built for skewed groups.  A ``Window.partitionBy(group)``
would send every row of a group to one task, so a single order holding a
third of all rows would be one task's work.  Instead:

1. ``repartitionByRange`` on the full sort key (group + in-group order).  The
   range bounds are sampled, so a hot group is split across many
   partitions, each holding a contiguous run of it.
2. Inside each partition (already sorted), a vectorised Arrow pass computes
   the local position, the local predecessor and a local is-last flag.  It
   streams Arrow batches and carries one row between batches, so memory does
   not grow with the partition, and values keep their types (64-bit ids next
   to NULLs stay exact).
3. The first and last rows of the partitions (two each) tell, per partition,
   the position offset of a group that started in earlier partitions, the
   predecessor of the partition's first row and whether its last row really
   ends its group.  Windows over these few rows compute that, and a join on the
   partition id applies it.

The Arrow pass's output is written once under the shared checkpoint folder
(``cut_lineage``): the edge summary and the final projection both read it, so
the shuffle and the pass run once.

``sequence_items_window`` is the plain window formulation with the same
output, kept as the baseline implementation for tests.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import cut_lineage

def sequence_items_window(items: DataFrame, group_col: str, sort_cols: Sequence[str], item_col: str,
                          out_item: str = "item", carry: Sequence[str] = ()) -> DataFrame:
    """``(group, <sort cols>, item, <carry>, pos, prev_item, is_last)`` with a window per group."""
    w = Window.partitionBy(group_col).orderBy(*sort_cols)
    base = items.select(group_col, *sort_cols, F.col(item_col).alias(out_item), *carry)
    return base.select(
        "*",
        F.row_number().over(w).cast("bigint").alias("pos"),
        F.lag(out_item).over(w).alias("prev_item"),
        F.lead(F.lit(1)).over(w).isNull().alias("is_last"),
    )


def _differs(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Element-wise ``a != b`` with NULL equal to NULL and NaN to NaN, in Arrow:
    64-bit ids stay whole numbers."""
    out = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    out = out | (pc.is_null(a).to_numpy(zero_copy_only=False) != pc.is_null(b).to_numpy(zero_copy_only=False))
    if pa.types.is_floating(a.type):
        out &= ~pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False).to_numpy(zero_copy_only=False)
    return out


def _local_pass(group_col: str, item_col: str):
    """Per-partition Arrow pass over rows sorted by (group, order keys)."""

    def run(batches):
        pid = TaskContext.get().partitionId()
        held = None          # last row of the previous batch; its is-last flag is still open
        state = None         # (group, local position, item) of the held row; group and item as arrays of one
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            g, items = batch.column(batch.schema.get_field_index(group_col)), batch.column(batch.schema.get_field_index(item_col))
            starts = np.empty(n, dtype=bool)
            starts[0] = state is None or bool(_differs(g.slice(0, 1), state[0])[0])
            starts[1:] = _differs(g.slice(1), g.slice(0, n - 1))
            idx = np.arange(n)
            lpos = idx - np.maximum.accumulate(np.where(starts, idx, 0)) + 1
            if not starts[0]:
                lpos[: (np.argmax(starts) if starts.any() else n)] += state[1]
            before = state[2] if state is not None else pa.nulls(1, items.type)
            prev = pc.if_else(pa.array(~starts), pa.concat_arrays([before, items.slice(0, n - 1)]), pa.scalar(None, items.type))
            last_local = np.append(starts[1:], False)           # the last one is decided by the next row
            p_first = np.zeros(n, dtype=bool)
            p_first[0] = state is None
            done = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, pid, np.int32)), pa.array(lpos), prev, pa.array(last_local),
                 pa.array(p_first), pa.array(np.zeros(n, dtype=bool))],
                [*batch.schema.names, "_pid", "_lpos", "prev_item", "_last_local", "_p_first", "_p_last"])
            if held is not None:
                yield _flagged(held, "_last_local", bool(starts[0]))
            if n > 1:
                yield done.slice(0, n - 1)
            held = done.slice(n - 1)
            state = (g.slice(n - 1), int(lpos[-1]), items.slice(n - 1))
        if held is not None:
            yield _flagged(_flagged(held, "_last_local", True), "_p_last", True)

    return run


def _flagged(batch: pa.RecordBatch, column: str, value: bool) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index(column), column, pa.array([value]))


def _edge_fixes(local: DataFrame, group_col: str, item_col: str) -> DataFrame:
    """Per partition, from the first and last rows of all of them: the group of
    its first row with its position offset and predecessor, and whether its
    last row ends its group.  A group that goes on over several partitions has
    one last row in each of them but the final one; windows over these rows
    (one partition id each) give the sums, so nothing comes to the driver."""
    group = F.struct(F.col(group_col).alias("g"))          # a struct: NULL is a group like any other
    ends = local.where("_p_last").select("_pid", group.alias("_grp"), "_lpos", F.struct(F.col(item_col).alias("v")).alias("_item"))
    starts = local.where("_p_first").select("_pid", group.alias("_grp"))
    both = (ends.withColumn("_kind", F.lit(1))
            .unionByName(starts.withColumn("_kind", F.lit(0)), allowMissingColumns=True))
    order = Window.partitionBy("_grp").orderBy("_pid", "_kind")
    marked = both.select(
        "_pid", "_grp", "_kind",
        F.coalesce(F.sum("_lpos").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.last("_item", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.lead("_pid").over(order).isNull().alias("_ends"))
    first = marked.where("_kind = 0").select("_pid", F.col("_grp.g").alias("_fix_group"), F.col("_offset").alias("_fix_offset"),
                                             F.col("_before.v").alias("_fix_prev"))
    last = marked.where("_kind = 1").select("_pid", F.col("_ends").alias("_fix_last"))
    return first.join(last, "_pid")


def sequence_items(items: DataFrame, group_col: str, sort_cols: Sequence[str], item_col: str,
                   out_item: str = "item", partitions: int | None = None, carry: Sequence[str] = (),
                   keep_sort_cols: bool = True, strategy: str = "range") -> DataFrame:
    """``(group, <sort cols>, item, <carry>, pos, prev_item, is_last)``, skew-safe.

    ``(group, sort_cols)`` must be unique, so the in-group order is total;
    ``carry`` columns are passed through unchanged.  With
    ``keep_sort_cols=False`` the sort columns are dropped right after the
    sort (``pos`` carries the order), which shrinks the Arrow pass and the
    materialised table.  ``strategy="window"`` uses the per-group window
    instead: about half the cost, but only for data whose largest group is
    known to fit one task.
    """
    if strategy == "window":
        out = sequence_items_window(items, group_col, sort_cols, item_col, out_item, carry)
        return out if keep_sort_cols else out.drop(*sort_cols)
    if strategy != "range":
        raise ValueError(f"unknown strategy {strategy!r}")
    spark = items.sparkSession
    keys = [group_col, *sort_cols]
    base = items.select(*keys, F.col(item_col).alias(out_item), *carry)
    item_type = base.schema[out_item].dataType
    # without an explicit count the range exchange uses spark.sql.shuffle.partitions
    # and AQE may coalesce neighbouring ranges; the stitching below works on
    # whatever contiguous, ordered partitions result
    ranged = (base.repartitionByRange(partitions, *keys) if partitions else base.repartitionByRange(*keys))
    ranged = ranged.sortWithinPartitions(*keys)
    if not keep_sort_cols:        # a projection keeps the sorted order
        keys = [group_col]
        base = base.select(group_col, out_item, *carry)
        ranged = ranged.select(group_col, out_item, *carry)
    out_schema = T.StructType(base.schema.fields + [
        T.StructField("_pid", T.IntegerType()), T.StructField("_lpos", T.LongType()),
        T.StructField("prev_item", item_type), T.StructField("_last_local", T.BooleanType()),
        T.StructField("_p_first", T.BooleanType()), T.StructField("_p_last", T.BooleanType()),
    ])
    local = cut_lineage(ranged.mapInArrow(_local_pass(group_col, out_item), out_schema), "sequence")
    # a row per partition, written: its size is known when the join is planned
    fixes = cut_lineage(_edge_fixes(local, group_col, out_item), "sequence-edges")
    joined = local.join(fixes, "_pid", "left")
    in_first_group = F.col(group_col).eqNullSafe(F.col("_fix_group"))
    return joined.select(
        *keys, out_item, *carry,
        (F.col("_lpos") + F.when(in_first_group, F.col("_fix_offset")).otherwise(F.lit(0))).alias("pos"),
        F.when(F.col("_p_first"), F.col("_fix_prev")).otherwise(F.col("prev_item")).alias("prev_item"),
        F.when(F.col("_p_last"), F.col("_fix_last")).otherwise(F.col("_last_local")).alias("is_last"),
    )
