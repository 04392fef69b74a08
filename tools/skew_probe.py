"""Stress probe for hot keys (not a registered query).

Re-keys the line items of a test scale so that one order holds about a third
of all rows, then checks that
* the range-partitioned sequencer spreads that order over many tasks and
  gives the same positions / predecessors / last flags as a per-order window;
* chunked baskets and chunked leave-last-out rows never exceed their bound;
and reports timings.

usage: python tools/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from basketry.operators import baskets as B  # noqa: E402
from basketry.operators.sequence import sequence_items, sequence_items_window  # noqa: E402
from basketry.plans import catalog as C  # noqa: E402
from basketry.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    items = C.joined_items(spark, sf).withColumn("orig_order", F.col("order_id"))
    hot = F.pmod(F.xxhash64("orig_order"), F.lit(3)) == 0
    skewed = items.withColumn("order_id", F.when(hot, F.lit(-1)).otherwise(F.col("order_id")))
    sort_cols = ["orig_order", *B.ITEM_ORDER]         # unique within the hot order too
    total = skewed.count()
    hot_rows = skewed.where(F.col("order_id") == -1).count()
    print(f"rows {total}, hot order rows {hot_rows} ({hot_rows / total:.0%})")

    t0 = time.time()
    seq = sequence_items(skewed, "order_id", sort_cols, "department_id", partitions=16)
    seq.write.format("noop").mode("overwrite").save()
    print(f"range sequencer: {time.time() - t0:.1f}s")
    spread = (skewed.repartitionByRange(16, "order_id", *sort_cols)
                    .where(F.col("order_id") == -1).select(F.spark_partition_id().alias("p")).distinct().count())
    print(f"hot order spread over {spread} of 16 range partitions")

    t0 = time.time()
    win = sequence_items_window(skewed, "order_id", sort_cols, "department_id")
    win.write.format("noop").mode("overwrite").save()
    print(f"window sequencer: {time.time() - t0:.1f}s (the hot order is one task's work)")
    cols = ["order_id", *sort_cols, "item", "pos", "prev_item", "is_last"]
    diff = seq.select(cols).exceptAll(win.select(cols)).count() + win.select(cols).exceptAll(seq.select(cols)).count()
    print(f"rows differing between the two: {diff}")

    t0 = time.time()
    chunks = B.build_basket_chunks(skewed, {"items": "department_id"}, 5000, sort_cols=sort_cols, partitions=16)
    biggest = chunks.agg(F.max(F.size("items"))).first()[0]
    n_hot = chunks.where(F.col("order_id") == -1).count()
    print(f"chunked baskets: largest row {biggest} items, hot order in {n_hot} rows, {time.time() - t0:.1f}s")

    t0 = time.time()
    llo = B.leave_last_out_chunks(skewed, {"items": "department_id"}, 5000, sort_cols=sort_cols, partitions=16)
    biggest = llo.agg(F.max(F.size("items"))).first()[0]
    hot_hist = llo.where((F.col("order_id") == -1) & (F.col("part") == "history")).agg(F.sum(F.size("items"))).first()[0]
    print(f"chunked leave-last-out: largest row {biggest} items, hot history {hot_hist} items "
          f"(= hot rows - 1: {hot_hist == hot_rows - 1}), {time.time() - t0:.1f}s")


if __name__ == "__main__":
    main()
