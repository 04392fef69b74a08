"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall-clock seconds.

Each query is fully executed (``write`` to the no-op sink format), so the
timing covers the whole plan without pulling rows into the driver.  Every
query runs twice; ``queries`` reports the faster (warm) run and
``first_run`` the first one, which includes JIT / code-generation warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.plans.catalog import QUERIES  # noqa: E402
from basketry.session import build_session, recommended_conf, release_scratch  # noqa: E402

HEADLINE = (
    "baskets", "leave_last_out", "leave_last_out_long", "leave_last_out_chunks", "basket_chunks",
    "order_items_join_products",
    "max_ids_from_arrays",
    "describe_table", "correlation_pairs", "quartiles_exact", "iqr_outliers", "group_mean_stddev",
    "text_clean_documents", "tfidf_top_words_documents", "tfidf_fixed_vocab",
    "nearest_centroid", "next_item_transition_eval", "kmeans_clusters", "rf_accuracy",
    "next_item_classifier_accuracy", "next_item_virtual_classifier_accuracy", "model_save_reload",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(HEADLINE)
    input_bytes = sum(p.stat().st_size for p in Path(sf_dir).glob("*.parquet"))
    conf = recommended_conf(input_bytes, cpus)
    event_dir = os.environ.get("BENCH_EVENT_LOG")      # optional: stage timings via tools/stage_times.py
    if event_dir:
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(conf.pop("spark.sql.shuffle.partitions")),
                          extra={**conf, "spark.driver.memory": "16g"})
    # warm the JVM (class loading, codegen paths) and the Python workers
    # outside the timed region
    QUERIES["class_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(0, 64, 1, cpus).mapInPandas(lambda batches: batches, "id long").write.format("noop") \
        .mode("overwrite").save()
    timings, first, failed = {}, {}, []
    for name in names:
        runs = []
        spark.sparkContext.setJobDescription(name)        # labels the query's stages in event logs
        try:
            for _ in range(2):
                t0 = time.time()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.time() - t0)
                release_scratch(spark)
        except Exception as exc:  # noqa: BLE001 - report and keep measuring the others
            print(f"bench: {name} failed: {exc!r}"[:2000], file=sys.stderr)
            failed.append(name)
            timings[name] = first[name] = None
            continue
        first[name] = round(runs[0], 3)
        timings[name] = round(min(runs), 3)
    ok = [v for v in timings.values() if v is not None]
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(ok), 3), "unit": "sec",
                      "queries": timings, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "first_run": first, "first_run_total": round(sum(v for v in first.values() if v is not None), 3),
                      "failed": failed}))


if __name__ == "__main__":
    main()
