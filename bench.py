"""Headline timings: each query is run once cold and then timed warm, results
written to a sink that keeps nothing. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestream.plans import catalog  # noqa: E402
from lodestream.session import build_session  # noqa: E402

HEADLINE = (
    "clean_corpus parse_lists dedup_first quality_filter exact_split seeded_sample duplicate_keys learned_units "
    "segmented_text topk_exact retrieval_metrics hard_negatives mined_pairs mean_pool inbatch_loss rerank_requests "
    "retrieve_rerank encode_corpus pair_metrics roc_auc threshold_sweep classification_report best_epoch early_stop "
    "version_compare gate_verdict request_counts latency_histogram latency_quantiles request_rate_1m success_rate_5m "
    "latency_quantiles_5m cold_starts_1h alert_rules alert_sustained alert_messages parsed_log"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    timings = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs), 3)
        print(f"{name} {runs[0]:.2f} {runs[1]:.2f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
