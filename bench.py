"""Benchmark: headline queries per analysis stage, one JSON line on stdout.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3).  Method: one warm session; stage "load" derives the
reference-shaped tables from the test tables and writes them as Parquet into
the shared checkpoint folder (the equivalent of the analysed pipeline's CSV
load + cache); every query then runs BENCH_REPEAT times into the ``noop`` sink
and its median wall time is reported (grid searches run once).  ``value`` is the sum of the medians
plus the load time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans.queries import REGISTRY, queries  # noqa: E402
from ledgerlens.plans.tables import Tables  # noqa: E402
from ledgerlens.session import get_session, scratch_path  # noqa: E402

#: Queries that train whole grids: run once, not BENCH_REPEAT times.
ONCE = {"cv_scores", "lr_predictions"}

# stage of the analysed pipeline -> headline queries
STAGES = {
    "class_distribution": ["tx_class_counts", "wallet_class_counts", "class_distribution"],
    "graph_degree": ["degree_stats", "labelled_hubs", "degree_histogram"],
    "wallet_network": ["edge_flow_by_class", "top_illicit_wallets", "illicit_to_licit_transfers"],
    "temporal": ["temporal_distribution", "top_neighbour_ratio"],
    "fraud_models": ["cv_scores", "lr_predictions", "roc_curve", "pr_curve", "auc_pr_rule_score"],
    "wallet_clustering": ["kmeans_profile", "silhouette_rule_clusters"],
    "case_analysis": ["case_summary"],
    "profiling": ["null_profile", "feature_summary", "feature_box_stats", "feature_correlation"],
    "wallet_features": ["wallet_features"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", app="ledgerlens-bench", shuffle_partitions=2 * cpus)
    queries()  # fill the registry
    # warm-up (untimed): JVM start-up and first code generation
    spark.range(100000).selectExpr("sum(id) as s").collect()

    t0 = time.time()
    tables = Tables(spark, sf_dir).materialize(scratch_path(spark, "bench-tables"))
    load = time.time() - t0

    per_query: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for names in STAGES.values():
        for name in names:
            runs = []
            try:
                for _ in range(1 if name in ONCE else repeat):
                    s = time.time()
                    REGISTRY[name].build(tables).write.format("noop").mode("overwrite").save()
                    runs.append(time.time() - s)
                per_query[name] = round(statistics.median(runs), 3)
            except Exception as e:  # report the failure, keep timing the rest
                per_query[name] = None
                errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    done = {k: v for k, v in per_query.items() if v is not None}
    stages = {st: round(sum(done.get(n, 0.0) for n in names), 3) for st, names in STAGES.items()}
    total = round(load + sum(done.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    shapes = {n: [getattr(tables, n).count(), len(getattr(tables, n).columns)]
              for n in ("tx_edges", "addr_addr", "wallet_classes", "doc_features")}
    out = {"metric": "total_sec", "value": total, "unit": "sec", "queries": per_query,
           "stages": {"load": round(load, 3), **stages}, "sf": sf, "cpus": cpus, "repeat": repeat, "rows_x_columns": shapes}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
