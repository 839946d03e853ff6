"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from celltide.plans.queries import QUERIES
from celltide.session import build_session, drop_scratch

HEADLINE = [
    "prior3", "prior3_split", "rules_from_text", "anomalies_long", "anomaly_flags", "traffic_grouped", "adj_flags", "ingest_parse",
    "parse_anomalies", "anomaly_summary", "network_health", "candidate_links", "adjacency",
    "chunk_documents", "vector_topk", "kpi_du_outer", "resolve_cell", "feed", "stream_detect",
    "stream_detect_tail",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench", f"local[{cpus}]", cpus, spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["valid_bands"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
    print(json.dumps({
        "metric": "headline queries, best of three", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus,
    }))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
