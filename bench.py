"""Seconds of the headline queries, warm; prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set the data, the cores and the runs."""

from __future__ import annotations

import importlib.util
import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "p1_found", "p2_found", "p3_found", "p4_found", "p5_found", "p6_found", "p7_found", "p8_found", "q_edges", "q_nodes", "q_components", "q_panel_entities", "q_group_contracts", "q_parse_fields", "q_sequence_repair",
    "q_clean_text", "q_quality_flags", "q_segments", "q_pixel_stats", "q_ab_compare",
]


def main() -> None:
    from archiva.session import build

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(f"local[{cpus}]", "bench", **{"spark.sql.shuffle.partitions": str(max(8, int(cpus) if cpus.isdigit() else 8)), "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"), "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spec = importlib.util.spec_from_file_location("__spark_entry__", Path(__file__).with_name("__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    queries = entry.queries()
    out: dict[str, float] = {}
    for name in (sys.argv[1:] or HEADLINE):
        if name not in queries:
            continue
        took = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            began = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        out[name] = round(statistics.median(took[1:] or took), 3)  # the first run warms up
    print(json.dumps({"metric": "total_seconds", "value": round(sum(out.values()), 3), "unit": "sec", "queries": out, "sf": Path(sf).name}))
    spark.stop()


if __name__ == "__main__":
    main()
