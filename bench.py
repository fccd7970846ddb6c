"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the table folder and ``BENCH_CPUS`` the number of local cores.  Each query runs
to the end into a sink that discards rows, so nothing is collected and no column is pruned away.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from tablemint.session import RECOMMENDED
from tablemint.workload import QUERIES

HEADLINE = [
    "entity_group_orders", "custom_agreed", "notes_withheld", "entity_row_customers", "single_member",
    "fold_rows", "fold_arrays", "cross_mapping_fold",
    "edges_resolve", "edges_inverse", "edges_external", "edge_dangling", "edge_external_counts",
    "reconcile_differences", "reconcile_verdict", "reconcile_orders", "crosstab_flags", "golden_diff", "idempotent",
    "dup_keys", "last_wins", "first_match", "totals", "validate_rules", "id_unique", "rule_classify",
    "check_manifest", "page_completeness",
    "eav_columns", "eav_long", "field_inventory", "threads_flatten", "tree_paths", "tree_files", "page_lines",
    "name_domains", "upgrade_edges", "malformed_edges", "fn_text", "fn_numbers", "fn_labels", "report_counts",
    "bundle_records", "csv_rows", "xml_rows", "delivery_takes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=RECOMMENDED)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed run of the flagship warms up the JVM.
    QUERIES[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
