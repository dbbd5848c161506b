"""Time the headline queries and print one JSON line.

Each query runs twice and its whole result is produced (written to nowhere), so lazy
columns are not skipped. ``queries`` and ``value`` hold the second runs, when the JVM has
compiled the generated code; ``first_runs_total`` is the sum of the first ones.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import re
import sys
import time
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from outagelens.plans.queries import REGISTRY  # noqa: E402

HEADLINE = [
    "gold_outage_month", "conform_events", "conform_events_detailed", "dedupe_natural_key",
    "dedupe_order_number", "conform_indicators_long", "indicators_wide",
    "gold_indicator_month", "dec_comparison", "check_report", "reconcile_steps",
    "reconcile_sum_silver", "reconcile_sum_gold", "profile_nulls", "profile_duplicates",
    "quality_summary", "duration_stats", "dist_by_type", "indicator_distribution", "coverage",
    "cause_analysis", "conjunto_ranking", "bq_top_cause", "bq_missing_months",
    "scan_year_partition", "replace_year_idempotent", "ledger_pending_version",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("outagelens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        begun = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begun, 3)

    names = sys.argv[1:] or HEADLINE
    seconds("gold_outage_month")
    first = {name: seconds(name) for name in names}
    timed = {name: seconds(name) for name in names}
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        REGISTRY["gold_outage_month"](spark, sf_dir).explain()
    rows = pq.ParquetFile(f"{sf_dir}/lineitem.parquet").metadata.num_rows
    flagship = timed.get("gold_outage_month")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "first_runs_total": round(sum(first.values()), 3),
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "input_rows": rows,
                "flagship_exchanges": len(re.findall("ENSURE_REQUIREMENTS", shown.getvalue())),
                "flagship_rows_per_sec": round(rows / flagship) if flagship else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
