"""Headline queries, timed once each; prints one JSON line."""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assaymill.plans.queries import QUERIES  # noqa: E402
from assaymill.session import builder  # noqa: E402

HEADLINES = (
    "cohort_summary", "merge_full", "clean_results", "clean_subjects", "clean_projects",
    "dedup_keep_first", "dedup_keep_none", "merge_inner", "merge_dedup_right", "merge_orphans",
    "constraint_range", "constraint_drop_counts", "string_standardize", "type_convert",
    "date_parse", "null_profile", "value_census", "gate_result", "rule_counts", "failure_cases",
    "first_n_errors", "column_status", "table_score", "recommendations", "success_rate_bands",
    "report_retention", "step_metrics", "mapping_effects", "table_metrics", "csv_round_trip",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench").master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        # the tables come as one row group each, which no scan splits
        .config("assaymill.scan.tasks", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir",
                os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.time() - start, 3)

    run("report_stats")  # starts the JVM's threads and reads the first footer
    names = sys.argv[1:] or HEADLINES
    seconds = {name: run(name) for name in names}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
