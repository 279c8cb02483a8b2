"""Scans and writes."""

from .scan import (
    extract_projects, extract_results, extract_subjects, scan, scan_csv, scan_parquet, spread,
    with_na_tokens_as_null,
)
from .footers import footer_counts, stored_null_counts
from .quarantine import SplitScan, scan_csv_split
from .run_log import RunLog
from .sinks import write_parquet, write_recipes, write_report, write_summary_csv
from .staging import Staging, staging_root

__all__ = [
    "RunLog", "SplitScan", "Staging", "extract_projects", "extract_results", "extract_subjects", "footer_counts", "scan", "scan_csv", "scan_csv_split",
    "scan_parquet", "spread", "staging_root", "stored_null_counts", "with_na_tokens_as_null", "write_parquet", "write_recipes",
    "write_report", "write_summary_csv",
]
