from foldwright.sources.applicants import APPLICANT_SCHEMA, APPROVED, applicants
from foldwright.sources.inspect import (
    ObservedCounts,
    collect_scalar,
    preview,
    row_count,
    schema_report,
    stage_counts,
    to_local,
)
from foldwright.sources.published import publish_results, published, read_published, verify_published
from foldwright.sources.scans import scan_csv, scan_parquet, scan_report, table
from foldwright.sources.sinks import read_results, sink_results

__all__ = [
    "APPLICANT_SCHEMA",
    "APPROVED",
    "ObservedCounts",
    "applicants",
    "collect_scalar",
    "preview",
    "publish_results",
    "published",
    "read_published",
    "read_results",
    "row_count",
    "scan_csv",
    "scan_parquet",
    "scan_report",
    "schema_report",
    "sink_results",
    "stage_counts",
    "table",
    "to_local",
    "verify_published",
]
