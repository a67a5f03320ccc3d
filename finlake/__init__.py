"""Daily financial reporting on a layered data lake, as Spark plans."""

from finlake.operators.reports import REPORTS, Report
from finlake.plans.ingest import ingest, ingest_range
from finlake.plans.jobs import backfill, compact, refresh_gold, run_day
from finlake.sources.daily_csv import SPECS, SourceSpec
from finlake.sources.lake import Lake

__all__ = [
    "REPORTS",
    "SPECS",
    "Lake",
    "Report",
    "SourceSpec",
    "backfill",
    "compact",
    "ingest",
    "ingest_range",
    "refresh_gold",
    "run_day",
]
