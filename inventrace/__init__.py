"""Cloud-inventory change tracking on Spark: snapshots and audit events in, state and history out."""

from inventrace.operators.attribution import field_map
from inventrace.operators.report import coverage, run_summary, work_grid
from inventrace.operators.upsert import compare, significant
from inventrace.plans.audit_log import events_from_pages as ingest_audit
from inventrace.plans.replay import replay
from inventrace.plans.sync import Sync, attribute, diff, flatten, upsert
from inventrace.specs.registry import SPECS, select_services

__all__ = [
    "SPECS",
    "Sync",
    "attribute",
    "compare",
    "coverage",
    "diff",
    "field_map",
    "flatten",
    "ingest_audit",
    "replay",
    "run_summary",
    "select_services",
    "significant",
    "upsert",
    "work_grid",
]
