"""Compositions of the operators: the report and the job that writes it."""

from declined.plans.job import AuditOutcome, preview, run_audit, write_audit
from declined.plans.report import audit_report, best_matches, report_of_matches

__all__ = [
    "AuditOutcome",
    "audit_report",
    "best_matches",
    "preview",
    "report_of_matches",
    "run_audit",
    "write_audit",
]
