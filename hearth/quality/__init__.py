"""Audit rows, the load ledger, conformance reports and quarantine."""

from hearth.quality.audit import audited_write, AUDIT_SCHEMA
from hearth.quality.ledger import LoadEntry, Unaccounted, read_ledger, record, run_id_of, LEDGER_SCHEMA, FATES
from hearth.quality.checks import (
    quality_flag_counts, text_length_report, schema_report, reject_rows, failing_values, conformance_report,
    require_conformance, NotConforming,
)
