"""Sources: schemas and readers for the ledger tables, plus the test-data
derivation used by tests, the oracle check and the benchmark."""

from closeledger.sources.schema import (
    AUDIT_LOG,
    FACT_COLUMNS,
    LEAVES,
    LEDGER_FACT,
    OPERATORS,
    POSTED_DATES,
    STORED_COUNTS,
    read_jdbc,
    read_ledger_fact,
    read_leaves,
    read_operators,
    read_posted_dates,
    read_stored_counts,
    read_table,
)

__all__ = [
    "AUDIT_LOG",
    "FACT_COLUMNS",
    "LEAVES",
    "LEDGER_FACT",
    "OPERATORS",
    "POSTED_DATES",
    "STORED_COUNTS",
    "read_jdbc",
    "read_ledger_fact",
    "read_leaves",
    "read_operators",
    "read_posted_dates",
    "read_stored_counts",
    "read_table",
]
