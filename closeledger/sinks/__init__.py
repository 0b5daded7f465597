"""Sinks: quoted-CSV extracts, Parquet by period, JDBC landing tables,
multi-target publishing and the audit log."""

from closeledger.sinks.audit import AuditLog, audit_frame, observe_extract
from closeledger.sinks.files import CsvTarget, ParquetTarget, csv_frame, read_csv, write_csv, write_parquet
from closeledger.sinks.jdbc import JdbcTarget, write_jdbc
from closeledger.sinks.publish import publish

__all__ = [
    "AuditLog",
    "CsvTarget",
    "JdbcTarget",
    "ParquetTarget",
    "audit_frame",
    "csv_frame",
    "observe_extract",
    "publish",
    "read_csv",
    "write_csv",
    "write_jdbc",
    "write_parquet",
]
