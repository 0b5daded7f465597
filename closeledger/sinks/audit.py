"""Audit rows and in-pass run metrics.

``observe_extract`` attaches an ``Observation`` to an extract so that its
row count and its new high-water mark (latest posting day written) are
computed by the same tasks that write it: no second pass, no collect.
After the write, one audit row ``Rowcount: n`` is appended to the audit
table; a failure appends an ``Error`` row and is re-raised.

Every row tells where it comes from: the application is ``host:path:method``
(unless the log has a name of its own) and the line is the one that wrote the
row; an error has method and line of the code that raised it.
"""

from __future__ import annotations

import datetime as dt
import os
import platform
import sys
import traceback
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from closeledger.sources.schema import AUDIT_LOG

# Fixed values of the audit log.
LEVEL_INFO = "Outline"
LEVEL_ERROR = "Error"
LOG_CLASS = "DataETL"
AUDIT_TIME_FORMAT = "%Y-%m-%d %H:%M:%S"


def observe_extract(
    df: DataFrame, name: str, high_water_column: str | None = None, count_column: str | None = None
) -> tuple[DataFrame, Observation]:
    """Row count, latest ``high_water_column`` and the sum of
    ``count_column`` (the count carried by a control-count extract)."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if high_water_column is not None:
        metrics.append(F.max(F.col(f"`{high_water_column}`")).alias("high_water"))
    if count_column is not None:
        metrics.append(F.sum(F.col(f"`{count_column}`")).alias("counted"))
    return df.observe(obs, *metrics), obs


def audit_frame(
    spark: SparkSession,
    message: str,
    app_name: str,
    level: str = LEVEL_INFO,
    log_class: str = LOG_CLASS,
    line_num: int | None = None,
    at: dt.datetime | None = None,
) -> DataFrame:
    ts = (at or dt.datetime.now()).strftime(AUDIT_TIME_FORMAT)
    return spark.createDataFrame([(ts, level, log_class, app_name, line_num, message)], AUDIT_LOG)


#: Code that raises on behalf of its caller.
_BELOW = (f"{os.sep}pyspark{os.sep}", f"{os.sep}py4j{os.sep}")


def origin(cause: BaseException | None = None) -> tuple[str, int]:
    """Method and line that write an audit row, or that raised ``cause``."""
    if cause is not None:
        frames = [f for f in traceback.extract_tb(cause.__traceback__) if not any(b in f.filename for b in _BELOW)]
        if frames:
            return frames[-1].name, frames[-1].lineno or 0
    frame = sys._getframe(1)
    while frame.f_back is not None and frame.f_code.co_filename == __file__:
        frame = frame.f_back
    return frame.f_code.co_name, frame.f_lineno


@dataclass(frozen=True)
class AuditLog:
    """Where audit rows go: any target with ``write(df)`` (Parquet table,
    JDBC table) that appends.  ``path`` is that of the job (default: the
    running program)."""

    target: object
    app_name: str | None = None
    path: str | None = None

    def _write(self, spark: SparkSession, message: str, level: str, at: dt.datetime | None, cause: BaseException | None) -> None:
        method, line = origin(cause)
        name = self.app_name or f"{platform.node()}:{self.path or os.path.abspath(sys.argv[0])}:{method}"
        self.target.write(audit_frame(spark, message, name, level, line_num=line, at=at))

    def info(self, spark: SparkSession, message: str, at: dt.datetime | None = None) -> None:
        self._write(spark, message, LEVEL_INFO, at, None)

    def error(self, spark: SparkSession, message: str, at: dt.datetime | None = None, cause: BaseException | None = None) -> None:
        self._write(spark, message, LEVEL_ERROR, at, cause)
