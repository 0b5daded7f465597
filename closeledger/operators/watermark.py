"""Incremental upper bound on posting dates (the extract's watermark).

The bound is the latest posting day already extracted, or 1900-01-01 when
nothing was extracted yet.  It is used as a scalar subquery, so it stays in
the plan: Spark evaluates the one-row aggregate first and substitutes its
value into the fact filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: bound used when no posting day was extracted yet.
EMPTY_WATERMARK = dt.date(1900, 1, 1)


def watermark_frame(posted_dates: DataFrame, column: str = "posted_date") -> DataFrame:
    """One row, one column ``bound``."""
    return posted_dates.agg(F.coalesce(F.max(column), F.lit(EMPTY_WATERMARK)).alias("bound"))


def watermark_bound(posted_dates: DataFrame, column: str = "posted_date") -> Column:
    """The bound as a scalar-subquery ``Column``."""
    return watermark_frame(posted_dates, column).scalar()


def up_to(df: DataFrame, bound: Column | dt.date, column: str = "posted_date") -> DataFrame:
    """Lines posted on or before ``bound``; lines with no posting date drop."""
    b = bound if isinstance(bound, Column) else F.lit(bound)
    return df.filter(F.col(column) <= b)
