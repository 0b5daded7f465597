"""Scalar projections used by the extracts (all built-in expressions).

Grouping always happens on raw values; these helpers are applied *after* the
aggregate so that ``'40000'`` and ``'40000 '`` stay two groups even though
they print alike.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money precision of the landing tables and the text form of the
# load timestamp (24-hour clock, milliseconds).
MONEY = "decimal(19,4)"
MONEY_SUM = "decimal(38,4)"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_blank(c: Column | str) -> Column:
    """Trim blanks (spaces only) on both sides; NULL stays NULL."""
    return F.trim(as_column(c))


def tag(letter: str, c: Column | str, trim: bool = False) -> Column:
    """Prefix a code with its type letter (``A`` account, ``J`` project,
    ``D`` department, ``S`` operating unit).  NULL in, NULL out."""
    v = as_column(c)
    return F.concat(F.lit(letter), F.trim(v) if trim else v)


def scrub_quotes(c: Column | str) -> Column:
    """Replace every double quote by a blank."""
    return F.translate(as_column(c), '"', " ")


def name_or_id(name: Column | str, ident: Column | str) -> Column:
    """Display name, falling back to the id when the name is NULL."""
    return F.coalesce(as_column(name), as_column(ident))


def money(c: Column | str) -> Column:
    """Round to the landing-table money type (half away from zero)."""
    return as_column(c).cast(MONEY)


def money_sum(c: Column | str) -> Column:
    """Fixed output type for uncast journal sums."""
    return as_column(c).cast(MONEY_SUM)


def run_timestamp(run_ts: dt.datetime | None) -> Column:
    """The load timestamp, pinned once per run so every extract of a run
    carries the same value.  ``None`` falls back to the query's own
    ``current_timestamp()`` (also one constant per query)."""
    if run_ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    # from text, so the wall-clock value does not depend on any time zone
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def timestamp_text(run_ts: dt.datetime | None) -> Column:
    """Load timestamp as text with milliseconds, 24-hour clock."""
    return F.date_format(run_timestamp(run_ts), TIMESTAMP_TEXT)


def load_date(run_ts: dt.datetime | None) -> Column:
    return F.to_date(run_timestamp(run_ts))


def text_or_empty(c: Column | str) -> Column:
    """Any column as text with NULL shown as the empty string."""
    return F.coalesce(as_column(c).cast("string"), F.lit(""))


def lower_names(df):
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def rename_positional(df, names):
    """Rename columns by position to a fixed list; the arity must match."""
    names = list(names)
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}: {names}")
    return df.toDF(*names)


def as_text_view(df):
    """Every column as text, NULL as ``''`` (the shape a quoted CSV holds)."""
    return df.select([text_or_empty(F.col(f"`{c}`")).alias(c) for c in df.columns])
