"""Column functions: accounting period, calendar labels, code tagging, money."""

from closeledger.functions.labels import (
    MONEY,
    MONEY_SUM,
    as_text_view,
    load_date,
    lower_names,
    money,
    money_sum,
    name_or_id,
    rename_positional,
    run_timestamp,
    scrub_quotes,
    tag,
    text_or_empty,
    timestamp_text,
    trim_blank,
)
from closeledger.functions.period import (
    DEFAULT_CUTOFF_DAY,
    NOTE_CUTOFF_DAY,
    calendar_month,
    calendar_year,
    close_period,
    close_period_of,
    fiscal_year_label,
    month_label,
    run_date_stamp,
)

__all__ = [
    "DEFAULT_CUTOFF_DAY",
    "MONEY",
    "MONEY_SUM",
    "NOTE_CUTOFF_DAY",
    "as_text_view",
    "calendar_month",
    "calendar_year",
    "close_period",
    "close_period_of",
    "fiscal_year_label",
    "load_date",
    "lower_names",
    "money",
    "money_sum",
    "month_label",
    "name_or_id",
    "rename_positional",
    "run_date_stamp",
    "run_timestamp",
    "scrub_quotes",
    "tag",
    "text_or_empty",
    "timestamp_text",
    "trim_blank",
]
