import datetime as dt

import pytest
from pyspark.sql import functions as F

from closeledger.functions.period import (
    calendar_month,
    calendar_year,
    close_period,
    close_period_of,
    fiscal_year_label,
    month_label,
)

# run date, period with cut-over after the 12th, period with cut-over on the 20th
GOLDEN = [
    ("2026-04-20", "2026-04-01", "2026-04-01"),
    ("2026-05-12", "2026-04-01", "2026-04-01"),
    ("2026-05-13", "2026-05-01", "2026-04-01"),
    ("2026-05-19", "2026-05-01", "2026-04-01"),
    ("2026-05-20", "2026-05-01", "2026-05-01"),
    ("2026-01-12", "2025-12-01", "2025-12-01"),
    ("2026-01-13", "2026-01-01", "2025-12-01"),
    ("2024-02-29", "2024-02-01", "2024-02-01"),
    ("2024-03-12", "2024-02-01", "2024-02-01"),
]


def _d(s):
    return dt.date.fromisoformat(s)


@pytest.mark.parametrize("run,p12,p19", GOLDEN)
def test_scalar_rule(run, p12, p19):
    assert close_period_of(_d(run)) == _d(p12)
    assert close_period_of(_d(run), 19) == _d(p19)


def test_column_rule_golden(spark):
    df = spark.createDataFrame([(_d(r),) for r, _, _ in GOLDEN], "run date")
    got = df.select("run", close_period("run").alias("p12"), close_period("run", 19).alias("p19")).collect()
    want = {_d(r): (_d(a), _d(b)) for r, a, b in GOLDEN}
    assert {row.run: (row.p12, row.p19) for row in got} == want


def _python_rule(d, cutoff):
    # the plain year/month arithmetic of the shipped scripts
    if d.day <= cutoff:
        y, m = (d.year - 1, 12) if d.month == 1 else (d.year, d.month - 1)
    else:
        y, m = d.year, d.month
    return dt.date(y, m, 1)


@pytest.mark.parametrize("cutoff", [12, 19])
def test_column_rule_every_day_of_four_years(spark, cutoff):
    start = dt.date(2023, 1, 1)
    days = spark.range(0, 4 * 366).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    rows = days.select("d", close_period("d", cutoff).alias("p")).collect()
    assert len(rows) == 4 * 366
    assert all(r.p == _python_rule(r.d, cutoff) for r in rows)


def test_cutoffs_differ_only_on_days_13_to_19(spark):
    days = spark.range(0, 731).select(F.date_add(F.lit(dt.date(2025, 1, 1)), F.col("id").cast("int")).alias("d"))
    diff = days.filter(close_period("d", 12) != close_period("d", 19)).select(F.dayofmonth("d").alias("dom")).distinct()
    assert sorted(r.dom for r in diff.collect()) == list(range(13, 20))


def test_labels(spark):
    df = spark.createDataFrame([(dt.date(2026, m, 1),) for m in range(1, 13)], "p date")
    rows = df.select(
        "p",
        fiscal_year_label("p").alias("fy"),
        month_label("p").alias("up"),
        month_label("p", upper=False).alias("title"),
        calendar_year("p").alias("y"),
        calendar_month("p").alias("m"),
    ).orderBy("p").collect()
    assert [r.up for r in rows] == ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
    assert [r.title for r in rows][:3] == ["Jan", "Feb", "Mar"]
    assert {r.fy for r in rows} == {"FY2026"}
    assert [r.m for r in rows] == list(range(1, 13)) and {r.y for r in rows} == {2026}


def test_default_run_date_is_today():
    today = dt.date.today()
    assert close_period_of() == close_period_of(today)
