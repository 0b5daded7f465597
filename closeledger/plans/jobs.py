"""Whole jobs: the extract sets that run together at period close.

Each builder returns a list of ``ExtractSpec`` for ``run_all``; every spec
builds a lazy DataFrame over the caller's ledger tables and names its own
targets, so one job run writes every file or table once, with a row-count
audit row per extract.

* ``landing_load``      landing-grain (or line-grain) segment balances and
                        their independent control count, appended to
                        relational landing tables (or any target);
* ``landing_files``     the landing file (timestamp as text), its control
                        count file and the period pass-through file, each
                        published to several folders;
* ``journal_files``     journal summary, stored control counts, journal
                        detail, each published to several folders;
* ``journal_incremental`` the watermarked journal extract with its new
                        high-water mark in the run result (or in a store of
                        marks that chains the runs), published to several
                        folders.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from closeledger.functions.period import run_date_stamp
from closeledger.operators.dimension import DEFAULT_BROADCAST_ROWS
from closeledger.operators.fingerprint import ContentCheck
from closeledger.operators.rules import SegmentRule
from closeledger.plans import extracts as X
from closeledger.plans.runner import ExtractSpec
from closeledger.sinks.files import CsvTarget
from closeledger.sinks.marks import MarkStore


@dataclass(frozen=True)
class Ledger:
    """The caller's ledger tables (any DataFrames with the documented
    columns; see ``closeledger.sources.schema``)."""

    fact: DataFrame
    leaves: DataFrame
    operators: DataFrame | None = None
    stored_counts: DataFrame | None = None
    posted_dates: DataFrame | None = None


def staged(ledger: Ledger, period: dt.date) -> Ledger:
    """The same ledger with its fact cut to one period and checkpointed to
    the cluster's checkpoint folder (``spark.checkpoint.dir``), for jobs in
    which several extracts read that period: the slice is read from the fact
    once, and a lost executor costs a re-read of checkpoint files, not of
    the fact.  Worth it only when the fact is not partitioned by period."""
    from closeledger.plans.extracts import period_slice

    return Ledger(
        fact=period_slice(ledger.fact, period).checkpoint(eager=True),
        leaves=ledger.leaves,
        operators=ledger.operators,
        stored_counts=ledger.stored_counts,
        posted_dates=ledger.posted_dates,
    )


def _csv_targets(folders: list[str], stem: str, names: list[str], stamp: str) -> tuple[CsvTarget, ...]:
    return tuple(CsvTarget(f"{f.rstrip('/')}/{stem}_{stamp}.csv", tuple(names)) for f in folders)


def _landing_content(ledger: Ledger, rules, period: dt.date, run_ts: dt.datetime, extract=X.landing, **more) -> ContentCheck:
    """The landing extract built rule by rule, to be held against the
    single-pass one."""
    return ContentCheck(
        lambda _s: extract(ledger.fact, ledger.leaves, rules, period, run_ts, single_pass=False, **more),
        segments=("bus_flg",),
        keys=("gl_acct", "lgr", "ucmg_id", "bu", "ou", "loc", "dept"),
    )


def landing_load(
    ledger: Ledger,
    rules: tuple[SegmentRule, ...],
    period: dt.date,
    run_ts: dt.datetime,
    landing_target,
    count_target,
    line_grain: bool = False,
    with_posted_date: bool = False,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    check_content: bool = False,
) -> list[ExtractSpec]:
    """Landing extract appended to its table, then the control count to
    its own table; the landing spec reconciles against the count, and with
    ``check_content`` every row against the UNION ALL form of the extract."""

    def control(_spark):
        return X.control_count(ledger.fact, ledger.leaves, rules, period, run_ts, max_broadcast_rows=max_broadcast_rows)

    if line_grain:
        def build(_spark):
            return X.landing_line(ledger.fact, ledger.leaves, rules, period, run_ts, with_posted_date, max_broadcast_rows=max_broadcast_rows)
        # the control count is at landing grain; line-grain rows are not reconciled against it
        content = _landing_content(ledger, rules, period, run_ts, X.landing_line, with_posted_date=with_posted_date) if check_content else None
        return [ExtractSpec("landing_line", build, (landing_target,), content=content)]

    def build_landing(_spark):
        return X.landing(ledger.fact, ledger.leaves, rules, period, run_ts, max_broadcast_rows=max_broadcast_rows)

    # the control count runs first; the landing extract is reconciled with
    # the count observed while it was written (computed once per run)
    return [
        ExtractSpec("control_count", control, (count_target,), count_column="row_cnt"),
        ExtractSpec("landing", build_landing, (landing_target,), control="control_count",
                    content=_landing_content(ledger, rules, period, run_ts) if check_content else None),
    ]


def landing_files(
    ledger: Ledger,
    rules: tuple[SegmentRule, ...],
    period: dt.date,
    run_ts: dt.datetime,
    folders: list[str],
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    stage: bool = False,
    check_content: bool = False,
) -> list[ExtractSpec]:
    """Landing file, its control count and the period pass-through.  All
    three read the period slice; ``stage=True`` checkpoints that slice once
    (``staged``), for a fact that is not partitioned by period."""
    if stage:
        ledger = staged(ledger, period)
    stamp = run_date_stamp(run_ts.date())
    passthrough_names = [c.lower() for c in ledger.fact.columns]

    def landing(_spark):
        return X.landing(ledger.fact, ledger.leaves, rules, period, run_ts, ts_text=True, max_broadcast_rows=max_broadcast_rows)

    def count(_spark):
        return X.control_count(ledger.fact, ledger.leaves, rules, period, run_ts, ts_text=True, max_broadcast_rows=max_broadcast_rows)

    return [
        ExtractSpec("control_count", count, _csv_targets(folders, "control_count", X.CSV_NAMES["control_count"], stamp),
                    count_column="row_cnt"),
        ExtractSpec("landing", landing, _csv_targets(folders, "landing", X.CSV_NAMES["landing"], stamp), control="control_count",
                    content=_landing_content(ledger, rules, period, run_ts, ts_text=True) if check_content else None),
        ExtractSpec(
            "period_passthrough",
            lambda _s: X.period_passthrough(ledger.fact, period),
            _csv_targets(folders, "period_passthrough", passthrough_names, stamp),
        ),
    ]


def journal_files(
    ledger: Ledger,
    scope: X.JournalScope,
    period: dt.date,
    run_ts: dt.datetime,
    folders: list[str],
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> list[ExtractSpec]:
    if ledger.operators is None or ledger.stored_counts is None:
        raise ValueError("journal_files needs the operator dimension and the stored counts")
    stamp = run_date_stamp(run_ts.date())
    return [
        ExtractSpec(
            "journal_summary",
            lambda _s: X.journal_summary(ledger.fact, ledger.leaves, ledger.operators, scope, period, run_ts, max_broadcast_rows),
            _csv_targets(folders, "journal_summary", X.CSV_NAMES["journal_summary"], stamp),
        ),
        ExtractSpec(
            "stored_count",
            lambda _s: X.stored_count(ledger.stored_counts),
            _csv_targets(folders, "stored_count", X.CSV_NAMES["stored_count"], stamp),
        ),
        ExtractSpec(
            "journal_detail",
            lambda _s: X.journal_detail(ledger.fact, ledger.leaves, ledger.operators, scope, period, run_ts, max_broadcast_rows),
            _csv_targets(folders, "journal_detail", X.CSV_NAMES["journal_detail"], stamp),
        ),
    ]


def journal_incremental(
    ledger: Ledger,
    scope: X.JournalScope,
    period: dt.date,
    run_ts: dt.datetime,
    folders: list[str],
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    marks: str | None = None,
    closed: dt.date | None = None,
) -> list[ExtractSpec]:
    """The journal extract up to the latest posting day of the posted-dates
    table; or, with ``marks`` (a folder on shared storage), the lines posted
    after the mark of the last run up to the day ``closed`` (default: the day
    before the run), after which no line may be posted on it.  Runs chained by their marks lose and repeat no line."""
    if ledger.operators is None or (ledger.posted_dates is None and marks is None):
        raise ValueError("journal_incremental needs the operator dimension, and the posted-dates table or a folder of marks")
    stamp = run_date_stamp(run_ts.date())
    if marks is not None:
        through = closed or run_ts.date() - dt.timedelta(days=1)
        return [
            ExtractSpec(
                "journal_watermarked",
                lambda _s, since: X.journal_watermarked(
                    ledger.fact, ledger.leaves, ledger.operators, scope, period,
                    bound=through, since=since, run_ts=run_ts, max_broadcast_rows=max_broadcast_rows,
                ),
                _csv_targets(folders, "journal_watermarked", X.CSV_NAMES["journal_watermarked"], stamp),
                high_water_column="posted",
                mark=MarkStore(marks, f"journal_watermarked-{period:%Y-%m}"),
            )
        ]
    return [
        ExtractSpec(
            "journal_watermarked",
            lambda _s: X.journal_watermarked(
                ledger.fact, ledger.leaves, ledger.operators, scope, period,
                posted_dates=ledger.posted_dates, run_ts=run_ts, max_broadcast_rows=max_broadcast_rows,
            ),
            _csv_targets(folders, "journal_watermarked", X.CSV_NAMES["journal_watermarked"], stamp),
            high_water_column="posted",
        )
    ]
