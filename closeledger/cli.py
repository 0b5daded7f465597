"""Command-line entry: run one period-close job from a JSON config.

    spark-submit --py-files closeledger.zip closeledger/cli.py JOB --config job.json [--run-date YYYY-MM-DD]
    python -m closeledger JOB --config job.json            (local session)

``--period YYYY-MM-01`` re-extracts a past period instead of the one the
run date closes.

JOB is one of ``landing-load``, ``landing-files``, ``journal-files``,
``journal-incremental``.  The run date (default: today) gives the period
through the close rule; the load timestamp is taken once at start and
shared by every extract of the run.  Config keys:

    fact, leaves, operators, stored_counts, posted_dates   table names or paths
    cutoff_day                                             default 12
    segments       [{flag, codes: {col: value}, account_range: [lo, hi],
                     account_list: [...], hierarchies: [{column, letter, node, tree}]}]
    line_segments  same shape; defaults to ``segments``
    journal_scope  {node, ledger, project_prefix, tree}
    folders        output folders for file jobs
    check_content  landing jobs: hold the rows against an independent build
                   before anything is published (default false)
    stage_period   landing-files: checkpoint the period slice once (for a
                   fact not partitioned by period)
    landing_table, count_table   targets of landing-load: a path (Parquet,
                   appended) or {"jdbc": url, "table": t, "properties": {...}}
    marks          journal-incremental: folder of durable posting-day marks;
                   each run then takes the lines posted after the last one
    audit          path of the audit table (Parquet), optional
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from pyspark.sql import SparkSession

from closeledger.functions.period import DEFAULT_CUTOFF_DAY, close_period_of
from closeledger.operators.rules import HierarchyRef, SegmentRule
from closeledger.plans import jobs
from closeledger.plans.extracts import JournalScope
from closeledger.plans.runner import run_all
from closeledger.sinks.audit import AuditLog
from closeledger.sinks.files import ParquetTarget
from closeledger.sinks.jdbc import JdbcTarget
from closeledger.sources.schema import read_table

JOBS = ("landing-load", "landing-files", "journal-files", "journal-incremental")


def rule_from_dict(d: dict) -> SegmentRule:
    return SegmentRule(
        flag=d["flag"],
        codes=tuple((k, v) for k, v in d.get("codes", {}).items()),
        account_range=tuple(d["account_range"]) if d.get("account_range") else None,
        account_list=tuple(d.get("account_list", ())),
        hierarchies=tuple(
            HierarchyRef(h["column"], h["letter"], h["node"], h.get("tree")) for h in d.get("hierarchies", ())
        ),
        account_column=d.get("account_column", "account"),
    )


def _target(spec):
    if isinstance(spec, dict) and "jdbc" in spec:
        return JdbcTarget(spec["jdbc"], spec["table"], dict(spec.get("properties", {})))
    return ParquetTarget(spec)


def build_specs(
    spark: SparkSession, job: str, cfg: dict, run_date: dt.date, run_ts: dt.datetime, period: dt.date | None = None
):
    """Extract specs of one job; ``period`` overrides the close rule (a
    re-run of a past period)."""
    period = period or close_period_of(run_date, int(cfg.get("cutoff_day", DEFAULT_CUTOFF_DAY)))

    def opt(name):
        return read_table(spark, cfg[name]) if cfg.get(name) else None

    ledger = jobs.Ledger(
        fact=read_table(spark, cfg["fact"]),
        leaves=read_table(spark, cfg["leaves"]),
        operators=opt("operators"),
        stored_counts=opt("stored_counts"),
        posted_dates=opt("posted_dates"),
    )
    segments = tuple(rule_from_dict(r) for r in cfg.get("segments", ()))
    line_segments = tuple(rule_from_dict(r) for r in cfg.get("line_segments", ())) or segments
    scope = JournalScope(**cfg["journal_scope"]) if cfg.get("journal_scope") else None
    folders = list(cfg.get("folders", ()))

    if job == "landing-load":
        line = bool(cfg.get("line_grain", False))
        return jobs.landing_load(
            ledger, line_segments if line else segments, period, run_ts,
            _target(cfg["landing_table"]), _target(cfg["count_table"]),
            line_grain=line, with_posted_date=bool(cfg.get("with_posted_date", False)),
            check_content=bool(cfg.get("check_content", False)),
        )
    if job == "landing-files":
        return jobs.landing_files(ledger, segments, period, run_ts, folders, stage=bool(cfg.get("stage_period", False)),
                                  check_content=bool(cfg.get("check_content", False)))
    if job == "journal-files":
        return jobs.journal_files(ledger, scope, period, run_ts, folders)
    if job == "journal-incremental":
        return jobs.journal_incremental(ledger, scope, period, run_ts, folders, marks=cfg.get("marks"), closed=run_date - dt.timedelta(days=1))
    raise ValueError(f"unknown job {job!r}; one of {JOBS}")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="closeledger")
    p.add_argument("job", choices=JOBS)
    p.add_argument("--config", required=True)
    p.add_argument("--run-date", type=dt.date.fromisoformat, default=None)
    p.add_argument("--period", type=dt.date.fromisoformat, default=None, help="first day of a period to (re-)extract")
    a = p.parse_args(argv)
    if a.period is not None and a.period.day != 1:
        p.error("--period must be the first day of a month")
    with open(a.config) as fh:
        cfg = json.load(fh)
    spark = SparkSession.builder.appName(f"closeledger-{a.job}").getOrCreate()
    now = dt.datetime.now()
    run_ts = now.replace(microsecond=now.microsecond // 1000 * 1000)
    run_date = a.run_date or run_ts.date()
    specs = build_specs(spark, a.job, cfg, run_date, run_ts, a.period)
    audit = AuditLog(ParquetTarget(cfg["audit"]), path=os.path.abspath(a.config)) if cfg.get("audit") else None
    for r in run_all(spark, specs, audit):
        print(json.dumps({"extract": r.name, "rows": r.rows, "high_water": str(r.high_water) if r.high_water else None,
                          "control_rows": r.control_rows, "elapsed_sec": round(r.elapsed_sec, 3)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
