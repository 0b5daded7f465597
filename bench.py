"""Benchmark the headline extracts.

Runs each headline query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``: a warm-up pass over all queries, then the
median wall time of five runs each (plan build plus execution).  A run
executes the whole plan into Spark's ``noop`` sink (no collect to the
driver).  A second session with the event log on (in a fresh scratch
folder) runs each query once for its shuffle bytes; the fact scans are
counted in each physical plan.  The extracts are also timed over the
ledger stored as Parquet partitioned by period, and the same oracle SQL is
timed in DuckDB as a single-node reference point.

Prints ONE JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "landing",
    "landing_two_scan",
    "landing_line",
    "landing_line_posted",
    "control_count",
    "journal_summary",
    "journal_detail",
    "journal_watermarked",
    "close_period_12",
    "nonzero_balance",
    "period_passthrough",
]
# the same extracts over the ledger stored as Parquet partitioned by period
# (the production layout: the period filter prunes to one partition)
STORED = ["landing", "landing_line_posted", "journal_summary", "journal_detail", "journal_watermarked", "period_passthrough"]
RUNS = 5


def _shuffle_bytes(event_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, from the event log."""
    stage_group: dict[int, str] = {}
    out: dict[str, int] = {}
    for path in sorted(glob.glob(f"{event_dir}/**/*", recursive=True)):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = stage_group.get(info["Stage ID"])
                    if not group:
                        continue
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                            out[group] = out.get(group, 0) + int(acc.get("Value", 0))
    return out


def _fact_scans(df) -> int:
    """Scans of the fact source (lineitem) in the formatted physical plan."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return sum(1 for ln in buf.getvalue().splitlines() if ln.startswith("Location:") and "/lineitem.parquet]" in ln)


def _stored_bench(spark, sf_dir: str, scratch: str) -> dict[str, float]:
    """Write the derived ledger once (fact partitioned by drill_date and
    clustered by codes, ``write_ledger_fact``), then time the extracts
    reading it."""
    from closeledger.plans import extracts as X
    from closeledger.plans.catalog import JOURNAL_SCOPE, LANDING_RULES, LINE_RULES, PERIOD, RUN_TS
    from closeledger.sources import testdata as td

    root = os.path.join(scratch, "ledger")
    t0 = time.perf_counter()
    from closeledger.sinks.files import write_ledger_fact

    write_ledger_fact(td.ledger_fact(spark, sf_dir), f"{root}/fact")
    for name, df in (("leaves", td.leaves(spark, sf_dir)), ("operators", td.operators(spark, sf_dir)),
                     ("posted_dates", td.posted_dates(spark, sf_dir))):
        df.write.parquet(f"{root}/{name}")
    write_sec = time.perf_counter() - t0

    def tables():
        r = spark.read
        return (r.parquet(f"{root}/fact"), r.parquet(f"{root}/leaves"), r.parquet(f"{root}/operators"),
                r.parquet(f"{root}/posted_dates"))

    def build(name):
        fact, leaves, ops, pd = tables()
        return {
            "landing": lambda: X.landing(fact, leaves, LANDING_RULES, PERIOD, RUN_TS),
            "landing_line_posted": lambda: X.landing_line(fact, leaves, LINE_RULES, PERIOD, RUN_TS, with_posted_date=True),
            "journal_summary": lambda: X.journal_summary(fact, leaves, ops, JOURNAL_SCOPE, PERIOD, RUN_TS),
            "journal_detail": lambda: X.journal_detail(fact, leaves, ops, JOURNAL_SCOPE, PERIOD, RUN_TS),
            "journal_watermarked": lambda: X.journal_watermarked(fact, leaves, ops, JOURNAL_SCOPE, PERIOD, pd, run_ts=RUN_TS),
            "period_passthrough": lambda: X.period_passthrough(fact, PERIOD),
        }[name]()

    def run(name):
        t = time.perf_counter()
        build(name).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    def publish_csv(name):
        # the extract written as quoted CSV to two targets (the second copied
        # from the first), as the file jobs do
        from closeledger.sinks.files import CsvTarget
        from closeledger.sinks.publish import publish

        df = build(name)
        names = tuple(c.replace("oper_unit", "oper unit") for c in df.columns)
        out_dir = tempfile.mkdtemp(prefix=f"csv-{name}-", dir=scratch)
        t = time.perf_counter()
        publish(spark, df, [CsvTarget(f"{out_dir}/a", names), CsvTarget(f"{out_dir}/b", names)])
        return time.perf_counter() - t

    out = {"write_ledger_once": round(write_sec, 3)}
    for name in ("landing", "period_passthrough"):
        publish_csv(name)
        out[f"publish_csv_2_targets:{name}"] = round(statistics.median(publish_csv(name) for _ in range(RUNS)), 3)
    for name in STORED:
        run(name)
    for name in STORED:
        out[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="closeledger-bench-")
    events = os.path.join(scratch, "events")
    os.makedirs(events)

    from closeledger.plans.catalog import QUERIES
    from closeledger.plans.oracle import ORACLE
    from closeledger.session import local_session

    # phase 1: timings, in a session without event logging (writing the
    # event log costs ~40% on jobs this small)
    spark = local_session(
        f"local[{cpus}]", "closeledger-bench",
        {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # one warm-up pass over every query first (JIT, class loading), so the
    # order of the queries does not bias their times
    for name in HEADLINE:
        run(name)
    timings = {name: round(statistics.median(run(name) for _ in range(RUNS)), 3) for name in HEADLINE}
    stored_timings = _stored_bench(spark, sf_dir, scratch)
    spark.stop()

    # phase 2: one run per query with the event log on, for shuffle bytes;
    # and the fact scans of each physical plan
    spark = local_session(
        f"local[{cpus}]", "closeledger-bench-events",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": events,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    scans: dict[str, int] = {}
    for name in HEADLINE:
        spark.sparkContext.setJobGroup(name, name)
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        scans[name] = _fact_scans(df)
    spark.stop()
    per_group = _shuffle_bytes(events)
    shuffle = {n: per_group.get(n, 0) for n in HEADLINE}

    duck: dict[str, float] = {}
    try:
        sys.path.insert(0, os.path.join(ROOT, "tests"))
        from oracle_check import duck as duck_con

        con = duck_con(sf_dir)
        for name in HEADLINE:
            con.sql(ORACLE[name]).fetchall()
            ts = []
            for _ in range(3):
                t0 = time.perf_counter()
                con.sql(ORACLE[name]).fetchall()
                ts.append(time.perf_counter() - t0)
            duck[name] = round(statistics.median(ts), 4)
    except Exception as e:  # the reference point is optional
        duck = {"error": str(e)[:200]}

    headline_total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median wall seconds over headline extracts",
                "value": headline_total,
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                "cpus": int(cpus),
                "runs": RUNS,
                "shuffle_bytes": shuffle,
                "fact_scans": scans,
                "stored_fact_sec": stored_timings,
                "duckdb_same_sql_sec": duck,
            }
        )
    )


if __name__ == "__main__":
    main()
