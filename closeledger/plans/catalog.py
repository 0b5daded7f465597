"""The extract catalogue used by the entry points, tests and benchmark:
segment rules and journal scope of the test-data ledger, and one builder
per named query.  Each builder takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the whole derived ledger."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closeledger.functions.labels import as_text_view
from closeledger.functions.period import (
    NOTE_CUTOFF_DAY,
    calendar_month,
    calendar_year,
    close_period,
    fiscal_year_label,
    month_label,
)
from closeledger.operators.balances import balance, nonzero
from closeledger.operators.control import reconcile
from closeledger.operators.dimension import bounded_broadcast
from closeledger.operators.fingerprint import ContentCheck, content_differences
from closeledger.operators.hierarchy import duplicate_leaf_impact, in_hierarchy, join_leaves
from closeledger.operators.rule_index import tag_segments_indexed
from closeledger.operators.rules import FLAG, HierarchyRef, SegmentRule, tag_segments
from closeledger.operators.watermark import watermark_frame
from closeledger.plans import extracts as X
from closeledger.plans.runner import ExtractSpec, run_spec
from closeledger.session import ensure_checkpoint_dir
from closeledger.sinks.files import ParquetTarget, write_ledger_fact
from closeledger.sinks.marks import MarkStore
from closeledger.sources import testdata as td
from closeledger.sources.zone_map import read_matching, refresh

# Fixed values of the test-data segment rules (codes as in the shipped
# extracts; node names are neutral stand-ins).
RANGE = ("40000", "99999")
ALLOW_LIST = ("15050", "15060", "15055", "15065")
SEGMENT_A = SegmentRule(
    flag="A",
    codes=(("business_unit", "20020"), ("operating_unit", "02858"), ("deptid", "220210"), ("ledger", "GAAP")),
    account_range=RANGE,
)
SEGMENT_B = SegmentRule(
    flag="B",
    codes=(("business_unit", "20020"), ("operating_unit", "01000")),
    account_range=RANGE,
    account_list=ALLOW_LIST,
    hierarchies=(
        HierarchyRef("deptid", "D", td.DEPT_NODE, td.DEPT_TREE),
        HierarchyRef("project_id", "J", td.PROJ_NODE, td.PROJ_TREE),
    ),
)
# landing grain: rule B has no ledger condition; line grain: it has (as shipped)
LANDING_RULES = (SEGMENT_A, SEGMENT_B)
LINE_RULES = (SEGMENT_A, SEGMENT_B.with_code("ledger", "GAAP"))
JOURNAL_SCOPE = X.JournalScope(node=td.OPER_NODE, ledger="GAAP", project_prefix="1")

PERIOD = td.FIXTURE_PERIOD
RUN_TS = td.FIXTURE_RUN_TS


def _fact(spark, d):
    return td.ledger_fact(spark, d, PERIOD)


def _leaves(spark, d):
    return td.leaves(spark, d)


def q_landing(spark: SparkSession, d: str) -> DataFrame:
    return X.landing(_fact(spark, d), _leaves(spark, d), LANDING_RULES, PERIOD, RUN_TS)


def q_landing_two_scan(spark, d):
    return X.landing(_fact(spark, d), _leaves(spark, d), LANDING_RULES, PERIOD, RUN_TS, single_pass=False)


def q_landing_shuffle(spark, d):
    """The landing extract with no broadcast allowed: membership by shuffle
    joins (the path taken when a leaf set fails its size check)."""
    return X.landing(_fact(spark, d), _leaves(spark, d), LANDING_RULES, PERIOD, RUN_TS, max_broadcast_rows=0)


def q_segment_a(spark, d):
    return X.landing(_fact(spark, d), _leaves(spark, d), (SEGMENT_A,), PERIOD, RUN_TS)


def q_segment_b(spark, d):
    return X.landing(_fact(spark, d), _leaves(spark, d), (SEGMENT_B,), PERIOD, RUN_TS)


def q_landing_line(spark, d):
    return X.landing_line(_fact(spark, d), _leaves(spark, d), LINE_RULES, PERIOD, RUN_TS)


def q_landing_line_posted(spark, d):
    return X.landing_line(_fact(spark, d), _leaves(spark, d), LINE_RULES, PERIOD, RUN_TS, with_posted_date=True)


def q_control_count(spark, d):
    return X.control_count(_fact(spark, d), _leaves(spark, d), LANDING_RULES, PERIOD, RUN_TS)


def q_control_count_text(spark, d):
    return X.control_count(_fact(spark, d), _leaves(spark, d), LANDING_RULES, PERIOD, RUN_TS, ts_text=True)


def q_reconcile(spark, d):
    return reconcile(q_landing(spark, d), q_control_count(spark, d))


def q_period_passthrough(spark, d):
    return X.period_passthrough(_fact(spark, d), PERIOD)


def _journal_scope_lines(spark, d):
    s = JOURNAL_SCOPE
    return X.period_slice(_fact(spark, d), PERIOD).filter(
        (F.col("ledger") == s.ledger) & F.col("project_id").startswith(s.project_prefix)
    )


def q_hierarchy_semi(spark, d):
    lines = _journal_scope_lines(spark, d)
    return in_hierarchy(lines, "operating_unit", "S", _leaves(spark, d), td.OPER_NODE)


def q_hierarchy_inner_fanout(spark, d):
    lines = _journal_scope_lines(spark, d)
    return join_leaves(lines, "operating_unit", "S", _leaves(spark, d), td.OPER_NODE)


def q_operator_fallback(spark, d):
    """Every operator id of the whole ledger with its display name."""
    ids = td.ledger_fact(spark, d).select("oprid").distinct()
    ops, _ = bounded_broadcast(td.operators(spark, d))
    return ids.join(ops, F.col("oprid") == F.col("employeeid"), "left").select(
        "oprid", F.coalesce(F.col("employeename"), F.col("oprid")).alias("user")
    )


def q_journal_summary(spark, d):
    return X.journal_summary(_fact(spark, d), _leaves(spark, d), td.operators(spark, d), JOURNAL_SCOPE, PERIOD, RUN_TS)


def q_journal_summary_shuffle(spark, d):
    """The journal summary with no broadcast allowed: lines pre-aggregated to
    groups, then shuffle joins to the leaf table and the operators."""
    return X.journal_summary(
        _fact(spark, d), _leaves(spark, d), td.operators(spark, d), JOURNAL_SCOPE, PERIOD, RUN_TS, max_broadcast_rows=0
    )


def q_journal_detail(spark, d):
    return X.journal_detail(_fact(spark, d), _leaves(spark, d), td.operators(spark, d), JOURNAL_SCOPE, PERIOD, RUN_TS)


def q_watermark_scalar(spark, d):
    return watermark_frame(td.posted_dates(spark, d))


def q_journal_watermarked(spark, d):
    return X.journal_watermarked(
        _fact(spark, d), _leaves(spark, d), td.operators(spark, d), JOURNAL_SCOPE, PERIOD,
        posted_dates=td.posted_dates(spark, d), run_ts=RUN_TS,
    )


def _order_dates(spark, d):
    return td.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()


def q_close_period_12(spark, d):
    return _order_dates(spark, d).select("run_date", close_period("run_date").alias("drill_date"))


def q_close_period_20(spark, d):
    return _order_dates(spark, d).select("run_date", close_period("run_date", NOTE_CUTOFF_DAY).alias("drill_date"))


def q_month_labels(spark, d):
    periods = _order_dates(spark, d).select(close_period("run_date").alias("drill_date")).distinct()
    return periods.select(
        "drill_date",
        fiscal_year_label("drill_date").alias("fisc_yr"),
        month_label("drill_date").alias("mo_upper"),
        month_label("drill_date", upper=False).alias("mo_title"),
        calendar_year("drill_date").alias("year"),
        calendar_month("drill_date").alias("period"),
    )


def q_string_range(spark, d):
    """Lines per raw account code with its range / allow-list membership,
    over the whole ledger (string comparison, blanks count)."""
    acct = F.col("account")
    return (
        td.ledger_fact(spark, d)
        .groupBy("account")
        .agg(F.count(F.lit(1)).alias("lines"))
        .select(
            "account",
            "lines",
            acct.between(*RANGE).alias("in_range"),
            acct.isin(*ALLOW_LIST).alias("in_list"),
        )
    )


def q_nonzero_balance(spark, d):
    """Every period: landing-grain balances whose rounded sum is not zero."""
    return nonzero(balance(td.ledger_fact(spark, d), X.LANDING_KEYS))


def q_csv_text_view(spark, d):
    """The landing file as written: timestamp text, all columns text, NULL as ''."""
    lnd = X.landing(_fact(spark, d), _leaves(spark, d), LANDING_RULES, PERIOD, RUN_TS, ts_text=True)
    return as_text_view(lnd)


def q_duplicate_leaf_check(spark, d):
    """Leaves listed twice under one node, with the ledger lines (all
    periods) that carry each such code."""
    return duplicate_leaf_impact(td.ledger_fact(spark, d), _leaves(spark, d))


def stored_counts(spark: SparkSession, d: str, rules=LANDING_RULES) -> DataFrame:
    """The stored control-count table as earlier runs would have filled it:
    one row per period of the ledger, ``(insrt_on, row_cnt)``, stamped with
    the 5th of the following month (a run date that closes that period)."""
    tagged = tag_segments(td.ledger_fact(spark, d), td.leaves(spark, d), rules)
    groups = nonzero(balance(tagged, [FLAG, *X.LANDING_KEYS]))
    return groups.groupBy("drill_date").agg(F.count(F.lit(1)).alias("row_cnt")).select(
        F.date_add(F.add_months("drill_date", 1), 4).alias("insrt_on"), "row_cnt"
    )


def q_stored_count(spark, d):
    return X.stored_count(stored_counts(spark, d))


def q_hierarchy_semi_ledger(spark, d):
    """Membership over the whole ledger: lines per period and operating unit."""
    lines = in_hierarchy(td.ledger_fact(spark, d), "operating_unit", "S", _leaves(spark, d), td.OPER_NODE)
    return lines.groupBy("drill_date", "operating_unit").agg(F.count(F.lit(1)).alias("lines"), F.sum("amount").cast("decimal(38,4)").alias("amt"))


def q_hierarchy_fanout_ledger(spark, d):
    """The fan-out join over the whole ledger: listings multiply the sums."""
    lines = join_leaves(td.ledger_fact(spark, d), "operating_unit", "S", _leaves(spark, d), td.OPER_NODE)
    return lines.groupBy("drill_date", "operating_unit").agg(F.count(F.lit(1)).alias("lines"), F.sum("amount").cast("decimal(38,4)").alias("amt"))


def q_nonzero_rounded(spark, d):
    """Balances of amounts with twelve decimals: many sums are not zero but
    round to it, and drop."""
    small = td.ledger_fact(spark, d).withColumn("amount", F.expr("amount * 0.00000001BD"))
    return nonzero(balance(small, X.LANDING_KEYS))


def q_landing_rule_index(spark, d):
    """The landing extract with its rules looked up in the rule index."""
    tagged = tag_segments_indexed(X.period_slice(_fact(spark, d), PERIOD), _leaves(spark, d), LANDING_RULES)
    return nonzero(balance(tagged, [FLAG, *X.LANDING_KEYS]))


def many_rules(spark, d, per_department: int = 40) -> list[SegmentRule]:
    """Overlapping rules: for every department of a nation, ranges of accounts
    that begin every 2,000 and are 3,000 long; every fourth also asks for a
    ledger, every fifth for a project under the capital projects' node."""
    capital = HierarchyRef("project_id", "J", td.PROJ_NODE, td.PROJ_TREE)
    nations = sorted(r["n_nationkey"] for r in td.table(spark, d, "nation").select("n_nationkey").distinct().collect())
    rules = []
    for n in nations:
        for i in range(per_department):
            ledger = (("ledger", "GAAP"),) if i % 4 == 0 else ()
            low = 10_000 + 2_000 * i
            rules.append(SegmentRule(
                f"{n}-{i}", (("deptid", f"2203{n:02d}"), *ledger), (str(low), str(low + 3_000)), hierarchies=(capital,) if i % 5 == 0 else ()
            ))
    return rules


def q_landing_many_rules(spark, d):
    """The landing extract under 40 rules per nation (1,000 for 25), by the
    index: one scan of the ledger, a plan of the same size as for two."""
    return X.landing(_fact(spark, d), _leaves(spark, d), many_rules(spark, d), PERIOD, RUN_TS)


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_landing_zone_map(spark, d):
    """The landing extract over the stored ledger, from the files that its zone
    map names only."""
    path = _scratch(spark, "ledger")
    write_ledger_fact(td.ledger_fact(spark, d), path)
    zones = refresh(spark, path, f"{path}-zones")
    return X.landing(read_matching(spark, path, zones, PERIOD, LANDING_RULES), _leaves(spark, d), LANDING_RULES, PERIOD, RUN_TS)


#: Last posting days of the two chained runs of ``journal_after_mark``.
CHAIN = (td.FIXTURE_WATERMARK, dt.date(1998, 6, 30))


def q_journal_after_mark(spark, d):
    """The second of two chained incremental runs: lines posted after the mark
    that the first one committed."""
    store = MarkStore(_scratch(spark, "marks"), "journal")
    inputs = (_fact(spark, d), _leaves(spark, d), td.operators(spark, d), JOURNAL_SCOPE, PERIOD)
    first = ExtractSpec(
        "journal", lambda _s, since: X.journal_watermarked(*inputs, bound=CHAIN[0], since=since, run_ts=RUN_TS),
        (ParquetTarget(_scratch(spark, "journal")),), high_water_column="posted", mark=store,
    )
    run_spec(spark, first)
    return X.journal_watermarked(*inputs, bound=CHAIN[1], since=store.read(spark).value, run_ts=RUN_TS)


def q_content_differences(spark, d):
    """Groups in which the landing extract differs between the landing rules
    and the line rules (which ask for one ledger)."""
    check = ContentCheck(lambda s: s.range(0), (FLAG,), ("gl_acct", "lgr", "ucmg_id", "ou", "loc", "dept"))
    line = X.landing(_fact(spark, d), _leaves(spark, d), LINE_RULES, PERIOD, RUN_TS)
    return content_differences(q_landing(spark, d), line, check)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "close_period_12": q_close_period_12,
    "close_period_20": q_close_period_20,
    "month_labels": q_month_labels,
    "string_range": q_string_range,
    "segment_a": q_segment_a,
    "segment_b": q_segment_b,
    "landing": q_landing,
    "landing_two_scan": q_landing_two_scan,
    "landing_shuffle": q_landing_shuffle,
    "landing_line": q_landing_line,
    "landing_line_posted": q_landing_line_posted,
    "control_count": q_control_count,
    "control_count_text": q_control_count_text,
    "reconcile": q_reconcile,
    "period_passthrough": q_period_passthrough,
    "hierarchy_semi": q_hierarchy_semi,
    "hierarchy_inner_fanout": q_hierarchy_inner_fanout,
    "operator_fallback": q_operator_fallback,
    "journal_summary": q_journal_summary,
    "journal_summary_shuffle": q_journal_summary_shuffle,
    "journal_detail": q_journal_detail,
    "watermark_scalar": q_watermark_scalar,
    "journal_watermarked": q_journal_watermarked,
    "nonzero_balance": q_nonzero_balance,
    "csv_text_view": q_csv_text_view,
    "duplicate_leaf_check": q_duplicate_leaf_check,
    "stored_count": q_stored_count,
    "hierarchy_semi_ledger": q_hierarchy_semi_ledger,
    "hierarchy_fanout_ledger": q_hierarchy_fanout_ledger,
    "nonzero_rounded": q_nonzero_rounded,
    "landing_rule_index": q_landing_rule_index,
    "landing_many_rules": q_landing_many_rules,
    "landing_zone_map": q_landing_zone_map,
    "journal_after_mark": q_journal_after_mark,
    "content_differences": q_content_differences,
}
