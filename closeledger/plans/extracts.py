"""The named ledger extracts, as lazy DataFrames.

Every extract groups on **raw** keys and formats (trims, tags, labels) only
after the aggregate, so look-alike codes stay separate groups and the
labels are computed once per group rather than once per line.

Physical shape (see ``.explain()`` in tests/test_plans.py):

* the period equality reaches the scan (partition pruning on a
  ``drill_date``-partitioned fact);
* segment extracts read the fact once, whatever the number of rules;
* hierarchy and operator lookups are broadcast hash joins when their size
  check passes (possibly after cutting the dimension to the keys the
  period's lines use), so the only shuffle is the aggregate's, after
  map-side partial aggregation;
* when a dimension is still too large, the join is salted so a hot key is
  spread over many tasks, and the journal extracts pre-aggregate the lines
  first (exact for sums) so the join moves groups, not lines.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeledger.functions.labels import (
    MONEY_SUM,
    load_date,
    lower_names,
    rename_positional,
    run_timestamp,
    scrub_quotes,
    tag,
    timestamp_text,
    trim_blank,
)
from closeledger.functions.period import calendar_month, calendar_year, fiscal_year_label, month_label
from closeledger.operators.balances import balance, nonzero, nonzero_keys
from closeledger.operators.control import row_count
from closeledger.operators.dimension import DEFAULT_BROADCAST_ROWS, broadcast_or_restrict, hot_keys, salted_join
from closeledger.operators.hierarchy import leaf_set
from closeledger.operators.membership import membership_filter
from closeledger.operators.rule_index import tag_segments_indexed
from closeledger.operators.rules import FLAG, SegmentRule, tag_one, tag_segments, tag_segments_union
from closeledger.operators.watermark import up_to, watermark_bound

#: Rules that stand in a plan one by one.
INDEXED_RULES = 16

LANDING_KEYS = ["account", "ledger", "drill_date", "project_id", "business_unit", "operating_unit", "location", "deptid"]
LINE_KEYS = LANDING_KEYS + ["line_descr", "descr", "descr254", "oprid", "journal_id", "source"]
LINE_POSTED_KEYS = LINE_KEYS + ["posted_date"]

JOURNAL_SUMMARY_KEYS = [
    "account", "ledger", "drill_date", "project_id", "business_unit", "operating_unit",
    "location", "deptid", "reversal_cd", "journal_id", "posted_date",
]
JOURNAL_DETAIL_KEYS = [
    "account", "ledger", "drill_date", "project_id", "line_descr", "descr", "oprid", "source",
    "journal_id", "business_unit", "operating_unit", "location", "deptid", "posted_date", "reversal_cd",
]
JOURNAL_WATERMARK_KEYS = [
    "business_unit", "operating_unit", "account", "location", "deptid", "journal_id", "project_id",
    "line_descr", "drill_date", "source", "posted_date", "reversal_cd", "descr",
]

# Column names of the CSV files, by position (some carry blanks).
CSV_NAMES = {
    "landing": ["gl_acct", "lgr", "fisc_yr", "mo", "ucmg_id", "amt", "insrt_on", "bu", "ou", "loc", "dept", "bus_flg"],
    "control_count": ["insert_on", "row_cnt"],
    "stored_count": ["insert_on", "row_cnt"],
    "journal_summary": [
        "gl_acct", "lgr", "fisc_yr", "mo", "ucmg_id", "amt", "insrt_on", "unit", "oper unit",
        "location", "dept", "reversal_cd", "user", "journal_id", "posted_date",
    ],
    "journal_detail": [
        "gl_acct", "lgr", "fisc_yr", "mo", "ucmg_id", "amt", "line_desc", "descr", "user", "src",
        "jnl_id", "insrt_on", "unit", "oper unit", "location", "dept", "posted_date", "reversal_cd",
    ],
    "journal_watermarked": [
        "unit", "oper unit", "account", "location", "dept", "journal id", "user", "project",
        "line descr", "year", "period", "source", "amount", "posted", "reversal_cd", "runtime", "descr",
    ],
}


@dataclass(frozen=True)
class JournalScope:
    """Which lines the journal extracts read: one ledger, projects with a
    code prefix, operating units that are leaves under ``node`` (any tree
    unless ``tree`` is given)."""

    node: str
    ledger: str = "GAAP"
    project_prefix: str = "1"
    unit_column: str = "operating_unit"
    unit_letter: str = "S"
    tree: str | None = None


def period_slice(fact: DataFrame, period: dt.date | Column) -> DataFrame:
    p = period if isinstance(period, Column) else F.lit(period)
    return fact.filter(F.col("drill_date") == p)


# ---------------------------------------------------------------------------
# landing-grain extracts (segment rules)
# ---------------------------------------------------------------------------


def segment_balances(
    fact: DataFrame,
    leaves: DataFrame,
    rules: list[SegmentRule] | tuple[SegmentRule, ...],
    period: dt.date | Column,
    keys: list[str],
    single_pass: bool = True,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Non-zero balances per (segment flag, raw keys) for one period.  More
    than ``INDEXED_RULES`` rules are looked up in an index instead of standing
    in the plan one by one; the lines found are the same."""
    lines = period_slice(fact, period)
    if single_pass and len(rules) > INDEXED_RULES:
        tagged = tag_segments_indexed(lines, leaves, rules, max_broadcast_rows)
    elif single_pass:
        tagged = tag_segments(lines, leaves, rules, max_broadcast_rows, grain=keys)
    else:
        tagged = tag_segments_union(lines, leaves, rules, max_broadcast_rows)
    return nonzero(balance(tagged, [FLAG, *keys]))


def _landing_head() -> list[Column]:
    return [
        tag("A", "account", trim=True).alias("gl_acct"),
        trim_blank("ledger").alias("lgr"),
        fiscal_year_label("drill_date").alias("fisc_yr"),
        month_label("drill_date").alias("mo"),
        tag("J", "project_id").alias("ucmg_id"),
        F.col("amt"),
    ]


def _landing_tail() -> list[Column]:
    return [
        trim_blank("business_unit").alias("bu"),
        trim_blank("operating_unit").alias("ou"),
        trim_blank("location").alias("loc"),
        trim_blank("deptid").alias("dept"),
        F.col(FLAG),
    ]


def _stamp(run_ts: dt.datetime | None, text: bool) -> Column:
    return timestamp_text(run_ts) if text else run_timestamp(run_ts)


def landing(
    fact: DataFrame,
    leaves: DataFrame,
    rules,
    period,
    run_ts: dt.datetime | None = None,
    ts_text: bool = False,
    single_pass: bool = True,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """EXT-1: segment balances at landing grain (8 raw keys)."""
    b = segment_balances(fact, leaves, rules, period, LANDING_KEYS, single_pass, max_broadcast_rows)
    return b.select(*_landing_head(), _stamp(run_ts, ts_text).alias("insrt_on"), *_landing_tail())


def landing_line(
    fact: DataFrame,
    leaves: DataFrame,
    rules,
    period,
    run_ts: dt.datetime | None = None,
    with_posted_date: bool = False,
    single_pass: bool = True,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """EXT-2 / EXT-3: balances at journal-line grain.  ``descr254`` is a
    grouping key but not an output column, so rows may look alike."""
    keys = LINE_POSTED_KEYS if with_posted_date else LINE_KEYS
    b = segment_balances(fact, leaves, rules, period, keys, single_pass, max_broadcast_rows)
    cols = [
        *_landing_head(),
        trim_blank("line_descr").alias("line_desc"),
        trim_blank("descr").alias("descr"),
        trim_blank("oprid").alias("opr_id"),
        trim_blank("source").alias("src"),
        trim_blank("journal_id").alias("jnl_id"),
        run_timestamp(run_ts).alias("insrt_on"),
        *_landing_tail(),
    ]
    if with_posted_date:
        cols.append(F.col("posted_date").alias("pst_dt"))
    return b.select(*cols)


def control_count(
    fact: DataFrame,
    leaves: DataFrame,
    rules,
    period,
    run_ts: dt.datetime | None = None,
    ts_text: bool = False,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """EXT-4: recount of the landing extract's groups by another way, the
    keys of each rule's own aggregate under UNION ALL; one row
    ``(insrt_on, row_cnt)`` with the load date (or the timestamp text)."""
    lines = period_slice(fact, period)
    parts = [nonzero_keys(tag_one(lines, leaves, r, max_broadcast_rows), list(LANDING_KEYS)) for r in rules]
    stamp = timestamp_text(run_ts) if ts_text else load_date(run_ts)
    return row_count(reduce(lambda a, b: a.unionByName(b), parts), stamp)


def period_passthrough(fact: DataFrame, period) -> DataFrame:
    """EXT-5: every fact column of one period, names lower-cased."""
    return lower_names(period_slice(fact, period))


def stored_count(counts: DataFrame) -> DataFrame:
    """EXT-8: the stored control-count table, renamed by position."""
    return rename_positional(counts, ["insert_on", "row_cnt"])


# ---------------------------------------------------------------------------
# journal extracts (hierarchy inner join + operator lookup)
# ---------------------------------------------------------------------------


def journal_balances(
    fact: DataFrame,
    leaves: DataFrame,
    operators: DataFrame,
    scope: JournalScope,
    period,
    keys: list[str],
    bound: Column | dt.date | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    since: dt.date | None = None,
) -> DataFrame:
    """Sum of ``amount`` per raw ``keys`` plus ``user`` (operator name, or the
    operator id when the name is missing), over lines of ``scope`` joined to
    the leaf table (listings multiply) and to the operator dimension."""
    lines = period_slice(fact, period).filter(
        (F.col("ledger") == F.lit(scope.ledger)) & F.col("project_id").startswith(scope.project_prefix)
    )
    if bound is not None:
        lines = up_to(lines, bound)
    if since is not None:
        lines = lines.filter(F.col("posted_date") > F.lit(since))

    units = leaf_set(leaves, scope.node, scope.tree, distinct=False).select(F.col("leaf").alias("__leaf"))
    ops = operators.select(F.col("employeeid").alias("__opid"), F.col("employeename").alias("__opname"))
    unit_key = tag(scope.unit_letter, F.col(scope.unit_column))
    (units, units_small), (ops, ops_small) = broadcast_or_restrict(
        [units, ops], ["__leaf", "__opid"], [unit_key, F.col("oprid")], lines, max_broadcast_rows
    )

    unit_hot = op_hot = None
    if not (units_small and ops_small):
        if not units_small and (kept := membership_filter(units, "__leaf", max_broadcast_rows)) is not None:
            lines = kept.keep(lines, unit_key)
        # one pass of the lines tells the hot keys of both joins
        unit_hot, op_hot = hot_keys(lines, [unit_key, F.col("oprid")])
        # a shuffle join is coming: move groups, not lines.  Summing before
        # the join is exact because the join only multiplies or keeps rows.
        pre_keys = list(dict.fromkeys([*keys, scope.unit_column, "oprid"]))
        lines = lines.groupBy(*pre_keys).agg(F.sum("amount").alias("amount"))

    def join(left, right, key, side_key, how, small, hot):
        return left.join(right, key == side_key, how) if small else salted_join(left, right, key, side_key, how, hot)

    joined = join(lines, units, unit_key, F.col("__leaf"), "inner", units_small, unit_hot)
    joined = join(joined, ops, F.col("oprid"), F.col("__opid"), "left", ops_small, op_hot)
    user = F.coalesce(F.col("__opname"), F.col("oprid")).alias("user")
    return joined.groupBy(*keys, user).agg(F.sum("amount").cast(MONEY_SUM).alias("amt"))


def journal_summary(
    fact: DataFrame,
    leaves: DataFrame,
    operators: DataFrame,
    scope: JournalScope,
    period,
    run_ts: dt.datetime | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """EXT-6: journal balances; zero balances kept, sum not rounded."""
    b = journal_balances(fact, leaves, operators, scope, period, JOURNAL_SUMMARY_KEYS, None, max_broadcast_rows)
    return b.select(
        tag("A", "account").alias("gl_acct"),
        F.col("ledger").alias("lgr"),
        fiscal_year_label("drill_date").alias("fisc_yr"),
        month_label("drill_date", upper=False).alias("mo"),
        tag("J", "project_id").alias("ucmg_id"),
        "amt",
        timestamp_text(run_ts).alias("insrt_on"),
        F.col("business_unit").alias("unit"),
        F.col("operating_unit").alias("oper_unit"),
        "location",
        F.col("deptid").alias("dept"),
        "reversal_cd",
        "user",
        "journal_id",
        "posted_date",
    )


def journal_detail(
    fact: DataFrame,
    leaves: DataFrame,
    operators: DataFrame,
    scope: JournalScope,
    period,
    run_ts: dt.datetime | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """EXT-7: journal balances at line grain; grouped on the raw line text
    and the raw operator id, shown with quotes scrubbed and the name."""
    b = journal_balances(fact, leaves, operators, scope, period, JOURNAL_DETAIL_KEYS, None, max_broadcast_rows)
    return b.select(
        tag("A", "account").alias("gl_acct"),
        F.col("ledger").alias("lgr"),
        fiscal_year_label("drill_date").alias("fisc_yr"),
        month_label("drill_date", upper=False).alias("mo"),
        tag("J", "project_id").alias("ucmg_id"),
        "amt",
        scrub_quotes("line_descr").alias("line_desc"),
        "descr",
        "user",
        F.col("source").alias("src"),
        F.col("journal_id").alias("jnl_id"),
        timestamp_text(run_ts).alias("insrt_on"),
        F.col("business_unit").alias("unit"),
        F.col("operating_unit").alias("oper_unit"),
        "location",
        F.col("deptid").alias("dept"),
        "posted_date",
        "reversal_cd",
    )


def journal_watermarked(
    fact: DataFrame,
    leaves: DataFrame,
    operators: DataFrame,
    scope: JournalScope,
    period,
    posted_dates: DataFrame | None = None,
    bound: Column | dt.date | None = None,
    run_ts: dt.datetime | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    since: dt.date | None = None,
) -> DataFrame:
    """EXT-9: incremental journal extract, lines posted up to the watermark
    (the latest already-extracted posting day, or ``bound`` if given) and, with
    ``since``, after that day.  With both days given (a stored mark and a closed
    posting day) the fact is scanned once."""
    if bound is None:
        if posted_dates is None:
            raise ValueError("give posted_dates or bound")
        bound = watermark_bound(posted_dates)
    b = journal_balances(fact, leaves, operators, scope, period, JOURNAL_WATERMARK_KEYS, bound, max_broadcast_rows, since)
    return b.select(
        F.col("business_unit").alias("unit"),
        F.col("operating_unit").alias("oper_unit"),
        "account",
        "location",
        F.col("deptid").alias("dept"),
        "journal_id",
        "user",
        F.col("project_id").alias("project"),
        scrub_quotes("line_descr").alias("line_descr"),
        calendar_year("drill_date").alias("year"),
        calendar_month("drill_date").alias("period"),
        "source",
        F.col("amt").alias("amount"),
        F.col("posted_date").alias("posted"),
        "reversal_cd",
        run_timestamp(run_ts).alias("runtime"),
        "descr",
    )
