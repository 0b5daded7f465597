"""Hand rows for the semantic traps of the extracts."""

import datetime as dt
from decimal import Decimal

from ledger_rows import RUN_TS, P, fact, leaves, operators, segment_b_row
from pyspark.sql import functions as F

from closeledger.operators.balances import balance, nonzero
from closeledger.operators.hierarchy import duplicate_leaf_impact, duplicate_leaves, in_hierarchy, join_leaves
from closeledger.operators.rules import SegmentRule, tag_segments
from closeledger.operators.watermark import EMPTY_WATERMARK, watermark_frame
from closeledger.plans import extracts as X
from closeledger.plans.catalog import LANDING_RULES, LINE_RULES, SEGMENT_A, SEGMENT_B
from closeledger.sources.schema import POSTED_DATES

SCOPE = X.JournalScope(node="OPER_GROUP")


def landing(spark, rows, rules=LANDING_RULES):
    return X.landing(fact(spark, rows), leaves(spark), rules, P, RUN_TS)


def test_grouping_on_raw_keys_output_trimmed(spark):
    # T-1: '40000' and '40000 ' are two groups that print alike
    out = landing(spark, [{"account": "40000"}, {"account": "40000 "}]).collect()
    assert len(out) == 2
    assert {r.gl_acct for r in out} == {"A40000"}


def test_predicates_use_raw_values(spark):
    # T-2: a trailing blank puts '99999 ' above the range and '15050 ' off the list
    out = landing(
        spark,
        [
            {"account": "99999 "},
            {"account": "99999"},
            segment_b_row(account="15050 "),
            segment_b_row(account="15050"),
        ],
    ).collect()
    assert sorted((r.gl_acct, r.bus_flg) for r in out) == [("A15050", "B"), ("A99999", "A")]


def test_semi_join_never_multiplies_inner_join_does(spark):
    # T-4: S01000 is listed twice under OPER_GROUP (two trees)
    f = fact(spark, [{"operating_unit": "01000"}, {"operating_unit": "03000"}])
    for limit in (500_000, 1, 0):  # broadcast, cut to used codes, salted shuffle
        assert in_hierarchy(f, "operating_unit", "S", leaves(spark), "OPER_GROUP", max_broadcast_rows=limit).count() == 1
        assert join_leaves(f, "operating_unit", "S", leaves(spark), "OPER_GROUP", max_broadcast_rows=limit).count() == 2
    # membership through a duplicated leaf (D220210 listed twice) keeps one row
    b = landing(spark, [segment_b_row(deptid="220210")], (SEGMENT_B,)).collect()
    assert len(b) == 1 and b[0].amt == Decimal("1.0000")


def test_null_codes(spark):
    # T-5: NULL project kept by rule A (tag NULL), NULL dept / project dropped by rule B
    out = landing(
        spark,
        [
            {"project_id": None},
            segment_b_row(deptid=None),
            segment_b_row(project_id=None),
        ],
    ).collect()
    assert [(r.bus_flg, r.ucmg_id) for r in out] == [("A", None)]


def test_zero_test_on_rounded_sum_and_half_away_from_zero(spark):
    # T-7 with a wider source precision than the landing money type
    df = spark.createDataFrame(
        [("k0", Decimal("0.00004")), ("k1", Decimal("1.00005")), ("k2", Decimal("-1.00005")), ("k3", None)],
        "k string, amount decimal(38,10)",
    )
    got = {r.k: r.amt for r in nonzero(balance(df, ["k"])).collect()}
    assert got == {"k1": Decimal("1.0001"), "k2": Decimal("-1.0001")}


def test_reversal_cancels_at_landing_grain_not_at_line_grain(spark):
    # T-3: descr254 is a hidden grouping key of the line extract
    rows = [{"descr254": "x0"}, {"descr254": "x9", "amount": Decimal("-1.0000"), "reversal_cd": "Y"}]
    assert landing(spark, rows).count() == 0
    line = X.landing_line(fact(spark, rows), leaves(spark), LINE_RULES, P, RUN_TS).collect()
    assert len(line) == 2
    assert len({tuple(v for k, v in r.asDict().items() if k != "amt") for r in line}) == 1


def test_overlapping_rules_give_one_row_per_rule(spark):
    twin = SegmentRule(flag="C", codes=SEGMENT_A.codes, account_range=SEGMENT_A.account_range)
    f = fact(spark, [{}])
    single = X.landing(f, leaves(spark), (SEGMENT_A, twin), P, RUN_TS).collect()
    union = X.landing(f, leaves(spark), (SEGMENT_A, twin), P, RUN_TS, single_pass=False).collect()
    assert sorted(r.bus_flg for r in single) == ["A", "C"] == sorted(r.bus_flg for r in union)


def test_null_sum_dropped(spark):
    assert landing(spark, [{"amount": None}]).count() == 0


def test_journal_keeps_zero_balances_and_unrounded_type(spark):
    # T-8
    rows = [{"operating_unit": "02858", "amount": Decimal("2.5000")}, {"operating_unit": "02858", "amount": Decimal("-2.5000")}]
    out = X.journal_summary(fact(spark, rows), leaves(spark), operators(spark), SCOPE, P, RUN_TS)
    got = out.collect()
    assert len(got) == 1 and got[0].amt == 0
    assert dict(out.dtypes)["amt"] == "decimal(38,4)"


def test_run_timestamp_pinned_and_formatted(spark):
    # T-9 / Q-9: one value per run, 24-hour text with milliseconds
    rows = [{"operating_unit": "02858", "account": a} for a in ("50000", "60000")]
    out = X.journal_summary(fact(spark, rows), leaves(spark), operators(spark), SCOPE, P, dt.datetime(2026, 5, 5, 15, 4, 5, 60000))
    assert {r.insrt_on for r in out.collect()} == {"2026-05-05 15:04:05.060"}


def test_watermark_drops_null_posted_dates(spark):
    # T-10: NULL posted_date stays in the summary, drops under the watermark
    rows = [{"operating_unit": "02858", "posted_date": None}, {"operating_unit": "02858", "posted_date": P}]
    f = fact(spark, rows)
    assert X.journal_summary(f, leaves(spark), operators(spark), SCOPE, P, RUN_TS).count() == 2
    wm = X.journal_watermarked(f, leaves(spark), operators(spark), SCOPE, P, bound=dt.date(2026, 12, 31), run_ts=RUN_TS)
    assert [r.posted for r in wm.collect()] == [P]


def test_empty_watermark_table(spark):
    empty = spark.createDataFrame([], POSTED_DATES)
    assert watermark_frame(empty).first().bound == EMPTY_WATERMARK
    f = fact(spark, [{"operating_unit": "02858", "posted_date": dt.date(1899, 12, 31)}, {"operating_unit": "02858"}])
    wm = X.journal_watermarked(f, leaves(spark), operators(spark), SCOPE, P, posted_dates=empty, run_ts=RUN_TS)
    assert [r.posted for r in wm.collect()] == [dt.date(1899, 12, 31)]


def test_name_fallback_and_shared_names(spark):
    # PRJ-11: NULL name falls back to the id; two ids with one name merge in
    # the summary but not in the detail (raw oprid is a detail key)
    rows = [
        {"operating_unit": "02858", "oprid": "U1"},
        {"operating_unit": "02858", "oprid": "U3"},
        {"operating_unit": "02858", "oprid": "U2"},
        {"operating_unit": "02858", "oprid": "U9"},
    ]
    f = fact(spark, rows)
    summary = X.journal_summary(f, leaves(spark), operators(spark), SCOPE, P, RUN_TS).collect()
    assert sorted((r.user, r.amt) for r in summary) == [("Ann", 2), ("U2", 1), ("U9", 1)]
    detail = X.journal_detail(f, leaves(spark), operators(spark), SCOPE, P, RUN_TS).collect()
    assert sorted(r.user for r in detail) == ["Ann", "Ann", "U2", "U9"]
    assert {r.line_desc for r in detail} == {"say  hi "}


def test_journal_inner_join_multiplies_on_duplicate_listing(spark):
    # Q-7: S01000 sits under OPER_GROUP in two trees, amounts double
    out = X.journal_summary(fact(spark, [{"operating_unit": "01000"}]), leaves(spark), operators(spark), SCOPE, P, RUN_TS)
    assert [r.amt for r in out.collect()] == [2]
    dups = {(r.node, r.leaf): (r.listings, r.trees) for r in duplicate_leaves(leaves(spark)).collect()}
    assert dups == {("OPER_GROUP", "S01000"): (2, 2), ("DEPT_ROOT", "D220210"): (2, 1)}


def test_tagging_keeps_nothing_else(spark):
    f = fact(spark, [{"business_unit": "10010"}, {"ledger": "STAT"}, {}])
    tagged = tag_segments(f, leaves(spark), LANDING_RULES)
    assert [r.bus_flg for r in tagged.collect()] == ["A"]
    assert set(tagged.columns) == set(f.columns) | {"bus_flg"}


def test_period_filter(spark):
    rows = [{}, {"drill_date": dt.date(2026, 3, 1)}]
    assert landing(spark, rows).count() == 1
    assert X.period_passthrough(fact(spark, rows), P).count() == 1
    assert X.period_passthrough(fact(spark, rows), F.lit(P)).columns == [c.lower() for c in fact(spark, rows).columns]


def test_duplicate_leaf_impact_counts_affected_lines(spark):
    f = fact(spark, [{"operating_unit": "01000"}, {"operating_unit": "01000", "deptid": "220301"}, {"deptid": None}])
    for limit in (500_000, 1, 0):  # broadcast, cut to used codes, salted
        got = {(r.node, r.leaf): (r.listings, r.trees, r.lines) for r in duplicate_leaf_impact(f, leaves(spark), max_broadcast_rows=limit).collect()}
        # S01000: two lines; D220210: the one line with the default dept
        assert got == {("OPER_GROUP", "S01000"): (2, 2, 2), ("DEPT_ROOT", "D220210"): (2, 1, 1)}
