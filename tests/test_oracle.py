"""Every catalogue query against its oracle SQL (DuckDB) at sf0.01."""

import pytest
from ledger_paths import SF_ORACLE, SF_SMALL
from oracle_check import compare, duck

import __spark_entry__ as entry_mod
from closeledger.plans.catalog import QUERIES
from closeledger.plans.oracle import ORACLE

# golden row counts from FIXTURES.md (sf0.001, sf0.01)
GOLDEN = {
    "segment_a": (13, 204),
    "segment_b": (19, 149),
    "landing": (32, 353),
    "landing_two_scan": (32, 353),
    "landing_shuffle": (32, 353),
    "landing_line": (60, 634),
    "landing_line_posted": (65, 714),
    "journal_summary": (49, 627),
    "journal_summary_shuffle": (49, 627),
    "journal_detail": (49, 695),
    "journal_watermarked": (38, 413),
    "hierarchy_semi": (50, 696),
    "hierarchy_inner_fanout": (69, 958),
    "duplicate_leaf_check": (2, 2),
    "period_passthrough": (308, 3509),
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_oracle_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    assert ok, msg
    if name in GOLDEN:
        assert msg == f"{GOLDEN[name][1]} rows"


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_golden_counts_small(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() == GOLDEN[name][0]


def test_control_count_value(spark):
    assert QUERIES["control_count"](spark, SF_SMALL).first().row_cnt == 32
    r = QUERIES["reconcile"](spark, SF_SMALL).first()
    assert (r.extract_rows, r.control_rows, r.matched) == (32, 32, True)


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.count() == 32
    assert df.columns == ["gl_acct", "lgr", "fisc_yr", "mo", "ucmg_id", "amt", "insrt_on", "bu", "ou", "loc", "dept", "bus_flg"]
