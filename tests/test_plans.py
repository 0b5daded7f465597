"""Physical-plan checks: one fact scan, filters at the scan, partition
pruning, broadcast joins behind the size check, no sort-merge joins."""

import contextlib
import io

import pytest
from ledger_paths import SF_SMALL

from closeledger.plans import extracts as X
from closeledger.plans.catalog import JOURNAL_SCOPE, LANDING_RULES, PERIOD, QUERIES, RUN_TS
from closeledger.sources import testdata as td


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _scans(text, table):
    """Number of scan nodes reading ``table`` in a formatted plan."""
    return sum(1 for ln in text.splitlines() if ln.startswith("Location:") and f"/{table}.parquet]" in ln)


def test_control_count_scans_once_per_rule(spark):
    # the recount is the rules' own aggregates under UNION ALL, not the extract's single pass
    assert _scans(plan(QUERIES["control_count"](spark, SF_SMALL)), "lineitem") == 2


@pytest.mark.parametrize("name", ["landing", "landing_line", "csv_text_view"])
def test_segment_extracts_scan_fact_once(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert _scans(text, "lineitem") == 1, text
    assert "SortMergeJoin" not in text
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text


def test_two_scan_form_scans_twice(spark):
    text = plan(QUERIES["landing_two_scan"](spark, SF_SMALL))
    assert _scans(text, "lineitem") == 2


def test_journal_extracts_broadcast_dimensions(spark):
    for name in ("journal_summary", "journal_detail", "journal_watermarked"):
        text = plan(QUERIES[name](spark, SF_SMALL))
        assert text.count("BroadcastHashJoin") >= 2, text
        assert "SortMergeJoin" not in text
        # one aggregate shuffle over the lines, after partial aggregation
        assert "partial_sum" in text


def test_watermark_is_a_scalar_subquery(spark):
    text = plan(QUERIES["journal_watermarked"](spark, SF_SMALL))
    assert "Subquery" in text


def test_partitioned_fact_prunes_partitions(spark, scratch):
    fact = td.ledger_fact(spark, SF_SMALL)
    path = f"{scratch}/fact"
    fact.write.partitionBy("drill_date").parquet(path)
    stored = spark.read.parquet(path)
    df = X.landing(stored, td.leaves(spark, SF_SMALL), LANDING_RULES, PERIOD, RUN_TS)
    text = plan(df)
    assert "PartitionFilters: [isnotnull(drill_date" in text and "(drill_date#" in text and "= 1998-04-01)" in text
    assert "PushedFilters: [" in text and "EqualTo(business_unit,20020)" in text
    assert df.count() == 32
    # column pruning: the landing extract never reads the line text columns
    scan = [ln for ln in text.splitlines() if ln.startswith("ReadSchema:") and "account" in ln][0]
    assert "line_descr" not in scan and "descr254" not in scan


def test_shuffle_fallback_when_dimension_too_large(spark):
    t = td.ledger_tables(spark, SF_SMALL)
    df = X.journal_summary(t.fact, t.leaves, t.operators, JOURNAL_SCOPE, PERIOD, RUN_TS, max_broadcast_rows=0)
    text = plan(df)
    assert "BroadcastHashJoin" not in text
    assert "SortMergeJoin Inner" in text and "SortMergeJoin LeftOuter" in text
    assert text.count("HashAggregate") >= 4  # pre-aggregation before the joins, final after


def test_close_period_stays_in_codegen(spark):
    text = plan(QUERIES["close_period_12"](spark, SF_SMALL), "formatted")
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "trunc(CASE WHEN (dayofmonth(" in text  # the rule is one built-in expression


def test_large_leaf_set_is_cut_to_used_codes_then_broadcast(spark):
    # the department node lists 8 leaves; the period's lines use 4 of them.
    # With a bound of 5 the set fails the first check, passes after the cut
    # and is broadcast; the project set (40 listings, most used) is not.
    t = td.ledger_tables(spark, SF_SMALL, PERIOD)
    df = X.landing(t.fact, t.leaves, LANDING_RULES, PERIOD, RUN_TS, max_broadcast_rows=5)
    text = plan(df)
    assert text.count("BroadcastHashJoin LeftOuter") == 2, text  # department flag join, membership filter of the projects
    assert text.count("__bits") > 0
    assert text.count("SortMergeJoin LeftOuter") == 1, text  # project flag join
    assert df.count() == 32


def test_ledger_layout_clusters_codes_and_prunes(spark, scratch):
    from closeledger.sinks.files import write_ledger_fact

    path = f"{scratch}/fact"
    write_ledger_fact(td.ledger_fact(spark, SF_SMALL), path, num_partitions=256)
    import glob

    period_files = glob.glob(f"{path}/drill_date=1998-04-01/*.parquet")
    assert len(period_files) > 1  # a period is spread over several files
    stored = spark.read.parquet(path)
    df = X.landing(stored, td.leaves(spark, SF_SMALL), LANDING_RULES, PERIOD, RUN_TS)
    text = plan(df)
    assert "PartitionFilters: [isnotnull(drill_date" in text
    assert "EqualTo(business_unit,20020)" in text
    assert df.count() == 32
    # files are contiguous bands of the range key: rows sorted inside each
    # file, and a (business unit, operating unit) combination spans files
    # only at band edges
    import pyarrow.parquet as pq

    pairs, combos = 0, set()
    for f in period_files:
        t = pq.read_table(f, columns=["business_unit", "operating_unit", "account"]).to_pylist()
        keys = [(r["business_unit"], r["operating_unit"], r["account"]) for r in t]
        assert keys == sorted(keys, key=lambda k: tuple("" if v is None else v for v in k))
        file_combos = {k[:2] for k in keys}
        pairs += len(file_combos)
        combos |= file_combos
    assert pairs <= len(period_files) + len(combos) - 1


def test_journal_scan_prunes_and_pushes_over_stored_fact(spark, scratch):
    from closeledger.sinks.files import write_ledger_fact

    path = f"{scratch}/fact"
    write_ledger_fact(td.ledger_fact(spark, SF_SMALL), path, num_partitions=16)
    t = td.ledger_tables(spark, SF_SMALL)
    df = X.journal_summary(spark.read.parquet(path), t.leaves, t.operators, JOURNAL_SCOPE, PERIOD, RUN_TS)
    text = plan(df)
    scan = text[text.index("Scan parquet"):]
    assert "PartitionFilters: [isnotnull(drill_date" in scan
    assert "EqualTo(ledger,GAAP)" in scan and "StringStartsWith(project_id,1)" in scan
    read_schema = [ln for ln in scan.splitlines() if ln.startswith("ReadSchema:")][0]
    for unused in ("descr254", "line_descr", "source"):
        assert unused not in read_schema
    assert df.count() == 49
