"""The rule index against a plain evaluation of every rule on every line, and
the zone map against the whole fact."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from ledger_paths import SF_ORACLE, SF_SMALL
from ledger_rows import RUN_TS, P, fact, leaves
from pyspark.sql import functions as F

from closeledger.operators.rule_index import BINS, anchor_load, edges, intervals, tag_segments_indexed
from closeledger.operators.rules import HierarchyRef, SegmentRule, tag_segments_union
from closeledger.plans import extracts as X
from closeledger.plans.catalog import LANDING_RULES, PERIOD, many_rules
from closeledger.sinks.files import write_ledger_fact
from closeledger.sources import testdata as td
from closeledger.sources.schema import FACT_COLUMNS
from closeledger.sources.zone_map import listed_files, matching, read_matching, refresh, zones

TREE = {("DEPT", "N1"): {"D1", "D2"}, ("DEPT", "N2"): {"D2", "D3"}, ("ALT", "N1"): {"D3"}, ("PROJ", "N3"): {"J1", "J9"}}


def _random_rules(pick, n):
    rules = []
    for i in range(n):
        codes = [(c, pick.choice(v)) for c, v in (("business_unit", "ab"), ("deptid", "1234"), ("ledger", "GS")) if pick.random() < 0.6]
        ends = sorted(pick.choice(["", "1", "2", "20", "25", "3", "30 ", "4", "zz", "é"]) for _ in range(2))
        refs = [HierarchyRef("deptid", "D", pick.choice(["N1", "N2", "N9"]), pick.choice([None, "DEPT", "ALT"]))] if pick.random() < 0.4 else []
        refs += [HierarchyRef("project_id", "J", "N3")] if pick.random() < 0.2 else []
        rules.append(SegmentRule(
            f"r{i}", tuple(codes), tuple(pick.choice([ends, ends[::-1]])) if pick.random() < 0.7 else None,
            tuple(pick.sample(["1", "2", "25", "40", "é"], pick.randint(0, 3))), tuple(refs),
        ))
    return rules


def _holds(rule, row):
    if any(row[c] != v for c, v in rule.codes):
        return False
    terms = []
    if rule.account_range is not None:
        terms.append(rule.account_range[0] <= row["account"] <= rule.account_range[1])
    if rule.account_list:
        terms.append(row["account"] in rule.account_list)
    if terms and not any(terms):
        return False
    return all(
        row[h.column] is not None and any(h.letter + row[h.column] in found for (t, n), found in TREE.items() if n == h.node and h.tree in (None, t))
        for h in rule.hierarchies
    )


def _lines(pick, n):
    return [
        {"account": pick.choice(["", "1", "15", "2", "20", "22", "25", "3", "30 ", "4", "40", "zzz", "é", "éa"]), "business_unit": pick.choice("abc"),
         "deptid": pick.choice(["1", "2", "3", "4", None]), "ledger": pick.choice("GS"), "project_id": pick.choice(["1", "9", "5", None]), "descr": str(i % 7)}
        for i in range(n)
    ]


@pytest.mark.parametrize(("seed", "n"), [(1, 40), (2, 1000)])
@pytest.mark.parametrize("limit", [500_000, 0])
def test_index_equals_every_rule_on_every_line(spark, seed, n, limit):
    pick = random.Random(seed)
    rules, rows = _random_rules(pick, n), _lines(pick, 120)
    tree = spark.createDataFrame([(t, n, leaf) for (t, n), found in TREE.items() for leaf in [*found, *found]], "treecd string, node string, leaf string")
    got = tag_segments_indexed(fact(spark, rows), tree, rules, limit)
    assert got.columns == [*FACT_COLUMNS, "bus_flg"]
    full = [{**{"descr": r["descr"]}, **r} for r in rows]
    want = sorted((r["account"], r["deptid"] or "", r["descr"], rule.flag) for r in full for rule in rules if _holds(rule, r))
    assert sorted((r.account, r.deptid or "", r.descr, r.bus_flg) for r in got.collect()) == want and want


def test_plan_does_not_grow_with_the_rules(spark):
    def sized(n):
        rules = [SegmentRule(f"r{i}", (("deptid", str(i % 50)),), (str(10000 + i), str(10000 + 3 * i))) for i in range(n)]
        plan = tag_segments_indexed(fact(spark, [{}]), leaves(spark), rules)._jdf.queryExecution().optimizedPlan()
        return plan.toString(), plan.treeString().count("\n")

    (_, many), (text, more) = sized(200), sized(2000)
    assert many == more and "r1999" not in text


def test_intervals_and_bins():
    rule = SegmentRule("x", account_range=("2", "4"), account_list=("1", "3", "4", "5"))
    assert intervals(rule) == [("1", "1"), ("2", "4"), ("5", "5")]
    assert intervals(SegmentRule("x")) is None and intervals(SegmentRule("x", account_range=("4", "2"))) == []
    assert len(edges([(str(i), str(i + 1)) for i in range(5000)])) < BINS
    # a key of the index holds a bounded part of many rules
    rules = [SegmentRule(f"{d}-{i}", (("deptid", str(d)),), (f"{i:05d}", f"{i + 50:05d}")) for d in range(25) for i in range(0, 40_000, 1000)]
    assert max(anchor_load(rules).values()) <= 3


def test_many_rules_scan_the_fact_once_and_equal_the_union(spark, scratch):
    td.ledger_fact(spark, SF_SMALL).write.partitionBy("drill_date").parquet(f"{scratch}/fact")
    stored = spark.read.parquet(f"{scratch}/fact")
    rules = many_rules(spark, SF_SMALL)
    assert len(rules) == 1000
    df = X.landing(stored, td.leaves(spark, SF_SMALL), rules, PERIOD, RUN_TS)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert sum("drill_date" in line and "FileScan" in line for line in plan.splitlines()) == 1
    some = [r for r in rules if r.codes[0][1] in ("220301", "220303") and r.flag.split("-")[1] in "0 5 9 15 20 33".split()]
    union = X.landing(stored, td.leaves(spark, SF_SMALL), some, PERIOD, RUN_TS, single_pass=False)
    flags = [r.flag for r in some]
    assert sorted(map(tuple, df.filter(F.col("bus_flg").isin(flags)).collect()), key=repr) == sorted(map(tuple, union.collect()), key=repr)


def test_rules_with_equal_flags_or_other_account_columns_are_rejected(spark):
    with pytest.raises(ValueError, match="one flag"):
        tag_segments_indexed(fact(spark, [{}]), leaves(spark), [LANDING_RULES[0]] * 2)
    with pytest.raises(ValueError, match="account columns"):
        tag_segments_indexed(fact(spark, [{}]), leaves(spark), [SegmentRule("a"), SegmentRule("b", account_column="descr")])


def test_union_form_agrees_on_the_landing_rules(spark):
    lines = X.period_slice(td.ledger_fact(spark, SF_SMALL), PERIOD)
    tree = td.leaves(spark, SF_SMALL)
    got, want = tag_segments_indexed(lines, tree, LANDING_RULES), tag_segments_union(lines, tree, LANDING_RULES)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("zoned") / "fact")
    write_ledger_fact(td.ledger_fact(spark, SF_ORACLE), path, num_partitions=16, max_records_per_file=90)
    return path


def test_scan_lists_matching_files_only(spark, many_files, scratch):
    all_files = listed_files(spark, many_files).count()
    assert all_files >= 1000
    zone_map = refresh(spark, many_files, f"{scratch}/zones")
    files = matching(zone_map, PERIOD, LANDING_RULES)
    held = spark.read.parquet(many_files).filter((F.col("drill_date") == F.lit(PERIOD)) & (LANDING_RULES[0].column_predicate() | LANDING_RULES[1].column_predicate()))
    needed = {r[0] for r in held.select(F.col("_metadata.file_path")).distinct().collect()}
    assert needed <= set(files) and len(files) < 3 * len(needed) + 5 and len(files) < all_files / 20
    df = read_matching(spark, many_files, zone_map, PERIOD, LANDING_RULES)
    assert sorted(f.replace('file:///', 'file:/') for f in df.inputFiles()) == sorted(files)
    tree = td.leaves(spark, SF_ORACLE)
    want = X.landing(spark.read.parquet(many_files), tree, LANDING_RULES, PERIOD, RUN_TS)
    assert sorted(map(tuple, X.landing(df, tree, LANDING_RULES, PERIOD, RUN_TS).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert matching(zone_map, dt.date(2030, 1, 1)) == [] and read_matching(spark, many_files, zone_map, dt.date(2030, 1, 1)).isEmpty()
    assert len(matching(zone_map, PERIOD)) == zone_map.filter(F.col("lo_drill_date") == PERIOD.isoformat()).count()


def test_refresh_reads_new_footers_only(spark, scratch):
    path = f"{scratch}/fact"
    write_ledger_fact(fact(spark, [{}, {"account": "50000"}]), path, num_partitions=1)
    first = {r.file: r for r in refresh(spark, path, f"{scratch}/zones").collect()}
    write_ledger_fact(fact(spark, [{"drill_date": dt.date(2026, 5, 1), "amount": Decimal("2.0000")}]), path, num_partitions=1)
    [gone] = first
    second = {r.file: r for r in refresh(spark, path, f"{scratch}/zones").collect()}
    assert second[gone] == first[gone] and len(second) == 2
    os.remove(gone.removeprefix("file:"))
    assert set(r.file for r in refresh(spark, path, f"{scratch}/zones").collect()) == set(second) - {gone}


def test_unknown_columns_match(spark, many_files):
    found = zones(listed_files(spark, many_files), ["drill_date", "account", "nothing"])
    one = found.orderBy("file").first()
    assert one.lo_nothing is None and one.lo_account <= one.hi_account and one.lo_drill_date == one.hi_drill_date
    assert len(matching(found, PERIOD, [SegmentRule("a", (("nothing", "x"),))])) == len(matching(found, PERIOD))
    assert P not in {dt.date.fromisoformat(r.lo_drill_date) for r in found.select("lo_drill_date").distinct().collect()}
