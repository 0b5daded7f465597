"""A hot key (one department / operator holding two thirds of the lines) on
the shuffle-join paths: the joins are salted, the hot key's lines are spread
over many join tasks, and the results equal the broadcast path."""

from decimal import Decimal

import pytest
from ledger_rows import RUN_TS, P, fact, leaves, operators, segment_b_row

from closeledger.operators.dimension import SALT_BUCKETS, hot_keys, repeat_hot, salted_join
from closeledger.operators.hierarchy import in_hierarchy, join_leaves
from closeledger.operators.membership import membership_filter
from closeledger.plans import extracts as X
from closeledger.plans.catalog import LANDING_RULES

SCOPE = X.JournalScope(node="OPER_GROUP")

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed_rows(n=3000):
    rows = []
    for i in range(n):
        hot = i % 3 != 0  # two thirds of the lines share one department
        rows.append(
            segment_b_row(
                account=f"{40000 + i % 500:05d}",
                deptid="220301" if hot else f"2203{i % 7:02d}",
                oprid="U1" if hot else f"U{i % 50}",
                line_descr=f"l{i}",
                amount=Decimal(i % 11 - 5).quantize(Decimal("0.0001")),
            )
        )
    return rows


def _salt_spread(f):
    """Distinct salt buckets taken by the hot department's lines."""
    from pyspark.sql import functions as F

    from closeledger.operators.dimension import SALT_BUCKETS

    hot = f.filter(F.col("deptid") == "220301")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in f.columns]), F.lit(SALT_BUCKETS))
    return hot.select(salt.alias("s")).distinct().count()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _final_plan(df):
    """Run ``df`` and return its final adaptive plan."""
    import contextlib
    import io

    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_landing_membership_skew(spark, skew_conf):
    f = fact(spark, _skewed_rows()).repartition(8)
    lv = leaves(spark)
    want = _rows(X.landing(f, lv, LANDING_RULES, P, RUN_TS))
    df = X.landing(f, lv, LANDING_RULES, P, RUN_TS, max_broadcast_rows=0)
    plan = _final_plan(df)
    assert "__salt" in plan and "BroadcastHashJoin" not in plan.split("== Final Plan ==")[0]
    assert _rows(df) == want and len(want) > 0
    # the hot department's lines go to many salt buckets, not one task
    salted = _salt_spread(f)
    assert salted >= 16, salted


def test_journal_operator_skew(spark, skew_conf):
    rows = [dict(r, operating_unit="02858") for r in _skewed_rows()]
    f = fact(spark, rows).repartition(8)
    want = _rows(X.journal_detail(f, leaves(spark), operators(spark), SCOPE, P, RUN_TS))
    df = X.journal_detail(f, leaves(spark), operators(spark), SCOPE, P, RUN_TS, max_broadcast_rows=0)
    assert "__salt" in _final_plan(df)
    assert _rows(df) == want and len(want) > 0


def _wide_leaves(spark, n):
    """A tree beyond a bound of ``n / 10`` rows: the fixture's leaves and
    ``n`` departments and projects that no line has."""
    extra = spark.range(n).selectExpr("'DEPT' treecd", "'DEPT_ROOT' node", "concat('D9', lpad(cast(id as string), 6, '0')) leaf")
    more = spark.range(n).selectExpr("'PROJ' treecd", "'CAPITAL_PROJ' node", "concat('J9', lpad(cast(id as string), 6, '0')) leaf")
    return leaves(spark).unionByName(extra).unionByName(more)


def _many_departments(n):
    """Lines over ``n`` departments, of which two are in the tree."""
    return [segment_b_row(account=f"{40000 + i % 90:05d}", deptid="220301" if i % 3 == 0 else f"77{i % n:04d}", line_descr=f"l{i}") for i in range(2000)]


def test_heavy_hitters_are_found_and_cold_keys_are_not(spark):
    from pyspark.sql import functions as F

    lines = fact(spark, _skewed_rows(2000)).withColumn("oprid", F.when(F.col("oprid") == "U1", "U1").otherwise(F.concat(F.lit("V"), F.col("line_descr"))))
    dept, user = hot_keys(lines, [F.col("deptid"), F.col("oprid")])
    assert "220301" in dept and user == ["U1"]
    assert hot_keys(lines.limit(0), [F.col("deptid")]) == [[]]
    assert hot_keys(lines.withColumn("deptid", F.lit(None).cast("string")), [F.col("deptid")]) == [[]]


def test_cold_dimension_rows_appear_once(spark):
    from pyspark.sql import functions as F

    side = spark.range(1000).selectExpr("concat('k', id) AS k", "id")
    salted = repeat_hot(side, F.col("k"), ["k3", "k9", "absent"])
    assert salted.count() == 998 + 2 * SALT_BUCKETS
    lines = spark.range(5000).selectExpr("CASE WHEN id % 3 > 0 THEN 'k3' WHEN id % 31 = 0 THEN NULL ELSE concat('k', id % 1500) END AS lk", "id AS line")
    for how in ("inner", "left", "left_semi"):
        want = _rows(lines.join(side, F.col("lk") == F.col("k"), how))
        assert _rows(salted_join(lines, side, F.col("lk"), F.col("k"), how)) == want
        assert _rows(salted_join(lines, side, F.col("lk"), F.col("k"), how, hot=[])) == want


def test_membership_filter_lets_members_and_the_stated_share_pass(spark):
    from pyspark.sql import functions as F

    members = spark.range(5000).selectExpr("concat('D', id) AS leaf")
    others = spark.range(5000, 105_000).selectExpr("concat('D', id) AS code")
    for bound in (10_000, 700):
        kept = membership_filter(members, "leaf", bound)
        assert kept.words <= bound and kept.table.count() <= kept.words
        assert kept.keep(members, F.col("leaf")).count() == 5000
        passed = kept.keep(others, F.col("code")).count() / 100_000
        assert abs(passed - kept.false_share) < 0.1 * kept.false_share + 0.002
    assert membership_filter(members, "leaf", 700).false_share > membership_filter(members, "leaf").false_share
    assert membership_filter(members, "leaf", 20) is None and membership_filter(members, "leaf", 0) is None
    none = membership_filter(members.limit(0), "leaf")
    assert none.keep(others, F.col("code")).isEmpty()
    assert kept.keep(spark.sql("SELECT cast(NULL AS string) code"), F.col("code")).isEmpty()


@pytest.mark.parametrize("limit", [60, 1])
def test_large_tree_moves_members_only(spark, limit):
    """``limit`` 60: too many used departments to broadcast, a filter fits; 1: not even that."""
    f, wide = fact(spark, _many_departments(400)).repartition(4), _wide_leaves(spark, 3000)
    want = _rows(X.landing(f, leaves(spark), LANDING_RULES, P, RUN_TS))
    assert want and _rows(X.landing(f, wide, LANDING_RULES, P, RUN_TS, max_broadcast_rows=limit)) == want
    assert _rows(X.landing(f, wide, LANDING_RULES, P, RUN_TS, max_broadcast_rows=0)) == want
    semi = _rows(in_hierarchy(f, "deptid", "D", leaves(spark), "DEPT_ROOT"))
    assert _rows(in_hierarchy(f, "deptid", "D", wide, "DEPT_ROOT", max_broadcast_rows=limit)) == semi
    inner = _rows(join_leaves(f, "deptid", "D", leaves(spark), "DEPT_ROOT"))
    assert _rows(join_leaves(f, "deptid", "D", wide, "DEPT_ROOT", max_broadcast_rows=limit)) == inner


def test_shuffled_rows_fall_to_members(spark):
    """Lines beyond the filter, of a tree whose used part is beyond the bound."""
    from pyspark.sql import functions as F

    from closeledger.operators.hierarchy import leaf_set
    from closeledger.operators.rules import HierarchyRef, SegmentRule, _thinned

    lines = spark.range(20_000).selectExpr("concat(lpad(cast(id % 4000 as string), 6, '0')) AS deptid", "'40000' AS account", "cast(1 as decimal(19,4)) AS amount")
    tree = spark.range(400).selectExpr("'T' AS treecd", "'N' AS node", "concat('D', lpad(cast(id as string), 6, '0')) AS leaf")
    rule = SegmentRule("A", account_range=("40000", "99999"), hierarchies=(HierarchyRef("deptid", "D", "N"),))
    side = leaf_set(tree, "N", distinct=False)
    key = F.concat(F.lit("D"), F.col("deptid"))
    thin = _thinned(lines, [rule], list(rule.hierarchies), [key], [(side, False)], 300)
    share = membership_filter(side, "leaf", 300).false_share
    assert 2000 <= thin.count() <= 2000 + 18_000 * (share * 2 + 0.01) and thin.columns == lines.columns
