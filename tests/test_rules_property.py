"""Segment tagging against a brute-force Python evaluation of the rules, on
random small ledgers and random (possibly overlapping) rule sets."""

from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from ledger_rows import fact, leaves

from closeledger.operators.balances import balance
from closeledger.operators.rules import FLAG, HierarchyRef, SegmentRule, tag_segments, tag_segments_union

ACCOUNTS = ["40000", "40000 ", "99999", "99999 ", "15050", "15050 ", "39999", "50000"]
DEPT = HierarchyRef("deptid", "D", "DEPT_ROOT", "DEPT")
PROJ = HierarchyRef("project_id", "J", "CAPITAL_PROJ", "PROJ")
LEAF_SETS = {DEPT: {"D220210", "D220301"}, PROJ: {"J10001"}}
KEYS = ["account", "ledger", "project_id", "business_unit", "operating_unit", "deptid"]

rows_st = st.lists(
    st.fixed_dictionaries(
        {
            "account": st.sampled_from(ACCOUNTS),
            "ledger": st.sampled_from(["GAAP", "STAT"]),
            "business_unit": st.sampled_from(["20020", "10010", None]),
            "operating_unit": st.sampled_from(["02858", "01000"]),
            "deptid": st.sampled_from(["220210", "220301", "220399", None]),
            "project_id": st.sampled_from(["10001", "10002", None]),
            "amount": st.integers(-3, 3).map(lambda i: Decimal(i).quantize(Decimal("0.0001"))),
        }
    ),
    min_size=1,
    max_size=25,
)


@st.composite
def rule_st(draw, flag):
    codes = {}
    for col, values in (("business_unit", ["20020", "10010"]), ("operating_unit", ["02858", "01000"]), ("ledger", ["GAAP"])):
        if draw(st.booleans()):
            codes[col] = draw(st.sampled_from(values))
    rng = None
    if draw(st.booleans()):
        lo, hi = sorted(draw(st.lists(st.sampled_from(ACCOUNTS), min_size=2, max_size=2)))
        rng = (lo, hi)
    lst = tuple(draw(st.lists(st.sampled_from(["15050", "15055", "39999"]), max_size=2, unique=True)))
    hier = tuple(h for h in (DEPT, PROJ) if draw(st.booleans()))
    return SegmentRule(flag, tuple(codes.items()), rng, lst, hier)


rules_st = st.integers(1, 3).flatmap(lambda n: st.tuples(*[rule_st(f) for f in "ABC"[:n]]))


def _matches(rule: SegmentRule, row: dict) -> bool:
    for col, v in rule.codes:
        if row[col] is None or row[col] != v:
            return False
    acct = row["account"]
    terms = []
    if rule.account_range is not None:
        terms.append(rule.account_range[0] <= acct <= rule.account_range[1])
    if rule.account_list:
        terms.append(acct in rule.account_list)
    if terms and not any(terms):
        return False
    for h in rule.hierarchies:
        code = row[h.column]
        if code is None or h.letter + code not in LEAF_SETS[h]:
            return False
    return True


def _brute(rows, rules):
    sums = {}
    for r in rows:
        for rule in rules:
            if _matches(rule, r):
                k = (rule.flag, *[r[c] for c in KEYS])
                sums[k] = sums.get(k, Decimal(0)) + r["amount"]
    return Counter(sums.items())


def _spark(df):
    return Counter(((r[0], *r[1:-1]), r[-1]) for r in df.select(FLAG, *KEYS, "amt").collect())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, rules=rules_st)
def test_tagging_matches_brute_force(spark, rows, rules):
    f = fact(spark, rows)
    lv = leaves(spark)
    want = _brute(rows, rules)
    single = balance(tag_segments(f, lv, rules), [FLAG, *KEYS], cast=None)
    assert _spark(single) == want
    union = balance(tag_segments_union(f, lv, rules), [FLAG, *KEYS], cast=None)
    assert _spark(union) == want
