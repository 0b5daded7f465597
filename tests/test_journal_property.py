"""Journal balances against a brute-force Python evaluation, on random small
ledgers: leaf listings multiply, missing names fall back to the operator id,
two ids with one name merge, NULL projects and posting days behave as in SQL;
on the broadcast path and on the pre-aggregated salted shuffle path."""

from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from ledger_rows import RUN_TS, P, fact, leaves, operators

from closeledger.plans import extracts as X

SCOPE = X.JournalScope(node="OPER_GROUP")
# listings of each operating-unit leaf under OPER_GROUP (ledger_rows.leaves)
LISTINGS = {"S01000": 2, "S02858": 1}
NAMES = {"U1": "Ann", "U2": None, "U3": "Ann"}

rows_st = st.lists(
    st.fixed_dictionaries(
        {
            "ledger": st.sampled_from(["GAAP", "STAT"]),
            "operating_unit": st.sampled_from(["01000", "02858", "03000"]),
            "project_id": st.sampled_from(["10001", "20001", None]),
            "oprid": st.sampled_from(["U1", "U2", "U3", "U9"]),
            "journal_id": st.sampled_from(["J1", "J2"]),
            "posted_date": st.sampled_from([P, None]),
            "amount": st.integers(-3, 3).map(lambda i: Decimal(i).quantize(Decimal("0.0001"))),
        }
    ),
    min_size=1,
    max_size=25,
)


def _brute(rows):
    out = {}
    for r in rows:
        if r["ledger"] != "GAAP" or r["project_id"] is None or not r["project_id"].startswith("1"):
            continue
        n = LISTINGS.get("S" + r["operating_unit"], 0)
        if n == 0:
            continue
        user = NAMES.get(r["oprid"]) or r["oprid"]
        k = (r["operating_unit"], r["project_id"], r["journal_id"], r["posted_date"], user)
        out[k] = out.get(k, Decimal(0)) + n * r["amount"]
    return Counter(out.items())


def _spark(df):
    return Counter(((r.oper_unit, r.ucmg_id[1:], r.journal_id, r.posted_date, r.user), r.amt) for r in df.collect())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st)
def test_journal_summary_matches_brute_force(spark, rows):
    f = fact(spark, rows)
    want = _brute(rows)
    for limit in (500_000, 0):
        got = X.journal_summary(f, leaves(spark), operators(spark), SCOPE, P, RUN_TS, max_broadcast_rows=limit)
        assert _spark(got) == want
