"""Hand-made ledger rows for unit tests."""

import datetime as dt
from decimal import Decimal

from closeledger.sources.schema import FACT_COLUMNS, LEAVES, LEDGER_FACT, OPERATORS

P = dt.date(2026, 4, 1)
RUN_TS = dt.datetime(2026, 5, 5, 9, 15, 0, 123000)

BASE = dict(
    account="40000", ledger="GAAP", drill_date=P, project_id="10001", business_unit="20020",
    operating_unit="02858", location="L1", deptid="220210", line_descr='say "hi"', descr="d",
    descr254="x0", oprid="U1", source="S", journal_id="J1", posted_date=P, reversal_cd="N",
    amount=Decimal("1.0000"),
)


def fact(spark, rows):
    data = [tuple({**BASE, **r}[c] for c in FACT_COLUMNS) for r in rows]
    return spark.createDataFrame(data, LEDGER_FACT)


def leaves(spark):
    return spark.createDataFrame(
        [
            ("DEPT", "DEPT_ROOT", "D220210"),
            ("DEPT", "DEPT_ROOT", "D220210"),
            ("DEPT", "DEPT_ROOT", "D220301"),
            ("PROJ", "CAPITAL_PROJ", "J10001"),
            ("OPER", "OPER_GROUP", "S01000"),
            ("OPER", "OPER_GROUP", "S02858"),
            ("OPER_ALT", "OPER_GROUP", "S01000"),
        ],
        LEAVES,
    )


def operators(spark):
    return spark.createDataFrame([("U1", "Ann"), ("U2", None), ("U3", "Ann")], OPERATORS)


def segment_b_row(**kw):
    return {"operating_unit": "01000", "deptid": "220301", **kw}
