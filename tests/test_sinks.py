"""CSV contract, multi-target publishing, Parquet by period, JDBC append
(embedded in-memory Derby inside the Spark JVM, no server), audit rows and
the spec runner."""

import datetime as dt
import glob
import uuid
from decimal import Decimal

import pytest
from ledger_paths import SF_SMALL
from ledger_rows import RUN_TS, P, fact, leaves
from pyspark.sql import functions as F

from closeledger.plans import extracts as X
from closeledger.plans.catalog import LANDING_RULES, QUERIES
from closeledger.plans.runner import ExtractSpec, run_all, run_spec
from closeledger.sinks.audit import AuditLog
from closeledger.sinks.files import CsvTarget, ParquetTarget, read_csv, write_csv
from closeledger.sinks.jdbc import JdbcTarget
from closeledger.sinks.publish import publish


def _csv_bytes(path):
    parts = sorted(glob.glob(f"{path}/part-*.csv"))
    return b"".join(open(p, "rb").read() for p in parts)


def test_csv_contract_bytes(spark, scratch):
    df = spark.createDataFrame([('a"b', None, " x ", "l1\nl2", Decimal("1.5000"), dt.date(2026, 4, 1))],
                               "a string, b string, c string, d string, e decimal(19,4), f date")
    path = f"{scratch}/x"
    write_csv(df, path, names=["a", "oper unit", "c", "d", "e", "f"], single_file=True)
    assert _csv_bytes(path) == b'"a","oper unit","c","d","e","f"\n"a""b",""," x ","l1\nl2","1.5000","2026-04-01"\n'


def test_csv_crlf_on_request(spark, scratch):
    df = spark.createDataFrame([("x",)], "a string")
    write_csv(df, f"{scratch}/y", single_file=True, crlf=True)
    assert _csv_bytes(f"{scratch}/y") == b'"a"\r\n"x"\r\n'


def test_csv_positional_rename_checks_arity(spark, scratch):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    with pytest.raises(ValueError):
        write_csv(df, f"{scratch}/z", names=["only_one"])


def test_publish_writes_once_and_copies(spark, scratch):
    names = X.CSV_NAMES["journal_watermarked"]
    df = QUERIES["journal_watermarked"](spark, SF_SMALL)
    targets = [CsvTarget(f"{scratch}/t{i}", tuple(names)) for i in range(4)]
    publish(spark, df, targets)
    first = read_csv(spark, targets[0].path, names)
    assert first.count() == 38 and first.columns == names
    for t in targets[1:]:
        # byte-identical content (part files may be split differently)
        a = sorted(_csv_bytes(targets[0].path).splitlines())
        b = sorted(_csv_bytes(t.path).splitlines())
        assert a == b


def test_parquet_replace_one_period(spark, scratch):
    path = f"{scratch}/lnd"
    rows = [{"drill_date": P}, {"drill_date": dt.date(2026, 3, 1), "account": "50000"}]
    f = fact(spark, rows)
    target = ParquetTarget(path, ("drill_date",), replace_partitions=True)
    target.write(f)
    target.write(fact(spark, [{"drill_date": P, "amount": Decimal("7.0000")}]))
    got = {(r.drill_date, r.amount) for r in spark.read.parquet(path).collect()}
    assert got == {(P, Decimal("7.0000")), (dt.date(2026, 3, 1), Decimal("1.0000"))}
    ParquetTarget(path, ("drill_date",)).write(fact(spark, [{"drill_date": P}]))
    assert spark.read.parquet(path).filter(F.col("drill_date") == P).count() == 2


def _derby(name):
    return JdbcTarget(
        url=f"jdbc:derby:memory:{name};create=true",
        table="LANDING",
        properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"},
        batchsize=10,
        num_partitions=2,
    )


def test_jdbc_append(spark):
    t = _derby("db" + uuid.uuid4().hex[:8])
    lnd = X.landing(fact(spark, [{}, {"account": "50000"}]), leaves(spark), LANDING_RULES, P, RUN_TS)
    t.write(lnd)
    t.write(lnd)
    back = t.read(spark)
    assert back.count() == 4
    assert {r.AMT if "AMT" in back.columns else r.amt for r in back.collect()} == {Decimal("1.0000")}


def test_runner_observes_audits_and_reconciles(spark, scratch):
    audit = AuditLog(ParquetTarget(f"{scratch}/audit"), app_name="test")
    spec = ExtractSpec(
        "journal_watermarked",
        lambda s: QUERIES["journal_watermarked"](s, SF_SMALL),
        (CsvTarget(f"{scratch}/wm", tuple(X.CSV_NAMES["journal_watermarked"])), CsvTarget(f"{scratch}/wm2", tuple(X.CSV_NAMES["journal_watermarked"]))),
        high_water_column="posted",
    )
    landing = ExtractSpec(
        "landing",
        lambda s: QUERIES["landing"](s, SF_SMALL),
        (ParquetTarget(f"{scratch}/landing"),),
        control=lambda s: QUERIES["control_count"](s, SF_SMALL),
    )
    results = run_all(spark, [spec, landing], audit)
    assert results[0].rows == 38 and results[0].high_water <= dt.date(1998, 5, 31)
    assert results[1].rows == 32 and results[1].control_rows == 32
    log = spark.read.parquet(f"{scratch}/audit").collect()
    assert sorted(r.message for r in log if r.message.startswith("Rowcount")) == ["Rowcount: 32", "Rowcount: 38"]
    assert all(r.log_level == "Outline" and r.app_name == "test" for r in log)


def test_runner_error_row_and_reraise(spark, scratch):
    audit = AuditLog(ParquetTarget(f"{scratch}/audit"))

    def broken(s):
        return s.range(3).select(F.col("nope"))

    with pytest.raises(Exception):
        run_spec(spark, ExtractSpec("broken", broken, (ParquetTarget(f"{scratch}/out"),)), audit)
    log = spark.read.parquet(f"{scratch}/audit").collect()
    assert len(log) == 1 and log[0].log_level == "Error" and log[0].message.startswith("broken:")


def test_runner_reconciliation_mismatch_fails(spark, scratch):
    audit = AuditLog(ParquetTarget(f"{scratch}/audit"))
    spec = ExtractSpec(
        "landing",
        lambda s: QUERIES["landing"](s, SF_SMALL).limit(5),
        (ParquetTarget(f"{scratch}/landing"),),
        control=lambda s: QUERIES["control_count"](s, SF_SMALL),
    )
    with pytest.raises(ValueError, match="control count is 32"):
        run_spec(spark, spec, audit)
    assert spark.read.parquet(f"{scratch}/audit").first().log_level == "Error"


def test_spec_from_sql_binds_parameters(spark, scratch):
    fact(spark, [{}, {"drill_date": dt.date(2026, 3, 1)}]).createOrReplaceTempView("ledger_fact_t")
    spec = ExtractSpec.from_sql(
        "passthrough",
        "SELECT * FROM ledger_fact_t WHERE drill_date = :period",
        {"period": P},
        targets=(ParquetTarget(f"{scratch}/pt"),),
    )
    assert run_spec(spark, spec).rows == 1


def test_publish_from_append_table_uses_a_checkpoint(spark, scratch):
    # the first target is an append-mode table that already holds an earlier
    # run; the other targets must receive this run's rows only
    first = ParquetTarget(f"{scratch}/hist")
    first.write(spark.range(5).withColumnRenamed("id", "x"))
    second = ParquetTarget(f"{scratch}/copy", mode="overwrite")
    publish(spark, spark.range(3).withColumnRenamed("id", "x"), [first, second])
    assert spark.read.parquet(first.path).count() == 8
    assert sorted(r.x for r in spark.read.parquet(second.path).collect()) == [0, 1, 2]


@pytest.mark.parametrize("name", ["landing", "csv_text_view", "journal_summary", "journal_detail", "journal_watermarked", "period_passthrough"])
def test_every_extract_round_trips_through_the_csv_contract(spark, scratch, name):
    from closeledger.functions.labels import as_text_view

    df = QUERIES[name](spark, SF_SMALL)
    key = "landing" if name == "csv_text_view" else name
    names = X.CSV_NAMES.get(key, df.columns)
    target = CsvTarget(f"{scratch}/{name}", tuple(names))
    target.write(df)
    back = target.read(spark).fillna("")
    want = as_text_view(df)
    assert back.columns == list(names)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in want.collect())


def test_read_table_by_catalog_name(spark):
    from closeledger.sources.schema import read_table

    spark.range(3).createOrReplaceTempView("cl_numbers")
    assert read_table(spark, "cl_numbers").count() == 3


def test_duplicate_flags_are_rejected(spark):
    from closeledger.operators.rules import tag_segments, tag_segments_union
    from closeledger.sources import testdata as td

    t = td.ledger_tables(spark, SF_SMALL)
    for tag in (tag_segments, tag_segments_union):
        with pytest.raises(ValueError, match="one flag"):
            tag(t.fact, t.leaves, [LANDING_RULES[0], LANDING_RULES[0]])


def test_failed_reconciliation_touches_no_target(spark, scratch):
    target = ParquetTarget(f"{scratch}/t")
    one = lambda s: s.range(1).selectExpr("id AS row_cnt")
    spec = ExtractSpec(name="x", build=lambda s: s.range(3).toDF("n"), targets=[target], control=one)
    with pytest.raises(ValueError, match="control count"):
        run_spec(spark, spec)
    assert not glob.glob(f"{scratch}/t*")


def test_readers_enforce_their_schema(spark, scratch):
    from closeledger.sources.schema import read_leaves, read_posted_dates

    spark.sql("SELECT 'T' treecd, 'N' node, 'L' leaf").write.parquet(f"{scratch}/leaves")
    assert read_leaves(spark, f"{scratch}/leaves").count() == 1
    with pytest.raises(TypeError, match="posted_date"):
        read_posted_dates(spark, f"{scratch}/leaves")
