"""Byte copies with a manifest, one CSV file from many parts, durable marks,
content checks, audit origin."""

import datetime as dt
import glob
import os
import platform

import pytest
from ledger_paths import SF_SMALL
from ledger_rows import RUN_TS, P, fact, leaves, operators
from pyspark.sql import functions as F

from closeledger.operators.fingerprint import ContentCheck, check_contents, content_differences, segment_differences
from closeledger.plans import extracts as X
from closeledger.plans import jobs
from closeledger.plans.catalog import JOURNAL_SCOPE, LANDING_RULES, PERIOD, QUERIES
from closeledger.plans.runner import ExtractSpec, run_all, run_spec
from closeledger.sinks import copies
from closeledger.sinks.audit import AuditLog
from closeledger.sinks.copies import copy_folder, differences
from closeledger.sinks.files import CSV_WRITE_OPTIONS, CsvTarget, ParquetTarget, read_csv
from closeledger.sinks.marks import Mark, MarkConflict, MarkStore
from closeledger.sinks.publish import publish
from closeledger.sources import testdata as td


def _files(path):
    """Data files by name (the manifest is hidden, as from Spark's readers)."""
    return {os.path.relpath(p, path): open(p, "rb").read() for p in glob.glob(f"{path}/**/part-*", recursive=True) if "/_" not in p[len(path) :]}


def _odd(spark, n=40):
    """Text with quotes, empty fields, line feeds and blanks."""
    texts = F.array(F.lit('a"b'), F.lit(""), F.lit(None).cast("string"), F.lit("l1\nl2"), F.lit("l1\r\nl2"), F.lit(" x "), F.lit("é,▁"))
    return spark.range(n).select(F.col("id").cast("string").alias("n"), F.get(texts, (F.col("id") % 7).cast("int")).alias("t")).repartition(5)


@pytest.mark.parametrize("crlf", [False, True])
@pytest.mark.parametrize("single", [False, True])
def test_targets_are_byte_identical(spark, scratch, crlf, single):
    targets = [CsvTarget(f"{scratch}/share{i}/x.csv", ("n", "t"), single, crlf) for i in range(4)]
    publish(spark, _odd(spark), targets)
    first = _files(targets[0].path)
    assert len(first) == (1 if single else 5) and all(_files(t.path) == first for t in targets)
    assert all(os.path.exists(f"{t.path}/_SUCCESS") and differences(spark, t.path).isEmpty() for t in targets)
    assert all(read_csv(spark, t.path, ["n", "t"]).count() == 40 for t in targets)
    assert not glob.glob(f"{scratch}/**/_copying*", recursive=True)


def test_copies_replace_what_was_there_and_tell_damage(spark, scratch):
    targets = [CsvTarget(f"{scratch}/a", ("n", "t")), CsvTarget(f"{scratch}/b", ("n", "t"))]
    publish(spark, _odd(spark, 100).repartition(9), targets)
    publish(spark, _odd(spark, 3).coalesce(1), targets)
    assert len(_files(targets[1].path)) == 1 and read_csv(spark, targets[1].path, ["n", "t"]).count() == 3
    [part] = glob.glob(f"{scratch}/b/part-*")
    with open(part, "ab") as f:
        f.write(b"x")
    assert [r.file for r in differences(spark, targets[1].path).collect()] == [os.path.basename(part)]
    assert differences(spark, targets[0].path).isEmpty()


def test_partitioned_parquet_is_copied_whole(spark, scratch):
    targets = [ParquetTarget(f"{scratch}/{n}", ("drill_date",), mode="overwrite") for n in "ab"]
    publish(spark, td.ledger_fact(spark, SF_SMALL), targets)
    assert _files(targets[0].path) == _files(targets[1].path) and len(_files(targets[0].path)) > 20
    assert spark.read.parquet(targets[1].path).count() == spark.read.parquet(targets[0].path).count()


def test_mixed_formats_share_one_computation(spark, scratch):
    targets = [CsvTarget(f"{scratch}/a", ("n", "t")), CsvTarget(f"{scratch}/b", ("n", "t"), crlf=True), CsvTarget(f"{scratch}/c", ("n", "t"))]
    publish(spark, _odd(spark).withColumn("t", F.concat(F.uuid(), F.lit(""))), targets)
    rows = [sorted(map(tuple, read_csv(spark, t.path, ["n", "t"]).collect())) for t in targets]
    assert rows[0] == rows[1] == rows[2] and _files(targets[0].path) == _files(targets[2].path)


def test_failed_copy_leaves_the_targets(spark, scratch, monkeypatch):
    target = CsvTarget(f"{scratch}/b", ("n", "t"))
    target.write(_odd(spark, 5))
    before = _files(target.path)
    source = CsvTarget(f"{scratch}/a", ("n", "t"))
    source.write(_odd(spark))
    real = copies.checksums
    monkeypatch.setattr(copies, "checksums", lambda *a: real(*a).withColumn("sha256", F.lit("0")))
    with pytest.raises(OSError, match="differs from"):
        copy_folder(spark, source.path, [target.path])
    assert _files(target.path) == before
    with pytest.raises(ValueError, match="onto itself"):
        copy_folder(spark, source.path, [source.path])


def test_one_file_equals_the_one_task_form(spark, scratch):
    df = td.ledger_fact(spark, SF_SMALL).repartition(7)
    target = CsvTarget(f"{scratch}/one", tuple(df.columns), single_file=True)
    target.write(df)
    [(_, data)] = _files(target.path).items()
    df.coalesce(1).write.options(**CSV_WRITE_OPTIONS).csv(f"{scratch}/plain")
    assert data.startswith(b'"account","ledger"') and data.count(b'"account"') == 1
    names = list(df.columns)
    assert sorted(map(tuple, read_csv(spark, target.path, names).collect()), key=repr) == sorted(
        map(tuple, read_csv(spark, f"{scratch}/plain", names).collect()), key=repr
    )
    target.write(df.limit(0))
    assert list(_files(target.path).values()) == [b",".join(b'"%s"' % c.encode() for c in names) + b"\n"]


def test_marks_are_versions_and_conflict(spark, scratch):
    store = MarkStore(f"{scratch}/marks", "x")
    none = store.read(spark)
    assert none == Mark()
    one = store.commit(spark, none, dt.date(2026, 4, 1), "r1")
    assert store.read(spark) == one == Mark(1, dt.date(2026, 4, 1), "r1")
    with pytest.raises(MarkConflict):
        store.commit(spark, none, dt.date(2026, 4, 2))
    with pytest.raises(ValueError, match="lies before"):
        store.commit(spark, one, dt.date(2026, 3, 31))
    open(f"{scratch}/marks/x/_half", "w").write("{")
    two = store.commit(spark, one, dt.date(2026, 4, 9))
    assert store.read(spark) == two and store.at(spark, 1) == one
    assert not [f for f in os.listdir(f"{scratch}/marks/x") if f.startswith("_") and f != "_half"]


def _incremental(spark, scratch, day, fact_rows=None):
    ledger = jobs.Ledger(
        fact_rows if fact_rows is not None else td.ledger_fact(spark, SF_SMALL), td.leaves(spark, SF_SMALL), td.operators(spark, SF_SMALL)
    )
    run_ts = dt.datetime.combine(day, dt.time(9))
    folders = [f"{scratch}/share{i}" for i in range(2)]
    return jobs.journal_incremental(ledger, JOURNAL_SCOPE, PERIOD, run_ts, folders, marks=f"{scratch}/marks")


def _written(spark, scratch, share=0):
    rows = []
    for path in sorted(glob.glob(f"{scratch}/share{share}/journal_watermarked_*.csv")):
        rows += [tuple(r)[:15] + tuple(r)[16:] for r in read_csv(spark, path, X.CSV_NAMES["journal_watermarked"]).collect()]
    return sorted(rows, key=repr)


def _whole(spark, last):
    frame = X.journal_watermarked(td.ledger_fact(spark, SF_SMALL), td.leaves(spark, SF_SMALL), td.operators(spark, SF_SMALL), JOURNAL_SCOPE, PERIOD, bound=last)
    from closeledger.functions.labels import as_text_view

    return sorted((tuple(x or None for x in tuple(r)[:15] + tuple(r)[16:]) for r in as_text_view(frame).collect()), key=repr)


def test_chained_runs_lose_and_repeat_nothing(spark, scratch, monkeypatch):
    days = [dt.date(1998, 5, 5), dt.date(1998, 5, 6), dt.date(1998, 6, 3), dt.date(1998, 9, 1)]
    seen = []
    for day in days[:2]:
        seen.append(run_all(spark, _incremental(spark, scratch, day))[0].rows)
    # the third run breaks between publishing and the commit of its mark
    with monkeypatch.context() as m:
        m.setattr(MarkStore, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            run_all(spark, _incremental(spark, scratch, days[2]))
    store = MarkStore(f"{scratch}/marks", f"journal_watermarked-{PERIOD:%Y-%m}")
    assert store.read(spark).value < days[1]
    for day in days[2:]:
        seen.append(run_all(spark, _incremental(spark, scratch, day))[0].rows)
    want = _whole(spark, days[-1] - dt.timedelta(days=1))
    assert sum(seen) == len(want) and [s > 0 for s in seen] == [True, seen[1] > 0, True, True]
    assert _written(spark, scratch, 0) == _written(spark, scratch, 1) == want
    assert store.read(spark).value < days[-1]


def test_incremental_run_scans_the_fact_once(spark, scratch):
    td.ledger_fact(spark, SF_SMALL).write.partitionBy("drill_date").parquet(f"{scratch}/fact")
    [spec] = _incremental(spark, scratch, dt.date(1998, 6, 3), spark.read.parquet(f"{scratch}/fact"))
    plan = spec.build(spark, dt.date(1998, 5, 5))._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation" in line and "drill_date" in line]
    assert len(scans) == 1 and "subquery" not in plan.lower()


def test_a_spec_with_a_mark_needs_its_column(spark):
    with pytest.raises(ValueError, match="needs the column"):
        ExtractSpec("x", lambda s, since: s.range(1), mark=MarkStore("/nowhere", "x"))


KEYS = ("gl_acct", "lgr", "ucmg_id", "bu", "ou", "loc", "dept")


def _check(build=None):
    return ContentCheck(build, ("bus_flg",), KEYS, ignore=("insrt_on",))


def test_one_changed_amount_is_named_and_nothing_published(spark, scratch):
    rows = [{"account": f"4{i:04d}", "location": None if i % 2 else "L1"} for i in range(30)]
    good = lambda s: X.landing(fact(s, rows), leaves(s), LANDING_RULES, P, RUN_TS)
    bad = lambda s: good(s).withColumn("amt", F.when(F.col("gl_acct") == "A40007", F.col("amt") + 0.01).otherwise(F.col("amt")).cast("decimal(19,4)"))
    target = ParquetTarget(f"{scratch}/t", mode="overwrite")
    with pytest.raises(ValueError, match=r"in 1 groups.*gl_acct=A40007"):
        run_spec(spark, ExtractSpec("landing", bad, (target,), content=_check(good)))
    assert not os.path.exists(target.path)
    assert run_spec(spark, ExtractSpec("landing", good, (target,), content=_check(good))).rows == 30


def test_fingerprints_see_nulls_counts_and_repeats(spark):
    schema = "bus_flg string, gl_acct string, lgr string, ucmg_id string, bu string, ou string, loc string, dept string, amt decimal(19,4)"
    base = [("A", "1", "G", None, "b", "", "l", "d", None), ("B", "2", "G", "p", "b", "o", "l", "d", None)]
    make = lambda rows: spark.createDataFrame(rows, schema)
    swapped = [("A", "1", "G", "", "b", None, "l", "d", None), base[1]]
    assert segment_differences(make(base), make(list(reversed(base))), _check()).isEmpty()
    assert [r.bus_flg for r in segment_differences(make(base), make(swapped), _check()).collect()] == ["A"]
    twice = content_differences(make(base + base[1:]), make(base), _check()).collect()
    assert [(r.bus_flg, r.extract_rows, r.control_rows) for r in twice] == [("B", 2, 1)]
    assert [(r.extract_rows, r.control_rows) for r in content_differences(make([]), make(base[:1]), _check()).collect()] == [(0, 1)]
    with pytest.raises(ValueError, match="no column"):
        check_contents(make(base), make(base).drop("amt"), _check())


def test_landing_jobs_check_contents(spark, scratch):
    ledger = jobs.Ledger(fact(spark, [{}, {"account": "50000"}]), leaves(spark), operators(spark))
    specs = jobs.landing_files(ledger, LANDING_RULES, P, RUN_TS, [f"{scratch}/s"], check_content=True)
    assert [r.rows for r in run_all(spark, specs)] == [1, 2, 2]


def test_audit_rows_tell_their_origin(spark, scratch):
    audit = AuditLog(ParquetTarget(f"{scratch}/audit"), path="/jobs/close.json")

    def broken(s):
        raise KeyError("nothing here")

    good = ExtractSpec("ok", lambda s: s.range(2), (ParquetTarget(f"{scratch}/t"),))
    run_spec(spark, good, audit)
    with pytest.raises(KeyError):
        run_spec(spark, ExtractSpec("x", broken, (ParquetTarget(f"{scratch}/u"),)), audit)
    rows = {r.log_level: r for r in spark.read.parquet(f"{scratch}/audit").collect()}
    assert rows["Outline"].app_name == f"{platform.node()}:/jobs/close.json:run_spec" and rows["Outline"].line_num > 0
    assert rows["Error"].app_name == f"{platform.node()}:/jobs/close.json:broken"
    assert rows["Error"].line_num == broken.__code__.co_firstlineno + 1


def test_every_registered_landing_row_agrees_with_its_control(spark):
    assert segment_differences(QUERIES["landing"](spark, SF_SMALL), QUERIES["landing_two_scan"](spark, SF_SMALL), _check()).isEmpty()
