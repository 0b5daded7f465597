"""Whole jobs through the CLI, on ledger tables stored as Parquet (the fact
partitioned by period), as a user would run them."""

import glob
import json

import pytest
from ledger_paths import SF_SMALL

from closeledger import cli
from closeledger.plans.catalog import LANDING_RULES, SEGMENT_A, SEGMENT_B, stored_counts
from closeledger.plans.extracts import CSV_NAMES
from closeledger.sinks.files import read_csv
from closeledger.sources import testdata as td


def _rule(r):
    return {
        "flag": r.flag,
        "codes": dict(r.codes),
        "account_range": list(r.account_range) if r.account_range else None,
        "account_list": list(r.account_list),
        "hierarchies": [{"column": h.column, "letter": h.letter, "node": h.node, "tree": h.tree} for h in r.hierarchies],
    }


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("ledger"))
    td.ledger_fact(spark, SF_SMALL).write.partitionBy("drill_date").parquet(f"{root}/fact")
    td.leaves(spark, SF_SMALL).write.parquet(f"{root}/leaves")
    td.operators(spark, SF_SMALL).write.parquet(f"{root}/operators")
    stored_counts(spark, SF_SMALL).write.parquet(f"{root}/stored_counts")
    td.posted_dates(spark, SF_SMALL).write.parquet(f"{root}/posted_dates")
    return root


def _config(root, out, **extra):
    cfg = {
        "fact": f"{root}/fact",
        "leaves": f"{root}/leaves",
        "operators": f"{root}/operators",
        "stored_counts": f"{root}/stored_counts",
        "posted_dates": f"{root}/posted_dates",
        "segments": [_rule(SEGMENT_A), _rule(SEGMENT_B)],
        "line_segments": [_rule(SEGMENT_A), _rule(SEGMENT_B.with_code("ledger", "GAAP"))],
        "journal_scope": {"node": td.OPER_NODE, "ledger": "GAAP", "project_prefix": "1"},
        "folders": [f"{out}/share{i}" for i in range(4)],
        "audit": f"{out}/audit",
        **extra,
    }
    path = f"{out}/job.json"
    with open(path, "w") as fh:
        json.dump(cfg, fh)
    return path


def _run(capsys, *args):
    assert cli.main(list(args)) == 0
    return [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]


def test_landing_files_job(spark, stored, scratch, capsys):
    cfg = _config(stored, scratch)
    res = {r["extract"]: r for r in _run(capsys, "landing-files", "--config", cfg, "--run-date", "1998-05-05")}
    assert res["landing"]["rows"] == 32 and res["landing"]["control_rows"] == 32
    assert res["control_count"]["rows"] == 1 and res["period_passthrough"]["rows"] == 308
    for i in range(4):
        [lnd] = glob.glob(f"{scratch}/share{i}/landing_*.csv")
        assert read_csv(spark, lnd, CSV_NAMES["landing"]).count() == 32
        [cnt] = glob.glob(f"{scratch}/share{i}/control_count_*.csv")
        assert read_csv(spark, cnt, CSV_NAMES["control_count"]).first().row_cnt == "32"
    log = spark.read.parquet(f"{scratch}/audit").collect()
    assert sorted(r.message for r in log if r.message.startswith("Rowcount")) == ["Rowcount: 1", "Rowcount: 308", "Rowcount: 32"]


def test_landing_files_job_staged(spark, stored, scratch, capsys):
    cfg = _config(stored, scratch, stage_period=True)
    res = {r["extract"]: r for r in _run(capsys, "landing-files", "--config", cfg, "--run-date", "1998-05-05")}
    assert (res["landing"]["rows"], res["control_count"]["rows"], res["period_passthrough"]["rows"]) == (32, 1, 308)


def test_period_override(spark, stored, scratch, capsys):
    cfg = _config(stored, scratch)
    res = _run(capsys, "journal-files", "--config", cfg, "--run-date", "2026-12-03", "--period", "1998-04-01")
    assert [r["rows"] for r in res] == [49, 28, 49]
    with pytest.raises(SystemExit):
        cli.main(["journal-files", "--config", cfg, "--period", "1998-04-02"])


def test_journal_jobs(spark, stored, scratch, capsys):
    cfg = _config(stored, scratch)
    res = {r["extract"]: r for r in _run(capsys, "journal-files", "--config", cfg, "--run-date", "1998-05-05")}
    assert (res["journal_summary"]["rows"], res["stored_count"]["rows"], res["journal_detail"]["rows"]) == (49, 28, 49)
    res = _run(capsys, "journal-incremental", "--config", cfg, "--run-date", "1998-05-05")
    assert res[0]["rows"] == 38 and res[0]["high_water"] <= "1998-05-31"
    log = [r.message for r in spark.read.parquet(f"{scratch}/audit").collect()]
    assert f"HighWater: {res[0]['high_water']}" in log
    [f] = glob.glob(f"{scratch}/share3/journal_watermarked_*.csv")
    assert read_csv(spark, f, CSV_NAMES["journal_watermarked"]).columns[1] == "oper unit"


def test_landing_load_job_parquet_and_jdbc(spark, stored, scratch, capsys):
    import uuid

    jdbc = {"jdbc": f"jdbc:derby:memory:job{uuid.uuid4().hex[:8]};create=true", "table": "LANDING_CNT",
            "properties": {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}}
    cfg = _config(stored, scratch, landing_table=f"{scratch}/landing", count_table=jdbc)
    res = {r["extract"]: r for r in _run(capsys, "landing-load", "--config", cfg, "--run-date", "1998-05-05")}
    assert res["landing"]["rows"] == 32 and res["control_count"]["rows"] == 1
    assert spark.read.parquet(f"{scratch}/landing").count() == 32
    back = spark.read.format("jdbc").option("url", jdbc["jdbc"]).option("dbtable", "LANDING_CNT").options(**jdbc["properties"]).load()
    assert [r[1] for r in back.collect()] == [32]
    cfg = _config(stored, scratch, landing_table=f"{scratch}/landing_line", count_table=f"{scratch}/cnt2",
                  line_grain=True, with_posted_date=True)
    res = _run(capsys, "landing-load", "--config", cfg, "--run-date", "1998-05-05")
    assert res[0]["rows"] == 65


def test_staged_period_slice(spark, stored):
    from closeledger.plans import jobs
    from closeledger.plans.catalog import PERIOD, RUN_TS
    from closeledger.plans.extracts import landing
    from closeledger.session import checkpoint_dir

    assert checkpoint_dir(spark)
    ledger = jobs.Ledger(spark.read.parquet(f"{stored}/fact"), spark.read.parquet(f"{stored}/leaves"))
    st = jobs.staged(ledger, PERIOD)
    assert st.fact.count() == 308
    assert landing(st.fact, st.leaves, LANDING_RULES, PERIOD, RUN_TS).count() == 32


def test_example_config_rules_match_catalog():
    import os

    from closeledger.plans.catalog import LINE_RULES

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples", "period_close.json")
    with open(path) as fh:
        cfg = json.load(fh)

    def norm(rules):
        return [(r.flag, dict(r.codes), r.account_range, set(r.account_list), r.hierarchies) for r in rules]

    assert norm(cli.rule_from_dict(r) for r in cfg["segments"]) == norm(LANDING_RULES)
    assert norm(cli.rule_from_dict(r) for r in cfg["line_segments"]) == norm(LINE_RULES)
