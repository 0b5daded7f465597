"""Oracle SQL: for each catalogue query, the same result written as plain
SQL over the driver's tables (runs in DuckDB; the test harness and the
driver compare it with the Spark result).

The SQL is written the way the shipped extracts are written (one SELECT per
segment joined by UNION ALL, ``IN (select leaf ...)`` subqueries, ``CASE``
for the name fallback), so it checks the Spark-first plans against an
independent formulation.  The ledger inputs come from the derivation in
FIXTURES.md.
"""

from __future__ import annotations

# The ledger inputs derived from lineitem / nation / region / customer
# (FIXTURES.md section 2), plus the table of already-extracted posting days.
LEDGER_CTE = """
with base as (
 select lpad(cast(case when l_partkey%10=0 then 15050+5*(l_suppkey%4) else 10000+(l_partkey*7919)%90000 end as string),5,'0') || case when l_orderkey%5=0 then ' ' else '' end account,
  case when l_returnflag='A' and l_linenumber%2=0 then 'STAT' else 'GAAP' end ledger,
  cast(date_trunc('quarter',l_shipdate) as date) drill_date,
  case when l_linenumber=7 then null else cast(l_partkey%3 as string)||lpad(cast(l_partkey%20 as string),4,'0') end project_id,
  case when l_suppkey%10=9 then '10010' else '20020' end business_unit,
  case when l_linenumber<=3 then '02858' when l_linenumber<=5 then '01000' else '03000' end operating_unit,
  case when l_suppkey%4=0 then null else ' L'||cast(l_suppkey%4 as string) end location,
  case when l_suppkey%2=0 then '220210' else '2203'||lpad(cast(l_suppkey%10 as string),2,'0') end deptid,
  'line "'||l_linestatus||'"' line_descr,
  l_returnflag||' ' descr,
  'x'||cast(l_linenumber%2 as string) descr254,
  'U'||cast(l_orderkey%50 as string) oprid,
  l_linestatus source,
  'JN'||cast(l_orderkey%97 as string) journal_id,
  case when l_orderkey%37=0 then null else cast(l_shipdate as date)+l_linenumber end posted_date,
  'N' reversal_cd,
  cast(case when l_orderkey%40=1 then 0 else cast(l_extendedprice as decimal(12,2))*(1-cast(l_discount as decimal(4,2))) end as decimal(19,4)) amount,
  l_orderkey k
 from lineitem),
fx as (
 select account,ledger,drill_date,project_id,business_unit,operating_unit,location,deptid,line_descr,descr,descr254,oprid,source,journal_id,posted_date,reversal_cd,amount from base
 union all select account,ledger,drill_date,project_id,business_unit,operating_unit,location,deptid,line_descr,descr,'x9',oprid,source,journal_id,posted_date,'Y',-amount from base where k%4=0
 union all select account,ledger,drill_date,project_id,business_unit,operating_unit,location,deptid,line_descr,descr,descr254,oprid,source,journal_id,posted_date+3,reversal_cd,amount from base where k%6=1
 union all select account,ledger,drill_date,project_id,business_unit,operating_unit,location,deptid,'line  '||source||' ',descr,descr254,oprid,source,journal_id,posted_date,reversal_cd,amount from base where k%7=1
 union all select account,ledger,drill_date,project_id,business_unit,operating_unit,location,deptid,line_descr,descr,descr254,'U31',source,journal_id,posted_date,reversal_cd,amount from base where k%50=30),
leaves as (
 select 'DEPT' treecd,'DEPT_ROOT' node,'D2203'||lpad(cast(n_nationkey as string),2,'0') leaf from nation where n_nationkey<6
 union all select 'DEPT','DEPT_ROOT_OTHER','D2203'||lpad(cast(n_nationkey as string),2,'0') from nation where n_nationkey>=6
 union all select 'DEPT_ALT','DEPT_ROOT','D2203'||lpad(cast(n_nationkey as string),2,'0') from nation where n_nationkey>=6
 union all select 'DEPT','DEPT_ROOT','D220210' union all select 'DEPT','DEPT_ROOT','D220210'
 union all select 'PROJ','CAPITAL_PROJ','J'||cast(r_regionkey as string)||lpad(cast(n_nationkey as string),4,'0') from region cross join nation where r_regionkey<2 and n_nationkey<20
 union all select 'PROJ','CAPITAL_PROJ_OTHER','J'||cast(r_regionkey as string)||lpad(cast(n_nationkey as string),4,'0') from region cross join nation where not (r_regionkey<2 and n_nationkey<20)
 union all select 'PROJ_ALT','CAPITAL_PROJ','J'||cast(r_regionkey as string)||lpad(cast(n_nationkey as string),4,'0') from region cross join nation where not (r_regionkey<2 and n_nationkey<20)
 union all select 'OPER','OPER_GROUP_OTHER','S03000'
 union all select 'OPER','OPER_GROUP','S01000' union all select 'OPER','OPER_GROUP','S02858' union all select 'OPER_ALT','OPER_GROUP','S01000'),
op as (select 'U'||cast(c_custkey as string) employeeid, case when c_custkey in (30,31) then 'Shared Operator' when c_custkey%7=0 then null else c_name end employeename from customer),
pd as (select distinct posted_date from fx where posted_date <= DATE '1998-05-31')
"""

PERIOD = "DATE '1998-04-01'"
RUN_TS = "TIMESTAMP '1998-05-05 14:30:15.25'"
RUN_TS_TEXT = f"strftime({RUN_TS}, '%Y-%m-%d %H:%M:%S.%g')"

SEG_A_WHERE = (
    "business_unit = '20020' AND operating_unit = '02858' AND deptid = '220210' "
    "AND ledger = 'GAAP' AND account BETWEEN '40000' AND '99999'"
)
SEG_B_WHERE = (
    "business_unit = '20020' AND operating_unit = '01000' "
    "AND (account BETWEEN '40000' AND '99999' OR account IN ('15050','15060','15055','15065')) "
    "AND 'D'||deptid IN (SELECT leaf FROM leaves WHERE treecd = 'DEPT' AND node = 'DEPT_ROOT') "
    "AND 'J'||project_id IN (SELECT leaf FROM leaves WHERE treecd = 'PROJ' AND node = 'CAPITAL_PROJ')"
)
LANDING_GROUP = "account, ledger, drill_date, project_id, business_unit, operating_unit, location, deptid"
LINE_GROUP = LANDING_GROUP + ", line_descr, descr, descr254, oprid, journal_id, source"
NONZERO = "HAVING cast(sum(amount) AS decimal(19,4)) != 0"

LANDING_HEAD = """'A'||trim(account) gl_acct, trim(ledger) lgr,
  'FY'||cast(year(drill_date) as varchar) fisc_yr,
  substr('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', month(drill_date)*3-2, 3) mo,
  'J'||project_id ucmg_id, cast(sum(amount) as decimal(19,4)) amt"""
LANDING_TAIL = "trim(business_unit) bu, trim(operating_unit) ou, trim(location) loc, trim(deptid) dept"


def _landing_branch(flag: str, where: str, stamp: str = RUN_TS) -> str:
    return f"""SELECT {LANDING_HEAD}, {stamp} insrt_on, {LANDING_TAIL}, '{flag}' bus_flg
FROM fx WHERE drill_date = {PERIOD} AND {where}
GROUP BY {LANDING_GROUP} {NONZERO}"""


def _line_branch(flag: str, where: str, posted: bool) -> str:
    group = LINE_GROUP + (", posted_date" if posted else "")
    extra = ", posted_date pst_dt" if posted else ""
    return f"""SELECT {LANDING_HEAD},
  trim(line_descr) line_desc, trim(descr) descr, trim(oprid) opr_id, trim(source) src, trim(journal_id) jnl_id,
  {RUN_TS} insrt_on, {LANDING_TAIL}, '{flag}' bus_flg{extra}
FROM fx WHERE drill_date = {PERIOD} AND {where}
GROUP BY {group} {NONZERO}"""


def _count_branch(where: str, period: bool = True) -> str:
    cond = f"drill_date = {PERIOD} AND {where}" if period else where
    return f"SELECT {LANDING_GROUP} FROM fx WHERE {cond} GROUP BY {LANDING_GROUP} {NONZERO}"


LANDING = _landing_branch("A", SEG_A_WHERE) + "\nUNION ALL\n" + _landing_branch("B", SEG_B_WHERE)
LANDING_TEXT_TS = _landing_branch("A", SEG_A_WHERE, RUN_TS_TEXT) + "\nUNION ALL\n" + _landing_branch("B", SEG_B_WHERE, RUN_TS_TEXT)
SEG_B_LINE_WHERE = "ledger = 'GAAP' AND " + SEG_B_WHERE
CONTROL = f"""SELECT cast({RUN_TS} as date) insrt_on, count(*) row_cnt FROM (
{_count_branch(SEG_A_WHERE)}
UNION ALL
{_count_branch(SEG_B_WHERE)}) sub"""

JOURNAL_FROM = f"""FROM fx a
JOIN leaves b ON 'S'||a.operating_unit = b.leaf AND b.node = 'OPER_GROUP'
LEFT JOIN op c ON a.oprid = c.employeeid
WHERE a.ledger = 'GAAP' AND a.drill_date = {PERIOD} AND a.project_id LIKE '1%'"""
USER = "CASE WHEN c.employeename IS NULL THEN a.oprid ELSE c.employeename END"
JOURNAL_SCOPE_WHERE = f"ledger = 'GAAP' AND drill_date = {PERIOD} AND project_id LIKE '1%'"


def _sql(body: str) -> str:
    return LEDGER_CTE + body


JOURNAL_SUMMARY = f"""
SELECT 'A'||account gl_acct, ledger lgr, 'FY'||cast(year(drill_date) as varchar) fisc_yr,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(drill_date)*3-2, 3) mo,
  'J'||project_id ucmg_id, cast(sum(amount) as decimal(38,4)) amt, {RUN_TS_TEXT} insrt_on,
  business_unit unit, operating_unit oper_unit, location, deptid dept, reversal_cd,
  {USER} "user", journal_id, posted_date
{JOURNAL_FROM}
GROUP BY account, ledger, drill_date, project_id, business_unit, operating_unit, location, deptid,
  reversal_cd, journal_id, posted_date, {USER}"""

JOURNAL_WATERMARKED = f"""
SELECT business_unit unit, operating_unit oper_unit, account, location, deptid dept, journal_id,
  {USER} "user", project_id project, replace(line_descr, '"', ' ') line_descr,
  cast(year(drill_date) as integer) "year", cast(month(drill_date) as integer) "period", source,
  cast(sum(amount) as decimal(38,4)) amount, posted_date posted, reversal_cd, {RUN_TS} runtime, descr
{JOURNAL_FROM}
  AND {{posted}}
GROUP BY business_unit, operating_unit, account, location, deptid, journal_id, project_id, line_descr,
  drill_date, source, posted_date, reversal_cd, descr, {USER}"""
JOURNAL_AFTER_MARK = JOURNAL_WATERMARKED.format(posted=f"""a.posted_date <= DATE '1998-06-30' AND a.posted_date > (
    SELECT max(a.posted_date) {JOURNAL_FROM} AND a.posted_date <= DATE '1998-05-31')""")

ORACLE: dict[str, str] = {
    "close_period_12": """
SELECT run_date, cast(CASE WHEN day(run_date) <= 12 THEN date_trunc('month', run_date - INTERVAL 1 MONTH)
  ELSE date_trunc('month', run_date) END AS date) drill_date
FROM (SELECT DISTINCT cast(o_orderdate AS date) run_date FROM orders) t""",
    "close_period_20": """
SELECT run_date, cast(CASE WHEN day(run_date) < 20 THEN date_trunc('month', run_date - INTERVAL 1 MONTH)
  ELSE date_trunc('month', run_date) END AS date) drill_date
FROM (SELECT DISTINCT cast(o_orderdate AS date) run_date FROM orders) t""",
    "month_labels": _sql("""
SELECT drill_date, 'FY'||cast(year(drill_date) as varchar) fisc_yr,
  upper(strftime(drill_date, '%b')) mo_upper, strftime(drill_date, '%b') mo_title,
  cast(year(drill_date) as integer) "year", cast(month(drill_date) as integer) "period"
FROM (SELECT DISTINCT cast(CASE WHEN day(o_orderdate) <= 12 THEN date_trunc('month', o_orderdate - INTERVAL 1 MONTH)
  ELSE date_trunc('month', o_orderdate) END AS date) drill_date FROM orders) t"""),
    "string_range": _sql("""
SELECT account, count(*) lines, account BETWEEN '40000' AND '99999' in_range,
  account IN ('15050','15060','15055','15065') in_list
FROM fx GROUP BY account"""),
    "segment_a": _sql(_landing_branch("A", SEG_A_WHERE)),
    "segment_b": _sql(_landing_branch("B", SEG_B_WHERE)),
    "landing": _sql(LANDING),
    "landing_two_scan": _sql(LANDING),
    "landing_shuffle": _sql(LANDING),
    "landing_line": _sql(_line_branch("A", SEG_A_WHERE, False) + "\nUNION ALL\n" + _line_branch("B", SEG_B_LINE_WHERE, False)),
    "landing_line_posted": _sql(_line_branch("A", SEG_A_WHERE, True) + "\nUNION ALL\n" + _line_branch("B", SEG_B_LINE_WHERE, True)),
    "control_count": _sql(CONTROL),
    "control_count_text": _sql(CONTROL.replace(f"cast({RUN_TS} as date)", RUN_TS_TEXT, 1)),
    "reconcile": _sql(f""", l AS ({LANDING}), c AS ({CONTROL})
SELECT (SELECT count(*) FROM l) extract_rows, (SELECT row_cnt FROM c) control_rows,
  (SELECT count(*) FROM l) = (SELECT row_cnt FROM c) matched"""),
    "period_passthrough": _sql(f"SELECT * FROM fx WHERE drill_date = {PERIOD}"),
    "hierarchy_semi": _sql(f"""
SELECT * FROM fx WHERE {JOURNAL_SCOPE_WHERE}
  AND 'S'||operating_unit IN (SELECT leaf FROM leaves WHERE node = 'OPER_GROUP')"""),
    "hierarchy_inner_fanout": _sql(f"""
SELECT a.* FROM fx a JOIN leaves b ON 'S'||a.operating_unit = b.leaf AND b.node = 'OPER_GROUP'
WHERE a.ledger = 'GAAP' AND a.drill_date = {PERIOD} AND a.project_id LIKE '1%'"""),
    "operator_fallback": _sql("""
SELECT i.oprid, CASE WHEN c.employeename IS NULL THEN i.oprid ELSE c.employeename END "user"
FROM (SELECT DISTINCT oprid FROM fx) i LEFT JOIN op c ON i.oprid = c.employeeid"""),
    "journal_summary": _sql(JOURNAL_SUMMARY),
    "journal_summary_shuffle": _sql(JOURNAL_SUMMARY),
    "journal_detail": _sql(f"""
SELECT 'A'||account gl_acct, ledger lgr, 'FY'||cast(year(drill_date) as varchar) fisc_yr,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(drill_date)*3-2, 3) mo,
  'J'||project_id ucmg_id, cast(sum(amount) as decimal(38,4)) amt,
  replace(line_descr, '"', ' ') line_desc, descr, {USER} "user", source src, journal_id jnl_id,
  {RUN_TS_TEXT} insrt_on, business_unit unit, operating_unit oper_unit, location, deptid dept,
  posted_date, reversal_cd
{JOURNAL_FROM}
GROUP BY account, ledger, drill_date, project_id, line_descr, descr, oprid, source, journal_id,
  business_unit, operating_unit, location, deptid, posted_date, reversal_cd, {USER}"""),
    "watermark_scalar": _sql("SELECT coalesce(max(posted_date), DATE '1900-01-01') bound FROM pd"),
    "journal_watermarked": _sql(JOURNAL_WATERMARKED.format(
        posted="a.posted_date <= (SELECT coalesce(max(posted_date), DATE '1900-01-01') FROM pd)")),
    "nonzero_balance": _sql(f"""
SELECT {LANDING_GROUP}, cast(sum(amount) as decimal(19,4)) amt FROM fx
GROUP BY {LANDING_GROUP} {NONZERO}"""),
    "csv_text_view": _sql(f"""
SELECT coalesce(gl_acct,'') gl_acct, coalesce(lgr,'') lgr, coalesce(fisc_yr,'') fisc_yr, coalesce(mo,'') mo,
  coalesce(ucmg_id,'') ucmg_id, coalesce(cast(amt as varchar),'') amt, coalesce(insrt_on,'') insrt_on,
  coalesce(bu,'') bu, coalesce(ou,'') ou, coalesce(loc,'') loc, coalesce(dept,'') dept, coalesce(bus_flg,'') bus_flg
FROM ({LANDING_TEXT_TS}) t"""),
    "duplicate_leaf_check": _sql(""", d AS (
SELECT node, leaf, count(*) listings, count(DISTINCT treecd) trees FROM leaves
GROUP BY node, leaf HAVING count(*) > 1),
codes AS (SELECT 'D'||deptid code FROM fx UNION ALL SELECT 'J'||project_id FROM fx UNION ALL SELECT 'S'||operating_unit FROM fx),
n AS (SELECT code, count(*) lines FROM codes WHERE code IS NOT NULL GROUP BY code)
SELECT d.node, d.leaf, d.listings, d.trees, coalesce(n.lines, 0) lines FROM d LEFT JOIN n ON d.leaf = n.code"""),
    "stored_count": _sql(f"""
SELECT cast(drill_date + INTERVAL 1 MONTH AS date) + 4 insert_on, count(*) row_cnt FROM (
{_count_branch(SEG_A_WHERE, period=False)}
UNION ALL
{_count_branch(SEG_B_WHERE, period=False)}) sub GROUP BY drill_date"""),
    "hierarchy_semi_ledger": _sql("""
SELECT drill_date, operating_unit, count(*) lines, cast(sum(amount) as decimal(38,4)) amt FROM fx
WHERE 'S'||operating_unit IN (SELECT leaf FROM leaves WHERE node = 'OPER_GROUP') GROUP BY drill_date, operating_unit"""),
    "hierarchy_fanout_ledger": _sql("""
SELECT a.drill_date, a.operating_unit, count(*) lines, cast(sum(a.amount) as decimal(38,4)) amt FROM fx a
JOIN leaves b ON 'S'||a.operating_unit = b.leaf AND b.node = 'OPER_GROUP' GROUP BY a.drill_date, a.operating_unit"""),
    "nonzero_rounded": _sql(f"""
SELECT {LANDING_GROUP}, cast(sum(amount * 0.00000001) as decimal(19,4)) amt FROM fx
GROUP BY {LANDING_GROUP} HAVING cast(sum(amount * 0.00000001) as decimal(19,4)) != 0"""),
    "landing_rule_index": _sql(f"""
SELECT 'A' bus_flg, {LANDING_GROUP}, cast(sum(amount) as decimal(19,4)) amt FROM fx
WHERE drill_date = {PERIOD} AND {SEG_A_WHERE} GROUP BY {LANDING_GROUP} {NONZERO}
UNION ALL
SELECT 'B', {LANDING_GROUP}, cast(sum(amount) as decimal(19,4)) FROM fx
WHERE drill_date = {PERIOD} AND {SEG_B_WHERE} GROUP BY {LANDING_GROUP} {NONZERO}"""),
    "landing_many_rules": _sql(f""", rules AS (
SELECT n_nationkey||'-'||i flag, '2203'||lpad(cast(n_nationkey as string),2,'0') dept_code, i,
  cast(10000+2000*i as string) low, cast(13000+2000*i as string) high FROM nation CROSS JOIN range(40) t(i))
SELECT {LANDING_HEAD}, {RUN_TS} insrt_on, {LANDING_TAIL}, flag bus_flg
FROM fx JOIN rules ON deptid = dept_code AND account BETWEEN low AND high
WHERE drill_date = {PERIOD} AND (i % 4 != 0 OR ledger = 'GAAP')
  AND (i % 5 != 0 OR 'J'||project_id IN (SELECT leaf FROM leaves WHERE treecd = 'PROJ' AND node = 'CAPITAL_PROJ'))
GROUP BY flag, {LANDING_GROUP} {NONZERO}"""),
    "landing_zone_map": _sql(LANDING),
    "journal_after_mark": _sql(JOURNAL_AFTER_MARK),
    "content_differences": _sql(f""", l AS ({LANDING}), m AS ({_landing_branch("A", SEG_A_WHERE)}
UNION ALL
{_landing_branch("B", SEG_B_LINE_WHERE)}),
s AS (SELECT 1 side, * FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM m)
  UNION ALL SELECT -1, * FROM (SELECT * FROM m EXCEPT ALL SELECT * FROM l)),
d AS (SELECT DISTINCT bus_flg, gl_acct, lgr, ucmg_id, ou, loc, dept FROM s),
c AS (SELECT 1 side, * FROM l UNION ALL SELECT -1, * FROM m)
SELECT d.*, count(*) FILTER (WHERE side = 1) extract_rows, count(*) FILTER (WHERE side = -1) control_rows
FROM d JOIN c ON c.bus_flg = d.bus_flg AND c.gl_acct = d.gl_acct AND c.lgr = d.lgr AND c.ucmg_id IS NOT DISTINCT FROM d.ucmg_id
  AND c.ou IS NOT DISTINCT FROM d.ou AND c.loc IS NOT DISTINCT FROM d.loc AND c.dept IS NOT DISTINCT FROM d.dept
GROUP BY ALL"""),
}
