"""Billing, trial, load and log relations derived from the driver's tables.

The SELECT texts are shared by Spark SQL and DuckDB, so both sides of the
correctness check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumenlake import contract

TABLES = ["orders", "customer", "nation", "region", "lineitem", "events"]

_DATE = "cast(o.o_orderdate as date)"
_MONTH = f"cast(year({_DATE})*100+month({_DATE}) as string)"


def _pad(number: str, width: int) -> str:
    """Zero-padded number that keeps every digit when it outgrows the width."""
    text = f"cast({number} as string)"
    return f"lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


def _slashed(day: str) -> str:
    day = f"cast({day} as date)"
    two = "lpad(cast({}({}) as string),2,'0')"
    return f"{two.format('day', day)}||'/'||{two.format('month', day)}||'/'||cast(year({day}) as string)"


def _comma(number: str, scale: int) -> str:
    return f"replace(cast(cast({number} as decimal(18,{scale})) as string),'.',',')"


BILL_TEXT = {
    "line_no": "cast(o.o_orderkey+1 as string)",
    "billing_month": _MONTH,
    "reference_month": _MONTH,
    "customer_name": "c.c_name",
    "person_tax_id": f"case when o.o_custkey%3<>0 then {_pad('o.o_custkey', 11)} else '' end",
    "company_tax_id": f"case when o.o_custkey%3=0 then {_pad('o.o_custkey', 14)} else '' end",
    "municipality": "case when o.o_orderkey%53=0 then '' else n.n_name end",
    "locality": "r.r_name",
    "street": "'STREET '||lpad(cast(o.o_custkey%200 as string),3,'0')",
    "house_number": "case when o.o_custkey%19=0 then 'S/N' else cast(o.o_custkey as string) end",
    "complement": "case when o.o_custkey%4<>0 then '' else 'UNIT '||cast(o.o_custkey%8 as string) end",
    "postal_code": f"{_pad('n.n_nationkey*100+o.o_custkey%3', 5)}||'-'||lpad(cast(o.o_custkey%1000 as string),3,'0')",
    "district": "'DISTRICT '||cast(o.o_custkey%10 as string)",
    "reading_calendar": "'BR'",
    "longitude": f"'-'||{_comma('30+(o.o_custkey%1000)/1000.0', 12)}",
    "latitude": f"case when o.o_custkey%23=0 then '' else '-'||{_comma('5+(o.o_custkey%777)/1000.0', 12)} end",
    "consumption_class": (
        "case c.c_mktsegment when 'AUTOMOBILE' then 'Industrial' when 'BUILDING' then 'Comercial, Servicos e Outras A'"
        " when 'FURNITURE' then 'Rural' when 'HOUSEHOLD' then 'Residencial' else 'Poder Publico' end"
    ),
    "consumption_subclass": (
        "case when o.o_custkey%17=0 then 'UNKNOWN' else case c.c_mktsegment when 'AUTOMOBILE' then 'Industrial'"
        " when 'BUILDING' then 'Comercial' when 'FURNITURE' then 'Agroindustrial'"
        " when 'HOUSEHOLD' then 'Residencial Pleno' else 'Poder Publico Federal' end end"
    ),
    "tariff_category": "'T'||cast(o.o_custkey%5 as string)",
    "connected_on": "'01/0'||cast(1+o.o_custkey%9 as string)||'/1990'",
    "commercial_status": "case when o.o_custkey%13=0 then 'XX' else 'LG' end",
    "contract_account": (
        f"case when o.o_custkey%5=0 then '0030'||{_pad('o.o_custkey', 8)} else '00'||{_pad('o.o_custkey', 10)} end"
    ),
    "installation": _pad("o.o_custkey", 10),
    "reading_stage": "cast(o.o_custkey%6 as string)",
    "supply_group": "case when o.o_custkey%2=0 then 'A' else 'B' end",
    "free_customer": "case when o.o_custkey%7=0 then 'S' else 'N' end",
    "phase": "cast(1+o.o_custkey%3 as string)",
    "perimeter": "'U'",
    "micro_generator": "case when o.o_custkey%11=0 then 'S' else 'N' end",
    "irrigator": "'N'",
    "block_reason": "''",
    "contract_active": "case o.o_custkey%3 when 0 then 'S' when 1 then 'SIM' else 'N' end",
    "payment_channel": "substring(o.o_orderpriority,1,1)",
    "print_document": f"'3'||{_pad('o.o_orderkey', 11)}",
    "bill_number": f"'0'||{_MONTH}||{_pad('o.o_orderkey', 9)}",
    "cnr": "''",
    "flag_revenue": _comma("(o.o_orderkey%500)/100.0", 2),
    "billed_kwh": _comma("coalesce(li.kwh,0)+30", 6),
    "measured_kwh": f"case when li.kwh is null then '' else {_comma('li.kwh', 6)} end",
    "due_on": (
        "case when o.o_orderkey%97=0 then '31/02/2024'"
        f" when o.o_orderkey%2=1 then cast(year({_DATE})*10000+month({_DATE})*100+day({_DATE}) as string)"
        f" else {_slashed('o.o_orderdate')} end"
    ),
    "paid_on": (
        "case when o.o_orderstatus='O' then '' else " + _slashed("o.o_orderdate + interval '10' day") + " end"
    ),
    "cycle_start": (
        "case when o.o_orderkey%37=0 then '' else " + _slashed("o.o_orderdate - interval '30' day") + " end"
    ),
    "cycle_end": _slashed("o.o_orderdate"),
    "cycle_days": "case when o.o_orderkey%37=0 then '' else '30' end",
    "cancelled": "case when o.o_orderkey%29=0 then 'S' else 'N' end",
    "rebilled": "case when o.o_orderkey%31=0 then 'SIM' else 'N' end",
    "rebilled_on": (
        "case when o.o_orderkey%31=0 then " + _slashed("o.o_orderdate + interval '10' day") + " else '' end"
    ),
    "tariff": _comma("0.5+(o.o_custkey%100)/10000.0", 8),
    "price": _comma("0.6+(o.o_custkey%100)/10000.0", 8),
    "tax_pis": _comma("(o.o_orderkey%300)/100.0", 2),
    "tax_cofins": _comma("(o.o_orderkey%700)/100.0", 2),
    "tax_icms": _comma("(o.o_orderkey%1900)/100.0", 2),
    "consumption_revenue": _comma("o.o_totalprice", 2),
    "bill_amount": (
        "case when o.o_orderkey%41=0 then '' when o.o_orderkey%43=0 then '0,00'"
        f" else {_comma('o.o_totalprice', 2)} end"
    ),
    "paid_amount": (
        f"case o.o_orderstatus when 'O' then '' when 'F' then {_comma('o.o_totalprice', 2)}"
        f" else {_comma('(o.o_orderkey%90000)/1.0', 2)} end"
    ),
    "bill_status": "o.o_orderstatus",
    "substitute_amount": f"case when o.o_orderkey%31=0 then {_comma('(o.o_orderkey%1000)/10.0', 2)} else '' end",
    "levy": f"case when o.o_orderkey%59=0 then '' else {_comma('(500+o.o_orderkey%4500)/100.0', 2)} end",
    "substitute_levy": "case when o.o_orderkey%31=0 then '1.234,50' else '' end",
}


# Some orders are billed twice.  The second copy comes later in the file and
# differs where the first row of a key must win or where rows must multiply.
COPY_SHIFT = 1_000_000_000_000
COPY_TEXT = {
    "line_no": f"cast(o.o_orderkey+1+{COPY_SHIFT} as string)",
    "person_tax_id": f"case when o.o_custkey%3<>0 and o.o_orderkey%5<>0 then {_pad('o.o_custkey', 11)} else '' end",
    "district": "'DISTRICT Z'",
    "paid_on": (
        "case when o.o_orderstatus='O' then '' when o.o_orderkey%2=0 then "
        + _slashed("o.o_orderdate + interval '20' day") + " else " + _slashed("o.o_orderdate + interval '10' day") + " end"
    ),
    "paid_amount": "case when o.o_orderstatus='O' then '' else '1,00' end",
    "levy": "case when o.o_orderkey%3=0 then '7,77' else " + BILL_TEXT["levy"] + " end",
}

# Values that the raw table cannot hold.
BROKEN_TEXT = {
    "block_reason": "case when o.o_orderkey%101=0 then repeat('x',300) else '' end",
    "bill_amount": f"case when o.o_orderkey%103=0 then '12.345.678.901.234.567,00' else {_comma('o.o_totalprice', 2)} end",
    "latitude": "case when o.o_orderkey%107=0 then '-1234567,5' else '' end",
    "cycle_days": "case when o.o_orderkey%109=0 then 'thirty' else '30' end",
    "line_no": "case when o.o_orderkey%113=0 then cast(o.o_orderkey as string)||'x' else cast(o.o_orderkey+1 as string) end",
}

# Texts that a floating-point reader would take for numbers.
SPECIAL_TEXT = {
    "bill_amount": "case o.o_orderkey%7 when 0 then 'NaN' when 1 then ' Infinity' when 2 then '-inf' when 3 then '+Infinity '"
    f" when 4 then '1e400' else {_comma('o.o_totalprice', 2)} end",
}

# Line breaks, separators and quotes inside the first, a middle and the last field.
QUOTED_TEXT = {
    contract.NAMES[0]: f"{BILL_TEXT[contract.NAMES[0]]}||case when o.o_orderkey%5=0 then chr(10)||'next' else '' end",
    "customer_name": "c.c_name||case when o.o_orderkey%7=0 then ' \"of\"; '||chr(10)||chr(10)||'two' else '' end",
    contract.NAMES[-1]: f"{BILL_TEXT.get(contract.NAMES[-1], chr(39) * 2)}||case when o.o_orderkey%11=0 then chr(10)||'end' else '' end",
}

# Header lines by billing month: as declared, one column renamed, the last one left out, one more.
_HEADER = ";".join(contract.HEADERS)
MONTH_HEADER = (
    "case cast(billing_month as int) % 4 when 0 then '{0}' when 1 then replace('{0}', 'VALOR_FATURA', 'VALOR_FAT')"
    " when 2 then substr('{0}', 1, {1}) else '{0};NOVA' end"
).format(_HEADER, len(_HEADER) - len(contract.HEADERS[-1]) - 1)

# Payments whose amount and rebills whose date got lost.
UNFINISHED_TEXT = {
    "paid_amount": f"case when o.o_orderkey%37=0 then '' else {BILL_TEXT['paid_amount']} end",
    "rebilled_on": f"case when o.o_orderkey%93=0 then '' else {BILL_TEXT['rebilled_on']} end",
}


def bills_raw_sql(
    table: str = "{}", names: list[str] | None = None, spark_sql: bool = False, changed: dict[str, str] | None = None
) -> str:
    """SELECT text of the text columns: one row per order, two for every 67th.

    The unfolding of the second copy is written differently in Spark SQL, and
    orders meet their line items before their customers, as they are narrower
    then.  The left join drops and repeats no order, so the rows are the same.
    """
    first = {**BILL_TEXT, **(changed or {})}
    second = {**COPY_TEXT, **(changed or {})}

    def text(name: str) -> str:
        if second.get(name, first[name]) == first[name]:
            return f"{first[name]} as {name}"
        return f"case when k.copy=1 then {second[name]} else {first[name]} end as {name}"

    picked = ",\n  ".join(text(n) for n in names or contract.NAMES)
    orders, customer, nation, region, lineitem = (table.format(t) for t in TABLES[:5])
    if spark_sql:
        copies = "lateral view explode(case when o.o_orderkey%67=0 then array(0,1) else array(0) end) k as copy"
    else:
        copies = "join (values (0),(1)) k(copy) on k.copy=0 or o.o_orderkey%67=0"
    owners = (
        f" join {customer} c on c.c_custkey = o.o_custkey"
        f" join {nation} n on n.n_nationkey = c.c_nationkey join {region} r on r.r_regionkey = n.n_regionkey"
    )
    items = (
        f" left join (select l_orderkey, sum(l_quantity) as kwh from {lineitem} group by l_orderkey) li"
        " on li.l_orderkey = o.o_orderkey"
    )
    joins = items + owners if spark_sql else owners + items
    return f"select {picked}\nfrom {orders} o{joins} {copies}"


def trials_sql(table: str = "{}") -> str:
    return f"""
select event_id+1 as trial_id, grp, fault, user_id as iteration, ts as injected_at,
  case when fault='NONE' or (grp='TREATMENT' and fault<>'SCHEMA' and event_id%11<>0)
       then 'success' else 'failed' end as outcome,
  case when grp='CONTROL' and fault='CONNECTION' then null else event_id+1 end as load_id
from (select *, case when event_id%2=0 then 'CONTROL' else 'TREATMENT' end as grp,
  case event_type when 'click' then 'CONNECTION' when 'view' then 'SCHEMA' when 'purchase' then 'NULL_DATA'
    when 'signup' then 'FILE_MISSING' else 'NONE' end as fault from {table.format('events')}) e"""


def loads_sql(table: str = "{}") -> str:
    return f"""
select load_id, case when fault='FILE_MISSING' then 'Sample_Backup.csv' else 'Sample_Base.csv' end as file_name,
  injected_at + interval '1' second as started_at,
  injected_at + interval '1' second + (trial_id%500) * interval '1' millisecond as ended_at,
  case when outcome='success' then (case when fault='NULL_DATA' then 252 else 267 end) end as n_rows,
  case when outcome='success' and fault='NULL_DATA' then 15 else 0 end as n_quarantined,
  case when outcome='success' then 'SUCCESS' else 'ERROR' end as status,
  case when grp='CONTROL' and fault='SCHEMA' then 'NULL_DATA' else fault end as fault_type,
  case when fault='NONE' then 'NONE' when fault='FILE_MISSING' then 'FILE_FALLBACK' when grp='CONTROL' then 'NONE'
       when fault='CONNECTION' then 'RETRY_BACKOFF' when fault='SCHEMA' then 'SCHEMA_CHECK'
       else 'QUARANTINE' end as mechanism,
  case when fault='CONNECTION' then 3 else 1 end as attempts,
  case when fault='CONNECTION' then 11000+trial_id%100 else 5+trial_id%4 end as recovery_ms,
  (fault<>'NONE' and outcome='success') as auto_resolved
from ({trials_sql(table)}) t where load_id is not null"""


# Landmark lines written per load: sequence, origin, offset in ms, how far it may move with the trial, message.
LOG_STEPS = [
    (-1, "database", -9900, 300, "received fast shutdown request"),
    (0, "database", -9500, 1000, "received fast shutdown request"),
    (1, "db_utils", -8000, 1100, "Attempt 1/3"),
    (2, "db_utils", -3500, 900, "Attempt 2/3"),
    (3, "database", -1500, 1300, "database system is ready to accept connections"),
    (4, "db_utils", -20, 9, "Attempt 3/3"),
    (5, "db_utils", -10, 8, ""),
    (6, "__main__", 0, 1, ""),
    (7, "schema_check", 5, 5, "Schema valid"),
    (8, "__main__", 10, 13, "Reading file: x.csv"),
    (9, "__main__", 33, 11, "Clearing raw"),
    (10, "__main__", 45, 50, "Raw cleared"),
    (11, "__main__", 250, 37, "Writing history"),
    (12, "__main__", 290, 17, "History copied"),
    (13, "__main__", 312, 7, ""),
    (14, "db_utils", 330, 1, ""),
]


def log_steps_sql(table: str = "{}", spark_sql: bool = False) -> str:
    """Log messages with the millisecond at which each was written.

    Every interval varies with the trial.  Some outages have two shutdowns,
    some no line that the database is ready, some end after the second try.
    """
    if spark_sql:
        structs = ", ".join(f"struct{step}" for step in LOG_STEPS)
        steps = f"lateral view inline(array({structs})) k as line_seq, origin, off, jitter, message"
    else:
        steps = f"cross join (values {', '.join(map(str, LOG_STEPS))}) k(line_seq,origin,off,jitter,message)"
    return f"""
select t.load_id, t.trial_id, k.line_seq, k.origin,
   t.trial_id*20000 + k.off + (t.trial_id*(2*k.line_seq+3))%k.jitter as ms,
   case k.line_seq when 5 then 'Connected after 3 attempt(s) in '||cast(11000+(t.trial_id*7)%101 as string)||' ms'
     when 6 then 'Load id created: '||cast(t.load_id as string)
     when 13 then 'Load finished. Rows inserted: '||(case when fault='NULL_DATA' then '252' else '267' end)
     when 14 then 'Connection failed after 1 attempt(s) in '||cast(2515+t.trial_id%114 as string)
                  ||' ms: could not translate host name'
     else k.message end as message
 from ({trials_sql(table)}) t {steps}
 where (t.load_id is not null and k.line_seq<14
   and (k.line_seq>=6 or (fault='CONNECTION' and grp='TREATMENT'))
   and (k.line_seq<>-1 or t.trial_id%5=0) and (k.line_seq<>3 or t.trial_id%7<>0)
   and (k.line_seq not in (4,5) or t.trial_id%13<>0)
   and (k.line_seq<>7 or grp='TREATMENT')
   and (k.line_seq<=6 or fault<>'SCHEMA')
   and (k.line_seq<11 or outcome='success'))
   or (k.line_seq=14 and fault='CONNECTION' and grp='CONTROL')"""


def _paths(sf_dir: str) -> str:
    return "parquet.`" + sf_dir.rstrip("/") + "/{}.parquet`"


_source_rows: dict[tuple[str, str], int] = {}


def source_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the larger of orders and events, from the footers of their files, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _source_rows:
        _source_rows[key] = max(spark.table(_paths(sf_dir).format(t)).count() for t in ("orders", "events"))
    return _source_rows[key]


def bills_raw(
    spark: SparkSession, sf_dir: str, names: list[str] | None = None, changed: dict[str, str] | None = None
) -> DataFrame:
    """The text columns.  Orders that come in fewer splits than there are cores are spread first:
    writing 59 texts per row costs far more than moving six narrow columns."""
    tables = {t: spark.table(_paths(sf_dir).format(t)) for t in TABLES[:5]}
    # Every text takes the day alone, and days are added to faster than times.
    tables["orders"] = tables["orders"].withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    cores = spark.sparkContext.defaultParallelism
    if tables["orders"].rdd.getNumPartitions() < cores:
        tables["orders"] = tables["orders"].repartition(cores)
    return spark.sql(bills_raw_sql("{{{}}}", names, True, changed), **tables)


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(trials_sql(_paths(sf_dir)))


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(loads_sql(_paths(sf_dir)))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is written to the log with its order columns, see ``log_line``."""
    return spark.sql(log_steps_sql(_paths(sf_dir), True)).select("ms", "line_seq", "origin", "message")


def log_line() -> Column:
    """The line itself, which is all that operators read; it is made where lines are in order, not moved."""
    stamp = "date_format(timestampadd(MILLISECOND, ms, timestamp_ntz'2026-09-01 00:00:00'), 'yyyy-MM-dd HH:mm:ss,SSS')"
    return F.expr(f"{stamp} || ' - ' || origin || ' - INFO - ' || message").alias("line")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run intervals: one per event, as long as its value in seconds."""
    return spark.sql(runs_sql(_paths(sf_dir)))


def runs_sql(table: str = "{}") -> str:
    return (
        "select event_id as run_id, event_type as scenario, ts as started_at,"
        " ts + cast(floor(value*1000) as int) * interval '1' millisecond as ended_at"
        f" from {table.format('events')}"
    )
