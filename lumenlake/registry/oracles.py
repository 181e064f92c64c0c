"""DuckDB equivalents of the registered queries, over whole tables.

Written from the meaning of each operator, with plain SQL joins and windows:
no step of the Spark plans (elided joins, chunked windows, pre-aggregation)
is repeated here.
"""

from __future__ import annotations

from lumenlake import contract
from lumenlake.plans import masking, silver
from lumenlake.functions.permutation import ROUNDS
from lumenlake.registry.queries import BY_PARTIALS, INSERT_SPLIT_MONTH, MASK_KEY
from lumenlake.registry.relations import DATES, DECIMALS
from lumenlake.sources import derived

_DUCK_INT = "regexp_full_match(trim({0}), '[+-]?[0-9]+')"


def _date(c: str) -> str:
    return (
        f"case when contains({c}, '/') then cast(try_strptime(trim({c}), '%d/%m/%Y') as date)"
        f" when regexp_full_match(trim({c}), '[0-9]{{8}}') then cast(try_strptime(trim({c}), '%Y%m%d') as date) end"
    )


def _number(c: str) -> str:
    return f"case when contains({c}, ',') then replace(replace(trim({c}), '.', ''), ',', '.') else trim({c}) end"


def _decimal(c: str, declared: str) -> str:
    return f"try_cast({_number(c)} as {declared})"


def _int(c: str, declared: str) -> str:
    return f"case when {_DUCK_INT.format(c)} then try_cast(trim({c}) as {declared}) end"


def _typed(column: contract.Column) -> str:
    c = column.name
    value = {
        "string": lambda: c,
        "date": lambda: _date(c),
        "decimal": lambda: _decimal(c, column.declared),
        "bigint": lambda: _int(c, "bigint"),
        "int": lambda: _int(c, "integer"),
    }[column.kind]()
    return f"{value} as {c}"


def _names(rows: list[str]) -> str:
    return ", ".join(rows)


_RAW = f"raw as materialized ({derived.bills_raw_sql()})"
_TYPED = f"typed as materialized (select {_names([_typed(c) for c in contract.COLUMNS])} from raw)"
_BLANK = " or ".join(
    f"{c.name} is null or trim({c.name}) = ''" if c.kind == "string" else f"{c.name} is null" for c in contract.REQUIRED
)
_VALID = f"valid as materialized (select * from typed where not ({_BLANK}))"
_MISSING = (
    "concat_ws(''', ''', "
    + ", ".join(
        f"case when {c.name} is null{f' or trim({c.name}) = {chr(39) * 2}' if c.kind == 'string' else ''}"
        f" then '{c.header}' end"
        for c in contract.REQUIRED
    )
    + ")"
)
_REASON = f"'Campos obrigatórios nulos: [''' || {_MISSING} || ''']'"


def _yes(c: str) -> str:
    return f"coalesce({c} in ('S','SIM','1','TRUE','T'), false)"


_PAIRS = "pairs(consumption_class, consumption_subclass) as (values {})".format(
    ", ".join(f"('{c}', '{s}')" for c, names in contract.SUBCLASSES.items() for s in names)
)
_TYPE = "case when person_tax_id <> '' then 'PF' else 'PJ' end"
_PROFILE = ", ".join(
    f"coalesce({c} = 'S', false) as {c}" if c in ("free_customer", "micro_generator", "irrigator") else c
    for c in silver.PROFILE
)
_CUSTOMERS = f"customers as (select distinct customer_name, {_TYPE} as customer_type from valid)"
_ADDRESS = ", ".join(silver.ADDRESS_KEY)
_ADDRESSES = (
    f"addresses as (select distinct on ({_ADDRESS}) {_ADDRESS}, district, municipality, latitude, longitude"
    f" from valid order by {_ADDRESS}, line_no)"
)
_INSTALLATIONS = f"""installations as (
  select distinct on (installation) installation, contract_account, consumption_class, consumption_subclass,
    connected_on, commercial_status, {_yes('contract_active')} as contract_active, {_PROFILE}, {_ADDRESS},
    'DISTRIBUIDORA_PADRAO' as distributor
  from valid join pairs using (consumption_class, consumption_subclass) order by installation, line_no)"""
_BILLS = f"""bills as materialized (
  select row_number() over () as bill_id, * replace (cast(billed_kwh as decimal(18,2)) as billed_kwh,
    cast(measured_kwh as decimal(18,2)) as measured_kwh)
  from (select distinct {', '.join(
      f'{_yes(c)} as {c}' if c == 'cancelled' else f'c.{c}' if c == 'customer_type' else f'v.{c}' for c in silver.BILL)}
    from valid v join customers c on c.customer_name = v.customer_name
    join installations i on i.installation = v.installation) d)"""
_PAYMENTS = """payments as (
  select b.bill_id, b.bill_number, p.paid_on, p.payment_channel, p.paid_amount
  from bills b join (select distinct on (bill_number, paid_on) * from valid
    where paid_on is not null order by bill_number, paid_on, line_no) p on p.bill_number = b.bill_number)"""
_LEVIES = """levies as (
  select distinct b.bill_id, b.bill_number, v.levy from bills b join valid v on v.bill_number = b.bill_number
  where v.levy is not null)"""
_BASE = """base as materialized (
  select b.bill_number, b.customer_name, b.customer_type, b.installation, i.consumption_class, i.consumption_subclass,
    a.district, a.municipality, b.billing_month, b.reference_month,
    cast(strptime(b.billing_month || '01', '%Y%m%d') as date) as month, b.measured_kwh, b.billed_kwh, b.bill_amount,
    coalesce(l.levy, 0)::decimal(18,2) as levy_billed, coalesce(p.paid, 0)::decimal(18,2) as paid_total,
    round(coalesce(l.levy, 0)::double
      * least(coalesce(p.paid, 0)::double / nullif(b.bill_amount::double, 0), 1.0), 2)::decimal(18,2) as levy_collected
  from bills b join installations i on i.installation = b.installation
  left join addresses a on a.street = i.street and a.house_number = i.house_number
    and a.complement = i.complement and a.postal_code = i.postal_code
  left join levies l on l.bill_id = b.bill_id
  left join (select bill_id, sum(paid_amount) as paid from payments group by bill_id) p on p.bill_id = b.bill_id)"""

_CHECKED_CTES = [_RAW, _TYPED]
_VALID_CTES = [*_CHECKED_CTES, _VALID]
_CUSTOMER_CTES = [*_VALID_CTES, _CUSTOMERS]
_BILL_CTES = [*_CUSTOMER_CTES, _PAIRS, _INSTALLATIONS, _BILLS]
_BASE_CTES = [*_BILL_CTES, _ADDRESSES, _PAYMENTS, _LEVIES, _BASE]

_TRIAL_CTES = [f"trials as ({derived.trials_sql()})", f"loads as ({derived.loads_sql()})"]
_MILESTONES = {
    "created": "Load id created%", "schema": "Schema valid", "reading": "Reading file%", "clearing": "Clearing raw",
    "cleared": "Raw cleared", "history": "Writing history", "copied": "History copied", "finished": "Load finished%",
}
_STEPS = (
    f"steps as materialized (select *, timestamp '2026-09-01' + ms * interval '1' millisecond as ts"
    f" from ({derived.log_steps_sql()}))"
)
_LANDMARKS = (
    "landmarks as materialized (select load_id, "
    + ", ".join(f"min(ts) filter (message like '{text}') as {k}" for k, text in _MILESTONES.items())
    + ", min(try_cast(regexp_extract(message, '[0-9]+$') as bigint)) filter (message like 'Load finished%') as rows_logged"
    " from steps where origin in ('__main__', 'schema_check') group by load_id)"
)


def _ms(a: str, b: str) -> str:
    return f"date_diff('microsecond', {a}, {b}) / 1000.0::double"


_METRICS = {
    "ingest_ms": ("created", "finished"), "pre_read_ms": ("created", "reading"),
    "schema_ms": ("created", "schema"), "read_to_done_ms": ("reading", "finished"),
}
_TIMINGS = f"""timings as materialized (
  select t.load_id, t.trial_id, t.grp, t.fault, t.iteration, t.outcome, l.status, l.n_rows, m.rows_logged,
    m.created as created_at, m.finished as finished_at,
    {', '.join(f'{_ms(a, b)} as {n}' for n, (a, b) in _METRICS.items())}
  from trials t join loads l on l.load_id = t.load_id left join landmarks m on m.load_id = t.load_id)"""
_LONG = f"""long as materialized (
  {' union all '.join(f"select '{n}' as metric, grp, fault, {n} as ms from timings where {n} is not null"
                      for n in _METRICS)})"""
_SUMMARY = """summary as materialized (
  select metric, grp, fault, count(*) as n, avg(ms) as mean, stddev_samp(ms) as stdev, min(ms) as min, max(ms) as max,
    median(ms) as median
  from long where (grp = 'CONTROL' and fault = 'NONE')
    or (grp = 'TREATMENT' and fault in ('NONE', 'CONNECTION', 'NULL_DATA', 'FILE_MISSING'))
  group by metric, grp, fault)"""
_LOAD_STEPS = {
    "schema_check": ("created", "reading"), "read_convert": ("reading", "clearing"),
    "clear_raw": ("clearing", "cleared"), "insert_rows": ("cleared", "history"),
    "copy_history": ("history", "copied"), "finish": ("copied", "finished"), "total": ("created", "finished"),
}
_QUIET_STEPS = "quiet as materialized ({})".format(
    " union all ".join(
        f"select '{n}' as step, t.grp, t.iteration, t.trial_id, {_ms(a, b)} as ms from trials t join landmarks m"
        f" on m.load_id = t.load_id where t.fault = 'NONE' and m.{a} is not null and m.{b} is not null"
        for n, (a, b) in _LOAD_STEPS.items()
    )
)
_TESTED = "tested as (select metric, grp, ms from long where fault = 'NONE' and metric <> 'schema_ms')"
_LOG_CTES = [*_TRIAL_CTES, _STEPS, _LANDMARKS]
_TIMING_CTES = [*_LOG_CTES, _TIMINGS, _LONG, _SUMMARY]
_RETRIES = """retries as materialized (
  select load_id, max(ts) filter (message = 'Attempt 1/3') as try1_at, max(ts) filter (message = 'Attempt 2/3') as try2_at,
    max(ts) filter (message = 'Attempt 3/3') as try3_at, max(ts) filter (message like 'Connected after 3%') as connected_at,
    max(try_cast(regexp_extract(message, 'in ([0-9]+) ms', 1) as bigint)) filter (message like 'Connected after 3%') as recovery_ms
  from steps where origin = 'db_utils' and message not like 'Connection failed%' group by load_id
  having connected_at is not null)"""
_SEQUENCES = """sequences as materialized (
  select load_id, stopped.ts as shutdown_at, ready.ts as ready_at, try1_at, try2_at, try3_at, connected_at, recovery_ms
  from retries asof join (select ts from steps where message like '%fast shutdown request%') stopped
    on retries.try1_at > stopped.ts
  asof join (select ts from steps where message like '%ready to accept connections%') ready on stopped.ts < ready.ts)"""
_OUTAGE_CTES = [_STEPS, _RETRIES, _SEQUENCES]


def _with(ctes: list[str], body: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body


def _text(c: str) -> str:
    return f"cast({c} as varchar) as {c}"


def _double(c: str) -> str:
    return f"cast({c} as double) as {c}"


def _shown(columns: list[str]) -> str:
    """Select list of contract columns with dates as text and decimals as doubles."""
    kinds = {c.name: c.kind for c in contract.COLUMNS}
    form = {"date": _text, "decimal": _double}
    return ", ".join(form.get(kinds.get(c, "string"), str)(c) for c in columns)


def _mean(total: str, n: str) -> str:
    """Quotient of cents rounded half up, in integers."""
    cents = f"cast({total} * 100 as hugeint)"
    return f"cast((2 * {cents} + {n}) // (2 * nullif({n}, 0)) as double) / 100"


def _per_month(keys: str, measures: str) -> str:
    keys = f", {keys}" if keys else ""
    return _with(_BASE_CTES, f"select cast(month as varchar) as month{keys}, {measures} from base group by month{keys}")


_TICKET = (
    "count(distinct (customer_name, customer_type)) as n_customers, cast(sum(levy_billed) as double) as levy_billed, "
    + _mean("sum(levy_billed)", "count(distinct (customer_name, customer_type))")
    + " as levy_ticket"
)
_CLASS, _SUBCLASS = "consumption_class", "consumption_class, consumption_subclass"
_KWH = "cast(sum(measured_kwh) as double) as kwh"
_COLLECTED = "cast(sum(levy_collected) as double) as levy_collected"
_LOSS = "cast(sum(levy_billed - levy_collected) as double) as levy_loss"


def _list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def _header_rows() -> str:
    """Both set differences by lists, per month."""
    wanted = "[" + ", ".join(f"'{h}'" for h in contract.HEADERS) + "]"
    shown = lambda names: f"'[' || coalesce(list_aggregate([chr(39) || x || chr(39) for x in {names}], 'string_agg', ', '), '') || ']'"
    a, b, c, d, e = contract.HEADER_INVALID.split("{}")
    broken = f"'{a}' || len(missing) || '{b}' || len(extra) || '{c}' || {shown('missing')} || '{d}' || {shown('extra')} || '{e}'"
    return _with([f"raw as materialized ({derived.bills_raw_sql(names=['billing_month'])})", f"""files as (
  select billing_month as file, count(*) as n_rows, string_split({derived.MONTH_HEADER}, ';') as found from raw group by billing_month)""", f"""compared as (
  select file, n_rows, [h for h in {wanted} if not list_contains(found, h)] as missing,
    [h for h in found if not list_contains({wanted}, h)] as extra from files)"""], f"""
select file, len(missing) = 0 and len(extra) = 0 as valid, array_to_string(missing, ',') as missing,
  array_to_string(extra, ',') as extra,
  case when len(missing) = 0 and len(extra) = 0 then '{contract.HEADER_VALID.format(len(contract.HEADERS))}' else {broken} end as message,
  n_rows
from compared""")


def _keyed(columns: list[str]) -> str:
    """A Feistel network of eight rounds written out, one subquery a round."""
    ctes, joined = [f"raw as materialized ({derived.bills_raw_sql(names=['line_no', *columns])})"], []
    for i, c in enumerate(columns):
        rounds = f"""(select cast(line_no as bigint) as line_no, {c} as original, cast(case when regexp_full_match({c}, '[0-9]+') then {c} end as bigint) as v,
    cast(pow(10, length({c}) // 2) as bigint) as lo, cast(pow(10, length({c}) - length({c}) // 2) as bigint) as hi from raw)"""
        rounds = f"(select line_no, original, v // lo as x, v % lo as y, hi as xs, lo as ys from {rounds})"
        for n in range(1, ROUNDS + 1):
            f = f"cast('0x' || substr(md5('{MASK_KEY}:{c}:{n}:' || y), 1, 12) as bigint)"
            rounds = f"(select line_no, original, y as x, (x + {f}) % xs as y, ys as xs, xs as ys from {rounds})"
        ctes.append(f"m{i} as (select line_no, coalesce(lpad(cast(x * ys + y as varchar), cast(length(original) as int), '0'), original) as {c} from {rounds})")
        joined.append(f"m{i}")
    return _with(ctes, f"select line_no, {', '.join(columns)} from " + " join ".join(
        name if i == 0 else f"{name} using (line_no)" for i, name in enumerate(joined)
    ))


def _violations() -> str:
    tests = {
        "line_no": f"not {_DUCK_INT.format('line_no')}",
        "block_reason": "length(block_reason) > 255",
        "latitude": f"latitude <> '' and {_decimal('latitude', 'decimal(18,12)')} is null",
        "bill_amount": f"bill_amount <> '' and {_decimal('bill_amount', 'decimal(18,2)')} is null",
        "cycle_days": f"cycle_days <> '' and not {_DUCK_INT.format('cycle_days')}",
    }
    faults = ", ".join(f"case when {tests[c.name]} then '{c.header}' end" for c in contract.COLUMNS if c.name in tests)
    raw = f"raw as materialized ({derived.bills_raw_sql(changed=derived.BROKEN_TEXT)})"
    due = f"case when {_date('due_on')} is null then 'DATA_VENCIMENTO_ORIGINAL' end"
    place = "case when trim(municipality) = '' then 'MUNICIPIO' end"
    inner = (
        f"select bill_number, concat_ws(''', ''', {due}, {place}) as missing,"
        f" concat_ws(''', ''', {faults}) as violations from raw"
    )
    return _with([raw], f"select * from ({inner}) where violations <> ''")


def _control() -> str:
    counts = (
        f"counts as (select billing_month, count(*) filter (not ({_BLANK})) as n_rows,"
        f" count(*) filter ({_BLANK}) as n_quarantined from typed group by billing_month)"
    )
    return _with([*_CHECKED_CTES, counts], """
select billing_month, n_rows, n_quarantined, case when n_quarantined > 0 then 'NULL_DATA' else 'NONE' end as fault_type,
  case when n_quarantined > 0 then 'QUARANTINE' else 'NONE' end as mechanism,
  case when n_quarantined > 0 and n_rows = 0 then 'ERROR' else 'SUCCESS' end as status,
  n_quarantined > 0 and n_rows > 0 as auto_resolved, true as self_healing from counts
union all
select billing_month, case when n_quarantined = 0 then n_rows end, 0,
  case when n_quarantined > 0 then 'NULL_DATA' else 'NONE' end, 'NONE',
  case when n_quarantined > 0 then 'ERROR' else 'SUCCESS' end, false, false from counts""")


def _many_faults() -> str:
    """The fault type is what the first true of an ordered list of tests says."""
    retried, fell_back, bad_header, bad_rows = "load_id % 5 = 0", "load_id % 7 = 0", "load_id % 11 = 0", "bad > 0"
    held = f"({bad_rows} and not {bad_header})"

    def mode(healing: bool) -> str:
        used = [(retried, "RETRY_BACKOFF"), (fell_back, "FILE_FALLBACK"), (bad_header, "SCHEMA_CHECK"),
                (held, "QUARANTINE" if healing else "NONE")]
        names = ", ".join(f"case when {test} then '{name}' end" for test, name in used)
        failed = f"({bad_header} or ({bad_rows} and {'n = 0' if healing else 'true'}))"
        kind = (
            f"case when {retried} then 'CONNECTION' when {fell_back} then 'FILE_MISSING' when {bad_header} then 'SCHEMA'"
            f" when {bad_rows} then 'NULL_DATA' else 'NONE' end"
        )
        n_rows = "n" if healing else f"case when not {failed} then n end"
        return (
            f"select load_id, {n_rows} as n_rows, {'bad' if healing else 0}::bigint as n_quarantined, {kind} as fault_type,"
            f" coalesce(nullif(concat_ws('+', {names}), ''), 'NONE') as mechanism,"
            f" case when {failed} then 'ERROR' else 'SUCCESS' end as status,"
            f" {kind} <> 'NONE' and not {failed} as auto_resolved, {healing} as self_healing from counted"
        )

    counted = (
        "counted as (select load_id, case when load_id % 4 = 0 then 0 else load_id % 100 end::bigint as n,"
        " (load_id % 3)::bigint as bad from loads)"
    )
    return _with([*_TRIAL_CTES, counted], f"{mode(True)} union all {mode(False)}")


def _seeds() -> str:
    rows = [("commercial_status", c, d) for c, d in contract.COMMERCIAL_STATUS]
    rows += [("entity_type", c, d) for c, d in contract.ENTITY_TYPES]
    rows += [("opinion_status", d, d) for d in contract.OPINION_STATUS]
    rows += [("customer_type", "PF", "PF"), ("customer_type", "PJ", "PJ")]
    rows += [("distributor", contract.DISTRIBUTOR, contract.DISTRIBUTOR)]
    values = ", ".join(str(r) for r in rows)
    return _with([*_VALID_CTES, _PAIRS], f"""
select 'subclass' as domain, consumption_class as code, consumption_subclass as description, (select count(*)
  from valid v where v.consumption_class = p.consumption_class and v.consumption_subclass = p.consumption_subclass
  ) as n_rows from pairs p
union all select domain, code, description, (select count(*) from valid v where s.domain = 'commercial_status'
  and v.commercial_status = s.code) from (values {values}) s(domain, code, description)""")


_RANKED = "rank() over (partition by {0} order by {1}) + (count(*) over (partition by {0}, {1}) - 1) / 2.0"


def _labels(column: str, prefix: str, keep_blank: bool) -> str:
    where = f" where trim({column}) <> ''" if keep_blank else ""
    return (
        f"{column}_labels as (select {column}, '{prefix}' || lpad(cast(n as varchar),"
        f" cast(greatest(3, length(cast(n as varchar))) as int), '0') as label from (select {column},"
        f" row_number() over (order by min(cast(line_no as bigint))) as n from raw{where} group by {column}))"
    )


_LABEL_CTES = [
    _RAW, _labels("street", "RUA FICTICIA ", False), _labels("complement", "COMPLEMENTO ", True),
    _labels("district", "BAIRRO ", False),
]


def _pad(number: str, width: int) -> str:
    text = f"cast({number} as varchar)"
    return f"lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


_MASKED_IDS = f"""
select line_no, {_pad('seq', 10)} as installation, case when follows then '00' || {_pad('seq', 10)}
  else '0030' || {_pad('own', 8)} end as contract_account, '0' || billing_month || {_pad('seq', 9)} as bill_number,
  '3' || {_pad('seq', 11)} as print_document
from (select *, row_number() over (order by line_no) as seq,
    sum(case when follows then 0 else 1 end) over (order by line_no) as own
  from (select cast(line_no as bigint) as line_no, billing_month, contract_account = '00' || installation as follows
    from raw))"""
_HOUSE_CTES = [
    "originals as (select distinct house_number from raw where regexp_full_match(house_number, '[0-9]+'))",
    f"""pool as (select id from (select unnest(generate_series(1, (select {masking.LARGEST_HOUSE_NUMBER} + 2 * count(*)
  from originals))) as id) where id not in (select try_cast(house_number as bigint) from originals
  where try_cast(house_number as bigint) is not null))""",
    f"""house_map as (select house_number, cast(id as varchar) as masked
from (select house_number, row_number() over (order by md5('{masking.SEED}:original:' || house_number)) as slot
  from originals)
join (select id, row_number() over (order by md5('{masking.SEED}:pool:' || id)) as slot from pool) using (slot))""",
]


def _coordinate(c: str) -> str:
    rounded = f"cast(round(cast(replace({c}, ',', '.') as decimal(18,12)), 2) as decimal(18,2))"
    return f"case when {c} = '' then '' else replace(cast({rounded} as varchar), '.', ',') || '0000000000' end as {c}"


def _area(limit: str, density: str) -> str:
    """Simpson's rule from 0 to the limit; the density is a function of x."""
    at = density.replace("{x}", f"({limit} * i / 2000.0)")
    weight = "case when i in (0, 2000) then 1 when i % 2 = 1 then 4 else 2 end"
    return f"{limit} / 6000.0 * list_sum([({weight}) * {at} for i in range(0, 2001)])"


def _normal_share(z: str) -> str:
    inside = _area(f"least(abs({z}), 40)", "exp(-{x} * {x} / 2) / sqrt(2 * pi())")
    return f"case when {z} <= 0 then 1.0 when {z} > 0 then greatest(1 - 2 * {inside}, 0) end"


def _student_share(t: str, df: str) -> str:
    scale = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi())"
    inside = _area(f"least(abs({t}), 60)", f"pow(1 + {{x}} * {{x}} / {df}, -({df} + 1) / 2)")
    return f"case when {t} is not null then greatest(1 - 2 * {scale} * {inside}, 0) end"


def _rank_sums(key: str, rows: str, digits: int = 4) -> str:
    ranks = _RANKED.format(key, "ms")
    return f"""
select {key}, n_first, n_second, round(u, {digits}) as u, round((greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5)
  / nullif(sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))), 0), {digits}) as z
from (select {key}, n_first, n_second, n_first::double as n1, n_second::double as n2,
    ranks - n_first::double * (n_first + 1) / 2 as u, ties
  from (select {key}, count(*) filter (grp = 'TREATMENT') as n_first, count(*) filter (grp = 'CONTROL') as n_second,
      sum(r) filter (grp = 'TREATMENT') as ranks, sum(same * same - 1) as ties
    from (select {key}, grp, cast({ranks} as double) as r,
        cast(count(*) over (partition by {key}, ms) as double) as same from {rows}) group by {key}))"""


def _small_samples() -> str:
    """The exact tail by listing every arrangement of up to 16 places as a number in binary."""
    tested = " union all ".join(
        f"select '{n}' as metric, iteration, grp, {n} as ms from timings where fault = 'NONE' and {n} is not null"
        for n in _METRICS if n != "schema_ms"
    )
    arranged = """arranged as materialized (
  select n, n1, cast(sum_r as bigint) - n1 * (n1 + 1) // 2 as u0, count(*) as ways
  from (select m, cast(bit_count(m) as bigint) as n1, list_sum([i for i in range(1, 17) if (m >> (i - 1)) & 1 = 1]) as sum_r
    from range(0, 65536) t(m)) join range(4, 17) s(n) on m < (1 << n) group by n, n1, sum_r)"""
    sums = f"sums as materialized ({_rank_sums('metric, iteration', 'small', 15)})"
    tied = "ties as (select metric, iteration, count(*) <> count(distinct ms) as tied from small group by metric, iteration)"
    exact = """exact as (
  select metric, iteration, 2.0 * sum(ways) filter (u0 <= least(u, n_first * n_second - u)) / sum(ways) as p
  from sums join arranged on n = n_first + n_second and n1 = n_first group by metric, iteration, u)"""
    return _with([*_LOG_CTES, _TIMINGS, f"small as ({tested})", sums, tied, arranged, exact], f"""
select metric, iteration, n_first, n_second, round(u, 6) as u, tied, round(case when not tied then least(p, 1.0) end, 6) as p_exact,
  round(normal, 6) as p_normal, round(coalesce(case when not tied then least(p, 1.0) end, normal), 6) as p
from (select *, {_normal_share('z')} as normal from sums) join ties using (metric, iteration) left join exact using (metric, iteration)
where n_first between 2 and 8 and n_second between 2 and 8""")


def _welch(digits: int) -> str:
    return f"""
select metric, round((m1 - m2) / nullif(sqrt(v1 + v2), 0), {digits}) as t,
  round((v1 + v2) * (v1 + v2) / nullif(v1 * v1 / (n1 - 1) + v2 * v2 / (n2 - 1), 0), {digits}) as df
from (select metric, avg(ms) filter (grp = 'TREATMENT') as m1, avg(ms) filter (grp = 'CONTROL') as m2,
    var_samp(ms) filter (grp = 'TREATMENT') / count(*) filter (grp = 'TREATMENT') as v1,
    var_samp(ms) filter (grp = 'CONTROL') / count(*) filter (grp = 'CONTROL') as v2,
    count(*) filter (grp = 'TREATMENT') as n1, count(*) filter (grp = 'CONTROL') as n2 from tested group by metric)"""


def _correlations(digits: int) -> str:
    return f"""
select grp, step, count(*) as n, round(corr(rx, ry), {digits}) as rho
from (select grp, step, cast({_RANKED.format('grp, step', 'iteration')} as double) as rx,
    cast({_RANKED.format('grp, step', 'ms')} as double) as ry from quiet where step in ('total', 'insert_rows'))
group by grp, step"""


def _summary_by_trial(value: str, extra: str = "") -> str:
    return _with(_TRIAL_CTES, f"""
select grp, fault, count(*) as n, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as stdev, min(v) as min,
  max(v) as max, median(v) as median{extra}
from (select grp, fault, attempts, {value} as v from trials join loads using (load_id)) group by grp, fault""")


def oracle_sql() -> dict[str, str]:
    every = contract.NAMES
    violations = _violations()
    asof = """select t.trial_id, t.injected_at, n.load_id, n.started_at
from trials t left join (select w.injected_at, max_by(l.load_id, (l.started_at, l.load_id)) as load_id,
    max(l.started_at) as started_at
  from loads l asof join (select distinct injected_at from trials) w on l.started_at >= w.injected_at
  group by w.injected_at) n on n.injected_at = t.injected_at"""
    elapsed = _ms("started_at", "ended_at")
    found = {
        "scan_bills": _with([_RAW], f"select {_names(every)} from raw"),
        "scan_mixed_headers": _with([_RAW], f"select {_names(every)} from raw"),
        "header_contract_report": _header_rows(),
        "scan_quoted_breaks": derived.bills_raw_sql(changed=derived.QUOTED_TEXT),
        "mask_keyed": _keyed(masking.KEYED_COLUMNS),
        "parse_dates": _with(_CHECKED_CTES, f"select line_no, {_shown(DATES)} from typed"),
        "parse_decimals": _with(_CHECKED_CTES, f"select line_no, {_shown(DECIMALS)} from typed"),
        "special_numbers": f"""
select cast(line_no as bigint) as line_no, case when lower(trim(bill_amount, ' +-')) not in ('nan', 'inf', 'infinity', '1e400')
  then cast(replace(replace(bill_amount, '.', ''), ',', '.') as double) end as bill_amount
from ({derived.bills_raw_sql(names=["line_no", "bill_amount"], changed=derived.SPECIAL_TEXT)})""",
        "history_lineage": _with(_VALID_CTES, """
select case when cast(billing_month as int) % 2 = 1 then 1 else 2 end::bigint as load_id, line_no, bill_number,
  true as file_named, true as timed from valid"""),
        "parse_ints": _with(_CHECKED_CTES, "select bill_number, line_no, cycle_days from typed"),
        "bills_typed": _with(_CHECKED_CTES, f"select {_shown(every)} from typed"),
        "valid_rows": _with(
            _VALID_CTES,
            "select line_no, bill_number, municipality, consumption_class, cast(due_on as varchar) as due_on,"
            " cast(bill_amount as double) as bill_amount from valid",
        ),
        "required_null_fields": _with(
            _CHECKED_CTES, f"select * from (select line_no, {_MISSING} as missing from typed) where missing <> ''"
        ),
        "constraint_violations": violations,
        "quarantine_rows": _with(
            _CHECKED_CTES,
            f"select line_no, {_REASON} as reason, customer_name, cast(due_on as varchar) as due_on, complement,"
            f" {len(every)} as n_fields from typed where {_BLANK}",
        ),
        "load_control_rows": _control(),
        "fail_fast_report": _with(
            _CHECKED_CTES, f"select line_no, {_REASON} as reason from typed where {_BLANK} order by line_no limit 1"
        ),
        "load_outcome_class": _with(_TRIAL_CTES, """
select load_id, fault_type, mechanism, case when failed then 'ERROR' else 'SUCCESS' end as status,
  fault_type <> 'NONE' and not failed as auto_resolved
from (select load_id,
    case when attempts > 1 then 'CONNECTION' when file_name = 'Sample_Backup.csv' then 'FILE_MISSING'
      when mechanism = 'SCHEMA_CHECK' then 'SCHEMA' when n_quarantined > 0 then 'NULL_DATA' else 'NONE' end as fault_type,
    case when attempts > 1 then 'RETRY_BACKOFF' when file_name = 'Sample_Backup.csv' then 'FILE_FALLBACK'
      when mechanism = 'SCHEMA_CHECK' then 'SCHEMA_CHECK' when n_quarantined > 0 then 'QUARANTINE'
      else 'NONE' end as mechanism,
    mechanism = 'SCHEMA_CHECK' or (n_quarantined > 0 and coalesce(n_rows, 0) = 0) as failed from loads)"""),
        "load_outcome_of_many_faults": _many_faults(),
        "history_load_bounds": _with(
            _VALID_CTES,
            "select billing_month as load_id, cast(min(due_on) as timestamp) as first_at,"
            " cast(max(due_on) as timestamp) as last_at from valid group by billing_month",
        ),
        "seed_domains": _seeds(),
        "commercial_status": _with(_VALID_CTES, """
select * from (values ('LG', 'Ligado'), ('BL', 'Bloqueado'), ('DS', 'Desligado')) s(code, description)
union all select distinct commercial_status, commercial_status from valid
where commercial_status not in ('LG', 'BL', 'DS')"""),
        "bill_status": _with(_VALID_CTES, "select distinct bill_status as description from valid"),
        "tariff_categories": _with(
            _VALID_CTES, "select distinct tariff_category as code, cast(null as varchar) as description from valid"
        ),
        "municipalities": _with(
            _VALID_CTES, "select distinct municipality as name, cast(null as varchar) as state from valid"
        ),
        "regulatory_profiles": _with(_VALID_CTES, f"select distinct {_PROFILE} from valid"),
        "addresses": _with(
            [*_VALID_CTES, _ADDRESSES],
            f"select {_ADDRESS}, district, municipality, {_shown(['latitude', 'longitude'])} from addresses",
        ),
        "customers": _with(_CUSTOMER_CTES, "select * from customers"),
        "customers_person": _with(_CUSTOMER_CTES, """
select v.customer_name, (select min(customer_type) from customers c where c.customer_name = v.customer_name)
  as customer_type, v.person_tax_id
from (select distinct on (person_tax_id) * from valid where person_tax_id <> '' order by person_tax_id, line_no) v"""),
        "customers_company": _with(_CUSTOMER_CTES, """
select v.customer_name, (select min(customer_type) from customers c where c.customer_name = v.customer_name)
  as customer_type, v.company_tax_id
from (select distinct on (company_tax_id) * from valid where company_tax_id <> '' order by company_tax_id, line_no) v"""),
        "installations": _with(
            [*_VALID_CTES, _PAIRS, _INSTALLATIONS],
            "select * replace (cast(connected_on as varchar) as connected_on) from installations",
        ),
        "bills": _with(_BILL_CTES, f"select {_shown(silver.BILL)} from bills"),
        "payments": _with(
            [*_BILL_CTES, _PAYMENTS],
            f"select bill_number, {_shown(['paid_on'])}, payment_channel, {_shown(['paid_amount'])} from payments",
        ),
        "taxes": _with(_BILL_CTES, f"""
select b.bill_number, {_shown(['tax_pis', 'tax_cofins', 'tax_icms'])} from bills b
join (select distinct on (bill_number) bill_number, tax_pis, tax_cofins, tax_icms from valid
  order by bill_number, line_no) v on v.bill_number = b.bill_number"""),
        "reading_cycles": _with(_BILL_CTES, """
select bill_number, cast(cycle_start as varchar) as cycle_start, cast(cycle_end as varchar) as cycle_end, cycle_days
from (select distinct b.bill_id, b.bill_number, v.cycle_start, v.cycle_end, v.cycle_days from bills b
  join valid v on v.bill_number = b.bill_number where v.cycle_start is not null)"""),
        "rebills": _with(_BILL_CTES, f"""
select bill_number, bill_number as new_bill_number, cast(rebilled_on as varchar) as rebilled_on,
  {_shown(['substitute_amount', 'substitute_levy'])}
from (select distinct b.bill_id, b.bill_number, v.rebilled_on, v.substitute_amount, v.substitute_levy from bills b
  join valid v on v.bill_number = b.bill_number where {_yes('v.rebilled')})"""),
        "levies": _with([*_BILL_CTES, _LEVIES], "select bill_number, cast(levy as double) as levy from levies"),
        "insert_if_absent": _with(_VALID_CTES, f"""
select distinct on ({_ADDRESS}) {_ADDRESS}, district, municipality from valid v
where billing_month >= '{INSERT_SPLIT_MONTH}' and not exists (select 1 from valid w
  where w.billing_month < '{INSERT_SPLIT_MONTH}' and {' and '.join(f'w.{k} = v.{k}' for k in silver.ADDRESS_KEY)})
order by {_ADDRESS}, line_no"""),
        "preview_table": _with(_BILL_CTES, f"""select {_shown(silver.BILL)} from (select * from bills
order by {', '.join(f'{c} nulls first' for c in silver.BILL)} limit 100)"""),
        "null_in_required_fact": _with([f"raw as materialized ({derived.bills_raw_sql(changed=derived.UNFINISHED_TEXT)})", _TYPED], """
select line_no, bill_number, case when paid_on is not null and paid_amount is null then 'payment without amount'
  else 'rebill without date' end as fault
from typed where (paid_on is not null and paid_amount is null)
  or (rebilled_on is null and rebilled in ('S', 'SIM', '1', 'TRUE', 'T'))"""),
        "unmatched_rows": _with([*_VALID_CTES, _PAIRS, _INSTALLATIONS], """
select line_no, bill_number, case when consumption_class not in (select consumption_class from pairs)
  then 'consumption_class' when (consumption_class, consumption_subclass) not in (select
  (consumption_class, consumption_subclass) from pairs) then 'consumption_subclass' else 'installation' end as lost_by
from valid where installation not in (select installation from installations)"""),
        "unmatched_rows_with_gaps": _with([*_VALID_CTES, _PAIRS], """
select line_no, bill_number, lost_by from (select line_no, bill_number,
  case when line_no % 11 = 0 then 'consumption_class'
    when not exists (select 1 from pairs p where p.consumption_class = v.consumption_class
      and p.consumption_subclass = v.consumption_subclass) then 'consumption_subclass'
    when line_no % 13 = 0 then 'commercial_status' when line_no % 17 = 0 or line_no % 19 = 0 then 'address'
    when line_no % 23 = 0 or line_no % 31 = 0 then 'regulatory_profile' when line_no % 29 = 0 then 'installation'
  end as lost_by from valid v) where lost_by is not null"""),
        "unmatched_lookups_with_gaps": _with([*_VALID_CTES, _PAIRS], """
select line_no, bill_number, lost_by from (select line_no, bill_number, concat_ws(',',
  case when line_no % 11 = 0 then 'consumption_class'
    when not exists (select 1 from pairs p where p.consumption_class = v.consumption_class
      and p.consumption_subclass = v.consumption_subclass) then 'consumption_subclass' end,
  case when line_no % 13 = 0 then 'commercial_status' end, case when line_no % 17 = 0 or line_no % 19 = 0 then 'address' end,
  case when line_no % 23 = 0 or line_no % 31 = 0 then 'regulatory_profile' end,
  case when line_no % 29 = 0 then 'installation' end) as lost_by from valid v) where lost_by <> ''"""),
        "levy_base": _with(_BASE_CTES, """
select * replace (cast(month as varchar) as month, measured_kwh::double as measured_kwh,
  billed_kwh::double as billed_kwh, bill_amount::double as bill_amount, levy_billed::double as levy_billed,
  paid_total::double as paid_total, levy_collected::double as levy_collected) from base"""),
        "consumption_by_district": _per_month("district", _KWH),
        "consumption_by_municipality": _per_month("municipality", _KWH),
        "consumption_by_subclass": _per_month(_SUBCLASS, _KWH),
        "bill_average_by_district": _per_month(
            "district",
            "count(*) as n_bills, cast(sum(bill_amount) as double) as total_amount, "
            + _mean("sum(bill_amount)", "count(bill_amount)") + " as mean_amount",
        ),
        "levy_collected_by_class": _per_month(_CLASS, _COLLECTED),
        "levy_collected_by_subclass": _per_month(_SUBCLASS, _COLLECTED),
        "levy_collected_by_municipality": _per_month("municipality", _COLLECTED),
        "levy_billed_by_month": _per_month("", "cast(sum(levy_billed) as double) as levy_billed"),
        "levy_customers_sketched": _with(_BASE_CTES, """
select consumption_class, count(distinct (customer_name, customer_type)) as n_customers, true as sketch_is_near
from base group by consumption_class"""),
        "levy_ticket_by_class": _per_month(_CLASS, _TICKET),
        "levy_ticket_by_municipality": _per_month("municipality", _TICKET),
        "district_ranking": _per_month(
            "district",
            _KWH + ", rank() over (partition by month order by sum(measured_kwh) desc nulls first) as position",
        ),
        "levy_loss_by_municipality": _per_month("municipality", _LOSS),
        "levy_loss_by_district": _per_month("district", _LOSS),
        "trial_load_join": _with(_TRIAL_CTES, "select * from trials left join loads using (load_id)"),
        "success_rate": _with(_TRIAL_CTES, """
select grp, fault, count(*) as n_trials, count(*) filter (outcome = 'success') as n_success,
  round(100.0 * count(*) filter (outcome = 'success') / count(*), 2)::double as success_pct
from trials left join loads using (load_id) group by grp, fault"""),
        "fault_pivot": _with(_TRIAL_CTES, "select fault, " + ", ".join(
            f"count(*) filter (grp = '{g}' and outcome = 'success') as {n}_success,"
            f" round(100.0 * count(*) filter (grp = '{g}' and outcome = 'success')"
            f" / nullif(count(*) filter (grp = '{g}'), 0), 1)::double as {n}_pct"
            for n, g in (("control", "CONTROL"), ("treatment", "TREATMENT"))
        ) + " from trials left join loads using (load_id) where fault <> 'NONE' group by fault"),
        "runs_by_state": _with(_TRIAL_CTES, "select outcome, count(*) as n_runs from trials group by outcome"),
        "mechanism_activations": _with(_TRIAL_CTES, """
select mechanism, grp, count(*) as n_activations, count(*) filter (auto_resolved) as n_resolved
from trials join loads using (load_id) group by mechanism, grp"""),
        "mttr_by_fault": _with(_TRIAL_CTES, """
select fault_type, count(*) as n_recovered, round(avg(recovery_ms), 2)::double as mttr_ms,
  round(avg(recovery_ms) / 1000, 3)::double as mttr_s, min(recovery_ms) as min_ms, max(recovery_ms) as max_ms
from trials join loads using (load_id) where grp = 'TREATMENT' and auto_resolved and recovery_ms is not null
group by fault_type"""),
        "mttr_detail": _with(_TRIAL_CTES, """
select round(avg(recovery_ms), 2) as mean_ms, round(stddev_samp(recovery_ms), 2) as stdev_ms,
  min(recovery_ms) as min_ms, max(recovery_ms) as max_ms, count(*) filter (attempts = 3) as n_third_try
from trials join loads using (load_id) where grp = 'TREATMENT' and fault = 'CONNECTION'"""),
        "auto_resolved_pct": _with(_TRIAL_CTES, """
select fault, count(*) as n_trials, count(*) filter (auto_resolved) as n_resolved,
  round(100.0 * count(*) filter (auto_resolved) / count(*), 2)::double as resolved_pct
from trials join loads using (load_id) where grp = 'TREATMENT' and fault <> 'NONE' group by fault"""),
        "overhead_by_group": _with(_TRIAL_CTES, f"""
select grp, count(*) as n_trials, round(avg({elapsed}), 2) as mean_ms
from trials left join loads using (load_id) where fault = 'NONE' group by grp"""),
        "time_to_failure": _with(_TRIAL_CTES, f"""
select grp, count(*) as n, round(avg({elapsed}), 2) as mean_ms, round(stddev_samp({elapsed}), 2) as stdev_ms,
  round(min({elapsed}), 2) as min_ms, round(max({elapsed}), 2) as max_ms
from trials join loads using (load_id) where fault = 'SCHEMA' group by grp"""),
        "quarantine_yield": _with(_TRIAL_CTES, """
select cast(sum(n_rows) as bigint) as n_inserted, cast(sum(n_quarantined) as bigint) as n_quarantined,
  round(100.0 * sum(n_rows) / (sum(n_rows) + sum(n_quarantined)), 2)::double as yield_pct
from trials join loads using (load_id) where grp = 'TREATMENT' and fault = 'NULL_DATA'"""),
        "quarantine_by_reason": _with([*_CHECKED_CTES, *_TRIAL_CTES], f"""
select reason, count(*) as n_rows, count(distinct q.load_id) as n_loads
from (select {_REASON} as reason, line_no % 1000 + 1 as load_id from typed where {_BLANK}) q
join trials t on t.load_id = q.load_id where grp = 'TREATMENT' and fault = 'NULL_DATA' group by reason"""),
        "duration_summary": _summary_by_trial(elapsed),
        "recovery_summary": _summary_by_trial(
            "recovery_ms", ", min(attempts) as min_attempts, max(attempts) as max_attempts"
        ),
        "trial_load_asof": _with(_TRIAL_CTES, asof),
        "overlapping_runs": _with([f"runs as ({derived.runs_sql()})"], """
select s.scenario, s.n_runs, coalesce(o.n, 0) as n_overlapping
from (select scenario, count(*) as n_runs from runs group by scenario) s
left join (select a.scenario, count(*) as n from runs a join runs b on a.scenario = b.scenario and a.run_id < b.run_id
  and a.started_at < b.ended_at and b.started_at < a.ended_at group by a.scenario) o on o.scenario = s.scenario"""),
        "log_lines": _with([_STEPS], "select ts, origin, message from steps"),
        "log_landmarks": _with(_LOG_CTES, "select * from landmarks"),
        "grown_log_landmarks": _with(_LOG_CTES, "select * from landmarks"),
        "load_timings": _with(_TIMING_CTES, "select * from timings"),
        "timing_summary": _with(
            _TIMING_CTES, "select * replace (round(mean, 4) as mean, round(stdev, 4) as stdev) from summary"
        ),
        "overhead_summary": _with(_TIMING_CTES, """
select c.metric, round(c.mean, 4) as control_mean, round(c.median, 4) as control_median,
  round(t.mean, 4) as treatment_mean, round(t.median, 4) as treatment_median,
  round(t.mean - c.mean, 4) as mean_difference, round(t.median - c.median, 4) as median_difference,
  case when c.mean >= 1 then round(100 * (t.mean - c.mean) / c.mean, 4) end as mean_change_pct,
  case when c.median >= 1 then round(100 * (t.median - c.median) / c.median, 4) end as median_change_pct
from summary c join summary t on t.metric = c.metric and t.fault = 'NONE' and t.grp = 'TREATMENT'
where c.fault = 'NONE' and c.grp = 'CONTROL' and c.metric <> 'schema_ms'"""),
        "overhead_by_step": _with([*_LOG_CTES, _QUIET_STEPS], """
select step, grp, count(*) as n, round(avg(ms), 4) as mean_ms, round(stddev_samp(ms), 4) as stdev_ms
from quiet group by step, grp"""),
        "mann_whitney": _with([*_TIMING_CTES, _TESTED], _rank_sums("metric", "tested")),
        "mann_whitney_small": _small_samples(),
        "mann_whitney_by_step": _with([*_LOG_CTES, _QUIET_STEPS], _rank_sums("step", "quiet")),
        "welch_t": _with([*_TIMING_CTES, _TESTED], _welch(4)),
        "overhead_tests": _with([*_TIMING_CTES, _TESTED], f"""
select metric, round(u, 4) as u, round({_normal_share('z')}, 6) as p_u, round(t, 4) as t, round(df, 4) as df,
  round({_student_share('t', 'df')}, 6) as p_t
from ({_rank_sums('metric', 'tested', 15)}) join ({_welch(15)}) using (metric)"""),
        "spearman_trend": _with([*_LOG_CTES, _QUIET_STEPS], _correlations(6)),
        "trend_tests": _with([*_LOG_CTES, _QUIET_STEPS], f"""
select grp, step, n, round(rho, 6) as rho, round({_student_share('t', '(n - 2)')}, 6) as p
from (select *, rho * sqrt((n - 2) / (1 - rho * rho)) as t from ({_correlations(15)}))"""),
        "trend_first_last": _with([*_LOG_CTES, _QUIET_STEPS], """
select grp, step, round(avg(ms) filter (early <= 10), 4) as first_mean_ms, round(avg(ms) filter (late <= 10), 4)
  as last_mean_ms
from (select *, row_number() over (partition by grp, step order by iteration, trial_id) as early,
    row_number() over (partition by grp, step order by iteration desc, trial_id desc) as late
  from quiet where step in ('total', 'insert_rows')) group by grp, step"""),
        "retry_sequences": _with(
            [_STEPS, _RETRIES], "select try1_at, try2_at, try3_at, connected_at, recovery_ms from retries"
        ),
        "outage_timeline": _with(_OUTAGE_CTES, "select * exclude (load_id) from sequences"),
        "grown_log_outages": _with(_OUTAGE_CTES, "select * exclude (load_id) from sequences"),
        "outage_statistics": _with(_OUTAGE_CTES, """
select interval, count(*) as n, round(avg(s), 4) as mean_s, round(stddev_samp(s), 4) as stdev_s,
  round(min(s), 4) as min_s, round(max(s), 4) as max_s
from (select unnest(['shutdown_to_try1', 'try1_to_try2', 'try2_to_try3', 'try3_to_connected', 'outage',
    'ready_to_try3', 'recovery']) as interval, unnest([epoch(try1_at - shutdown_at), epoch(try2_at - try1_at),
    epoch(try3_at - try2_at), epoch(connected_at - try3_at), epoch(ready_at - shutdown_at), epoch(try3_at - ready_at),
    recovery_ms / 1000]) as s from sequences) group by interval"""),
        "connect_failures": _with([_STEPS], """
select count(*) as n, round(avg(ms), 4) as mean, round(stddev_samp(ms), 4) as stdev, min(ms) as min, max(ms) as max,
  median(ms) as median
from (select cast(regexp_extract(message, 'in ([0-9]+) ms', 1) as bigint) as ms from steps where message like 'Connection failed%')"""),
        "mask_address_labels": _with(_LABEL_CTES, """
select cast(line_no as bigint) as line_no, s.label as street, coalesce(c.label, r.complement) as complement,
  d.label as district
from raw r join street_labels s on s.street = r.street join district_labels d on d.district = r.district
left join complement_labels c on c.complement = r.complement"""),
        "mask_postal_code": _with([_RAW], """
select cast(line_no as bigint) as line_no, r.municipality, p.prefix || '-000' as postal_code
from raw r join (select distinct on (municipality) municipality, substring(postal_code, 1, 5) as prefix from raw
  group by municipality, prefix order by municipality, count(*) desc, prefix) p on p.municipality = r.municipality"""),
        "mask_coordinates": _with(
            [_RAW],
            f"select cast(line_no as bigint) as line_no, {_coordinate('latitude')}, {_coordinate('longitude')} from raw",
        ),
        "mask_identifiers": _with([_RAW], _MASKED_IDS),
        "mask_house_number": _with([_RAW, *_HOUSE_CTES], """
select cast(line_no as bigint) as line_no, coalesce(m.masked, r.house_number) as house_number
from raw r left join house_map m on m.house_number = r.house_number"""),
        "mask_extract": _with([*_LABEL_CTES, *_HOUSE_CTES], f"""
select cast(r.line_no as bigint) as line_no, s.label as street, coalesce(m.masked, r.house_number) as house_number,
  coalesce(c.label, r.complement) as complement, p.prefix || '-000' as postal_code, d.label as district,
  {_coordinate('latitude')}, {_coordinate('longitude')}, i.installation, i.contract_account, i.bill_number,
  i.print_document
from raw r left join street_labels s on s.street = r.street left join district_labels d on d.district = r.district
left join complement_labels c on c.complement = r.complement
left join house_map m on m.house_number = r.house_number
left join (select distinct on (municipality) municipality as place, substring(postal_code, 1, 5) as prefix from raw
  where postal_code is not null group by municipality, prefix order by municipality, count(*) desc, prefix) p
  on p.place is not distinct from r.municipality
join ({_MASKED_IDS}) i on i.line_no = cast(r.line_no as bigint)"""),
        "mask_equality_audit": _with([_RAW], " union all ".join(
            f"select '{c}' as name, count(distinct {c}) as n_old, count(distinct {c}) as n_new,"
            f" count(distinct {c}) as n_pairs, true as preserved from raw"
            for c in ("street", "complement", "district", "house_number")
        )),
    }
    return found | {f"{name}_by_partials": found[name] for name in BY_PARTIALS}
