"""Every operator as a query over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumenlake import contract
from lumenlake.contract import ENGLISH_TERMS
from lumenlake.functions import parsing
from lumenlake.operators.keys import insert_if_absent
from lumenlake.plans import bronze, gold, logs, masking, reliability, silver
from lumenlake.registry.relations import DATES, DECIMALS, Relations
from lumenlake.sources import extract, logtext
from lumenlake.sources.derived import BROKEN_TEXT, MONTH_HEADER, QUOTED_TEXT, SPECIAL_TEXT, UNFINISHED_TEXT

Query = Callable[[Relations], DataFrame]
_QUERIES: dict[str, Query] = {}

QUOTED_SPLIT = 1 << 20
MASK_KEY = "mask-2026"
SKETCH_ERROR = 0.05
INSERT_SPLIT_MONTH = "199601"


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def _rounded(rows: DataFrame, digits: int, *names: str) -> DataFrame:
    return rows.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


# --- raw layer ---------------------------------------------------------------


@_query
def scan_bills(r: Relations) -> DataFrame:
    return extract.scan_extract(r.spark, r.extract_path()).select(*contract.NAMES)


@_query
def scan_mixed_headers(r: Relations) -> DataFrame:
    """A folder in which one file has the columns in another order."""
    rows = r.numbered([c for c in contract.NAMES if c != "line_no"])
    even = F.col("line_no") % 2 == 0

    def write(path: str) -> None:
        extract.write_extract(rows.where(even), f"{path}/forwards")
        extract.write_extract(rows.where(~even), f"{path}/backwards", backwards=True)

    return extract.scan_extract(r.spark, r.workspace.files("mixed_extract", write) + "/*").select(*contract.NAMES)


@_query
def scan_quoted_breaks(r: Relations) -> DataFrame:
    """Line breaks inside quoted fields, in files that are cut into many splits."""
    path = r.workspace.files("quoted_extract", lambda path: extract.write_extract(r.raw(changed=QUOTED_TEXT), path))

    with extract.split_size(r.spark, QUOTED_SPLIT), extract.pinned_splits(r.spark):
        scan = lambda: extract.scan_extract(r.spark, path, multiline=True).select(*contract.NAMES)
        return r.workspace.table("quoted_rows", scan)


@_query
def header_contract_report(r: Relations) -> DataFrame:
    """One file a month, whose header has a column renamed, too few or too many by the month."""
    names = [c for c in contract.NAMES if c != "billing_month"]
    rows = r.raw(["billing_month", *names[:3]])

    def write(path: str) -> None:
        headers = rows.select("billing_month").distinct().select("billing_month", F.lit(0).alias("kind"), F.expr(MONTH_HEADER).alias("line"))
        lines = headers.unionByName(rows.select("billing_month", F.lit(1).alias("kind"), F.concat_ws(";", *names[:3]).alias("line")))
        placed = lines.repartition("billing_month").sortWithinPartitions("billing_month", "kind")
        placed.select("billing_month", "line").write.mode("overwrite").partitionBy("billing_month").text(path)

    path = r.workspace.files("monthly_headers", write)
    month = F.regexp_extract("path", "billing_month=(\\d+)", 1)
    headers = extract.read_headers(r.spark, path).table.select(month.alias("file"), "header")
    sizes = rows.groupBy(F.col("billing_month").alias("file")).agg(F.count("*").alias("n_rows"))
    report = extract.header_report(headers).join(sizes, "file")
    return report.select(
        "file",
        "valid",
        F.array_join("missing", ",").alias("missing"),
        F.array_join("extra", ",").alias("extra"),
        "message",
        "n_rows",
    )


@_query
def parse_dates(r: Relations) -> DataFrame:
    rows = r.numbered(DATES)
    return rows.select("line_no", *(parsing.parse_date(F.col(c)).alias(c) for c in DATES))


@_query
def parse_decimals(r: Relations) -> DataFrame:
    rows = r.numbered(DECIMALS)
    declared = {c.name: c.declared for c in contract.COLUMNS}
    return rows.select("line_no", *(parsing.parse_decimal(F.col(c), declared[c]).alias(c) for c in DECIMALS))


@_query
def special_numbers(r: Relations) -> DataFrame:
    """Not-a-number, infinities and numbers beyond all bounds are null."""
    rows = r.raw(["line_no", "bill_amount"], changed=SPECIAL_TEXT)
    amount = parsing.parse_decimal(F.col("bill_amount"), "decimal(18,2)")
    return rows.select(parsing.parse_int(F.col("line_no"), "bigint").alias("line_no"), amount.cast("double").alias("bill_amount"))


@_query
def history_lineage(r: Relations) -> DataFrame:
    """The history of two loads, one of them repeated: each row once, with its load, file and time."""
    rows = r.lake().history()
    named = F.col("file_name").rlike("^part-[^/]+\\.csv$")
    return rows.select("load_id", "line_no", "bill_number", named.alias("file_named"), F.col("loaded_at").isNotNull().alias("timed"))


@_query
def parse_ints(r: Relations) -> DataFrame:
    rows = r.raw(["bill_number", "line_no", "cycle_days"])
    return rows.select(
        "bill_number",
        parsing.parse_int(F.col("line_no"), "bigint").alias("line_no"),
        parsing.parse_int(F.col("cycle_days")).alias("cycle_days"),
    )


@_query
def bills_typed(r: Relations) -> DataFrame:
    return r.checked().select(*contract.NAMES)


@_query
def valid_rows(r: Relations) -> DataFrame:
    return r.valid().select("line_no", "bill_number", "municipality", "consumption_class", "due_on", "bill_amount")


@_query
def required_null_fields(r: Relations) -> DataFrame:
    return r.checked().where("missing <> ''").select("line_no", "missing")


@_query
def constraint_violations(r: Relations) -> DataFrame:
    """Rows the raw table could not hold, from an extract with damaged values.

    Checked rows are written before they are filtered: a filter would move
    into the wide projection and evaluate it twice.
    """
    text = r.raw(changed=BROKEN_TEXT)
    faults = lambda: bronze.type_columns(text).select("bill_number", "missing", "violations")
    return r.workspace.table("broken_faults", faults).where("violations <> ''")


@_query
def quarantine_rows(r: Relations) -> DataFrame:
    rejected = bronze.rejected_rows(r.checked())
    field = lambda header: F.get_json_object("payload", f"$.{header}")
    return rejected.select(
        "line_no",
        "reason",
        field("NOME").alias("customer_name"),
        field("DATA_VENCIMENTO_ORIGINAL").alias("due_on"),
        field("COMPLEMENTO").alias("complement"),
        F.size(F.json_object_keys("payload")).alias("n_fields"),
    )


@_query
def load_control_rows(r: Relations) -> DataFrame:
    """Control rows of one load per billing month, in both modes."""
    summary = bronze.totals(r.checked(), ["billing_month"])
    no = F.lit(False)
    modes = [
        bronze.outcome(summary, no, no, no, healing, ENGLISH_TERMS).withColumn("self_healing", F.lit(healing))
        for healing in (True, False)
    ]
    return modes[0].unionByName(modes[1])


@_query
def fail_fast_report(r: Relations) -> DataFrame:
    return bronze.first_fault(r.checked())


@_query
def load_outcome_class(r: Relations) -> DataFrame:
    summary = r.loads().select(
        "load_id",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        "n_quarantined",
        (F.col("attempts") > 1).alias("recovered"),
        F.col("file_name").startswith("Sample_Backup").alias("fallback"),
        (F.col("mechanism") == ENGLISH_TERMS.schema_check).alias("bad_header"),
    )
    flags = [F.col(c) for c in ("recovered", "fallback", "bad_header")]
    return bronze.outcome(summary, *flags, True, ENGLISH_TERMS).select(
        "load_id", "fault_type", "mechanism", "status", "auto_resolved"
    )


@_query
def load_outcome_of_many_faults(r: Relations) -> DataFrame:
    """Loads with any combination of faults, in both modes: the first is the type, mechanisms are joined."""
    load = F.col("load_id")
    summary = r.loads().select(
        "load_id",
        F.when(load % 4 == 0, 0).otherwise(load % 100).cast("long").alias("n_rows"),
        (load % 3).cast("long").alias("n_quarantined"),
    )
    flags = [load % 5 == 0, load % 7 == 0, load % 11 == 0]
    modes = [
        bronze.outcome(summary, *flags, healing, ENGLISH_TERMS).withColumn("self_healing", F.lit(healing))
        for healing in (True, False)
    ]
    return modes[0].unionByName(modes[1])


@_query
def history_load_bounds(r: Relations) -> DataFrame:
    history = r.valid().select(
        F.col("billing_month").alias("load_id"), F.col("due_on").cast("timestamp_ntz").alias("loaded_at")
    )
    return reliability.history_load_bounds(history)


# --- normalised layer --------------------------------------------------------


@_query
def seed_domains(r: Relations) -> DataFrame:
    """Each domain entry with the number of valid rows that use it."""
    pair = ["consumption_class", "consumption_subclass"]
    used = r.valid().groupBy(*pair, "commercial_status").agg(F.count("*").alias("_n"))
    by_pair = used.groupBy(*pair).agg(F.sum("_n").alias("n_rows"))
    by_status = used.groupBy(F.col("commercial_status").alias("code")).agg(F.sum("_n").alias("n_rows"))
    pairs = silver.subclass_domain(r.spark).join(by_pair, pair, "left").select(
        F.lit("subclass").alias("domain"), F.col(pair[0]).alias("code"), F.col(pair[1]).alias("description"), "n_rows"
    )
    others = silver.fixed_domains(r.spark).join(
        by_status.withColumn("domain", F.lit("commercial_status")), ["domain", "code"], "left"
    )
    return pairs.unionByName(others).withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def _silver(name: str, *columns: str) -> None:
    def build(r: Relations) -> DataFrame:
        table = r.silver(name)
        return table.select(*columns) if columns else table

    _QUERIES[name] = build


for _name in (
    "commercial_status", "bill_status", "tariff_categories", "municipalities", "regulatory_profiles", "addresses",
    "customers", "customers_person", "customers_company", "installations",
):
    _silver(_name)
_silver("bills", *silver.BILL)
_silver("payments", "bill_number", "paid_on", "payment_channel", "paid_amount")
_silver("taxes", "bill_number", "tax_pis", "tax_cofins", "tax_icms")
_silver("reading_cycles", "bill_number", "cycle_start", "cycle_end", "cycle_days")
_silver("rebills", "bill_number", "new_bill_number", "rebilled_on", "substitute_amount", "substitute_levy")
_silver("levies", "bill_number", "levy")


def _insert_if_absent(r: Relations) -> DataFrame:
    """Addresses that rows from the split month on add to those seen before it."""
    rows = r.valid()
    target = silver.addresses(rows.where(F.col("billing_month") < INSERT_SPLIT_MONTH))
    incoming = rows.where(F.col("billing_month") >= INSERT_SPLIT_MONTH).select(
        "line_no", *silver.ADDRESS_KEY, "district", "municipality"
    )
    return insert_if_absent(target, incoming, silver.ADDRESS_KEY).drop("line_no")


_QUERIES["insert_if_absent"] = _insert_if_absent


@_query
def unmatched_rows(r: Relations) -> DataFrame:
    return silver.unmatched_rows(r.valid(), r.silver("installations"))


def _with_gaps(r: Relations) -> DataFrame:
    """Every row with an installation of its own, some without a value that a lookup needs."""
    rows = r.valid()
    gap = lambda c, n: F.when(F.col("line_no") % n != 0, F.col(c))
    known = F.when(F.col("line_no") % 11 != 0, F.col("consumption_class")).otherwise("Unlisted")
    own = F.when(F.col("line_no") % 29 != 0, F.concat_ws("-", "installation", "line_no"))
    gaps = {"commercial_status": 13, "municipality": 17, "street": 19, "tariff_category": 23, "phase": 31}
    return rows.withColumns({c: gap(c, n) for c, n in gaps.items()} | {"consumption_class": known, "installation": own})


@_query
def unmatched_rows_with_gaps(r: Relations) -> DataFrame:
    rows = _with_gaps(r)
    return silver.unmatched_rows(rows, silver.installations(rows))


@_query
def unmatched_lookups_with_gaps(r: Relations) -> DataFrame:
    """The same rows with every lookup that fails."""
    rows = _with_gaps(r)
    return silver.unmatched_rows(rows, silver.installations(rows), every=True)


@_query
def null_in_required_fact(r: Relations) -> DataFrame:
    """Payments and rebills that the normalised tables leave out, from rows with lost amounts and dates."""
    text = r.raw(changed=UNFINISHED_TEXT)
    facts = ["line_no", "bill_number", "paid_on", "paid_amount", "rebilled", "rebilled_on"]
    typed = r.workspace.table("unfinished", lambda: bronze.type_columns(text).select(*facts))
    return silver.null_in_required_fact(typed)


@_query
def preview_table(r: Relations) -> DataFrame:
    """The first hundred bills by all their columns."""
    return r.silver("bills").select(*silver.BILL).orderBy(*silver.BILL).limit(100)


# --- served layer ------------------------------------------------------------


@_query
def levy_customers_sketched(r: Relations) -> DataFrame:
    """Distinct customers per class over all months: exact, and whether the merged monthly sketches come near."""
    base = r.base()
    sketches = r.workspace.table("customer_sketches", lambda: gold.customer_sketches(base, ["consumption_class"]))
    merged = gold.merged_customers(sketches, ["consumption_class"])
    exact = base.groupBy("consumption_class").agg(F.count_distinct("customer_name", "customer_type").alias("n_customers"))
    near = F.abs(F.col("n_customers_estimate") - F.col("n_customers")) <= SKETCH_ERROR * F.col("n_customers")
    return exact.join(merged, exact["consumption_class"].eqNullSafe(merged["consumption_class"])).select(
        exact["consumption_class"], "n_customers", near.alias("sketch_is_near")
    )


@_query
def levy_base(r: Relations) -> DataFrame:
    return r.base().drop("bill_id")


def _view(name: str) -> None:
    _QUERIES[name] = lambda r: gold.VIEWS[name](r.base())


for _name in gold.VIEWS:
    _view(_name)

# Views over partials of three loads; each has the oracle of the view.
BY_PARTIALS = [
    "consumption_by_subclass", "bill_average_by_district", "levy_collected_by_municipality", "levy_ticket_by_class",
    "levy_loss_by_district", "district_ranking",
]


def _partial_view(name: str) -> None:
    _QUERIES[f"{name}_by_partials"] = lambda r: r.partials().view(name)


for _name in BY_PARTIALS:
    _partial_view(_name)


# --- reliability -------------------------------------------------------------


@_query
def trial_load_join(r: Relations) -> DataFrame:
    return r.control_extract()


@_query
def success_rate(r: Relations) -> DataFrame:
    return reliability.success_rate(r.trials())


@_query
def fault_pivot(r: Relations) -> DataFrame:
    return reliability.fault_pivot(r.trials(), ENGLISH_TERMS)


@_query
def runs_by_state(r: Relations) -> DataFrame:
    return reliability.runs_by_state(r.trials())


@_query
def mechanism_activations(r: Relations) -> DataFrame:
    return reliability.mechanism_activations(r.trials(), r.loads())


def _trial_query(name: str) -> None:
    _QUERIES[name] = lambda r: getattr(reliability, name)(r.trials(), r.loads(), ENGLISH_TERMS)


for _name in (
    "mttr_by_fault", "mttr_detail", "auto_resolved_pct", "overhead_by_group", "time_to_failure", "quarantine_yield",
):
    _trial_query(_name)


@_query
def quarantine_by_reason(r: Relations) -> DataFrame:
    held = r.checked().where("not is_valid").select("reason", (F.col("line_no") % 1000 + 1).alias("load_id"))
    return reliability.quarantine_by_reason(held, r.trials(), ENGLISH_TERMS)


@_query
def duration_summary(r: Relations) -> DataFrame:
    return _rounded(reliability.duration_summary(r.trials(), r.loads()), 4, "mean", "stdev")


@_query
def recovery_summary(r: Relations) -> DataFrame:
    return _rounded(reliability.recovery_summary(r.trials(), r.loads()), 4, "mean", "stdev")


@_query
def trial_load_asof(r: Relations) -> DataFrame:
    return reliability.trial_load_asof(r.trials(), r.loads())


@_query
def overlapping_runs(r: Relations) -> DataFrame:
    return reliability.overlapping_runs(r.runs())


# --- logs --------------------------------------------------------------------


@_query
def log_lines(r: Relations) -> DataFrame:
    parsed = logtext.parse_lines(logtext.scan_log(r.spark, r.log_path()))
    return parsed.select("ts", "origin", "message")


@_query
def log_landmarks(r: Relations) -> DataFrame:
    return r.landmarks()


@_query
def load_timings(r: Relations) -> DataFrame:
    return r.timings()


@_query
def timing_summary(r: Relations) -> DataFrame:
    return _rounded(r.timing_summary(), 4, "mean", "stdev")


@_query
def overhead_summary(r: Relations) -> DataFrame:
    rows = logs.overhead_summary(r.timing_summary(), ENGLISH_TERMS)
    return _rounded(rows, 4, *[c for c in rows.columns if c != "metric"])


@_query
def overhead_by_step(r: Relations) -> DataFrame:
    return _rounded(logs.overhead_by_step(r.landmarks(), r.trials(), ENGLISH_TERMS), 4, "mean_ms", "stdev_ms")


@_query
def mann_whitney(r: Relations) -> DataFrame:
    return _rounded(logs.mann_whitney(r.timings(), ENGLISH_TERMS).drop("tied"), 4, "u", "z")


@_query
def mann_whitney_small(r: Relations) -> DataFrame:
    """Samples of one iteration: the exact tail beside the normal one."""
    rows = logs.mann_whitney_by_iteration(r.timings(), ENGLISH_TERMS).where("n_first between 2 and 8 and n_second between 2 and 8")
    return _rounded(rows.drop("z"), 6, "u", "p_exact", "p_normal", "p")


@_query
def mann_whitney_by_step(r: Relations) -> DataFrame:
    return _rounded(logs.mann_whitney_by_step(r.landmarks(), r.trials(), ENGLISH_TERMS).drop("tied"), 4, "u", "z")


@_query
def welch_t(r: Relations) -> DataFrame:
    return _rounded(logs.welch_t(r.timings(), ENGLISH_TERMS), 4, "t", "df")


@_query
def spearman_trend(r: Relations) -> DataFrame:
    return _rounded(logs.spearman_trend(r.landmarks(), r.trials(), ENGLISH_TERMS), 6, "rho")


@_query
def overhead_tests(r: Relations) -> DataFrame:
    rows = _rounded(logs.overhead_tests(r.timings(), ENGLISH_TERMS), 4, "u", "t", "df")
    return _rounded(rows, 6, "p_u", "p_t")


@_query
def trend_tests(r: Relations) -> DataFrame:
    return _rounded(logs.trend_tests(r.landmarks(), r.trials(), ENGLISH_TERMS), 6, "rho", "p")


@_query
def trend_first_last(r: Relations) -> DataFrame:
    rows = logs.trend_first_last(r.landmarks(), r.trials(), ENGLISH_TERMS)
    return _rounded(rows, 4, "first_mean_ms", "last_mean_ms")


@_query
def retry_sequences(r: Relations) -> DataFrame:
    return r.retry_sequences()


@_query
def grown_log_landmarks(r: Relations) -> DataFrame:
    """The log came in three stretches, each of which was parsed alone."""
    return r.grown_log().landmarks()


@_query
def grown_log_outages(r: Relations) -> DataFrame:
    store = r.grown_log()
    return logs.outage_timeline(store.events(), store.retry_sequences())


@_query
def outage_timeline(r: Relations) -> DataFrame:
    return r.outages()


@_query
def outage_statistics(r: Relations) -> DataFrame:
    return _rounded(logs.outage_statistics(r.outages()), 4, "mean_s", "stdev_s", "min_s", "max_s")


@_query
def connect_failures(r: Relations) -> DataFrame:
    return _rounded(logs.connect_failures(r.log_events()), 4, "mean", "stdev")


# --- masking -----------------------------------------------------------------


@_query
def mask_address_labels(r: Relations) -> DataFrame:
    return masking.address_labels(r.numbered(["street", "complement", "district"]), r.workspace)


@_query
def mask_house_number(r: Relations) -> DataFrame:
    return masking.house_numbers(r.numbered(["house_number"]), r.workspace)


@_query
def mask_postal_code(r: Relations) -> DataFrame:
    return masking.postal_codes(r.numbered(["municipality", "postal_code"]), r.workspace)


@_query
def mask_coordinates(r: Relations) -> DataFrame:
    return masking.coordinates(r.numbered(["latitude", "longitude"]))


@_query
def mask_identifiers(r: Relations) -> DataFrame:
    names = ["billing_month", "installation", "contract_account", "bill_number", "print_document"]
    return masking.identifiers(r.numbered(names)).drop("billing_month")


@_query
def mask_keyed(r: Relations) -> DataFrame:
    """Identifiers under a keyed permutation of their digits."""
    return masking.keyed_identifiers(r.numbered(masking.KEYED_COLUMNS), MASK_KEY)


@_query
def mask_extract(r: Relations) -> DataFrame:
    """Every masked column of the extract."""
    names = {c.header: c.name for c in contract.COLUMNS}
    masked = [names[h] for h in masking.MASKED_HEADERS]
    helpers = [names[h] for h in masking.HELPER_HEADERS]
    return masking.mask(r.numbered([*masked, *helpers]), r.workspace).select("line_no", *masked)


@_query
def mask_equality_audit(r: Relations) -> DataFrame:
    before = r.numbered(masking.EQUALITY_COLUMNS)
    after = masking.house_numbers(masking.address_labels(before, r.workspace), r.workspace)
    return masking.equality_audit(before, after)


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, so both engines show the same types."""
    columns = []
    for field in rows.schema:
        kind = field.dataType.typeName()
        column = F.col(field.name)
        if kind == "decimal":
            column = column.cast("double").alias(field.name)
        elif kind == "date":
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return rows.select(*columns)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query):
        return lambda spark, sf_dir: plain(build(Relations.sized(spark, sf_dir)))

    return {name: bind(build) for name, build in _QUERIES.items()}
