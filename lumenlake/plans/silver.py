"""Normalised layer: pure functions from valid raw rows to keyed tables.

Joins that cannot change the result are not run.  A dimension built from the
same rows contains every key those rows carry, so looking it up only drops
null keys: a filter says the same without a shuffle.  Joins remain where the
other side is a fixed domain (class and subclass), where the first row of a
key decides (address, installation), or where rows multiply (a customer name
used by a person and by a company).

Tables are keyed by natural keys.  A bill has none, so ``bill_id`` is a hash
of all its columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumenlake import contract
from lumenlake.functions import parsing
from lumenlake.operators.keys import first_wins

ADDRESS_KEY = ["street", "house_number", "complement", "postal_code"]
PROFILE_TEXT = ["reading_stage", "supply_group", "phase", "perimeter", "block_reason", "reading_calendar"]
PROFILE = [
    "reading_stage", "supply_group", "free_customer", "phase", "perimeter", "micro_generator", "irrigator",
    "block_reason", "reading_calendar", "tariff_category",
]
BILL = [
    "customer_name", "customer_type", "installation", "billing_month", "reference_month", "print_document",
    "bill_number", "cnr", "billed_kwh", "measured_kwh", "tariff", "price", "consumption_revenue", "flag_revenue",
    "bill_amount", "due_on", "bill_status", "cancelled",
]


def _present(*names: str) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & F.col(name).isNotNull()
    return test


# --- domains ---------------------------------------------------------------


def subclass_domain(spark: SparkSession) -> DataFrame:
    """(consumption_class, consumption_subclass): each class with its subclasses unfolded."""
    classes = spark.createDataFrame(list(contract.SUBCLASSES.items()), "consumption_class string, names array<string>")
    return classes.select("consumption_class", F.explode("names").alias("consumption_subclass"))


def fixed_domains(spark: SparkSession) -> DataFrame:
    """The remaining literal domains as (domain, code, description)."""
    rows = [("commercial_status", c, d) for c, d in contract.COMMERCIAL_STATUS]
    rows += [("entity_type", c, d) for c, d in contract.ENTITY_TYPES]
    rows += [("opinion_status", d, d) for d in contract.OPINION_STATUS]
    rows += [("customer_type", d, d) for d in (contract.PERSON, contract.COMPANY)]
    rows += [("distributor", contract.DISTRIBUTOR, contract.DISTRIBUTOR)]
    return spark.createDataFrame(rows, "domain string, code string, description string")


def commercial_status(raw: DataFrame) -> DataFrame:
    """Seeds, then unseen codes described by themselves."""
    seeds = raw.sparkSession.createDataFrame(contract.COMMERCIAL_STATUS, "code string, description string")
    seen = raw.where(_present("commercial_status")).select(F.col("commercial_status").alias("code")).distinct()
    unseen = seen.join(F.broadcast(seeds), "code", "left_anti")
    return seeds.unionByName(unseen.withColumn("description", F.col("code")))


def bill_status(raw: DataFrame) -> DataFrame:
    return raw.where(_present("bill_status")).select(F.col("bill_status").alias("description")).distinct()


def tariff_categories(raw: DataFrame) -> DataFrame:
    """Codes with a description that the extract does not carry."""
    codes = raw.where(_present("tariff_category")).select(F.col("tariff_category").alias("code")).distinct()
    return codes.withColumn("description", F.lit(None).cast("string"))


def municipalities(raw: DataFrame) -> DataFrame:
    """Names with the federative unit left null: the extract has none."""
    names = raw.where(_present("municipality")).select(F.col("municipality").alias("name")).distinct()
    return names.withColumn("state", F.lit(None).cast("string"))


def _with_profile_flags(raw: DataFrame) -> DataFrame:
    flags = ["free_customer", "micro_generator", "irrigator"]
    return raw.withColumns({c: parsing.is_yes_letter(F.col(c), contract.YES_LETTER) for c in flags})


def regulatory_profiles(raw: DataFrame) -> DataFrame:
    """Distinct ten-column profiles; the category is null when the row has none."""
    return _with_profile_flags(raw).select(*PROFILE).distinct()


# --- dimensions ------------------------------------------------------------


def addresses(raw: DataFrame) -> DataFrame:
    """First row per street, number, complement and postal code; keys with a null never collide."""
    columns = ADDRESS_KEY + ["district", "municipality", "latitude", "longitude"]
    rows = raw.where(_present("municipality", "street")).select("line_no", *columns)
    keyed = first_wins(rows.where(_present(*ADDRESS_KEY)), ADDRESS_KEY)
    open_keys = rows.where(~_present(*ADDRESS_KEY))
    return keyed.select(*columns).unionByName(open_keys.select(*columns).distinct())


def _customer_type() -> Column:
    has_person_id = F.coalesce(F.col("person_tax_id") != "", F.lit(False))
    return F.when(has_person_id, contract.PERSON).otherwise(contract.COMPANY)


def customers(raw: DataFrame) -> DataFrame:
    """Distinct (customer_name, customer_type); a name may have both types."""
    return raw.where(_present("customer_name")).select(
        "customer_name", _customer_type().alias("customer_type")
    ).distinct()


def _per_customer_id(raw: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """One customer per tax id: the first row's name, and of its types the first."""
    rows = raw.where(_present("customer_name", column) & (F.col(column) != ""))
    holders = first_wins(rows.select("line_no", column, "customer_name"), [column])
    types = known.groupBy("customer_name").agg(F.min("customer_type").alias("customer_type"))
    return holders.join(types, "customer_name").select("customer_name", "customer_type", column)


def customers_person(raw: DataFrame, known: DataFrame) -> DataFrame:
    return _per_customer_id(raw, known, "person_tax_id")


def customers_company(raw: DataFrame, known: DataFrame) -> DataFrame:
    return _per_customer_id(raw, known, "company_tax_id")


def _installable(raw: DataFrame) -> DataFrame:
    """Rows that reach every table an installation refers to.

    The 51 class and subclass pairs are a literal, so that broadcast is bounded.
    """
    keys = ["installation", "commercial_status", "municipality", "tariff_category", *ADDRESS_KEY, *PROFILE_TEXT]
    domain = F.broadcast(subclass_domain(raw.sparkSession))
    return raw.where(_present(*keys)).join(domain, ["consumption_class", "consumption_subclass"])


def installations(raw: DataFrame) -> DataFrame:
    """First complete row per installation code."""
    rows = _with_profile_flags(_installable(raw)).select(
        "line_no",
        "installation",
        "contract_account",
        "consumption_class",
        "consumption_subclass",
        "connected_on",
        "commercial_status",
        parsing.is_yes_word(F.col("contract_active"), contract.YES_WORDS).alias("contract_active"),
        *PROFILE,
        *ADDRESS_KEY,
        F.lit(contract.DISTRIBUTOR).alias("distributor"),
    )
    return first_wins(rows, ["installation"]).drop("line_no")


# --- facts -----------------------------------------------------------------


def bills(raw: DataFrame, known: DataFrame, installed: DataFrame) -> DataFrame:
    """Distinct bills of known installations, once per customer that has the name.

    Rows are made distinct on their raw values before the consumption is
    narrowed to two decimals.  Most names have a single type, which the row
    itself shows; the few with both are looked up and unfold the row.
    """
    both = known.groupBy("customer_name").agg(F.count("*").alias("_types")).where("_types > 1")
    rows = raw.where(_present("customer_name", "installation", "bill_status", "bill_number")).select(
        *(c for c in BILL if c not in ("customer_type", "cancelled")),
        _customer_type().alias("_own"),
        parsing.is_yes_word(F.col("cancelled"), contract.YES_WORDS).alias("cancelled"),
    )
    rows = rows.join(installed.select("installation"), "installation", "left_semi")
    rows = rows.join(both, "customer_name", "left")
    types = F.when(F.col("_types").isNull(), F.array("_own")).otherwise(
        F.array(F.lit(contract.PERSON), F.lit(contract.COMPANY))
    )
    whole = rows.withColumn("customer_type", F.explode(types)).select(*BILL).distinct()
    return whole.withColumn("bill_id", _row_id(BILL)).select(
        "bill_id",
        *(F.round(c, 2).cast("decimal(18,2)").alias(c) if c in ("billed_kwh", "measured_kwh") else c for c in BILL),
    )


def _row_id(names: list[str]) -> Column:
    """128 bits of a hash over all columns; nulls and blanks differ."""
    texts = (F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in names)
    return F.substring(F.sha2(F.concat_ws("\x1f", *texts), 256), 1, 32)


def _billed(billed: DataFrame, facts: DataFrame) -> DataFrame:
    """Attach per-number facts to every bill with that number, and its month to prune by."""
    return billed.select("bill_id", "bill_number", "billing_month").join(facts, "bill_number")


def payments(raw: DataFrame, billed: DataFrame) -> DataFrame:
    """First payment per bill and day."""
    rows = raw.where(_present("bill_number", "paid_on", "paid_amount"))
    firsts = first_wins(
        rows.select("line_no", "bill_number", "paid_on", "payment_channel", "paid_amount"), ["bill_number", "paid_on"]
    )
    return _billed(billed, firsts.drop("line_no"))


def taxes(raw: DataFrame, billed: DataFrame) -> DataFrame:
    rows = raw.where(_present("bill_number")).select("line_no", "bill_number", "tax_pis", "tax_cofins", "tax_icms")
    return _billed(billed, first_wins(rows, ["bill_number"]).drop("line_no"))


def reading_cycles(raw: DataFrame, billed: DataFrame) -> DataFrame:
    rows = raw.where(_present("bill_number", "cycle_start"))
    return _billed(billed, rows.select("bill_number", "cycle_start", "cycle_end", "cycle_days").distinct())


def rebills(raw: DataFrame, billed: DataFrame) -> DataFrame:
    """Rebilled rows; the extract names no new bill, so it is the original one."""
    flagged = parsing.is_yes_word(F.col("rebilled"), contract.YES_WORDS)
    rows = raw.where(_present("bill_number", "rebilled_on") & flagged)
    facts = rows.select("bill_number", "rebilled_on", "substitute_amount", "substitute_levy").distinct()
    return _billed(billed, facts).withColumn("new_bill_number", F.col("bill_number"))


def levies(raw: DataFrame, billed: DataFrame) -> DataFrame:
    rows = raw.where(_present("bill_number", "levy")).select("bill_number", "levy").distinct()
    return _billed(billed, rows)


# --- audits ----------------------------------------------------------------


def null_in_required_fact(raw: DataFrame) -> DataFrame:
    """Rows whose payment or rebill lacks a value those tables require."""
    flagged = parsing.is_yes_word(F.col("rebilled"), contract.YES_WORDS)
    fault = F.when(F.col("paid_on").isNotNull() & F.col("paid_amount").isNull(), "payment without amount").when(
        flagged & F.col("rebilled_on").isNull(), "rebill without date"
    )
    return raw.select("line_no", "bill_number", fault.alias("fault")).where("fault is not null")


def unmatched_rows(raw: DataFrame, installed: DataFrame, every: bool = False) -> DataFrame:
    """Valid rows that reach no bill, with the first lookup that lost them, or with all, joined by commas.

    A subclass is looked up in its class, so it is not named where the class is unknown.
    """
    domain = F.broadcast(subclass_domain(raw.sparkSession).withColumn("_pair", F.lit(True)))
    classes = list(contract.SUBCLASSES)
    rows = raw.join(installed.select("installation"), "installation", "left_anti").join(
        domain, ["consumption_class", "consumption_subclass"], "left"
    )
    known = F.coalesce(F.col("consumption_class").isin(classes), F.lit(False))
    lookups = {
        "consumption_class": ~known,
        "consumption_subclass": known & F.col("_pair").isNull(),
        "commercial_status": F.col("commercial_status").isNull(),
        "address": ~_present("municipality", *ADDRESS_KEY),
        "regulatory_profile": ~_present("tariff_category", *PROFILE_TEXT),
        "installation": F.col("installation").isNull(),
    }
    failed = [F.when(lost, name) for name, lost in lookups.items()]
    lost_by = F.coalesce(F.nullif(F.concat_ws(",", *failed), F.lit("")) if every else F.coalesce(*failed), F.lit("installation"))
    return rows.select("line_no", "bill_number", lost_by.alias("lost_by"))
