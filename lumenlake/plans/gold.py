"""Serving layer: one enriched base relation and thirteen aggregate views.

Every view takes the base and an optional filter on its columns; filters on
group keys move below the aggregate on their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenlake.functions.money import MONEY, mean_money, prorate
from lumenlake.functions.parsing import month_start
from lumenlake.operators.skew import join_many
from lumenlake.plans.silver import ADDRESS_KEY


def levy_base(
    bills: DataFrame, installations: DataFrame, addresses: DataFrame, levies: DataFrame, payments: DataFrame
) -> DataFrame:
    """One row per bill and levy, with place, class, and billed and collected levy.

    Levies and payments hang on the bill id; payments are totalled first so
    that they do not multiply rows, and levies may do so for a hot bill.
    Installation and address are joined to each other before the bills see
    them.  Adaptive execution splits a hot installation.
    """
    paid = payments.groupBy("bill_id").agg(F.sum("paid_amount").alias("_paid"))
    rows = join_many(bills.join(paid, "bill_id", "left"), levies.select("bill_id", "levy"), "bill_id")
    return priced(rows.join(places(installations, addresses), "installation"))


def places(installations: DataFrame, addresses: DataFrame) -> DataFrame:
    """(installation, consumption_class, consumption_subclass, district, municipality)."""
    return installations.select("installation", "consumption_class", "consumption_subclass", *ADDRESS_KEY).join(
        addresses.select(*ADDRESS_KEY, "district", "municipality"), ADDRESS_KEY, "left"
    ).drop(*ADDRESS_KEY)


def priced(rows: DataFrame, *more: str) -> DataFrame:
    """The columns of the base from bills with their place, ``levy`` and total ``_paid``; ``more`` pass through."""
    levy, total = F.coalesce("levy", F.lit(0)).cast(MONEY), F.coalesce("_paid", F.lit(0))
    return rows.select(
        "bill_id",
        "bill_number",
        "customer_name",
        "customer_type",
        "installation",
        "consumption_class",
        "consumption_subclass",
        "district",
        "municipality",
        "billing_month",
        "reference_month",
        month_start(F.col("billing_month")).alias("month"),
        "measured_kwh",
        "billed_kwh",
        "bill_amount",
        levy.alias("levy_billed"),
        total.cast(MONEY).alias("paid_total"),
        prorate(levy, total, F.col("bill_amount")).alias("levy_collected"),
        *more,
    )


def _grouped(base: DataFrame, keys: list[str], where: Column | None):
    rows = base if where is None else base.where(where)
    return rows.groupBy("month", *keys)


def _sum(column: str | Column) -> Column:
    return F.sum(column).cast(MONEY)


def _kwh(base, keys, where):
    return _grouped(base, keys, where).agg(_sum("measured_kwh").alias("kwh"))


def consumption_by_district(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _kwh(base, ["district"], where)


def consumption_by_municipality(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _kwh(base, ["municipality"], where)


def consumption_by_subclass(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _kwh(base, ["consumption_class", "consumption_subclass"], where)


def bill_average_by_district(base: DataFrame, where: Column | None = None) -> DataFrame:
    amounts = F.sum("bill_amount")
    return _grouped(base, ["district"], where).agg(
        F.count("*").alias("n_bills"),
        amounts.cast(MONEY).alias("total_amount"),
        mean_money(amounts, F.count("bill_amount")).alias("mean_amount"),
    )


def _collected(base, keys, where):
    return _grouped(base, keys, where).agg(_sum("levy_collected").alias("levy_collected"))


def levy_collected_by_class(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _collected(base, ["consumption_class"], where)


def levy_collected_by_subclass(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _collected(base, ["consumption_class", "consumption_subclass"], where)


def levy_collected_by_municipality(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _collected(base, ["municipality"], where)


def levy_billed_by_month(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _grouped(base, [], where).agg(_sum("levy_billed").alias("levy_billed"))


def _ticket(base, keys, where):
    """Billed levy per distinct customer.

    Totals per customer come first, so the distinct count is a plain count
    and no group is ever held in one place.
    """
    customer = ["customer_name", "customer_type"]
    each = _grouped(base, keys + customer, where).agg(F.sum("levy_billed").alias("_levy"))
    return (
        each.groupBy("month", *keys)
        .agg(F.count("*").alias("n_customers"), F.sum("_levy").alias("_total"))
        .select(
            "month",
            *keys,
            "n_customers",
            F.col("_total").cast(MONEY).alias("levy_billed"),
            mean_money(F.col("_total"), F.col("n_customers")).alias("levy_ticket"),
        )
    )


def levy_ticket_by_class(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _ticket(base, ["consumption_class"], where)


def levy_ticket_by_municipality(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _ticket(base, ["municipality"], where)


# About 0.8 % standard error: 1.04 / sqrt(2^14).
SKETCH_BITS = 14


def customer_sketches(base: DataFrame, keys: list[str]) -> DataFrame:
    """(month, *keys, customers): a mergeable sketch of the distinct customers, a few kB whatever their number."""
    customer = F.concat_ws(":", "customer_type", "customer_name")
    return base.groupBy("month", *keys).agg(F.hll_sketch_agg(customer, SKETCH_BITS).alias("customers"))


def merged_customers(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(*by, n_customers_estimate) over any set of months, from their sketches alone."""
    united = sketches.groupBy(*by).agg(F.hll_union_agg("customers").alias("_all"))
    return united.select(*by, F.hll_sketch_estimate("_all").alias("n_customers_estimate"))


def district_ranking(base: DataFrame, where: Column | None = None) -> DataFrame:
    """Districts by consumption within each month; an unknown consumption ranks first."""
    kwh = consumption_by_district(base, where)
    by_month = Window.partitionBy("month").orderBy(F.col("kwh").desc_nulls_first())
    return kwh.withColumn("position", F.rank().over(by_month))


def _loss(base, keys, where):
    lost = F.col("levy_billed") - F.col("levy_collected")
    return _grouped(base, keys, where).agg(_sum(lost).alias("levy_loss"))


def levy_loss_by_municipality(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _loss(base, ["municipality"], where)


def levy_loss_by_district(base: DataFrame, where: Column | None = None) -> DataFrame:
    return _loss(base, ["district"], where)


VIEWS = {
    view.__name__: view
    for view in (
        consumption_by_district, consumption_by_municipality, bill_average_by_district, levy_collected_by_class,
        levy_collected_by_subclass, levy_collected_by_municipality, levy_billed_by_month, levy_ticket_by_class,
        levy_ticket_by_municipality, consumption_by_subclass, district_ranking, levy_loss_by_municipality,
        levy_loss_by_district,
    )
}


def register_views(base: DataFrame) -> list[str]:
    """Create or replace the base and all views under their names."""
    base.createOrReplaceTempView("levy_base")
    for name, view in VIEWS.items():
        view(base).createOrReplaceTempView(name)
    return ["levy_base", *VIEWS]
