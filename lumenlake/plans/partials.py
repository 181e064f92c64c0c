"""Served views from partial aggregates that each load adds to.

A load changes the base rows of the bills it brings, levies or pays, and no
others.  Its partial is what these rows add to each group, less what they
added before, so groups are sums over the partials of all loads: the views
read no base rows, and a load reads its own rows and those of the bills it
touches.

Two tables hold the partials, one partition per addition::

    cube/generation=G/batch=N        rows, sums and counted values per month, class, subclass and place
    customers/generation=G/batch=N   rows and billed levy per month, class, municipality and customer
    added/generation=G/batch=N       the loads of batch N with their versions; written last, it releases the batch

Distinct customers are those whose rows do not add up to zero.  A load that
has been added and is normalised again cannot be told apart from the sums, so
it begins a new generation, which is built from all loads.

Defined results: a sum is null where no value was counted, as over base rows;
a group whose rows add up to zero is gone; null keys are groups; adding an
empty load, or a load that is already in, changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lumenlake.functions.money import MONEY, mean_money
from lumenlake.operators.skew import join_many
from lumenlake.plans import gold
from lumenlake.plans.workspace import written

SUMMED = ["measured_kwh", "bill_amount", "levy_billed", "levy_collected", "levy_loss"]
CUBE = ["month", "consumption_class", "consumption_subclass", "district", "municipality"]
CUSTOMERS = ["month", "consumption_class", "municipality", "customer_name", "customer_type"]
ADDED = "load_id bigint, version timestamp_ntz, generation bigint, batch bigint"


def touched_bills(tables: dict[str, DataFrame], fresh: list[int]) -> DataFrame:
    """(bill_id) of the bills that these loads brought, levied or paid."""
    ids = [tables[n].where(F.col("load_id").isin(fresh)).select("bill_id") for n in ("bills", "levies", "payments")]
    return ids[0].unionByName(ids[1]).unionByName(ids[2]).distinct()


def changes(tables: dict[str, DataFrame], fresh: list[int], earlier: list[int]) -> DataFrame:
    """Base rows of the touched bills with sign 1, and what they were without these loads with sign -1.

    ``tables`` are bills, installations, addresses, levies and payments; the
    three with bills carry ``load_id``.  Without earlier loads every bill is new.

    What a bill is now and what it was come from one pass: a flag tells the
    rows of earlier loads, and each bill knows both totals of its payments.
    A levy counts in what was when it is of an earlier load; a bill that had
    no levy then, but has one now, was a row of its own.
    """
    loaded = lambda name: tables[name].where(F.col("load_id").isin([*earlier, *fresh])).withColumn(
        "_old", F.col("load_id").isin(earlier)
    )
    if not earlier:
        of = lambda name: loaded(name).drop("load_id", "_old")
        now = gold.levy_base(of("bills"), tables["installations"], tables["addresses"], of("levies"), of("payments"))
        return now.withColumn("_sign", F.lit(1))
    levies = loaded("levies").select("bill_id", "levy", "_old")
    rows = join_many(_touched(loaded), levies.withColumnRenamed("_old", "_old_levy"), "bill_id", where=~F.col("_bare"))
    # Of each row: what it is now, what it was, or both.
    version = lambda paid, sign: F.struct(F.col(paid).alias("_paid"), F.lit(sign).alias("_sign"))
    was = F.col("_old") & (F.col("_bare") | F.when(F.col("_old_levies") > 0, F.coalesce("_old_levy", F.lit(False))).otherwise(F.col("_levies") == 0))
    versions = F.array_compact(F.array(F.when(~F.col("_bare"), version("_now", 1)), F.when(was, version("_before", -1))))
    rows = rows.withColumn("_version", F.explode(versions)).select("*", "_version.*")
    return gold.priced(rows.join(gold.places(tables["installations"], tables["addresses"]), "installation"), "_sign")


def _touched(loaded: Callable[[str], DataFrame]) -> DataFrame:
    """Touched bills with their totals now and before, and the numbers of their levies.

    A bill that had no levy, but has one now, comes twice: the second is
    marked ``_bare`` and is to find none.  Both stay where the totals were
    joined, so the levies meet them without another shuffle of the bills.
    """
    none = F.lit(None)
    paid = loaded("payments").select("bill_id", "_old", none.cast("int").alias("_levy"), "paid_amount")
    levied = loaded("levies").select("bill_id", "_old", F.lit(1).alias("_levy"), none.alias("paid_amount"))
    found = paid.unionByName(levied).groupBy("bill_id").agg(
        F.sum("paid_amount").alias("_now"),
        F.sum(F.when(F.col("_old"), F.col("paid_amount"))).alias("_before"),
        F.count("_levy").alias("_levies"),
        F.count(F.when(F.col("_old"), F.col("_levy"))).alias("_old_levies"),
        F.max(~F.col("_old")).alias("_fresh"),
    )
    bills = loaded("bills").where("bill_id is not null").drop("load_id").join(found, "bill_id", "left")
    bills = bills.where("not _old or _fresh").fillna(0, ["_levies", "_old_levies"])
    had_none = F.col("_old") & (F.col("_old_levies") == 0) & (F.col("_levies") > 0)
    bare = F.explode(F.when(had_none, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    return bills.withColumn("_bare", bare)


def cube(changed: DataFrame) -> DataFrame:
    """Per finest group: rows, and sum and number of counted values of every measure."""
    rows = changed.withColumn("levy_loss", F.col("levy_billed") - F.col("levy_collected"))
    sign = F.col("_sign")
    return rows.groupBy(*CUBE).agg(
        F.sum(sign).alias("n_rows"),
        *(F.sum(F.col(c) * sign).alias(c) for c in SUMMED),
        *(F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"n_{c}") for c in SUMMED),
    )


def customers(changed: DataFrame) -> DataFrame:
    """Per customer: rows and billed levy, so that distinct customers can be counted and taken back."""
    sign = F.col("_sign")
    return changed.groupBy(*CUSTOMERS).agg(
        F.sum(sign).alias("n_rows"), F.sum(F.col("levy_billed") * sign).alias("levy_billed")
    )


class Partials:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def added(self) -> DataFrame:
        """(load_id, version, generation, batch) of the latest generation."""
        try:
            every = self.spark.read.schema(ADDED).parquet(f"{self.root}/added")
        except AnalysisException:
            return self.spark.createDataFrame([], ADDED)
        return every.where(F.col("generation") == every.agg(F.max("generation")).first()[0])

    def add(self, read: Callable[[list[int], list[int]], dict[str, DataFrame]], versions: dict[int, object]) -> list[int]:
        """Add the loads that are not in yet; returns them, or all where one in it has another version.

        ``versions`` are the normalised loads with what changes when one is
        normalised again; ``read`` gives the tables for (fresh, earlier) loads.
        """
        known = {row["load_id"]: row for row in self.added().collect()}
        generation = max((row["generation"] for row in known.values()), default=0)
        batch = max((row["batch"] for row in known.values()), default=-1) + 1
        if any(n not in versions or versions[n] != row["version"] for n, row in known.items()):
            known, generation, batch = {}, generation + 1, 0
        fresh, earlier = sorted(set(versions) - set(known)), sorted(known)
        if fresh:
            tables = read(fresh, earlier)
            changed = changes(tables, fresh, earlier).select(*dict.fromkeys(CUBE + CUSTOMERS), *SUMMED[:-1], "_sign")
            changed = written(changed, "changed-rows")
            for name, made in (("cube", cube), ("customers", customers)):
                made(changed).write.mode("overwrite").parquet(self._path(name, generation, batch))
            rows = self.spark.createDataFrame([(n, versions[n]) for n in fresh], "load_id bigint, version timestamp_ntz")
            rows.coalesce(1).write.mode("overwrite").parquet(self._path("added", generation, batch))
        return fresh

    def _path(self, name: str, generation: int, batch: int) -> str:
        return f"{self.root}/{name}/generation={generation}/batch={batch}"

    def _read(self, name: str) -> DataFrame:
        last = self.added().agg(F.max("generation").alias("g"), F.max("batch").alias("b")).first()
        if last["g"] is None:
            raise ValueError("no load has been added")
        released = (F.col("generation") == last["g"]) & (F.col("batch") <= last["b"])
        return self.spark.read.parquet(f"{self.root}/{name}").where(released)

    # --- views --------------------------------------------------------------

    def view(self, name: str) -> DataFrame:
        """The view of that name in ``gold.VIEWS``, from the partials alone."""
        keys, columns = VIEWS[name]
        if columns is _ticket:
            each = self._read("customers").groupBy("month", *keys, "customer_name", "customer_type").agg(
                F.sum("n_rows").alias("_rows"), F.sum("levy_billed").alias("_levy")
            )
            merged = each.where("_rows <> 0").groupBy("month", *keys).agg(
                F.count("*").alias("n_customers"), F.sum("_levy").alias("_total")
            )
            return merged.select("month", *keys, *columns())
        sums = [F.sum(c).alias(c) for c in ("n_rows", *SUMMED, *(f"n_{c}" for c in SUMMED))]
        merged = self._read("cube").groupBy("month", *keys).agg(*sums).where("n_rows <> 0")
        found = merged.select("month", *keys, *columns())
        if name == "district_ranking":
            by_month = Window.partitionBy("month").orderBy(F.col("kwh").desc_nulls_first())
            found = found.withColumn("position", F.rank().over(by_month))
        return found

    def register_views(self) -> list[str]:
        for name in VIEWS:
            self.view(name).createOrReplaceTempView(name)
        return list(VIEWS)


def _counted(name: str):
    return F.when(F.col(f"n_{name}") != 0, F.col(name))


def _sum_of(name: str, alias: str | None = None):
    return lambda: [_counted(name).cast(MONEY).alias(alias or name)]


def _bills():
    mean = mean_money(_counted("bill_amount"), F.col("n_bill_amount"))
    return [
        F.col("n_rows").alias("n_bills"), _counted("bill_amount").cast(MONEY).alias("total_amount"), mean.alias("mean_amount"),
    ]


def _ticket():
    mean = mean_money(F.col("_total"), F.col("n_customers"))
    return [F.col("n_customers"), F.col("_total").cast(MONEY).alias("levy_billed"), mean.alias("levy_ticket")]


_KWH = _sum_of("measured_kwh", "kwh")
_SUBCLASS = ["consumption_class", "consumption_subclass"]
# Keys and columns of each view.
VIEWS = {
    "consumption_by_district": (["district"], _KWH),
    "consumption_by_municipality": (["municipality"], _KWH),
    "consumption_by_subclass": (_SUBCLASS, _KWH),
    "district_ranking": (["district"], _KWH),
    "bill_average_by_district": (["district"], _bills),
    "levy_collected_by_class": (["consumption_class"], _sum_of("levy_collected")),
    "levy_collected_by_subclass": (_SUBCLASS, _sum_of("levy_collected")),
    "levy_collected_by_municipality": (["municipality"], _sum_of("levy_collected")),
    "levy_billed_by_month": ([], _sum_of("levy_billed")),
    "levy_ticket_by_class": (["consumption_class"], _ticket),
    "levy_ticket_by_municipality": (["municipality"], _ticket),
    "levy_loss_by_municipality": (["municipality"], _sum_of("levy_loss")),
    "levy_loss_by_district": (["district"], _sum_of("levy_loss")),
}
