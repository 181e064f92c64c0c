"""The relations that registered queries start from, built from the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumenlake import contract, session
from lumenlake.contract import ENGLISH_TERMS
from lumenlake.plans import bronze, gold, logs, silver
from lumenlake.plans.lake import Lake
from lumenlake.plans.logstore import LogStore
from lumenlake.plans.partials import Partials
from lumenlake.plans.workspace import Workspace
from lumenlake.sources import derived, extract, logtext

# How each normalised table follows from the valid rows and earlier tables.
_SILVER = {
    "commercial_status": lambda r: silver.commercial_status(r.valid()),
    "bill_status": lambda r: silver.bill_status(r.valid()),
    "tariff_categories": lambda r: silver.tariff_categories(r.valid()),
    "municipalities": lambda r: silver.municipalities(r.valid()),
    "regulatory_profiles": lambda r: silver.regulatory_profiles(r.valid()),
    "addresses": lambda r: silver.addresses(r.valid()),
    "customers": lambda r: silver.customers(r.valid()),
    "customers_person": lambda r: silver.customers_person(r.valid(), r.silver("customers")),
    "customers_company": lambda r: silver.customers_company(r.valid(), r.silver("customers")),
    "installations": lambda r: silver.installations(r.valid()),
    "bills": lambda r: silver.bills(r.valid(), r.silver("customers"), r.silver("installations")),
    "payments": lambda r: silver.payments(r.valid(), r.silver("bills")),
    "taxes": lambda r: silver.taxes(r.valid(), r.silver("bills")),
    "reading_cycles": lambda r: silver.reading_cycles(r.valid(), r.silver("bills")),
    "rebills": lambda r: silver.rebills(r.valid(), r.silver("bills")),
    "levies": lambda r: silver.levies(r.valid(), r.silver("bills")),
}


# Log files are compressed; a file is one split, so its length is bounded by lines.
LOG_FILES = {"maxRecordsPerFile": 100_000, "compression": "gzip"}


class Relations:
    """Lazy sources; what several queries read is written once to the workspace."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.workspace = Workspace(spark, sf_dir)

    @classmethod
    def sized(cls, spark: SparkSession, sf_dir: str) -> Relations:
        """Relations in a session whose shuffles fit the source tables."""
        return cls(session.sized(spark, derived.source_rows(spark, sf_dir)), sf_dir)

    # --- billing ------------------------------------------------------------

    def raw(self, names: list[str] | None = None, changed: dict[str, str] | None = None) -> DataFrame:
        return derived.bills_raw(self.spark, self.sf_dir, names, changed)

    def numbered(self, names: list[str]) -> DataFrame:
        """Text columns with the row number as an integer."""
        rows = self.raw(["line_no", *names])
        return rows.withColumn("line_no", F.col("line_no").cast("bigint"))

    def extract_path(self) -> str:
        return self.workspace.files("extract", lambda path: extract.write_extract(self.raw(), path))

    def lake(self) -> Lake:
        """Odd and even billing months as loads 1 and 2, the first of which is loaded once more in the end."""
        odd = F.col("billing_month").cast("int") % 2 == 1
        rows = self.raw().withColumn("load", F.when(odd, 1).when(~odd, 2)).where("load is not null")

        def write(path: str) -> None:
            with extract.open_together(self.spark, 2):
                extract.write_extract(rows, path, by=["load"])

        path = self.workspace.files("two_extracts", write)

        def load(root: str) -> None:
            for load_id in (1, 2, 1):
                Lake(self.spark, root).load(f"{path}/load={load_id}", load_id)

        return Lake(self.spark, self.workspace.files("lake", load))

    def checked(self) -> DataFrame:
        return self.workspace.table("checked", lambda: bronze.check(self.raw()))

    def valid(self) -> DataFrame:
        return bronze.valid_rows(self.checked())

    def silver(self, name: str) -> DataFrame:
        return self.workspace.table(name, lambda: _SILVER[name](self))

    def base(self) -> DataFrame:
        tables = ("bills", "installations", "addresses", "levies", "payments")
        return self.workspace.table("levy_base", lambda: gold.levy_base(*(self.silver(t) for t in tables)))

    def partials(self) -> Partials:
        """The base as three loads by a hash of the bill, facts with their bill or after it, added one by one."""
        third = lambda *columns: F.pmod(F.crc32(F.concat_ws(":", *columns).cast("binary")), F.lit(3))
        loads = {
            "bills": third("bill_id"),
            "levies": F.greatest(third("bill_id"), third("bill_id", "levy")),
            "payments": F.greatest(third("bill_id"), third("bill_id", "paid_on")),
        }

        def add(root: str) -> None:
            partials = Partials(self.spark, root)
            tables = {n: self.silver(n) for n in ("installations", "addresses")}
            tables |= {n: self.silver(n).withColumn("load_id", load) for n, load in loads.items()}
            versions = {}
            for load_id in range(3):
                versions[load_id] = datetime(2026, 1, 1 + load_id)
                partials.add(lambda fresh, earlier: tables, versions)

        return Partials(self.spark, self.workspace.files("partials", add))

    # --- trials and logs ----------------------------------------------------

    def trials(self) -> DataFrame:
        return derived.trials(self.spark, self.sf_dir)

    def loads(self) -> DataFrame:
        return derived.loads(self.spark, self.sf_dir)

    def runs(self) -> DataFrame:
        return derived.runs(self.spark, self.sf_dir)

    def control_extract(self) -> DataFrame:
        """Trials with their loads, written as CSV with a header and read back as declared."""
        joined = self.trials().join(self.loads(), "load_id", "left")
        options = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
        path = self.workspace.files(
            "control_extract", lambda target: joined.write.mode("overwrite").options(**options).csv(target)
        )
        return self.spark.read.schema(joined.schema).options(**options).csv(path)

    def log_path(self) -> str:
        """The log as text files whose names and lines are in time order."""

        def write(path: str) -> None:
            lines = derived.log_lines(self.spark, self.sf_dir).orderBy("ms", "line_seq").select(derived.log_line())
            lines.write.mode("overwrite").options(**LOG_FILES).text(path)

        return self.workspace.files("log", write)

    def log_events(self) -> DataFrame:
        return self.workspace.table(
            "log_events", lambda: logs.log_events(self.spark, self.log_path(), logtext.DERIVED_PHRASES)
        )

    def grown_log(self) -> LogStore:
        """The same log in three stretches of time, each parsed when it has come to the others."""

        def write(path: str) -> None:
            lines = derived.log_lines(self.spark, self.sf_dir)
            end = lines.agg(F.max("ms")).first()[0] or 0
            part = F.expr(f"least(2, 3 * ms div {end + 1})")
            placed = lines.withColumn("part", part).orderBy("part", "ms", "line_seq").select("part", derived.log_line())
            placed.write.mode("overwrite").partitionBy("part").options(**LOG_FILES).text(path)

        def parse(root: str) -> None:
            store = LogStore(self.spark, root, logtext.DERIVED_PHRASES)
            for stretch in ("part=0", "part={0,1}", "part=*"):
                store.ingest(f"{path}/{stretch}")

        path = self.workspace.files("log_stretches", write)
        return LogStore(self.spark, self.workspace.files("log_store", parse), logtext.DERIVED_PHRASES)

    def landmarks(self) -> DataFrame:
        return self.workspace.table("log_landmarks", lambda: logs.log_landmarks(self.log_events()))

    def timings(self) -> DataFrame:
        return self.workspace.table(
            "load_timings", lambda: logs.load_timings(self.landmarks(), self.trials(), self.loads())
        )

    def timing_summary(self) -> DataFrame:
        return self.workspace.table("timing_summary", lambda: logs.timing_summary(self.timings(), ENGLISH_TERMS))

    def retry_sequences(self) -> DataFrame:
        return self.workspace.table("retry_sequences", lambda: logs.retry_sequences(self.log_events()))

    def outages(self) -> DataFrame:
        return self.workspace.table(
            "outages", lambda: logs.outage_timeline(self.log_events(), self.retry_sequences())
        )


DATES = [c.name for c in contract.COLUMNS if c.kind == "date"]
DECIMALS = [c.name for c in contract.COLUMNS if c.kind == "decimal"]
