"""Load files into the lake: checked rows, control events, normalised tables, base view.

Layout under the root, all Parquet::

    checked/load_id=N/is_valid=true|false   every row of load N, typed
    splits/load_id=N                        rows of each file split of load N and before it
    control/                                load events, the last one counts
    trials/                                 trial events, the last one counts
    <table>/load_id=N                       rows load N added to a normalised table
    rejects/load_id=N                       payments and rebills of load N that were left out
    normalised/                             events of normalised loads
    levy_base/                              the served base relation
    partials/                               what each load adds to the views, see plans.partials

A load reads its extract once and writes its rows once, each with its split
and its place in it; row numbers follow from the small table of splits, which
is counted from the stored rows.  The raw snapshot, the history and the
quarantine are partitions of that one copy, and they show a load only after
its control event says so: a failed or interrupted load leaves nothing to
undo, and repeating a load replaces its own partitions.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lumenlake import contract
from lumenlake.contract import PUBLISHED_TERMS, Terms
from lumenlake.operators.keys import insert_if_absent
from lumenlake.plans import bronze, gold, reports, silver
from lumenlake.plans.partials import Partials, touched_bills
from lumenlake.sources import extract, locate

CONTROL = {
    "load_id": "bigint", "file_name": "string", "started_at": "timestamp_ntz", "ended_at": "timestamp_ntz",
    "n_rows": "bigint", "n_quarantined": "bigint", "status": "string", "error": "string", "fault_type": "string",
    "mechanism": "string", "attempts": "int", "recovery_ms": "bigint", "auto_resolved": "boolean",
    "event_at": "timestamp_ntz",
}
TRIAL = {
    "trial_id": "bigint", "grp": "string", "fault": "string", "iteration": "bigint", "injected_at": "timestamp_ntz",
    "outcome": "string", "load_id": "bigint", "event_at": "timestamp_ntz",
}
CHECKED = {
    **{c.name: c.spark_type for c in contract.COLUMNS},
    "file_name": "string", "too_long": "boolean", "open_quote": "boolean",
    "_file": "string", "_start": "bigint", "_at": "bigint", "missing": "string", "violations": "string",
    "reason": "string", "loaded_at": "timestamp_ntz", "is_valid": "boolean",
}
SPLITS = {
    "_file": "string", "_start": "bigint", "_first": "bigint", "n_rows": "bigint", "n_quarantined": "bigint", "_offset": "bigint",
}
NORMALISED = {"load_id": "bigint", "event_at": "timestamp_ntz"}
# Billing months are free text in an extract; only such texts are months, at most 120 000.
MONTH = "^[0-9]{4}(0[1-9]|1[0-2])$"
ABSENT_FILE = "(ausente)"

# Natural keys by which a normalised table takes only rows it lacks.
KEYS = {
    "commercial_status": ["code"],
    "bill_status": ["description"],
    "tariff_categories": ["code"],
    "municipalities": ["name"],
    "regulatory_profiles": silver.PROFILE,
    "addresses": silver.ADDRESS_KEY,
    "customers": ["customer_name", "customer_type"],
    "customers_person": ["person_tax_id"],
    "customers_company": ["company_tax_id"],
    "installations": ["installation"],
    "bills": ["bill_id"],
    "payments": ["bill_id", "paid_on"],
    "taxes": ["bill_id"],
    "reading_cycles": ["bill_id", "cycle_start", "cycle_end", "cycle_days"],
    "rebills": ["bill_id", "rebilled_on", "substitute_amount", "substitute_levy"],
    "levies": ["bill_id", "levy"],
}
# A null in these keys is a value like any other, so that repeating a load adds nothing.
NULL_SAFE = {"regulatory_profiles", "reading_cycles", "rebills"}


class LoadFailed(Exception):
    """A load that ended in error; its control event has been written."""


@dataclass(frozen=True)
class Attempt:
    """How the connection to the source went before the load began."""

    tries: int = 1
    elapsed_ms: int = 0


class Lake:
    def __init__(self, spark: SparkSession, root: str, terms: Terms = PUBLISHED_TERMS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.terms = terms

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # --- control and trial events -------------------------------------------

    def _append(self, name: str, schema: dict[str, str], row: dict) -> None:
        self._one_row(row, schema).coalesce(1).write.mode("append").parquet(self._path(name))

    def _one_row(self, row: dict, schema: dict[str, str]) -> DataFrame:
        """A local relation: reading it takes no job."""
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "timestamp_ntz": pa.timestamp("us")}
        columns = {name: pa.array([row.get(name)], kinds[kind]) for name, kind in schema.items()}
        return self.spark.createDataFrame(pa.table(columns), _ddl(schema))

    def _latest(self, name: str, schema: dict[str, str], key: str) -> DataFrame:
        """The last event of each key; events without a key all stay."""
        try:
            events = self.spark.read.schema(_ddl(schema)).parquet(self._path(name))
        except AnalysisException:
            return self.spark.createDataFrame([], _ddl(schema))
        fields = [name for name in schema if name != key]
        last = events.where(F.col(key).isNotNull()).groupBy(key).agg(
            F.max_by(F.struct(*fields), "event_at").alias("_last")
        )
        return last.select(key, "_last.*").unionByName(events.where(F.col(key).isNull())).select(events.columns)

    def loads(self) -> DataFrame:
        return self._latest("control", CONTROL, "load_id")

    def trials(self) -> DataFrame:
        return self._latest("trials", TRIAL, "trial_id")

    def record_trial(self, **row) -> None:
        self._append("trials", TRIAL, row)

    def record_failure(self, file_name: str, message: str, fault: str, mechanism: str, attempt: Attempt, at: datetime):
        """A failure that happened before any load could be registered."""
        self._append("control", CONTROL, {
            "file_name": file_name, "started_at": at, "ended_at": at, "status": self.terms.error, "error": message,
            "fault_type": fault, "mechanism": mechanism, "attempts": attempt.tries,
            "recovery_ms": attempt.elapsed_ms, "auto_resolved": False, "n_quarantined": 0, "event_at": at,
        })

    # --- raw layer ----------------------------------------------------------

    def load_file(
        self,
        directory: str,
        primary: str,
        load_id: int,
        self_healing: bool = True,
        attempt: Attempt = Attempt(),
        multiline: bool = False,
    ) -> dict:
        """Find the file and load it; without one, record the failure and raise.

        The failure carries the fallback label even when fallback is off, as
        in the published records.
        """
        found = locate.locate(self.spark, directory, primary, allow_fallback=self_healing)
        if found.path is None:
            terms = self.terms
            self.record_failure(ABSENT_FILE, found.message, terms.file_missing, terms.fallback, attempt, _now())
            raise LoadFailed(found.message)
        return self.load(found.path, load_id, self_healing, attempt, found.used_fallback, multiline)

    def load(
        self,
        path: str,
        load_id: int,
        self_healing: bool = True,
        attempt: Attempt = Attempt(),
        used_fallback: bool = False,
        multiline: bool = False,
    ) -> dict:
        """Type, check and store one extract; returns its control row.

        With ``self_healing`` a wrong header stops the load before the data
        is read, and bad rows go to quarantine.  Without it the header is not
        checked and the first bad row fails the load.  ``multiline`` allows
        line breaks in quoted fields and reads each file in one task.
        """
        started = _now()
        event = {
            "load_id": load_id, "file_name": path.rstrip("/").rsplit("/", 1)[-1], "started_at": started,
            "attempts": attempt.tries, "recovery_ms": attempt.elapsed_ms, "n_quarantined": 0, "auto_resolved": False,
        }
        flags = {"recovered": attempt.tries > 1, "fallback": used_fallback, "bad_header": False}

        def finish(error: str | None = None, n_rows: int = 0, n_quarantined: int = 0) -> dict:
            event.update(self._outcome(n_rows, n_quarantined, flags, self_healing))
            if error is not None:
                event.update(status=self.terms.error, auto_resolved=False)
            if event["status"] == self.terms.error and not n_quarantined:
                event["n_rows"] = None
            event.update(ended_at=_now(), error=error, event_at=_now())
            self._append("control", CONTROL, event)
            if event["status"] == self.terms.error:
                raise LoadFailed(error or "no valid row")
            return event

        running = self._outcome(0, 0, flags, self_healing)
        running.update(status=self.terms.running, auto_resolved=False, n_rows=None)
        self._append("control", CONTROL, {**event, **running, "event_at": started})

        try:
            headers = extract.read_headers(self.spark, path)
            if not headers.distinct:
                raise ValueError("no columns to read")
            if self_healing and not all(map(extract.has_contract, headers.distinct)):
                flags["bad_header"] = True
                report = extract.header_report(extract.header_lines(headers.table))
                faults = report.where("not valid").orderBy("file").collect()
                return finish(_header_faults(faults, headers.table.count()))
        except (AnalysisException, ValueError) as unreadable:
            flags["bad_header"] = self_healing
            return finish(contract.HEADER_UNREADABLE.format(str(unreadable).split("\n")[0]))
        try:
            counts, fault = self._store(path, load_id, headers, started, self_healing, multiline)
        except Exception as broken:
            finish(f"{type(broken).__name__}: {str(broken).splitlines()[0]}" if str(broken) else type(broken).__name__)
        return finish(fault, counts["n_rows"], counts["n_quarantined"])

    def _store(
        self, path: str, load_id: int, headers: extract.Headers, started: datetime, self_healing: bool, multiline: bool
    ):
        """Write the checked rows; returns their counts and, without healing, the first fault."""
        target = f"{self._path('checked')}/load_id={load_id}"
        with extract.pinned_splits(self.spark):
            checked = bronze.check(extract.scan_extract(self.spark, path, headers, multiline))
            checked = checked.withColumn("loaded_at", F.lit(started).cast("timestamp_ntz"))
            with extract.open_together(self.spark, 2):
                checked.write.mode("overwrite").partitionBy("is_valid").parquet(target)
        stored = self.spark.read.schema(_ddl(CHECKED)).parquet(target)
        valid = F.col("is_valid")
        counts = (F.count_if(valid).alias("n_rows"), F.count_if(~valid).alias("n_quarantined"))
        splits = f"{self._path('splits')}/load_id={load_id}"
        extract.split_offsets(stored, *counts).coalesce(1).write.mode("overwrite").parquet(splits)
        splits = self.spark.read.schema(_ddl(SPLITS)).parquet(splits)
        total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
        counts = splits.agg(total("n_rows"), total("n_quarantined")).first()
        fault = None
        if counts["n_quarantined"] and not self_healing:
            bad = extract.with_row_numbers(stored.where(~valid), splits.drop("n_rows", "n_quarantined"))
            fault = bronze.first_fault(bad, "row_number").first()["reason"]
        return counts, fault

    def _outcome(self, n_rows: int, n_quarantined: int, flags: dict[str, bool], self_healing: bool) -> dict:
        summary = self._one_row({"n_rows": n_rows, "n_quarantined": n_quarantined}, {"n_rows": "bigint", "n_quarantined": "bigint"})
        conditions = [F.lit(flags[f]) for f in ("recovered", "fallback", "bad_header")]
        return bronze.outcome(summary, *conditions, self_healing, self.terms).first().asDict()

    def _checked(self, valid: bool) -> DataFrame:
        """Rows of loads whose control event has released them."""
        terms = self.terms
        released = (F.col("status") == terms.success) if valid else (F.col("n_quarantined") > 0)
        ids = self.loads().where(released & F.col("load_id").isNotNull()).select("load_id")
        try:
            rows = self.spark.read.schema(_ddl({**CHECKED, "load_id": "bigint"})).parquet(self._path("checked"))
            splits = self.spark.read.schema(_ddl({**SPLITS, "load_id": "bigint"})).parquet(self._path("splits"))
        except AnalysisException:
            raise LoadFailed("no load has finished") from None
        rows = rows.where(F.col("is_valid") == valid).join(ids, "load_id", "left_semi")
        return extract.with_row_numbers(rows, splits.drop("n_rows", "n_quarantined"), by=("load_id",))

    def history(self) -> DataFrame:
        """Valid rows of all released loads."""
        return self._checked(True).drop("is_valid", "missing", "violations", "reason", "too_long", "open_quote")

    def latest_load(self) -> int:
        """The load released last, whatever its number."""
        released = self.loads().where((F.col("status") == self.terms.success) & F.col("load_id").isNotNull())
        found = released.agg(F.max_by("load_id", F.struct("event_at", "load_id"))).first()[0]
        if found is None:
            raise LoadFailed("no load has finished")
        return found

    def raw(self) -> DataFrame:
        """Valid rows of the latest released load."""
        return self.history().where(F.col("load_id") == self.latest_load())

    def quarantine(self) -> DataFrame:
        rows = self._checked(False)
        kept = rows.select("load_id", "row_number", "loaded_at", F.col("is_valid"), "reason", *contract.NAMES)
        return bronze.rejected_rows(kept, "row_number", ["load_id", "loaded_at"])

    # --- normalised layer ---------------------------------------------------

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name)).drop("load_id")

    def _insert(self, name: str, incoming: DataFrame, load_id: int, months: list | None = None) -> None:
        """Write what earlier loads lack.  ``months`` bound the earlier rows that can have the same key."""
        target = f"{self._path(name)}/load_id={load_id}"
        keys = KEYS[name]
        try:
            known = T.StructType([*incoming.schema.fields, T.StructField("load_id", T.LongType())])
            earlier = self.spark.read.schema(known).parquet(self._path(name)).where(F.col("load_id") != load_id)
        except AnalysisException:
            earlier = None
        if earlier is not None:
            if months is not None:
                earlier = earlier.where(_in_months(months))
            if name in NULL_SAFE:
                match = F.lit(True)
                for key in keys:
                    match = match & F.col(f"new.{key}").eqNullSafe(F.col(f"old.{key}"))
                incoming = incoming.alias("new").join(earlier.alias("old"), match, "left_anti")
            else:
                incoming = insert_if_absent(earlier, incoming, keys, order=None)
        incoming.write.mode("overwrite").parquet(target)

    def normalise(self) -> None:
        """Add the latest load to every normalised table, in dependency order; independent ones together.

        Row numbers restart in each load, so first-wins compares rows of one
        load; across loads the earlier load wins.  Bills and their facts are
        compared with the months of the load alone: loads come by month, so
        the files of other months are not read.
        """
        raw = self.raw()
        load_id = self.latest_load()
        raw = raw.withColumn("line_no", F.col("row_number"))

        def insert(name: str, *more: DataFrame, months: list | None = None) -> Callable[[], None]:
            return lambda: self._insert(name, getattr(silver, name)(raw, *more), load_id, months)

        _together(*(insert(name) for name in (
            "commercial_status", "bill_status", "tariff_categories", "municipalities", "regulatory_profiles", "addresses",
            "customers", "installations",
        )))
        known = self.table("customers")
        _together(
            insert("customers_person", known),
            insert("customers_company", known),
            insert("bills", known, self.table("installations"), months=_months(raw)),
        )
        billed = self.table("bills")
        # A number may be that of a bill of another month than the row's.
        months = _months(billed.join(raw.select("bill_number"), "bill_number", "left_semi"))
        billed = billed.where(_in_months(months))
        rejects = silver.null_in_required_fact(raw)
        _together(
            *(insert(name, billed, months=months) for name in ("payments", "taxes", "reading_cycles", "rebills", "levies")),
            lambda: rejects.write.mode("overwrite").parquet(f"{self._path('rejects')}/load_id={load_id}"),
        )
        self._append("normalised", NORMALISED, {"load_id": load_id, "event_at": _now()})

    def rejects(self) -> DataFrame:
        """Rows whose payment or rebill was left out, with the reason, of all normalised loads."""
        return self.spark.read.parquet(self._path("rejects"))

    # --- served layer -------------------------------------------------------

    def serve(self, whole: bool = False) -> list[str]:
        """Write the months of the base relation that the latest load touched; register it and its views.

        A month is touched if the load added a bill to it, or a levy or a
        payment to one of its bills; without a written base, or with
        ``whole``, all months are.  Ranges of month and bill spread a hot
        month over several tasks while every task writes few months.
        """
        bills, *others = (self.table(t) for t in ("bills", "installations", "addresses", "levies", "payments"))
        if not whole and self._is_served():
            bills = bills.where(_in_months(_months(self._touched(bills))))
        base = gold.levy_base(bills, *others).repartitionByRange("month", "bill_id")
        writer = base.write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
        writer.partitionBy("month").parquet(self._path("levy_base"))
        return gold.register_views(self.served())

    def _is_served(self) -> bool:
        try:
            return bool(self.spark.read.parquet(self._path("levy_base")).columns)
        except AnalysisException:
            return False

    def _touched(self, bills: DataFrame) -> DataFrame:
        """Billing months of bills that the latest load added or added to."""
        load_id = self.latest_load()
        added = lambda name: self.spark.read.parquet(self._path(name)).where(F.col("load_id") == load_id)
        ids = added("levies").select("bill_id").unionByName(added("payments").select("bill_id"))
        later = bills.join(ids, "bill_id", "left_semi").select("billing_month")
        return added("bills").select("billing_month").unionByName(later).distinct()

    def served(self) -> DataFrame:
        return self.spark.read.parquet(self._path("levy_base"))

    def partials(self) -> Partials:
        return Partials(self.spark, self._path("partials"))

    def serve_partials(self) -> list[str]:
        """Add what the loads normalised since the last call change, and register the views over the partials.

        Reads the rows of those loads and, in the months of the bills they
        touch, of these bills; places are looked up.  ``serve`` writes the
        base rows themselves, which these views do not need.
        """
        last = self._latest("normalised", NORMALISED, "load_id").collect()  # one row per load
        partials = self.partials()
        partials.add(self._changed_tables, {row["load_id"]: row["event_at"] for row in last})
        return partials.register_views()

    def _changed_tables(self, fresh: list[int], earlier: list[int]) -> dict[str, DataFrame]:
        by_bill = {n: self.spark.read.parquet(self._path(n)) for n in ("bills", "levies", "payments")}
        if earlier:
            near = _in_months(_months(by_bill["bills"].join(touched_bills(by_bill, fresh), "bill_id", "left_semi")))
            by_bill = {n: rows.where(near) for n, rows in by_bill.items()}
        return {**by_bill, "installations": self.table("installations"), "addresses": self.table("addresses")}

    def run(
        self, directory: str, primary: str, load_id: int, self_healing: bool = True, multiline: bool = False
    ) -> list[str]:
        """A whole load: find and check the file, normalise it, refresh the served views."""
        self.load_file(directory, primary, load_id, self_healing, multiline=multiline)
        self.normalise()
        return self.serve()

    def preview(self, name: str, rows: int = 100) -> DataFrame:
        """The first rows, by all columns in turn, of any table, layer, record or view of the lake."""
        layers = {
            "raw": self.raw, "history": self.history, "quarantine": self.quarantine, "rejects": self.rejects,
            "loads": self.loads, "trials": self.trials, "levy_base": self.served,
        }
        if name in layers:
            found = layers[name]()
        elif name in gold.VIEWS:
            found = gold.VIEWS[name](self.served())
        else:
            found = self.table(name)
        return found.orderBy(*found.columns).limit(rows)

    # --- reports ------------------------------------------------------------

    def write_reports(self, folder: str, landmarks: DataFrame) -> list[str]:
        """The result files of all trials of this lake; landmarks are those of its log."""
        return reports.write_reports(folder, self.trials(), self.loads(), landmarks, self.terms)


def _together(*steps: Callable[[], None]) -> None:
    """Run steps that do not need each other at once; the first fault is raised when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for ended in [pool.submit(step) for step in steps]:
            ended.result()


def _months(rows: DataFrame) -> list:
    """Calendar months, so few whatever the rows; one blank stands for all texts that are no month."""
    month = F.col("billing_month")
    known = F.when(month.rlike(MONTH), month).when(month.isNotNull(), "")
    return [row[0] for row in rows.select(known).distinct().collect() if row[0] is not None]


def _in_months(months: list) -> Column:
    month = F.col("billing_month")
    found = month.isin([m for m in months if m]) | month.isNull()
    return found | ~month.rlike(MONTH) if "" in months else found


def _header_faults(faults: list, n_files: int) -> str:
    """The message of one file as it is; of several files each behind its name."""
    if n_files == 1:
        return faults[0]["message"]
    return "; ".join(f"{row['file']}: {row['message']}" for row in faults)


def _ddl(schema: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in schema.items())


def _now() -> datetime:
    return datetime.now()
