"""Raw layer: typed rows, admissibility, and the outcome of a load."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F

from lumenlake import contract
from lumenlake.contract import Terms
from lumenlake.functions import parsing

OPEN_QUOTE = "A quoted field does not end on its line: load the file with multiline"
_QUOTED = "', '"


def type_columns(raw: DataFrame) -> DataFrame:
    """Typed columns, plus what is wrong with each row.

    ``missing`` names the required headers that are null or blank after
    conversion, ``violations`` the headers whose value the raw table could
    not hold; '' when nothing is wrong.  Columns outside the contract pass
    through.

    The short filter over the first two required headers keeps this one wide
    projection out of whole-stage code: there it would be a single method,
    larger than the JVM compiles, while outside of it Spark splits the
    expressions into small methods.  The filter itself is interpreted, so it
    holds nothing that has to be parsed; the rest uses ``concat_ws``, which
    skips nulls and is generated code.
    """
    extra = tuple(c for c in raw.columns if c not in contract.NAMES)
    return raw.select(*_projection(extra))


@lru_cache(maxsize=16)
def _projection(extra: tuple[str, ...]) -> list[Column]:
    """The wide projection; building its 2000 expressions costs more than typing a small extract."""
    typed = [_typed(c).alias(c.name) for c in contract.COLUMNS]
    missing = [F.when(_is_missing(c), c.header) for c in contract.REQUIRED]
    faults = [F.when(_is_inadmissible(c), c.header) for c in contract.COLUMNS if c.kind != "date"]
    if "too_long" in extra:
        faults.append(F.when(F.col("too_long"), "*"))
    if "open_quote" in extra:
        faults.append(F.when(F.col("open_quote"), '"'))
    return [
        *typed,
        *map(F.col, extra),
        F.concat_ws(_QUOTED, F.array_compact(F.array(*missing[:2])), *missing[2:]).alias("missing"),
        F.concat_ws(_QUOTED, *faults).alias("violations"),
    ]


def _typed(column: contract.Column) -> Column:
    text = F.col(column.name)
    if column.kind == "string":
        return text
    if column.kind == "date":
        return parsing.parse_date(text)
    if column.kind == "decimal":
        return parsing.parse_decimal(text, column.declared)
    return parsing.parse_int(text, column.declared)


def _is_missing(column: contract.Column) -> Column:
    """Null after conversion; an overflowing number is present, only inadmissible."""
    text = F.col(column.name)
    if column.kind == "string":
        return parsing.is_blank(text)
    if column.kind == "decimal":
        return _typed(column).isNull() & ~parsing.is_number(text)
    return _typed(column).isNull()


def _is_inadmissible(column: contract.Column) -> Column:
    text = F.col(column.name)
    if column.kind == "string":
        return F.length(text) > column.max_length
    if column.kind == "decimal":
        return _typed(column).isNull() & (text != "") & parsing.is_number(text)
    return _typed(column).isNull() & ~parsing.is_blank(text)


def check(raw: DataFrame) -> DataFrame:
    """Typed rows with ``is_valid`` and, for rejected ones, the ``reason``."""
    before, after = contract.MISSING_REASON.split("{}")
    typed = type_columns(raw)
    torn = F.col("open_quote") if "open_quote" in raw.columns else F.lit(False)
    reason = F.when(torn, OPEN_QUOTE).when(
        F.col("missing") != "", F.concat(F.lit(before + "'"), "missing", F.lit("'" + after))
    ).when(F.col("violations") != "", F.concat(F.lit("Inadmissible values: ['"), "violations", F.lit("']")))
    valid = (F.col("missing") == "") & (F.col("violations") == "")
    return typed.withColumn("is_valid", valid).withColumn("reason", reason)


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where("is_valid").drop("missing", "violations", "is_valid", "reason", "too_long", "open_quote")


def rejected_rows(checked: DataFrame, row: str = "line_no", keep: list[str] | None = None) -> DataFrame:
    """Quarantine form: row number, reason, and the converted values under their headers as JSON."""
    payload = F.to_json(
        F.struct(*(F.col(c.name).alias(c.header) for c in contract.COLUMNS)), {"ignoreNullFields": "false"}
    )
    return checked.where("not is_valid").select(
        *(keep or []), F.col(row).cast("bigint").alias("line_no"), "reason", payload.alias("payload")
    )


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return valid_rows(checked), rejected_rows(checked)


def first_fault(checked: DataFrame, row: str = "line_no") -> DataFrame:
    """What a fail-fast load reports: its first bad row, if any."""
    bad = checked.where("not is_valid")
    return bad.agg(F.min(row).alias("line_no"), F.min_by("reason", row).alias("reason"))


def totals(checked: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Valid and rejected counts in one pass."""
    return checked.groupBy(*(by or [])).agg(
        F.count_if("is_valid").alias("n_rows"), F.count_if(~F.col("is_valid")).alias("n_quarantined")
    )


def outcome(
    summary: DataFrame, recovered: Column, fallback: Column, bad_header: Column, quarantine: bool, terms: Terms
) -> DataFrame:
    """Fault type, mechanisms, status and the auto-resolved flag of each load.

    ``summary`` has n_rows and n_quarantined.  Faults are listed from most to
    least severe: the first one is the type, the mechanisms of all are joined
    by '+'.  With ``quarantine`` off a single bad row fails the load, and the
    counts are not stored.
    """
    bad_rows = F.col("n_quarantined") > 0
    faults = [
        (recovered, terms.connection, terms.retry),
        (fallback, terms.file_missing, terms.fallback),
        (bad_header, terms.schema, terms.schema_check),
        (bad_rows & ~bad_header, terms.null_data, terms.quarantine if quarantine else terms.no_mechanism),
    ]
    fault_type = F.coalesce(*(F.when(found, fault) for found, fault, _ in faults), F.lit(terms.no_fault))
    used = F.concat_ws("+", *(F.when(found, mechanism) for found, _, mechanism in faults))
    failed = bad_header | (bad_rows & ((F.col("n_rows") == 0) if quarantine else F.lit(True)))
    classified = summary.select(
        "*",
        fault_type.alias("fault_type"),
        F.when(used == "", terms.no_mechanism).otherwise(used).alias("mechanism"),
        F.when(failed, terms.error).otherwise(terms.success).alias("status"),
    )
    resolved = (F.col("fault_type") != terms.no_fault) & (F.col("status") == terms.success)
    stored = classified.withColumn("auto_resolved", resolved)
    if not quarantine:
        stored = stored.withColumn("n_rows", F.when(F.col("status") == terms.success, F.col("n_rows")))
        stored = stored.withColumn("n_quarantined", F.lit(0).cast("bigint"))
    return stored
