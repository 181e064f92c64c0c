"""Deterministic masking of identifying columns.

Works on the text columns of the extract.  Every call makes its own label
tables from the rows it masks; a value without a label fails the job.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenlake import contract
from lumenlake.functions import parsing
from lumenlake.functions.permutation import permuted_digits
from lumenlake.operators.ordering import number_rows
from lumenlake.plans.workspace import Workspace
from lumenlake.sources import extract

# Masked headers, label texts and widths, identifier formats.
MASKED_HEADERS = [
    "ENDERECO", "NUMERO", "COMPLEMENTO", "CEP", "BAIRRO", "LATITUDE", "LONGITUDE",
    "CONTA_CONTRATO", "INSTALACAO", "DOCUMENTO_IMPRESSAO", "FATURA",
]
HELPER_HEADERS = ["MUNICIPIO", "MES_COMPETENCIA"]
LABELS = {"street": "RUA FICTICIA ", "complement": "COMPLEMENTO ", "district": "BAIRRO "}
LABEL_WIDTH = 3
SEED = 20260926
LARGEST_HOUSE_NUMBER = 9999

EQUALITY_COLUMNS = ["street", "complement", "district", "house_number"]


def require_columns(header: list[str]) -> None:
    absent = [h for h in MASKED_HEADERS + HELPER_HEADERS if h not in header]
    if absent:
        raise ValueError(f"columns missing from the extract: {absent}")


def _written(workspace: Workspace, name: str, rows: DataFrame) -> DataFrame:
    """A table of its own for every call: a mapping is never used on other rows than its own."""
    return workspace.table(f"{name}-{uuid.uuid4().hex}", lambda: rows)


def _mapped(label: Column, original: Column, stays: Column) -> Column:
    """The label; what has none must be allowed to stay as it is, or the job fails."""
    unmapped = F.raise_error(F.lit("a value has no masked counterpart")).cast("string")
    return F.when(label.isNotNull(), label).when(original.isNull() | stays, original).otherwise(unmapped)


def _padded(number: Column, width: int) -> Column:
    """Zero-padded; a longer number keeps all its digits."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def appearance_numbers(rows: DataFrame, column: str, skip_blank: bool = False) -> DataFrame:
    """(column, place): distinct values numbered by first appearance."""
    if skip_blank:
        rows = rows.where(~parsing.is_blank(F.col(column)))
    firsts = rows.groupBy(column).agg(F.min("line_no").alias("_first"))
    return number_rows(firsts, "_first", {"place": None}).drop("_first")


def address_labels(rows: DataFrame, workspace: Workspace, source: DataFrame | None = None) -> DataFrame:
    """Street, complement and district become numbered labels; a blank complement stays.

    Blank complements are most of the rows and never match: they pass beside
    the join, which comes first so that little is read twice for it.  Labels
    are made from ``source``, the same rows before other columns were masked.
    """
    source = rows if source is None else source
    columns = rows.columns
    for column in sorted(LABELS, key=lambda c: c != "complement"):
        blank = column == "complement"
        places = _written(workspace, f"mask_{column}", appearance_numbers(source, column, blank))
        label = F.concat(F.lit(LABELS[column]), _padded(F.col("place"), LABEL_WIDTH)).alias("_label")
        bare = F.coalesce(parsing.is_blank(F.col(column)), F.lit(True)) if blank else F.lit(False)
        labelled = rows.where(~bare).join(places.select(column, label), column, "left")
        masked = labelled.withColumn(column, _mapped(F.col("_label"), F.col(column), F.lit(False))).select(*columns)
        rows = masked.unionByName(rows.where(bare)) if blank else masked
    return rows


def _hash_rank(rows: DataFrame, column: str, salt: str, name: str) -> DataFrame:
    """Add ``name``: the rank by the seeded hash of a column with distinct values.

    Ranked inside chunks by the leading digits of the hash; only the sizes of
    at most 65 536 chunks pass through one window.
    """
    hashed = rows.withColumn("_hash", F.md5(F.concat(F.lit(f"{SEED}:{salt}:"), F.col(column).cast("string")).cast("binary")))
    hashed = hashed.withColumn("_chunk", F.substring("_hash", 1, 4))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy("_chunk").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_chunk").orderBy("_hash"))
    ranked = hashed.withColumn("_place", inside).join(offsets, "_chunk")
    return ranked.withColumn(name, F.col("_before") + F.col("_place")).drop("_hash", "_chunk", "_place", "_before")


def house_number_map(rows: DataFrame, workspace: Workspace) -> DataFrame:
    """(house_number, masked): distinct numbers to distinct free numbers.

    The pool is every number that is not an original, up to a bound that
    leaves more free numbers than there are originals.  The n-th original by
    its seeded hash gets the n-th pool number by another.
    """
    digits = rows.where(F.col("house_number").rlike("^[0-9]+$")).select("house_number").distinct()
    originals = _written(workspace, "mask_house_originals", digits)
    taken = originals.select(F.col("house_number").try_cast("bigint").alias("id")).where("id is not null").distinct()
    bound = LARGEST_HOUSE_NUMBER + 2 * originals.count()
    pool = rows.sparkSession.range(1, bound + 1).join(taken, "id", "left_anti")
    pool = _hash_rank(_written(workspace, "mask_house_pool", pool), "id", "pool", "slot")
    placed = _hash_rank(originals, "house_number", "original", "slot")
    return placed.join(pool, "slot").select("house_number", F.col("id").cast("string").alias("masked"))


def house_numbers(rows: DataFrame, workspace: Workspace, source: DataFrame | None = None) -> DataFrame:
    """Text such as S/N has no entry in the map and is kept; a number without one fails."""
    source = rows if source is None else source
    numbers = _written(workspace, "mask_house_number", house_number_map(source, workspace))
    joined = rows.join(numbers, "house_number", "left")
    masked = _mapped(F.col("masked"), F.col("house_number"), ~F.col("house_number").rlike("^[0-9]+$"))
    return joined.withColumn("house_number", masked).drop("masked").select(*rows.columns)


def postal_codes(rows: DataFrame, workspace: Workspace, source: DataFrame | None = None) -> DataFrame:
    """The municipality's commonest five-digit prefix, the smallest on a tie.

    Rows without municipality are a group of their own; where all postal codes are null they stay null.
    """
    prefixes = modal_prefixes(rows if source is None else source)
    prefixes = _written(workspace, "mask_postal_code", prefixes).withColumnRenamed("municipality", "_of")
    joined = rows.join(prefixes, rows["municipality"].eqNullSafe(prefixes["_of"]), "left")
    return joined.withColumn("postal_code", F.concat("_prefix", F.lit("-000"))).select(*rows.columns)


def modal_prefixes(rows: DataFrame) -> DataFrame:
    counts = rows.where(F.col("postal_code").isNotNull()).groupBy("municipality", F.substring("postal_code", 1, 5).alias("_prefix")).agg(
        F.count("*").alias("_n")
    )
    best = F.row_number().over(Window.partitionBy("municipality").orderBy(F.desc("_n"), "_prefix"))
    return counts.withColumn("_best", best).where("_best = 1").select("municipality", "_prefix")


def round_coordinate(text: Column) -> Column:
    """Two decimals, half up, written with the comma and width of the original."""
    width = F.length(F.substring_index(text, ",", -1))
    rounded = F.round(F.replace(text, F.lit(","), F.lit(".")).try_cast("decimal(38,18)"), 2).cast("decimal(20,2)")
    number = rounded.cast("string")
    signed = F.when(text.startswith("-") & ~number.startswith("-"), F.concat(F.lit("-"), number)).otherwise(number)
    shown = F.concat(signed, F.repeat(F.lit("0"), F.greatest(width - 2, F.lit(0))))
    shorter = F.length(shown) - F.greatest(F.lit(2) - width, F.lit(0))
    masked = F.replace(F.substring(shown, F.lit(1), shorter), F.lit("."), F.lit(","))
    return F.when(parsing.is_blank(text) | ~text.contains(","), text).otherwise(masked)


def coordinates(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: round_coordinate(F.col(c)) for c in ("latitude", "longitude")})


def identifiers(rows: DataFrame, per_row: bool = True, workspace: Workspace | None = None) -> DataFrame:
    """Installation, account, bill and document numbers from the row sequence.

    By default every row gets a new installation number.  With ``per_row``
    off, equal installations stay equal: they are numbered by first appearance.
    An account that was '00' + installation keeps that relation; the others
    get a sequence of their own.
    """
    follows = F.coalesce(F.col("contract_account") == F.concat(F.lit("00"), "installation"), F.lit(False))
    rows = rows.withColumn("_follows", follows)
    numbered = number_rows(rows, "line_no", {"_seq": None, "_own": ~F.col("_follows")})
    if per_row:
        numbered = numbered.withColumn("installation", _padded(F.col("_seq"), 10))
    else:
        places = _written(workspace, "mask_installation", appearance_numbers(rows, "installation"))
        label = _mapped(_padded(F.col("place"), 10), F.col("installation"), F.lit(False))
        numbered = numbered.join(places, "installation", "left").withColumn("installation", label)
    account = F.when(F.col("_follows"), F.concat(F.lit("00"), "installation")).otherwise(
        F.concat(F.lit("0030"), _padded(F.col("_own"), 8))
    )
    return numbered.withColumns(
        {
            "contract_account": account,
            "bill_number": F.concat(F.lit("0"), "billing_month", _padded(F.col("_seq"), 9)),
            "print_document": F.concat(F.lit("3"), _padded(F.col("_seq"), 11)),
        }
    ).select(*[c for c in rows.columns if c != "_follows"])


KEYED_COLUMNS = ["installation", "contract_account", "bill_number", "house_number"]


def keyed_identifiers(rows: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """Identifiers replaced by their keyed image of the same length, column by column.

    No table and no join: equal numbers stay equal within and across loads
    with the same key, and different ones stay apart.  Text such as S/N stays.
    """
    images = {}
    for name in columns or KEYED_COLUMNS:
        number = F.col(name).rlike("^[0-9]+$")
        images[name] = F.when(number, permuted_digits(F.when(number, F.col(name)), f"{key}:{name}")).otherwise(F.col(name))
    return rows.withColumns(images)


def mask(rows: DataFrame, workspace: Workspace, per_row: bool = True) -> DataFrame:
    """The whole extract masked; ``line_no`` must be a unique integer row number.

    Refuses rows that lack a masked or helper column.  Records that the scan
    marked as too long, and quotes inside a masked text, fail the job: their
    fields may have shifted into columns that are not masked.
    """
    names = {c.header: c.name for c in contract.COLUMNS}
    require_columns([header for header, name in names.items() if name in rows.columns])
    broken = F.coalesce(F.concat_ws("", *(F.col(names[h]) for h in MASKED_HEADERS)).contains('"'), F.lit(False))
    for fault in ("too_long", "open_quote"):
        if fault in rows.columns:
            broken = broken | F.coalesce(fault, F.lit(False))
    street, fault = F.col("street"), F.raise_error(F.lit("a record cannot be told apart into its fields"))
    rows = rows.withColumn("street", F.when(broken, fault.cast("string")).otherwise(street))
    source = _written(workspace, "mask_rows", rows)  # read once for every mapping
    masked = address_labels(identifiers(source, per_row, workspace), workspace, source)
    masked = house_numbers(masked, workspace, source)
    return coordinates(postal_codes(masked, workspace, source)).select(*rows.columns)


def mask_extract(rows: DataFrame, target: str, workspace: Workspace, per_row: bool = True) -> None:
    """Mask the rows of a scan, numbered as ``line_no``, and write them in the form of the extract."""
    extract.write_extract(mask(rows, workspace, per_row), target)


def equality_audit(before: DataFrame, after: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: distinct values before, after and together; equal when nothing merged or split.

    Pairs are made distinct first, so later counts see one row per pair.
    """
    columns = columns or EQUALITY_COLUMNS
    paired = before.select("line_no", *(F.col(c).alias(f"old_{c}") for c in columns)).join(
        after.select("line_no", *(F.col(c).alias(f"new_{c}") for c in columns)), "line_no"
    )
    pairs = paired.select(
        F.explode(
            F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"old_{c}").alias("old"), F.col(f"new_{c}").alias("new"))
                      for c in columns))
        ).alias("p")
    ).select("p.*").distinct()
    counted = pairs.groupBy("name").agg(
        F.count_distinct("old").alias("n_old"), F.count_distinct("new").alias("n_new"), F.count("*").alias("n_pairs")
    )
    same = (F.col("n_old") == F.col("n_pairs")) & (F.col("n_new") == F.col("n_pairs"))
    return counted.withColumn("preserved", same)
