"""The delimited billing extract: scan, header contract, line numbers, writing."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache, reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from lumenlake import contract
from lumenlake.plans.workspace import written
from lumenlake.sources.quoted import first_lines, quoted_records

SEPARATOR = ";"
BOM = "\ufeff"
_CORRUPT = "_corrupt"
_SPLITS = "spark.sql.files.minPartitionNum"
# Opening a file counts as much as a whole task may read, so no two files share one.
_ONE_FILE_PER_TASK = {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40)}


def split_header(line: str) -> list[str]:
    return [name.strip('"') for name in line.removeprefix(BOM).rstrip("\r").split(SEPARATOR)]


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@dataclass(frozen=True)
class Headers:
    """(path, header) of every file, and the distinct headers."""

    table: DataFrame
    distinct: list[str]


def read_headers(spark: SparkSession, path: str) -> Headers:
    """The first line of every file under a path, written.

    One scan with a task per file that ends with its first batch of lines, so
    neither the files nor their number pass through the driver.
    """
    with _settings(spark, _ONE_FILE_PER_TASK):
        lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0)
        lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("header"))
        table = written(lines.mapInArrow(first_lines, "path string, header string"), "headers")
    return Headers(table, [row["header"] for row in table.select("header").distinct().collect()])


def header_rows(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(path, first line) of every file under a path, in path order."""
    return sorted((unquote(row["path"]), row["header"]) for row in read_headers(spark, path).table.collect())


def header_lines(rows: DataFrame) -> DataFrame:
    """(file, header) with the base name of each file of a header table."""
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("file"), "header")


def has_contract(line: str) -> bool:
    """Whether a header line names the declared columns, in any order, and no others."""
    return set(split_header(line)) == set(contract.HEADERS)


def header_report(headers: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Compare header lines with the contract, both ways, in contract and file order.

    Returns (file, valid, missing, extra, message).
    """
    expected = contract.HEADERS if expected is None else expected
    line = F.regexp_replace(F.regexp_replace("header", "^" + BOM, ""), "[\r\"]", "")
    found = F.split(line, SEPARATOR)
    wanted = F.array(*(F.lit(h) for h in expected))
    listed = lambda names: F.when(
        F.size(names) > 0, F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))
    ).otherwise("[]")
    missing, extra = F.array_except(wanted, found), F.array_except(found, wanted)
    report = headers.select("file", missing.alias("missing"), extra.alias("extra"))
    valid = (F.size("missing") == 0) & (F.size("extra") == 0)
    parts = contract.HEADER_INVALID.split("{}")
    values = [F.size("missing"), F.size("extra"), listed(F.col("missing")), listed(F.col("extra"))]
    broken = F.concat(*(x for p, v in zip(parts, values) for x in (F.lit(p), v.cast("string"))))
    return report.select(
        "file",
        valid.alias("valid"),
        "missing",
        "extra",
        F.when(valid, contract.HEADER_VALID.format(len(expected))).otherwise(broken).alias("message"),
    )


@contextmanager
def pinned_splits(spark: SparkSession):
    """Cut files the same way in every scan inside the block, whatever executors come and go."""
    before = spark.conf.get(_SPLITS, None)
    if before is None:
        spark.conf.set(_SPLITS, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SPLITS)


def split_size(spark: SparkSession, size: int):
    """Splits of at most ``size`` bytes inside the block."""
    return _settings(spark, {"spark.sql.files.maxPartitionBytes": str(size)})


def open_together(spark: SparkSession, files: int):
    """A task writes up to so many partitions at once inside the block, so its wide rows are not sorted by them."""
    return _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(files)})


def scan_extract(
    spark: SparkSession, path: str, headers: Headers | None = None, multiline: bool = False
) -> DataFrame:
    """All declared columns as text, blanks kept as '', columns matched by name in each file.

    Adds ``file_name``; ``too_long`` marks records with more fields than the
    header, while records with fewer are padded with blanks.  A declared
    column the header lacks comes back null.  Files with the same header are
    scanned together; ``headers`` are those of read_headers, if known.

    With ``multiline`` a quoted field may hold line breaks: two scans, the
    first of which counts quotes, so run it inside ``pinned_splits``.  Without
    it a record ends with its line, and ``open_quote`` marks the pieces of one
    that does not.
    """
    headers = read_headers(spark, path) if headers is None else headers
    if not headers.distinct:
        raise ValueError("no columns to read")
    if len({tuple(split_header(line)) for line in headers.distinct}) == 1:
        return _scan(spark, path, split_header(headers.distinct[0]), multiline)
    # Only where headers differ does the driver deal the files out.
    files: dict[tuple[str, ...], list[str]] = {}
    for row in headers.table.collect():
        files.setdefault(tuple(split_header(row["header"])), []).append(unquote(row["path"]))
    return reduce(DataFrame.unionAll, [_scan(spark, sorted(paths), list(header), multiline) for header, paths in files.items()])


def _scan(spark: SparkSession, path: str | list[str], header: list[str], multiline: bool) -> DataFrame:
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]
    schema = T.StructType(fields + [T.StructField(_CORRUPT, T.StringType())])
    options = {"sep": SEPARATOR, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    if multiline:
        records = quoted_records(spark, path)
        parsed = F.from_csv("record", ", ".join(f"{field.name} string" for field in schema), options)
        rows = records.select(
            parsed.alias("_r"), F.col("file").alias("_file"), F.col("split").alias("_start"), F.col("place").alias("_at")
        ).select("_r.*", "_file", "_start", "_at")
    else:
        rows = spark.read.schema(schema).options(**options).option("header", True).option("enforceSchema", True).csv(path)
        rows = rows.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_at"),
        )
    return rows.select(*_columns(tuple(header)))


@lru_cache(maxsize=64)
def _columns(header: tuple[str, ...]) -> list[Column]:
    """The declared columns by their place in a header, and what is known of the record."""
    position = {name: i for i, name in reversed(list(enumerate(header)))}
    columns = []
    for column in contract.COLUMNS:
        at = position.get(column.header)
        value = F.lit(None).cast("string") if at is None else F.coalesce(F.col(f"c{at}"), F.lit(""))
        columns.append(value.alias(column.name))
    return [
        *columns,
        F.element_at(F.split("_file", "/"), -1).alias("file_name"),
        _too_many_fields(len(header)).alias("too_long"),
        (F.length(F.regexp_replace(F.coalesce(_CORRUPT, F.lit("")), '[^"]', "")) % 2 == 1).alias("open_quote"),
        *map(F.col, ("_file", "_start", "_at")),
    ]


def _too_many_fields(n: int) -> Column:
    bare = F.regexp_replace(_CORRUPT, '"[^"]*"', "")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(SEPARATOR), F.lit("")))
    return F.coalesce(separators >= n, F.lit(False))


def split_offsets(rows: DataFrame, *counts: Column) -> DataFrame:
    """Rows that precede each file split, and the split's first row id: one row per split.

    Rows know their split and their place in it, so this reads three columns
    of what was stored, not the files; ``counts`` are further aggregates.
    """
    splits = rows.groupBy("_file", "_start").agg(F.count("*").alias("_size"), F.min("_at").alias("_first"), *counts)
    earlier = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    return splits.select(*(c for c in splits.columns if c != "_size"), offset)


def with_row_numbers(rows: DataFrame, offsets: DataFrame, name: str = "row_number", by: tuple[str, ...] = ()) -> DataFrame:
    """1-based data row number over the files in path order.

    A row's number is its split's offset plus its place in the split, so rows
    meet one small table and are not shuffled when that is broadcast.  ``by``
    are further columns that tell splits apart.  Places are dense where no
    record was left out; a split without an offset stops the job.
    """
    lost = F.raise_error(F.lit("a split of the stored rows is not counted"))
    offset = F.when(F.col("_offset").isNull(), lost.cast("bigint")).otherwise(F.col("_offset"))
    numbered = rows.join(offsets, [*by, "_file", "_start"], "left").withColumn(
        name, offset + F.col("_at") - F.col("_first") + 1
    )
    return numbered.drop("_file", "_start", "_at", "_first", "_offset")


def write_extract(
    rows: DataFrame, path: str, headers: dict[str, str] | None = None, backwards: bool = False, by: list[str] | None = None
) -> None:
    """Write text columns as ';'-separated files with a header and a byte-order mark, in a folder per value of ``by``."""
    renamed = []
    for i, column in enumerate(contract.COLUMNS[::-1] if backwards else contract.COLUMNS):
        header = (headers or {}).get(column.header, column.header)
        renamed.append(F.col(column.name).alias(BOM + header if i == 0 else header))
    options = {
        "sep": SEPARATOR, "header": True, "emptyValue": "", "escape": '"',
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    writer = rows.select(*renamed, *(by or [])).write.mode("overwrite").options(**options)
    writer.partitionBy(*(by or [])).csv(path)
