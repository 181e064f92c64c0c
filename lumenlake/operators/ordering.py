"""Global order without a one-partition window.

Each operator cuts the order into chunks, works inside the chunks in
parallel, summarises each chunk in one row, accumulates over the summaries
and joins the result back.  Only the summaries, a few rows per chunk, pass
through a single window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenlake.plans.workspace import written

BLOCK = 1 << 18


def number_rows(rows: DataFrame, order: str, names: dict[str, Column | None], block: int = BLOCK) -> DataFrame:
    """1-based sequences by a unique integer column.

    ``names`` maps each sequence to the condition of the rows it counts, or to
    None for all rows.  A block spans ``block`` consecutive values of the order
    column, so it can never hold more rows than that.
    """
    rows = rows.withColumn("_block", F.floor(F.col(order) / block))
    counted = {n: F.lit(1) if test is None else F.when(test, 1).otherwise(0) for n, test in names.items()}
    sizes = rows.groupBy("_block").agg(*(F.sum(one).alias(n) for n, one in counted.items()))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_block", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in names))
    upto = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.withColumns({n: F.sum(one).over(upto) for n, one in counted.items()}).join(offsets, "_block")
    for n, test in names.items():
        total = F.col(n) + F.col(f"_{n}")
        inside = inside.withColumn(n, total if test is None else F.when(test, total))
    return inside.drop("_block", *(f"_{n}" for n in names))


def range_chunks(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with ``_chunk``, written: what a range exchange put together, numbered in the order of the ranges.

    The exchange finds its ranges itself, as many as there are shuffle
    partitions, and adaptive execution merges small ones; no bound reaches the
    plan, whose size does not depend on them.  Equal values of ``order`` stay
    together, so callers aggregate them to one row first.  Rows are read once:
    what follows reads the written chunks.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.withColumn("_chunk", F.spark_partition_id()), "value-ranges")


def running_total(counts: DataFrame, order: str, amount: str, name: str, by: list[str] | None = None) -> DataFrame:
    """Sum of ``amount`` over all rows up to and including this one.

    ``counts`` has one row per value of ``order`` within ``by``: callers
    aggregate first, so equal values, however many, are a single row here.
    Each chunk takes over the total of those before it.
    """
    by = by or []
    chunked = range_chunks(counts, [*by, order])
    sums = chunked.groupBy(*by, "_chunk").agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*by, "_chunk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = (
        Window.partitionBy(*by, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = chunked.withColumn("_local", F.sum(amount).over(inside))
    return local.join(offsets, by + ["_chunk"]).withColumn(name, F.col("_offset") + F.col("_local")).drop(
        "_chunk", "_local", "_offset"
    )


def carry_forward(
    rows: DataFrame, chunk: list[str], order: list[str], value: str, name: str, inclusive: bool = True
) -> DataFrame:
    """Last non-null ``value`` at or before each row, across chunks.

    ``chunk`` are columns whose own order is the order of the chunks, and
    ``order`` the order inside one.
    """
    inside = Window.partitionBy(*chunk).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1
    )
    position = F.struct(*order)
    marked = F.when(F.col(value).isNotNull(), position)
    tails = rows.groupBy(*chunk).agg(F.max_by(value, marked).alias("_tail"))
    earlier = Window.orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    heads = tails.select(*chunk, F.last("_tail", ignorenulls=True).over(earlier).alias("_head"))
    local = rows.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    return local.join(heads, chunk).withColumn(name, F.coalesce("_local", "_head")).drop("_local", "_head")
