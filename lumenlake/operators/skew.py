"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 100_000
BUCKETS = 1 << 14


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key) of the keys with more than ``hot_rows`` rows.

    Buckets of hashed keys are counted first: that moves one number per bucket
    and task, not the keys.  Only keys of buckets that hold so many rows are
    counted themselves.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("_bucket")
    full = rows.groupBy(bucket).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
    full = [row["_bucket"] for row in full.select("_bucket").collect()]  # at most one per hot_rows rows
    near = rows.where(bucket.isin(full)) if len(full) < BUCKETS else rows
    return near.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows).select(key)


def join_many(
    unique: DataFrame, many: DataFrame, key: str, hot_rows: int = HOT_ROWS, where: Column | None = None
) -> DataFrame:
    """Left join of a side with one row per key to a side with any number.

    Rows of the first side that fail ``where``, a test of its own columns,
    stay and find nothing; they may repeat a key.

    An outer join cannot be split on its right side at run time.  So keys
    with more than ``hot_rows`` rows there, at most one per ``hot_rows`` rows,
    are joined apart by an inner join, which can: adaptive execution broadcasts
    the few rows of the unique side if they are small in bytes, and splits the
    hot partitions otherwise.  All other keys are joined by shuffle.
    """
    hot = hot_keys(many, key, hot_rows)
    if hot.isEmpty():
        return _left_join(unique, many, key, where)
    linked = unique if where is None else unique.where(where)
    spread = many.join(linked.join(hot, key, "left_semi"), key)
    cold = unique.join(hot, key, "left_anti")
    if where is not None:
        cold = cold.unionByName(unique.where(~F.coalesce(where, F.lit(False))).join(hot, key, "left_semi"))
    rest = _left_join(cold, many.join(hot, key, "left_anti"), key, where)
    return rest.unionByName(spread.select(rest.columns))


def _left_join(unique: DataFrame, many: DataFrame, key: str, where: Column | None) -> DataFrame:
    if where is None:
        return unique.join(many, key, "left")
    found = many.withColumnRenamed(key, "_found")
    return unique.join(found, (F.col(key) == F.col("_found")) & where, "left").drop("_found")
