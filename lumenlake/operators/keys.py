"""Deduplication and insert-if-absent by natural key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_wins(rows: DataFrame, keys: list[str], order: Column | str = "line_no") -> DataFrame:
    """Keep the earliest row of each key.

    The filter on row_number lets Spark keep one row per key on the map side,
    so a key that holds most of the rows is reduced before the shuffle.
    """
    order = F.col(order) if isinstance(order, str) else order
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    return ranked.where("_rank = 1").drop("_rank")


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: list[str], order: Column | str | None = "line_no"
) -> DataFrame:
    """Incoming rows whose key the target lacks, the earliest row per key.

    Without ``order`` the incoming keys are taken to be unique already.  Keys
    with a null never collide, as in a SQL unique constraint: the anti join
    keeps them, and only whole keys are reduced to their earliest row.
    """
    if order is not None:
        whole = F.lit(True)
        for key in keys:
            whole = whole & F.col(key).isNotNull()
        incoming = first_wins(incoming.where(whole), keys, order).unionByName(incoming.where(~whole))
    return incoming.join(target.select(*keys), keys, "left_anti").select(*incoming.columns)
