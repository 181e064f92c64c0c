"""As-of and interval joins by sorting instead of pairing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lumenlake.operators.ordering import carry_forward, range_chunks, running_total


def newest_after(marks: DataFrame, mark_time: str, facts: DataFrame, fact_time: str, fact_id: str) -> DataFrame:
    """For each distinct mark time, the newest fact before the next mark.

    Facts are first reduced to one per instant; each then belongs to the last
    mark at or before it, found by carrying the mark forward in time order.
    Returns (mark_time, fact_id, fact_time).
    """
    points = marks.select(F.col(mark_time).alias("_at")).distinct().withColumn("_mark", F.col("_at"))
    latest = facts.groupBy(F.col(fact_time).alias("_at")).agg(F.max(fact_id).alias("_fact"))
    timeline = points.withColumn("_kind", F.lit(0)).withColumn("_fact", F.lit(None).cast("bigint")).unionByName(
        latest.withColumn("_kind", F.lit(1)).withColumn("_mark", F.lit(None).cast(points.schema["_mark"].dataType))
    )
    timeline = range_chunks(timeline, ["_at", "_kind"])
    owned = carry_forward(timeline, ["_chunk"], ["_at", "_kind"], "_mark", "_owner")
    return (
        owned.where("_kind = 1 and _owner is not null")
        .groupBy(F.col("_owner").alias(mark_time))
        .agg(F.max_by("_fact", "_at").alias(fact_id), F.max("_at").alias(fact_time))
    )


def count_overlaps(runs: DataFrame, start: str, end: str, by: list[str]) -> DataFrame:
    """Pairs of runs that overlap, per group, without listing any pair.

    Two runs miss each other when one ends at or before the other starts.
    With all instants in order, the runs that ended by each start are a
    running total, so the misses come from one pass and overlaps are what is
    left of n(n-1)/2.  Runs of no length at the same instant miss each other
    both ways and themselves; those are counted apart.
    """
    ends = runs.groupBy(*by, F.col(end).alias("_at")).agg(F.count("*").alias("_ended"))
    starts = runs.groupBy(*by, F.col(start).alias("_at")).agg(
        F.count("*").alias("_started"), F.count_if(F.col(start) == F.col(end)).alias("_empty")
    )
    instants = ends.withColumn("_started", F.lit(0)).withColumn("_empty", F.lit(0)).unionByName(
        starts.withColumn("_ended", F.lit(0))
    )
    instants = instants.groupBy(*by, "_at").agg(
        *(F.sum(c).alias(c) for c in ("_ended", "_started", "_empty"))
    )
    total = running_total(instants, "_at", "_ended", "_done", by)
    # Products of counts outgrow 64 bits at a few thousand million runs.
    exact = lambda name: F.col(name).cast("decimal(19,0)")
    pairs = lambda n: (n * (n - 1) / 2).cast("decimal(38,0)")
    empty = exact("_empty")
    misses = (exact("_started") * exact("_done")).cast("decimal(38,0)") - empty - pairs(empty)
    summed = total.groupBy(*by).agg(F.sum("_started").alias("n_runs"), F.sum(misses.cast("decimal(38,0)")).alias("_misses"))
    overlapping = (pairs(exact("n_runs")) - F.col("_misses")).cast("decimal(38,0)")
    return summed.select(*by, "n_runs", overlapping.alias("n_overlapping"))
