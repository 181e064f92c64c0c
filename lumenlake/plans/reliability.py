"""Trial and load analytics: success, recovery, overhead, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lumenlake.contract import PUBLISHED_TERMS, Terms
from lumenlake.functions.money import percent
from lumenlake.operators import statistics
from lumenlake.operators.intervals import count_overlaps, newest_after

SUCCESS = "success"


def _all_trials(trials: DataFrame, loads: DataFrame) -> DataFrame:
    """Every trial with its load, if it recorded one."""
    return trials.join(loads, "load_id", "left")


def _recorded(trials: DataFrame, loads: DataFrame) -> DataFrame:
    return trials.join(loads, "load_id")


def _elapsed_ms():
    return F.expr("timestampdiff(MICROSECOND, started_at, ended_at) / 1000")


def trial_load_join(trials: DataFrame, loads: DataFrame) -> DataFrame:
    return _all_trials(trials, loads)


def success_rate(trials: DataFrame) -> DataFrame:
    """By group and injected fault.

    Success is what the trial observed, and a load id names at most one load,
    so the left join to the loads could only repeat each trial once: it is
    left out.
    """
    won = F.count_if(F.col("outcome") == SUCCESS)
    return trials.groupBy("grp", "fault").agg(
        F.count("*").alias("n_trials"),
        won.alias("n_success"),
        percent(won, F.count("*")).alias("success_pct"),
    )


def mttr_by_fault(trials: DataFrame, loads: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Recovery time of treatment loads that resolved themselves."""
    rows = _recorded(trials.where(F.col("grp") == terms.treatment), loads.where("auto_resolved"))
    mean = F.sum("recovery_ms").cast("decimal(28,0)") / F.count("*").cast("decimal(18,0)")
    return rows.where("recovery_ms is not null").groupBy("fault_type").agg(
        F.count("*").alias("n_recovered"),
        F.round(mean, 2).cast("decimal(18,2)").alias("mttr_ms"),
        F.round(mean / 1000, 3).cast("decimal(18,3)").alias("mttr_s"),
        F.min("recovery_ms").alias("min_ms"),
        F.max("recovery_ms").alias("max_ms"),
    )


def mttr_detail(trials: DataFrame, loads: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Spread of the connection recovery time, and how many needed the third try."""
    wanted = (F.col("grp") == terms.treatment) & (F.col("fault") == terms.connection)
    return _recorded(trials.where(wanted), loads).agg(
        F.round(F.avg("recovery_ms"), 2).alias("mean_ms"),
        F.round(F.stddev_samp("recovery_ms"), 2).alias("stdev_ms"),
        F.min("recovery_ms").alias("min_ms"),
        F.max("recovery_ms").alias("max_ms"),
        F.count_if(F.col("attempts") == 3).alias("n_third_try"),
    )


def auto_resolved_pct(trials: DataFrame, loads: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Share of injected faults that treatment loads resolved themselves."""
    wanted = (F.col("grp") == terms.treatment) & (F.col("fault") != terms.no_fault)
    resolved = F.count_if("auto_resolved")
    return _recorded(trials.where(wanted), loads.select("load_id", "auto_resolved")).groupBy("fault").agg(
        F.count("*").alias("n_trials"),
        resolved.alias("n_resolved"),
        percent(resolved, F.count("*")).alias("resolved_pct"),
    )


def overhead_by_group(trials: DataFrame, loads: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Mean load duration without faults; trials without a load count but have no duration."""
    rows = _all_trials(trials.where(F.col("fault") == terms.no_fault), loads)
    return rows.groupBy("grp").agg(
        F.count("*").alias("n_trials"), F.round(F.avg(_elapsed_ms()), 2).alias("mean_ms")
    )


def fault_pivot(trials: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Control and treatment side by side per injected fault."""
    columns = []
    for name, group in (("control", terms.control), ("treatment", terms.treatment)):
        member = F.col("grp") == group
        won = F.count_if(member & (F.col("outcome") == SUCCESS))
        columns += [won.alias(f"{name}_success"), percent(won, F.count_if(member), 1).alias(f"{name}_pct")]
    return trials.where(F.col("fault") != terms.no_fault).groupBy("fault").agg(*columns)


def time_to_failure(trials: DataFrame, loads: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Load duration under the header fault, by group."""
    rows = _recorded(trials.where(F.col("fault") == terms.schema), loads).withColumn("_ms", _elapsed_ms())
    return rows.groupBy("grp").agg(
        F.count("*").alias("n"),
        *(F.round(f("_ms"), 2).alias(f"{n}_ms")
          for n, f in (("mean", F.avg), ("stdev", F.stddev_samp), ("min", F.min), ("max", F.max))),
    )


def duration_summary(trials: DataFrame, loads: DataFrame) -> DataFrame:
    """Load duration statistics by group and injected fault."""
    rows = _recorded(trials, loads).withColumn("_ms", _elapsed_ms())
    return statistics.summarise(rows, ["grp", "fault"], "_ms")


def recovery_summary(trials: DataFrame, loads: DataFrame) -> DataFrame:
    """Recovery time statistics by group and injected fault, with the range of attempts."""
    return statistics.summarise(_recorded(trials, loads), ["grp", "fault"], "recovery_ms", ["attempts"])


def mechanism_activations(trials: DataFrame, loads: DataFrame) -> DataFrame:
    rows = _recorded(trials, loads.select("load_id", "mechanism", "auto_resolved"))
    return rows.groupBy("mechanism", "grp").agg(
        F.count("*").alias("n_activations"), F.count_if("auto_resolved").alias("n_resolved")
    )


def runs_by_state(trials: DataFrame) -> DataFrame:
    return trials.groupBy("outcome").agg(F.count("*").alias("n_runs")).orderBy(F.desc("n_runs"))


def quarantine_yield(trials: DataFrame, loads: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Share of rows that null-data loads still delivered."""
    wanted = (F.col("grp") == terms.treatment) & (F.col("fault") == terms.null_data)
    inserted, held = F.sum("n_rows"), F.sum("n_quarantined")
    return _recorded(trials.where(wanted), loads).agg(
        inserted.alias("n_inserted"), held.alias("n_quarantined"), percent(inserted, inserted + held).alias("yield_pct")
    )


def quarantine_by_reason(quarantine: DataFrame, trials: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Rejected rows per reason, and in how many loads each reason occurs.

    Rows are counted per reason and load before the join, so the join sees
    one row per pair and the distinct count is a plain one.
    """
    wanted = (F.col("grp") == terms.treatment) & (F.col("fault") == terms.null_data)
    each = quarantine.groupBy("reason", "load_id").agg(F.count("*").alias("_n"))
    joined = each.join(trials.where(wanted).groupBy("load_id").agg(F.count("*").alias("_t")), "load_id")
    return joined.groupBy("reason").agg(
        F.sum(F.col("_n") * F.col("_t")).alias("n_rows"), F.count("*").alias("n_loads")
    )


def history_load_bounds(history: DataFrame) -> DataFrame:
    return history.groupBy("load_id").agg(F.min("loaded_at").alias("first_at"), F.max("loaded_at").alias("last_at"))


def trial_load_asof(trials: DataFrame, loads: DataFrame) -> DataFrame:
    """For each trial the newest load started from its injection up to the next one."""
    newest = newest_after(trials, "injected_at", loads, "started_at", "load_id")
    rows = trials.select("trial_id", "injected_at").join(newest, "injected_at", "left")
    return rows.select("trial_id", "injected_at", "load_id", "started_at")


def overlapping_runs(runs: DataFrame) -> DataFrame:
    return count_overlaps(runs, "started_at", "ended_at", ["scenario"])
