"""Log analytics: landmarks per load, durations, summaries, tests, outages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lumenlake.contract import PUBLISHED_TERMS, Terms
from lumenlake.functions.money import guarded_percent
from lumenlake.operators import statistics
from lumenlake.operators.ordering import carry_forward, range_chunks
from lumenlake.sources import logtext
from lumenlake.sources.logtext import MILESTONES, Phrases

# The four published metrics as (start, end) milestones.
METRICS = {
    "ingest_ms": ("created", "finished"),
    "pre_read_ms": ("created", "reading"),
    "schema_ms": ("created", "schema"),
    "read_to_done_ms": ("reading", "finished"),
}
# Consecutive steps of a load, and the total.
STEPS = {
    "schema_check": ("created", "reading"),
    "read_convert": ("reading", "clearing"),
    "clear_raw": ("clearing", "cleared"),
    "insert_rows": ("cleared", "history"),
    "copy_history": ("history", "copied"),
    "finish": ("copied", "finished"),
    "total": ("created", "finished"),
}
TESTED = ["ingest_ms", "pre_read_ms", "read_to_done_ms"]
_CHUNK = ["file", "split"]


def log_events(spark: SparkSession, path: str, phrases: Phrases) -> DataFrame:
    """Landmark lines with their place in the log.

    Write this once: the later steps read it more than once and need the same
    file splits each time.
    """
    return logtext.classify(logtext.parse_lines(logtext.scan_log(spark, path)), phrases)


def log_landmarks(events: DataFrame) -> DataFrame:
    """First time of each milestone per load.

    A line belongs to the load created last before it, carried forward within
    file splits and across them.  When a load id is created again, its later
    creation replaces the earlier one.
    """
    return merged_landmarks(load_parts(events))


def load_parts(events: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """One row per creation of a load: the first line of each milestone that these events hold.

    First in log order, which is not always the smallest time.  ``opening`` is
    the creation that earlier parts of the log left open; it has its own row.
    """
    rows = events.where(F.col("kind").isin(MILESTONES)).withColumn(
        "_birth", F.when(F.col("kind") == "created", F.struct("load_id", "file", "split", "at"))
    )
    owned = carry_forward(_opened_by(opening, rows, "_birth"), _CHUNK, ["at"], "_birth", "_owner")
    seen = F.struct("file", "split", "at", "ts", "number")
    return owned.where("_owner is not null").groupBy("_owner").agg(
        *(F.min(F.when(F.col("kind") == kind, seen)).alias(kind) for kind in MILESTONES)
    )


def _opened_by(opening: DataFrame | None, rows: DataFrame, name: str) -> DataFrame:
    """The rows behind one that carries the opening and stands before every file."""
    if opening is None:
        return rows
    first = opening.select(
        F.lit("").alias("file"), F.lit(0).cast("bigint").alias("split"), F.lit(0).cast("bigint").alias("at"),
        F.col("_opening").alias(name),
    )
    return rows.unionByName(first, allowMissingColumns=True)


def merged_landmarks(parts: DataFrame) -> DataFrame:
    """Landmarks per load from the parts of one or more stretches of the log."""
    per_birth = parts.groupBy("_owner").agg(*(F.min(kind).alias(kind) for kind in MILESTONES))
    births = F.struct("_owner.file", "_owner.split", "_owner.at")
    times = [F.col(f"{kind}.ts").alias(kind) for kind in MILESTONES]
    last = per_birth.groupBy(F.col("_owner.load_id").alias("load_id")).agg(
        F.max_by(F.struct(*times, F.col("finished.number").alias("rows_logged")), births).alias("_last")
    )
    return last.select("load_id", "_last.*")


def _between(start: str, end: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {start}, {end}) / 1000")


def load_timings(landmarks: DataFrame, trials: DataFrame, loads: DataFrame) -> DataFrame:
    """One row per trial with a load: the four metrics and the log's row count."""
    recorded = trials.join(loads.select("load_id", "status", "n_rows"), "load_id")
    timed = landmarks.select(
        "load_id",
        "rows_logged",
        F.col("created").alias("created_at"),
        F.col("finished").alias("finished_at"),
        *(_between(a, b).alias(name) for name, (a, b) in METRICS.items()),
    )
    return recorded.join(timed, "load_id", "left").select(
        "load_id", "trial_id", "grp", "fault", "iteration", "outcome", "status", "n_rows", "rows_logged",
        "created_at", "finished_at", *METRICS,
    )


def _long(rows: DataFrame, keys: list[str], names: list[str], label: str) -> DataFrame:
    """Unfold measured columns into (label, ms), dropping what was not measured."""
    return rows.unpivot(keys, names, label, "ms").where("ms is not null")


def _scenarios(terms: Terms) -> Column:
    treated = [terms.no_fault, terms.connection, terms.null_data, terms.file_missing]
    control = (F.col("grp") == terms.control) & (F.col("fault") == terms.no_fault)
    return control | ((F.col("grp") == terms.treatment) & F.col("fault").isin(treated))


def timing_summary(timings: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """n, mean, deviation, extremes and median per metric, group and reported scenario."""
    rows = _long(timings.where(_scenarios(terms)), ["grp", "fault"], list(METRICS), "metric")
    return statistics.summarise(rows, ["metric", "grp", "fault"], "ms")


def _steps(landmarks: DataFrame, trials: DataFrame, terms: Terms) -> DataFrame:
    quiet = trials.where((F.col("fault") == terms.no_fault) & F.col("load_id").isNotNull())
    timed = landmarks.select("load_id", *(_between(a, b).alias(name) for name, (a, b) in STEPS.items()))
    return _long(quiet.join(timed, "load_id"), ["grp", "iteration", "trial_id"], list(STEPS), "step")


def overhead_by_step(landmarks: DataFrame, trials: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Mean and deviation of each step without faults, by group."""
    return _steps(landmarks, trials, terms).groupBy("step", "grp").agg(
        F.count("*").alias("n"), F.avg("ms").alias("mean_ms"), F.stddev_samp("ms").alias("stdev_ms")
    )


def overhead_summary(summary: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Treatment minus control without faults: means and medians, absolute and in percent."""
    quiet = summary.where((F.col("fault") == terms.no_fault) & F.col("metric").isin(TESTED))
    side = lambda group, value: F.max(F.when(F.col("grp") == group, F.col(value)))
    sides = quiet.groupBy("metric").agg(
        *(side(g, v).alias(f"{n}_{v}") for n, g in (("control", terms.control), ("treatment", terms.treatment))
          for v in ("mean", "median"))
    ).where("control_mean is not null and treatment_mean is not null")
    for value in ("mean", "median"):
        difference = F.col(f"treatment_{value}") - F.col(f"control_{value}")
        change = guarded_percent(difference, F.col(f"control_{value}"))
        sides = sides.withColumn(f"{value}_difference", difference).withColumn(f"{value}_change_pct", change)
    return sides


def _quiet_long(timings: DataFrame, terms: Terms) -> DataFrame:
    quiet = timings.where((F.col("fault") == terms.no_fault) & F.col("grp").isin(terms.control, terms.treatment))
    return _long(quiet, ["grp"], TESTED, "metric")


def mann_whitney(timings: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """U and z of treatment against control per metric, without faults."""
    treated = F.col("grp") == terms.treatment
    return statistics.mann_whitney(_quiet_long(timings, terms), "ms", treated, ["metric"])


def mann_whitney_by_iteration(timings: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """U of treatment against control per metric and iteration with exact, normal and chosen p: small samples."""
    quiet = timings.where((F.col("fault") == terms.no_fault) & F.col("grp").isin(terms.control, terms.treatment))
    rows = _long(quiet, ["grp", "iteration"], TESTED, "metric")
    found = statistics.mann_whitney(rows, "ms", F.col("grp") == terms.treatment, ["metric", "iteration"])
    found = found.where((F.col("n_first") > 0) & (F.col("n_second") > 0))
    sizes = [F.col("n_first"), F.col("n_second")]
    exact = F.when(~F.col("tied"), statistics.exact_two_sided(F.col("u"), *sizes))
    normal = statistics.normal_two_sided(F.col("z"))
    found = found.withColumns({"p_exact": exact, "p_normal": normal})
    return found.withColumn("p", F.coalesce("p_exact", "p_normal"))


def mann_whitney_by_step(landmarks: DataFrame, trials: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """U and z of treatment against control per step of a load, without faults."""
    return statistics.mann_whitney(_steps(landmarks, trials, terms), "ms", F.col("grp") == terms.treatment, ["step"])


def overhead_tests(timings: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Both tests with their two-sided p-values, one row per tested metric."""
    columns = [F.col(c) for c in ("u", "z", "n_first", "n_second", "tied")]
    u = mann_whitney(timings, terms).select("metric", "u", statistics.mann_whitney_two_sided(*columns).alias("p_u"))
    p_t = statistics.student_two_sided(F.col("t"), F.col("df")).alias("p_t")
    return u.join(welch_t(timings, terms).select("metric", "t", "df", p_t), "metric")


def welch_t(timings: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    treated = F.col("grp") == terms.treatment
    return statistics.welch(_quiet_long(timings, terms), "ms", treated, ["metric"])


def spearman_trend(landmarks: DataFrame, trials: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """Correlation of iteration and duration per group, for the whole load and the insert step."""
    rows = _steps(landmarks, trials, terms).where(F.col("step").isin("total", "insert_rows"))
    return statistics.spearman(rows, ["grp", "step"], "iteration", "ms")


def trend_tests(landmarks: DataFrame, trials: DataFrame, terms: Terms = PUBLISHED_TERMS) -> DataFrame:
    """The same correlations with their two-sided p-values."""
    p = statistics.spearman_two_sided(F.col("rho"), F.col("n"))
    return spearman_trend(landmarks, trials, terms).withColumn("p", p)


def trend_first_last(
    landmarks: DataFrame, trials: DataFrame, terms: Terms = PUBLISHED_TERMS, size: int = 10
) -> DataFrame:
    """Mean duration of the first and of the last ``size`` loads by iteration.

    The row limits let Spark keep ``size`` rows per group and map task.
    """
    rows = _steps(landmarks, trials, terms).where(F.col("step").isin("total", "insert_rows"))
    ends = []
    for name, order in (("first", ("iteration", "trial_id")), ("last", (F.desc("iteration"), F.desc("trial_id")))):
        place = F.row_number().over(Window.partitionBy("grp", "step").orderBy(*order))
        ends.append(rows.withColumn("_place", place).where(F.col("_place") <= size).withColumn("_end", F.lit(name)))
    both = ends[0].unionByName(ends[1])
    return both.groupBy("grp", "step").agg(
        *(F.avg(F.when(F.col("_end") == name, F.col("ms"))).alias(f"{name}_mean_ms") for name in ("first", "last"))
    )


# --- outages -----------------------------------------------------------------


def retry_sequences(events: DataFrame) -> DataFrame:
    """Attempt times and connection time of each sequence that connected on try three.

    A sequence opens at attempt one and its lines carry that opening forward.
    """
    return merged_sequences(retry_parts(events))


def retry_parts(events: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """One row per opening of a sequence: its times as far as these events hold them.

    ``opening`` is the one that earlier parts of the log left open.
    """
    first = (F.col("kind") == "attempt") & (F.col("number") == 1)
    rows = events.where("kind in ('attempt', 'connected')").withColumn(
        "_opened", F.when(first, F.struct("file", "split", "at"))
    )
    owned = carry_forward(_opened_by(opening, rows, "_opened"), _CHUNK, ["at"], "_opened", "_owner")
    attempt = lambda n: F.max(F.when((F.col("kind") == "attempt") & (F.col("number") == n), F.col("ts")))
    connected = F.col("kind") == "connected"
    return owned.where("_owner is not null").groupBy("_owner").agg(
        *(attempt(n).alias(f"try{n}_at") for n in (1, 2, 3)),
        F.min(F.when(connected, F.col("ts"))).alias("connected_at"),
        F.min(F.when(connected, F.col("number"))).alias("recovery_ms"),
    )


def merged_sequences(parts: DataFrame) -> DataFrame:
    """Connected sequences from the parts of one or more stretches of the log."""
    whole = parts.groupBy("_owner").agg(
        *(F.max(c).alias(c) for c in ("try1_at", "try2_at", "try3_at")),
        *(F.min(c).alias(c) for c in ("connected_at", "recovery_ms")),
    )
    return whole.where("connected_at is not null and try3_at is not null").drop("_owner")


def outage_timeline(events: DataFrame, sequences: DataFrame) -> DataFrame:
    """Each sequence with the last shutdown before try one and the first ready after that shutdown.

    Both are as-of lookups in time order.  Instants are made distinct first
    and dealt out in ranges.
    """
    shutdowns = _instants(events.where("kind = 'shutdown'"), "ts", 0)
    starts = _instants(sequences, "try1_at", 1)
    before = _last_before(shutdowns, starts, "shutdown_at", forward=True).withColumnRenamed("_at", "try1_at")
    readies = _instants(events.where("kind = 'ready'"), "ts", 0)
    stops = _instants(shutdowns, "_at", 1)
    after = _last_before(readies, stops, "ready_at", forward=False).withColumnRenamed("_at", "shutdown_at")
    return sequences.join(before, "try1_at").join(after, "shutdown_at")


def _instants(rows: DataFrame, column: str, kind: int) -> DataFrame:
    return rows.select(F.col(column).alias("_at")).distinct().withColumn("_kind", F.lit(kind))


def _last_before(events: DataFrame, marks: DataFrame, name: str, forward: bool) -> DataFrame:
    """For each mark the nearest event strictly before it, or after it when not ``forward``."""
    sign = 1 if forward else -1
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', _at)") * sign
    timeline = events.withColumn("_event", F.col("_at")).unionByName(
        marks.withColumn("_event", F.lit(None).cast("timestamp_ntz"))
    ).withColumn("_us", micros)
    # At one instant marks come first, so an event there is not before them.
    timeline = timeline.withColumn("_order", 1 - F.col("_kind"))
    timeline = range_chunks(timeline, ["_us", "_order"])
    found = carry_forward(timeline, ["_chunk"], ["_us", "_order"], "_event", name)
    return found.where(f"_kind = 1 and {name} is not null").select("_at", name)


# The reported intervals of an outage as (start, end).
OUTAGE_INTERVALS = {
    "shutdown_to_try1": ("shutdown_at", "try1_at"),
    "try1_to_try2": ("try1_at", "try2_at"),
    "try2_to_try3": ("try2_at", "try3_at"),
    "try3_to_connected": ("try3_at", "connected_at"),
    "outage": ("shutdown_at", "ready_at"),
    "ready_to_try3": ("ready_at", "try3_at"),
}


def outage_statistics(timeline: DataFrame) -> DataFrame:
    """Mean, deviation and extremes of the six intervals and of the recovery time, in seconds."""
    seconds = timeline.select(
        *(F.expr(f"timestampdiff(MICROSECOND, {a}, {b}) / 1000000").alias(n) for n, (a, b) in OUTAGE_INTERVALS.items()),
        (F.col("recovery_ms") / 1000).alias("recovery"),
    )
    rows = seconds.unpivot([], [*OUTAGE_INTERVALS, "recovery"], "interval", "s").where("s is not null")
    return rows.groupBy("interval").agg(
        F.count("*").alias("n"),
        *(f("s").alias(f"{n}_s") for n, f in (
            ("mean", F.avg), ("stdev", F.stddev_samp), ("min", F.min), ("max", F.max))),
    )


def connect_failures(events: DataFrame) -> DataFrame:
    """Duration statistics of connections that failed for good."""
    failed = events.where("kind = 'connect_failed'").select("kind", F.col("number").alias("ms"))
    return statistics.summarise(failed, ["kind"], "ms").drop("kind")
