"""The result files of a trial campaign: tables, timings, and one document that shows them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lumenlake.contract import PUBLISHED_TERMS, Terms
from lumenlake.plans import export, logs, reliability
from lumenlake.plans.workspace import written

TITLE = "Trials: control and treatment"
DOCUMENT = "report"
# Name of the file, heading in the document, and the order of its rows.
TABLES = {
    "success_rate": ("Success by group and injected fault", ["fault", "grp"]),
    "mttr_by_fault": ("Time to recover, by fault", ["fault_type"]),
    "auto_resolved_pct": ("Faults resolved without help", ["fault"]),
    "overhead_by_group": ("Mean load duration without faults", ["grp"]),
    "fault_pivot": ("Control and treatment side by side", ["fault"]),
    "timing_summary": ("Durations from the log", ["metric", "grp", "fault"]),
    "overhead_summary": ("Treatment against control without faults", ["metric"]),
    "overhead_tests": ("Tests of the difference", ["metric"]),
    "trend_tests": ("Duration over the iterations", ["grp", "step"]),
}
TIMINGS = "load_timings"


def result_tables(
    trials: DataFrame, loads: DataFrame, landmarks: DataFrame, timings: DataFrame, terms: Terms = PUBLISHED_TERMS
) -> dict[str, DataFrame]:
    """One table per entry of TABLES, few rows each."""
    summary = written(logs.timing_summary(timings, terms), "timing-summary")
    return {
        "success_rate": reliability.success_rate(trials),
        "mttr_by_fault": reliability.mttr_by_fault(trials, loads, terms),
        "auto_resolved_pct": reliability.auto_resolved_pct(trials, loads, terms),
        "overhead_by_group": reliability.overhead_by_group(trials, loads, terms),
        "fault_pivot": reliability.fault_pivot(trials, terms),
        "timing_summary": summary,
        "overhead_summary": logs.overhead_summary(summary, terms),
        "overhead_tests": logs.overhead_tests(timings, terms),
        "trend_tests": logs.trend_tests(landmarks, trials, terms),
    }


def write_reports(
    folder: str, trials: DataFrame, loads: DataFrame, landmarks: DataFrame, terms: Terms = PUBLISHED_TERMS
) -> list[str]:
    """Write every table as CSV, the timings of all loads beside them, and the document; returns the paths.

    The timings have a row per load and stay out of the document.
    """
    spark = trials.sparkSession
    timings = written(logs.load_timings(landmarks, trials, loads), TIMINGS)
    export.write_csv(timings, f"{folder}/{TIMINGS}")
    sections = {}
    for name, rows in result_tables(trials, loads, landmarks, timings, terms).items():
        heading, order = TABLES[name]
        sections[heading] = written(rows, name).orderBy(*order)
        export.write_csv(sections[heading], f"{folder}/{name}")
    document = export.markdown_report(TITLE, sections)
    lines = spark.createDataFrame([(document.rstrip("\n"),)], "value string").coalesce(1)
    lines.write.mode("overwrite").text(f"{folder}/{DOCUMENT}")
    return [f"{folder}/{name}" for name in (TIMINGS, *TABLES, DOCUMENT)]
