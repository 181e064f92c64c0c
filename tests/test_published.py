"""The published durations and the figures published for them."""

import math

import pytest
from pyspark.sql import functions as F

from lumenlake.contract import PUBLISHED_TERMS as TERMS
from lumenlake.functions.money import guarded_percent
from lumenlake.operators import statistics
from lumenlake.plans import logs, reliability
from lumenlake.sources import logtext

# Published values: load duration in ms by iteration, without faults.
CONTROL = [283, 261, 279, 237, 264, 266, 262, 261, 271, 267, 268, 281, 266, 265, 269, 269, 271, 266, 270, 264, 270,
           270, 278, 283, 297, 275, 291, 265, 285, 280]
TREATMENT = [288, 299, 284, 287, 288, 299, 284, 282, 293, 299, 293, 291, 282, 293, 279, 306, 306, 275, 274, 290, 285,
             288, 279, 289, 271, 280, 288, 283, 279, 284]


@pytest.fixture(scope="module")
def timings(spark):
    rows = [(g, i + 1, float(ms)) for g, sample in ((TERMS.control, CONTROL), (TERMS.treatment, TREATMENT))
            for i, ms in enumerate(sample)]
    return spark.createDataFrame(rows, "grp string, iteration int, ms double").withColumn("metric", F.lit("ingest_ms"))


def test_summary(timings):
    found = {r["grp"]: r for r in statistics.summarise(timings, ["grp"], "ms").collect()}
    shown = lambda r: (r["n"], round(r["mean"], 2), round(r["stdev"], 2), r["min"], r["max"], r["median"])
    assert shown(found[TERMS.control]) == (30, 271.13, 11.12, 237, 297, 269.5)
    assert shown(found[TERMS.treatment]) == (30, 287.27, 8.71, 271, 306, 287.5)


def test_two_sample_tests(timings):
    treated = F.col("grp") == TERMS.treatment
    u = statistics.mann_whitney(timings, "ms", treated, ["metric"]).first()
    assert u["u"] == 796.5
    t = statistics.welch(timings, "ms", treated, ["metric"]).first()
    assert round(t["t"], 3) == 6.255 and round(t["df"], 1) == 54.8


def test_report_of_both_tests(timings):
    wide = timings.withColumnRenamed("ms", "ingest_ms").withColumn("fault", F.lit(TERMS.no_fault))
    wide = wide.withColumn("pre_read_ms", F.lit(None).cast("double")).withColumn("read_to_done_ms", F.col("ingest_ms") * 0)
    found = {r["metric"]: r for r in logs.overhead_tests(wide.drop("metric"), TERMS).collect()}
    assert found["ingest_ms"]["p_t"] == pytest.approx(6.27e-8, rel=0.01)
    assert found["ingest_ms"]["p_u"] == pytest.approx(3.06e-7, rel=0.01)
    assert found["read_to_done_ms"]["p_u"] is None and found["read_to_done_ms"]["p_t"] is None


def test_trend(timings):
    found = {r["grp"]: r for r in statistics.spearman(timings, ["grp"], "iteration", "ms").collect()}
    assert round(found[TERMS.control]["rho"], 3) == 0.488 and round(found[TERMS.treatment]["rho"], 3) == -0.392
    p = statistics.spearman_two_sided(F.col("rho"), F.col("n")).alias("p")
    shares = {r["grp"]: r["p"] for r in statistics.spearman(timings, ["grp"], "iteration", "ms").select("grp", p).collect()}
    assert round(shares[TERMS.control], 3) == 0.006 and round(shares[TERMS.treatment], 3) == 0.032


def test_tails(spark):
    """Against closed forms: the error function, and Student's with one and two degrees of freedom."""
    tails = spark.createDataFrame([(0.001,), (0.7,), (1.96,), (5.1,), (30.0,)], "x double")
    x = F.col("x")
    found = tails.select(
        "x", statistics.normal_two_sided(x).alias("normal"), statistics.student_two_sided(-x, F.lit(1)).alias("one"),
        statistics.student_two_sided(x, F.lit(2)).alias("two"), statistics.student_two_sided(x, F.lit(1e9)).alias("many"),
        statistics.student_two_sided(x, F.lit(0)).alias("none"),
    )
    for r in found.collect():
        normal = math.erfc(r["x"] / math.sqrt(2))
        assert r["normal"] == pytest.approx(normal, rel=1e-9)
        assert r["one"] == pytest.approx(1 - 2 / math.pi * math.atan(r["x"]), rel=1e-9)
        assert r["two"] == pytest.approx(1 - r["x"] / math.sqrt(2 + r["x"] ** 2), rel=1e-9)
        assert r["x"] > 6 or r["many"] == pytest.approx(normal, rel=1e-5)
        assert r["none"] is None
    ends = spark.createDataFrame([(1.0, 5), (-1.0, 2), (0.0, 5), (0.5, 2)], "rho double, n int")
    shown = [r[0] for r in ends.select(statistics.spearman_two_sided(F.col("rho"), F.col("n"))).collect()]
    assert shown == [0.0, None, pytest.approx(1.0), None]
    assert spark.range(1).select(statistics.normal_two_sided(F.lit(-0.1))).first()[0] == 1.0


def test_overhead(spark, timings):
    summary = statistics.summarise(timings.withColumn("fault", F.lit(TERMS.no_fault)), ["metric", "grp", "fault"], "ms")
    r = logs.overhead_summary(summary, TERMS).first()
    assert (round(r["mean_difference"], 2), round(r["mean_change_pct"], 2)) == (16.13, 5.95)
    assert (r["median_difference"], round(r["median_change_pct"], 2)) == (18.0, 6.68)
    assert spark.range(1).select(guarded_percent(F.lit(8.83), F.lit(0.07))).first()[0] is None


def trials(spark):
    """240 faulty and 60 quiet trials with the published outcomes."""
    rows, load = [], 0
    for fault in (TERMS.connection, TERMS.schema, TERMS.null_data, TERMS.file_missing, TERMS.no_fault):
        for group in (TERMS.control, TERMS.treatment):
            for i in range(1, 31):
                recorded = not (fault == TERMS.connection and group == TERMS.control)
                won = fault == TERMS.no_fault or (group == TERMS.treatment and fault != TERMS.schema)
                load += recorded
                rows.append((group, fault, i, "success" if won else "failed", load if recorded else None,
                             won and fault != TERMS.no_fault))
    frame = spark.createDataFrame(rows, "grp string, fault string, iteration int, outcome string, load_id bigint, healed boolean")
    loads = frame.where("load_id is not null").select("load_id", F.col("healed").alias("auto_resolved"))
    return frame.drop("healed"), loads


def test_success_rates(spark):
    all_trials, loads = trials(spark)
    rates = {(r["grp"], r["fault"]): (r["n_success"], float(r["success_pct"])) for r in reliability.success_rate(all_trials).collect()}
    assert rates[(TERMS.control, TERMS.connection)] == (0, 0.0) and rates[(TERMS.treatment, TERMS.connection)] == (30, 100.0)
    assert rates[(TERMS.treatment, TERMS.schema)] == (0, 0.0) and rates[(TERMS.control, TERMS.no_fault)] == (30, 100.0)
    pivot = {r["fault"]: tuple(r)[1:] for r in reliability.fault_pivot(all_trials).collect()}
    assert [float(v) for v in pivot[TERMS.null_data]] == [0, 0, 30, 100]
    resolved = {r["fault"]: float(r["resolved_pct"]) for r in reliability.auto_resolved_pct(all_trials, loads).collect()}
    assert resolved == {TERMS.connection: 100, TERMS.schema: 0, TERMS.null_data: 100, TERMS.file_missing: 100}


# One published outage, its retries and the load after them, as the logs hold them.
LOG = """2026-09-20 16:20:03,622 - db_utils - INFO - Tentativa 1/3 de conexão
not a log line
2026-09-20 16:20:08,154 - db_utils - INFO - Tentativa 2/3 de conexão
2026-09-20 16:20:14,673 - db_utils - INFO - Tentativa 3/3 de conexão
2026-09-20 16:20:14,681 - db_utils - INFO - Conexão estabelecida após 3 tentativa(s) em 11058 ms
2026-09-20 16:20:14,683 - __main__ - INFO - ID da carga criada: 91
2026-09-20 16:20:14,692 - validador_schema - INFO - Schema validado com sucesso: 59 colunas
2026-09-20 16:20:14,692 - __main__ - INFO - Lendo arquivo: /data/x.csv
2026-09-20 16:20:14,714 - __main__ - INFO - Limpando tabela bronze.tbl_carga_raw...
2026-09-20 16:20:14,963 - __main__ - INFO - Carga concluída com sucesso. Registros inseridos: 267
2026-09-20 16:20:15,000 - __main__ - INFO - Lendo arquivo: again
2026-09-20 16:20:16,000 - db_utils - ERROR - Falha ao conectar após 1 tentativa(s) em 2544 ms: could not translate host name"""
SERVER = """2026-09-20 16:20:00.655 UTC [1] LOG:  received fast shutdown request
2026-09-20 16:20:11.160 UTC [1] LOG:  database system is ready to accept connections
2026-09-20 16:30:00.000 UTC [1] LOG:  received fast shutdown request"""


def test_published_log_format(spark, tmp_path, workspace):
    (tmp_path / "a.log").write_bytes(LOG.replace("x.csv", "x\xff.csv").encode("latin-1").replace(
        "ê".encode("latin-1"), "ê".encode()).decode("latin-1").encode())
    (tmp_path / "b.log").write_text(SERVER)
    events = workspace.table("events", lambda: logs.log_events(spark, str(tmp_path), logtext.PUBLISHED_PHRASES))
    marks = logs.log_landmarks(events).collect()
    assert [m["load_id"] for m in marks] == [91] and marks[0]["rows_logged"] == 267
    assert (marks[0]["finished"] - marks[0]["created"]).total_seconds() == pytest.approx(0.280)
    assert marks[0]["reading"].microsecond == 692000
    outage = logs.outage_timeline(events, logs.retry_sequences(events))
    seconds = {r["interval"]: r["mean_s"] for r in logs.outage_statistics(outage).collect()}
    assert seconds == pytest.approx({
        "shutdown_to_try1": 2.967, "try1_to_try2": 4.532, "try2_to_try3": 6.519, "try3_to_connected": 0.008,
        "outage": 10.505, "ready_to_try3": 3.513, "recovery": 11.058,
    })
    assert logs.connect_failures(events).first()["median"] == 2544
