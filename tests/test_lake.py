"""Files to lake: scans, faults, quarantine, repeated loads, reports."""

import csv
import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lumenlake import contract
from lumenlake.contract import ENGLISH_TERMS, PUBLISHED_TERMS as TERMS
from lumenlake.plans import export, gold, masking, reliability, reports
from lumenlake.plans.lake import KEYS, Attempt, Lake, LoadFailed, _in_months
from lumenlake.registry.relations import Relations
from lumenlake.sources import derived, extract, locate

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lines(spark):
    rows = derived.bills_raw(spark, SF).orderBy(F.col("line_no").cast("bigint")).limit(267).collect()
    good = [dict(r.asDict(), municipality=r["municipality"] or "M", bill_amount=r["bill_amount"] or "5,00") for r in rows]
    for r in good:
        if r["due_on"] == "31/02/2024":
            r["due_on"] = "01/02/2024"
    return [[r[n] for n in contract.NAMES] for r in good]


def write(path, lines, headers=contract.HEADERS, bom=True, end="\r\n"):
    text = end.join(";".join(r) for r in [headers, *lines])
    path.write_bytes((("﻿" if bom else "") + text).encode())
    return str(path)


def blanked(lines):
    """Ten blank amounts and five blank municipalities, drawn as the published trials drew them."""
    draw = random.Random(42)
    amount, place = contract.HEADERS.index("VALOR_FATURA"), contract.HEADERS.index("MUNICIPIO")
    copy = [list(r) for r in lines]
    for i in draw.sample(range(len(lines)), 10):
        copy[i][amount] = ""
    for i in draw.sample(range(len(lines)), 5):
        copy[i][place] = ""
    return copy


def test_scan_keeps_blanks_and_ignores_column_order(spark, tmp_path, lines):
    path = write(tmp_path / "a.csv", [r[::-1] for r in lines], contract.HEADERS[::-1])
    found = extract.scan_extract(spark, path).select(*contract.NAMES).collect()
    assert sorted(tuple(r) for r in found) == sorted(tuple(r) for r in lines)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_row_numbers_over_many_splits(spark, tmp_path, lines, small_splits):
    path = write(tmp_path / "a.csv", lines * 4)
    with extract.pinned_splits(spark):
        scan = extract.scan_extract(spark, path)
        assert scan.rdd.getNumPartitions() > 4
        offsets = F.broadcast(extract.split_offsets(scan))
        numbered = extract.with_row_numbers(scan, offsets).select("row_number", "bill_number")
        assert "Exchange hashpartitioning(_file" not in numbered._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
        found = numbered.collect()
    at = contract.NAMES.index("bill_number")
    assert sorted(tuple(r) for r in found) == [(i + 1, r[at]) for i, r in enumerate(lines * 4)]


def _quoted(value):
    return '"' + value.replace('"', '""') + '"'


@pytest.mark.parametrize("seed", range(3))
def test_quoted_records_over_many_splits(spark, tmp_path, lines, small_splits, seed):
    """Line breaks, separators and quotes in first, middle and last fields, records longer than a split, blank lines."""
    draw = random.Random(seed)
    odd = ["two\nlines", 'a "quoted" word\n', "\n\n;\n", "x;y", "long " * 6000 + "\nend", "", "plain", "\r\n"]
    rows = [[draw.choice(odd) if i in (0, 30, 58) and draw.random() < 0.5 else v for i, v in enumerate(r)] for r in lines[:200]]
    body = [";".join(_quoted(v) if set(v) & set('";\r\n') else v for v in r) for r in rows]
    ends = ["\r\n", "\n", "\n\n"]
    text = "\ufeff" + ";".join(contract.HEADERS) + "\n" + "".join(r + draw.choice(ends) for r in body)
    (tmp_path / "a.csv").write_bytes(text.encode())
    with extract.pinned_splits(spark):
        scan = extract.scan_extract(spark, str(tmp_path / "a.csv"), multiline=True)
        kept = scan.write.mode("overwrite").parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    assert kept.select("_start").distinct().count() > 4
    found = extract.with_row_numbers(kept, extract.split_offsets(kept)).orderBy("row_number").collect()
    assert [r["row_number"] for r in found] == list(range(1, len(rows) + 1))
    assert [[r[c] for c in contract.NAMES] for r in found] == rows
    assert not any(r["too_long"] or r["open_quote"] for r in found)


def test_unfinished_quotes_and_empty_files(spark, tmp_path, lines):
    head = ";".join(contract.HEADERS) + "\n"
    (tmp_path / "a.csv").write_text(head + ";".join(lines[0]) + '\n"never ends\n' + ";".join(lines[1]))
    (tmp_path / "b.csv").write_text(head)
    with extract.pinned_splits(spark):
        found = extract.scan_extract(spark, str(tmp_path), multiline=True).orderBy("_file", "_at").collect()
    assert [(r["open_quote"], r["_at"]) for r in found] == [(False, 0), (True, 1)]


def test_a_load_reads_its_extract_once(spark, tmp_path, lines):
    """The stored rows know split and place; counting them reads no more of the files."""
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.load(write(tmp_path / "a.csv", lines), 1)
    files = lake.history().inputFiles()
    assert files and not any("a.csv" in f for f in files)
    assert [r["row_number"] for r in lake.history().orderBy("row_number").collect()] == list(range(1, len(lines) + 1))
    group = "one-load"
    spark.sparkContext.setJobGroup(group, "jobs of a load")
    lake.load(str(tmp_path / "a.csv"), 2)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert jobs <= 12


def test_null_data_goes_to_quarantine(spark, tmp_path, lines):
    lake = Lake(spark, str(tmp_path / "lake"))
    event = lake.load(write(tmp_path / "Amostra.csv", blanked(lines)), 7)
    assert (event["n_rows"], event["n_quarantined"], event["status"]) == (252, 15, "SUCESSO")
    assert (event["fault_type"], event["mechanism"], event["auto_resolved"]) == ("DADOS_NULOS", "QUARENTENA", True)
    held = lake.quarantine().orderBy("line_no").collect()
    assert [r["line_no"] for r in held] == [13, 16, 17, 45, 48, 53, 58, 72, 112, 115, 120, 126, 141, 217, 259]
    reasons = {r["reason"] for r in held}
    assert reasons == {"Campos obrigatórios nulos: ['VALOR_FATURA']", "Campos obrigatórios nulos: ['MUNICIPIO']"}
    lake.record_trial(trial_id=1, grp=TERMS.treatment, fault=TERMS.null_data, iteration=1,
                      injected_at=datetime(2026, 9, 1), outcome="success", load_id=7, event_at=datetime(2026, 9, 1))
    found = reliability.quarantine_by_reason(lake.quarantine(), lake.trials()).collect()
    assert sorted((r["n_rows"], r["n_loads"]) for r in found) == [(5, 1), (10, 1)]
    share = reliability.quarantine_yield(lake.trials(), lake.loads()).first()
    assert (share["n_inserted"], share["n_quarantined"], float(share["yield_pct"])) == (252, 15, 94.38)


def test_without_healing_the_first_bad_row_fails_the_load(spark, tmp_path, lines):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.load(write(tmp_path / "ok.csv", lines), 1)
    with pytest.raises(LoadFailed, match="VALOR_FATURA|MUNICIPIO"):
        lake.load(write(tmp_path / "bad.csv", blanked(lines)), 2, self_healing=False)
    failed = lake.loads().where("load_id = 2").first()
    assert (failed["status"], failed["fault_type"], failed["mechanism"]) == ("ERRO", "DADOS_NULOS", "NENHUM")
    assert failed["n_quarantined"] == 0 and failed["n_rows"] is None
    assert lake.raw().select("load_id").distinct().collect()[0][0] == 1 and lake.history().count() == 267


def test_header_fault(spark, tmp_path, lines):
    renamed = [h.replace("VALOR_FATURA", "VALOR_FAT") for h in contract.HEADERS]
    path = write(tmp_path / "a.csv", lines, renamed)
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(LoadFailed):
        lake.load(path, 1)
    found = lake.loads().first()
    assert found["error"] == (
        "Schema inválido: 2 colunas faltando, 2 colunas extras. Faltando: ['VALOR_FATURA', 'VALOR_FATURA_SUB']."
        " Extras: ['VALOR_FAT', 'VALOR_FAT_SUB']"
    )
    assert (found["fault_type"], found["mechanism"]) == ("SCHEMA", "VALIDACAO_SCHEMA")
    with pytest.raises(LoadFailed, match="VALOR_FATURA"):
        lake.load(path, 2, self_healing=False)
    assert lake.loads().where("load_id = 2").first()["fault_type"] == "DADOS_NULOS"


def test_unreadable_files_are_header_faults(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    lake = Lake(spark, str(tmp_path / "lake"))
    for load_id, name in enumerate(("empty.csv", "absent.csv"), 1):
        with pytest.raises(LoadFailed, match="Não foi possível ler"):
            lake.load(str(tmp_path / name), load_id)
    assert {(r["status"], r["fault_type"]) for r in lake.loads().collect()} == {("ERRO", "SCHEMA")}


def test_ragged_and_inadmissible_rows(spark, tmp_path, lines):
    short, long, letters = list(lines[0])[:-3], list(lines[1]) + ["more"], list(lines[2])
    letters[0] = "12x"
    lake = Lake(spark, str(tmp_path / "lake"))
    event = lake.load(write(tmp_path / "a.csv", [short, long, letters, lines[3]]), 1)
    assert (event["n_rows"], event["n_quarantined"]) == (2, 2)
    assert sorted(r["line_no"] for r in lake.quarantine().collect()) == [2, 3]


def test_all_rows_bad_is_an_error_but_kept(spark, tmp_path, lines):
    at = contract.HEADERS.index("MUNICIPIO")
    bad = [r[:at] + [" "] + r[at + 1:] for r in lines[:5]]
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(LoadFailed):
        lake.load(write(tmp_path / "a.csv", bad), 1)
    assert lake.loads().first()["status"] == "ERRO" and lake.quarantine().count() == 5


def test_fallback_to_the_newest_candidate(spark, tmp_path, lines):
    import os

    inbox = tmp_path / "in"
    inbox.mkdir()
    for age, name in ((50, "Amostra_old.csv"), (10, "Amostra_new.csv"), (0, "Other.csv")):
        write(inbox / name, lines[:3])
        stamp = 1_700_000_000 - age
        os.utime(inbox / name, (stamp, stamp))
    lake = Lake(spark, str(tmp_path / "lake"))
    event = lake.load_file(str(inbox), "Main.csv", 1, attempt=Attempt(3, 11066))
    assert event["file_name"] == "Amostra_new.csv" and event["fault_type"] == "CONEXAO"
    assert event["mechanism"] == "RETRY_BACKOFF+FALLBACK_ARQUIVO" and event["auto_resolved"]
    with pytest.raises(LoadFailed, match="switched off"):
        lake.load_file(str(inbox), "Main.csv", 2, self_healing=False)
    missing = lake.loads().where("load_id is null").first()
    assert (missing["file_name"], missing["mechanism"], missing["attempts"]) == ("(ausente)", "FALLBACK_ARQUIVO", 1)
    assert locate.locate(spark, str(inbox), "Other.csv").path.endswith("Other.csv")
    assert locate.locate(spark, str(tmp_path / "lake"), "x.csv").message.endswith("Amostra*.csv")


def counts(lake):
    return {name: lake.table(name).count() for name in KEYS}


def test_repeating_a_load_changes_nothing(spark, tmp_path, lines):
    lake = Lake(spark, str(tmp_path / "lake"))
    path = write(tmp_path / "a.csv", lines)
    lake.load(path, 1)
    lake.normalise()
    first = counts(lake)
    assert first["bills"] > 0 and first["levies"] > 0
    lake.load(path, 1)
    lake.normalise()
    assert counts(lake) == first and lake.history().count() == 267
    lake.load(path, 2)
    lake.normalise()
    assert counts(lake) == first and lake.history().count() == 534
    assert reliability.history_load_bounds(lake.history()).count() == 2
    names = lake.serve()
    assert set(names) == {"levy_base", *gold.VIEWS}
    total = spark.sql("select sum(levy_billed - levy_collected) from levy_base").first()[0]
    assert spark.sql("select sum(levy_loss) from levy_loss_by_district").first()[0] == total
    assert lake.preview("bills").count() == 100
    month = spark.table("levy_base").first()["month"]
    filtered = gold.consumption_by_district(spark.table("levy_base"), F.col("month") == month)
    assert filtered.select("month").distinct().count() == 1


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([("A", 1), ("B", None)], "name string, n int")
    export.write_csv(rows.coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.csv")).read_bytes()
    assert text.startswith(b"\xef\xbb\xbfname,n") and b"B," in text
    report = export.markdown_report("T", {"one": rows, "none": rows.where("false")})
    assert "| B |  |" in report and "| (sem dados) | (sem dados) |" in report


def test_masking_contract():
    with pytest.raises(ValueError, match="CEP"):
        masking.require_columns([h for h in contract.HEADERS if h != "CEP"])
    masking.require_columns(contract.HEADERS)


def test_a_failure_after_the_header_check_ends_the_load(spark, tmp_path, lines, monkeypatch):
    path = write(tmp_path / "a.csv", lines)
    lake = Lake(spark, str(tmp_path / "lake"))
    monkeypatch.setattr("lumenlake.sources.extract.split_offsets", lambda *_: 1 / 0)
    with pytest.raises(LoadFailed, match="ZeroDivisionError"):
        lake.load(path, 1)
    row = lake.loads().first()
    assert row["status"] == TERMS.error and row["ended_at"] is not None and "ZeroDivisionError" in row["error"]
    monkeypatch.undo()
    lake.load(path, 1)
    assert lake.raw().count() == len(lines)


def test_the_latest_load_is_the_one_released_last(spark, tmp_path, lines):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.load(write(tmp_path / "a.csv", lines[:20]), 5)
    lake.load(write(tmp_path / "b.csv", lines[20:50]), 3)
    assert {r["load_id"] for r in lake.raw().select("load_id").distinct().collect()} == {3}
    assert lake.raw().count() == 30


def test_dropped_payments_and_rebills_are_kept_as_rejects(spark, tmp_path, lines):
    copy = [list(r) for r in lines[:12]]
    names = contract.NAMES
    for r in copy:
        r[names.index("paid_on")], r[names.index("paid_amount")] = "01/02/2024", "5,00"
        r[names.index("rebilled")], r[names.index("rebilled_on")] = "", ""
    copy[3][names.index("paid_amount")] = ""
    copy[7][names.index("rebilled")] = contract.YES_WORDS[0]
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.load(write(tmp_path / "a.csv", copy), 1)
    lake.normalise()
    assert sorted(r["fault"] for r in lake.rejects().collect()) == ["payment without amount", "rebill without date"]
    lake.normalise()
    assert lake.rejects().count() == 2


def test_a_header_without_rows_goes_all_the_way(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    write(tmp_path / "empty.csv", [[]], end="\n")
    try:
        lake.load(str(tmp_path / "empty.csv"), 1)
    except LoadFailed:
        assert lake.loads().first()["status"] == TERMS.error
    else:
        lake.normalise()
        assert lake.table("bills").count() == 0


def test_files_of_a_folder_may_differ_in_column_order(spark, tmp_path, lines):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", lines[:30])
    write(tmp_path / "in" / "b.csv", [r[::-1] for r in lines[30:70]], contract.HEADERS[::-1])
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.load(str(tmp_path / "in"), 1)
    names = ("customer_name", "district", "installation")
    at = [contract.NAMES.index(n) for n in names]
    found = sorted(tuple(r[n] for n in names) for r in lake.raw().collect())
    assert found == sorted(tuple(r[i] for i in at) for r in lines[:70])
    assert sorted(r["row_number"] for r in lake.raw().collect()) == list(range(1, 71))


def test_every_faulty_header_of_many_files_is_named(spark, tmp_path, lines):
    (tmp_path / "in").mkdir()
    for i in range(70):
        headers = contract.HEADERS if i % 30 else ["X", *contract.HEADERS[1:]]
        write(tmp_path / "in" / f"f{i:02}.csv", lines[:2], headers)
    assert len(extract.header_rows(spark, str(tmp_path / "in"))) == 70
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(LoadFailed) as failed:
        lake.load(str(tmp_path / "in"), 1)
    assert [name for name in ("f00", "f01", "f30", "f60") if name in str(failed.value)] == ["f00", "f30", "f60"]


def test_quoted_line_breaks(spark, tmp_path, lines):
    """One record when the load allows for it, named for what it is when not."""
    rows = [list(r) for r in lines[:3]]
    rows[1][contract.NAMES.index("complement")] = '"UNIT 1\nREAR; LEFT"'
    path = write(tmp_path / "a.csv", rows)
    lake = Lake(spark, str(tmp_path / "lake"))
    event = lake.load(path, 1, multiline=True)
    assert (event["n_rows"], event["n_quarantined"]) == (3, 0)
    found = {r["row_number"]: r["complement"] for r in lake.raw().collect()}
    assert sorted(found) == [1, 2, 3] and found[2] == "UNIT 1\nREAR; LEFT"
    event = lake.load(path, 2)
    assert (event["n_rows"], event["n_quarantined"]) == (2, 2)
    held = lake.quarantine().where("load_id = 2").collect()
    assert len(held) == 2 and all(r["reason"].startswith("A quoted field") for r in held)


def test_all_reports_are_written(spark, tmp_path):
    """Every file read back: the tables, the timings, and the document that shows them."""
    r = Relations(spark, SF)
    paths = reports.write_reports(str(tmp_path / "out"), r.trials(), r.loads(), r.landmarks(), ENGLISH_TERMS)
    assert [p.rsplit("/", 1)[-1] for p in paths] == [reports.TIMINGS, *reports.TABLES, reports.DOCUMENT]
    read = lambda p: [row for f in sorted(Path(p).glob("part-*")) for row in list(csv.reader(f.open(encoding="utf-8-sig")))[1:]]
    assert len(read(paths[0])) == r.timings().count()
    rates = read(paths[1])
    expected = reliability.success_rate(r.trials()).orderBy("fault", "grp").collect()
    assert rates == [[str(v) for v in row] for row in expected]
    document = "\n".join(f.read_text() for f in sorted(Path(paths[-1]).glob("part-*")))
    for heading, _ in reports.TABLES.values():
        assert f"## {heading}" in document
    assert all("| " + " | ".join(row) + " |" in document for row in rates)

    none = reports.write_reports(
        str(tmp_path / "none"), r.trials().where("false"), r.loads(), r.landmarks(), ENGLISH_TERMS
    )
    document = "\n".join(f.read_text() for f in sorted(Path(none[-1]).glob("part-*")))
    assert document.count("(sem dados)") >= len(reports.TABLES) and read(none[1]) == []


def test_serving_refreshes_the_months_a_load_touched(spark, tmp_path, lines):
    """A second load with one new bill and one late payment: the base equals one written as a whole."""
    month, number, paid, amount = (contract.NAMES.index(n) for n in ("billing_month", "bill_number", "paid_on", "paid_amount"))
    subclass = contract.NAMES.index("consumption_subclass")
    matched = [r for r in lines if r[subclass] != "UNKNOWN" and r[paid]]
    fresh, late = list(matched[0]), list(next(r for r in matched if r[month] != matched[0][month]))
    fresh[number], fresh[month] = "0999999999999999", "203001"
    late[paid], late[amount] = "01/02/2031", "3,00"
    lake = Lake(spark, str(tmp_path / "lake"))
    for load_id, rows in ((1, lines), (2, [fresh, late])):
        lake.load(write(tmp_path / f"{load_id}.csv", rows), load_id)
        lake.normalise()
        if load_id == 2:
            assert {r[0] for r in lake._touched(lake.table("bills")).collect()} == {"203001", late[month]}
        views = lake.serve()
    found = sorted(map(repr, lake.served().collect()))
    lake.serve(whole=True)
    assert found == sorted(map(repr, lake.served().collect())) and len(views) == 14


def test_preview_of_every_layer(spark, tmp_path, lines):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.run(str(Path(write(tmp_path / "Main.csv", blanked(lines))).parent), "Main.csv", 1)
    lake.record_trial(trial_id=1, grp="A", fault="B", iteration=1, outcome="success", load_id=1, event_at=datetime(2026, 1, 1))
    for name in ("raw", "history", "quarantine", "rejects", "loads", "trials", "levy_base", *KEYS, *gold.VIEWS):
        rows = lake.preview(name, 5)
        first = rows.columns[0]
        shown = [r[first] for r in rows.collect()]
        assert len(shown) <= 5 and shown == sorted(shown, key=lambda v: (v is not None, v))
    assert [r["line_no"] for r in lake.preview("raw", 3).collect()] == sorted(r["line_no"] for r in lake.raw().collect())[:3]


def test_a_load_is_compared_with_its_own_months(spark, tmp_path, lines):
    """The filter that keeps other months out reaches the scan of the earlier rows."""
    lake = Lake(spark, str(tmp_path / "lake"))
    path = write(tmp_path / "a.csv", lines)
    lake.load(path, 1)
    lake.normalise()
    before = {name: lake.table(name).count() for name in KEYS}
    text = lake.table("payments").where(_in_months(["199601"]))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in text and "billing_month" in text
    lake.load(path, 2)
    lake.normalise()
    assert {name: lake.table(name).count() for name in KEYS} == before
