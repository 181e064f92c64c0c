"""A log parsed as it grows against the same log parsed at once."""

import random

import pytest

from lumenlake.plans import logs
from lumenlake.plans.logstore import LogStore
from lumenlake.sources.logtext import DERIVED_PHRASES

STEPS = [
    "__main__|Load id created: {}", "schema_check|Schema valid", "__main__|Reading file: x", "__main__|Clearing raw",
    "__main__|Raw cleared", "__main__|Writing history", "__main__|History copied", "__main__|Load finished. Rows inserted: {}",
]
RETRY = ["db_utils|Attempt 1/3", "db_utils|Attempt 2/3", "db_utils|Attempt 3/3", "db_utils|Connected after 3 attempt(s) in 1{} ms"]


def log(loads):
    """Lines of loads, some cut short, some created again, with retries and other lines between them."""
    draw = random.Random(4)
    out, second = [], 0
    for n in range(loads):
        load_id = n if n % 5 else max(n - 1, 0)
        steps = STEPS[: draw.choice([3, 8, 8])]
        for text in ["database|received fast shutdown request"] + (RETRY if n % 3 == 0 else RETRY[:2]) + steps + ["other|noise"]:
            origin, message = text.format(load_id).split("|")
            second += draw.randint(0, 1)
            out.append(f"2026-01-01 {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d},000 - {origin} - INFO - {message}")
    return out


def write(folder, number, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"day {number}.log").write_text("\n".join(lines) + "\n")


def rows(frame):
    return sorted(map(tuple, frame.select(sorted(frame.columns)).collect()), key=repr)


def whole(spark, workspace, folder):
    events = workspace.table("events", lambda: logs.log_events(spark, str(folder), DERIVED_PHRASES))
    return rows(logs.log_landmarks(events)), rows(logs.retry_sequences(events))


def test_every_cut_gives_the_log_parsed_at_once(spark, workspace, tmp_path):
    lines = log(12)
    cuts = [0, 3, 5, 17, 18, 60, len(lines)]  # inside loads and retry sequences
    store = LogStore(spark, str(tmp_path / "store"), DERIVED_PHRASES)
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        write(tmp_path / "log", i, lines[a:b])
        assert store.ingest(str(tmp_path / "log")) == 1
    assert store.ingest(str(tmp_path / "log")) == 0
    found = rows(store.landmarks()), rows(store.retry_sequences())
    assert found == whole(spark, workspace, tmp_path / "log") and len(found[0]) > 5 and len(found[1]) == 4


def test_a_call_reads_new_files_alone(spark, workspace, tmp_path, monkeypatch):
    lines = log(6)
    store = LogStore(spark, str(tmp_path / "store"), DERIVED_PHRASES)
    read = []
    scan = logs.logtext.scan_log
    monkeypatch.setattr(logs.logtext, "scan_log", lambda s, paths, **k: read.append(paths) or scan(s, paths, **k))
    for i, part in enumerate((lines[:20], ["nothing of a load"], lines[20:])):
        write(tmp_path / "log", i, part)
        store.ingest(str(tmp_path / "log"))
    assert [[p.rsplit("/", 1)[1] for p in paths] for paths in read] == [["day 0.log"], ["day 1.log"], ["day 2.log"]]
    monkeypatch.undo()
    assert (rows(store.landmarks()), rows(store.retry_sequences())) == whole(spark, workspace, tmp_path / "log")


def test_an_interrupted_call_is_repeated(spark, workspace, tmp_path, monkeypatch):
    lines = log(6)
    store = LogStore(spark, str(tmp_path / "store"), DERIVED_PHRASES)
    write(tmp_path / "log", 0, lines[:20])
    store.ingest(str(tmp_path / "log"))
    before = rows(store.landmarks())
    write(tmp_path / "log", 1, lines[20:])
    real = logs.retry_parts
    monkeypatch.setattr(logs, "retry_parts", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.ingest(str(tmp_path / "log"))
    assert rows(store.landmarks()) == before
    monkeypatch.setattr(logs, "retry_parts", real)
    assert store.ingest(str(tmp_path / "log")) == 1
    assert (rows(store.landmarks()), rows(store.retry_sequences())) == whole(spark, workspace, tmp_path / "log")


def test_changed_and_misplaced_files_are_refused(spark, tmp_path):
    store = LogStore(spark, str(tmp_path / "store"), DERIVED_PHRASES)
    with pytest.raises(ValueError, match="no log file"):
        store.landmarks()
    write(tmp_path / "log", 5, log(2))
    store.ingest(str(tmp_path / "log"))
    write(tmp_path / "log", 3, log(2))
    with pytest.raises(ValueError, match="before a parsed one"):
        store.ingest(str(tmp_path / "log"))
    write(tmp_path / "later", 5, log(1))
    write(tmp_path / "log", 5, log(3))
    with pytest.raises(ValueError, match="has changed"):
        store.ingest(str(tmp_path / "log"))
