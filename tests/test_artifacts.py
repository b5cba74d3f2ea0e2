"""Evidence as a source: what is foreign, broken or malformed is refused; progress that a run tells."""

import io
import json
from datetime import date, timedelta
from pathlib import Path

import pytest

from pulsegrid.contracts import ContractError
from pulsegrid.operators import ledger
from pulsegrid.sources import artifacts
from pulsegrid.streaming import events
from pulsegrid.streaming.progress import ProgressLog

FIRST = date(2026, 7, 2)


@pytest.fixture(scope="module")
def whole(spark):
    """Proper evidence: two pages, one day unavailable."""
    day = [FIRST + timedelta(n) for n in range(14)]
    rows = {
        "days": [(d, "previous" if n < 7 else "current", "unavailable" if n == 3 else "successful") for n, d in enumerate(day)],
        "cutoffs": [(d, None if n == 5 else 100) for n, d in enumerate(day) if n != 3],
        "pages": [(1, "A", ["A", "a"], "", []), (2, "B", ["B"], "x" * 600, ["c", "k"])],
        "observations": [(1, day[0], 0), (1, day[4], 300), (2, day[13], 500)],
        "exclusions": [(0, 1, 2, {"file": 3})],
    }
    return {n: spark.createDataFrame(r, artifacts.EVIDENCE[n]) for n, r in rows.items()}


def told(tables):
    return sorted(tuple(r) for r in artifacts.evidence_faults(tables).collect())


def test_proper_evidence_is_read(spark, whole, tmp_path):
    folder = str(tmp_path / "evidence")
    with pytest.raises(ContractError, match="absent"):
        artifacts.read_evidence(spark, folder, "r1")
    ledger.write_stage(spark, folder, "r1", "evidence", {"project": "p"}, {}, whole)
    envelope, tables = artifacts.read_evidence(spark, folder, "r1")
    assert envelope["configuration"] == {"project": "p"} and tables["pages"].count() == 2
    with pytest.raises(ContractError, match="not a complete one of this run"):
        artifacts.read_evidence(spark, folder, "r2")
    empty = whole | {n: whole[n].limit(0) for n in ("pages", "observations")}
    assert told(empty) == []


def test_other_shapes_are_refused(spark, whole, tmp_path):
    for n, tables in enumerate(({k: v for k, v in whole.items() if k != "cutoffs"}, whole | {"pages": whole["pages"].drop("lead")}, whole | {"observations": whole["observations"].selectExpr("page_id", "date", "CAST(views_ceil AS STRING) AS views_ceil")}, whole | {"days": whole["days"].selectExpr("*", "1 AS more")})):
        ledger.write_stage(spark, str(tmp_path / str(n)), "r1", "evidence", {}, {}, tables)
        with pytest.raises(ContractError, match="lacks cutoffs|schema-incompatible"):
            artifacts.read_evidence(spark, str(tmp_path / str(n)), "r1")
    artifacts.require_shape({n: df.select(*reversed(df.columns)) for n, df in whole.items()} | {"further": whole["days"]})


def test_every_rule(spark, whole, tmp_path):
    make = lambda n, *rows: whole[n].unionByName(spark.createDataFrame(list(rows), artifacts.EVIDENCE[n]))
    later = FIRST + timedelta(40)
    pages = make("pages", (None, "N", ["n"], "", []), (3, "", ["n"], "", []), (4, "D", ["n"], "x" * 601, []), (5, "E", [], "", []), (6, "F", ["n", "n"], "", []), (7, "G", ["n"], "", ["c", None]), (8, "H", ["n"], None, []), (2, "B", ["B"], "", []))
    assert {(r["key"], r["fault"]) for r in artifacts.evidence_faults(whole | {"pages": pages}).collect()} == {("2", "repeated"), (None, "page_id"), ("3", "title"), ("4", "lead"), ("5", "aliases"), ("6", "aliases"), ("7", "categories"), ("8", "lead")}
    seen = make("observations", (9, FIRST, 1), (1, later, 1), (1, FIRST + timedelta(3), 1), (2, FIRST, -1), (2, FIRST + timedelta(1), None), (1, FIRST, 0), (None, None, 1))
    assert {(r["key"], r["fault"]) for r in artifacts.evidence_faults(whole | {"observations": seen}).collect()} == {("9/2026-07-02", "page"), ("1/2026-08-11", "day"), ("1/2026-07-05", "day"), ("2/2026-07-02", "views"), ("2/2026-07-03", "views"), ("1/2026-07-02", "repeated"), ("null/null", "page")}
    cutoffs = make("cutoffs", (FIRST + timedelta(3), 100), (FIRST, 100)).where("date <> '2026-07-15'")
    assert told(whole | {"cutoffs": cutoffs}) == [("cutoffs", "2026-07-02", "repeated"), ("cutoffs", "2026-07-05", "day"), ("cutoffs", "2026-07-15", "missing")]
    gone = whole | {"days": whole["days"].where("date <> '2026-07-06'"), "observations": whole["observations"].limit(0)}
    assert {("days", "2026-07-07", "gap"), ("days", "13", "number of days"), ("cutoffs", "2026-07-06", "day")} <= set(told(gone))
    idle = whole["days"].selectExpr("date", "window", "CASE WHEN window = 'current' AND date <= '2026-07-12' THEN 'unavailable' ELSE status END AS status")
    assert ("days", "current", "coverage") in told(whole | {"days": idle})
    assert told(whole | {"exclusions": make("exclusions", (-1, 0, 0, {}), (0, 0, 0, {"x": -1}))}) == [("exclusions", "3", "number of rows"), ("exclusions", "counters", "counter"), ("exclusions", "counters", "counter")]
    ledger.write_stage(spark, str(tmp_path / "e"), "r1", "evidence", {}, {}, whole | {"cutoffs": cutoffs})
    with pytest.raises(ContractError, match="not in order: cutoffs"):
        artifacts.read_evidence(spark, str(tmp_path / "e"), "r1")


def test_envelopes_are_listed(spark, whole, tmp_path):
    for name in ("own", "other"):
        ledger.write_stage(spark, str(tmp_path / name), name, "evidence", {}, {}, {"days": whole["days"]})
    good = json.loads((tmp_path / "own" / "artifact.json").read_text())
    for name, text in (("partial", json.dumps(good | {"status": "running"})), ("old", json.dumps(good | {"schema_version": "1.0"})), ("late", json.dumps(good | {"stage": "portfolio"})), ("torn", json.dumps(good)[:40]), ("list", "[1]"), ("empty", "")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "artifact.json").write_text(text)
    found = {Path(r["path"]).parent.name: r["fault"] for r in artifacts.scan_envelopes(spark, f"{tmp_path}/*/artifact.json", "own", "evidence").collect()}
    found.pop("empty", None)  # a file without a byte is no row
    assert found == {"own": None, "other": "run", "partial": "incomplete", "old": "version", "late": "stage", "torn": "unreadable", "list": "unreadable"}


def test_progress_goes_on_after_a_restart(spark, tmp_path):
    lines = io.StringIO()
    log = ProgressLog(spark, str(tmp_path), "r1", lines)
    log.emit("evidence", "start", "begins")
    log.emit("evidence", "review", "goes on", progress=(2, 5))
    other = ProgressLog(spark, str(tmp_path), "r1")
    assert other.last == 2
    other.emit("evidence", "complete", "ends", "warning")
    for wrong in (lambda: log.record(2, "evidence", "again", "x"), lambda: log.emit("evidence", "taken", "x"), lambda: other.emit("evidence", "much", "x", progress=(6, 5))):
        with pytest.raises(ContractError):
            wrong()
    assert lines.getvalue() == "[evidence:start] begins\n[evidence:review] goes on (2/5)\n"
    rows = events.guarded(events.read_events(spark, log.folder)).orderBy("sequence").collect()
    assert [(r["sequence"], r["operation"], r["level"], r["fault"]) for r in rows] == [(1, "start", "info", None), (2, "review", "info", None), (3, "complete", "warning", None)]
