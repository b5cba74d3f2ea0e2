"""Evidence: windows, coverage, cutoffs, aliases, exclusions, metadata and redirects on small fixtures."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError
from pulsegrid.operators import evidence
from pulsegrid.sources import files

AS_OF = "2026-07-17"


def day(n):
    return f"2026-07-{n:02d}"


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    """Ten good days, one of them empty; two aliases of page 42; foreign rows."""
    records = lambda *rows: {"records": [dict(zip(("project", "article", "views_ceil"), r)) for r in rows]}
    en = "en.wikipedia"
    responses = {day(n): {"error": "down"} for n in (3, 4, 13, 14)}
    responses |= {day(n): records((en, "Alias_A", 300), (en, "Alias_B", 200)) for n in (5, 7, 8, 9, 10, 15)}
    responses |= {day(2): records((en, "Alias_A", 120), ("de.wikipedia", "Fremd", 90)), day(6): records(), day(11): records((en, "Alias_A", 220), (en, "Canonical_A", 25)), day(12): records(("fr.wikipedia", "Autre", 70))}
    page = {"page_id": 42, "canonical_title": "Canonical A", "lead": "lead", "categories": ["x"]}
    document = {"schema_version": "1.0", "source": "test", "daily_responses": responses, "canonical_pages": {"Alias_A": page, "Canonical_A": page, "Alias_B": page | {"page_id": 84, "canonical_title": "Canonical B"}}}
    path = tmp_path_factory.mktemp("evidence") / "fixture.json"
    path.write_text(json.dumps(document))
    return files.read_evidence_fixture(spark, str(path))


@pytest.fixture(scope="module")
def days(spark, fixture):
    return evidence.nominal_days(spark, AS_OF).join(fixture["day_status"], "date")


def test_windows(spark):
    found = evidence.nominal_days(spark, AS_OF).groupBy("window").agg(F.min("date"), F.max("date")).collect()
    assert {r[0]: (str(r[1]), str(r[2])) for r in found} == {"previous": (day(2), day(8)), "current": (day(9), day(15))}
    assert evidence.consecutive_days(evidence.nominal_days(spark, AS_OF)).first()["consecutive"]
    assert not evidence.consecutive_days(evidence.nominal_days(spark, AS_OF).where("date <> DATE '2026-07-05'")).first()["consecutive"]


def test_coverage(days):
    assert {r["window"]: r["successful_days"] for r in evidence.coverage(days).collect()} == {"previous": 5, "current": 5}
    evidence.require_coverage(days)
    with pytest.raises(ContractError, match="previous Effective Window has 3 successful days; at least 4 are required"):
        evidence.require_coverage(days.where("date > DATE '2026-07-05'"))


def test_cutoffs_come_from_all_projects(fixture, days):
    found = {str(r["date"]): r["cutoff"] for r in evidence.daily_cutoffs(fixture["raw_daily"], days).collect()}
    assert len(found) == 10 and found[day(2)] == 90 and found[day(6)] is None and found[day(12)] == 70


def test_aliases_are_added_up(fixture):
    own = evidence.filter_project(fixture["raw_daily"], "en.wikipedia")
    universe = evidence.candidate_universe(own)
    assert sorted(r[0] for r in universe.collect()) == ["Alias_A", "Alias_B", "Canonical_A"]
    pages = fixture["pages"].dropDuplicates(["page_id"])
    resolved = evidence.canonicalize(universe, fixture["aliases"], pages)
    evidence.require_known(resolved)
    assert {r["page_id"]: r["aliases"] for r in evidence.canonical_pages(resolved).collect()} == {42: ["Alias_A", "Canonical_A"], 84: ["Alias_B"]}
    series = {(r["page_id"], str(r["date"])): r["views_ceil"] for r in evidence.page_observations(own, resolved).collect()}
    assert series[42, day(11)] == 245
    counts = {r["reason"]: r["n"] for r in evidence.exclusion_counts(resolved, fixture["raw_daily"], "en.wikipedia").collect()}
    assert counts == {"other_project": 2}


def test_exclusions(spark):
    titles = ["Main_Page", " main page ", "Special:Search", "User talk:X", "Talk:X", "File_talk:X", "Portal", "Category:Y", "A: B"]
    found = spark.createDataFrame([(t,) for t in titles], "t string").select(evidence.exclusion_reason(F.col("t"))).collect()
    assert [r[0] for r in found] == ["main_page", "main_page", "technical_namespace:special", "technical_namespace:user talk", None, None, None, "technical_namespace:category", None]


def test_exclusion_map(spark):
    counts = spark.createDataFrame([("unavailable", 2), ("technical_namespace:special", 1), ("technical_namespace:file", 3)], "reason string, n long")
    r = evidence.exclusion_map(counts).first()
    assert (r["unavailable"], r["main_page"], r["technical_namespaces"]) == (2, 0, {"special": 1, "file": 3})


def test_unknown_title_is_refused(spark):
    resolved = evidence.canonicalize(spark.createDataFrame([("a",)], "article string"), spark.createDataFrame([], "alias string, page_id long"), spark.createDataFrame([], "page_id long, canonical_title string, unavailable boolean"))
    with pytest.raises(ContractError):
        evidence.require_known(resolved)


def test_metadata(spark):
    rows = [(1, "A", "", ["x"]), (1, "A", "lead", ["y", "x"]), (2, "B", "one", []), (2, "B", "two", []), (3, "C", "", ["z"]), (3, "D", "", [])]
    merged = evidence.merge_metadata(spark.createDataFrame(rows, "page_id long, canonical_title string, lead string, categories array<string>"))
    found = {r["page_id"]: (r["lead"], r["categories"], r["conflict"]) for r in merged.collect()}
    assert found[1] == ("lead", ["x", "y"], False) and found[2][2] and found[3][2]
    with pytest.raises(ContractError):
        evidence.require_no_conflict(merged)


def test_redirect_chains_and_cycles(spark):
    links = [(f"n{i}", f"n{i + 1}") for i in range(17)] + [("a", "b"), ("b", "a")]
    out = evidence.resolve_redirects(spark.createDataFrame([("n0",), ("n17",), ("a",), ("free",)], "title string"), spark.createDataFrame(links, "source string, target string"))
    assert {r["title"]: r["final"] for r in out.collect()} == {"n0": "n17", "n17": "n17", "a": None, "free": "free"}


@pytest.mark.parametrize("hops", [40, 1000])
def test_long_redirect_chains(spark, hops):
    links = [(f"n{i}", f"n{i + 1}") for i in range(hops)] + [("a", "b"), ("b", "c"), ("c", "a")] + [(f"t{i}", f"t{i + 1}" if i < 9 else "a") for i in range(10)]
    out = evidence.resolve_redirects(spark.createDataFrame([("n0",), ("n1",), ("t0",), ("b",)], "title string"), spark.createDataFrame(links, "source string, target string"))
    assert {r["title"]: r["final"] for r in out.collect()} == {"n0": f"n{hops}", "n1": f"n{hops}", "t0": None, "b": None}


def test_batches(spark):
    universe = spark.createDataFrame([(f"t{i:04d}",) for i in range(120)], "article string")
    found = {r["article"]: r["batch"] for r in evidence.metadata_batches(universe).collect()}
    assert [found[f"t{i:04d}"] for i in (0, 49, 50, 119)] == [0, 0, 1, 2]


def test_landed_responses(spark, tmp_path):
    body = {"items": [{"country": "US", "year": "2025", "month": "07", "day": "15", "articles": [{"article": "A", "project": "p", "views_ceil": 100}]}]}
    (tmp_path / "a.json").write_text(json.dumps(body))
    assert files.read_top_pages(spark, str(tmp_path)).first().asDict() == {"date": datetime.date(2025, 7, 15), "project": "p", "article": "A", "views_ceil": 100}


def test_broken_fixture(spark, tmp_path):
    path = tmp_path / "f.json"
    path.write_text('{"schema_version": "9"}')
    with pytest.raises(ContractError):
        files.read_evidence_fixture(spark, str(path))


def test_frozen_embeddings_must_be_complete(spark):
    texts = spark.createDataFrame([(1, "a"), (2, "b")], "page_id long, text string")
    vectors = spark.createDataFrame([("a", [1.0])], "text string, vector array<double>")
    with pytest.raises(ContractError):
        files.frozen_embeddings(texts, vectors)
