"""Narratives, publication and events."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError
from pulsegrid.operators import narrative, publish
from pulsegrid.streaming import events


def told(spark, **change):
    items = spark.sql("SELECT 'Garden users' AS name, 'robust_growth' AS direction, array('Retail') AS brand_categories, 'low' AS buying_power_rating")
    made = narrative.narrative_templates(items)
    for k, v in change.items():
        made = made.withColumn(k, v)
    return made.select(F.lit("c").alias("cluster_id"), F.lit(1).alias("attempt"), F.lit("Garden users").alias("source_name"), F.lit("robust_growth").alias("direction"), F.struct("name", "summary", "commercial_interpretation", "brand_categories", "buying_power_rating", "buying_power_rationale").alias("narrative"))


def errors(spark, **change):
    return narrative.narrative_validation(told(spark, **change)).first()["errors"]


def test_templates_are_valid(spark):
    assert errors(spark) == []
    assert errors(spark, summary=F.lit("Attention to Garden users topics growing in the supplied comparison.")) == []
    assert narrative.first_valid(told(spark)).count() == 1


@pytest.mark.parametrize("text,wanted", [("It rose because of rain.", "prohibited causation claim"), ("Shoppers like it.", "prohibited reader identity claim"), ("A wealthy group.", "prohibited income claim"), ("They intend much.", "prohibited intent claim"), ("It will last.", "prohibited prediction claim"), ("Traffic doubled.", "prohibited invented traffic claim")])
def test_claims(spark, text, wanted):
    assert errors(spark, summary=F.lit(text)) == [wanted, "summary is outside the bounded narrative template"]


def test_form_comes_first(spark):
    assert errors(spark, summary=F.lit("It will last."), buying_power_rating=F.lit("huge"), brand_categories=F.array(F.lit("Weapons"))) == ["brand_categories has an unlisted value", "buying_power_rating has an unlisted value"]


def test_fingerprint_is_that_of_canonical_json(spark):
    """The tree by hand: digests of the pages' canonical JSON under prefixes of six, three and no digits."""
    pages = [{"page_id": 2, "canonical_title": "B", "lead": 'q"\n', "categories": ["y", "x"]}, {"page_id": 1, "canonical_title": "Ä", "lead": "", "categories": []}]
    rows = [(p["page_id"], p["canonical_title"], p["lead"], [*p["categories"], *p["categories"]]) for p in [*pages, pages[0]]]
    df = spark.createDataFrame(rows, "page_id long, canonical_title string, lead string, categories array<string>")
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    leaves = [(sha(publish.canonical_json({**p, "categories": sorted(p["categories"])})), n) for p, n in zip(pages, (2, 1))]
    nodes = [(d, f"{d}:{n}") for d, n in leaves]
    for digits in (6, 3):
        names = sorted({d[:digits] for d, _ in nodes})
        nodes = [(x, x + ":" + sha(",".join(sorted(line for d, line in nodes if d.startswith(x))))) for x in names]
    assert tuple(publish.semantic_fingerprint(df).first()) == ("sha256:" + sha(",".join(sorted(line for _, line in nodes))), 3)


def test_publication(tmp_path):
    final = publish.publish(tmp_path, "run-1", {"portfolio.json": {"a": 1}, "audit.json": []})
    publish.verify(final)
    assert (tmp_path / "latest").resolve() == final and publish.publish(tmp_path, "run-1", {"portfolio.json": {}}) == final
    (final / "audit.json").write_text("{}")
    with pytest.raises(ContractError):
        publish.verify(final)
    with pytest.raises(ContractError):
        publish.publish(tmp_path, "run-2", {"x.json": [{"deep": {"Api-Key": 1}}]})
    assert not (tmp_path / "run-2").exists()


def test_artifacts(tmp_path):
    path = tmp_path / "a" / "x.json"
    publish.write_artifact(path, "r", "evidence", {"n": 1})
    assert publish.read_artifact(path, "r", "evidence") == {"n": 1}
    for run, stage in (("other", "evidence"), ("r", "other")):
        with pytest.raises(ContractError):
            publish.read_artifact(path, run, stage)
    with pytest.raises(ContractError):
        publish.write_atomic(path, "x", replace=False)
    publish.same_configuration(tmp_path / "c.json", {"a": 1})
    publish.same_configuration(tmp_path / "c.json", {"a": 1})
    with pytest.raises(ContractError):
        publish.same_configuration(tmp_path / "c.json", {"a": 2})


def test_redaction(spark):
    df = spark.createDataFrame([([(1, "secret", "e")],)], "attempts array<struct<attempt:int,output:string,errors:string>>")
    assert publish.redacted_attempts(df, "attempts", "output", "errors").first()["attempts"][0].asDict() == {"attempt": 1}


LINES = [{"schema_version": "1.0", "run_id": "r", "sequence": n, "timestamp": f"2026-07-0{n}T00:00:00Z", "module": "wiki-evidence", "operation": "load-days", "level": "info", "message": "m"} for n in (1, 2, 4)]


def test_event_log_as_batch_and_stream(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join([*map(json.dumps, LINES), "{broken"]))
    read = events.neutral(events.read_events(spark, str(folder)).cache())
    assert read.where("message = 'an event could not be read'").count() == 1
    good = read.where("sequence IS NOT NULL")
    check = events.sequence_check(good).first()
    assert (check["n_events"], check["gaps"], check["contiguous"]) == (3, 1, False)
    assert events.after(good, 1).count() == 2
    text = good.select(events.public_message(F.col("module"), F.col("operation"), F.col("level"))).first()[0]
    assert text == "Wiki evidence: load days update."
    stream = events.daily_counts(events.read_events(spark, str(folder), stream=True))
    query = stream.writeStream.outputMode("complete").format("memory").queryName("counted").option("checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.sql("SELECT sum(n) FROM counted WHERE module IS NOT NULL").first()[0] == 3
