"""Whole runs on a small set of documents: results, resuming after a kill, and faults planted between the stages."""

import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError
from pulsegrid.operators import adjudication, crosscheck, narrative, publish
from pulsegrid.plans import run as plan
from pulsegrid.plans.run import run
from pulsegrid.streaming import events

AS_OF = "2026-07-17"
NAMES = {1: "Gardens", 2: "Kitchens", 3: "Sheds"}


def story(name):
    return {"name": name, "summary": f"Attention to {name} topics rose in the supplied comparison.", "commercial_interpretation": "Retail brands may find the supplied topic group commercially relevant.", "brand_categories": ["Retail"], "buying_power_rating": "low", "buying_power_rationale": "The low rating is a qualitative assessment based on the supplied topics' relevance to Retail."}


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    """Seven pages, three pairs of them alike; attention to these grows; the third pair is rejected."""
    folder = tmp_path_factory.mktemp("run")
    days = {f"2026-07-{n:02d}": {"records": [{"project": "en.wikipedia", "article": f"P{i}", "views_ceil": (1000 + i if n >= 9 else 300) if i < 7 else 300} for i in range(1, 8)] + [{"project": "de.wikipedia", "article": "X", "views_ceil": 100}]} for n in range(2, 16)}
    pair = lambda i: (i + 1) // 2
    pages = {f"P{i}": {"page_id": i, "canonical_title": f"P{i}", "lead": f"lead {i}", "categories": [f"c{pair(i)}"]} for i in range(1, 8)}
    axis = lambda i: [float(k == pair(i)) for k in range(1, 5)]
    texts = {f"Title: P{i}\nLead: lead {i}": axis(i) for i in range(1, 8)} | {f"Selected Categories: c{pair(i)}": axis(i) for i in range(1, 8)}
    decide = lambda k: {"groups": [{"name": NAMES[k], "page_ids": [2 * k - 1, 2 * k], "rationale": "alike"}] if k < 3 else [], "rejected": [] if k < 3 else [{"page_id": i, "reason": "dull"} for i in (5, 6)]}
    documents = {
        "evidence": {"schema_version": "1.0", "source": "test", "daily_responses": days, "canonical_pages": pages},
        "embeddings": {"schema_version": "1.0", "model": "m", "embeddings": texts},
        "decisions": {"schema_version": "1.0", "model": "m", "clusters": [{"page_ids": [2 * k, 2 * k - 1], "responses": {"proposer": [decide(k)], "critic": [{"approved": True, "challenges": []}], "reviser": []}} for k in (1, 2, 3)]},
        "narratives": {"schema_version": "1.0", "model": "m", "clusters": [{"cluster_id": f"final-audience-cluster-{k:04d}", "responses": [{"delivery_error": "down"}, story(NAMES[k]), story("later")]} for k in (1, 2)]},
    }
    for name, value in documents.items():
        (folder / f"{name}.json").write_text(json.dumps(value))
    return {n: str(folder / f"{n}.json") for n in documents}


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def killed(spark, inputs, tmp_path_factory):
    """A run with one unit a commit, killed at the second cluster and again at the second narrative; what was asked for each time."""
    out, asked, first_review, first_story = str(tmp_path_factory.mktemp("out")), [], adjudication.adjudicate_clusters, narrative.attempt_records

    def counted(kind, work, stop):
        def step(df):
            own = sorted(r[0] for r in df.select("cluster_id").distinct().collect())
            if stop in own:
                raise InterruptedError(kind)
            asked.append((kind, *own))
            return work(df)

        return step

    log = []
    with pytest.MonkeyPatch.context() as patch:
        for review, tell in (("preliminary-cluster-0002", None), (None, "final-audience-cluster-0001"), (None, None)):
            patch.setattr(adjudication, "adjudicate_clusters", counted("review", first_review, review))
            patch.setattr(narrative, "attempt_records", counted("story", first_story, tell))
            asked.clear()
            try:
                final = run(spark, inputs, out, "run-1", AS_OF, batch=1)
            except InterruptedError:
                final = None
            log.append([*asked])
    return out, final, log


def test_resumes_where_it_was_killed(spark, inputs, killed):
    out, final, log = killed
    assert log == [
        [("review", "preliminary-cluster-0001")],
        [("review", "preliminary-cluster-0002"), ("review", "preliminary-cluster-0003"), ("story", "final-audience-cluster-0002")],
        [("story", "final-audience-cluster-0001")],
    ]
    trends = json.loads((final / "portfolio.json").read_text())["trends"]
    assert [(t["rank"], t["direction"], t["narrative"]["name"], t["n_members"]) for t in trends] == [(1, "robust_growth", "Kitchens", 2), (2, "robust_growth", "Gardens", 2)]
    audit = json.loads((final / "audit.json").read_text())
    assert audit["adjudication"] == {"reviewed_clusters": 3, "accepted_pages": 4, "rejected_pages": 2, "final_clusters": 2} and set(audit["stages"]) == set(plan.STAGES)
    publish.verify(final)
    assert run(spark, inputs, out, "run-1", AS_OF) == final
    with pytest.raises(ContractError):
        run(spark, inputs, out, "run-1", "2026-07-18")


def test_progress_of_a_killed_run_is_one_sequence(spark, killed):
    out, final, _ = killed
    told = events.guarded(events.read_events(spark, f"{out}/.stages/run-1/progress/events")).orderBy("sequence").collect()
    assert [r["sequence"] for r in told] == list(range(1, len(told) + 1)) and not any(r["fault"] for r in told)
    operations = [(r["module"], r["operation"]) for r in told]
    assert operations.count(("evidence", "resume")) == 2 and operations.count(("adjudication", "review")) == 3 and operations.count(("portfolio", "narrate")) == 2
    assert operations[-2:] == [("publication", "check"), ("publication", "complete")]


def test_product_and_manifest(killed):
    portfolio, audit, manifest = (json.loads((killed[1] / f"{n}.json").read_text()) for n in ("portfolio", "audit", "manifest"))
    windows = {"previous": {"start": "2026-07-02", "end": "2026-07-08"}, "current": {"start": "2026-07-09", "end": "2026-07-15"}}
    assert portfolio["nominal_windows"] == manifest["nominal_windows"] == windows and portfolio["completion"] == {"status": "complete", "empty": False}
    assert manifest["modules"] == audit["stages"] and set(manifest["configuration_provenance"]) == set(plan.STAGES) and set(manifest["files"]) == {"portfolio.json", "audit.json"}
    tries = {a["cluster_id"]: a["attempts"] for a in audit["narrative_attempts"]}
    assert {c: [t["attempt"] for t in a] for c, a in tries.items()} == {f"final-audience-cluster-{k:04d}": [1, 2] for k in (1, 2)}
    assert not {"output", "errors", "narrative"} & {k for a in tries.values() for t in a for k in t}


def test_a_killed_run_gives_what_a_whole_one_gives(spark, inputs, killed, tmp_path):
    whole = run(spark, inputs, str(tmp_path), "run-1", AS_OF)
    for name in ("portfolio.json", "audit.json"):
        a, b = (json.loads((folder / name).read_text()) for folder in (whole, killed[1]))
        assert a == b


@pytest.mark.parametrize("kind", ["commit", "stage"])
def test_refuses_to_go_on_from_what_was_changed(spark, inputs, killed, tmp_path, kind):
    work = tmp_path / ".stages" / "run-1"
    shutil.copytree(Path(killed[0], ".stages", "run-1"), work)
    for name in ("adjudication", "portfolio"):
        (work / name / "artifact.json").unlink()
    path = work / "adjudication" / "units" / "commits" / "00000001.json" if kind == "commit" else work / "formation" / "artifact.json"
    path.write_text(path.read_text().replace("sha256:", "sha256:0", 1))
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    with pytest.raises(ContractError):
        run(spark, inputs, str(tmp_path), "run-1", AS_OF, batch=1)


@pytest.fixture(scope="module")
def stages(spark, inputs, killed):
    return plan.Run(spark, inputs, f"{killed[0]}/.stages/run-1", "run-1", AS_OF, "en.wikipedia", 0.76, 10, 1).stages()


def changed(column, value, where="true"):
    return lambda df: df.withColumn(column, F.when(F.expr(where), F.expr(value)).otherwise(F.col(column)))


FAULTS = {
    "none": ("evidence", "days", lambda df: df, set()),
    "other windows": ("evidence", "days", changed("date", "date_sub(date, 14)", "date = '2026-07-02'"), {"run facts", "traffic"}),
    "title": ("formation", "members", changed("canonical_title", "'other'", "page_id = 1"), {"formation evidence", "member evidence"}),
    "lead": ("evidence", "pages", changed("lead", "'other'", "page_id = 1"), {"formation evidence"}),
    "categories": ("formation", "members", changed("selected_categories", "array('nowhere')", "page_id = 5"), {"formation evidence"}),
    "unknown page": ("evidence", "pages", lambda df: df.where("page_id <> 5"), {"formation evidence"}),
    "page in two clusters": ("formation", "members", lambda df: df.unionByName(df.where("page_id = 5").withColumn("cluster_id", F.lit("preliminary-cluster-0001"))), {"formation members"}),
    "formation counts": ("formation", "counts", changed("selected_clusters", "selected_clusters + 1"), {"formation counts"}),
    "omitted clusters": ("formation", "counts", changed("omitted_clusters", "omitted_clusters + 1"), {"formation counts"}),
    "preliminary ids": ("formation", "clusters", changed("cluster_id", "'preliminary-cluster-0009'", "cluster_id = 'preliminary-cluster-0003'"), {"preliminary ids", "formation members", "terminal provenance"}),
    "page left out": ("adjudication", "decided", lambda df: df.where("page_id <> 6"), {"terminal provenance", "adjudication counts"}),
    "page twice": ("adjudication", "decided", lambda df: df.unionAll(df.where("page_id = 6")), {"terminal provenance", "adjudication counts"}),
    "source of another": ("adjudication", "decided", changed("cluster_id", "'preliminary-cluster-0007'", "page_id = 6"), {"terminal provenance", "adjudication counts"}),
    "final ids": ("adjudication", "final", changed("final_cluster_id", "'final-audience-cluster-0003'", "final_cluster_id = 'final-audience-cluster-0002'"), {"final clusters"}),
    "final name": ("adjudication", "final", changed("group_name", "'Other'"), {"final clusters"}),
    "adjudication counts": ("adjudication", "counts", changed("accepted_pages", "accepted_pages + 1"), {"adjudication counts"}),
    "member fields": ("adjudication", "final_members", changed("lead", "NULL", "page_id = 1"), {"member evidence"}),
    "member of another": ("adjudication", "final_members", changed("cluster_id", "'final-audience-cluster-0002'"), {"member evidence"}),
    "traffic": ("portfolio", "traffic", lambda df: df.withColumn("current", F.col("current").withField("observed_total", F.col("current.observed_total") + 1)), {"traffic"}),
    "traffic missing": ("portfolio", "traffic", lambda df: df.limit(1), {"traffic"}),
    "traffic twice": ("portfolio", "traffic", lambda df: df.unionAll(df), {"traffic"}),
    "observations": ("evidence", "observations", changed("views_ceil", "views_ceil + 1", "page_id = 1"), {"traffic", "portfolio"}),
    "ranks": ("portfolio", "items", changed("rank", "3 - rank"), {"portfolio"}),
    "impact": ("portfolio", "items", changed("impact_score", "impact_score + 1", "rank = 1"), {"portfolio"}),
    "change": ("portfolio", "items", changed("percentage_change", "NULL", "rank = 2"), {"portfolio"}),
    "coverage": ("portfolio", "items", changed("coverage_current", "0.5", "rank = 2"), {"portfolio"}),
    "trend left out": ("portfolio", "items", lambda df: df.where("rank = 1"), {"portfolio"}),
    "narrative of another": ("portfolio", "narratives", lambda df: df.withColumn("narrative", F.col("narrative").withField("name", F.lit("Other"))), {"narratives"}),
    "narrative left out": ("portfolio", "narratives", lambda df: df.limit(1), {"narratives"}),
    "attempt left out": ("portfolio", "attempts", lambda df: df.where("attempt > 1"), {"narratives"}),
    "attempt changed": ("portfolio", "attempts", lambda df: df.withColumn("narrative", F.col("narrative").withField("summary", F.lit("Views doubled."))), {"narratives"}),
    "attempt said to be valid": ("portfolio", "attempts", changed("validation_status", "'valid'"), {"narratives"}),
}


@pytest.mark.parametrize("fault", FAULTS)
def test_planted_faults(stages, fault):
    stage, table, plant, checks = FAULTS[fault]
    planted = stages | {stage: stages[stage] | {table: plant(stages[stage][table])}}
    assert {r["check"] for r in crosscheck.faults(planted, AS_OF, checks or crosscheck.CHECKS).collect()} == checks


def test_gate(spark, stages, killed, tmp_path):
    crosscheck.gate(spark, stages, AS_OF, str(tmp_path / "none"))
    ranks = stages["portfolio"] | {"items": changed("rank", "3 - rank")(stages["portfolio"]["items"])}
    with pytest.raises(ContractError, match=r"portfolio \(2\)"):
        crosscheck.gate(spark, stages | {"portfolio": ranks}, AS_OF, str(tmp_path / "some"))
    assert spark.read.parquet(str(tmp_path / "some")).count() == 2
    assert Path(killed[0], ".stages", "run-1", "faults").exists()
