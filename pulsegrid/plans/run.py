"""A whole run from landed documents: evidence, formation, adjudication, portfolio, cross-checks, publication.

Every stage is kept as an artifact beside the published folder and made from the ones before it. A run that was
stopped is started again with the same words: finished stages are verified and read, the reviewed clusters and
narrated trends that were committed are verified and not asked for again, and the rest goes on from there.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path
from typing import TextIO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError, review_cap, safe_identifier
from pulsegrid.functions import digests
from pulsegrid.functions.storage import cut
from pulsegrid.operators import adjudication, categories, clusters, crosscheck, evidence, ledger, narrative, publish, similarity, traffic
from pulsegrid.sources import artifacts, files
from pulsegrid.streaming.progress import ProgressLog

STAGES = ("evidence", "formation", "adjudication", "portfolio")
#: Units of review or narration that are committed together.
BATCH = 64


def gather_evidence(spark: SparkSession, fixture: str, as_of: str, project: str) -> dict[str, DataFrame]:
    """days, cutoffs, pages and observations of the pages that stay, behind the coverage gate."""
    found = files.read_evidence_fixture(spark, fixture)
    days = evidence.nominal_days(spark, as_of).join(F.broadcast(found["day_status"]), "date")  # a fortnight
    evidence.require_coverage(days)
    records = found["raw_daily"].join(F.broadcast(days.where("status = 'successful'").select("date")), "date", "left_semi")  # 14 rows
    own = evidence.filter_project(records, project)
    known = evidence.merge_metadata(found["pages"].where("NOT unavailable").select("page_id", "canonical_title", "lead", "categories"))
    evidence.require_no_conflict(known)
    gone = found["pages"].where("unavailable").select("page_id", "canonical_title", F.lit(True).alias("unavailable"))
    pages = known.select("page_id", "canonical_title", F.lit(False).alias("unavailable")).unionByName(gone)
    resolved = cut(evidence.canonicalize(evidence.candidate_universe(own), found["aliases"], pages))
    evidence.require_known(resolved)
    kept = evidence.canonical_pages(resolved).join(known.drop("canonical_title", "conflict"), "page_id").withColumn("lead", evidence.lead_text(F.col("lead")))
    return {"days": days, "cutoffs": evidence.daily_cutoffs(records, days), "pages": cut(kept), "observations": evidence.page_observations(own, resolved), "exclusions": evidence.exclusion_map(evidence.exclusion_counts(resolved, records, project))}


def form_clusters(pages: DataFrame, embeddings: DataFrame, threshold: float = similarity.THRESHOLD, cap: int | str = clusters.REVIEW_CAP, most: int = clusters.MAX_INPUT) -> dict[str, DataFrame]:
    """pages, embeddings(text, vector) -> ranked clusters for review with cluster_id, their members, all selected pages, and counts."""
    chosen = cut(categories.select_categories(pages))
    texts = categories.representations(chosen)
    part = lambda c, name: files.frozen_embeddings(texts.select("page_id", F.col(c).alias("text")), embeddings).withColumnRenamed("vector", name)
    vectors = part("content_text", "content").join(part("category_text", "category"), "page_id")
    edges = cut(similarity.similarity_edges(vectors, threshold))
    every = cut(clusters.component_members(vectors, edges))
    parts = cut(clusters.subdivide_components(clusters.reviewable(every), edges, chosen, threshold, most))
    eligible = cut(clusters.preliminary_clusters(parts, vectors))
    review = cut(clusters.assign_ids(clusters.rank_clusters(eligible, review_cap(cap))))
    members = review.select("cluster_id", F.explode("page_ids").alias("page_id")).join(chosen.select("page_id", "canonical_title", "lead", "selected_categories"), "page_id")
    return {"clusters": review, "members": members, "selected": chosen.select("page_id"), "counts": clusters.formation_counts(every, parts, eligible, review_cap(cap))}


def _given(*columns: str) -> Column:
    return digests.row_digest(list(columns)).alias("given")


def review_clusters(review: DataFrame, script: DataFrame, book: ledger.Ledger, batch: int = BATCH, notify: Callable[[int, int], object] = lambda done, total: None) -> dict[str, DataFrame]:
    """review(rank, cluster_id, page_ids), script(page_ids, answers) -> where every page ends; clusters already committed are not asked about again."""
    asked = cut(review.select(F.col("rank").cast("long").alias("sequence"), F.col("cluster_id").alias("unit"), "page_ids").join(script, "page_ids", "left").withColumn("given", _given("page_ids", "answers")))

    def work(units: DataFrame) -> DataFrame:
        ends = adjudication.adjudicate_clusters(units.select(F.col("unit").alias("cluster_id"), "page_ids", "answers"))
        body = F.to_json(F.array_sort(F.collect_list(F.struct(*ends.columns))), {"ignoreNullFields": "false"})
        return units.select("sequence", "unit").join(ends.groupBy(F.col("cluster_id").alias("unit")).agg(body.alias("body")), "unit")  # a cluster fits one reader

    done = book.complete(asked, work, batch, notify)
    decided = cut(done.select(F.explode(F.from_json("body", f"array<struct<{adjudication.RESULT}>>")).alias("x")).select("x.*"))
    adjudication.require_partition(review.select("cluster_id", F.explode("page_ids").alias("page_id")), decided)
    return {"decided": decided, "final": adjudication.final_clusters(decided), "counts": adjudication.adjudication_counts(decided)}


def narrate(items: DataFrame, told: DataFrame, book: ledger.Ledger, batch: int = BATCH, notify: Callable[[int, int], object] = lambda done, total: None) -> dict[str, DataFrame]:
    """items(rank, cluster_id, source_name, direction), told(cluster_id, attempt, output, delivery_error) -> attempts, and the narrative of every item."""
    lists = told.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("attempt", "output", "delivery_error"))).alias("told"))  # a few attempts
    asked = cut(items.join(lists, "cluster_id", "left").select(F.col("rank").cast("long").alias("sequence"), F.col("cluster_id").alias("unit"), "source_name", "direction", "told").withColumn("given", _given("source_name", "direction", "told")))

    def work(units: DataFrame) -> DataFrame:
        given = units.select(F.col("unit").alias("cluster_id"), "source_name", "direction", F.explode("told").alias("t")).select("cluster_id", "source_name", "direction", "t.*")
        kept = narrative.attempt_records(given)
        body = F.to_json(F.array_sort(F.collect_list(F.struct("attempt", *(c for c in kept.columns if c != "attempt")))), {"ignoreNullFields": "false"})
        found = units.select("sequence", "unit").join(kept.groupBy(F.col("cluster_id").alias("unit")).agg(body.alias("body"), F.max("validation_status").alias("best")), "unit", "left")
        if not found.where("best IS NULL OR best <> 'valid'").isEmpty():
            raise ContractError("narrative attempts exhausted")
        return found

    done = book.complete(asked, work, batch, notify)
    attempts = cut(done.select(F.explode(F.from_json("body", f"array<struct<{narrative.RECORD}>>")).alias("x")).select("x.*"))
    return {"attempts": attempts, "narratives": attempts.where("validation_status = 'valid'").select("cluster_id", "attempt", "narrative")}


class Run:
    """The stages of one run in its working folder."""

    def __init__(self, spark: SparkSession, inputs: dict[str, str], work: str, run_id: str, as_of: str, project: str, threshold: float, cap: int | str, batch: int, lines: TextIO | None = None):
        self.spark, self.inputs, self.work, self.run_id, self.as_of, self.batch = spark, inputs, work, run_id, as_of, batch
        self.project, self.threshold, self.cap = project, threshold, cap
        self.prints = {n: tuple(digests.table_fingerprint(spark.read.text(p, wholetext=True)).first())[1] for n, p in sorted(inputs.items())}
        self.made: dict[str, str] = {}
        self.configurations: dict[str, dict] = {}
        self.log = ProgressLog(spark, f"{work}/progress", run_id, lines)

    def stage(self, name: str, configuration: dict, make: Callable[[str], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        """The stage's tables: read and verified if they are finished, else made and kept."""
        folder, known = f"{self.work}/{name}", dict(self.made)
        arguments = (self.spark, folder, self.run_id, name, configuration, known)
        if (found := ledger.read_stage(*arguments)) is None:
            self.log.emit(name, "start", f"{name} is made")
            ledger.write_stage(*arguments, make(fingerprint_of(configuration, known)))
            found = ledger.read_stage(*arguments)
            self.log.emit(name, "complete", f"{name} is kept")
        else:
            self.log.emit(name, "resume", f"{name} was kept before")
        self.made[name], self.configurations[name] = found[0]["fingerprint"], configuration
        return found[1]

    def stages(self) -> dict[str, dict[str, DataFrame]]:
        e = self.stage("evidence", {"input": self.prints["evidence"], "as_of": self.as_of, "project": self.project}, lambda _: gather_evidence(self.spark, self.inputs["evidence"], self.as_of, self.project))
        artifacts.require_evidence(e)
        f = self.stage("formation", {"input": self.prints["embeddings"], "threshold": self.threshold, "cap": str(self.cap)}, lambda _: form_clusters(e["pages"], files.embedding_document(self.spark, self.inputs["embeddings"]), self.threshold, self.cap))

        def adjudicated(own: str) -> dict[str, DataFrame]:
            found = review_clusters(f["clusters"], files.decision_document(self.spark, self.inputs["decisions"]), self.book("adjudication", own), self.batch, self.told("adjudication", "review"))
            members = found["final"].select(F.col("final_cluster_id").alias("cluster_id"), F.explode("page_ids").alias("page_id"))
            return found | {"final_members": members.join(f["members"].drop("cluster_id"), "page_id")}

        a = self.stage("adjudication", {"input": self.prints["decisions"]}, adjudicated)

        def portfolio(own: str) -> dict[str, DataFrame]:
            members = a["final_members"].select("cluster_id", "page_id")
            seen = cut(traffic.attach_cluster_traffic(members, e["days"], e["cutoffs"], e["observations"], e["pages"]))
            names = a["final"].select(F.col("final_cluster_id").alias("cluster_id"), F.col("group_name").alias("source_name"))
            items = cut(traffic.portfolio_items(traffic.rank_portfolio(seen), members).join(names, "cluster_id"))
            return {"traffic": seen, "items": items} | narrate(items, files.narrative_document(self.spark, self.inputs["narratives"]), self.book("portfolio", own), self.batch, self.told("portfolio", "narrate"))

        return {"evidence": e, "formation": f, "adjudication": a, "portfolio": self.stage("portfolio", {"input": self.prints["narratives"]}, portfolio)}

    def told(self, module: str, operation: str) -> Callable[[int, int], object]:
        return lambda done, total: self.log.emit(module, operation, "units are committed", progress=(done, total))

    def book(self, name: str, own: str) -> ledger.Ledger:
        return ledger.Ledger(self.spark, f"{self.work}/{name}/units", self.run_id, own)


def narrative_attempts(attempts: DataFrame) -> list[dict]:
    """For every item how its narrative came about, without what was answered or what was wrong with it."""
    each = F.array_sort(F.collect_list(F.struct("attempt", *(c for c in attempts.columns if c not in ("cluster_id", "attempt")))))  # a few attempts
    told = publish.redacted_attempts(attempts.groupBy("cluster_id").agg(each.alias("attempts")), "attempts", "output", "errors", "narrative")
    return [json.loads(r) for r in told.orderBy("cluster_id").toJSON().collect()]  # ten rows


def fingerprint_of(configuration: dict, upstream: dict[str, str]) -> str:
    return publish.fingerprint({"configuration": configuration, "upstream": upstream})


def run(spark: SparkSession, inputs: dict[str, str], out: str, run_id: str, as_of: str, project: str = "en.wikipedia", threshold: float = similarity.THRESHOLD, cap: int | str = clusters.REVIEW_CAP, batch: int = BATCH, lines: TextIO | None = None) -> Path:
    """inputs names the evidence, embeddings, decisions and narratives documents; the published folder is returned.

    A run that was published already is verified and returned; one with another configuration under its id is refused;
    one that was stopped goes on behind what it had committed. Progress is told as events beside the stages, and as lines where wanted.
    """
    folder = Path(out)
    now = Run(spark, inputs, f"{out.rstrip('/')}/.stages/{safe_identifier(run_id, 'run_id')}", run_id, as_of, project, threshold, cap, batch, lines)
    publish.same_configuration(folder / f"{run_id}.config.json", {"inputs": now.prints, "as_of": as_of, "project": project, "threshold": threshold, "cap": str(cap)})
    if (folder / run_id).exists():
        publish.verify(folder / run_id)
        return folder / run_id
    stages = now.stages()
    crosscheck.gate(spark, stages, as_of, f"{now.work}/faults")
    now.log.emit("publication", "check", "the stages agree")
    e, f, a, p = (stages[n] for n in STAGES)
    rows = p["items"].join(p["narratives"].drop("attempt"), "cluster_id").orderBy("rank").toJSON().collect()  # ten rows
    windows = {r["window"]: {"start": r["start"], "end": r["end"]} for r in e["days"].groupBy("window").agg(F.min("date").cast("string").alias("start"), F.max("date").cast("string").alias("end")).collect()}  # two rows
    product = {"schema_version": publish.PRODUCT_VERSION, "run_id": run_id, "nominal_windows": windows}
    portfolio = product | {"as_of": as_of, "trends": [json.loads(r) for r in rows], "completion": {"status": "complete", "empty": not rows}}
    audit = {
        "schema_version": publish.PRODUCT_VERSION,
        "run_id": run_id,
        "stages": now.made,
        "semantic_fingerprint": publish.semantic_fingerprint(e["pages"]).first()["fingerprint"],
        "coverage": {r["window"]: r["successful_days"] for r in evidence.coverage(e["days"]).collect()},
        "exclusions": json.loads(e["exclusions"].toJSON().first()),
        "adjudication": a["counts"].first().asDict(),
        "selected_pages": f["selected"].count(),
        "narrative_attempts": narrative_attempts(p["attempts"]),
    }
    integrity = {"algorithm": "sha256", "encoding": "utf-8", "manifest_excludes_self": True}
    manifest = product | {"as_of": as_of, "configuration_provenance": now.configurations, "modules": now.made, "integrity": integrity, "completion": {"status": "complete"}}
    published = publish.publish(folder, run_id, {"portfolio.json": portfolio, "audit.json": audit}, manifest)
    now.log.emit("publication", "complete", "the run is published")
    return published
