"""Publication: fingerprints, checks between stages, redaction, and files that appear all at once or not at all."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.contracts import ARTIFACT_VERSION, ContractError, safe_identifier
from pulsegrid.functions.digests import tree_root

PRODUCT_VERSION = "1.0"
# Keys that no published document may hold.
FORBIDDEN_KEYS = ("api_key", "authorization", "chain_of_thought", "database_url", "hidden_reasoning", "password", "secret", "token")


def canonical_json(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def fingerprint(value: object) -> str:
    return "sha256:" + hashlib.sha256(canonical_json(value).encode()).hexdigest()


def semantic_fingerprint(pages: DataFrame) -> DataFrame:
    """One row: the fingerprint of pages(page_id, canonical_title, lead, categories), in any order, categories sorted and distinct.

    A page's bytes are those of canonical JSON; the pages meet in a tree of digests, so no task holds them all.
    """
    record = F.to_json(F.struct("canonical_title", F.array_sort(F.array_distinct("categories")).alias("categories"), "lead", "page_id"), {"ignoreNullFields": "false"})
    return tree_root(pages.select(F.sha2(record, 256).alias("digest"))).select("fingerprint", F.col("n").alias("n_pages"))


def formation_faults(members: DataFrame, pages: DataFrame) -> DataFrame:
    """(page_id, fault) of cluster members that differ from the evidence: unknown pages, other titles or leads, categories from nowhere."""
    known = pages.select("page_id", F.col("canonical_title").alias("t"), F.col("lead").alias("l"), F.col("categories").alias("c"))
    joined = members.join(known, "page_id", "left")
    fault = F.when(F.col("t").isNull(), "unknown").when(~F.col("canonical_title").eqNullSafe(F.col("t")), "title").when(~F.col("lead").eqNullSafe(F.col("l")), "lead").when(F.size(F.array_except("selected_categories", "c")) > 0, "categories")
    return joined.select("page_id", fault.alias("fault")).where("fault IS NOT NULL")


def member_faults(final: DataFrame, preliminary: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, fault): final members without a preliminary one, or with other fields."""
    fields = [c for c in final.columns if c != key]
    a, b = final.select(key, F.struct(*fields).alias("a")), preliminary.select(key, F.struct(*fields).alias("b"), F.lit(True).alias("known"))
    fault = F.when(F.col("known").isNull(), "unknown").when(~F.col("a").eqNullSafe(F.col("b")), "differs")
    return a.join(b, key, "left").select(key, fault.alias("fault")).where("fault IS NOT NULL")


def traffic_faults(traffic: DataFrame, recomputed: DataFrame, key: str = "cluster_id") -> DataFrame:
    """(key, fault): rows missing on either side, or different."""
    fields = [c for c in traffic.columns if c != key]
    a, b = traffic.select(key, F.struct(*fields).alias("a"), F.lit(True).alias("x")), recomputed.select(key, F.struct(*fields).alias("b"), F.lit(True).alias("y"))
    fault = F.when(F.col("x").isNull(), "missing").when(F.col("y").isNull(), "unknown").when(~F.col("a").eqNullSafe(F.col("b")), "differs")
    return a.join(b, key, "full").select(key, fault.alias("fault")).where("fault IS NOT NULL")


def portfolio_faults(portfolio: DataFrame, recomputed: DataFrame) -> DataFrame:
    """The same by rank: places and facts must agree."""
    return traffic_faults(portfolio, recomputed, "rank")


def id_faults(rows: DataFrame, column: str, rank: Column, prefix: str) -> DataFrame:
    """Rows whose identifier is not the one of their place."""
    return rows.withColumn("expected", F.format_string(f"{prefix}%04d", rank)).where(F.col(column) != F.col("expected"))


def redacted_attempts(rows: DataFrame, column: str, *fields: str) -> DataFrame:
    """rows with the fields taken out of the structs of an array column."""
    return rows.withColumn(column, F.transform(column, lambda x: x.dropFields(*fields)))


def ensure_safe(value: object) -> None:
    """Raise where a key, however it is written, is forbidden at any depth."""
    stack = [value]
    while stack:
        now = stack.pop()
        if isinstance(now, dict):
            for k in now:
                if str(k).lower().replace("-", "_") in FORBIDDEN_KEYS:
                    raise ContractError(f"published artifacts contain prohibited field {k!r}")
            stack += now.values()
        elif isinstance(now, list):
            stack += now


def write_atomic(path: str | Path, text: str, replace: bool = True) -> None:
    """The file holds all of text or stays as it was; without replace an existing file is an error."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    try:
        with part.open("w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(part, path) if replace else os.link(part, path)
    except FileExistsError as e:
        raise ContractError(f"{path.name} exists") from e
    finally:
        part.unlink(missing_ok=True)


def write_artifact(path: str | Path, run_id: str, stage: str, payload: object, status: str = "complete") -> None:
    document = {"schema_version": ARTIFACT_VERSION, "run_id": safe_identifier(run_id, "run_id"), "stage": safe_identifier(stage, "stage"), "status": status, "payload": payload}
    write_atomic(path, canonical_json(document) + "\n")


def read_artifact(path: str | Path, run_id: str, stage: str) -> object:
    """The payload of a complete artifact of this run and stage."""
    try:
        document = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise ContractError("artifact cannot be read") from e
    if not isinstance(document, dict) or (document.get("schema_version"), document.get("run_id"), document.get("stage"), document.get("status")) != (ARTIFACT_VERSION, run_id, stage, "complete"):
        raise ContractError("artifact is not a complete one of this run and stage")
    return document["payload"]


def publish(folder: str | Path, run_id: str, documents: dict[str, object], facts: dict[str, object] | None = None) -> Path:
    """folder/run_id with the documents and a manifest of their hashes and sizes and of the facts, put in place by one rename; folder/latest points to it."""
    folder = Path(folder)
    final, part = folder / safe_identifier(run_id, "run_id"), folder / f".{run_id}.{uuid.uuid4().hex}"
    ensure_safe([*documents.values(), facts])
    if final.exists():
        verify(final)
        return final
    part.mkdir(parents=True)
    try:
        files = {}
        for name, value in documents.items():
            text = canonical_json(value) + "\n"
            write_atomic(part / name, text)
            files[name] = {"sha256": "sha256:" + hashlib.sha256(text.encode()).hexdigest(), "bytes": len(text.encode())}
        write_atomic(part / "manifest.json", canonical_json((facts or {}) | {"run_id": run_id, "files": files}) + "\n")
        os.replace(part, final)
    finally:
        shutil.rmtree(part, ignore_errors=True)
    link = folder / f".latest.{uuid.uuid4().hex}"
    link.symlink_to(final.name)
    os.replace(link, folder / "latest")
    return final


def verify(final: str | Path) -> None:
    """Raise where a published file differs from its manifest."""
    final = Path(final)
    try:
        files = json.loads((final / "manifest.json").read_text(encoding="utf-8"))["files"]
        for name, facts in files.items():
            data = (final / name).read_bytes()
            if len(data) != facts["bytes"] or "sha256:" + hashlib.sha256(data).hexdigest() != facts["sha256"]:
                raise ContractError(f"{name} differs from its manifest")
    except (OSError, KeyError, TypeError, ValueError) as e:
        if isinstance(e, ContractError):
            raise
        raise ContractError("publication is incomplete") from e


def same_configuration(path: str | Path, configuration: dict) -> None:
    """Record a run's configuration, or raise where an earlier start recorded another."""
    path = Path(path)
    if path.exists():
        if json.loads(path.read_text(encoding="utf-8")).get("fingerprint") != fingerprint(configuration):
            raise ContractError("run configuration differs from the recorded one")
        return
    write_atomic(path, canonical_json({"configuration": configuration, "fingerprint": fingerprint(configuration)}) + "\n", replace=False)
