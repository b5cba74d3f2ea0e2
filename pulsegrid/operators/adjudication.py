"""Decisions about clusters: proposals, critiques and revisions checked, fail-closed results, and the flow between the roles.

A cluster under review fits one reader, so its checks run per row: proposals and critiques arrive as JSON of unknown
shape, where casts would hide mistakes. What happens across clusters (identifiers, counts, the partition check) are
DataFrame operations.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError

# Fixed values of the model's contract.
DIMENSIONS = ("semantic_coherence", "commercial_meaning", "brand_safety", "naming", "evidence_support")
ACTIONS = ("revise", "reject")
ALWAYS_REJECT = ("brand_safety", "evidence_support")
VISIBLE_FIELDS = ("page_id", "canonical_title", "lead", "selected_categories")
INVALID = "invalid_adjudication"
DELIVERY_ATTEMPTS = 3


def _is_id(value: object) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def _is_text(value: object) -> bool:
    return isinstance(value, str) and bool(value.strip())


def _has_exactly(value: object, *keys: str) -> bool:
    return isinstance(value, dict) and set(value) == set(keys)


def _distinct(values: list) -> list:
    return list(dict.fromkeys(values))


def visible_members(members: DataFrame) -> DataFrame:
    """The four fields that a model may see, behind the bounds that they must keep."""
    from pulsegrid.contracts import checked

    categories = F.col("selected_categories")
    fine = F.col("page_id").isNotNull() & (F.length("canonical_title") > 0) & (F.length("lead") <= 600) & (F.size(categories) <= 5) & (F.size(F.array_distinct(categories)) == F.size(categories)) & ~F.exists(categories, lambda c: c.isNull() | (c == ""))
    kept = members.select(*(["cluster_id"] if "cluster_id" in members.columns else []), *VISIBLE_FIELDS)
    return kept.withColumn("page_id", checked(F.col("page_id"), fine, "Preliminary Cluster member is invalid"))


def _shape(proposal: object) -> bool:
    """Whether a proposal has groups and rejections of the right form."""
    if not _has_exactly(proposal, "groups", "rejected") or not isinstance(proposal["groups"], list) or not isinstance(proposal["rejected"], list):
        return False
    groups = all(_has_exactly(g, "name", "page_ids", "rationale") and _is_text(g["name"]) and _is_text(g["rationale"]) and isinstance(g["page_ids"], list) and all(map(_is_id, g["page_ids"])) for g in proposal["groups"])
    return groups and all(_has_exactly(r, "page_id", "reason") and _is_id(r["page_id"]) and _is_text(r["reason"]) for r in proposal["rejected"])


def decision_errors(members: list[int], proposal: object) -> list[str]:
    """What keeps a proposal from putting every member in one group or among the rejected, exactly once; empty if nothing does."""
    if not _shape(proposal):
        return ["invalid_proposal_shape"]
    supplied, used, errors = set(members), Counter(), []
    for group in proposal["groups"]:
        ids, own, seen = group["page_ids"], Counter(group["page_ids"]), set()
        errors += [f"duplicate_page_id:{i}" for i in ids if i in seen or seen.add(i)]
        if len(own) < 2:
            errors.append(f"accepted_group_has_fewer_than_two_distinct_pages:{group['name']}")
        errors += [f"unknown_page_id:{i}" for i in ids if i not in supplied]
        used += own
    rejected = [r["page_id"] for r in proposal["rejected"]]
    errors += [f"unknown_page_id:{i}" for i in rejected if i not in supplied]
    used += Counter(rejected)
    errors += [f"{'multiply_assigned' if used[i] else 'omitted'}_page_id:{i}" for i in members if used[i] != 1]
    return _distinct(errors)


def closed(members: list[int], errors: list[str]) -> dict:
    """The result that accepts nothing."""
    return {"groups": [], "rejected": [{"page_id": i, "reason": INVALID} for i in members], "status": "invalid", "errors": errors}


def decide(members: list[int], proposal: object) -> dict:
    errors = decision_errors(members, proposal)
    return closed(members, errors) if errors else {"groups": proposal["groups"], "rejected": proposal["rejected"], "status": "valid", "errors": []}


def parse_critique(members: list[int], critique: object) -> dict | None:
    """The critique, or None where it breaks its contract: approval means no challenge, and challenges name supplied pages once."""
    if not _has_exactly(critique, "approved", "challenges") or not isinstance(critique["approved"], bool) or not isinstance(critique["challenges"], list):
        return None
    if critique["approved"] == bool(critique["challenges"]):
        return None
    for c in critique["challenges"]:
        if not _has_exactly(c, "dimension", "message", "page_ids", "required_action") or not _is_text(c["message"]):
            return None
        ids = c["page_ids"]
        if c["dimension"] not in DIMENSIONS or c["required_action"] not in ACTIONS or not isinstance(ids, list) or not ids:
            return None
        if not all(map(_is_id, ids)) or len(set(ids)) != len(ids) or not set(ids) <= set(members):
            return None
    return critique


def required_rejections(critique: dict) -> list[int]:
    return _distinct([i for c in critique["challenges"] if c["required_action"] == "reject" or c["dimension"] in ALWAYS_REJECT for i in c["page_ids"]])


def proposed_rejections(members: list[int], proposal: object) -> list[int]:
    """Members that a proposal, valid or not, rejects in proper form."""
    listed, supplied = proposal.get("rejected") if isinstance(proposal, dict) else None, set(members)
    return _distinct([r["page_id"] for r in listed if isinstance(r, dict) and _is_id(r.get("page_id")) and r["page_id"] in supplied and _is_text(r.get("reason"))]) if isinstance(listed, list) else []


def revise(members: list[int], proposal: object, critique: dict, revision: object) -> dict:
    """A revision's result: valid by itself, and with every earlier and every demanded rejection kept."""
    result = decide(members, revision)
    if result["status"] != "valid":
        return result
    final = {r["page_id"] for r in result["rejected"]}
    errors = [f"resurrected_page_id:{i}" for i in proposed_rejections(members, proposal) if i not in final]
    errors += [f"critic_required_rejection_missing:{i}" for i in required_rejections(critique) if i not in final]
    return closed(members, _distinct(errors)) if errors else result


class Undelivered(Exception):
    """A role's answer that did not arrive."""


def adjudicate(members: list[int], ask: Callable[[str, int, dict], object]) -> dict:
    """The flow of one cluster: propose, criticise, then accept, reject all, or revise once.

    ask(role, attempt, request) answers or raises Undelivered; a role is asked at most three times.
    """
    steps: list[dict] = []

    def answer(role: str, **request: object) -> object:
        for attempt in range(1, DELIVERY_ATTEMPTS + 1):
            try:
                found = ask(role, attempt, {"members": members, **request})
            except Undelivered as e:
                steps.append({"role": role, "attempt": attempt, "delivery": "error", "error": str(e)})
            else:
                steps.append({"role": role, "attempt": attempt, "delivery": "delivered"})
                return found
        raise Undelivered(role)

    try:
        proposal = answer("proposer")
        first = decide(members, proposal)
        critique = parse_critique(members, answer("critic", proposal=proposal, validation_errors=first["errors"]))
        if critique is None:
            return closed(members, ["invalid_critique"]) | {"steps": steps}
        if first["status"] == "valid" and critique["approved"]:
            return first | {"steps": steps}
        revision = answer("reviser", proposal=proposal, validation_errors=first["errors"], critique=critique)
        return revise(members, proposal, critique, revision) | {"steps": steps}
    except Undelivered as e:
        return closed(members, [f"exhausted_delivery:{e}"]) | {"steps": steps}


def _answers(text: str | None) -> dict[str, list]:
    """Answers by role; broken JSON, or a role that has no list, is an answer that did not arrive."""
    try:
        found = json.loads(text or "{}")
    except (ValueError, RecursionError):
        return {}
    return {role: given for role, given in found.items() if isinstance(given, list)} if isinstance(found, dict) else {}


RESULT = "cluster_id string, status string, errors array<string>, page_id long, assignment string, group_position int, group_name string, reason string"
ENDS_FIELD = "ends array<struct<page_id:long,assignment:string,group_position:int,group_name:string,reason:string>>"
#: Ends of members handed on at once, in whole clusters.
ENDS = 10_000
#: Characters of errors, times the members that they are repeated for, in one row that leaves Python: Spark holds all rows that come of one.
REPEATED = 16_000_000


def adjudicate_clusters(clusters: DataFrame, errors: Callable[[Column], Column] = lambda e: e) -> DataFrame:
    """clusters(cluster_id, page_ids, answers) -> (cluster_id, status, errors, page_id, ...), a row for each member: the group it is in, or why it is rejected.

    answers is JSON: for each role a list of answers by attempt, {"delivery_error": text} for one that did not arrive.
    A cluster's errors can be as many as its members, so they leave Python once for as many members as fit REPEATED, pass
    through the function errors there, and are repeated for each member only as the rows are handed on. Clusters are
    dealt out by their identifier to tasks that small inputs do not shrink to one, as what comes of them is far larger.
    """
    kinds = [("cluster_id", pa.string()), ("status", pa.string()), ("errors", pa.list_(pa.string()))]
    end = pa.struct([("page_id", pa.int64()), ("assignment", pa.string()), ("group_position", pa.int32()), ("group_name", pa.string()), ("reason", pa.string())])
    schema = pa.schema([*kinds, ("ends", pa.list_(end))])

    def decided(cluster: str, ids: list[int], text: str | None) -> dict:
        answers = _answers(text)

        def ask(role: str, attempt: int, _: dict) -> object:
            given = answers.get(role) or []
            found = given[attempt - 1] if attempt <= len(given) else {"delivery_error": "no answer"}
            if isinstance(found, dict) and set(found) == {"delivery_error"}:
                raise Undelivered(str(found["delivery_error"]))
            return found

        result = adjudicate(ids, ask)
        ends = [{"page_id": i, "assignment": "accepted", "group_position": n, "group_name": g["name"]} for n, g in enumerate(result["groups"]) for i in g["page_ids"]]
        ends += [{"page_id": r["page_id"], "assignment": "rejected", "reason": r["reason"]} for r in result["rejected"]]
        return {"cluster_id": cluster, "status": result["status"], "errors": result["errors"], "ends": ends}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], 0
            for i in range(b.num_rows):
                row = decided(*(c[i].as_py() for c in b.columns))
                ends, most = row["ends"], max(1, REPEATED // max(1, sum(map(len, row["errors"]))))
                if len(ends) > most:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
                    whole = [pa.array([row[n]], k) for n, k in kinds]
                    for at in range(0, len(ends), most):
                        yield pa.record_batch([*whole, pa.array([ends[at : at + most]], pa.list_(end))], schema=schema)
                    continue
                rows.append(row)
                held += len(ends)
                if held >= ENDS:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    tasks = int(clusters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = clusters.select("cluster_id", "page_ids", "answers").repartition(tasks, "cluster_id").mapInArrow(run, f"cluster_id string, status string, errors array<string>, {ENDS_FIELD}")
    told = found.select("cluster_id", "status", errors(F.col("errors")).alias("errors"), "ends")
    return told.select("cluster_id", "status", "errors", F.inline("ends"))


def final_clusters(decided: DataFrame) -> DataFrame:
    """Accepted groups with their lasting identifiers, numbered by (cluster, position); the reviewed clusters are few."""
    groups = decided.where("assignment = 'accepted'").groupBy("cluster_id", "group_position", "group_name").agg(F.sort_array(F.collect_list("page_id")).alias("page_ids"))
    return groups.withColumn("final_cluster_id", F.format_string("final-audience-cluster-%04d", F.row_number().over(Window.orderBy("cluster_id", "group_position"))))


def adjudication_counts(decided: DataFrame) -> DataFrame:
    """One row: clusters reviewed, groups accepted, pages accepted and rejected."""
    groups = decided.where("assignment = 'accepted'").select("cluster_id", "group_position").distinct().agg(F.count(F.lit(1)).alias("final_clusters"))
    pages = decided.agg(F.countDistinct("cluster_id").alias("reviewed_clusters"), F.count_if(F.col("assignment") == "accepted").alias("accepted_pages"), F.count_if(F.col("assignment") == "rejected").alias("rejected_pages"))
    return pages.crossJoin(groups)  # one row each


def terminal_partition(source: DataFrame, decided: DataFrame) -> DataFrame:
    """source(cluster_id, page_id), decided(cluster_id, page_id) -> (cluster_id, missing, unknown, repeated, exact): whether every page ends in one place."""
    ends = decided.groupBy("cluster_id", "page_id").agg(F.count(F.lit(1)).alias("n"))
    both = source.select("cluster_id", "page_id", F.lit(1).alias("s")).join(ends, ["cluster_id", "page_id"], "full")
    out = both.groupBy("cluster_id").agg(F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("s").isNull()).alias("unknown"), F.count_if(F.col("n") > 1).alias("repeated"))
    return out.withColumn("exact", (F.col("missing") + F.col("unknown") + F.col("repeated")) == 0)


def require_partition(source: DataFrame, decided: DataFrame) -> None:
    if not terminal_partition(source, decided).where("NOT exact").isEmpty():
        raise ContractError("adjudication does not partition its source cluster")


def retry_delay(error_type: Column, status_code: Column, message: Column, retry_after: Column, attempt: Column, jitter: Column) -> Column:
    """Seconds to wait before a rate-limited answer is asked for again, null for any other error.

    The provider's header counts first, then the delay its message names, then doubling from one second to thirty with
    a jitter in [0, 1) of a quarter second.
    """
    limited = F.coalesce(error_type == "RateLimitError", F.lit(False)) | F.coalesce(status_code == 429, F.lit(False)) | F.coalesce(F.contains(message, F.lit("Error code: 429")), F.lit(False))
    asked = F.when(F.rlike(retry_after, F.lit(r"^\s*[+-]?[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]{1,2})?\s*$")), F.trim(retry_after)).cast("double")
    named = r"(?i)try again in\s+([0-9]+(?:\.[0-9]+)?)\s*(ms|s)\b"
    value = F.nullif(F.regexp_extract(message, named, 1), F.lit("")).cast("double")
    told = F.when(F.lower(F.regexp_extract(message, named, 2)) == "ms", value / 1000).otherwise(value) + 0.1
    doubled = F.least(F.pow(F.lit(2.0), attempt - 1), F.lit(30.0)) + 0.25 * jitter
    return F.when(limited, F.coalesce(F.when(asked.isNotNull(), F.greatest(asked, F.lit(0.0)) + 0.1), told, doubled))
