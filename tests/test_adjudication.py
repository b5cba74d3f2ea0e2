"""Decisions: every way a proposal, critique or revision can fail, and the flow between the roles."""

import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError
from pulsegrid.operators import adjudication as a
from pulsegrid.sources import files

IDS = [1, 2, 3, 4]


def proposal(groups=(("G", [1, 2]),), rejected=(3, 4)):
    return {"groups": [{"name": n, "page_ids": list(i), "rationale": "r"} for n, i in groups], "rejected": [{"page_id": i, "reason": "x"} for i in rejected]}


def challenge(dimension="naming", ids=(1,), action="revise"):
    return {"dimension": dimension, "message": "m", "page_ids": list(ids), "required_action": action}


APPROVED = {"approved": True, "challenges": []}


def test_valid_decision():
    out = a.decide(IDS, proposal())
    assert out["status"] == "valid" and [g["page_ids"] for g in out["groups"]] == [[1, 2]]


@pytest.mark.parametrize(
    "bad",
    [None, [], {}, {"groups": []}, {"groups": {}, "rejected": []}, proposal() | {"more": 1}, {"groups": [{"name": "", "page_ids": [1], "rationale": "r"}], "rejected": []}, {"groups": [{"name": "n", "page_ids": [True, 2], "rationale": "r"}], "rejected": []}, {"groups": [], "rejected": [{"page_id": True, "reason": "x"}]}, {"groups": [], "rejected": [{"page_id": 1, "reason": " "}]}],
)
def test_bad_shapes(bad):
    out = a.decide(IDS, bad)
    assert out["errors"] == ["invalid_proposal_shape"] and {r["page_id"] for r in out["rejected"]} == set(IDS) and not out["groups"]


@pytest.mark.parametrize(
    "given,errors",
    [
        (proposal(rejected=(3,)), ["omitted_page_id:4"]),
        (proposal(rejected=(2, 3, 4)), ["multiply_assigned_page_id:2"]),
        (proposal(groups=(("G", [1, 1]),), rejected=(2, 3, 4)), ["duplicate_page_id:1", "accepted_group_has_fewer_than_two_distinct_pages:G", "multiply_assigned_page_id:1"]),
        (proposal(groups=(("G", [1, 9]),), rejected=(2, 3, 4, 8)), ["unknown_page_id:9", "unknown_page_id:8"]),
    ],
)
def test_decision_errors(given, errors):
    assert a.decision_errors(IDS, given) == errors


@pytest.mark.parametrize("bad", [None, {"approved": True}, {"approved": True, "challenges": [challenge()]}, {"approved": False, "challenges": []}, {"approved": 1, "challenges": []}, {"approved": False, "challenges": [challenge("other")]}, {"approved": False, "challenges": [challenge(ids=[9])]}, {"approved": False, "challenges": [challenge(ids=[1, 1])]}, {"approved": False, "challenges": [challenge(ids=[])]}, {"approved": False, "challenges": [challenge(action="drop")]}])
def test_bad_critiques(bad):
    assert a.parse_critique(IDS, bad) is None


def test_revision_keeps_rejections():
    critique = {"approved": False, "challenges": [challenge("brand_safety", [1]), challenge("naming", [2], "reject")]}
    out = a.revise(IDS, proposal(), critique, proposal(groups=(("G", [1, 2, 3]),), rejected=(4,)))
    assert out["errors"] == ["resurrected_page_id:3", "critic_required_rejection_missing:1", "critic_required_rejection_missing:2"]
    assert a.revise(IDS, proposal(), {"approved": False, "challenges": [challenge()]}, proposal())["status"] == "valid"


def flow(**answers):
    asked = []

    def ask(role, attempt, request):
        asked.append((role, attempt))
        given = answers[role][attempt - 1]
        if isinstance(given, Exception):
            raise given
        return given

    return a.adjudicate(IDS, ask), asked


def test_flow():
    lost = a.Undelivered("timeout")
    out, asked = flow(proposer=[lost, proposal()], critic=[APPROVED])
    assert out["status"] == "valid" and asked == [("proposer", 1), ("proposer", 2), ("critic", 1)]
    out, _ = flow(proposer=[proposal()], critic=[lost] * 3)
    assert out["errors"] == ["exhausted_delivery:critic"] and len(out["rejected"]) == 4
    assert flow(proposer=[proposal()], critic=["?"])[0]["errors"] == ["invalid_critique"]
    out, asked = flow(proposer=[proposal(rejected=())], critic=[APPROVED], reviser=[proposal()])
    assert out["status"] == "valid" and asked[-1] == ("reviser", 1)


def test_scripted_clusters(spark):
    decisions = [("c1", "proposer", 1, json.dumps(proposal()), None), ("c1", "critic", 1, json.dumps(APPROVED), None), ("c2", "proposer", 1, None, "down"), ("c2", "proposer", 2, None, "down"), ("c2", "proposer", 3, None, "down")]
    answers = files.scripted_answers(spark.createDataFrame(decisions, "cluster_id string, role string, attempt int, output string, delivery_error string"))
    out = a.adjudicate_clusters(answers.withColumn("page_ids", F.array(*(F.lit(i).cast("long") for i in IDS)))).cache()
    assert [(r["final_cluster_id"], r["page_ids"]) for r in a.final_clusters(out).collect()] == [("final-audience-cluster-0001", [1, 2])]
    assert a.adjudication_counts(out).first().asDict() == {"reviewed_clusters": 2, "accepted_pages": 2, "rejected_pages": 6, "final_clusters": 1}
    source = answers.select("cluster_id", F.explode(F.array(*(F.lit(i).cast("long") for i in IDS))).alias("page_id"))
    a.require_partition(source, out)
    with pytest.raises(ContractError):
        a.require_partition(source, out.where("page_id <> 4"))


@pytest.mark.parametrize("change", ["'' AS canonical_title", "repeat('x', 601) AS lead", "array('a','a') AS selected_categories", "array('') AS selected_categories"])
def test_visible_members(spark, change):
    row = spark.sql("SELECT 1L AS page_id, 't' AS canonical_title, 'l' AS lead, array('a') AS selected_categories, 's' AS secret")
    assert a.visible_members(row).columns == ["page_id", "canonical_title", "lead", "selected_categories"]
    with pytest.raises(Exception, match="Preliminary Cluster member is invalid"):
        name = change.rsplit(" ", 1)[1]
        a.visible_members(row.withColumn(name, F.expr(change.rsplit(" AS ", 1)[0]))).collect()


def test_broken_answers_close_the_cluster(spark):
    rows = [("c1", [1, 2], "{not json"), ("c2", [3, 4], "[1]"), ("c3", [5, 6], '{"proposer": 7}'), ("c4", [7, 8], None)]
    out = a.adjudicate_clusters(spark.createDataFrame(rows, "cluster_id string, page_ids array<long>, answers string")).collect()
    assert {r["page_id"] for r in out} == set(range(1, 9)) and {(r["status"], r["reason"]) for r in out} == {("invalid", "invalid_adjudication")}


def test_errors_leave_python_once_for_a_cluster(spark):
    """A closed cluster of many pages has as many errors; a copy of them for each page, in one batch, took gigabytes."""
    ids = list(range(3000))
    answers = json.dumps({"proposer": [{"groups": [], "rejected": []}], "critic": [{"approved": False, "challenges": [challenge("brand_safety", (0,), "reject")]}], "reviser": [{"groups": [], "rejected": []}]})
    held = []
    out = a.adjudicate_clusters(spark.createDataFrame([("c", ids, answers), ("d", [1, 2], answers)], "cluster_id string, page_ids array<long>, answers string"), lambda e: held.append(e) or F.array_join(e, ","))
    assert len(held) == 1 and out.columns == [x.split()[0] for x in a.RESULT.split(", ")]
    found = out.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("page_id").alias("pages"), F.min("errors").alias("least"), F.max("errors").alias("most"), F.max("status").alias("status")).orderBy("cluster_id").collect()
    assert [(r["n"], r["pages"], r["status"]) for r in found] == [(3000, 3000, "invalid"), (2, 2, "invalid")]
    assert found[0]["least"] == found[0]["most"] == ",".join(f"omitted_page_id:{i}" for i in ids)
    assert "Generate inline" in (plan := out._jdf.queryExecution().optimizedPlan().toString()) and plan.index("Generate inline") < plan.index("array_join") < plan.index("MapInArrow")


def test_proposed_rejections_of_many_pages():
    """In proportion to the pages: a look through all members for each took hours."""
    ids = list(range(200_000))
    assert a.proposed_rejections(ids, {"rejected": [{"page_id": i, "reason": "x"} for i in reversed(ids)]}) == ids[::-1]


def test_members_that_errors_are_repeated_for_come_in_pieces(spark):
    """All rows that come of one row are held at once: 2,000 members with 2,000 errors of 35 characters were 140 MB, 10,000 ended the executor."""
    ids = list(range(10**18, 10**18 + 2000))
    given = [("a", ids, '{"proposer":[{"groups":[],"rejected":[]}],"critic":[{"approved":true,"challenges":[]}],"reviser":[{"groups":[],"rejected":[]}]}'), ("b", ids[:2], None)]
    df = spark.createDataFrame(given, "cluster_id string, page_ids array<long>, answers string")
    pieces = a.adjudicate_clusters(df, lambda e: F.struct(F.monotonically_increasing_id().alias("piece"), F.size(e).alias("n")))
    counts = pieces.where("cluster_id = 'a'").groupBy("errors.piece", "errors.n").count().collect()
    assert {r["n"] for r in counts} == {2000} and sum(r["count"] for r in counts) == 2000
    assert max(r["count"] for r in counts) * 2000 * 35 <= 16_000_000
    assert [(r["page_id"], r["assignment"]) for r in pieces.where("cluster_id = 'a'").orderBy("page_id").collect()] == [(i, "rejected") for i in ids]
    assert pieces.where("cluster_id = 'b'").count() == 2
