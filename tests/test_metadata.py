"""Landed metadata: continuation, normalised titles, redirects and missing pages, in any order of files."""

import json
import random

import pytest

from pulsegrid.contracts import ContractError
from pulsegrid.operators import evidence
from pulsegrid.sources import metadata

CATEGORY = lambda *names: [{"title": f"Category:{n}"} for n in names]


def response(batch, step, titles, pages, more=False, normalized=(), redirects=()):
    moves = lambda m: [{"from": a, "to": b} for a, b in m]
    query = {"pages": pages} | ({"normalized": moves(normalized)} if normalized else {}) | ({"redirects": moves(redirects)} if redirects else {})
    return {"batch": batch, "step": step, "titles": titles, "response": {"query": query} | ({"continue": {"clcontinue": "x", "continue": "||"}} if more else {})}


RESPONSES = [
    response(1, 0, ["a_b", "Old", "Gone", "Lost", "Loop", "Two"], [{"pageid": 1, "title": "A b", "extract": "é" * 700, "categories": CATEGORY("x", "y")}, {"pageid": 3, "title": "New"}, {"title": "Gone", "missing": True}], True, [("a_b", "A b")], [("Old", "Older"), ("Older", "New"), ("Loop", "Loop 2"), ("Loop 2", "Loop")]),
    response(1, 1, ["a_b", "Old", "Gone", "Lost", "Loop", "Two"], [{"pageid": 1, "title": "A b", "categories": CATEGORY("z", "x")}, {"pageid": 3, "title": "New", "extract": "three"}], True, (), [("Two", "New")]),
    response(1, 2, ["a_b", "Old", "Gone", "Lost", "Loop", "Two"], [{"pageid": 1, "title": "A b"}]),
    response(2, 0, ["New", "Old"], [{"pageid": 3, "title": "New", "categories": CATEGORY("n")}, {"pageid": 4, "title": "Old", "extract": ""}]),
]


def landed(folder, responses, files=3):
    for n in range(files):
        (folder / f"{n}.json").write_text("".join(json.dumps(r) + "\n" for r in responses[n::files]))
    return str(folder)


@pytest.mark.parametrize("seed", range(3))
def test_folds_in_any_order(spark, tmp_path, seed):
    found = metadata.read_responses(spark, landed(tmp_path, random.Random(seed).sample(RESPONSES, len(RESPONSES))))
    pages = {(r["batch"], r["page_id"]): (r["canonical_title"], r["lead"], r["categories"]) for r in metadata.fragments(found).collect()}
    assert pages == {(1, 1): ("A b", "é" * 600, ["x", "y", "z"]), (1, 3): ("New", "three", []), (2, 3): ("New", "", ["n"]), (2, 4): ("Old", "", [])}
    names = {(r["batch"], r["alias"]): r["page_id"] for r in metadata.aliases(found).collect()}
    assert names == {(1, "a_b"): 1, (1, "Old"): 3, (1, "Gone"): None, (1, "Lost"): None, (1, "Loop"): None, (1, "Two"): 3, (2, "New"): 3, (2, "Old"): 4}
    merged = {r["page_id"]: (r["lead"], r["categories"], r["conflict"]) for r in evidence.merge_metadata(metadata.fragments(found)).collect()}
    assert merged[3] == ("three", ["n"], False)


@pytest.mark.parametrize("bad", [RESPONSES[:2], RESPONSES[1:3], RESPONSES[:3] + RESPONSES[2:3], [RESPONSES[0], RESPONSES[2]], [RESPONSES[3] | {"response": {"query": {}}}], [RESPONSES[3] | {"batch": None}]])
def test_unfinished_batches_are_refused(spark, tmp_path, bad):
    with pytest.raises(ContractError):
        metadata.read_responses(spark, landed(tmp_path, bad, 1))
