"""Benchmark windows against a plain search."""

import hashlib
import random
import re

import pytest

from pulsegrid.llm import decontaminate as d


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        if item is not None and n:
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if x := windows.get(tuple(w[i : i + n])):
                    found |= x
                    hit |= set(range(i, i + n))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    vocabulary = ["a", "the", "é", "X1", "b-c", "of", "日本"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice((0, 1, 3, 9, 10, 14)))) for i in range(2, 30)] + [(1, "One lonely"), (100, None), (None, "of the"), (30, "one LONELY!")]
    items = [x for x in items if len(words(x[1])) > 2 or x[0] in (1, 30, 100, None)]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(150)] + [(200, f"x {items[0][1]} y"), (201, "see: One, lonely"), (202, None), (None, "one lonely"), (203, "lonely")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), docs, items


def test_report(tables):
    documents, benchmark, docs, items = tables
    assert sorted(map(tuple, d.report(documents, benchmark).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr) == plain(docs, items)


def test_blocks_give_the_same(tables):
    documents, benchmark, _, _ = tables
    key = lambda df: sorted(map(repr, df.select("doc_id", "n_words", "hit_runs", "hit_items").collect()))
    assert key(d.scan(documents, benchmark, block_words=15)) == key(d.scan(documents, benchmark))


def test_removal(spark):
    benchmark = spark.createDataFrame([(1, "Alpha beta gamma")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Start, ALPHA beta -- gamma! End é"), (2, "alpha beta"), (3, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in d.remove(docs, benchmark, spans=True).collect()} == {1: "Start, ! End é", 2: "alpha beta", 3: None}
    assert {r["doc_id"] for r in d.remove(docs, benchmark).collect()} == {2, 3}


def test_awkward_rows(spark, awkward, nothing):
    benchmark = spark.createDataFrame([(1, "same text")], "item_id long, text string")
    assert d.report(awkward, benchmark).count() == awkward.count() and d.report(nothing, benchmark).count() == 0
    assert d.remove(awkward, benchmark).columns == awkward.columns and d.remove(awkward, benchmark).count() == awkward.count() - 3
    assert not d.report(awkward, benchmark.limit(0)).where("contaminated").count()


def test_documents(spark, small):
    docs, items = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet")
    out = sorted(map(tuple, d.report(docs, items).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)
    assert out == plain([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
