"""Rankings against scores of all documents; bounds hold for every document and query."""

import random
import re
from collections import Counter
from math import floor, log

import pytest

from pulsegrid.llm import lexical as x

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, queries, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in queries:
        found = []
        for doc, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // length if length else 10
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, place + 1, doc, -score) for place, (score, _, _, doc) in enumerate(sorted(found, key=lambda r: r[:3])[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed, many):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)] + ["The", "ÉTÉ", "naïve", "漢字", "7up"]
    texts = [rng.choice([" ", ", ", "\n\x00"]).join(rng.choice(vocabulary) for _ in range(rng.choice((0, 1, 5, 30, 200)))) for _ in range(many)]
    return [(rng.choice((i, i, i, 7, None)), rng.choice(texts[: 1 + i])) for i in range(many)], [(f"q{i % 9}", t) for i, t in enumerate(rng.sample(texts, 12))] + [(None, "the ÉtÉ"), ("none", None), ("blank", " .,"), ("unknown", "zzz"), ("the", "the")]


@pytest.mark.parametrize("bounds", [{}, {"most": 3}, {"terms": 5}])
def test_search(spark, bounds):
    docs, queries = corpus(1, 300)
    d, q = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(queries, "item_id string, text string")
    assert got(x.search(d, q, **bounds)) == plain(docs, queries)


def test_few_and_k(spark):
    docs, queries = corpus(2, 60)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "item_id string, text string")
    for k in (1, 100):
        assert got(x.search(d, q, k=k)) == plain(docs, queries, k)


def test_ties_of_many_copies(spark):
    docs = [(5000 - i, "the same words of all") for i in range(3000)] + [(9000 + i, f"other {i}") for i in range(200)]
    d, q = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([("a", "same words"), ("b", "the"), ("c", "other 17")], "item_id string, text string")
    assert got(x.search(d, q)) == plain(docs, [("a", "same words"), ("b", "the"), ("c", "other 17")])


def test_bounds(spark):
    docs, queries = corpus(3, 200)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "item_id string, text string")
    (block,) = x.blocks(q)
    counted = x.postings(d, block)
    stats = x.Statistics(counted, block)
    index = x.quantised(counted, stats)
    exact = {(r["query"], r["row"]): r for r in x.candidates(index, block, stats, k=10_000, group=2, cells=50).collect()}
    few = x.candidates(index, block, stats, k=3, group=3, cells=80)
    scores = {}
    for r in index.collect():
        tf = dict(zip(r["terms"], r["tfs"]))
        m = 10 + 90 * r["n"] * stats.documents // stats.length
        for query, own in enumerate(block.terms):
            if score := sum(int(stats.weights[t]) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in own.tolist() if t in tf):
                scores[query, r["row"]] = score
    assert scores.keys() <= exact.keys() and all(exact[key]["lower"] <= s <= exact[key]["upper"] for key, s in scores.items())
    assert few.count() < len(exact)
    reach = {q: sorted((s for (p, _), s in scores.items() if p == q), reverse=True)[:3][-1] for q, _ in scores}
    assert {key for key, s in scores.items() if s >= reach[key[0]]} <= {(r["query"], r["row"]) for r in few.collect()}


def test_long_texts_in_parts():
    text = " ".join(f"w{i % 50}" for i in range(5000)).encode()
    for size in (1, 10, 1000, 1 << 20):
        assert [w for p in x.parts(text, size) for w in p] == text.split()


def test_awkward(spark, awkward, nothing):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    queries = [("a", "the same text"), ("b", "word7 one two"), ("c", "ünïcödé")]
    q = spark.createDataFrame(queries, "item_id string, text string")
    assert got(x.search(awkward, q)) == plain(docs, queries)
    assert x.search(nothing, q).count() == 0
    assert x.search(awkward, q.limit(0)).count() == 0
