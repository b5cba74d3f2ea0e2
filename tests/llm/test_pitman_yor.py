"""The language model: exact counts and base scores, seating laws, and probabilities that add up to one."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import pitman_yor as p


def words(text):
    return (text or "").encode().translate(p.FOLD_BYTES).split() + [p.END]


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 5 == 1


def check(df, **more):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    counts = Counter(w for d, t in rows if not held(d) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    wanted = sorted(repr((d, held(d), len(words(t)), sum(counts[w] > 0 for w in words(t)), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t)), 5))) for d, t in rows)
    out = p.score(df, **more).collect()
    assert sorted(repr((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5))) for r in out) == wanted
    assert all(math.isfinite(r["score"]) and r["score"] <= 1e-9 for r in out)
    return out


@pytest.mark.parametrize("frequent", [p.FREQUENT, 40])
def test_documents(spark, small, frequent):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    out = check(docs, frequent=frequent)
    scores = {r["doc_id"]: r["score"] for r in out}
    key = "scores"
    known = test_documents.__dict__.setdefault(key, scores)
    assert all(scores[i] == pytest.approx(known[i], rel=1e-6) for i in scores)
    unseen = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_awkward_rows(awkward, nothing):
    check(awkward)
    assert p.score(nothing).count() == 0


def test_probabilities_add_up(spark):
    texts = ["a b a c", "b b a", "c d e f a a a", "A b", None] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counted = p.counts(df)
    state = p.sample(counted)
    rows = counted.mapInArrow(p._predictive(state), "word string, n long, roots binary, values binary").toArrow()
    dense = p.Dense(state, rows)
    unseen = dense.average(dense.unseen[None], np.arange(p.CONTEXTS))
    assert (10 ** dense.logs.astype(float)).sum(axis=0) + unseen == pytest.approx(np.ones(p.CONTEXTS), abs=1e-5)
    assert {r["word"]: r["n"] for r in counted.collect()} == {k.decode(): v for k, v in Counter(w for t in texts for w in words(t)).items()}


def test_merging_keeps_counts():
    rng = np.random.default_rng(1)
    names = sorted(rng.choice(list("abcdefg"), 200).tolist())
    pairs = [[(int(c), int(rng.integers(1, 9))) for c in sorted(rng.choice(p.CONTEXTS, 3, replace=False))] for _ in names]
    pack = lambda x: np.array(x, p._PAIR).tobytes()
    for size in (1, 7, 50, 200):
        batches = (pa.record_batch([pa.array(names[i : i + size]), pa.array([pack(x) for x in pairs[i : i + size]], pa.binary())], ["word", "pairs"]) for i in range(0, 200, size))
        out = [r for b in p._merge_sorted(batches) for r in b.to_pylist()]
        want: dict = {}
        for w, x in zip(names, pairs):
            for c, n in x:
                want.setdefault(w, Counter())[c] += n
        assert [r["word"] for r in out] == sorted(want)
        assert all(dict(np.frombuffer(r["pairs"], p._PAIR).tolist()) == dict(want[r["word"]]) and r["n"] == sum(want[r["word"]].values()) for r in out)


def test_exact_draws_follow_the_law():
    d, strength, base, c = 0.4, 2.0, 0.3, 4
    weights = Counter()
    for seats in itertools.product(range(c), repeat=c):  # all seatings, customer by customer
        tables, w, ok = [], 1.0, True
        for s in seats:
            if s < len(tables):
                w *= tables[s] - d
                tables[s] += 1
            elif s == len(tables):
                w *= (strength + d * len(tables)) * base
                tables.append(1)
            else:
                ok = False
                break
        if ok:
            weights[len(tables)] += w
    n = 40_000
    h = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    t = p.draw_tables(np.full(n, float(c)), np.full(n, strength), np.full(n, base), d, p.log_stirling(d), h, 0, 0)
    for k in range(1, c + 1):
        assert (t == k).mean() == pytest.approx(weights[k] / sum(weights.values()), abs=0.01)


def test_blocks_follow_single_seating():
    d, strength, base, c, n = 0.5, 5.0, 0.2, 600, 4000
    h = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    t = p.draw_tables(np.full(n, float(c)), np.full(n, strength), np.full(n, base), d, p.log_stirling(d), h, 0, 0)
    rng, one = np.random.default_rng(0), p.draw_tables(np.full(n, float(p.EXACT)), np.full(n, strength), np.full(n, base), d, p.log_stirling(d), h, 0, 0)
    for i in range(p.EXACT, c):
        new = base * (strength + d * one)
        one = one + (rng.random(n) < new / (new + i - d * one))
    assert t.mean() == pytest.approx(one.mean(), rel=0.03)


def test_perplexity(spark):
    scored = spark.createDataFrame([(True, 10, -20.0, -10.0), (False, 5, -5.0, -5.0)], "held_out boolean, n_tokens long, base_score double, score double")
    out = {r["held_out"]: (r["perplexity"], r["base_perplexity"]) for r in p.perplexity(scored).collect()}
    assert out[True] == (pytest.approx(10), pytest.approx(100))


def test_words_of_one_class_are_contexts_of_their_own(spark):
    # "xbag" and "ybag" end alike, so that classes alone cannot tell what follows them
    texts = ["xbag one", "ybag two"] * 40
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, "xbag one"), (101, "xbag two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    (a, b) = p.context_classes([b"xbag", b"ybag"])
    assert a == b
    got = lambda f: {r["doc_id"]: r["score"] for r in f(df, held=F.col("doc_id") >= 100).collect()}
    by_words, by_classes = got(p.score), got(p.score_by_classes)
    assert by_words[100] > by_words[101] + 0.5
    assert by_classes[100] == pytest.approx(by_classes[101], abs=0.2)


@pytest.mark.parametrize("frequent", [p.FREQUENT, 2])
def test_word_probabilities_add_up(spark, monkeypatch, frequent):
    """Known words and all unseen ones together have a probability of one after every word, after new ones and at the start; counts are plain ones."""
    monkeypatch.setattr(p, "BUCKET_BYTES", 8)
    texts = ["a b a c a b", "b b a a c", "c d e f a a a", "A b", None] * 3
    known, contexts = ["", *"abcdef", "never"], ["", *"abcdef", "new"]  # an empty word ends a text, an empty context begins it
    asked = [f"{c} {w}" for c in contexts for w in known]
    df = spark.createDataFrame(list(enumerate(texts + asked)), "doc_id long, text string")
    joined, levels, sent, parts = p._model(df, frequent, F.col("doc_id") >= len(texts))
    got, counts = {}, {}
    for r in joined.collect():
        b, probability = p._probabilities(r.asDict(recursive=True), sent, levels, parts)
        pairs = list(zip(b.u.tolist(), b.h[b.owner].tolist()))
        got |= dict(zip(pairs, probability.tolist()))
        counts |= dict(zip(pairs, b.c.tolist()))
    number = dict(zip(["", *"abcdef", "never", "new"], p.word_ids([w.encode() for w in ["", *"abcdef", "never", "new"]]).tolist()))
    for c in contexts:
        u = number[c] if c else 0
        assert sum(got[u, number[w]] for w in known) == pytest.approx(1, abs=1e-9)
    plain = Counter((a, b) for t in texts for a, b in itertools.pairwise([None, *words(t)]))
    assert {k: n for k, n in counts.items() if n} == {(number[a.decode()] if a is not None else 0, number[b.decode()]): n for (a, b), n in plain.items()}
