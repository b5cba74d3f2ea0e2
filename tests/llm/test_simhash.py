"""Fingerprints, links and components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from pulsegrid.llm import simhash as s


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(prints):
    """id -> smallest id reachable, by comparing all pairs."""
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprint():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 500):
        text = " ".join(rng.choice(["A", "bé", "The", "x y", "z"]) for _ in range(n))
        assert s.fingerprint(text.encode()) & (2**64 - 1) == plain(text)


@pytest.mark.parametrize("hot", [s.HOT, 1])
def test_links_of_bits(spark, hot):
    rng = random.Random(2)
    prints, centre = {}, [rng.getrandbits(64) for _ in range(12)]
    for i in range(400):
        p = rng.choice(centre)
        for _ in range(rng.choice((0, 1, 2, 3, 4, 6))):
            p ^= 1 << rng.randrange(64)
        prints[i] = p - (1 << 64) if p >> 63 else p
    first = {}
    for i, p in prints.items():
        first.setdefault(p, i)
    reps = spark.createDataFrame([(p, i) for p, i in first.items()], "fp long, rep long")
    found = {r["node"]: r["component"] for r in s.connected_components(s.fingerprint_links(reps, hot)).collect()}
    assert {i: found.get(first[p], first[p]) for i, p in prints.items()} == components(prints)


def test_spanning_forest():
    rng = np.random.default_rng(0)
    for _ in range(100):
        n = int(rng.integers(1, 60))
        keys, fps, reps = np.sort(rng.integers(0, 5, n)), rng.integers(0, 1 << 9, n), rng.permutation(1000)[:n]
        src, dst = s._linked(keys, fps, reps, 3)
        label = {int(r): int(r) for r in reps}
        pairs = [(int(reps[i]), int(reps[j])) for i in range(n) for j in range(i) if keys[i] == keys[j] and int(fps[i] ^ fps[j]).bit_count() <= 3]

        def joined(edges, nodes):
            parent = dict(nodes)

            def find(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for a, b in edges:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
            return {i: find(i) for i in parent}

        assert joined(zip(src.tolist(), dst.tolist()), label) == joined(pairs, label) and len(src) < n


def test_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = {r["doc_id"]: r for r in s.near_duplicate_report(docs).collect()}
    prints = {r["doc_id"]: plain(r["text"]) for r in docs.collect()}
    assert {i: r["fingerprint"] for i, r in out.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in out.items()} == components(prints)


def test_awkward_rows(awkward, nothing):
    out = s.near_duplicate_report(awkward).collect()
    assert len(out) == awkward.count() and s.near_duplicate_report(nothing).count() == 0
    by = {r["doc_id"]: r for r in out if r["doc_id"] != 7}
    assert by[2]["component_id"] == by[None]["component_id"] == 1
    assert {by[i]["fingerprint"] for i in (3, 4, 5)} == {"0" * 16} and {by[i]["component_id"] for i in (3, 4, 5)} == {3}
    kept = s.keep_one(awkward)
    assert kept.columns == awkward.columns and {r["doc_id"] for r in kept.collect()} == {-5, 1, 3, 6, 7, None}


def test_rows_of_one_id_are_told_apart(spark):
    """What only one row has is kept, whatever other rows of its id are."""
    rng = random.Random(2)
    a, b = (" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(2))
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (None, b)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in s.keep_one(docs).collect()) == sorted([(1, a), (5, b), (0, b)])


def test_links_through_a_row_without_id(spark, monkeypatch):
    """Two fingerprints that meet only through one of a row without id."""
    monkeypatch.setattr(s, "fingerprints", lambda documents, *_: documents.select(s.F.col("doc_id").alias("id"), s.F.lit(0).cast("long").alias("mark"), s.F.col("text").cast("long").alias("fp")))
    docs = spark.createDataFrame([(8, str(0)), (None, str(0b111)), (6, str(0b111111)), (None, str(1 << 40)), (3, str(1 << 50 | 0xFFFF00))], "doc_id long, text string")
    out = {r["fp"]: r["component"] for r in s.near_duplicates(docs).collect()}
    assert out == {0: 6, 0b111: 6, 0b111111: 6, 1 << 40: 6, 1 << 50 | 0xFFFF00: 3}
