"""Sets, signatures, links and components against all pairs of sets of strings."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from pulsegrid.llm import minhash as m


def plain_set(text, k=2):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain(rows, k=2, similar=80):
    """(id, size, component, kept) by comparing all pairs."""
    sets, parent = [plain_set(t, k) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        least.setdefault(find(n), []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    return sorted(((i, len(s), c := i if not s else least[find(n)], i == c) for n, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def families(seed, many):
    """Texts in families with edits of all sizes about the threshold, moved and repeated parts, and short ones."""
    rng, rows = random.Random(seed), []
    word = lambda: f"w{rng.randrange(3000)}"
    common = [word() for _ in range(60)]
    for f in range(many):
        base = [word() for _ in range(rng.choice((1, 2, 4, 9, 20, 60, 150)))] + (common if f % 3 == 0 else [])
        for _ in range(rng.choice((1, 2, 5, 9))):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + max(1, len(w) // 7))):
                at = rng.randrange(len(w))
                rng.choice((lambda: w.__setitem__(at, word()), lambda: w.insert(at, word()), lambda: len(w) > 1 and w.pop(at), lambda: w.reverse() if len(w) < 3 else None))()
            rows.append((rng.choice((len(rows), len(rows), len(rows), None)) if f % 5 == 0 else len(rows), rng.choice((" ", "\t", "  ")).join(rng.choice((x, x.upper())) for x in w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_report(spark, seed):
    rows = families(seed, 90)
    assert got(m.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == plain(rows)


def test_five_words(spark):
    rows = families(3, 60)
    found = m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(found.select("id", "n", "component", "kept")) == plain(rows, 5)


def test_members_alike_whose_centre_is_like_neither(spark):
    """One bucket holds many sets of a common passage; two of them are alike, their centre is not like them."""
    passage = [f"p{i}" for i in range(400)]
    rows = [(i, " ".join(passage + [f"own{i}x{j}" for j in range(150 + i)])) for i in range(30)]
    rows += [(100, " ".join(passage + [f"tail{j}" for j in range(150)])), (101, " ".join(passage + [f"tail{j}" for j in range(160)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(m.near_duplicates(df, k=2, bands=1, rows=1).select("id", "n", "component", "kept")) == plain(rows)


def test_rare_shingle_pairs(spark):
    rng = random.Random(5)
    sets = {}
    for n in range(120):
        base = list(sets[rng.randrange(n)]) if n and rng.random() < 0.7 else rng.sample(range(500), rng.choice((1, 3, 10, 40)))
        sets[n] = set(x if rng.random() < 0.9 else rng.randrange(500) for x in base)
    labels = {n: n % 50 for n in sets}
    found = {tuple(r)[:2] for r in m.rare_shingle_pairs(spark.createDataFrame(list(labels.items()), "node long, label long"), spark.createDataFrame([(n, sorted(s), m.parities(np.array(sorted(s), np.uint64)).tolist()) for n, s in sets.items()], "node long, hashes array<long>, parity array<long>"), 80).collect()}
    must = {(a, b) for a, b in combinations(sets, 2) if labels[a] != labels[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert must and must <= found and len(found) < 120 * 119 / 2


def test_sets_and_parts():
    rng = random.Random(7)
    for n in (0, 1, 2, 3, 50, 900):
        text = rng.choice(" \n\t").join(rng.choice(("a", "B", "é", "cc", "ß9")) for _ in range(n))
        for k in (1, 2, 5):
            assert len(m.shingle_set(text.encode(), k)) == len(plain_set(text, k))
        for part in (1, 3, 10, 1 << 20):
            assert np.array_equal(m.word_hashes(text.encode(), part), m.word_hashes(text.encode()))


def test_parities_bound_the_difference():
    rng = np.random.default_rng(4)
    for size in (1, 30, 500, 5000):
        x = np.unique(rng.integers(0, 2**64, size, np.uint64))
        y = np.unique(np.concatenate((x[: size * 3 // 4], rng.integers(0, 2**64, size // 3, np.uint64))))
        bits = int(np.bitwise_count((m.parities(x) ^ m.parities(y)).view(np.uint64)).sum())
        assert 0 < bits <= len(np.setxor1d(x, y))


@pytest.mark.parametrize("size", [4, 60, 2000])
def test_bins_agree_as_often_as_sets_are_alike(size):
    rng, signer, agree = np.random.default_rng(0), m.Signatures(), []
    for _ in range(60):
        x = rng.integers(0, 2**64, size * 5 // 4, np.uint64)
        a, b = np.sort(x[:size]), np.sort(x[size // 4 :])  # three parts common of five
        agree.append((signer.values(a) == signer.values(b)).mean())
    assert abs(np.mean(agree) - 0.6) < 0.05


def test_awkward(spark, awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert got(m.report(awkward)) == plain(rows)
    assert m.report(nothing).count() == 0
    assert m.keep_one(nothing).count() == 0
    left = m.keep_one(awkward)
    assert left.columns == awkward.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [-5, 1, 3, 4, 5, 6, 7, 7, 7]
