"""Shared passages against their definition."""

import random
from itertools import pairwise

import numpy as np
import pytest

from pulsegrid.llm import repeats as r


def test_nodes_are_the_first_minima():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n, width = int(rng.integers(0, 80)), int(rng.integers(1, 25))
        values = rng.integers(0, int(rng.integers(1, 60)) + 1, n).astype(np.uint64) << np.uint64(30)
        assert r.first_minima(values, width).tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(n - width + 1)]


def test_cells_are_the_pairs_of_minima(monkeypatch):
    """Every passage of PASSAGE words has the cell of its two minima, near its places, whatever the blocks and the texts beside it."""
    monkeypatch.setattr(r, "BLOCK", 64)
    rng = random.Random(4)
    texts = [" ".join(f"v{rng.randrange(60)}" for _ in range(n)).encode() for n in (0, 49, 50, 51, 130, 300)] + [b"the " * 200]
    with np.errstate(over="ignore"):
        words, bounds = r.word_hashes(texts)
        keys, centres = r.cells(words, bounds)
        found = {(int(np.searchsorted(bounds, c, "right")) - 1, int(k)) for k, c in zip(keys, centres)}
        wanted = set()
        for i, text in enumerate(texts):
            alone = r.word_hashes([text])[0]
            for p in range(len(alone) - r.PASSAGE + 1):
                code = r.shingle_codes(alone[p : p + r.PASSAGE])
                least = np.array([code[np.argmin(code * f & np.uint64((1 << 64) - (1 << r.PLACE)))] for f in r.FACTORS])
                wanted |= {(i, int(r._mixed(r._mixed(least[x : x + 1] + np.uint64(n)) * r._B1 + least[y : y + 1] * r._B2)[0])) for n, (x, y) in enumerate(r.JOINS)}
    assert found == wanted and sum(i == 6 for i, _ in found) == 4


def test_words_are_hashed_alike_wherever_they_stand(monkeypatch):
    texts = [b"The quick\tbrown\x0bFOX", b"fox THE \x00 quick", None, b"", b" \n ", "Ünï the ﬁ".encode(), b"a " * 100 + b"the"]
    words, bounds = r.word_hashes(texts)
    split = [(t or b"").translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split() for t in texts]
    assert np.diff(bounds).tolist() == list(map(len, split))
    by_word = {}
    for w, h in zip((w for t in split for w in t), words.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    monkeypatch.setattr(r, "TOGETHER", 16)
    monkeypatch.setattr(r, "SPLIT", 60)
    again, there = r.word_hashes(texts)
    assert again.tolist() == words.tolist() and there.tolist() == bounds.tolist()


def corpus():
    rng = random.Random(3)
    para = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    p1, p2, p3, p4, p5 = para(55), para(50), para(49), para(60), para(120)
    docs = [para(rng.randint(0, 300)) for _ in range(60)]
    for i in (3, 8, 20):
        docs[i][10:10] = p1
    for i in (5, 30):
        docs[i] += p2
    for i in (6, 31):
        docs[i] = p3 + docs[i]
    docs[7] += p4
    docs[40] = [*p4[:31], "changed", *p4[32:]] + docs[40]
    docs[9] += [*p4[:20], "added", *p4[20:]]
    docs[33] += [*p4[:28], *p4[29:]]
    docs[41] += ["x" if i in (15, 30, 31, 45) else w for i, w in enumerate(p4)]
    docs[42], docs[43] = ["e" if i in (40, 80) else w for i, w in enumerate(p5)], para(30) + p5 + para(10)
    docs[50], docs[52] = docs[51], docs[53][:20]
    for i in range(0, 60, 2):
        docs[i] = docs[i] + ["of", "the", "to"] * 10
    return docs


def classes(docs):
    """Smallest index reachable by equal texts and by 50 words equal but for one."""
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def union(i, j):
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)

    changed, missing, plain, same = {}, {}, {}, {}
    for i, d in enumerate(docs):
        union(i, same.setdefault(tuple(d), i))
        for at in range(len(d) - 49):
            w = tuple(d[at : at + 50])
            for k in range(50):
                rest = w[:k] + w[k + 1 :]
                union(i, changed.setdefault((rest, k), i))
                missing.setdefault(rest, set()).add(i)
            plain.setdefault(w[1:], i)
            plain.setdefault(w[:-1], i)
    for rest, i in plain.items():
        for j in missing.get(rest, ()):
            union(i, j)
    return [find(i) for i in range(len(docs))]


@pytest.mark.parametrize("local,values", [(r.LOCAL, r.BROADCAST_VALUES), (1, r.BROADCAST_VALUES), (0, 0)])
def test_classes(spark, monkeypatch, local, values):
    monkeypatch.setattr(r.linked_texts, "__defaults__", (local, values))
    docs = corpus()
    rows = [(i, " ".join(d).upper() if i == 3 else "\n".join(d)) for i, d in enumerate(docs)] + [(60, None), (61, "")]
    out = {x["doc_id"]: x for x in r.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    wanted = classes([*docs, [], []])
    assert {i: x["class_id"] for i, x in out.items()} == dict(enumerate(wanted))
    groups = [i for i in range(60) if wanted.count(wanted[i]) > 1]
    assert sorted(i for i, x in out.items() if x["repeated"]) == sorted(i for i in groups if len(docs[i]) >= 50)


def test_crowded_passage(spark, monkeypatch):
    """Many texts around one line, and many edited copies of one passage, beyond what is compared in pairs."""
    rng = random.Random(5)
    para = lambda n: [f"v{rng.randrange(9000)}" for _ in range(n)]
    line, passage = para(9), para(60)
    docs = [para(40) + line + para(40) for _ in range(40)]
    for i in range(12):
        own = list(passage)
        own[rng.randrange(60)] = f"edit{i}"
        docs.append(para(5) + own + para(5))
    monkeypatch.setattr(r.linked_texts, "__defaults__", (4, r.BROADCAST_VALUES))
    monkeypatch.setattr(r, "CHUNK", 3)
    monkeypatch.setattr(r, "FEW", 3)
    out = {x["doc_id"]: x["class_id"] for x in r.shared_passages(spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")).collect()}
    assert [out[i] for i in range(len(docs))] == classes(docs)


def test_awkward_rows(awkward, nothing):
    out = r.shared_passages(awkward).collect()
    assert len(out) == awkward.count() and r.shared_passages(nothing).count() == 0
    assert {x["class_id"] for x in out if x["doc_id"] in (1, 2, None)} == {1}
    assert not any(x["repeated"] for x in out)


def test_many_copies(spark, monkeypatch):
    """Copies beyond what is broadcast are taken out by a shuffle, with the same result."""
    rng = random.Random(7)
    passage = [f"v{rng.randrange(3000)}" for _ in range(60)]
    texts = [" ".join(passage)] * 3 + [" ".join(["own", *passage, "words"])] * 2 + ["short"] * 2 + ["alone"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(r._without_copies, "__defaults__", (0,))
    assert {x["doc_id"]: (x["class_id"], x["repeated"]) for x in r.shared_passages(df).collect()} == {**dict.fromkeys(range(5), (0, True)), 5: (5, False), 6: (5, False), 7: (7, False)}


def test_few_different_words(spark):
    """Repeated shingles count as often as they occur, so texts over seven words are found like any other."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(7)}" for _ in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:30], "w9", *base[31:]])), (3, " ".join(["the"] * 80)), (4, " ".join(["the"] * 55 + ["end"])), (5, " ".join(f"w{rng.randrange(7)}" for _ in range(60)))]
    out = {x["doc_id"]: x["class_id"] for x in r.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5}


def test_links_through_rows_without_or_with_one_id(spark):
    rng = random.Random(9)
    para = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    p1, p2, p3 = para(80), para(80), para(80)
    rows = [(9, p1 + para(9)), (None, para(9) + p1 + para(9) + p2), (4, p2 + para(5)), (7, p3), (7, para(60)), (None, p3 + para(3)), (None, para(70)), (1 << 62, para(55))]
    out = r.shared_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()
    assert sorted((str(x["doc_id"]), str(x["class_id"]), x["repeated"]) for x in out) == sorted([("9", "4", True), ("None", "4", True), ("4", "4", True), ("7", "7", True), ("7", "7", False), ("None", "7", True), ("None", "None", False), (str(1 << 62), str(1 << 62), False)])


def jaccard(a, b):
    """The largest similarity of the five-word shingles of passages of 50 words or more: all of them."""
    a, b = ([tuple(x[i : i + 5]) for i in range(len(x) - 4)] for x in (a, b))
    best = 0.0
    of_b = [(k, m, set(b[k:m])) for k in range(len(b)) for m in range(k + 46, len(b) + 1)]
    for i in range(len(a)):
        for j in range(i + 46, len(a) + 1):
            s = set(a[i:j])
            for _, _, o in of_b:
                c = len(s & o)
                best = max(best, c / (len(s) + len(o) - c))
    return best


def edited(n, edit):
    own = [f"w{i}" for i in range(n)]
    return own, edit(list(own))


EDITS = {
    "two adjacent words replaced": edited(60, lambda w: [*w[:29], "x1", "x2", *w[31:]]),
    "two words inserted": edited(60, lambda w: [*w[:30], "x1", "x2", *w[30:]]),
    "six adjacent words replaced": edited(100, lambda w: [*w[:47], *(f"x{i}" for i in range(6)), *w[53:]]),
    "ten words deleted": edited(100, lambda w: [*w[:45], *w[55:]]),
    "words 2 and 49 changed": edited(51, lambda w: [w[0], "x1", *w[2:48], "x2", *w[49:]]),
    "45 equal words": edited(52, lambda w: [*w[:45], *(f"x{i}" for i in range(7))]),
    "44 equal words": edited(52, lambda w: [*w[:44], *(f"x{i}" for i in range(8))]),
    "three words replaced": edited(60, lambda w: [*w[:29], "x1", "x2", "x3", *w[32:]]),
    "two words far apart replaced": edited(60, lambda w: [*w[:20], "x1", *w[21:40], "x2", *w[41:]]),
    "two sentences swapped": edited(60, lambda w: w[30:] + w[:30]),
    "the first two of three sentences swapped": edited(120, lambda w: w[40:80] + w[:40] + w[80:]),
    "four sentences reversed": edited(60, lambda w: w[45:] + w[30:45] + w[15:30] + w[:15]),
}


@pytest.mark.parametrize("local", [r.LOCAL, 0])
def test_phrases_edited(spark, monkeypatch, local):
    """By the definition, with 0 through the steps for crowded passages."""
    monkeypatch.setattr(r.linked_texts, "__defaults__", (local, r.BROADCAST_VALUES))
    rows, wanted = [], {}
    for n, (a, b) in enumerate(EDITS.values()):
        for k, words in enumerate((a, b)):
            rows.append((2 * n + k, " ".join([*(f"l{n}.{k}.{i}" for i in range(30)), *(f"{w}.{n}" for w in words), *(f"r{n}.{k}.{i}" for i in range(30))])))
        wanted[2 * n] = wanted[2 * n + 1] = 2 * n
        if list(EDITS)[n] in ("44 equal words", "three words replaced", "two words far apart replaced", "four sentences reversed"):
            wanted[2 * n + 1] = 2 * n + 1
    out = {x["doc_id"]: x["class_id"] for x in r.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == wanted


def test_alike_is_the_definition():
    """Against every pair of passages, on random edits and those above."""
    rng = random.Random(11)
    pairs = list(EDITS.values())
    for _ in range(14):
        words = [f"w{i}" for i in range(rng.randint(52, 62))]
        other = list(words)
        for _ in range(rng.randint(1, 2)):
            at, n = rng.randrange(3, len(other) - 6), rng.randint(0, 3)
            other[at : at + rng.randint(0, 3)] = [f"x{rng.random()}" for _ in range(n)]
        pairs.append((words, other))
    for n in (1, 1, 1, 2, 2):  # sentences that changed places, one word edited in some
        words = [f"w{i}" for i in range(rng.randint(58, 63))]
        at = [0, *sorted(rng.sample(range(6, 56), n)), len(words)]
        parts = [words[i:k] for i, k in pairwise(at)]
        rng.shuffle(parts)
        other = [w for p in parts[::-1] for w in p]
        other[rng.randrange(len(other))] += rng.choice(["", "x"])
        pairs.append((words, other))
    seen = set()
    for a, b in pairs:
        if max(len(a), len(b)) > 64:
            continue
        number = {w: i + 1 for i, w in enumerate(dict.fromkeys([*a, *b]))}
        code = lambda x: r.shingle_codes(np.array([number[w] for w in x], np.uint64))
        whole = jaccard(a, b) >= 0.8
        seen.add(whole)
        assert r.alike(code(a), code(b)) == whole, (a, b)
    assert seen == {True, False}


def crowd(n=60):
    """Shingle codes of n copies of some words, with words of their own every 18 to 25: near misses, but for the last two."""
    rng = random.Random(13)
    words = [f"w{i}" for i in range(2 * r.REACH + r.SHINGLE)]
    rows = []
    for k in range(n):
        own, at = list(words), rng.randrange(8)
        while k < n - 2 and at < len(own):
            own[at] = f"x{k}.{at}"
            at += rng.randint(18, 26)
        rows.append(own)
    number = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for x in rows for w in x))}
    with np.errstate(over="ignore"):
        return r.shingle_codes(np.array([[number[w] for w in x] for x in rows], np.uint64))


def test_near_misses_are_told_apart_without_comparing(monkeypatch):
    """Many texts with something in common cost no comparison each where they cannot be near; all that are near are tied."""
    codes, calls, alike = crowd(), [], r.alike
    monkeypatch.setattr(r, "alike", lambda a, b: calls.append(alike(a, b)) or calls[-1])
    found = r.joined(codes, np.arange(len(codes)))
    assert (len(codes) - 1, len(codes) - 2) in [tuple(sorted(x, reverse=True)) for x in found]
    assert sum(not x for x in calls) <= len(codes)


def test_close_keeps_all_that_are_alike():
    rng = random.Random(12)
    seen = []
    for _ in range(300):
        words = [rng.randrange(40) if rng.random() < 0.2 else 100 + i for i in range(2 * r.REACH + r.SHINGLE)]
        other = list(words)
        for _ in range(rng.randint(0, 24)):
            other[rng.randrange(len(other))] = 1000 + rng.randrange(50)
        if rng.random() < 0.4:
            at = rng.randrange(len(other))
            other = other[at:] + other[:at]
        with np.errstate(over="ignore"):
            a, b = (r.shingle_codes(np.array([x], np.uint64) + np.uint64(1)) for x in (words, other))
        seen.append((r.alike(a[0], b[0]), bool(r._close(*r._codes_in_both(a, b))[0])))
    assert {x for x, _ in seen} == {True, False} and all(close for near, close in seen if near)


def test_cells_of_one_label_are_dealt_by_their_size(spark, monkeypatch):
    """A label that most cells have does not bring them all to the same few tasks."""
    monkeypatch.setattr(r, "SPREAD", 16)
    sizes = {key: 40 if key < 8 else 2 for key in range(100)}
    rows = [(key, 0, k and 1000 * key + k, b"") for key, n in sizes.items() for k in range(n)] + [(200, 0, 5, b""), (200, 0, 6, b"")]
    dealt = r._dealt(spark.createDataFrame(rows, "key long, chunk int, label long, around binary")).groupBy("home", "spread").count().collect()
    assert sum(x["count"] for x in dealt) == len(rows)
    assert len([x for x in dealt if x["home"] == 0]) >= 8 + 16 and [x["count"] for x in dealt if x["home"] == 5] == [2]
    assert max(x["count"] for x in dealt) == 40
