"""The network: gradients, windows, held-out accuracy, odd rows."""

import random

import numpy as np
import pytest

from pulsegrid.llm import toxicity as t


def test_gradients():
    rng = np.random.default_rng(0)
    net = t.Network(rng, [rng.standard_normal(t.BUCKETS) for _ in range(3)])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    batch = t.Texts([b"some words here", b"", b"other words " * 12])
    first = batch.bounds
    windows, mask, y, w = batch.windows[first], batch.mask[first], np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        x = net.forward(net.vectors(batch.words)[0], windows, mask)
        return float((w * (np.log1p(np.exp(x)) - y * x)).sum() / w.sum())

    vectors, parts = net.vectors(batch.words)
    g = net.gradients(vectors, parts, windows, mask, y, w)
    for name, grad in g.items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        step, old = 1e-3, net.p[name][at]
        net.p[name][at] = old + step
        up = loss()
        net.p[name][at] = old - step
        down = loss()
        net.p[name][at] = old
        assert (up - down) / (2 * step) == pytest.approx(float(grad[at]), rel=0.05, abs=2e-4), name


def test_windows_cover_the_text():
    for n in (0, 1, 16, 31, 32, 33, 48, 49, 200):
        batch = t.Texts([b" ".join(b"w%d" % i for i in range(n)), b"after"])
        own = batch.windows[batch.owner == 0]
        assert {batch.words[x - 1] for x in np.unique(own[own > 0])} == {b"w%d" % i for i in range(n)}
        assert batch.words[batch.windows[-1, 0] - 1] == b"after"


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        text = [rng.choice(["the", "cat", "runs", "on", "grass", f"w{rng.randrange(500)}"]) for _ in range(rng.randrange(1, 200))]
        bad = rng.random() < 0.25
        for _ in range(3 * bad):
            text.insert(rng.randrange(len(text) + 1), rng.choice(["grobnik", f"zorq{rng.randrange(900)}"]))
        out.append((" ".join(text), int(bad)))
    return out


def test_held_out_accuracy():
    learn, judge = corpus(1500, 1), corpus(400, 2)
    net = t.train([x.encode() for x, _ in learn], [y for _, y in learn], [1.0] * len(learn))
    s, y = net.scores([x.encode() for x, _ in judge]), np.array([y for _, y in judge])
    assert ((s >= t.THRESHOLD) == (y == 1)).mean() > 0.95
    long = ("the cat " * 20_000 + "zorq12345 grobnik " + "runs on " * 20_000).encode()
    assert net.scores([long])[0] > t.THRESHOLD > net.scores([b"the cat " * 40_000])[0]


def test_report(spark, awkward, nothing):
    learn = corpus(400, 3)
    docs = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(learn)], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, y) for i, (_, y) in enumerate(learn)), (None, 1), (5, None), (10**9, 1)], "doc_id long, toxic int")
    out = t.report(docs, labels).collect()
    import zlib

    assert len(out) == 400 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in out)
    again = {r["doc_id"]: r["score"] for r in t.report(docs, labels).collect()}
    assert again == {r["doc_id"]: r["score"] for r in out}
    odd = t.report(awkward, labels)
    assert odd.count() == awkward.count() and t.report(nothing, labels).count() == 0
    kept = t.reject(awkward, labels.limit(0))
    assert kept.columns == awkward.columns and kept.count() in (0, awkward.count())


def plain_logit(net, text):
    """Every window by itself, word by word, gate by gate."""
    words = t.split_words(text)
    sig = lambda x: 1 / (1 + np.exp(-x))
    best = -np.inf
    for start in range(0, max(1, len(words) - t.STRIDE), t.STRIDE):
        rows = []
        for w in words[start : start + t.WIDTH]:
            word, grams, five, _ = t.word_buckets([w])
            rows.append(np.concatenate((net.p["word"][word[0] % t.TRAINED], net.p["gram"][grams % t.TRAINED].mean(axis=0), [net.odds[0][word[0]], net.odds[1][grams].max(), net.odds[2][five].max()])))
        ways = []
        for way in "fb":
            h, trail = np.zeros(t.HIDDEN), []
            for x in rows if way == "f" else rows[::-1]:
                i, u = x @ net.p[f"in_{way}"] + net.p[f"b_{way}"], h @ net.p[f"u_{way}"]
                z, r = (sig(i[k * t.HIDDEN : (k + 1) * t.HIDDEN] + u[k * t.HIDDEN : (k + 1) * t.HIDDEN]) for k in (0, 1))
                new = np.tanh(i[2 * t.HIDDEN :] + r * u[2 * t.HIDDEN :])
                h = new + z * (h - new)
                trail.append(h)
            ways.append(trail if way == "f" else trail[::-1])
        pooled = np.zeros(2 * t.HIDDEN)
        if rows:
            states = np.concatenate([np.array(x) for x in ways], axis=1)
            e = np.exp(np.tanh(states @ net.p["att"]) @ net.p["att_v"][:, 0])
            pooled = (e / e.sum()) @ states
        best = max(best, float(pooled @ net.p["out"][:, 0] + net.p["out_b"][0]))
    return 1 / (1 + np.exp(-(net.scale[0] * best + net.scale[1])))


def test_scores_against_a_plain_network(monkeypatch):
    """Also in the parts of long texts."""
    learn = corpus(200, 5)
    net = t.train([x.encode() for x, _ in learn], [y for _, y in learn], [1.0] * len(learn))
    texts = [x.encode() for x, _ in corpus(12, 6)] + [None, b"", b"one", b"ends < > zorq1 " * 30]
    wanted = [plain_logit(net, x) for x in texts]
    assert net.scores(texts) == pytest.approx(wanted, abs=1e-4)
    monkeypatch.setattr(t, "TOGETHER", 2 * t.STRIDE)
    assert net.scores(texts) == pytest.approx(wanted, abs=1e-4)


def test_repeated_labelled_ids(spark):
    """A labelled id of many rows is learned once."""
    learn = corpus(60, 7)
    docs = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(learn)] + [(1, learn[1][0])] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(learn)], "doc_id long, toxic int")
    assert (t.fit(docs, labels).scores([b"zorq5 the"]) == t.fit(docs.distinct(), labels).scores([b"zorq5 the"])).all()


def test_held_out_rows_of_the_test_data():
    """No worse than the strongest word's log-odds, and most toxic rows found at the fixed threshold."""
    import zlib

    import pyarrow as pa
    import pyarrow.parquet as pq

    docs, labels = (pq.read_table(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    text, toxic = dict(zip(docs["doc_id"].to_pylist(), docs["text"].cast(pa.binary()).to_pylist())), dict(zip(labels["doc_id"].to_pylist(), labels["toxic"].to_pylist()))
    ids = sorted(i for i in toxic if i in text and toxic[i] is not None)
    judged = [i for i in ids if zlib.crc32(str(i).encode()) % 4 == 2]
    learned = sorted(set(ids) - set(judged))
    net = t.train([text[i] or b"" for i in learned], [toxic[i] for i in learned], [1.0] * len(learned))
    y = np.array([toxic[i] for i in judged])
    n = np.bincount([toxic[i] for i in learned], minlength=2)
    seen = {}
    for i in learned:
        for w in set(t.split_words(text[i])):
            seen.setdefault(w, [0, 0])[toxic[i]] += 1
    odds = {w: (np.log((b + 0.5) / (n[1] + 1)) - np.log((a + 0.5) / (n[0] + 1))) * (a + b) / (a + b + 4) for w, (a, b) in seen.items()}

    def area(x):
        return np.mean([(x[y == 1] > v).mean() + 0.5 * (x[y == 1] == v).mean() for v in x[y == 0]])

    score = net.scores([text[i] for i in judged])
    plain = np.array([max((odds[w] for w in set(t.split_words(text[i])) if w in odds), default=-9) for i in judged])
    assert area(score) >= max(0.93, area(plain) - 0.005) and (score[y == 1] >= t.THRESHOLD).mean() > 0.8 and (score[y == 0] >= t.THRESHOLD).mean() < 0.04
