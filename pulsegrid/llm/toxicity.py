"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, written and trained in numpy.

A word enters as a hashed word vector beside the mean of its hashed character-trigram vectors and fixed log-odds. Two
gated recurrent layers, one each way, read a window of WIDTH words; attention pools their states into one logit.
Windows start every WIDTH / 2 words, so all overlapping windows of the whole text are read; the text's logit is that
of its most toxic window, put on the scale of probabilities by a logistic fit.

Training is on labelled rows only: at most about SAMPLE_POSITIVE and SAMPLE_NEGATIVE of them, chosen by a hash (all
of them where there are fewer), so the driver holds a bounded sample however large the corpus is. Beside the trained vectors,
the smoothed log-odds of the word and of its strongest runs of three and five characters enter; in training each of FOLDS
folds sees the log-odds that the other rows give, and so does the logistic fit. The network is trained on the windows that
decide its texts, chosen again with the network of the round before. Language, source and id never enter a score.

Defined results: null and empty texts get the score of an empty window; labels of texts that do not exist, null
labels and repeated labels of one id (the largest counts), and repeated ids (the smallest text is learned) are no problem; without labels of both kinds every score is
the smoothed share of toxic labels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import unit_interval
from pulsegrid.llm.decontaminate import words as split_words

SAMPLE_POSITIVE, SAMPLE_NEGATIVE = 4000, 6000
THRESHOLD = 0.3
WIDTH, STRIDE = 32, 16
HIDDEN, VECTOR, ATTENTION = 8, 8, 8
#: Hash buckets of words and of runs of characters; those of their trained vectors.
BITS, FIVE = 18, 5
BUCKETS, TRAINED = 1 << BITS, 1 << 14
#: Rows of one fold see the log-odds that the others give.
FOLDS = 4
ROUNDS, EPOCHS, BATCH, RATE, SLOW = 2, 2, 256, 0.01, 0.05
SEED = 20240131
#: Words scored at once, and so the memory of a task, are about this many.
TOGETHER = 1 << 17


def _segments(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)[:-1]))


def word_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words -> bucket of each, buckets of all their trigrams and of all their runs of FIVE bytes, bytes of each.

    A word stands between two marks (and FIVE - 3 blanks more behind it), so it has as many of either as it has bytes.
    """
    raw = np.frombuffer(b"<" + b">  <".join(words) + b">  ", np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    at = np.arange(lengths.sum()) + 4 * np.repeat(np.arange(len(words)), lengths)
    mixed = (raw[:-2] * np.uint32(0x01000193) ^ raw[1:-1]) * np.uint32(0x85EBCA6B) ^ raw[2:] * np.uint32(0xC2B2AE35)
    five = (mixed[at] * np.uint32(0x9E3779B1) ^ raw[at + 3]) * np.uint32(0x85EBCA77) ^ raw[at + 4] * np.uint32(0x27D4EB2F)
    grams, five = ((x ^ x >> np.uint32(15)) * np.uint32(0x2C1B3C6D) for x in (mixed[at], five))
    weight = np.arange(1, len(at) + 1, dtype=np.uint32) - np.repeat(_segments(lengths), lengths).astype(np.uint32)
    whole = np.add.reduceat((mixed[at] ^ mixed[at] >> np.uint32(13)) * (np.uint32(2) * weight * weight + np.uint32(1)), _segments(lengths), dtype=np.uint32)
    whole = (whole ^ whole >> np.uint32(16)) * np.uint32(0x45D9F3B)
    return *((x >> np.uint32(32 - BITS)).astype(np.int64) for x in (whole, grams, five)), lengths


class Texts:
    """A batch of texts as numbered different words, the words of each window, and which windows are whose."""

    def __init__(self, texts: list[bytes | None]):
        number: dict[bytes, int] = {}
        ids, starts, owners, at = [], [], [], 0
        for n, t in enumerate(texts):
            found = split_words(t)
            ids.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found)))
            own = range(0, max(1, len(found) - STRIDE), STRIDE)
            starts.append(np.fromiter(own, np.int64, len(own)) + at)
            owners.append(np.full(len(own), n))
            at += len(found)
        self.words, self.n = list(number), len(texts)
        flat, ends = np.concatenate(ids), np.cumsum([len(x) for x in ids])
        self.starts, self.owner = np.concatenate(starts), np.concatenate(owners)
        place = self.starts[:, None] + np.arange(WIDTH)
        self.mask = place < ends[self.owner][:, None]
        #: Number of the word + 1 at each place of each window; 0 beyond the text's end.
        self.windows = np.where(self.mask, flat[np.minimum(place, len(flat) - 1)] + 1, 0) if len(flat) else np.zeros(place.shape, np.int64)
        self.bounds = np.searchsorted(self.owner, np.arange(self.n))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Weights, the pass forward and the pass back."""

    inputs = 2 * VECTOR + 3

    def __init__(self, rng: np.random.Generator, odds: list[np.ndarray]):
        draw = lambda *shape: (rng.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)
        self.odds = odds
        self.p = {k: (0.02 * rng.standard_normal((TRAINED, VECTOR))).astype(np.float32) for k in ("word", "gram")}
        for way in "fb":
            self.p |= {f"in_{way}": draw(self.inputs, 3 * HIDDEN), f"b_{way}": np.zeros(3 * HIDDEN, np.float32), f"u_{way}": draw(HIDDEN, 3 * HIDDEN)}
        self.p |= {"att": draw(2 * HIDDEN, ATTENTION), "att_v": draw(ATTENTION, 1), "out": draw(2 * HIDDEN, 1), "out_b": np.full(1, -1.0, np.float32)}
        self.scale = (1.0, 0.0)

    def vectors(self, words: list[bytes], odds: list[np.ndarray] | None = None) -> tuple[np.ndarray, tuple]:
        """A row for each word, after a row of zeros for places beyond the end: its vector, the mean of its trigrams', and the log-odds of the word and of its strongest trigram and run of five."""
        out = np.zeros((len(words) + 1, self.inputs), np.float32)
        if not words:
            return out, (None, None, None)
        (word, grams, five, lengths), odds = word_buckets(words), odds or self.odds
        at = _segments(lengths)
        out[1:, :VECTOR] = self.p["word"][word % TRAINED]
        out[1:, VECTOR:-3] = np.add.reduceat(self.p["gram"][grams % TRAINED], at) / lengths[:, None]
        out[1:, -3] = odds[0][word]
        out[1:, -2] = np.maximum.reduceat(odds[1][grams], at)
        out[1:, -1] = np.maximum.reduceat(odds[2][five], at)
        return out, (word % TRAINED, grams % TRAINED, lengths)

    def forward(self, vectors: np.ndarray, windows: np.ndarray, mask: np.ndarray, keep: bool = False):
        p, n = self.p, len(windows)
        states, kept = np.empty((WIDTH, n, 2 * HIDDEN), np.float32), {}
        live = mask.T[:, :, None].astype(np.float32)
        for k, way in enumerate("fb"):
            projected, h = vectors @ p[f"in_{way}"] + p[f"b_{way}"], np.zeros((n, HIDDEN), np.float32)
            trail = []
            for t in range(WIDTH) if way == "f" else reversed(range(WIDTH)):
                x, u = projected[windows[:, t]], h @ p[f"u_{way}"]
                gates = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
                before, h = h, live[t] * (new + z * (h - new))
                states[t, :, k * HIDDEN : (k + 1) * HIDDEN] = h
                if keep:
                    trail.append((t, before, z, r, new, u[:, 2 * HIDDEN :]))
            kept[way] = trail
        a = np.tanh(states @ p["att"])
        e = np.where(live[:, :, 0] > 0, (a @ p["att_v"])[:, :, 0], -1e9)
        e = np.exp(e - e.max(axis=0)) * live[:, :, 0]
        share = e / np.maximum(e.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", share, states)
        logit = (pooled @ p["out"] + p["out_b"])[:, 0]
        return (logit, (states, kept, a, share, pooled, live)) if keep else logit

    def gradients(self, texts_vectors: np.ndarray, parts: tuple, windows: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict:
        p = self.p
        logit, (states, kept, a, share, pooled, live) = self.forward(texts_vectors, windows, mask, keep=True)
        d = (weight * (_sigmoid(logit) - target) / weight.sum()).astype(np.float32)[:, None]
        g = {"out": pooled.T @ d, "out_b": d.sum(axis=0)}
        d_pooled = d @ p["out"].T
        d_states = share[:, :, None] * d_pooled
        d_share = np.einsum("tnh,nh->tn", states, d_pooled)
        d_e = share * (d_share - (share * d_share).sum(axis=0))
        g["att_v"] = np.einsum("tna,tn->a", a, d_e)[:, None]
        d_a = d_e[:, :, None] * p["att_v"][:, 0] * (1 - a * a)
        g["att"] = np.einsum("tnh,tna->ha", states, d_a)
        d_states += d_a @ p["att"].T
        d_vectors = np.zeros_like(texts_vectors)
        for k, way in enumerate("fb"):
            u_w, d_h = p[f"u_{way}"], np.zeros((len(windows), HIDDEN), np.float32)
            g_u, d_proj = np.zeros_like(u_w), np.zeros((len(texts_vectors), 3 * HIDDEN), np.float32)
            for t, before, z, r, new, un in reversed(kept[way]):
                d_h = (d_h + d_states[t, :, k * HIDDEN : (k + 1) * HIDDEN]) * live[t]
                d_new = d_h * (1 - z) * (1 - new * new)
                d_z = d_h * (before - new) * z * (1 - z)
                d_r = d_new * un * r * (1 - r)
                d_u = np.concatenate((d_z, d_r, d_new * r), axis=1)
                np.add.at(d_proj, windows[:, t], np.concatenate((d_z, d_r, d_new), axis=1))
                g_u += before.T @ d_u
                d_h = d_h * z + d_u @ u_w.T
            g[f"u_{way}"], g[f"b_{way}"], g[f"in_{way}"] = g_u, d_proj.sum(axis=0), texts_vectors.T @ d_proj
            d_vectors += d_proj @ p[f"in_{way}"].T
        word, grams, lengths = parts
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        if word is not None:
            np.add.at(g["word"], word, d_vectors[1:, :VECTOR])
            np.add.at(g["gram"], grams, np.repeat(d_vectors[1:, VECTOR:-3] / lengths[:, None], lengths, axis=0))
        return g

    def logits(self, texts: list[bytes | None], odds: list[np.ndarray] | None = None) -> np.ndarray:
        """The logit of each text's most toxic window."""
        batch = Texts(texts)
        return np.maximum.reduceat(self.forward(self.vectors(batch.words, odds)[0], batch.windows, batch.mask), batch.bounds)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        """Probabilities, a bounded number of words at a time: a long text goes alone, in parts that begin where windows do, with its maximum so far."""
        out, part, size = [], [], 0
        for t in texts:
            if len(t or b"") > 6 * TOGETHER:
                found = split_words(t)
                out += [self.logits(part)] if part else []
                parts = range(0, max(1, len(found) - STRIDE), TOGETHER)
                out.append(np.array([max(float(self.logits([b" ".join(found[at : at + TOGETHER + STRIDE])])[0]) for at in parts)]))
                part, size = [], 0
                continue
            part.append(t)
            size += len(t or b"") // 6 + 1
            if size >= TOGETHER:
                out.append(self.logits(part))
                part, size = [], 0
        if part:
            out.append(self.logits(part))
        x = np.concatenate(out) if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * x.astype(np.float64) + self.scale[1], -30, 30)))


def _log_odds(seen: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of each bucket's presence in toxic against other texts, from how many of the n of each kind have it, shrunk where it is seldom seen."""
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    return (odds * seen.sum(axis=0) / (seen.sum(axis=0) + 4)).astype(np.float32)


def _counted(texts: list[bytes], toxic: np.ndarray, fold: np.ndarray) -> tuple[list[list[np.ndarray]], list[np.ndarray]]:
    """Log-odds of words, trigrams and runs of five as each fold sees them, from the rows of the others, and those from all rows."""
    seen = np.zeros((3, FOLDS, 2, BUCKETS), np.int32)
    n = np.zeros((FOLDS, 2), np.int64)
    for text, y, f in zip(texts, toxic.astype(int).tolist(), fold.tolist()):
        n[f, y] += 1
        if own := sorted(set(split_words(text))):
            for k, buckets in enumerate(word_buckets(own)[:3]):
                seen[k, f, y, np.unique(buckets)] += 1
    every, rows = seen.sum(axis=1), n.sum(axis=0)
    return [[_log_odds(every[k] - seen[k, f], rows - n[f]) for k in range(3)] for f in range(FOLDS)], [_log_odds(every[k], rows) for k in range(3)]


class Constant:
    def __init__(self, share: float):
        self.share = share

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        return np.full(len(texts), self.share)


def train(texts: list[bytes], toxic: list[int], weights: list[float], seed: int = SEED) -> Network | Constant:
    """A network from labelled texts; weights say how many rows each stands for."""
    y, w = np.array(toxic, float), np.array(weights, float)
    if not 2 <= y.sum() <= len(y) - 2:
        return Constant(float(((y * w).sum() + 0.5) / (w.sum() + 1)))
    rng = np.random.default_rng(seed)
    fold = np.empty(len(y), np.int64)
    for v in (0, 1):
        own = rng.permutation(np.flatnonzero(y == v))
        fold[own] = np.arange(len(own)) % FOLDS
    folds, all_ = _counted(texts, y, fold)
    net = Network(rng, all_)
    moments: dict = {}
    step = 0
    for round_ in range(ROUNDS):
        rows: list[list[tuple]] = [[] for _ in range(FOLDS)]  # the windows that decide: at first those with the strongest log-odds
        for f in range(FOLDS):
            mine = np.flatnonzero(fold == f)
            for at in range(0, len(mine), 64):
                own = mine[at : at + 64]
                batch = Texts([texts[i] for i in own])
                vectors, _ = net.vectors(batch.words, folds[f])
                per_word = vectors[:, -3:].max(axis=1)
                per_word[0] = -9
                strength = net.forward(vectors, batch.windows, batch.mask) if round_ else per_word[batch.windows].max(axis=1)
                for k, i in enumerate(own):
                    a, b = batch.bounds[k], batch.bounds[k + 1] if k + 1 < len(own) else len(batch.owner)
                    chosen = {a + int(np.argmax(strength[a:b]))} | ({int(rng.integers(a, b))} if not y[i] else set())
                    rows[f] += [([batch.words[x - 1] for x in batch.windows[c] if x], y[i], w[i] / len(chosen)) for c in chosen]
        for _ in range(EPOCHS):
            parts = [(f, order[at : at + BATCH]) for f in range(FOLDS) for order in [rng.permutation(len(rows[f]))] for at in range(0, len(order), BATCH)]
            for at in rng.permutation(len(parts)):
                f, chosen = parts[at]
                part = [rows[f][i] for i in chosen]
                batch = Texts([b" ".join(r[0]) for r in part])
                vectors, buckets = net.vectors(batch.words, folds[f])
                g = net.gradients(vectors, buckets, batch.windows[batch.bounds], batch.mask[batch.bounds], np.array([r[1] for r in part]), np.array([r[2] for r in part]))
                step += 1
                for k, v in g.items():
                    m, s = moments.setdefault(k, (np.zeros_like(net.p[k]), np.zeros_like(net.p[k])))
                    m *= 0.9
                    m += 0.1 * v
                    s *= 0.99
                    s += 0.01 * v * v
                    rate = RATE * (SLOW if k in ("word", "gram") else 1)
                    net.p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
    x = np.empty(len(y))
    for f in range(FOLDS):
        mine = np.flatnonzero(fold == f)
        for at in range(0, len(mine), 64):
            x[mine[at : at + 64]] = net.logits([texts[i] for i in mine[at : at + 64]], folds[f])
    net.scale = _logistic(x, y, w)
    return net


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted, slightly shrunk logistic fit, by Newton's method."""
    design, beta, w = np.stack([x, np.ones_like(x)], axis=1), np.array([1.0, 0.0]), w / w.mean()
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (w * (y - q)) - 1e-2 * (beta - [1.0, 0.0])
        curve = (design * (w * q * (1 - q))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(max(beta[0], 0.05)), float(beta[1])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame) -> Network | Constant:
    """A network from the labelled rows outside the held-out fold."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    usable = usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    count = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = {v: min(1.0, most / max(1, count.get(v, 0))) for v, most in ((1, SAMPLE_POSITIVE), (0, SAMPLE_NEGATIVE))}
    chosen = usable.where(unit_interval(F.col("doc_id").cast("string"), seed="labelled") < F.when(F.col("y") == 1, rate[1]).otherwise(rate[0]))
    # about SAMPLE_POSITIVE + SAMPLE_NEGATIVE rows, which bounds the broadcast and what the driver holds
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.coalesce(F.min("text"), F.lit("")).alias("text")).collect()
    rows = sorted((r["doc_id"], r["text"].encode(), r["y"]) for r in rows)
    return train([t for _, t, _ in rows], [y for _, _, y in rows], [1 / rate[y] for _, _, y in rows])


def score(documents: DataFrame, net: Network | Constant, text: str = "text") -> DataFrame:
    """documents with score, the probability of a toxic label."""
    sent, at = documents.sparkSession.sparkContext.broadcast(net), documents.columns.index(text)
    out = documents.withColumn("score", F.lit(None).cast("double"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = sent.value.scores(b[at].cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], schema=b.schema)

    return out.mapInArrow(run, out.schema)


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """documents without those that score at least the threshold. Same columns. Where there are too few labels to learn from, none is rejected."""
    columns, net = documents.columns, fit(documents, labels)
    return documents if isinstance(net, Constant) else score(documents, net).where(F.col("score") < threshold).select(*columns)
