"""A hierarchical Pitman-Yor language model: Chinese-restaurant seating sampled by Gibbs, averaged predictive probabilities.

Every word has a restaurant that serves the words after it, and so has the start of a text. A word's restaurant asks the
restaurant of its class (its last three bytes), that one the root, and the root the base measure (half of it for words
never seen, the rest even over the known ones). The customers of a class are the tables of its words, those of the
root the tables of the classes.

Counting is exact over all training texts. The sampler's state is the number of tables of each (context, word). Given
all else that number has a known law (generalised Stirling numbers), so up to EXACT customers a step draws the
whole seating of a dish in a restaurant from it; further customers of very frequent pairs are seated in order,
in blocks of 1/16 of those before them. Words are spread over the cluster; within a sweep they see the totals of
the sweep before, and a word's contexts see its parent state of the sweep before, as in approximate distributed
Gibbs sampling. Random numbers are hashes of (word, context, sweep, step), so neither batches nor retries change a draw.

Texts are read once (`score`). Tasks send each pair of neighbouring words, with the documents it occurs in, to the bucket
of its second word. There a word's pairs, its classes and its root dish lie together; what a bucket lacks are its contexts'
totals. Those of the words in a code book (a fixed number, frequent ones by a sample; it decides how totals travel
and not what they are) are summed and broadcast, all others are summed by context and joined to the buckets that ask.
Words are told apart by 64-bit hashes (a clash among a hundred million of them has a probability of 0.0003).

`score_by_classes` is the model without words' own restaurants: classes alone, under the root. Its FREQUENT most frequent
words (a fixed number, so their table is bounded) are broadcast as a dense array over contexts, the others'
occurrences are joined by word and summed by document.

Defined results: null texts are empty and consist of the end token alone; a null id is a training row; rows with one
id are scored each for itself; without training texts (empty table apart, which gives no rows) all words are unknown.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, pairwise, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.storage import kept, use_shared_dir
from pulsegrid.llm.common import FOLD_BYTES

CONTEXTS = 128
FREQUENT = 131_072
BURN_IN, SAMPLES = 1, 3
#: Dishes with at most so many customers are seated by an exact draw.
EXACT = 64
STRENGTH, ROOT_STRENGTH = 20.0, 20.0
UNSEEN_SHARE = 0.5
SEED = 0x5EED
#: Bytes of text that a task counts before it hands them on; their words are what it has in memory.
BYTES_HELD = 8_000_000
#: The end token is the empty word, which no text contains.
END = b""
_PAIR = np.dtype([("ctx", "u1"), ("n", "<u4")])
_OCCURRENCE = np.dtype([("key", "<i8"), ("ctx", "u1")])
_VALUE = np.dtype([("ctx", "u1"), ("p", "<f4")])
#: Words whose totals are broadcast, at most (a code is two bytes), and the code of all other words.
CODES, RARE = 65_534, 0xFFFF
#: Bytes of text to a bucket of words, about; buckets to a task.
BUCKET_BYTES, TOGETHER = 4_000_000, 2
#: An occurrence is two bytes: which of the documents that a task holds, whether it begins a pair's list, whether the document is held out.
DOCS_HELD = DOC_MASK = 0x3FFF
BEGINS, HELD = 0x4000, 0x8000
#: Numbers of a vector that are summed over tasks together.
SLICE = 1024
_META = np.dtype([("first", "<i8"), ("id", "<i8"), ("valid", "?"), ("held", "?"), ("n", "<i8")])


# tokens and contexts


def context_classes(words: list[bytes]) -> np.ndarray:
    """The context that each word makes for the next one: 1 .. CONTEXTS-1. Context 0 is the start of a text."""
    raw = np.frombuffer(b"\0\0\0" + b"\0\0\0".join(words) + b"\0", np.uint8).astype(np.uint32)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 3)
    code = raw[ends - 1] | raw[ends - 2] << np.uint32(8) | raw[ends - 3] << np.uint32(16)
    code = (code ^ code >> np.uint32(11)) * np.uint32(0x9E3779B1)
    return (1 + (code >> np.uint32(12)) % np.uint32(CONTEXTS - 1)).astype(np.uint8)


def numbered(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Texts -> different words, the word number and context of every token (each text's end included), tokens of each text."""
    number: dict[bytes, int] = {}
    parts, lengths = [], np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):  # a text's words are let go before the next one's
        found = (t or b"").translate(FOLD_BYTES).split()
        found.append(END)
        lengths[i] = len(found)
        for w in dict.fromkeys(found):
            if w not in number:
                number[w] = len(number)
        parts.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
    words = list(number)
    ids = np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
    contexts = np.zeros(len(ids), np.uint8)
    if len(ids):
        contexts[1:] = context_classes(words)[ids[:-1]]
        contexts[np.cumsum(lengths)[:-1]] = 0
    return words, ids, contexts, lengths


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _flat(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The items of all rows of a binary column, and how many each row has (null: none)."""
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind), np.diff(offsets) // kind.itemsize


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


# counting


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> (word, pairs): counts by context of what the task has held, words in order of first use."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        words, ids, contexts, _ = numbered(held)
        code, n = np.unique(ids * CONTEXTS + contexts, return_counts=True)
        pairs = np.empty(len(code), _PAIR)
        pairs["ctx"], pairs["n"] = code % CONTEXTS, n
        offsets = np.searchsorted(code, np.arange(len(words) + 1) * CONTEXTS) * _PAIR.itemsize
        return pa.record_batch([_strings(words), _binary(offsets, pairs)], ["word", "pairs"])

    for b in batches:
        for t in b[0].cast(pa.binary()).to_pylist():
            held.append(t)
            size += len(t or b"")
            if size >= BYTES_HELD:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, pairs) sorted by word -> (word, h, n, pairs) with each word once. The last word is held until the next batch."""
    word, sums = None, np.zeros(CONTEXTS, np.int64)

    def packed(names: list[str], owner: np.ndarray, ctx: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        pairs = np.empty(len(ctx), _PAIR)
        pairs["ctx"], pairs["n"] = ctx, np.minimum(n, 0xFFFFFFFF)
        offsets = np.searchsorted(owner, np.arange(len(names) + 1)) * _PAIR.itemsize
        total = np.bincount(owner, n, len(names)).astype(np.int64)
        h = np.fromiter((xxhash.xxh64_intdigest(w.encode(), SEED) for w in names), np.uint64, len(names))
        return pa.record_batch([pa.array(names, pa.string()), pa.array(h.view(np.int64)), pa.array(total), _binary(offsets, pairs)], ["word", "h", "n", "pairs"])

    for b in batches:
        names = b["word"].to_pylist()
        if not names:
            continue
        pairs, lengths = _flat(b["pairs"], _PAIR)
        run = np.cumsum(np.fromiter((i > 0 and names[i] != names[i - 1] for i in range(len(names))), np.int64, len(names)))
        code = np.repeat(run, lengths) * CONTEXTS + pairs["ctx"]
        uniq, at = np.unique(code, return_inverse=True)
        n, owner, ctx = np.bincount(at, pairs["n"]).astype(np.int64), uniq // CONTEXTS, uniq % CONTEXTS
        first_of = np.flatnonzero(np.diff(run, prepend=-1))
        different = [names[i] for i in first_of]
        if word is not None and word != different[0]:
            ctx0 = np.flatnonzero(sums)
            yield packed([word], np.zeros(len(ctx0), np.int64), ctx0, sums[ctx0])
            sums = np.zeros(CONTEXTS, np.int64)
        if len(different) > 1:  # all but the last are complete
            body = owner < len(different) - 1
            head = body & (owner == 0)
            if sums.any():
                np.add.at(sums, ctx[head], n[head])
                ctx0 = np.flatnonzero(sums)
                yield packed([different[0]], np.zeros(len(ctx0), np.int64), ctx0, sums[ctx0])
                sums, body, shift = np.zeros(CONTEXTS, np.int64), body & ~head, 1
            else:
                shift = 0
            yield packed(different[shift:-1], owner[body] - shift, ctx[body], n[body])
        word, last = different[-1], owner == len(different) - 1
        np.add.at(sums, ctx[last], n[last])
    if word is not None:
        ctx0 = np.flatnonzero(sums)
        yield packed([word], np.zeros(len(ctx0), np.int64), ctx0, sums[ctx0])


def counts(texts: DataFrame) -> DataFrame:
    """texts(text) -> (word, h, n, pairs): every word once, with its counts by context, kept as a table in the shared folder."""
    part = texts.mapInArrow(_count_batches, "word string, pairs binary")
    whole = part.repartition("word").sortWithinPartitions("word").mapInArrow(_merge_sorted, "word string, h long, n long, pairs binary")
    return kept(whole, "pitman-yor")


# seating


def _uniform(h: np.ndarray, ctx: np.ndarray | int, sweep: int, step: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on nothing but the arguments."""
    with np.errstate(over="ignore"):
        x = h + np.asarray(ctx).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((sweep * 1_000_003 + step) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


@lru_cache(maxsize=8)
def log_stirling(d: float, most: int = EXACT) -> np.ndarray:
    """Logs of the generalised Stirling numbers S(c, t) of discount d: the weights of the seatings of c customers at t tables."""
    s = np.full((most + 1, most + 2), -np.inf)
    s[1, 1] = 0
    with np.errstate(divide="ignore"):
        for c in range(1, most):
            t = np.arange(1, c + 2)
            s[c + 1, 1 : c + 2] = np.logaddexp(s[c, t - 1], np.log(np.maximum(c - t * d, 1e-300)) + s[c, t])
            s[c + 1, c + 1] = 0
    return s


def _binomial(n: np.ndarray, p: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Counts of successes: by inversion of the Poisson law for small means, else by the normal one."""
    mean = n * p
    out = np.clip(np.round(mean + np.sqrt(mean * (1 - p)) * np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)), 0, n)
    few = np.flatnonzero(mean < 10)
    if len(few):
        k, mass = np.zeros(len(few)), np.exp(-mean[few])
        left = u[few] - mass
        while (go := (left > 0) & (k < 60)).any():
            k[go] += 1
            mass[go] *= mean[few][go] / k[go]
            left[go] -= mass[go]
        out[few] = np.minimum(k, n[few])
    return out


def draw_tables(c: np.ndarray, open_: np.ndarray, p: np.ndarray, d: float, stirling: np.ndarray, h: np.ndarray, ctx: np.ndarray | int, sweep: int) -> np.ndarray:
    """Tables of dishes with c customers: open_ is strength + d times the other dishes' tables, p the parent's probability of the dish."""
    t = np.ones(len(c))
    ctx = np.broadcast_to(ctx, c.shape)
    several = np.flatnonzero(c > 1)
    several = several[np.argsort(c[several], kind="stable")]
    sizes, at = np.unique(np.minimum(c[several], EXACT), return_index=True)
    for size, own in zip(sizes.astype(int), np.split(several, at[1:])):
        for part in np.array_split(own, max(1, len(own) * size // 2_000_000)):
            k = np.arange(size)
            logs = np.cumsum(np.log(p[part, None] * (open_[part, None] + d * k)), axis=1) + stirling[size, 1 : size + 1]
            mass = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
            u = _uniform(h[part], ctx[part], sweep, 0) * mass[:, -1]
            t[part] = 1 + (mass < u[:, None]).sum(axis=1)
    large = np.flatnonzero(c > EXACT)
    seated, step = np.full(len(large), float(EXACT)), 1
    while len(large):
        block = np.minimum(np.maximum(1, np.floor(seated / 16)), c[large] - seated)
        new = p[large] * (open_[large] + d * t[large])
        hazard = new / (new + seated + block / 2 - d * t[large])
        t[large] += _binomial(block, hazard, _uniform(h[large], ctx[large], sweep, step), _uniform(h[large], ctx[large], sweep, step + 1))
        seated, step = seated + block, step + 2
        go = seated < c[large]
        large, seated = large[go], seated[go]
    return t


class State:
    """Totals that all words share: customers of the contexts, and tables of contexts and parent after each sweep so far."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray, d: float, known: int, tokens: int, root_d: float):
        self.customers, self.d, self.known, self.tokens, self.root_d = customers, d, known, tokens, root_d
        self.tables, self.root_tables = [tables], [float(known)]

    def base(self) -> float:
        return (1 - UNSEEN_SHARE) / max(1, self.known)

    def root(self, c0: np.ndarray, t0: np.ndarray, sweep: int, base: float | None = None) -> np.ndarray:
        """The parent's probability of words with c0 customers at t0 tables, by the totals after a sweep."""
        c, t = self.tables[sweep].sum(), self.root_tables[sweep]
        return (c0 - self.root_d * t0 + (ROOT_STRENGTH + self.root_d * t) * (self.base() if base is None else base)) / (ROOT_STRENGTH + c)

    def back_off(self, sweep: int) -> np.ndarray:
        """The share of each context's probability that the parent deals out."""
        return (STRENGTH + self.d * self.tables[sweep]) / (STRENGTH + self.customers)


def sweeps(state: State, h: np.ndarray, c: np.ndarray, ctx: np.ndarray, owner: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """After each of the first sweeps over a batch of words: tables of its (context, word) pairs, parent customers and parent tables of its words."""
    n, stir, root_stir = len(h), log_stirling(state.d), log_stirling(state.root_d)
    t = np.ones(len(c))
    c0 = np.bincount(owner, t, n)
    t0 = np.ones(n)
    for s in range(most):
        p = state.root(c0, t0, s)[owner]
        open_ = STRENGTH + state.d * np.maximum(0, state.tables[s][ctx] - t)
        t = draw_tables(c, open_, p, state.d, stir, h[owner], ctx, s)
        c0 = np.bincount(owner, t, n)
        t0 = draw_tables(c0, np.full(n, ROOT_STRENGTH + state.root_d * max(0.0, state.root_tables[s] - 1)), np.full(n, state.base()), state.root_d, root_stir, h, CONTEXTS, s)
        yield t, c0, t0


def _unpacked(b: pa.RecordBatch):
    pairs, lengths = _flat(b["pairs"], _PAIR)
    return np.asarray(b["h"], np.int64).view(np.uint64), pairs["n"].astype(np.float64), pairs["ctx"].astype(np.int64), np.repeat(np.arange(len(lengths)), lengths)


def _summed(counted: DataFrame, what) -> np.ndarray:
    """The sum over tasks of the vectors that what(batch) gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            own = what(b)
            total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total.astype(np.float64))], ["i", "x"])

    rows = counted.select("h", "n", "pairs").mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(max((r["i"] for r in rows), default=-1) + 1)
    for r in rows:
        out[r["i"]] = r["x"]
    return out


def _first_look(b: pa.RecordBatch) -> np.ndarray:
    """Customers and words of each context, then: words, tokens, pairs seen once and twice, words in one and in two contexts."""
    _, c, ctx, owner = _unpacked(b)
    kinds = np.bincount(owner, minlength=b.num_rows)
    return np.concatenate((np.bincount(ctx, c, CONTEXTS), np.bincount(ctx, minlength=CONTEXTS), [b.num_rows, c.sum(), (c == 1).sum(), (c == 2).sum(), (kinds == 1).sum(), (kinds == 2).sum()]))


def _discount(once: float, twice: float) -> float:
    return float(np.clip(once / max(1.0, once + 2 * twice), 0.05, 0.95))


def sample(counted: DataFrame, most: int = BURN_IN + SAMPLES) -> State:
    """The totals after each sweep; a sweep is one job over the words, of which only sums come back."""
    look = _summed(counted, _first_look)
    if not len(look):
        look = np.zeros(2 * CONTEXTS + 6)
    words, tokens, one, two, single, double = look[2 * CONTEXTS :]
    state = State(look[:CONTEXTS], look[CONTEXTS : 2 * CONTEXTS], _discount(one, two), int(words), int(tokens), _discount(single, double))
    for s in range(most if words else 0):

        def totals(b: pa.RecordBatch, s: int = s) -> np.ndarray:
            h, c, ctx, owner = _unpacked(b)
            for t, _, t0 in sweeps(state, h, c, ctx, owner, s + 1):
                pass
            return np.concatenate((np.bincount(ctx, t, CONTEXTS), [t0.sum()]))

        now = _summed(counted, totals)
        state.tables.append(now[:CONTEXTS])
        state.root_tables.append(float(now[CONTEXTS]))
    return state


# prediction


def _predictive(state: State, burn_in: int = BURN_IN):
    """(word, h, n, pairs) -> (word, n, roots, values): averaged probabilities in the contexts that have the word, and the parent's in each sample."""
    last = len(state.tables) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, c, ctx, owner = _unpacked(b)
            roots, total = np.empty((len(h), last - burn_in), np.float64), np.zeros(len(c))
            for s, (t, c0, t0) in enumerate(sweeps(state, h, c, ctx, owner, last), start=1):
                if s > burn_in:
                    roots[:, s - burn_in - 1] = state.root(c0, t0, s)
                    total += np.maximum(0, c - state.d * t) / (STRENGTH + state.customers[ctx]) + state.back_off(s)[ctx] * roots[owner, s - burn_in - 1]
            values = np.empty(len(c), _VALUE)
            values["ctx"], values["p"] = ctx, total / max(1, last - burn_in)
            offsets = np.searchsorted(owner, np.arange(len(h) + 1)) * _VALUE.itemsize
            yield pa.record_batch([b["word"], b["n"], _binary(np.arange(len(h) + 1) * roots.shape[1] * 8, roots), _binary(offsets, values)], ["word", "n", "roots", "values"])

    return run


class Dense:
    """What every task needs: probabilities of the frequent words in all contexts, totals for the others."""

    def __init__(self, state: State, rows: pa.Table, burn_in: int = BURN_IN):
        sampled = range(burn_in + 1, len(state.tables))
        self.back_off = np.array([state.back_off(s) for s in sampled])
        self.unseen = np.array([state.root(np.zeros(1), np.zeros(1), s, UNSEEN_SHARE)[0] for s in sampled])
        self.number: dict[bytes, int] = {}
        self.n = rows["n"].to_numpy().astype(np.float64)
        self.logs = np.empty((len(rows), CONTEXTS), np.float32)
        for b in rows.to_batches(1000):
            for word, roots, values in zip(b["word"].cast(pa.binary()).to_pylist(), b["roots"].to_pylist(), b["values"].to_pylist()):
                p = self.average(np.frombuffer(roots, np.float64)[None], np.arange(CONTEXTS))
                v = np.frombuffer(values, _VALUE)
                p[v["ctx"]] = v["p"]
                self.logs[len(self.number)] = np.log10(p)
                self.number[word] = len(self.number)
        self.tokens, self.known = state.tokens, state.known

    def average(self, roots: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        """Probabilities by the parent alone, averaged over the samples."""
        if not len(self.back_off):  # nothing was learned: all is unseen
            return np.ones(np.broadcast_shapes(roots.shape[:1], ctx.shape))
        return (self.back_off[:, ctx].T * roots).mean(axis=1)

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.5) / (self.tokens + 0.5 * (self.known + 1)))


OCCURRENCES = "word string, seen binary, key long, id long, held boolean, n_tokens long, n_known long, base double, score double"


def _score_frequent(sent):
    """Documents -> a row for each with the sums over its frequent words (keyed by a word that no text has), and a row for each other word with where it occurs."""

    def emit(model: Dense, rows: list) -> Iterator[pa.RecordBatch]:
        words, ids, contexts, lengths = numbered([r[3] for r in rows])
        number = np.fromiter(map(model.number.get, words, repeat(-1)), np.int64, len(words))[ids]
        owner = np.repeat(np.arange(len(rows)), lengths)
        known = number >= 0
        logs = model.logs[number[known], contexts[known]]
        sums = [np.bincount(owner[known], w, len(rows)) for w in (np.ones(len(logs)), model.base(model.n[number[known]]), logs)]
        keys = np.array([r[0] for r in rows], np.int64)
        none = lambda n, kind: pa.nulls(n, kind)
        names = [x.split()[0] for x in OCCURRENCES.split(", ")]
        yield pa.record_batch([pa.array([f" {k}" for k in keys.tolist()]), none(len(rows), pa.binary()), pa.array(keys), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.bool_()), pa.array(lengths), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], names)
        rare = np.flatnonzero(~known)
        rare = rare[np.argsort(ids[rare], kind="stable")]
        own, first = np.unique(ids[rare], return_index=True)
        seen = np.empty(len(rare), _OCCURRENCE)
        seen["key"], seen["ctx"] = keys[owner[rare]], contexts[rare]
        n = len(own)
        yield pa.record_batch([_strings([words[i] for i in own.tolist()]), _binary(np.append(first, len(rare)) * _OCCURRENCE.itemsize, seen), *(none(n, k) for k in (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for r in zip(b["key"].to_pylist(), b["id"].to_pylist(), b["held"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()):
                held.append(r)
                size += len(r[3] or b"")
                if size >= BYTES_HELD:
                    yield from emit(sent.value, held)
                    held, size = [], 0
        if held:
            yield from emit(sent.value, held)

    return run


def _score_rare(sent):
    """Joined rows -> sums by document: those of frequent words as they are, and log-probabilities of the other words' occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "id", "held", "n_tokens", "n_known", "base", "score"]
        for b in batches:
            model: Dense = sent.value
            whole = b.filter(b["key"].is_valid())
            yield whole.select(names)
            b = b.filter(b["key"].is_null())
            if not b.num_rows:
                continue
            seen, times = _flat(b["seen"], _OCCURRENCE)
            row = np.repeat(np.arange(b.num_rows), times)
            n = np.asarray(b["train_n"].fill_null(0), np.float64)
            roots = np.tile(model.unseen, (b.num_rows, 1))
            known = n > 0
            if known.any():
                roots[known] = _flat(b["roots"], np.dtype("<f8"))[0].reshape(int(known.sum()), -1)
            ctx = seen["ctx"].astype(np.int64)
            p = model.average(roots[row], ctx)
            values, have = _flat(b["values"], _VALUE)
            if len(values):
                code = np.repeat(np.arange(b.num_rows), have) * CONTEXTS + values["ctx"]
                at = np.minimum(np.searchsorted(code, row * CONTEXTS + ctx), len(code) - 1)
                p = np.where(code[at] == row * CONTEXTS + ctx, values["p"][at], p)
            keys, at = np.unique(seen["key"], return_inverse=True)
            size = len(keys)
            sums = [np.bincount(at, w, size) for w in (known[row].astype(float), model.base(n)[row], np.log10(p))]
            yield pa.record_batch([pa.array(keys), pa.nulls(size, pa.int64()), pa.nulls(size, pa.bool_()), pa.nulls(size, pa.int64()), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], names)

    return run


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from: crc32 of the id as text, modulo 5, is 1."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 1, F.lit(False))


def fit(texts: DataFrame, frequent: int = FREQUENT) -> tuple[DataFrame, Dense]:
    """texts(text) -> the predictive table (lazy) and what is broadcast: totals, and the rows of the frequent words."""
    counted = counts(texts)
    state = sample(counted)
    model = counted.mapInArrow(_predictive(state), "word string, n long, roots binary, values binary")
    # how many words reach each step of a logarithmic scale of counts: a few thousand numbers at any size
    scale = F.floor(F.log2("n") * 64)
    least, total = math.inf, 0
    for step, n in sorted(((r["step"], r["n"]) for r in counted.groupBy(scale.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True):
        total += n
        if total > frequent:
            break
        least = step
    rows = counted.where(scale >= F.lit(float(least))).mapInArrow(_predictive(state), "word string, n long, roots binary, values binary").toArrow()
    return model, Dense(state, rows)


def score_by_classes(documents: DataFrame, frequent: int = FREQUENT, held: Column | None = None) -> DataFrame:
    """documents(doc_id, text) -> (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) by classes alone, learned from the rows that are not held out."""
    held = held_out(F.col("doc_id")) if held is None else held
    model, dense = fit(documents.where(~held).select("text"), frequent)
    sent = documents.sparkSession.sparkContext.broadcast(dense)
    rows = documents.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("id"), held.alias("held"), "text")
    seen = rows.mapInArrow(_score_frequent(sent), OCCURRENCES)
    joined = seen.join(model.withColumnsRenamed({"word": "model_word", "n": "train_n"}), F.col("word") == F.col("model_word"), "left").drop("model_word", "word")
    sums = joined.mapInArrow(_score_rare(sent), "key long, id long, held boolean, n_tokens long, n_known long, base double, score double")
    out = sums.groupBy("key").agg(F.max("id").alias("doc_id"), F.max("held").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.lit(dense.tokens).cast("long").alias("train_tokens"), F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return out.drop("key")


# words as contexts


def word_ids(words: list[bytes]) -> np.ndarray:
    """A number for each word, whose last seven bits are its class. 0 is the start of a text."""
    h = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    return h & ~np.uint64(CONTEXTS - 1) | context_classes(words).astype(np.uint64)


def code_book(texts: DataFrame, frequent: int) -> np.ndarray:
    """The sorted numbers of frequent words, by a bounded sample: how the totals of contexts travel, not what they are."""
    some = texts.select(F.substring("text", 1, 4000).alias("text")).limit(2000).toArrow()["text"].cast(pa.binary()).to_pylist()
    words, ids, _, _ = numbered(some)
    n = np.bincount(ids, minlength=len(words))
    most = np.argsort(-n, kind="stable")[: min(frequent, CODES)]
    return np.unique(np.append(word_ids([words[i] for i in most.tolist()]), np.uint64(0)))


def _coded(book: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words -> codes, and the numbers of those that have none."""
    at = np.minimum(np.searchsorted(book, ids), len(book) - 1)
    known = book[at] == ids
    return np.where(known, at, RARE).astype(np.uint16), ids[~known]


def _decoded(book: np.ndarray, code: np.ndarray, rare: np.ndarray) -> np.ndarray:
    ids = np.empty(len(code), np.uint64)
    known = code != RARE
    ids[known], ids[~known] = book[code[known]], rare
    return ids


MESSAGE = "bucket int, first long, h binary, size binary, code binary, rare binary, docs binary, meta binary"
MERGED = "bucket int, h binary, nw binary, size binary, code binary, rare binary, c binary, first binary, entries binary, delta binary, docs binary, meta binary"


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split() for x in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.record_batch([pa.array([v.tobytes() if isinstance(v, np.ndarray) else v for v in c], kinds[k]) for (_, k), c in zip(names, columns)], [n for n, _ in names])


def _row(schema: str, *values) -> pa.RecordBatch:
    return _rows(schema, [values])


def _messages(sent, buckets: int):
    """Texts -> for each bucket the pairs that end with its words: how often they occur, and in which documents of the task."""

    def emit(rows: list) -> Iterator[pa.RecordBatch]:
        book, first = sent.value, rows[0][0]
        words, ids, _, lengths = numbered([r[3] for r in rows])
        held = np.array([r[2] for r in rows], bool)
        meta = np.zeros(len(rows), _META)
        meta["first"], meta["held"], meta["n"] = first, held, lengths
        meta["id"], meta["valid"] = [r[1] or 0 for r in rows], [r[1] is not None for r in rows]
        out = [((first ^ first >> 33) % buckets, first, *[None] * 5, meta)]
        own = word_ids(words)
        bucket = (own >> np.uint64(20)) % np.uint64(buckets)
        order = np.lexsort((own, bucket))
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        contexts = np.append(own, np.uint64(0))
        by_id = np.argsort(contexts)
        place = np.empty(len(contexts), np.int64)
        place[by_id] = np.arange(len(contexts))
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[np.append(0, np.cumsum(lengths)[:-1])] = len(words)
        pair = rank[ids] * len(contexts) + place[before]
        at = np.argsort(pair, kind="stable")
        doc = np.repeat((np.arange(len(rows)) | held * HELD).astype(np.uint16), lengths)[at]
        pair = pair[at]
        start = np.flatnonzero(np.diff(pair, prepend=-1))
        doc[start] |= np.uint16(BEGINS)
        word, context = pair[start] // len(contexts), pair[start] % len(contexts)
        code, _ = _coded(book, contexts[by_id])
        cut = np.searchsorted(bucket[order][word], np.arange(buckets + 1, dtype=np.uint64))
        start = np.append(start, len(pair))
        for b in np.flatnonzero(np.diff(cut)).tolist():
            i, j = cut[b], cut[b + 1]
            w, size = np.unique(word[i:j], return_counts=True)
            codes = code[context[i:j]]
            out.append((b, first, own[order[w]], size.astype(np.uint32), codes, contexts[by_id[context[i:j][codes == RARE]]], doc[start[i] : start[j]], None))
        yield _rows(MESSAGE, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for r in zip(b["key"].to_pylist(), b["id"].to_pylist(), b["held"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()):
                if held and (size >= BYTES_HELD or len(held) >= DOCS_HELD or r[0] != held[-1][0] + 1):
                    yield from emit(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[3] or b"")
        if held:
            yield from emit(held)

    return run


def _merged(sent):
    """Messages sorted by bucket -> a row for each bucket: its words and their pairs once each, and where every pair occurs."""

    def whole(bucket: int, rows: list[dict]) -> pa.RecordBatch:
        meta = b"".join(r["meta"] or b"" for r in rows)
        rows = [r for r in rows if r["h"] is not None]
        get = lambda name, kind: np.frombuffer(b"".join(r[name] for r in rows), kind)
        w, u = np.repeat(get("h", "<u8"), get("size", "<u4")), _decoded(sent.value, get("code", "<u2"), get("rare", "<u8"))
        at = np.lexsort((u, w))
        new = np.ones(len(at), bool)
        new[1:] = (w[at[1:]] != w[at[:-1]]) | (u[at[1:]] != u[at[:-1]])
        pair = np.empty(len(at), np.int64)
        pair[at] = np.cumsum(new) - 1
        docs = get("docs", "<u2")
        c = np.bincount(pair[np.cumsum(docs & BEGINS > 0) - 1], docs < HELD, int(new.sum())).astype(np.int64)
        h, size = np.unique(w[at[new]], return_counts=True)
        nw = np.add.reduceat(c, np.append(0, np.cumsum(size)[:-1])) if len(h) else c
        code, rare = _coded(sent.value, u[at[new]])
        entries = np.array([len(r["code"]) // 2 for r in rows], np.uint32)
        first = np.array([r["first"] for r in rows], np.int64)
        delta = np.diff(pair, prepend=0).astype(np.int32)
        return _row(MERGED, bucket, h, nw, size.astype(np.uint32), code, rare, np.minimum(c, 0xFFFFFFFF).astype(np.uint32), first, entries, delta, docs, meta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                if rows and r["bucket"] != bucket:
                    yield whole(bucket, rows)
                    rows = []
                bucket = r["bucket"]
                rows.append(r)
        if rows:
            yield whole(bucket, rows)

    return run


def _dealt(df: DataFrame, name: str, tasks: int) -> DataFrame:
    """df kept as a table of the shared folder that is dealt by bucket, so that its joins by bucket move no rows of it."""
    spark = df.sparkSession
    own = f"{name}_{uuid.uuid4().hex}"
    path = f"{use_shared_dir(spark).rstrip('/')}/{own}"
    df.write.bucketBy(tasks, "bucket").option("path", path).option("compression", "zstd").saveAsTable(own)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)  # it is of use to this application alone
    return spark.table(own)


class Bucket:
    """A bucket's words (numbers h, customers nw) and their pairs: word, context, customers; the pairs of several customers; the (word, class) pairs."""

    def __init__(self, r: dict, book: np.ndarray):
        get = lambda name, kind: np.frombuffer(r[name], kind)
        self.h, self.nw = get("h", "<u8"), get("nw", "<i8")
        self.code = get("code", "<u2")
        self.u = _decoded(book, self.code, get("rare", "<u8"))
        self.c = get("c", "<u4").astype(np.int64)
        self.owner = np.repeat(np.arange(len(self.h)), get("size", "<u4"))
        dish = self.owner * CONTEXTS + (self.u & np.uint64(CONTEXTS - 1)).astype(np.int64)
        seen = np.flatnonzero(self.c)
        known, at = np.unique(dish[seen], return_inverse=True)
        self.wc_word, self.wc_cls = known // CONTEXTS, known % CONTEXTS
        self.wc = np.full(len(dish), -1, np.int64)
        self.wc[seen] = at
        if len(known):  # also for pairs that were not seen, if another word of the class was
            near = np.minimum(np.searchsorted(known, dish), len(known) - 1)
            self.wc = np.where(known[near] == dish, near, -1)
        self.cls = dish % CONTEXTS
        self.several = np.flatnonzero(self.c > 1)
        self.singles = np.bincount(self.wc[self.c == 1], minlength=len(known)).astype(float)

    def customers(self, t: np.ndarray) -> np.ndarray:
        """Customers of the (word, class) pairs: the tables of the class's words."""
        return self.singles + np.bincount(self.wc[self.several], t, len(self.singles))

    def excess(self, t: np.ndarray) -> np.ndarray:
        """Customers beyond one for each table, by pair: what a context's tables are fewer than its customers."""
        out = np.zeros(len(self.c))
        out[self.several] = self.c[self.several] - t
        return out


STATE = "bucket int, t binary, ct binary, t0 binary, code binary, code_e binary, rare binary, rare_e binary, sums binary"


def _state_row(bucket: int, b: Bucket, t: np.ndarray, ct: np.ndarray, t0: np.ndarray, more: list) -> pa.RecordBatch:
    """Tables after all sweeps so far (a row of t, ct and t0 for each), and the last sweep's sums for the others."""
    e, some = b.excess(t[-1]), b.several
    code, at = np.unique(b.code[some], return_inverse=True)
    code_e = np.bincount(at, e[some], len(code))
    rest = some[b.code[some] == RARE]
    rare, at = np.unique(b.u[rest], return_inverse=True)
    sums = np.concatenate((np.bincount(b.wc_cls, b.customers(t[-1]), CONTEXTS), np.bincount(b.wc_cls, ct[-1], CONTEXTS), [t0[-1].sum()], more))
    return _row(STATE, bucket, t.astype(np.uint32), ct.astype(np.uint32), t0.astype(np.uint32), code, code_e, rare, np.bincount(at, e[rest], len(rare)), sums)


class Levels:
    """What all words share: discounts, customers of the coded contexts, and the totals after each sweep so far."""

    def __init__(self, customers: np.ndarray, discounts: tuple[float, float, float], known: int, tokens: int):
        self.customers, (self.d, self.class_d, self.root_d), self.known, self.tokens = customers, discounts, known, tokens
        self.excess, self.class_customers, self.class_tables, self.root_tables = [], [], [], []

    def add(self, excess: np.ndarray, sums: np.ndarray) -> None:
        self.excess.append(excess)
        self.class_customers.append(sums[:CONTEXTS])
        self.class_tables.append(sums[CONTEXTS : 2 * CONTEXTS])
        self.root_tables.append(float(sums[2 * CONTEXTS]))

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.5) / (self.tokens + 0.5 * (self.known + 1)))

    def even(self) -> float:
        """The base measure of a known word."""
        return (1 - UNSEEN_SHARE) / max(1, self.known)

    def root(self, nw: np.ndarray, c0: np.ndarray, t0: np.ndarray, s: int) -> np.ndarray:
        """The root's probabilities: of words never seen together where nw is 0."""
        base = np.where(nw > 0, self.even(), UNSEEN_SHARE)
        return (c0 - self.root_d * t0 + (ROOT_STRENGTH + self.root_d * self.root_tables[s]) * base) / (ROOT_STRENGTH + self.class_tables[s].sum())

    def class_back_off(self, s: int) -> np.ndarray:
        return (STRENGTH + self.class_d * self.class_tables[s]) / (STRENGTH + self.class_customers[s])

    def classes(self, b: Bucket, cc: np.ndarray, ct: np.ndarray, root: np.ndarray, s: int) -> np.ndarray:
        """The classes' probabilities of the bucket's (word, class) pairs."""
        return (cc - self.class_d * ct) / (STRENGTH + self.class_customers[s][b.wc_cls]) + self.class_back_off(s)[b.wc_cls] * root[b.wc_word]


def _tables_of(r: dict, b: Bucket, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of pairs, (word, class) pairs and words: a row for the beginning and each sweep."""
    t, ct, t0 = (np.frombuffer(r[k], "<u4").astype(float).reshape(rows, n) for k, n in (("t", len(b.several)), ("ct", len(b.wc_word)), ("t0", len(b.h))))
    return t, ct, t0


def _part(u: np.ndarray, parts: int) -> np.ndarray:
    """Where the totals of contexts are summed."""
    return (u >> np.uint64(20)) % np.uint64(parts)


def _looked_up(r: dict, u: np.ndarray, width: int, parts: int) -> np.ndarray:
    """The totals that were sent to the bucket for contexts without a code; u names all that it asked for."""
    if not len(u):
        return np.zeros((width, 0))
    ids, at = np.unique(u, return_inverse=True)
    out = np.empty((width, len(ids)))
    out[:, np.argsort(_part(ids, parts), kind="stable")] = np.hstack([np.frombuffer(x["totals"], "<u4").reshape(width, -1) for x in r["told"]])
    return out[:, at]


def _seated(b: Bucket, levels: Levels, t: np.ndarray, ct: np.ndarray, t0: np.ndarray, of_context: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One sweep over a bucket; of_context has the tables of the contexts of its pairs of several customers."""
    c0 = np.bincount(b.wc_word, ct, len(b.h))
    root = levels.root(b.nw, c0, t0, s)
    p = levels.classes(b, b.customers(t), ct, root, s)
    some = b.several
    open_ = STRENGTH + levels.d * np.maximum(0, of_context - t)
    with np.errstate(over="ignore"):
        t = draw_tables(b.c[some].astype(float), open_, p[b.wc[some]], levels.d, log_stirling(levels.d), b.h[b.owner[some]], b.u[some] + np.uint64(1 << 32), s)
    cc = b.customers(t)
    open_ = STRENGTH + levels.class_d * np.maximum(0, levels.class_tables[s][b.wc_cls] - ct)
    ct = draw_tables(cc, open_, root[b.wc_word], levels.class_d, log_stirling(levels.class_d), b.h[b.wc_word], b.wc_cls, s)
    known = np.flatnonzero(b.nw)
    c0 = np.bincount(b.wc_word, ct, len(b.h))[known]
    new = np.zeros(len(b.h))
    new[known] = draw_tables(c0, np.full(len(known), ROOT_STRENGTH + levels.root_d * max(0.0, levels.root_tables[s] - 1)), np.full(len(known), levels.even()), levels.root_d, log_stirling(levels.root_d), b.h[known], CONTEXTS, s)
    return t, ct, new


def _each(make):
    """Rows one by one, so that no more than one bucket is unpacked at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield from make(b.slice(i, 1).to_pylist()[0])

    return run


ASKS = "part int, bucket int, u binary, x binary"


def _asks(bucket: int, u: np.ndarray, x: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """For each part a row with its contexts among u (ascending), and what the bucket adds to their totals."""
    part = _part(u, parts)
    order = np.argsort(part, kind="stable")
    which, start = np.unique(part[order], return_index=True)
    yield _rows(ASKS, [(k, bucket, u[at], np.stack([v[at] for v in x]).astype(np.uint32)) for k, at in zip(which.tolist(), np.split(order, start[1:]))])


def _answers(asks: DataFrame, width: int, parts: int) -> DataFrame:
    """asks -> (bucket, told): for each part the sums over all rows, in the order in which the bucket asked; bucket -1 only tells."""

    def whole(part: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        ids = [np.frombuffer(r["u"], "<u8") for r in rows]
        _, at = np.unique(np.concatenate(ids), return_inverse=True)
        x = np.hstack([np.frombuffer(r["x"], "<u4").reshape(width, -1) for r in rows])
        sums = np.stack([np.bincount(at, v) for v in x])
        own = zip(rows, np.split(at, np.cumsum([len(i) for i in ids])[:-1]))
        yield _rows("bucket int, part int, totals binary", [(r["bucket"], part, np.minimum(sums[:, i], 0xFFFFFFFF).astype(np.uint32)) for r, i in own if r["bucket"] >= 0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in groupby((r for b in batches for r in b.to_pylist()), key=lambda r: r["part"]):
            yield from whole(part, list(rows))

    summed = asks.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, "bucket int, part int, totals binary")
    return summed.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("part", "totals"))).alias("told"))


def _sums(df: DataFrame, what) -> np.ndarray:
    """The sum over tasks of the vectors that what(batch) gives, by slices."""
    form = "i int, x binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                own = what(b)
                total = own if total is None else total + own
        for i in range(0, 0 if total is None else len(total), SLICE):
            yield _row(form, i // SLICE, total[i : i + SLICE].astype(np.float64))

    def added(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_row(form, group["i"][0].as_py(), np.sum([np.frombuffer(x) for x in group["x"].to_pylist()], axis=0))])

    rows = sorted((r["i"], bytes(r["x"])) for r in df.mapInArrow(run, form).groupBy("i").applyInArrow(added, form).collect())
    return np.frombuffer(b"".join(x for _, x in rows))


PAIRS = ["bucket", "h", "nw", "size", "code", "rare", "c"]


def _sample_words(merged: DataFrame, sent, tasks: int, parts: int, most: int) -> tuple[Levels, DataFrame]:
    """The totals after each sweep and the tables of all sweeps; a sweep is one job over the buckets."""
    size = len(sent.value)

    def begin(r: dict) -> Iterator[pa.RecordBatch]:
        b = Bucket(r, sent.value)
        ones, ct, t0 = (np.ones((1, len(x))) for x in (b.several, b.wc_word, b.h))
        t0[0, b.nw == 0] = 0
        cc, kinds = b.customers(ones[0]), np.bincount(b.wc_word, minlength=len(b.h))
        look = [(b.nw > 0).sum(), b.nw.sum(), (b.c == 1).sum(), (b.c == 2).sum(), (cc == 1).sum(), (cc == 2).sum(), (kinds == 1).sum(), (kinds == 2).sum()]
        yield _state_row(r["bucket"], b, ones, ct, t0, look)

    def totals(b: pa.RecordBatch) -> np.ndarray:
        parts = []
        for code, e, sums in zip(b["code"].to_pylist(), b["code_e"].to_pylist(), b["sums"].to_pylist()):
            known = np.frombuffer(code, "<u2") != RARE
            parts.append(np.append(np.bincount(np.frombuffer(code, "<u2")[known], np.frombuffer(e, "<f8")[known], size), np.frombuffer(sums, "<f8")))
        return np.sum(parts, axis=0)

    def customers(b: pa.RecordBatch) -> np.ndarray:
        parts = zip(b["code"].to_pylist(), b["c"].to_pylist())
        return np.sum([np.bincount(np.minimum(np.frombuffer(code, "<u2"), size), np.frombuffer(c, "<u4"), size + 1)[:size] for code, c in parts], axis=0)

    def told(r: dict) -> Iterator[pa.RecordBatch]:
        h, n = np.frombuffer(r["h"], "<u8"), np.frombuffer(r["nw"], "<i8")
        rest = (n > 1) & (_coded(sent.value, h)[0] == RARE)  # a word's customers as a context: something follows wherever it stands
        yield from _asks(-1, h[rest], [n[rest], np.zeros(rest.sum())], parts)

    def asked(r: dict) -> Iterator[pa.RecordBatch]:
        u = np.frombuffer(r["rare"], "<u8")
        yield from _asks(r["bucket"], u, [np.zeros(len(u)), np.frombuffer(r["rare_e"], "<f8")], parts)

    state = _dealt(merged.select(PAIRS).mapInArrow(_each(begin), STATE), "pitman_yor_state", tasks)
    n, levels = _sums(merged.select("code", "c"), customers), None
    for s in range(most + 1):
        now = _sums(state.select("code", "code_e", "sums"), totals)
        if levels is None:
            look = now[-8:] if len(now) else np.zeros(8)
            levels = Levels(n, tuple(_discount(*look[i : i + 2]) for i in (2, 4, 6)), int(look[0]), int(look[1]))
        if not levels.known:
            break
        levels.add(now[:size], now[size:])
        if s == most:
            break

        def sweep(r: dict, s: int = s) -> Iterator[pa.RecordBatch]:
            b = Bucket(r, sent.value)
            t, ct, t0 = _tables_of(r, b, s + 1)
            some, code = b.several, b.code[b.several]
            of_context = np.empty(len(some))
            known = code != RARE
            of_context[known] = (levels.customers - levels.excess[s])[code[known]]
            x = _looked_up(r, b.u[some[~known]], 2, parts)
            of_context[~known] = x[0] - x[1]
            new = _seated(b, levels, t[-1], ct[-1], t0[-1], of_context, s)
            yield _state_row(r["bucket"], b, *(np.vstack((x, y)) for x, y in zip((t, ct, t0), new)), [])

        asks = state.select("bucket", "rare", "rare_e").mapInArrow(_each(asked), ASKS).union(merged.select("h", "nw").mapInArrow(_each(told), ASKS))
        joined = merged.select(PAIRS).join(state.select("bucket", "t", "ct", "t0"), "bucket").join(_answers(asks, 2, parts), "bucket", "left")
        state = _dealt(joined.mapInArrow(_each(sweep), STATE), "pitman_yor_state", tasks)
    return levels, state


def _predicted(b: Bucket, levels: Levels, tables: tuple, customers: np.ndarray, of_context: np.ndarray, first: int) -> np.ndarray:
    """Averaged probabilities of a bucket's pairs; of_context has the tables of their contexts, by sample."""
    total = np.zeros(len(b.c))
    for i, s in enumerate(range(first, len(levels.root_tables))):
        t, ct, t0 = (x[s] for x in tables)
        root = levels.root(b.nw, np.bincount(b.wc_word, ct, len(b.h)), t0, s)
        p = levels.class_back_off(s)[b.cls] * root[b.owner]
        have = b.wc >= 0
        p[have] = levels.classes(b, b.customers(t), ct, root, s)[b.wc[have]]
        own = np.where(b.c > 0, b.c - levels.d * (b.c - b.excess(t)), 0)  # customers less the discount of each table
        total += (own + (STRENGTH + levels.d * of_context[i]) * p) / (STRENGTH + customers)
    return total / max(1, len(levels.root_tables) - first)


SUMMED = "first long, meta binary, sums binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _probabilities(r: dict, sent, levels: Levels, parts: int) -> tuple[Bucket, np.ndarray]:
    """A bucket with its tables and the totals that it asked for -> the probabilities of its pairs."""
    b, samples = Bucket(r, sent.value), range(BURN_IN + 1, len(levels.root_tables))
    if not levels.known:  # nothing was learned: all is unseen
        return b, np.ones(len(b.c))
    coded = b.code != RARE
    code = b.code[coded]
    customers, of_context = np.empty(len(b.c)), np.empty((len(samples), len(b.c)))
    x = _looked_up(r, b.u[~coded], len(samples) + 1, parts)
    customers[coded], customers[~coded] = levels.customers[code], x[0]
    for i, s in enumerate(samples):
        of_context[i, coded] = levels.customers[code] - levels.excess[s][code]
        of_context[i, ~coded] = x[0] - x[i + 1]
    return b, _predicted(b, levels, _tables_of(r, b, len(levels.root_tables)), customers, of_context, samples.start)


def _score_buckets(sent, levels: Levels, parts: int):
    """Buckets with tables and totals -> for the documents that a task of `_messages` held together: sums over the words of a task, and once who they are."""

    def sums(r: dict) -> Iterator[tuple[np.ndarray, ...]]:
        get = lambda name, kind: np.frombuffer(r[name], kind)
        b, p = _probabilities(r, sent, levels, parts)
        known, base, logs = (b.nw > 0)[b.owner], levels.base(b.nw)[b.owner], np.log10(p)
        pair, docs = np.cumsum(get("delta", "<i4"), dtype=np.int64), get("docs", "<u2")
        start = np.append(np.flatnonzero(docs & BEGINS), len(docs))
        message = np.append(0, np.cumsum(get("entries", "<u4"), dtype=np.int64))
        for key, (i, j) in zip(get("first", "<i8").tolist(), pairwise(message.tolist())):
            own, n = docs[start[i] : start[j]] & DOC_MASK, np.repeat(pair[i:j], np.diff(start[i : j + 1]))
            yield key, np.stack([np.bincount(own, x[n]) for x in (known, base, logs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                meta = np.frombuffer(r["meta"], _META)
                for m in np.split(meta, np.flatnonzero(np.diff(meta["first"])) + 1) if len(meta) else []:
                    yield _row(SUMMED, int(m["first"][0]), m, None)
                for key, x in sums(r):
                    before = held.get(key)
                    size += x.shape[1]
                    held[key] = x if before is None else _added(before, x)
                if size >= 1_000_000:
                    yield _rows(SUMMED, [(k, None, x) for k, x in held.items()])
                    held, size = {}, 0
        if held:
            yield _rows(SUMMED, [(k, None, x) for k, x in held.items()])

    return run


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum of two arrays of rows that may differ in length."""
    if a.shape[1] < b.shape[1]:
        a, b = b, a
    a = a.copy()
    a[:, : b.shape[1]] += b
    return a


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums sorted by first -> a row for each document."""
    names = [x.split()[0] for x in SCORED.split(", ")]
    for _, rows in groupby((r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()), key=lambda r: r["first"]):
        meta, total = None, np.zeros((3, 0))
        for r in rows:
            if r["meta"] is not None:
                meta = np.frombuffer(r["meta"], _META)
            else:
                total = _added(total, np.frombuffer(r["sums"], "<f8").reshape(3, -1))
        yield pa.record_batch([pa.array(meta["id"], mask=~meta["valid"]), pa.array(meta["held"]), pa.array(meta["n"]), pa.array(np.rint(total[0]).astype(np.int64)), pa.array(total[1]), pa.array(total[2])], names)


def _model(documents: DataFrame, frequent: int, held: Column) -> tuple[DataFrame, Levels, object, int]:
    """Buckets with all that the probabilities of their pairs need (lazy), what all words share, the code book as sent, and the number of parts."""
    text_bytes = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(2, -(-text_bytes // (BUCKET_BYTES * TOGETHER)))
    sent = documents.sparkSession.sparkContext.broadcast(code_book(documents, frequent))
    rows = documents.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("id"), held.alias("held"), "text")
    messages = rows.mapInArrow(_messages(sent, tasks * TOGETHER), MESSAGE)
    merged = _dealt(messages.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_merged(sent), MERGED), "pitman_yor_pairs", tasks)
    levels, state = _sample_words(merged, sent, tasks, parts := -(-tasks // 4), BURN_IN + SAMPLES)

    def asked(r: dict) -> Iterator[pa.RecordBatch]:
        b = Bucket(r, sent.value)
        rest = np.flatnonzero(b.code == RARE)
        u, at = np.unique(b.u[rest], return_inverse=True)
        tables, _, _ = _tables_of(r, b, len(levels.root_tables))
        yield from _asks(r["bucket"], u, [np.bincount(at, x[rest], len(u)) for x in (b.c, *(b.excess(t) for t in tables[BURN_IN + 1 :]))], parts)

    tables = state.select("bucket", "t", "ct", "t0")
    joined = merged.join(tables, "bucket")
    if levels.known:
        asks = merged.select(PAIRS).join(tables, "bucket").mapInArrow(_each(asked), ASKS)
        joined = joined.join(_answers(asks, SAMPLES + 1, parts), "bucket", "left")
    return joined, levels, sent, parts


def score(documents: DataFrame, frequent: int = FREQUENT, held: Column | None = None) -> DataFrame:
    """documents(doc_id, text) -> (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), learned from the rows that are not held out.

    frequent bounds the contexts whose totals are broadcast; it changes no result.
    """
    joined, levels, sent, parts = _model(documents, frequent, held_out(F.col("doc_id")) if held is None else held)
    sums = joined.mapInArrow(_score_buckets(sent, levels, parts), SUMMED)
    out = sums.repartition(parts, "first").sortWithinPartitions("first").mapInArrow(_documents, SCORED)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(levels.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def perplexity(scored: DataFrame) -> DataFrame:
    """One row for held-out and one for training texts: tokens and the perplexities of model and base."""
    ppl = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), ppl("score").alias("perplexity"), ppl("base_score").alias("base_perplexity"))
