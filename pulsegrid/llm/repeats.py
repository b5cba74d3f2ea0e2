"""Substring near-duplicates: documents that hold near-duplicate passages of PASSAGE words or more, found by compact windows.

A passage is PASSAGE words or more; two are near-duplicates if the Jaccard similarity of their five-word shingles (a
repeated one counts as often as it occurs) is LIKENESS (0.8) or more. Each of eight min-hash functions orders a text's shingles. A compact window of one function is a
node of the Cartesian tree over that order: the longest stretch whose minimum the node is, so all sequences inside
that hold the node have the same min-hash. Only windows that span WIDTH shingles (a passage's least) matter.

1. Texts of equal words count as one from the start (a digest in two lanes).
2. In each text the windows of two functions are joined as intervals: a cell is what the two windows have in common,
   that is, all sequences with one pair of min-hashes. The eight functions make four such joins. Passages that agree in
   five of the eight min-hashes agree in both of some join, whatever the five are; those of similarity 0.8 share a cell
   with 98 % probability at a single place (more where they are longer), equal ones always.
3. Cells that several texts have are looked up by their two shingles. Where the PASSAGE words about a cell are equal too
   (a hash of them beside that of the cell), their texts are tied, without pairs.
4. Cells that texts not yet tied share are verified on the words: REACH words on both sides, from which the best
   passages are found: by their longest common subsequence of shingles, then by all common shingles in whatever order.
   (A passage that can be parted in two with WIDTH shingles on each side, each with its counterpart, has a part of that
   similarity, so REACH is enough; sentences that changed places are seen where they lie within REACH of the cell.) Before any two are compared, shingles that
   only one group has are set aside, surroundings with too few others dropped, and equal ones folded; so a line
   that very many texts hold among different words costs what it holds. A cell of more than LOCAL surroundings has this done by a
   distributed count; what is left of it is compared in a grid of chunks. Nothing that is joined already is compared.

Nothing has a cap, and no text reaches the driver; the shared cells do where they are few (BROADCAST_VALUES).

Defined results: null and short texts have no passages and form classes of their own; class_id is the smallest id among
the linked rows, whatever rows without id or with repeated ids lie between (null if none has an id); rows with one id
are separate texts.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.storage import BROADCAST_KEYS, cut, kept, small_or_shuffled
from pulsegrid.operators.graph import connected_components

SHINGLE, PASSAGE = 5, 50
#: Shingles of the shortest passage, and how many of them two such passages of LIKENESS (as a ratio) share at least.
WIDTH = PASSAGE - SHINGLE + 1
LIKENESS = (4, 5)
COMMON = -(-2 * WIDTH * LIKENESS[0] // (LIKENESS[0] + LIKENESS[1]))
#: Words kept on either side of a cell's centre.
REACH = 2 * WIDTH
#: Odd factors: each orders the (mixed) shingles in its own way. Two neighbours are joined.
FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64)) for k in range(8)]
JOINS = [(0, 1), (2, 3), (4, 5), (6, 7)]
#: Surroundings of a cell that one task holds, and the parts of larger ones.
LOCAL, CHUNK = 16_384, 4_096
#: Cells of so few surroundings are compared many at a time.
TOGETHER_ROWS = 16
#: Surroundings after which the cells of one smallest label go to a further task.
SPREAD = 2_048
#: Pairs of surroundings looked at together.
PAIRS = 1_024
#: Rounds of setting aside before more than so many surroundings are compared.
PEELED, FEW = 2, 64
#: Words looked at together, which bounds memory; bits of a place among them; bytes split together, and of short texts together.
BLOCK, PLACE, SPLIT, TOGETHER = 1 << 14, 24, 1 << 20, 1 << 16
#: Shared values are broadcast up to this many (16 MB); beyond it they are joined.
BROADCAST_VALUES = 2_000_000
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


#: Bytes as they are hashed: blanks to 0, A-Z lowered, the zero byte to one that no text has.
_BYTES = bytes(0 if x == 32 or 9 <= x <= 13 else 0xFE if x == 0 else x + 32 if 65 <= x <= 90 else x for x in range(256))
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def _powers(base: int) -> np.ndarray:
    factors = np.full(SPLIT + 1, base, np.uint64)
    factors[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(factors, dtype=np.uint64)


_UP, _DOWN = _powers(int(_B1)), _powers(pow(int(_B1), -1, 1 << 64))


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """At most SPLIT bytes -> (a 64-bit hash, not zero, of every word; where it starts). Words are hashed together, as polynomials got from running sums."""
    codes = np.frombuffer(data.translate(_BYTES), np.uint8)
    inside = np.empty(len(codes) + 2, np.int8)
    inside[0] = inside[-1] = 0
    np.not_equal(codes, 0, out=inside[1:-1], casting="unsafe")
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _DOWN[: len(codes)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * _UP[starts]) | np.uint64(1), starts


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts of at most SPLIT bytes that end at blanks; a longer word is cut."""
    at = 0
    while len(text) - at > SPLIT:
        part = text[at : at + SPLIT]
        last = len(part) - 1 - max(0, next((m.start() for m in _BLANK.finditer(part[::-1])), 0))
        yield part[: last + 1]
        at += last + 1
    yield text[at:]


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Texts -> (a hash of every word, the texts in a row; bounds of the texts)."""
    words, counts, n = [], np.zeros(len(texts) + 1, np.int64), 0
    while n < len(texts):
        first, size = n, 0
        while n < len(texts) and (n == first or size + len(texts[n] or b"") < TOGETHER):
            size += len(texts[n] or b"") + 1
            n += 1
        if size > TOGETHER:  # one long text
            found = [_hashed(p)[0] for p in _parts(texts[first])]
            counts[n] = sum(map(len, found))
            words += found
            continue
        found, starts = _hashed(b" ".join(t or b"" for t in texts[first:n]))
        ends = np.cumsum([len(t or b"") + 1 for t in texts[first:n]])
        counts[first + 1 : n + 1] = np.diff(np.searchsorted(starts, ends), prepend=0)
        words.append(found)
    return (np.concatenate(words) if words else np.empty(0, np.uint64)), np.cumsum(counts)


def shingle_codes(words: np.ndarray) -> np.ndarray:
    """Words (the last axis) -> a hash of the shingle at every place, 0 where it holds a 0 (a place beyond the text)."""
    n = words.shape[-1] - SHINGLE + 1
    if n <= 0:
        return np.zeros((*words.shape[:-1], 0), np.uint64)
    code, whole = np.zeros((*words.shape[:-1], n), np.uint64), np.ones((*words.shape[:-1], n), bool)
    for k in range(SHINGLE):
        word = words[..., k : k + n]
        code = code * _B1 + word
        whole &= word > 0
    return np.where(whole, _mixed(code) | np.uint64(1), np.uint64(0))


def first_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For every stretch of width values the place of its first minimum: the node of the Cartesian tree whose compact window holds the stretch.

    A value is compared by its high bits and, where these are equal, by its place.
    """
    least = values & np.uint64((1 << 64) - (1 << PLACE)) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:]) if len(least) > span else least[:0]
        span *= 2
    rest = width - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    return (least & np.uint64((1 << PLACE) - 1)).astype(np.int64)


def cells(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of texts in a row (text i from bounds[i] to bounds[i + 1]) -> (key, centre) of the cells: what windows of two functions have in common.

    A passage of PASSAGE words lies in one window of each function, and so in one cell of each join; cells are found where
    the pair of minima changes from one passage to the next, or its place moves on (a line over and over).
    """
    end = np.repeat(bounds[1:], np.diff(bounds))
    whole = np.arange(len(words)) + PASSAGE <= end
    fresh = np.zeros(len(words) + 1, bool)
    fresh[bounds] = True
    keys, centres = [], []
    for at in range(0, len(words) - PASSAGE + 1, BLOCK):
        part = words[at : at + BLOCK + PASSAGE - 1]
        code = shingle_codes(part)
        nodes = [first_minima(code * f, WIDTH) for f in FACTORS]
        least = [code[x] for x in nodes]
        n = len(nodes[0])
        for band, (i, j) in enumerate(JOINS):
            changed = fresh[at : at + n].copy()
            changed[0] = True
            near = nodes[i] + nodes[j] >> 6
            changed[1:] |= (least[i][1:] != least[i][:-1]) | (least[j][1:] != least[j][:-1]) | (near[1:] != near[:-1])
            new = np.flatnonzero(changed & whole[at : at + n])
            a, b = nodes[i][new], nodes[j][new]
            keys.append(_mixed(_mixed(code[a] + np.uint64(band)) * _B1 + code[b] * _B2))
            centres.append((a + b >> 1) + at)
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(centres)


def about(words: np.ndarray, start: np.ndarray, end: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """A hash of the PASSAGE words about each centre, within its text from start to end."""
    first = np.clip(centre - (PASSAGE - SHINGLE) // 2, start, end - PASSAGE)
    out = np.zeros(len(first), np.uint64)
    for k in range(PASSAGE):
        out = out * _B2 + words[first + k]
    return _mixed(out)


def surroundings(words: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The words from REACH before each centre's shingle to REACH behind, 0 beyond the text's ends."""
    wide = np.zeros(len(words) + 2 * REACH + SHINGLE, np.uint64)
    wide[REACH : REACH + len(words)] = words
    return wide[np.asarray(centres, np.int64)[:, None] + np.arange(2 * REACH + SHINGLE)]


def _chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The longest common subsequence of two rows of codes, as places."""
    if len(a) == len(np.unique(a)) and len(b) == len(np.unique(b)):  # a longest rising row of places
        where = dict(zip(b.tolist(), range(len(b))))
        ends, tails, links = [], [], []
        for i, c in enumerate(a.tolist()):
            if (j := where.get(c)) is not None:
                k = bisect.bisect_left(ends, j)
                links.append((i, j, tails[k - 1] if k else -1))
                ends[k : k + 1], tails[k : k + 1] = [j], [len(links) - 1]
        out, at = [], tails[-1] if tails else -1
        while at >= 0:
            i, j, at = links[at]
            out.append((i, j))
        return np.array(out[::-1], np.int64).reshape(-1, 2)
    same = a[:, None] == b
    length = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i in range(len(a)):
        np.maximum.accumulate(np.maximum(length[i, 1:], (length[i, :-1] + 1) * same[i]), out=length[i + 1, 1:])
    out, i, j = [], len(a), len(b)
    rows = length.tolist()
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return np.array(out[::-1], np.int64).reshape(-1, 2)


def _left_over(a: np.ndarray, b: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """Places of equal codes that the chain leaves, each used once: a code's first place in a with its first in b, and so on."""
    places = []
    for codes, used in ((a, chain[:, 0]), (b, chain[:, 1])):
        free = np.setdiff1d(np.arange(len(codes)), used)
        free = free[np.argsort(codes[free], kind="stable")]
        own = codes[free]
        nth = np.arange(len(own)) - np.searchsorted(own, own)
        places.append(dict(zip(zip(own.tolist(), nth.tolist()), free.tolist())))
    return np.array([(i, places[1][k]) for k, i in places[0].items() if k in places[1]], np.int64).reshape(-1, 2)


def _in_any_order(pairs: np.ndarray) -> bool:
    """Whether a stretch of a and one of b, each of WIDTH places or more, hold enough of the pairs of places (a, b), wherever they stand in the two.

    A stretch of a begins and ends at a pair and must be able to reach LIKENESS by its own pairs. For all that are left
    at once, the pairs are taken in the order of b: the best stretch of b up to each is found from running sums.
    """
    n, share, whole = len(pairs), LIKENESS[0], sum(LIKENESS)
    x, y = np.sort(pairs[:, 0]), pairs[np.argsort(pairs[:, 1]), 1]
    rank = np.searchsorted(x, pairs[np.argsort(pairs[:, 1]), 0])
    size = np.maximum(x[None, :] - x[:, None] + 1, WIDTH)
    most = np.arange(n)[None, :] - np.arange(n)[:, None] + 1
    first, last = np.nonzero((most * LIKENESS[1] >= share * size) & (most * whole >= share * (size + WIDTH)))
    if not len(first):
        return False
    cost = share * size[first, last].astype(np.int32)
    counts = np.zeros((n + 1, len(first)), np.int16)
    np.cumsum((first <= rank[:, None]) & (rank[:, None] <= last), axis=0, dtype=np.int16, out=counts[1:])
    near = np.searchsorted(y, y - WIDTH + 1)  # the first pair of b that is less than WIDTH before
    best, at = np.full(len(first), np.iinfo(np.int16).min, np.int32), 0
    for e in range(n):
        while at < near[e]:
            np.maximum(best, share * y[at] - whole * counts[at].astype(np.int32), out=best)
            at += 1
        here = whole * counts[e + 1].astype(np.int32)
        short = here - whole * counts[near[e]].astype(np.int32) - share * WIDTH
        if (np.maximum(short, here + best - share * (y[e] + 1)) >= cost).any():
            return True
    return False


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two rows of shingle codes hold passages of PASSAGE words or more, from one common shingle to another, with a Jaccard similarity of LIKENESS.

    Repeated shingles count as often as they occur. Common ones are those of the longest common subsequence and, in
    whatever order, what both rows have beside it: passages whose sentences changed places are found too. A passage too
    short is made longer by shingles that count as its own alone.
    """
    a, b = a[a > 0], b[b > 0]
    own_a, own_b = np.isin(a, b), np.isin(b, a)
    chain = _chain(a[own_a], b[own_b])
    if not len(chain):
        return False
    x, y = np.flatnonzero(own_a)[chain[:, 0]], np.flatnonzero(own_b)[chain[:, 1]]
    chain = np.stack((x, y), axis=1)
    moved = _left_over(a, b, chain)
    pairs = np.concatenate((chain, moved))
    if len(pairs) < COMMON:
        return False
    low = np.minimum(np.searchsorted(x, pairs[:, 0], "right"), np.searchsorted(y, pairs[:, 1], "right")) - 1
    high = np.maximum(np.searchsorted(x, pairs[:, 0]), np.searchsorted(y, pairs[:, 1]))
    inside = (low >= 0) & (high < len(x))
    h = np.zeros((len(x), len(x)), np.int64)
    np.add.at(h, (low[inside], high[inside]), 1)
    common = np.cumsum(np.cumsum(h[::-1], axis=0)[::-1], axis=1)
    sizes = sum(np.maximum(at[None, :] - at[:, None] + 1, WIDTH) for at in (x, y))
    if (np.triu(np.ones(common.shape, bool)) & (common * sum(LIKENESS) >= LIKENESS[0] * sizes)).any():
        return True
    return len(moved) > 0 and _in_any_order(pairs)


def _first_places(codes: np.ndarray) -> np.ndarray:
    """[row, i] -> 1 + the first place of the row that has the code at i."""
    order = np.argsort(codes, axis=1, kind="stable")
    ranked = np.take_along_axis(codes, order, axis=1)
    new = np.ones(codes.shape, bool)
    new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    first = np.maximum.accumulate(np.where(new, np.arange(codes.shape[1]), 0), axis=1)
    out = np.empty(codes.shape, np.uint64)
    np.put_along_axis(out, order, (np.take_along_axis(order, first, axis=1) + 1).astype(np.uint64), axis=1)
    return out


def _masked(codes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Codes with those that are not common replaced by the place where the row has them first: what the row has alone, whatever it is."""
    return np.where(common | (codes == 0), codes, _first_places(codes))


#: Codes up to here are places.
_PLACES = np.uint64(2 * REACH + SHINGLE + 1)


def _dense(common: np.ndarray, share: tuple[int, int], surplus: int) -> np.ndarray:
    """Which places lie in a stretch of WIDTH or more about the centre whose common places times share[1] less all its places times share[0] make surplus."""
    n = common.shape[1]
    sums = np.zeros((len(common), n + 1), np.int32)
    np.cumsum(common * np.int32(share[1]) - np.int32(share[0]), axis=1, out=sums[:, 1:])
    best = np.maximum.accumulate(sums[:, ::-1], axis=1)[:, ::-1]  # the largest sum from a place on
    starts = np.arange(REACH + 1)
    need = sums[:, starts] + surplus
    good = best[:, np.maximum(starts + WIDTH, REACH + 1)] >= need
    least = np.where(good, need, np.iinfo(np.int32).max).min(axis=1)
    last = (best >= least[:, None]).sum(axis=1) - 1  # the farthest end
    place = np.arange(n)
    return good.any(axis=1)[:, None] & (place >= good.argmax(axis=1)[:, None]) & (place < last[:, None])


def _viable(common: np.ndarray) -> np.ndarray:
    """common, less what cannot be in a near-duplicate passage that holds the cell: of n common shingles and two passages of a and b, n must be LIKENESS of a, and (4 / 9 for 0.8) of a + b with b >= WIDTH."""
    out = np.zeros(common.shape, bool)
    some = np.flatnonzero(common.sum(axis=1) >= COMMON)
    part = common[some]
    out[some] = part & _dense(part, (LIKENESS[0], sum(LIKENESS)), LIKENESS[0] * WIDTH) & _dense(part, LIKENESS, 0)
    return out


def _shortest(common: np.ndarray) -> np.ndarray:
    """[row, n - COMMON] -> the places of the shortest stretch, WIDTH at least, that holds n common places."""
    count = common.sum(axis=1)
    most = max(COMMON, int(count.max(initial=0)))
    at = np.argsort(~common, axis=1, kind="stable")[:, :most].astype(np.int32)
    nth = np.arange(at.shape[1], dtype=np.int32)
    at = np.where(nth < count[:, None], at, (nth + 1) * (common.shape[1] + 1))  # so far apart that no stretch holds two
    out = np.full((len(common), common.shape[1] - COMMON + 1), 2 * common.shape[1], np.int32)
    for n in range(COMMON, most + 1):
        out[:, n - COMMON] = np.maximum((at[:, n - 1 :] - at[:, : most - n + 1]).min(axis=1) + 1, WIDTH)
    return out


def _close(common_a: np.ndarray, common_b: np.ndarray) -> np.ndarray:
    """Which pairs of rows can hold passages of LIKENESS, whatever the order: n common shingles stand in n places of either, and in no shorter stretch than the shortest of n."""
    sizes = _shortest(common_a) + _shortest(common_b)
    return (sum(LIKENESS) * np.arange(COMMON, COMMON + sizes.shape[1]) >= LIKENESS[0] * sizes).any(axis=1)


def _shared(codes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which codes another label has too, and how many of a row's at most are common with a row of another label."""
    width, shape = codes.shape[1], codes.shape
    flat, label, row = codes.reshape(-1), np.repeat(labels, width), np.repeat(np.arange(len(codes)), width)
    order = np.lexsort((row, label, flat))
    flat, label, row = flat[order], label[order], row[order]

    def starts(*columns: np.ndarray) -> np.ndarray:
        new = np.ones(len(columns[0]), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        return np.flatnonzero(new)

    in_row = starts(flat, label, row)
    times = np.diff(np.concatenate((in_row, [len(flat)])))
    flat, label, row = flat[in_row], label[in_row], row[in_row]
    in_label = starts(flat, label)
    most = np.maximum.reduceat(times, in_label)
    at_label = np.repeat(np.arange(len(in_label)), np.diff(np.concatenate((in_label, [len(flat)]))))
    in_code = starts(flat[in_label])
    at_code = np.repeat(np.arange(len(in_code)), np.diff(np.concatenate((in_code, [len(in_label)]))))
    rank = np.lexsort((-most, at_code))  # each code's labels by how often a row of theirs has it
    first, second = rank[in_code], np.minimum(in_code + 1, len(rank) - 1)
    beyond = np.where(at_code[rank[second]] == np.arange(len(in_code)), most[rank[second]], 0)
    others = np.where(np.arange(len(in_label)) == first[at_code], beyond[at_code], most[first][at_code])[at_label]
    others = np.where(flat >= _PLACES, others, 0)
    known = np.empty(shape[0] * width, bool)
    known[order] = np.repeat(others > 0, times)
    return known.reshape(shape), np.bincount(row, np.minimum(times, others), shape[0])


def peeled(codes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Surroundings of a cell -> what can be near a passage of another label: codes that one label alone has are set aside, rows without a passage of others dropped, equal rows folded."""
    for _ in range(PEELED):  # what a further round would drop is compared instead
        if not len(codes):
            break
        common, at_most = _shared(codes, labels)
        common = _viable(common & (at_most >= COMMON)[:, None])
        alive = common.any(axis=1)
        codes, common, labels = codes[alive], common[alive], labels[alive]
        if not len(codes):
            break
        rows = np.ascontiguousarray(np.concatenate((labels.astype(np.int64).view(np.uint64)[:, None], _masked(codes, common)), axis=1))
        _, first = np.unique(rows.view(np.dtype((np.void, rows.shape[1] * 8))).reshape(-1), return_index=True)
        codes, labels = rows[first, 1:], labels[first]
    return codes, labels


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every COMMON shingles in a row: equal ones are a near-duplicate whatever is beside them."""
    real = np.zeros((len(codes), codes.shape[1] + 1), np.int32)
    np.cumsum(codes >= _PLACES, axis=1, out=real[:, 1:])
    row, start = np.nonzero(real[:, COMMON:] - real[:, :-COMMON] == COMMON)
    sums = np.zeros(real.shape, np.uint64)
    np.cumsum(codes * _DOWN[: codes.shape[1]], axis=1, out=sums[:, 1:])
    return row, _mixed((sums[row, start + COMMON] - sums[row, start]) * _UP[start])


def _in_step(codes: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Which rows have passages about the cell that are near those of one at the same places."""
    same = (codes == one) & (one >= _PLACES)
    return _dense(same, (2 * LIKENESS[0], sum(LIKENESS)), 0).any(axis=1)


def joined(codes: np.ndarray, labels: np.ndarray) -> list[tuple[int, int]]:
    """Surroundings of a cell -> pairs of labels that join what near-duplicate passages join; what is joined already is not compared.

    The label with the most rows comes last, so its rows are compared with those of others alone.
    """
    if len(codes) > FEW:
        codes, labels = peeled(codes, labels)
    names, group, size = np.unique(labels, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return []
    root, found = np.arange(len(names)), []

    def tie(a: int, c: int) -> None:
        a, c = sorted((int(root[a]), int(root[c])))
        if a != c:
            found.append((int(names[c]), int(names[a])))
            root[root == c] = a

    row, run = _runs(codes)
    _, first, which = np.unique(run, return_index=True, return_inverse=True)
    for a, c in np.unique(np.stack((group[row[first]][which], group[row])), axis=1).T.tolist():
        tie(a, c)
    if (root == root[0]).all():
        return found
    order = np.lexsort((group, size[group]))
    codes, group = codes[order], group[order]
    known, dense = np.unique(codes, return_inverse=True)
    dense = dense.reshape(codes.shape)
    shingle = known >= _PLACES
    n = len(codes)
    pairs, times = np.unique(dense.reshape(-1) * n + np.repeat(np.arange(n), codes.shape[1]), return_counts=True)  # (code, row) and how often
    code, row = pairs // n, pairs % n
    starts = np.searchsorted(code, np.arange(len(known) + 1))
    def in_common(i: int) -> np.ndarray:
        """How many shingles the row has in common with each row, repeats counted."""
        mine, often = np.unique(dense[i], return_counts=True)
        mine, often = mine[shingle[mine]], often[shingle[mine]]
        size = starts[mine + 1] - starts[mine]
        at = np.repeat(starts[mine] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(row[at], np.minimum(times[at], np.repeat(often, size)), n)

    for i in range(len(group) - size.max()):
        others = i + 1 + np.flatnonzero(root[group[i + 1 :]] != root[group[i]])
        if not len(others):
            continue
        often = in_common(i)[others]
        others = others[np.argsort(-often, kind="stable")[: (often >= COMMON).sum()]]  # the likeliest first: what it ties is not compared
        for j in others[_in_step(codes[others], codes[i])].tolist():
            tie(group[i], group[j])
        others = others[root[group[others]] != root[group[i]]]
        if not len(others):
            continue
        own = np.zeros(len(known), bool)
        own[dense[i]] = True
        own &= shingle
        others = others[_viable(own[dense[others]]).any(axis=1)]
        answers: dict[bytes, bool] = {}
        for at in range(0, len(others), PAIRS):
            part = others[at : at + PAIRS]
            part = part[root[group[part]] != root[group[i]]]
            mine, shared = _codes_in_both(np.broadcast_to(codes[i], (len(part), codes.shape[1])), codes[part])
            maybe = _viable(mine).any(axis=1) & _close(mine, shared)
            part, shared = part[maybe], shared[maybe]
            for j, other in zip(part.tolist(), _masked(codes[part], shared)):
                if root[group[j]] != root[group[i]]:
                    if (k := other.tobytes()) not in answers:
                        answers[k] = alike(codes[i], np.where((other > 0) & (other < _PLACES), other + _PLACES, other))
                    if answers[k]:
                        tie(group[i], group[j])
    return found


def _codes_in_both(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of codes, pair by pair -> which codes of a row its partner has too."""
    both = np.concatenate((a, b), axis=1)
    width, place = a.shape[1], np.arange(both.shape[1])
    order = np.argsort(both, axis=1, kind="stable")  # of equal codes those of a come first
    ranked = np.take_along_axis(both, order, axis=1)
    new = np.ones((len(a), both.shape[1] + 1), bool)
    new[:, 1:-1] = ranked[:, 1:] != ranked[:, :-1]
    first = np.maximum.accumulate(np.where(new[:, :-1], place, 0), axis=1)
    last = np.minimum.accumulate(np.where(new[:, 1:], place, len(place))[:, ::-1], axis=1)[:, ::-1]
    shared = (np.take_along_axis(order, first, axis=1) < width) & (np.take_along_axis(order, last, axis=1) >= width) & (ranked >= _PLACES)
    out = np.empty(both.shape, bool)
    np.put_along_axis(out, order, shared, axis=1)
    return out[:, :width], out[:, width:]


def joined_pairs(codes: np.ndarray, labels: np.ndarray, pairs: np.ndarray, root: Callable[[int], int], tie: Callable[[int, int], None]) -> None:
    """Pairs of surroundings, those of many cells together: tie(labels) where they are near, unless root has them joined already."""
    for at in range(0, len(pairs), PAIRS):
        i, j = pairs[at : at + PAIRS].T
        a, b = codes[i], codes[j]
        sure = _dense((a == b) & (a >= _PLACES), (2 * LIKENESS[0], sum(LIKENESS)), 0).any(axis=1)
        for x, y in zip(labels[i[sure]].tolist(), labels[j[sure]].tolist()):
            tie(x, y)
        open_ = np.flatnonzero(~sure & np.array([root(x) != root(y) for x, y in zip(labels[i].tolist(), labels[j].tolist())], bool))
        a, b, x, y = a[open_], b[open_], labels[i[open_]], labels[j[open_]]
        for _ in range(3):  # what is common only outside the places that can be in a passage does not count
            in_a, in_b = (_viable(c) for c in _codes_in_both(a, b))
            maybe = in_a.any(axis=1) & in_b.any(axis=1) & _close(in_a, in_b)
            in_a, in_b, a, b, x, y = (c[maybe] for c in (in_a, in_b, a, b, x, y))
            a, b = _within(a, in_a), _within(b, in_b)
        for one, other, k, m in zip(x.tolist(), y.tolist(), a, b):
            if root(one) != root(other) and alike(k, np.where((m > 0) & (m < _PLACES), m + _PLACES, m)):
                tie(one, other)


def _within(codes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Codes from each row's first place to its last, 0 beyond."""
    inside = np.maximum.accumulate(places, axis=1) & np.maximum.accumulate(places[:, ::-1], axis=1)[:, ::-1]
    return np.where(inside, codes, 0)


def _texts_in_parts(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, slice]]:
    """A batch(id, text, ...) in parts of about SPLIT bytes or one text: (ids, words in a row, bounds, which rows)."""
    ids, at, held, size = np.asarray(b[0], np.int64), 0, [], 0
    for i in range(b.num_rows):
        held.append(b[1][i].as_py())
        size += len(held[-1] or b"")
        if size >= SPLIT or i + 1 == b.num_rows:
            yield ids[at : i + 1], *word_hashes(held), slice(at, i + 1)
            at, held, size = i + 1, [], 0


def _each(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """df, its texts in parts -> the columns that work(ids, words, bounds, batch, rows) gives for every part."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.set_column(1, "text", b[1].cast(pa.binary()))
            for ids, words, bounds, rows in _texts_in_parts(b):
                with np.errstate(over="ignore"):
                    yield pa.record_batch([pa.array(c) for c in work(ids, words, bounds, b, rows)], names)

    return df.mapInArrow(run, schema)


def _cell_keys(ids: np.ndarray, words: np.ndarray, bounds: np.ndarray, *_: object) -> tuple[np.ndarray, ...]:
    keys, centres = cells(words, bounds)
    owner = np.searchsorted(bounds, centres, "right") - 1
    return ids[owner], keys.view(np.int64)


def _cell_places(ids: np.ndarray, words: np.ndarray, bounds: np.ndarray, shared: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, ...]:
    keys, centres = cells(words, bounds)
    if shared is not None:
        values, high = shared
        own = np.flatnonzero(high[keys >> _HIGH])  # few of the others get past their high bits
        own = own[values[np.minimum(np.searchsorted(values, keys[own]), len(values) - 1)] == keys[own]] if len(own) else own
        keys, centres = keys[own], centres[own]
    owner = np.searchsorted(bounds, centres, "right") - 1
    return ids[owner], keys.view(np.int64), centres - bounds[owner], about(words, bounds[owner], bounds[owner + 1], centres).view(np.int64)


#: What is shifted off a value for a table of its high bits (16 MB).
_HIGH = np.uint64(40)


def shared_cells(texts: DataFrame, most: int = BROADCAST_VALUES) -> DataFrame:
    """texts(id, text) -> (id, key, at, words) of the cells that several texts have: its hash, its place, a hash of the words about it."""
    one_each = _each(texts, _cell_keys, "id long, key long")
    several = cut(one_each.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("key"))
    schema = "id long, key long, at long, words long"
    if several.count() <= most:
        values = np.sort(np.asarray(several.toArrow()["key"], np.int64).view(np.uint64))
        high = np.zeros(1 << 64 - int(_HIGH), bool)
        high[values >> _HIGH] = True
        sent = texts.sparkSession.sparkContext.broadcast((values, high))
        return kept(_each(texts, lambda i, w, b, *_: _cell_places(i, w, b, sent.value), schema), "shared-cells")
    return kept(_each(texts, lambda i, w, b, *_: _cell_places(i, w, b, None), schema).join(several, "key", "left_semi"), "shared-cells")


def _tied(keyed: DataFrame, key: list[str]) -> DataFrame:
    """keyed(key, id) -> (src, dst): every id to the smallest of its key."""
    least = keyed.groupBy(*key).agg(F.min("id").alias("dst"), F.max("id").alias("last")).where("dst <> last").drop("last")
    return keyed.join(small_or_shuffled(least), key).where("id <> dst").select(F.col("id").alias("src"), "dst").distinct()


def _apart(keyed: DataFrame) -> DataFrame:
    """The rows of keyed(key, label, ...) whose key several labels have."""
    several = keyed.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("key")
    return keyed.join(small_or_shuffled(several), "key", "left_semi")


def _looked_up(texts: DataFrame, places: DataFrame) -> DataFrame:
    """places(id, key, at) -> (key, id, around): the words about each place. Few ids are broadcast to spare the other texts the way."""
    gathered = cut(places.groupBy("id").agg(F.collect_set(F.struct("at", "key")).alias("places")))
    ids = small_or_shuffled(gathered.select("id"))

    def work(texts_ids: np.ndarray, words: np.ndarray, bounds: np.ndarray, b: pa.RecordBatch, rows: slice) -> tuple:
        keys, owners, arounds = [], [], []
        for i, listed in enumerate(b[2].slice(rows.start, rows.stop - rows.start).to_pylist()):
            around = surroundings(words[bounds[i] : bounds[i + 1]], [p["at"] for p in listed])
            keys += [p["key"] for p in listed]
            owners += [int(texts_ids[i])] * len(listed)
            arounds += [a.tobytes() for a in around]
        return np.array(keys, np.int64), np.array(owners, np.int64), pa.array(arounds, pa.binary())

    found = texts.join(ids, "id", "left_semi").join(gathered, "id").select("id", "text", "places")
    return _each(found, work, "key long, id long, around binary")


def _codes(arounds: list[bytes]) -> np.ndarray:
    """Surroundings as words, or as codes already, -> codes."""
    rows = np.frombuffer(b"".join(arounds), np.uint64).reshape(len(arounds), -1)
    with np.errstate(over="ignore"):
        return shingle_codes(rows) if rows.shape[1] == 2 * REACH + SHINGLE else rows


def _dealt(rows: DataFrame) -> DataFrame:
    """rows(key, chunk, label, around) -> the same with home, the smallest label of the key, and spread, which deals the cells of a home to tasks."""
    homes = small_or_shuffled(rows.groupBy("key").agg(F.min("label").alias("home"), F.count(F.lit(1)).alias("n")))
    tasks = small_or_shuffled(homes.groupBy("home").agg(F.ceil(F.sum("n") / SPREAD).alias("tasks")).where("tasks > 1"))
    return rows.join(homes, "key").join(tasks, "home", "left").withColumn("spread", F.when(F.col("n") > SPREAD // 8, F.xxhash64("key", "chunk")).otherwise(F.pmod(F.xxhash64("key", "chunk"), F.coalesce("tasks", F.lit(1)))))


def _compared(rows: DataFrame) -> DataFrame:
    """rows(key, chunk, label, around) -> (src, dst): labels with near-duplicate surroundings of one key and chunk.

    Cells with the same smallest label meet in the same task, or in one for every SPREAD of their rows, where labels
    that one cell has joined are not compared for the next. A cell of more than an eighth of that is dealt by itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots: dict[int, int] = {}
        found: list[tuple[int, int]] = []
        at, rows, small, pairs = None, {}, [], []

        def root(x: int) -> int:
            while (up := roots.get(x, x)) != x:
                roots[x] = roots.get(up, up)
                x = up
            return x

        def tie(x: int, y: int) -> None:
            x, y = root(x), root(y)
            if x != y:
                roots[max(x, y)] = min(x, y)
                found.append((max(x, y), min(x, y)))

        def together() -> None:
            """The cells of few surroundings so far."""
            if pairs:
                with np.errstate(over="ignore"):
                    joined_pairs(_codes([a for _, a in small]), np.array([x for x, _ in small], np.int64), np.array(pairs, np.int64), root, tie)
            small.clear()
            pairs.clear()

        def one_cell() -> None:
            now = list(dict.fromkeys((root(x), a) for x, a in rows))
            if len({x for x, _ in now}) < 2:
                return
            if len(now) <= TOGETHER_ROWS:
                first = len(small)
                small.extend(now)
                pairs.extend((first + i, first + j) for j in range(len(now)) for i in range(j) if now[i][0] != now[j][0])
                if len(pairs) >= 4096:
                    together()
                return
            together()
            with np.errstate(over="ignore"):
                for x, y in joined(_codes([a for _, a in now]), np.array([root(x) for x, _ in now], np.int64)):
                    tie(x, y)

        def out() -> pa.RecordBatch:
            columns = [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)]
            found.clear()
            return pa.record_batch(columns, ["src", "dst"])

        for b in batches:
            for *k, label, around in zip(*(c.to_pylist() for c in b.columns)):
                if k != at:
                    one_cell()
                    at, rows = k, {}
                rows[label, around] = None
            yield out()
        one_cell()
        together()
        yield out()

    return _dealt(rows).repartition("home", "spread").sortWithinPartitions("home", "key", "chunk").select("key", "chunk", "label", "around").mapInArrow(run, "src long, dst long").distinct()


def _peeled(rows: DataFrame, most: int = BROADCAST_VALUES) -> DataFrame:
    """rows(key, label, around) of crowded keys -> the same as codes, without what only one label of a key has: see peeled, by a count over all machines."""
    rows = kept(rows.select("key", "label", "around").distinct().select("*", F.monotonically_increasing_id().alias("row")), "crowded")

    def marks(key: np.ndarray, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed(codes + _mixed(key.view(np.uint64) * _B2)[:, None]).view(np.int64)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                codes = _codes(part["around"].to_pylist())
                n, place = codes.shape[1], np.broadcast_to(np.arange(codes.shape[1]), codes.shape)[codes > 0]
                which = np.repeat(np.arange(len(codes)), n).reshape(codes.shape)[codes > 0]
                yield pa.record_batch([pa.array(np.asarray(part["row"])[which]), pa.array(place), pa.array(marks(np.asarray(part["key"], np.int64), codes)[codes > 0]), pa.array(np.asarray(part["label"])[which])], ["row", "place", "mark", "label"])

    def reduced(batches: Iterator[pa.RecordBatch], chosen: Callable) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                codes = _codes(part["around"].to_pylist())
                common = _viable(chosen(part, codes) & (codes > 0))
                alive = common.any(axis=1)
                masked = _masked(codes[alive], common[alive])
                yield pa.record_batch([part["key"].filter(pa.array(alive)), part["label"].filter(pa.array(alive)), pa.array([m.tobytes() for m in masked], pa.binary())], ["key", "label", "around"])

    every = rows.mapInArrow(listed, "row long, place long, mark long, label long")
    several = cut(every.groupBy("mark").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("mark"))
    if several.count() <= most:
        sent = rows.sparkSession.sparkContext.broadcast(np.sort(np.asarray(several.toArrow()["mark"], np.int64)))

        def known(part: pa.RecordBatch, codes: np.ndarray) -> np.ndarray:
            found = marks(np.asarray(part["key"], np.int64), codes)
            return sent.value[np.minimum(np.searchsorted(sent.value, found), len(sent.value) - 1)] == found if len(sent.value) else np.zeros(codes.shape, bool)

        out = rows.mapInArrow(lambda batches: reduced(batches, known), "key long, label long, around binary")
    else:

        def placed(part: pa.RecordBatch, codes: np.ndarray) -> np.ndarray:
            common = np.zeros(codes.shape, bool)
            for i, places in enumerate(part["places"].to_pylist()):
                common[i, places] = True
            return common

        places = every.join(several, "mark", "left_semi").groupBy("row").agg(F.collect_list("place").alias("places"))
        out = rows.join(places, "row").mapInArrow(lambda batches: reduced(batches, placed), "key long, label long, around binary")
    return kept(out.distinct(), "crowded-in-common")


def _grid(rows: DataFrame) -> DataFrame:
    """rows(key, label, around) -> the same with chunk, so that any two rows of a key meet in one chunk: a pair of parts of about CHUNK rows."""
    sizes = small_or_shuffled(rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts"), F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("key", "parts"))
    own = F.pmod(F.xxhash64("around", "label"), F.col("parts"))
    pair = lambda other: F.least("own", other) * F.col("parts") + F.greatest("own", other)
    return rows.join(sizes, "key").withColumn("own", own).select("key", "label", "around", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), pair)).alias("chunk"))


def linked_texts(texts: DataFrame, local: int = LOCAL, values: int = BROADCAST_VALUES) -> DataFrame:
    """texts(id, text) -> (node, component) of the texts that share a passage with another."""
    places = shared_cells(texts, values)
    groups = cut(connected_components(_tied(places, ["key", "words"])))
    known = small_or_shuffled(groups.select(F.col("node").alias("id"), "component"))
    labelled = lambda rows: rows.join(known, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
    rest = cut(_apart(labelled(places.select("id", "key", "at"))).select("id", "key", "at"))
    around = kept(labelled(_looked_up(texts, rest)).select("key", "label", "around"), "surroundings")
    sizes = small_or_shuffled(around.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > local).select("key"))
    ties = _compared(around.join(sizes, "key", "left_anti").withColumn("chunk", F.lit(0)))
    if not sizes.isEmpty():
        ties = cut(ties).unionAll(_compared(_grid(_peeled(around.join(sizes, "key", "left_semi"), values))))
    before = groups.where("node <> component").select(F.col("node").alias("src"), F.col("component").alias("dst"))
    return connected_components(before.unionAll(ties))


def _without_copies(texts: DataFrame, folded: DataFrame, ids: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """texts of the ids of folded alone. Beyond most ids of copies the filter takes a shuffle; as the result is read several times, it is then kept as a table."""
    gone = cut(ids.join(folded, "id", "left_anti"))
    if gone.count() <= most:
        return texts.join(F.broadcast(gone), "id", "left_anti")
    return kept(texts.join(gone, "id", "left_anti"), "different-texts")


def shared_passages(documents: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_words, repeated) of every row: class_id is the smallest id that shared passages reach, repeated whether another row is in the class.

    Every row gets a number of its own beside its id, under which it is searched. Rows of equal words are folded first,
    under the smallest number, by a digest of the words in two lanes.
    """

    def digest(ids: np.ndarray, words: np.ndarray, bounds: np.ndarray, b: pa.RecordBatch, rows: slice) -> tuple:
        lanes = [[xxhash.xxh64_intdigest(words[i:j].tobytes(), seed) - (1 << 63) for i, j in pairwise(bounds)] for seed in (1, 2)]
        return ids, b[2].slice(rows.start, len(ids)), *lanes, np.diff(bounds)

    plain = kept(documents.select(F.monotonically_increasing_id().alias("id"), F.col(text).alias("text"), F.col(id_col).alias("doc_id")), "numbered-texts")
    rows = cut(_each(plain, digest, f"id long, doc_id {plain.schema['doc_id'].dataType.simpleString()}, d1 long, d2 long, n_words long"))
    folded = cut(rows.groupBy("d1", "d2").agg(F.min("id").alias("id"), F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("copies"), F.max("n_words").alias("n")))
    connected = linked_texts(_without_copies(plain.select("id", "text"), folded.select("id"), rows.select("id")))
    classes = folded.join(connected.withColumnRenamed("node", "id"), "id", "left")
    least = classes.where("component IS NOT NULL").groupBy("component").agg(F.min("own").alias("least"))
    linked = F.col("component").isNotNull()
    named = classes.join(least, "component", "left").select("d1", "d2", F.when(linked, F.col("least")).otherwise(F.col("own")).alias("class_id"), ((F.col("n") >= PASSAGE) & ((F.col("copies") > 1) | linked)).alias("repeated"))
    return rows.join(named, ["d1", "d2"]).select("doc_id", "class_id", "n_words", "repeated")
