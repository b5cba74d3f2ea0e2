"""MinHash near-duplicates: documents whose sets of word shingles have a Jaccard similarity of 0.8 or more, linked.

One permutation: the 64-bit hashes of a set, sorted, fall into BANDS * ROWS bins by their size, and each bin keeps its
smallest. An empty bin takes the value of the first filled one in a fixed random order of bins that is the bin's own
(optimal densification), so that two sets agree in a bin with the probability of their similarity. ROWS bins make a
band and a band's values a bucket; two sets of similarity 0.8 share a bucket with probability 1 - (1 - 0.8^7)^60,
which leaves out fewer than one pair in a million, and more similar ones far fewer.

Equal sets are folded to one node before any of this. Candidates are the edges of stars: every member of a bucket with
the bucket's smallest node. A star cannot see two members that are alike though their centre is like neither; the members
(but for the centre) of a bucket that still lie in different components are therefore indexed under the rarest fifth of
their shingles: two sets of similarity 0.8 share one of those, whatever the order, so a common passage brings no pairs
and no link of a bucket is lost.

Either kind of pairs is verified on the full sets in waves, each of which takes the likeliest pair of every node and leaves out
what the waves before have joined.

Confirmed edges become components by distributed star joins. Sets travel only for nodes that have an edge to verify.

Defined results: a null text has no words; a set of no shingles is linked with nothing, not even its like; fewer words
than a shingle's make one shingle of all; a row without doc_id links others like any row, gets the smallest id of its
component (null if there is none), and is kept only then; rows with one doc_id are separate texts of that id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.storage import cut, joined_to_facts, kept, small_or_shuffled
from pulsegrid.llm.common import FOLD_BYTES
from pulsegrid.operators.graph import connected_components

SHINGLE_WORDS = 5
BANDS, ROWS = 60, 7
#: Least Jaccard similarity, in hundredths.
SIMILAR = 80
#: Waves of one pair for each node before all pairs that are left are verified.
WAVES = 2
#: Longs of a set's parity.
PARITY = 8
#: Bytes of a text whose words are hashed at once.
PART = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def word_hashes(text: bytes, part: int = PART) -> np.ndarray:
    """A hash for each word, in order; A-Z are lowered first."""
    text, found, at = text.translate(FOLD_BYTES), [], 0
    while at < len(text):
        end = at + part
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        words = text[at:end].split()
        found.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_set(text: bytes | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct hashes of a text's shingles of k words, sorted."""
    words = word_hashes(text or b"")
    if not len(words):
        return words
    k = min(k, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(words) - k + 1, k, np.uint64)
        for i in range(k):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - k + 1 + i])
    return np.unique(out)


class Signatures:
    """One-permutation min-hashes of sorted sets, and their bands."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.edges = np.array([(b << 64) // self.bins for b in range(self.bins)], np.uint64)
        #: The bins that an empty bin looks at, in order, as far as most sets need them.
        self.order = np.stack([self._order(attempt, np.arange(self.bins)) for attempt in range(2 * self.bins)], axis=1)

    def _order(self, attempt: int, bins: np.ndarray) -> np.ndarray:
        """The bin that an empty bin looks at in an attempt: the same for every set, another for every bin and attempt."""
        return (mixed(bins.astype(np.uint64) << np.uint64(32) | np.uint64(attempt + 1)) % np.uint64(self.bins)).astype(np.int32)

    def values(self, hashes: np.ndarray) -> np.ndarray:
        first = np.searchsorted(hashes, self.edges)
        filled = first < np.append(first[1:], len(hashes))
        value = hashes[np.minimum(first, len(hashes) - 1)]
        left, attempt, wide = np.flatnonzero(~filled), 0, 8
        while len(left):
            if attempt < self.order.shape[1]:
                looked = self.order[left, attempt : attempt + wide]
            else:
                looked = np.stack([self._order(attempt + i, left) for i in range(wide)], axis=1)
            found = filled[looked]
            at = found.argmax(axis=1)
            hit = found[np.arange(len(left)), at]
            value[left[hit]] = value[looked[hit, at[hit]]]
            left, attempt, wide = left[~hit], attempt + looked.shape[1], 2 * wide
        return value

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """One key for each band, which also names the band."""
        value = self.values(hashes).reshape(self.bands, self.rows)
        key = np.arange(self.bands, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for r in range(self.rows):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + value[:, r])
        return key.view(np.int64)


def marks(text: Column) -> list[Column]:
    """Two hashes that together stand for a text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("text"), text).alias("t2")]


def signatures(documents: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(row, id, t1, t2, n, d1, d2, keys) of every row: marks of the text, size and 128-bit digest of its set, keys of its bands. Kept as a table, so row stands for a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signatures(bands, rows)
        for b in batches:
            sizes, digests, keys = [], [], [np.empty(0, np.int64)]
            for t in b[3].cast(pa.binary()):
                found = shingle_set(t.as_py(), k)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                if len(found):
                    keys.append(signer.keys(found))
            digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            ends = np.concatenate(([0], np.cumsum(np.array(sizes) > 0) * bands)).astype(np.int32)
            yield pa.record_batch([*b.columns[:3], pa.array(sizes, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))], ["id", "t1", "t2", "n", "d1", "d2", "keys"])

    kind = documents.schema[id_col].dataType.simpleString()
    told = documents.select(F.col(id_col).alias("id"), *marks(F.col(text)), F.col(text).cast("string").alias("text"))
    return kept(told.mapInArrow(run, f"id {kind}, t1 long, t2 long, n long, d1 long, d2 long, keys array<long>").withColumn("row", F.monotonically_increasing_id()), "signatures")


def folded(prints: DataFrame) -> DataFrame:
    """(node, least, rows, n, d1, d2, id, t1, t2, keys): a node for each different set, with one of the texts that have it."""
    one = F.min_by(F.struct("id", "t1", "t2", "keys"), "row").alias("one")
    sets = prints.where("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("node"), F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"), F.min("n").alias("n"), one)
    return kept(sets.select("node", "least", "rows", "n", "d1", "d2", "one.*"), "nodes")


def stars(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (src: a bucket's smallest node, dst: another member, shared: their buckets), and (key, node) of the buckets with more than two."""
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    buckets = cut(keyed.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("last"), F.count(F.lit(1)).alias("members")).where("members > 1"))
    larger = buckets.where("members > 2")
    inside = kept(joined_to_facts(keyed, small_or_shuffled(larger), "key", "members").where("node <> centre").select("key", "node", "centre"), "buckets")
    edges = buckets.where("members = 2").select(F.col("centre").alias("src"), F.col("last").alias("dst")).unionAll(inside.select(F.col("centre").alias("src"), F.col("node").alias("dst")))
    return cut(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("shared"))), inside


def parities(hashes: np.ndarray) -> np.ndarray:
    """PARITY longs whose bits say whether an even or odd number of hashes fall on them: two sets differ in no fewer hashes than their parities in bits."""
    odd = np.bincount((hashes % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def full_sets(documents: DataFrame, nodes: DataFrame, wanted: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """(node, hashes, parity) of the wanted nodes, from their texts. Kept as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size, at = [], 0, 0
            for i, t in enumerate(b[1].cast(pa.binary())):
                held.append(shingle_set(t.as_py(), k))
                size += len(held[-1])
                if size > PART or i + 1 == b.num_rows:
                    ends = np.concatenate(([0], np.cumsum([len(x) for x in held]))).astype(np.int32)
                    odd = np.concatenate([parities(x) for x in held])
                    yield pa.record_batch([b[0].slice(at, len(held)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held).view(np.int64))), pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1, dtype=np.int32) * PARITY), pa.array(odd))], ["node", "hashes", "parity"])
                    held, size, at = [], 0, i + 1

    of = small_or_shuffled(nodes.join(wanted, "node", "left_semi").select("node", F.col("id").alias("own"), F.col("t1").alias("m1"), F.col("t2").alias("m2")))
    told = documents.select(F.col(id_col).alias("id"), *marks(F.col(text)), F.col(text).cast("string").alias("text"))
    found = told.join(of, (F.col("t1") == F.col("m1")) & (F.col("t2") == F.col("m2")) & F.col("id").eqNullSafe(F.col("own"))).select("node", "text")
    return kept(found.mapInArrow(run, "node long, hashes array<long>, parity array<long>").dropDuplicates(["node"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs whose full sets are similar."""
    a, b = sets.select(F.col("node").alias("src"), F.col("hashes").alias("a")), sets.select(F.col("node").alias("dst"), F.col("hashes").alias("b"))
    both = pairs.join(a, "src").join(b, "dst").withColumn("common", F.size(F.array_intersect("a", "b")).cast("long"))
    return cut(both.where(100 * F.col("common") >= similar * (F.size("a") + F.size("b") - F.col("common"))).select("src", "dst"))


def _labelled(rows: DataFrame, node: str, labels: DataFrame, name: str) -> DataFrame:
    return rows.join(labels.select(F.col("node").alias(node), F.col("component").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))


def joined_up(pairs: DataFrame, sets: DataFrame, similar: int, sure: DataFrame | None = None, waves: int = WAVES) -> tuple[DataFrame, DataFrame]:
    """Confirmed edges with sure, and their (node, component), once pairs (src, dst, shared) are verified. A wave verifies the likeliest pair of every dst; pairs whose ends are joined by then need no verifying."""
    labels = None if sure is None else cut(connected_components(sure))
    for wave in range(waves + 1):
        if labels is not None:
            pairs = cut(_labelled(_labelled(pairs, "src", labels, "one"), "dst", labels, "other").where("one <> other").select("src", "dst", "shared"))
        chosen = pairs if wave == waves else cut(pairs.groupBy("dst").agg(F.max_by("src", F.struct("shared", "src")).alias("src")).select("src", "dst"))
        if chosen.isEmpty():
            break
        if wave < waves:
            pairs = pairs.join(chosen, ["src", "dst"], "left_anti")
        found = verified(chosen.select("src", "dst"), sets, similar)
        sure = found if sure is None else sure.unionAll(found)
        labels = cut(connected_components(sure))
    if labels is None:
        sure = pairs.select("src", "dst").limit(0)
        labels = cut(connected_components(sure))
    return sure, labels


def rare_shingle_pairs(opened: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """opened (node, label) -> pairs (src, dst, shared) of nodes of different labels, all that can be similar among them.

    A node's shingles are ordered by how many opened nodes have them, rarest first. Similar sets share one of the first
    n - ceil(n * similar / 100) + 1 of either, from that shingle on both have enough left for what they must share, and
    their parities differ in no more bits than the sets may in shingles.
    """
    rows = kept(opened.join(sets, "node").select("node", "label", F.size("hashes").cast("long").alias("n"), F.explode("hashes").alias("h")), "shingles")
    often = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("label").alias("one"), F.max("label").alias("other")).where("df > 1")
    shared = joined_to_facts(rows, cut(often), "h", "df")
    alone = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("node"))  # these come before all shared ones
    placed = shared.withColumn("place", alone + F.row_number().over(Window.partitionBy("node").orderBy("df", "h")))
    first = placed.where(f"place <= n - ceil(n * {similar} / 100.0) + 1 AND one <> other").select("h", "node", "label", "n", "place")
    first = joined_to_facts(first, cut(first.groupBy("h").agg(F.count(F.lit(1)).alias("many")).where("many > 1")), "h", "many").select("h", "node", "label", "n", "place")
    first = first.join(sets.select("node", *(F.col("parity")[i].alias(f"p{i}") for i in range(PARITY))), "node")
    a, b = (first.select("h", *(F.col(c).alias(f"{x}_{c}") for c in first.columns if c != "h")) for x in "ab")
    must = F.ceil((F.col("a_n") + F.col("b_n")) * similar / (100.0 + similar))
    can = 1 + F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    apart = sum((F.bit_count(F.col(f"a_p{i}").bitwiseXOR(F.col(f"b_p{i}"))) for i in range(PARITY)), F.lit(0))
    return a.join(b, "h").where("a_node < b_node AND a_label <> b_label").where((can >= must) & (apart <= F.col("a_n") + F.col("b_n") - 2 * must)).select(F.col("a_node").alias("src"), F.col("b_node").alias("dst")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("shared"))


def links(documents: DataFrame, nodes: DataFrame, id_col: str, text: str, k: int, similar: int) -> DataFrame:
    """(node, component) of the nodes that are linked with another."""
    edges, inside = stars(nodes)
    sets = full_sets(documents, nodes, edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct(), id_col, text, k)
    sure, labels = joined_up(edges, sets, similar)
    members = cut(_labelled(inside.select("key", "node"), "node", labels, "label"))
    split = cut(members.groupBy("key").agg(F.min("label").alias("one"), F.max("label").alias("other"), F.count(F.lit(1)).alias("members")).where("one <> other").select("key", "members"))
    opened = joined_to_facts(members, split, "key", "members").select("node", "label").distinct()
    return joined_up(cut(rare_shingle_pairs(opened, sets, similar)), sets, similar, sure)[1]


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS, similar: int = SIMILAR, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, t1, t2, n, component, kept) of every row: marks of its text, size of its set, smallest id that links reach, and whether it is that. Ids are longs.

    bands and rows stand for a similarity of 0.8; a smaller one asks for more bands of fewer rows.
    """
    prints = signatures(documents, id_col, text, k, bands, rows)
    nodes = folded(prints)
    found = links(documents, nodes, id_col, text, k, similar)
    placed = nodes.select("node", "least", "rows", "d1", "d2").join(found, "node", "left")
    names = placed.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("name"))
    named = cut(placed.join(names, "component", "left").select("d1", "d2", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("name")).alias("component"), "rows"))
    told = prints.select("id", "t1", "t2", "n", "d1", "d2")
    linked = joined_to_facts(told.where("n > 0"), named, ["d1", "d2"], "rows").select("id", "t1", "t2", "n", "component")
    every = linked.unionAll(told.where("n = 0").select("id", "t1", "t2", "n", F.col("id").alias("component")))
    return every.withColumn("kept", F.col("id").eqNullSafe(F.col("component")))


def keep_one(documents: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS, similar: int = SIMILAR) -> DataFrame:
    """documents without the rows whose component has a smaller id, and without rows of no id that are linked with one."""
    gone = small_or_shuffled(near_duplicates(documents, id_col, text, k, similar).where("NOT kept").select(F.col("id").alias("gone"), F.col("t1").alias("m1"), F.col("t2").alias("m2")).distinct())
    t1, t2 = marks(F.col(text))
    return documents.join(gone, F.col(id_col).eqNullSafe(gone["gone"]) & (t1 == gone["m1"]) & (t2 == gone["m2"]), "left_anti")


def report(documents: DataFrame) -> DataFrame:
    found = near_duplicates(documents, k=2)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")
