"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a Hamming distance of 3 or less.

Candidates come from pigeonhole blocks. The 64 bits fall into 6 blocks; 3 differing bits touch 3 of them at most, so
a linked pair agrees in 3 whole blocks, and each of the 20 choices of 3 makes one key of about 32 bits. Keys that
more than HOT fingerprints share (many near-copies of one text) are not compared pair by pair: their members get
560 keys that leave out 3 of 16 nibbles instead. Such a key fixes 52 bits, so at most 4,096 different fingerprints
can share it, however many documents there are, and the same pigeonhole argument keeps every link.

Equal fingerprints are folded to one before any join, links leave a bucket as a spanning forest, and components are
found by distributed star joins. Nothing about single documents reaches the driver.

Defined results: a null text counts as empty; a text without words has fingerprint zero, linked like any other; one
or two words make one shingle; a row without doc_id keeps its fingerprint, gives no name to a component, links others like
any row, and gets the smallest id of its component (null if that has none); rows with one doc_id are separate texts of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.storage import cut, joined_to_facts, small_or_shuffled
from pulsegrid.llm.common import FOLD_BYTES
from pulsegrid.operators.graph import connected_components

SHINGLE_WORDS = 3
#: The seed that Spark's own xxhash64 uses.
HASH_SEED = 42
DISTANCE = 3
BLOCKS = (11, 11, 11, 11, 10, 10)
#: More fingerprints than this on one key go to the finer keys.
HOT = 1024
FINE = [tuple(x for x in range(16) if x not in wild) for wild in combinations(range(16), DISTANCE)]
#: Shingles hashed at once, which bounds memory for very long texts.
CHUNK = 1 << 16


def _shingles(words: list[bytes], k: int) -> Iterator[list[bytes]]:
    """The word shingles of a text, space-joined, in chunks; all words where there are fewer than k."""
    if len(words) <= k:
        yield [b" ".join(words)] if words else []
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    ends = ends[k - 1 :].tolist()
    for at in range(0, len(starts), CHUNK):
        yield [joined[a:b] for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])]


def fingerprint(text: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint: a bit is 1 if it is set in over half of the shingles' hashes, repeats included."""
    total, ones = 0, np.zeros(64, np.int64)
    for shingles in _shingles((text or b"").translate(FOLD_BYTES).split(), k):
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), "<u8", len(shingles))
        total += len(shingles)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0]) if total else 0


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """(id, mark, fp) of every row: mark a hash of the text, which tells rows of one id apart, fp a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b[0], b[1], pa.array([fingerprint(t, k) for t in b[2].cast(pa.binary()).to_pylist()], pa.int64())], ["id", "mark", "fp"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(F.col(id_col).alias("id"), marked(F.col(text)).alias("mark"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, mark long, fp long")


def marked(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _coarse_keys(fp: Column) -> Column:
    """The 20 keys of three blocks each, as longs that also name the choice."""
    at, blocks = 0, []
    for width in BLOCKS:
        blocks.append(F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1).cast("long")))
        at += width
    keys = []
    for n, chosen in enumerate(combinations(range(len(BLOCKS)), len(BLOCKS) - DISTANCE)):
        key = F.lit(n).cast("long")
        for i in chosen:
            key = F.shiftleft(key, BLOCKS[i]).bitwiseOR(blocks[i])
        keys.append(key)
    return F.array(*keys)


def _fine_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 560 keys of 13 nibbles each, for fingerprints whose coarse keys are too common."""
    for b in batches:
        fp, rep = np.asarray(b[0], np.int64).view(np.uint64), np.asarray(b[1], np.int64)
        nibbles = [fp >> np.uint64(4 * i) & np.uint64(15) for i in range(16)]
        for n, kept in enumerate(FINE):
            key = np.full(len(fp), n, np.uint64)
            for i in kept:
                key = key << np.uint64(4) | nibbles[i]
            yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(rep)], ["key", "fp", "rep"])


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """label, the smallest index that each item reaches so far, with the links a-b added."""
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _linked(keys: np.ndarray, fps: np.ndarray, reps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in key order -> a spanning forest, as pairs of rep, of the links inside runs of one key.

    Links between rows that are joined already are left out as they are found, so memory follows the rows, not the links.
    """
    label, firsts, seconds, held = np.arange(len(keys)), [], [], 0
    fps, lag, at = fps.view(np.uint64), 1, np.arange(len(keys))
    while len(at := at[at < len(keys) - lag]) and len(at := at[keys[at] == keys[at + lag]]):
        near = at[np.bitwise_count(fps[at] ^ fps[at + lag]) <= distance]
        near = near[label[near] != label[near + lag]]
        firsts.append(near)
        seconds.append(near + lag)
        held += len(near)
        lag += 1
        if held > len(keys):
            label, firsts, seconds, held = _joined(label, np.concatenate(firsts), np.concatenate(seconds)), [], [], 0
    if held:
        label = _joined(label, np.concatenate(firsts), np.concatenate(seconds))
    tied = np.flatnonzero(label != np.arange(len(keys)))
    return reps[tied], reps[label[tied]]


def links(keyed: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """keyed(key, fp, rep) -> (src, dst): links that connect whatever fingerprints within the distance share a key. Buckets are bounded by the caller."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        for b in batches:
            held = [np.concatenate((h, np.asarray(c, np.int64))) for h, c in zip(held, b.columns)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last key may go on in the next batch
            src, dst = _linked(*(h[:whole] for h in held), distance)
            held = [h[whole:] for h in held]
            yield pa.record_batch([pa.array(src), pa.array(dst)], ["src", "dst"])
        src, dst = _linked(*held, distance)
        yield pa.record_batch([pa.array(src), pa.array(dst)], ["src", "dst"])

    return keyed.select("key", "fp", "rep").repartition("key").sortWithinPartitions("key").mapInArrow(run, "src long, dst long")


def fingerprint_links(reps: DataFrame, hot: int = HOT) -> DataFrame:
    """reps(fp, rep), fp distinct -> (src, dst) over rep, connecting exactly what links of DISTANCE bits connect."""
    keyed = reps.withColumn("key", F.explode(_coarse_keys(F.col("fp"))))
    common = cut(keyed.groupBy("key").count().where(F.col("count") > hot).select("key"))
    if common.isEmpty():
        return links(keyed)
    common = small_or_shuffled(common)
    fine = keyed.join(common, "key", "left_semi").groupBy("fp", "rep").agg(F.lit(1).alias("one")).select("fp", "rep")
    return links(keyed.join(common, "key", "left_anti")).unionAll(links(fine.mapInArrow(_fine_keys, "key long, fp long, rep long")))


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS, hot: int = HOT) -> DataFrame:
    """(id, mark, fp, component) of every row; component is the smallest id that links reach, also those through rows without id. Ids are longs.

    The graph is one of fingerprints; which id a component has is looked up afterwards.
    """
    prints = cut(fingerprints(documents, id_col, text, k))
    reps = cut(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")))
    found = cut(connected_components(fingerprint_links(reps.select("fp", F.col("fp").alias("rep")), hot)))
    placed = reps.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    names = placed.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("name"))
    named = cut(placed.join(names, "component", "left").select("fp", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("name")).alias("component"), "rows"))
    return joined_to_facts(prints, named, "fp", "rows").select("id", "mark", "fp", "component")


def near_duplicate_report(documents: DataFrame) -> DataFrame:
    found = near_duplicates(documents)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one(documents: DataFrame) -> DataFrame:
    """documents without the rows whose component has a smaller doc_id. Rows without doc_id, and all rows of the kept id in the component, stay.

    Rows of one doc_id with different texts are told apart by a hash of the text.
    """
    gone = small_or_shuffled(near_duplicates(documents).where("id <> component").select(F.col("id").alias("gone"), "mark"))
    return documents.join(gone, (documents["doc_id"] == gone["gone"]) & (marked(documents["text"]) == gone["mark"]), "left_anti")
