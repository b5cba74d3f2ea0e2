"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, a scan of the documents' windows, verification, and removal.

Words are runs of digits, letters a-z (after lowering A-Z) and anything beyond ASCII. A benchmark item gives every
window of WINDOW consecutive words, or one window of all its words where it has fewer. A document word is hit if it
lies in any occurrence of a window. A window's polynomial hash only proposes; the words themselves decide.

The benchmark is read in blocks of about BLOCK_WORDS words, parts of an item if it is longer. Every block is broadcast
and scanned by a pass of its own, whose result is kept as a table before the next is sent: the driver holds two blocks
and an executor one, whatever the benchmark's size. One pass, and no table, where one block holds the benchmark.

Defined results: null texts have no words; items without an id or without words are ignored; all rows are kept and
answered for, also those with a null or repeated doc_id; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.storage import kept
from pulsegrid.llm.common import LOWER, UPPER

WINDOW = 10
BLOCK_WORDS = 1_000_000
#: ASCII bytes outside 0-9 and a-z separate words; A-Z are lowered first.
WORD_BYTES = bytes(x if x > 127 or 48 <= x <= 57 or 97 <= x <= 122 else x + 32 if 65 <= x <= 90 else 32 for x in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Windows:
    """The windows of a block of benchmark items: vocabulary, sorted hashes by length, and items by window."""

    def __init__(self, n: int = WINDOW):
        self.n, self.ids, self.items = n, {}, defaultdict(lambda: defaultdict(set))
        self.hashes: dict[int, np.ndarray] = {}

    def add(self, item: str, words: list[bytes]) -> None:
        ids = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
        length = min(self.n, len(ids))
        for at in range(len(ids) - length + 1):
            self.items[length][tuple(ids[at : at + length])].add(item)

    def close(self) -> Windows:
        self.items = {k: {w: tuple(i) for w, i in v.items()} for k, v in self.items.items()}
        for length, windows in self.items.items():
            flat = np.array(list(windows), np.uint64).reshape(-1, length)
            self.hashes[length] = np.unique(_rolling(flat.reshape(-1), np.arange(0, flat.size, length), length))
        return self

    def find(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """Which words are hit (None: none), and the items whose windows occur."""
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), np.int64, len(words))
        hit, found = None, set()
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        for length, hashes in self.hashes.items():
            if len(ids) < length:
                continue
            at = np.flatnonzero(known[length:] - known[:-length] == length)
            if not len(at):
                continue
            rolled = _rolling(ids.astype(np.uint64), at, length)
            near = np.searchsorted(hashes, rolled)
            at = at[hashes[np.minimum(near, len(hashes) - 1)] == rolled]
            for i in at.tolist():
                if items := self.items[length].get(tuple(ids[i : i + length].tolist())):
                    hit = np.zeros(len(ids), bool) if hit is None else hit
                    hit[i : i + length] = True
                    found.update(items)
        return hit, found


def _rolling(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.zeros(len(at), np.uint64)
        for j in range(length):
            out = out * _BASE + ids[at + j]
    return out


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def _blocks(benchmark: DataFrame, n: int, most: int) -> Iterator[Windows]:
    """The benchmark in blocks; one of its partitions at a time is held here."""
    block, size = Windows(n), 0
    for item, text in benchmark.select(F.col("item_id").cast("string"), F.col("text")).where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        found = words(text.encode())
        for at in range(0, max(1, len(found) - n + 1), most):  # a long item's windows go into several blocks
            part = found[at : at + most + n - 1]
            if size and size + len(part) > most:
                yield block.close()
                block, size = Windows(n), 0
            size += len(part)
            block.add(item, part)
    if size:
        yield block.close()


def _runs(hit: np.ndarray) -> list[list[int]]:
    """Maximal runs of hit words as [first, after last]."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return edges.reshape(-1, 2).tolist()


def scan(documents: DataFrame, benchmark: DataFrame, text: str = "text", n: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """documents with n_words, hit_runs (first word and the one after the last, for each run of hit words) and hit_items (sorted)."""
    out = documents.withColumns({"n_words": F.lit(None).cast("long"), "hit_runs": F.lit(None).cast("array<array<long>>"), "hit_items": F.lit(None).cast("array<string>")})
    at = documents.columns.index(text)
    blocks = _blocks(benchmark, n, block_words)
    block = next(blocks, None) or Windows(n).close()
    while block:
        sent = documents.sparkSession.sparkContext.broadcast((block.ids, block.items, block.hashes))
        block = next(blocks, None)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            windows = Windows(n)
            windows.ids, windows.items, windows.hashes = sent.value
            for b in batches:
                counts, runs, items = [], [], []
                for t, old_runs, old_items in zip(b[at].cast(pa.binary()).to_pylist(), b["hit_runs"].to_pylist(), b["hit_items"].to_pylist()):
                    found = words(t)
                    hit, names = windows.find(found)
                    for first, end in old_runs or ():
                        hit = np.zeros(len(found), bool) if hit is None else hit
                        hit[first:end] = True
                    counts.append(len(found))
                    runs.append([] if hit is None else _runs(hit))
                    items.append(sorted(names.union(old_items or ())))
                own = [pa.array(counts, pa.int64()), pa.array(runs, b.schema.field("hit_runs").type), pa.array(items, b.schema.field("hit_items").type)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-3], *own], schema=b.schema)

        out = out.mapInArrow(run, out.schema)
        if block:
            out = kept(out, "scanned")
            sent.destroy()
    return out


def _without(text: bytes, runs: list[list[int]]) -> bytes:
    """text without the hit runs, from the first byte of a run's first word to the last of its last."""
    marks = np.frombuffer(text.translate(WORD_BYTES), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0])))).reshape(-1, 2)
    kept, at = [], 0
    for first, end in runs:
        kept.append(text[at : edges[first, 0]])
        at = edges[end - 1, 1]
    return b"".join([*kept, text[at:]])


def remove(documents: DataFrame, benchmark: DataFrame, text: str = "text", spans: bool = False) -> DataFrame:
    """documents without the contaminated ones, or (spans) with the hit passages cut out of their texts. Same columns."""
    columns = documents.columns
    if not spans:
        return scan(documents, benchmark, text).where(F.size("hit_runs") == 0).select(*columns)
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cleaned = [_without(t, runs) if runs else t for t, runs in zip(b[at].cast(pa.binary()).to_pylist(), b["hit_runs"].to_pylist())]
            yield b.set_column(at, b.schema.field(at), pa.array(cleaned, pa.binary()).cast(b.schema.field(at).type))

    marked = scan(documents, benchmark, text)
    return marked.mapInArrow(run, marked.schema).select(*columns)


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row a document: counts of words and hit words, the items that occur, and whether any does."""
    found = scan(documents.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda a, r: a + r[1] - r[0])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.size("hit_runs") > 0).alias("contaminated"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _ahead(table: str, key: str) -> str:
    """Every word with the WINDOW - 1 after it."""
    return f"""SELECT row, {key}, pos, n, list(word) OVER (PARTITION BY row ORDER BY pos ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS ahead FROM (
    SELECT row, {key}, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (SELECT row_number() OVER () AS row, {key}, {_WORDS} AS w FROM {table}))"""


#: The report in DuckDB's SQL.
ORACLE = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, len({_WORDS}) AS n FROM documents),
d AS ({_ahead('documents', 'doc_id')}),
b AS ({_ahead('benchmark', 'item_id')}),
windows AS (SELECT DISTINCT item_id, least({WINDOW}, n) AS length, array_to_string(ahead[1:least({WINDOW}, n)], ' ') AS k FROM b WHERE pos + least({WINDOW}, n) - 1 <= n AND item_id IS NOT NULL),
lengths AS (SELECT DISTINCT length FROM windows),
keyed AS MATERIALIZED (SELECT doc_id, pos, length, array_to_string(ahead[1:length], ' ') AS k FROM d, lengths WHERE pos + length - 1 <= n),
hits AS (SELECT doc_id, pos, length, item_id FROM keyed JOIN windows USING (length, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + length)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT docs.doc_id, CAST(n AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
