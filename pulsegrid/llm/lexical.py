"""Ranked lexical search: a two-level quantised index, and the k best documents of every query, exactly.

score(query, document) = sum over the query's distinct terms of w * ((10^9 tf) div (1000 tf + 8 m)), in integers, where
w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 10 + (90 n N) div L. The quotient is below 10^6 and is called impact.

The index has a row for every document, with two levels:

- `impacts`, one byte for each term: the impact in steps of STEP, rounded upward. A weighted sum of bytes bounds the
  score from above, and, as an impact is less than one step below its byte, from below;
- `tfs` and `n`, from which the exact score follows. Only documents whose upper bound reaches the k-th best lower bound
  of the query have this level read.

Bounds are taken for a block of documents and a group of queries at once, as one product of matrices, next to where
the documents lie: the queries are the stated set, the documents stay and are never paired with them as rows. A task
keeps the k best lower bounds it has met for each query, hands on what reaches them, and the k-th best of all tasks
then decides what is rescored. No document that could be among the k best is left out, whatever the ties: they are
broken by doc_id, after the exact scores.

Queries come in blocks of at most QUERIES queries and TERMS words, each with its own pass, its words broadcast; a
single longer query is a block of its own. An index holds the words of its block: no other posting can be asked for.

Defined results: null texts have no terms and count for nothing; a query without terms has no rows; rows with one
doc_id are documents of their own, a null doc_id comes last in ties; each row of the queries is ranked by itself;
empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.storage import kept, small_or_shuffled
from pulsegrid.llm.decontaminate import WORD_BYTES, words

K = 10
#: A byte stands for so many units of impact: 245 steps reach 10^6.
STEP = 1 << 12
QUERIES, TERMS = 1024, 200_000
#: Bytes of a text split at once.
PART = 1 << 20
#: Queries of one product, and cells of its matrix of documents and terms (eight bytes each).
GROUP, CELLS = 128, 2_000_000


class Block:
    """A block of queries: the number of each of its terms, and the terms of each query."""

    def __init__(self):
        self.ids: list[str | None] = []
        self.number: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []

    def add(self, item: str | None, found: set[bytes]) -> None:
        self.ids.append(item)
        self.terms.append(np.array(sorted(self.number.setdefault(t, len(self.number)) for t in sorted(found)), np.int64))


def blocks(queries: DataFrame, id_col: str = "item_id", text: str = "text", most: int = QUERIES, terms: int = TERMS) -> Iterator[Block]:
    """The queries in blocks; one of their partitions at a time is held here."""
    block = Block()
    for item, told in queries.select(F.col(id_col), F.col(text)).where(F.col(text).isNotNull()).toLocalIterator():
        if not (found := set(words(told.encode()))):
            continue
        if block.ids and (len(block.ids) >= most or len(block.number) + len(found) > terms):
            yield block
            block = Block()
        block.add(item, found)
    if block.ids:
        yield block


def parts(told: bytes, size: int = PART) -> Iterator[list[bytes]]:
    """The words of a text in parts of about size bytes, which bounds memory for very long texts."""
    told = told.translate(WORD_BYTES)
    at = 0
    while at < len(told):
        end = told.find(b" ", at + size) if at + size < len(told) else len(told)
        end = len(told) if end < 0 else end
        yield told[at:end].split()
        at = end


def postings(documents: DataFrame, block: Block, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc, n, terms, tfs) of every document: its length, and which of the block's terms it holds how often. Kept as a table, so row stands for a document."""
    number = documents.sparkSession.sparkContext.broadcast(block.number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = number.value.get
        for b in batches:
            lengths, terms, tfs, ends = [], [], [], [0]
            for told in b[1].cast(pa.binary()):
                length, counted = 0, Counter()
                for found in parts(told.as_py() or b""):
                    length += len(found)
                    counted.update(map(get, found))
                del counted[None]
                lengths.append(length)
                counted = sorted(counted.items())
                terms.extend(t for t, _ in counted)
                tfs.extend(c for _, c in counted)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.record_batch([b[0], pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], ["doc", "n", "terms", "tfs"])

    kind = documents.schema[id_col].dataType.simpleString()
    told = documents.select(F.col(id_col).alias("doc"), F.col(text).cast("string").alias("text"))
    return kept(told.mapInArrow(run, f"doc {kind}, n long, terms array<int>, tfs array<long>").withColumn("row", F.monotonically_increasing_id()), "postings")


class Statistics:
    """What the scores take from all documents: how many there are with terms, all their terms, and the weights of the block's."""

    def __init__(self, counted: DataFrame, block: Block):
        self.documents, self.length = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        frequency = np.zeros(len(block.number), object)
        for term, many in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # one row for each term of the block
            frequency[term] = many
        self.weights = np.array([floor(1000 * log((2 * self.documents + 2) / (2 * df + 1))) for df in frequency], np.int64)

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """m of each n, in integers of any size."""
        values, at = np.unique(n, return_inverse=True)
        return np.array([10 + 90 * int(v) * self.documents // max(1, self.length) for v in values], np.int64)[at]


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _lists(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column without nulls, and how many each row has."""
    return np.asarray(column.flatten()).astype(kind, copy=False), np.diff(np.asarray(column.offsets))


def quantised(counted: DataFrame, stats: Statistics) -> DataFrame:
    """The index: postings with their impacts as upward-rounded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (tf, many), n = _lists(b[4], np.int64), np.asarray(b[2])
            levels = (impact(tf, np.repeat(stats.lengths(n), many)) + STEP - 1) // STEP
            ends = np.concatenate(([0], np.cumsum(many))).astype(np.int32)
            bytes_ = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(levels.astype(np.uint8))])
            yield pa.record_batch([*b.columns, bytes_], [*b.schema.names, "impacts"])

    kind = counted.schema["doc"].dataType.simpleString()
    return kept(counted.select("row", "doc", "n", "terms", "tfs").mapInArrow(run, f"row long, doc {kind}, n long, terms array<int>, tfs array<long>, impacts binary"), "impacts")


def candidates(index: DataFrame, block: Block, stats: Statistics, k: int = K, group: int = GROUP, cells: int = CELLS) -> DataFrame:
    """(query, row, upper, lower): documents that may be among a query's k best; all that may are there. Kept as a table."""
    shared = index.sparkSession.sparkContext.broadcast((block.terms, stats.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights = shared.value
        groups = []
        for first in range(0, len(terms), group):
            own = np.unique(np.concatenate(terms[first : first + group]))
            weighted = np.zeros((len(own), len(terms[first : first + group])))
            for q, t in enumerate(terms[first : first + group]):
                weighted[np.searchsorted(own, t), q] = weights[t]
            groups.append((first, own, weighted, np.full((weighted.shape[1], k), 0.0)))  # the k best lower bounds so far
        for b in batches:
            (term, many), rows = _lists(b[1], np.int64), np.asarray(b[0])
            ends, level = np.concatenate(([0], np.cumsum(many))), np.frombuffer(b"".join(b[2].to_pylist()), np.uint8)
            for first, own, weighted, best in groups:
                at = np.minimum(np.searchsorted(own, term), len(own) - 1)
                asked = own[at] == term
                step = max(1, cells // len(own))
                for low, high in pairwise([*range(0, len(rows), step), len(rows)]):
                    part = slice(ends[low], ends[high])
                    here = asked[part]
                    held = np.zeros((high - low, len(own)))
                    held[np.repeat(np.arange(high - low), many[low:high])[here], at[part][here]] = level[part][here]
                    upper = held @ weighted * STEP  # whole numbers below 2^53: exact
                    lower = upper - np.minimum(held, 1) @ weighted * (STEP - 1)
                    best[:] = np.partition(np.concatenate((best, lower.T), axis=1), -k, axis=1)[:, -k:]
                    doc, query = np.nonzero((upper > 0) & (upper >= best.min(axis=1)))
                    yield pa.record_batch([pa.array((query + first).astype(np.int32)), pa.array(rows[low:high][doc]), pa.array(upper[doc, query].astype(np.int64)), pa.array(lower[doc, query].astype(np.int64))], ["query", "row", "upper", "lower"])

    return kept(index.select("row", "terms", "impacts").mapInArrow(run, "query int, row long, upper long, lower long"), "candidates")


def rescored(index: DataFrame, near: DataFrame, block: Block, stats: Statistics, k: int = K) -> DataFrame:
    """(query, doc, score) by the exact formula, for every document whose upper bound reaches the k-th best lower bound of all."""
    best = near.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("lower")))).where(F.col("place") <= k)
    reach = best.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("lower")).otherwise(0).alias("reach"))  # a row for each query of the block
    chosen = small_or_shuffled(near.join(F.broadcast(reach), "query").where("upper >= reach").select("query", "row"))
    shared = index.sparkSession.sparkContext.broadcast((block.terms, stats.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights = shared.value
        for b in batches:
            m, scores = stats.lengths(np.asarray(b[2])), []
            for query, own, tf, length in zip(b[0].to_pylist(), b[3], b[4], m):
                _, a, c = np.intersect1d(terms[query], np.asarray(own.values), assume_unique=True, return_indices=True)
                scores.append(int(weights[terms[query][a]] @ impact(np.asarray(tf.values).astype(np.int64)[c], length)))
            yield pa.record_batch([b[0], b[1], pa.array(scores, pa.int64())], ["query", "doc", "score"])

    kind = index.schema["doc"].dataType.simpleString()
    return chosen.join(index, "row").select("query", "doc", "n", "terms", "tfs").mapInArrow(run, f"query int, doc {kind}, score long").where("score > 0")


def search(documents: DataFrame, queries: DataFrame, k: int = K, doc_id: str = "doc_id", doc_text: str = "text", query_id: str = "item_id", query_text: str = "text", most: int = QUERIES, terms: int = TERMS) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of every row of queries, ranks from 1."""
    spark, found = documents.sparkSession, None
    out = f"{query_id} {queries.schema[query_id].dataType.simpleString()}, rank int, {doc_id} {documents.schema[doc_id].dataType.simpleString()}, score long"
    for block in blocks(queries, query_id, query_text, most, terms):
        counted = postings(documents, block, doc_id, doc_text)
        stats = Statistics(counted, block)
        index = quantised(counted, stats)
        scored = rescored(index, candidates(index, block, stats, k), block, stats, k)
        ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc")))).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"query int, item {queries.schema[query_id].dataType.simpleString()}")
        rows = ranked.join(F.broadcast(names), "query").select(F.col("item").alias(query_id), "rank", F.col("doc").alias(doc_id), "score")
        found = rows if found is None else kept(found.unionByName(rows), "ranked")
    return spark.createDataFrame([], out) if found is None else found


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(documents, benchmark)


#: The same ranking in DuckDB's SQL, over all postings.
ORACLE = r"""
WITH terms AS (
  SELECT d.rowid_ AS r, d.doc_id, unnest(regexp_extract_all(translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents WHERE text IS NOT NULL) d),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
dl AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
st AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM dl),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), st),
q AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark WHERE text IS NOT NULL)),
s AS (
  SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN dl USING (r), st GROUP BY ALL)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS place FROM s WHERE score > 0) WHERE place <= 10
"""
