"""Blended vector similarity: safe normalisation, and all pairs at or above a threshold, pruned by distances to pivots."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.contracts import checked
from pulsegrid.functions.storage import cut, joined_to_facts, kept

CONTENT_WEIGHT, CATEGORY_WEIGHT = 0.7, 0.3
THRESHOLD = 0.76
#: Vectors of one block, and bytes of them; a task multiplies two blocks at a time.
BLOCK, BLOCK_BYTES = 4096, 4_000_000
#: Bytes of blocks in one partition: a task of the join holds one while another passes by.
PARTITION_BYTES = 100_000_000
#: Rows of one block that are multiplied, and their pairs handed on, at once.
ROWS = 512
#: Pivots at most: they are broadcast, and known to the driver one by one.
PIVOTS = 4096
#: Visits handed on at once.
VISITS = 8192
#: What rounding may add to a distance.
SLACK = 1e-6


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once; a plain use inside a lambda would compute it again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def normalized(vector: Column) -> Column:
    """The vector over its length. It is scaled by its largest element first, so neither squares overflow nor tiny ones vanish.

    Empty vectors, zeros, NaN and infinities fail the query.
    """

    def scaled(s: Column) -> Column:
        fine = (F.size(s["v"]) > 0) & (s["m"] > 0) & (s["m"] < float("inf")) & ~F.exists(s["v"], lambda x: F.isnan(x) | x.isNull())
        return checked(F.transform(s["v"], lambda x: x / s["m"]), fine, "an embedding is empty, zero or not finite")

    def over_length(a: Column) -> Column:
        length = F.sqrt(F.aggregate(a, F.lit(0.0), lambda t, x: t + x * x))
        return _let(F.struct(a.alias("v"), length.alias("n")), lambda s: F.transform(s["v"], lambda x: x / s["n"]))

    largest = F.array_max(F.transform(vector, F.abs))
    return _let(_let(F.struct(vector.alias("v"), largest.alias("m")), scaled), over_length)


def blended(vectors: DataFrame) -> DataFrame:
    """vectors(page_id, content, category) -> (page_id, v): one unit vector whose products are the weighted sum of both cosines."""
    part = lambda c, w: F.transform(normalized(F.col(c)), lambda x: x * F.lit(w**0.5))
    return vectors.select("page_id", F.concat(part("content", CONTENT_WEIGHT), part("category", CATEGORY_WEIGHT)).alias("v"))


def _cell_sizes(rows: DataFrame, most: int, *more: Column) -> dict[int, tuple]:
    """cell -> (rows, ...): one row for each pivot, of which there are most at most."""
    return {r[0]: tuple(r[1:]) for r in rows.groupBy("cell").agg(F.count(F.lit(1)), *more).limit(most).collect()}


def _placed(units: DataFrame, pivots: np.ndarray) -> DataFrame:
    """units with the cell of the nearest pivot and the distance to it."""
    shared = units.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                far = _distances(_matrix(b["v"], b.num_rows), shared.value)
                cell = far.argmin(axis=1)
                yield pa.record_batch([b["page_id"], b["v"], pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(cell)), cell])], ["page_id", "v", "cell", "away"])

    return units.select("page_id", "v").mapInArrow(run, "page_id long, v array<double>, cell int, away double")


def _visits(placed: DataFrame, pivots: np.ndarray, reach: np.ndarray) -> DataFrame:
    """(page_id, v, cell) of the later cells in which something may lie within the vector's reach: what has to be compared beyond a vector's own cell."""
    shared = placed.sparkSession.sparkContext.broadcast((pivots, reach))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, most = shared.value
        for b in batches:
            if b.num_rows:
                near = _distances(_matrix(b["v"], b.num_rows), centres) <= most
                near &= np.arange(len(centres)) > np.asarray(b["cell"])[:, None]
                row, cell = np.nonzero(near)
                for at in range(0, len(row), VISITS):
                    some = pa.array(row[at : at + VISITS])
                    yield pa.record_batch([b["page_id"].take(some), b["v"].take(some), pa.array(cell[at : at + VISITS].astype(np.int32))], ["page_id", "v", "cell"])

    return placed.select("page_id", "v", "cell").mapInArrow(run, "page_id long, v array<double>, cell int")


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(rows, -1)


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (v @ pivots.T)))


def _packed(placed: DataFrame, parts: dict[int, int], block: int) -> DataFrame:
    """placed in rows (block, cell, away, ids, v) of up to block vectors of one cell, away the farthest of them; kept as a table."""
    split = placed.sparkSession.createDataFrame(list(parts.items()), "cell int, parts int")  # a row for each pivot
    part = F.pmod(F.xxhash64("page_id"), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = placed.join(F.broadcast(split), "cell", "left").select("cell", part.alias("part"), "page_id", "v", "away")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def row() -> pa.RecordBatch:
            ids, v, away = (np.concatenate(x) for x in zip(*held))
            return pa.record_batch([pa.array([key[0]], pa.int32()), pa.array([away.max()]), pa.array([ids.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())], ["cell", "away", "ids", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            cell, own, ids, v, away = *(np.asarray(b[c]) for c in ("cell", "part", "page_id")), _matrix(b["v"], b.num_rows), np.asarray(b["away"])
            starts = np.flatnonzero(np.diff(cell, prepend=-1) | np.diff(own, prepend=-1))
            for i, upto in zip(starts.tolist(), [*starts[1:].tolist(), len(cell)]):
                if held and key != (cell[i], own[i]):
                    yield row()
                    held = []
                key = (cell[i], own[i])
                while i < upto:
                    to = min(upto, i + block - sum(len(h[0]) for h in held))
                    held.append((ids[i:to], v[i:to], away[i:to]))
                    i = to
                    if sum(len(h[0]) for h in held) == block:
                        yield row()
                        held = []
        if held:
            yield row()

    tasks = max(1, -(-sum(parts.values()) // 4))  # some four blocks each: Parquet's writer holds so many before it looks at their size
    packed = dealt.repartition(tasks, "cell", "part").sortWithinPartitions("cell", "part").mapInArrow(run, "cell int, away double, ids binary, v binary")
    return kept(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _reached(spark: SparkSession, pivots: np.ndarray, radius: np.ndarray, reach: float) -> DataFrame:
    """(cell, reached) for each pivot: the later cells that may hold something within reach of something in the cell."""
    shared = spark.sparkContext.broadcast((pivots, radius))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, wide = shared.value
        for b in batches:
            for i in np.asarray(b["id"]).tolist():
                near = _distances(centres[i : i + 1], centres)[0] <= wide[i] + wide + reach
                near[: i + 1] = False
                yield pa.record_batch([pa.array([i], pa.int32()), pa.array([np.flatnonzero(near).astype(np.int32)], pa.list_(pa.int32()))], ["cell", "reached"])

    return spark.range(len(pivots)).mapInArrow(run, "cell int, reached array<int>")


def unit_pairs(units: DataFrame, threshold: float, block: int = BLOCK, pivots: int | None = None) -> DataFrame:
    """(src, dst, similarity) of all pairs src < dst of unit vectors (page_id, v) whose product is the threshold or more (inclusive, to 1e-12).

    Each vector belongs to the cell of its nearest pivot (one in block vectors, PIVOTS at most, drawn by hash). Products
    of the threshold or more are distances of sqrt(2 - 2 threshold) or less, so two cells have to meet only if their
    radii and this distance together reach from pivot to pivot, and of two cells that meet only the vectors that reach
    into the other one: what triangles rule out is not multiplied. A cell is kept in blocks of block vectors at most,
    each once; a task of the join reads one partition of them and holds another, so nothing is copied for the pairs it
    is in. The pairs are not kept: a caller who looks at them twice keeps them.
    """
    spark = units.sparkSession
    units = units.select("page_id", "v")
    n = units.count()
    most = pivots or min(PIVOTS, max(1, -(-n // block)))
    drawn = units.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(most)
    chosen = units.join(F.broadcast(drawn), "page_id", "left_semi").select("v").limit(most).collect()  # at most PIVOTS vectors
    if not chosen:
        return spark.createDataFrame([], "src long, dst long, similarity double")
    centres = np.array([r["v"] for r in chosen])
    width = 8 * centres.shape[1]
    block = max(1, min(block, BLOCK_BYTES // width))
    placed = _placed(units, centres)
    blocks = _packed(placed, {c: -(-x[0] // block) for c, x in _cell_sizes(placed, len(centres)).items()}, block)
    radius = np.full(len(centres), -np.inf)
    for c, (_, away) in _cell_sizes(blocks, len(centres), F.max("away")).items():  # as packed: a tie between pivots may have gone either way
        radius[c] = away
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    shared = spark.sparkContext.broadcast((centres, radius + reach))
    some = blocks.coalesce(max(math.isqrt(4 * spark.sparkContext.defaultParallelism) + 1, -(-n * width // PARTITION_BYTES)))  # a task for each two of these
    names = ["cell", "block", "ids", "v"]
    first = some.select(*names).join(F.broadcast(_reached(spark, centres, radius, reach)), "cell")
    second = some.select(*(F.col(c).alias(f"{c}2") for c in names))
    meet = ((F.col("cell") == F.col("cell2")) & (F.col("block") <= F.col("block2"))) | ((F.col("cell") < F.col("cell2")) & F.array_contains("reached", F.col("cell2")))
    tasks = first.hint("shuffle_replicate_nl").join(second, meet).select(*names, *(f"{c}2" for c in names))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, upto = shared.value

        def within(ids: pa.Scalar, v: pa.Scalar, other: int | None) -> tuple[np.ndarray, np.ndarray]:
            own = np.frombuffer(ids.as_buffer(), np.int64)
            held = np.frombuffer(v.as_buffer(), np.float64).reshape(len(own), -1)
            if other is None:
                return own, held
            near = _distances(held, pivot[other : other + 1])[:, 0] <= upto[other]
            return own[near], held[near]

        for b in batches:
            for i in range(b.num_rows):
                cell, cell2 = b["cell"][i].as_py(), b["cell2"][i].as_py()
                same = b["block"][i].as_py() == b["block2"][i].as_py()
                left, v = within(b["ids"][i], b["v"][i], None if cell == cell2 else cell2)
                right, w = within(b["ids2"][i], b["v2"][i], None if cell == cell2 else cell)
                for at in range(0, len(left), ROWS):
                    product = np.clip(v[at : at + ROWS] @ w.T, -1, 1)
                    a, c = np.nonzero(product >= threshold - 1e-12)
                    one, two, s = left[at : at + ROWS][a], right[c], product[a, c]
                    if same:
                        once = one < two
                        one, two, s = one[once], two[once], s[once]
                    if len(s):
                        yield pa.record_batch([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), pa.array(s)], ["src", "dst", "similarity"])

    return tasks.mapInArrow(products, "src long, dst long, similarity double")


def similarity_edges(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, pivots: int | None = None) -> DataFrame:
    """(src, dst, similarity) of all pairs src < dst at or above the threshold (inclusive, to 1e-12)."""
    return unit_pairs(blended(vectors), threshold, block, pivots)


def similarity_links(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, pivots: int | None = None) -> DataFrame:
    """Edges that connect what similarity_edges connects, and at every stricter threshold too, without all pairs of equal vectors.

    Equal vectors are one: n of them give the n - 1 edges of a star, and only their smallest page meets the others. The
    product of a vector with its equal is 1.
    """
    units = blended(vectors)
    folded = cut(units.groupBy("v").agg(F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("many")))
    pairs = unit_pairs(folded.select("page_id", "v"), threshold, block, pivots)
    several = folded.where("many > 1").select(F.col("page_id").alias("src"), "v", "many")
    stars = joined_to_facts(units, several, "v", "many").where("page_id <> src").select("src", F.col("page_id").alias("dst"), F.lit(1.0).alias("similarity"))
    return pairs.unionAll(stars) if threshold - 1e-12 <= 1.0 else pairs


def cohesion(members: DataFrame, vectors: DataFrame) -> DataFrame:
    """members(cluster, page_id) -> (cluster, size, cohesion): the mean similarity of all pairs, null for one page.

    The sum over all pairs of unit vectors is (|sum|^2 - n) / 2, so no pair is made.
    """
    each = members.join(blended(vectors), "page_id").select("cluster", F.posexplode("v").alias("at", "x"))
    sums = each.groupBy("cluster", "at").agg(F.sum("x").alias("s"))
    squares = sums.groupBy("cluster").agg(F.sum(F.col("s") * F.col("s")).alias("q"))
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    n = F.col("size")
    return sizes.join(squares, "cluster", "left").select("cluster", "size", F.when(n > 1, (F.col("q") - n) / (n * (n - 1))).alias("cohesion"))
