"""Connected components of an undirected graph, by alternating star joins; maximum spanning forests, by rounds of components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.storage import cut, joined_to_facts, swept

#: Edges up to this many (8 MB) are joined in one task, which spares small graphs the rounds.
FEW_EDGES = 500_000
#: At most so many nodes have their smallest neighbour broadcast: those with the most edges.
CENTRES = 100_000
#: Rounds halve the depth of what is left, so this many suffice for any graph that fits a cluster.
MOST_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def _large_star(edges: DataFrame, heavy: int) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = _both_ways(edges)
    least = cut(both.groupBy("src").agg(F.min("dst").alias("m"), F.count(F.lit(1)).alias("n")).select("src", F.least("src", "m").alias("m"), "n"))
    return joined_to_facts(both.where("dst > src"), least, "src", "n", heavy).select(F.col("dst").alias("src"), F.col("m").alias("dst"))


def _small_star(edges: DataFrame, heavy: int) -> DataFrame:
    """A node (src > dst) and all its smaller neighbours are tied to the smallest of them."""
    least = cut(edges.groupBy("src").agg(F.min("dst").alias("m"), F.count(F.lit(1)).alias("n")))
    moved = joined_to_facts(edges, least, "src", "n", heavy).where("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return moved.unionByName(least.select("src", F.col("m").alias("dst")))


def _in_one_task(edges: DataFrame) -> DataFrame:
    """The same for few edges: the label of either end takes the smaller label until none changes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        ends = np.concatenate([np.stack([np.asarray(c, np.int64) for c in b.columns]) for b in held], axis=1)
        nodes, at = np.unique(ends, return_inverse=True)
        a, b = at.reshape(2, -1)
        label = np.arange(len(nodes))
        while True:
            before, least = label.copy(), np.minimum(label[a], label[b])
            for own in (label[a], label[b]):
                np.minimum.at(label, own, least)
            while not np.array_equal(up := label[label], label):
                label = up
            if np.array_equal(before, label):
                break
        yield pa.record_batch([pa.array(nodes), pa.array(nodes[label])], ["node", "component"])

    return edges.select("src", "dst").coalesce(1).mapInArrow(run, "node long, component long")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", few_edges: int = FEW_EDGES) -> DataFrame:
    """edges -> (node, component), for the nodes that have an edge; component is the smallest node reachable.

    Large-star and small-star steps alternate until the edges are stars around the smallest nodes; minima are
    aggregated before they are joined back, and those of nodes with very many neighbours are broadcast, so that no task gets all their edges.
    Each round is kept in the checkpoint folder, its edges sorted out without duplicates. Edges with a null end, and
    loops from a node to itself (which then only names itself), carry no link. No edges: an empty result. Nodes are longs.
    """
    pairs = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL")
    state = cut(pairs.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    if (count := state.count()) <= few_edges:
        return _in_one_task(state)
    heavy = max(1000, 2 * count // CENTRES)
    seen = None
    for _ in range(MOST_ROUNDS):
        state = cut(_small_star(cut(_large_star(state, heavy)), heavy).distinct())
        swept(edges.sparkSession)
        now = state.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")), F.lit(0))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle within {MOST_ROUNDS} rounds")
    nodes = state.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return nodes.unionByName(state.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())


def _strongest_forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Positions of the edges a-b of the maximum spanning forest; among equal weights the smaller (a, b) goes first."""
    _, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    first, second = at.reshape(2, -1)
    parent, taken = list(range(int(at.max()) + 1 if len(at) else 0)), []
    for e in np.lexsort((b, a, -weight)).tolist():
        x, y = int(first[e]), int(second[e])
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[x] = y
            taken.append(e)
    return np.array(taken, np.int64)


def _forests(edges: DataFrame, most: int) -> DataFrame:
    """Each task's edges without those that its own edges make needless; it holds twice most at a time. What a part does not need, the whole does not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def taken() -> list[np.ndarray]:
            whole = [np.concatenate(x) for x in zip(*held)]
            own = _strongest_forest(*whole)
            return [w[own] for w in whole]

        for b in batches:
            held.append([np.asarray(c) for c in b.columns])
            size += b.num_rows
            if size > 2 * most:
                held = [taken()]
                size = len(held[0][0])
                if size > most:  # a forest that large goes on as it is
                    yield pa.record_batch([pa.array(h) for h in held[0]], ["src", "dst", "weight"])
                    held, size = [], 0
        if held:
            yield pa.record_batch([pa.array(h) for h in taken()], ["src", "dst", "weight"])

    return edges.mapInArrow(run, "src long, dst long, weight double")


def spanning_forest(edges: DataFrame, weight: str = "similarity", few_edges: int = FEW_EDGES) -> DataFrame:
    """edges(src, dst, weight) -> (src, dst, weight), src < dst: the maximum spanning forest, n - 1 edges for a component of n nodes.

    Its edges at or above any weight connect what all edges at or above it connect. Equal weights are ordered by (src,
    dst), so the forest is one and the same in any order of rows. Tasks first drop what their own edges make needless;
    what is left beyond few_edges is joined in rounds: every component takes its strongest edge to another, components
    are found over what was taken, and of the edges between two of them the strongest is kept.
    """
    ends = edges.where(f"src IS NOT NULL AND dst IS NOT NULL AND src <> dst AND `{weight}` IS NOT NULL").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), F.col(weight).cast("double").alias("weight"))
    state = cut(_forests(ends, few_edges))
    if state.count() > few_edges and (tasks := state.rdd.getNumPartitions()) > 1:  # what several tasks have left is mostly the same to and fro
        state = cut(_forests(state.coalesce(-(-tasks // 8)), few_edges))
    found = []
    labels = None
    while state.count() > few_edges:
        one = state if labels is not None else state.withColumns({"a": F.col("src"), "b": F.col("dst")})
        both = one.select("a", "src", "dst", "weight").unionAll(one.select(F.col("b").alias("a"), "src", "dst", "weight"))
        best = F.max_by(F.struct("src", "dst", "weight"), F.struct("weight", -F.col("src"), -F.col("dst"))).alias("e")
        taken = cut(both.groupBy("a").agg(best).select("e.*").distinct())
        found.append(taken)
        labels = cut(connected_components(found[0] if len(found) == 1 else cut(reduce(DataFrame.unionAll, found))))
        name = lambda rows, node, out: rows.join(labels.select(F.col("node").alias(node), F.col("component").alias(out)), node, "left").withColumn(out, F.coalesce(out, node))
        moved = name(name(state.select("src", "dst", "weight"), "src", "x"), "dst", "y").where("x <> y").select("src", "dst", "weight", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        state = cut(moved.groupBy("a", "b").agg(best).select("a", "b", "e.*"))
        del one, both, moved
        swept(edges.sparkSession)
    last = state if labels is not None else state.withColumns({"a": F.col("src"), "b": F.col("dst")})
    return reduce(DataFrame.unionAll, [*found, _kept_between(last)]).withColumnRenamed("weight", weight)


def _kept_between(state: DataFrame) -> DataFrame:
    """The forest's edges among few edges (a, b, src, dst, weight) between components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches([b.cast(schema) for b in batches], schema)
        a, b, src, dst, weight = (np.asarray(held[c]) for c in ("a", "b", "src", "dst", "weight"))
        order = np.lexsort((dst, src, -weight))
        place = np.empty(len(order))
        place[order] = np.arange(len(order))
        taken = _strongest_forest(a, b, -place)  # the order of the weights and ends of the edges themselves
        yield pa.record_batch([pa.array(src[taken]), pa.array(dst[taken]), pa.array(weight[taken])], ["src", "dst", "weight"])

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("src", pa.int64()), ("dst", pa.int64()), ("weight", pa.float64())])
    return state.select("a", "b", "src", "dst", "weight").coalesce(1).mapInArrow(run, "src long, dst long, weight double")
