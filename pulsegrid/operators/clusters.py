"""Preliminary clusters: components of the similarity graph, cut to a size that a model can read, ranked and capped."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError
from pulsegrid.functions.ordering import best, placed
from pulsegrid.functions.storage import cut
from pulsegrid.operators.graph import connected_components, spanning_forest
from pulsegrid.operators.similarity import THRESHOLD, cohesion

MAX_INPUT, PROMPT, STEP = 16_384, 2_048, 0.02
#: Parts with more edges than this are split by distributed rounds; the others each in one task.
LOCAL_EDGES = 200_000
REVIEW_CAP = 10


def component_members(pages: DataFrame, edges: DataFrame) -> DataFrame:
    """(page_id, component): every page, alone where it has no edge; component is the smallest page id."""
    found = connected_components(edges)
    return pages.select("page_id").join(found.withColumnRenamed("node", "page_id"), "page_id", "left").select("page_id", F.coalesce("component", "page_id").alias("component"))


def reviewable(members: DataFrame) -> DataFrame:
    """members without components of one page."""
    several = members.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component")
    return members.join(several, "component", "left_semi").select("page_id", "component")


def record_bytes() -> Column:
    """UTF-8 bytes of a page's record in compact JSON."""
    return F.octet_length(F.to_json(F.struct("page_id", "canonical_title", "lead", "selected_categories"), {"ignoreNullFields": "false"}))


def token_estimate(members: DataFrame, pages: DataFrame, prompt: int = PROMPT, cluster: str = "component") -> DataFrame:
    """(cluster, n, tokens): prompt, brackets, records and the commas between them."""
    sized = members.join(pages.select("page_id", record_bytes().alias("bytes")), "page_id")
    return sized.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), (F.sum("bytes") + F.count(F.lit(1)) - 1 + 2 + prompt).alias("tokens"))


def pack(ids: list[int], sizes: list[int], most: int, prompt: int = PROMPT) -> list[list[int]]:
    """Consecutive groups that each fit, as long as they can be."""
    groups: list[list[int]] = []
    used = most + 1
    for i, size in zip(ids, sizes):
        if groups and used + size + 1 <= most:
            groups[-1].append(i)
            used += size + 1
        else:
            groups.append([i])
            used = prompt + 2 + size
    return groups


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while True:
        before, least = label.copy(), np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if np.array_equal(before, label):
            return label


def split_part(ids: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: np.ndarray, threshold: float, most: int, prompt: int, step: float) -> list[tuple[list[int], float | None]]:
    """One component (ids ascending, edges by position) -> its parts in order, each with the threshold it was cut at (None: whole)."""
    done: list[tuple[list[int], float | None]] = []
    work = [(np.arange(len(ids)), threshold, None)]
    while work:
        own, at, cut_at = work.pop()
        if prompt + 2 + int(sizes[own].sum()) + len(own) - 1 <= most:
            done.append((ids[own].tolist(), cut_at))
            continue
        if (too_large := own[prompt + 2 + sizes[own] > most]).size:
            raise ContractError(f"Canonical Page {ids[too_large[0]]} exceeds the model-input token guard")
        place = np.full(len(ids), -1)
        place[own] = np.arange(len(own))
        while True:
            at = min(1.0, at + step)
            inside = (place[a] >= 0) & (place[b] >= 0) & (similarity >= at)
            label = _roots(len(own), place[a[inside]], place[b[inside]])
            roots = np.unique(label)
            if len(roots) > 1 or at >= 1.0:
                break
        if len(roots) > 1:
            work += [(own[label == r], at, at) for r in roots[::-1]]
        else:
            done += [(g, 1.0) for g in pack(ids[own].tolist(), sizes[own].tolist(), most, prompt)]
    return done


def subdivide_components(members: DataFrame, edges: DataFrame, pages: DataFrame, threshold: float = THRESHOLD, most: int = MAX_INPUT, prompt: int = PROMPT, step: float = STEP, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """members(page_id, component) -> (page_id, component, cluster, subdivision_threshold): components that fit stay whole, the others are cut at ever stricter thresholds.

    cluster is the smallest page id of the part. What is connected at any threshold is so by the maximum spanning forest,
    so a part of n pages keeps n - 1 edges, also where all its pages are equal. Parts of very many edges are first cut by distributed rounds.
    """
    sized = members.join(pages.select("page_id", record_bytes().cast("long").alias("bytes")), "page_id")
    state = cut(sized.select("page_id", "component", "bytes", F.col("component").alias("part"), F.lit(float(threshold)).alias("at"), F.lit(None).cast("double").alias("subdivision_threshold")))
    inner = cut(spanning_forest(edges))
    while True:
        used = state.groupBy("part").agg((F.sum("bytes") + F.count(F.lit(1)) + 1 + prompt).alias("tokens"))
        large = used.where(F.col("tokens") > most).select("part")
        ends = state.select("page_id", "part", "at")
        own = inner.join(ends.select(F.col("page_id").alias("src"), F.col("part").alias("p"), "at"), "src").join(ends.select(F.col("page_id").alias("dst"), F.col("part").alias("q")), "dst").where("p = q")
        heavy = cut(own.groupBy(F.col("p").alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("at")).where((F.col("n") > local_edges) & (F.col("at") < 1.0)).join(large, "part", "left_semi"))
        if heavy.isEmpty():
            break
        stricter = own.join(heavy.select(F.col("part").alias("p")), "p", "left_semi").where(F.col("similarity") >= F.least(F.lit(1.0), F.col("at") + step))
        found = connected_components(stricter).withColumnRenamed("node", "page_id").withColumnRenamed("component", "root")
        moved = state.join(heavy.select("part", F.lit(True).alias("cut")), "part", "left").join(found, "page_id", "left")
        next_at = F.least(F.lit(1.0), F.col("at") + step)
        pieces = moved.withColumn("new", F.when(F.col("cut"), F.coalesce("root", "page_id")).otherwise(F.col("part")))
        state = cut(pieces.select("page_id", "component", "bytes", F.col("new").alias("part"), F.when(F.col("cut"), next_at).otherwise(F.col("at")).alias("at"), F.when(F.col("cut"), next_at).otherwise(F.col("subdivision_threshold")).alias("subdivision_threshold")))

    whole = state.join(large, "part", "left_anti").select("page_id", "component", F.col("part").alias("cluster"), "subdivision_threshold")
    rows = state.join(large, "part", "left_semi").select("part", "component", "page_id", "bytes", "at", F.lit(None).cast("long").alias("dst"), F.lit(None).cast("double").alias("similarity"))
    lines = own.join(large.withColumnRenamed("part", "p"), "p", "left_semi").select(F.col("p").alias("part"), F.lit(None).cast("long").alias("component"), F.col("src").alias("page_id"), F.lit(None).cast("long").alias("bytes"), F.col("at"), "dst", "similarity")

    def split(table: pa.Table) -> pa.Table:
        nodes = table.filter(table["dst"].is_null()).sort_by("page_id")
        links = table.filter(table["dst"].is_valid())
        ids, sizes = np.asarray(nodes["page_id"]), np.asarray(nodes["bytes"])
        a, b = np.searchsorted(ids, np.asarray(links["page_id"])), np.searchsorted(ids, np.asarray(links["dst"]))
        parts = split_part(ids, sizes, a, b, np.asarray(links["similarity"]), float(nodes["at"][0].as_py()), most, prompt, step)
        component = nodes["component"][0].as_py()
        flat = [(i, component, own[0], at) for own, at in parts for i in own]
        columns = list(zip(*flat))
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("page_id", "component", "cluster", "subdivision_threshold"), columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))})

    pieces = rows.unionByName(lines).groupBy("part").applyInArrow(split, "page_id long, component long, cluster long, subdivision_threshold double")
    return whole.unionByName(pieces)


def pack_members(members: DataFrame, pages: DataFrame, most: int = MAX_INPUT, prompt: int = PROMPT) -> DataFrame:
    """members(page_id, component) -> (page_id, component, pack): each component's pages in id order, packed greedily. A component is read by one task: greedy packing is sequential, and components are what one reader can hold."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("page_id")
        groups = pack(table["page_id"].to_pylist(), table["bytes"].to_pylist(), most, prompt)
        number = [n for n, g in enumerate(groups) for _ in g]
        return pa.table({"page_id": table["page_id"], "component": table["component"], "pack": pa.array(number, pa.int32())})

    sized = members.join(pages.select("page_id", record_bytes().cast("long").alias("bytes")), "page_id").select("component", "page_id", "bytes")
    return sized.groupBy("component").applyInArrow(run, "page_id long, component long, pack int")


def preliminary_clusters(parts: DataFrame, vectors: DataFrame) -> DataFrame:
    """parts(page_id, component, cluster, subdivision_threshold) -> a row for each cluster with its pages, size, cohesion and origin."""
    lists = parts.groupBy("cluster").agg(F.sort_array(F.collect_list("page_id")).alias("page_ids"), F.min("component").alias("component"), F.min("subdivision_threshold").alias("subdivision_threshold"))
    return lists.join(cohesion(parts.select("cluster", "page_id"), vectors), "cluster")


def rank_clusters(clusters: DataFrame, cap: int | None = None) -> DataFrame:
    """clusters with rank: cohesion (to 12 digits, so that the order of a sum does not matter) down, null last, size down, page ids up; only the first cap if one is given."""
    order = F.round("cohesion", 12).desc_nulls_last(), F.col("size").desc(), F.col("page_ids").asc()
    ranked = placed(clusters, *order) if cap is None else best(clusters, cap, *order)
    return ranked.withColumn("rank", F.col("rank").cast("int"))


def review_cap(ranked: DataFrame, cap: int | None = REVIEW_CAP) -> DataFrame:
    return ranked if cap is None else ranked.where(F.col("rank") <= cap)


def assign_ids(ranked: DataFrame, prefix: str = "preliminary-cluster-") -> DataFrame:
    return ranked.withColumn("cluster_id", F.format_string(f"{prefix}%04d", F.col("rank")))


def formation_counts(members: DataFrame, parts: DataFrame, clusters: DataFrame, cap: int | None = REVIEW_CAP) -> DataFrame:
    """One row of seven counts."""
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    a = sizes.agg(F.count(F.lit(1)).alias("components"), F.count_if(F.col("n") == 1).alias("singleton_components"))
    cut_up = parts.where("subdivision_threshold IS NOT NULL")
    b = cut_up.agg(F.countDistinct("component").alias("subdivided_components"), F.countDistinct("cluster").alias("subdivisions"))
    c = clusters.agg(F.count(F.lit(1)).alias("eligible_clusters"), F.count_if((F.col("size") == 1)).alias("singleton_subdivisions"))
    most = F.lit(cap) if cap is not None else F.col("eligible_clusters")
    joined = a.crossJoin(b).crossJoin(c)  # one row each
    return joined.withColumn("selected_clusters", F.least(most.cast("long"), F.col("eligible_clusters"))).withColumn("omitted_clusters", F.col("eligible_clusters") - F.col("selected_clusters"))
