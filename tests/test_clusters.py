"""Categories, similarity, components, subdivision and ranking on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError
from pulsegrid.functions.storage import cut, joined_to_facts
from pulsegrid.operators import categories, clusters, similarity
from pulsegrid.operators.graph import connected_components, spanning_forest

PAGES = "page_id long, canonical_title string, lead string, categories array<string>"


def vectors(spark, rows):
    return spark.createDataFrame(rows, "page_id long, content array<double>, category array<double>")


def selected(spark, ids, lead="lead"):
    return spark.createDataFrame([(i, f"Page {i}", lead, ["c"]) for i in ids], "page_id long, canonical_title string, lead string, selected_categories array<string>")


def formed(spark, rows, threshold, most=clusters.MAX_INPUT, prompt=clusters.PROMPT, step=clusters.STEP, **more):
    v = vectors(spark, rows)
    edges = similarity.similarity_edges(v, threshold).cache()
    members = clusters.component_members(v, edges)
    parts = clusters.subdivide_components(clusters.reviewable(members), edges, selected(spark, [r[0] for r in rows]), threshold, most, prompt, step, **more).cache()
    ranked = clusters.rank_clusters(clusters.preliminary_clusters(parts, v)).orderBy("rank").collect()
    return [(tuple(r["page_ids"]), None if r["cohesion"] is None else round(r["cohesion"], 9), r["subdivision_threshold"]) for r in ranked], members, parts


def test_categories_by_rarity(spark):
    rows = [(1, "One", "", ["Shared", "Rare Z", "Rare A", "1999 births", "Rare A", "Fifth", "Fourth", "Sixth"]), (2, "Two", "", ["Living people", "All articles needing work"]), (3, "Three", "", ["Shared", "Sparse only"])]
    out = {r["page_id"]: r["selected_categories"] for r in categories.select_categories(spark.createDataFrame(rows, PAGES)).collect()}
    assert out == {1: ["Fifth", "Fourth", "Rare A", "Rare Z", "Sixth"], 2: [], 3: ["Sparse only", "Shared"]}


def test_digits_of_any_script_are_digits(spark):
    found = spark.createDataFrame([("١٩٩٩ births",), ("199 births",)], "c string").select(categories.is_noise(F.col("c"))).collect()
    assert [r[0] for r in found] == [True, False]


def test_representations(spark):
    out = categories.representations(selected(spark, [1]).withColumn("selected_categories", F.array().cast("array<string>"))).first()
    assert (out["content_text"], out["category_text"]) == ("Title: Page 1\nLead: lead", "Selected Categories: (none)")


def test_threshold_is_inclusive_and_singletons_go(spark):
    unit = lambda i, n=6: [1.0 if j == i else 0.0 for j in range(n)]
    rows = [(i, unit(0), unit(0)) for i in (1, 2, 3)] + [(i, unit(1), unit(1)) for i in (4, 5)] + [(i, unit(2), unit(2)) for i in (6, 7)] + [(8, unit(3), unit(3)), (9, unit(4), unit(3)), (10, unit(5), unit(5))]
    found, members, parts = formed(spark, rows, 0.3)
    assert found == [((1, 2, 3), 1.0, None), ((4, 5), 1.0, None), ((6, 7), 1.0, None), ((8, 9), 0.3, None)]
    counts = clusters.formation_counts(members, parts, clusters.preliminary_clusters(parts, vectors(spark, rows)), 2).first()
    assert (counts["eligible_clusters"], counts["selected_clusters"], counts["omitted_clusters"], counts["singleton_components"]) == (4, 2, 2, 1)


@pytest.mark.parametrize("local_edges", [clusters.LOCAL_EDGES, 0])
def test_large_components_are_cut(spark, local_edges):
    near, far = [1.0, 0.0], [0.8, 0.6]
    rows = [(1, near, near), (2, near, near), (3, far, far), (4, far, far), (5, [0.0, -1.0], [0.0, -1.0]), (6, [0.0, -1.0], [0.0, -1.0])]
    found, _, parts = formed(spark, rows, 0.75, most=170, prompt=0, step=0.1, local_edges=local_edges)
    assert [(i, round(t, 9) if t else t) for i, _, t in found] == [((1, 2), 0.85), ((3, 4), 0.85), ((5, 6), None)]
    assert {r["page_id"]: r["component"] for r in parts.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5}


def test_subdivision_may_leave_one_page(spark):
    rows = [(1, [1.0, 0.0], [1.0, 0.0]), (2, [1.0, 0.0], [1.0, 0.0]), (3, [0.6, 0.8], [0.6, 0.8])]
    found, _, _ = formed(spark, rows, 0.5, most=170, prompt=0, step=0.2)
    assert found == [((1, 2), 1.0, 0.7), ((3,), None, 0.7)]


def test_equal_pages_are_packed(spark):
    rows = [(i, [1.0], [1.0]) for i in range(1, 6)]
    found, _, _ = formed(spark, rows, 0.9, most=170, prompt=0, step=0.05)
    assert sorted(i for i, _, t in found if t == 1.0) == [(1, 2), (3, 4), (5,)]


def test_one_page_too_large(spark):
    with pytest.raises(Exception, match="exceeds the model-input token guard"):
        formed(spark, [(1, [1.0], [1.0]), (2, [1.0], [1.0])], 0.9, most=20, prompt=0)


def test_many_equal_pages_in_blocks(spark):
    v = vectors(spark, [(i, [1.0, 2.0], [3.0, 4.0]) for i in range(257)])
    edges = similarity.similarity_edges(v, 0.9, block=40)
    assert edges.count() == 257 * 256 // 2
    assert similarity.cohesion(v.select(F.lit(0).alias("cluster"), "page_id"), v).first()["cohesion"] == pytest.approx(1)


@pytest.mark.parametrize("x", [1e308, 5e-324])
def test_extreme_vectors(spark, x):
    found, _, _ = formed(spark, [(1, [x, 0.0], [x, 0.0]), (2, [x, 0.0], [x, 0.0])], 0.9)
    assert found[0][1] == pytest.approx(1)


@pytest.mark.parametrize("bad", [[], [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0]])
def test_bad_vectors(spark, bad):
    with pytest.raises(Exception, match="embedding is empty, zero or not finite"):
        similarity.blended(vectors(spark, [(1, bad, [1.0])])).collect()


@pytest.mark.parametrize("few", [10_000, 0])
def test_components_of_chains_stars_and_loops(spark, few):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, j) for j in range(2, 40)] + [(500, 500), (7, 7), (None, 3), (900, 901)]
    out = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long"), few_edges=few).collect()}
    assert out == {i: 100 for i in range(100, 161)} | {j: 1 for j in range(1, 40)} | {900: 900, 901: 900}
    assert connected_components(spark.createDataFrame([], "src long, dst long"), few_edges=few).count() == 0


def test_components_with_a_centre_of_many_edges(spark):
    """Centres beyond the bound have their smallest neighbour broadcast."""
    edges = [(5000, j) for j in range(10_000, 11_500)] + [(j, j + 5000) for j in range(10_000, 10_100)] + [(3, 15_000), (4, 20_000)]
    out = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long"), few_edges=0).collect()}
    assert out == {3: 3, 4: 4, 20_000: 4, 5000: 3} | {j: 3 for j in range(10_000, 11_500)} | {j: 3 for j in range(15_000, 15_100)}


@pytest.mark.parametrize("heavy", [2, 100])
def test_facts_of_heavy_keys_are_broadcast(spark, heavy):
    rows = spark.createDataFrame([(i % 3 if i % 4 else None, i) for i in range(20)], "k long, v long")
    facts = rows.where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("m")).where("k > 0")
    out = joined_to_facts(rows, facts, "k", "n", heavy).select("k", "v", "n", "m").collect()
    wanted = [(i % 3, i) for i in range(20) if i % 4 and i % 3]
    assert sorted((r["k"], r["v"]) for r in out) == sorted(wanted) and all(r["n"] == sum(k == r["k"] for k, _ in wanted) for r in out)


def test_bytes_are_those_of_compact_json(spark):
    import json

    page = {"page_id": 5, "canonical_title": 'Tä"\t', "lead": "x\n😀", "selected_categories": ["ü", "\\"]}
    df = spark.createDataFrame([tuple(page.values())], "page_id long, canonical_title string, lead string, selected_categories array<string>")
    assert df.select(clusters.record_bytes()).first()[0] == len(json.dumps(page, ensure_ascii=False, separators=(",", ":")).encode())


def test_caps_and_ids():
    from pulsegrid.contracts import review_cap, safe_identifier

    assert (review_cap("all"), review_cap("3"), review_cap(7)) == (None, 3, 7)
    for bad in ("0", "-1", "x", True, "", 0):
        with pytest.raises(ContractError):
            review_cap(bad)
    assert safe_identifier("run-1", "run_id") == "run-1"
    for bad in ("", ".", "..", "a/b"):
        with pytest.raises(ContractError):
            safe_identifier(bad, "run_id")


def heaped(spark, seed, many, dims=6):
    """Vectors in narrow heaps, one of them much larger, with equal ones among them; and the similarity of all pairs."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    content = np.array([centres[0 if rng.random() < 0.4 else rng.integers(12)] + rng.normal(size=dims) * rng.choice((0, 0.05, 0.3)) for _ in range(many)])
    kind = np.eye(3)[rng.integers(3, size=many)]
    unit = content / np.linalg.norm(content, axis=1, keepdims=True)
    return vectors(spark, [(int(i), content[i].tolist(), kind[i].tolist()) for i in range(many)]), 0.7 * unit @ unit.T + 0.3 * kind @ kind.T


@pytest.mark.parametrize("bounds", [{}, {"block": 40}, {"block": 40, "pivots": 30}, {"pivots": 1}, {"block": 7, "pivots": 3}])
def test_pruned_pairs_are_all_pairs(spark, bounds):
    v, s = heaped(spark, 1, 300)
    for threshold in (0.5, 0.76, 0.95):
        found = {(r["src"], r["dst"]): r["similarity"] for r in similarity.similarity_edges(v, threshold, **bounds).collect()}
        must = {(i, j): s[i, j] for i in range(300) for j in range(i + 1, 300) if s[i, j] >= threshold - 1e-9}
        assert found.keys() == must.keys() and all(abs(found[k] - must[k]) < 1e-9 for k in must)


def test_far_cells_do_not_meet(spark):
    v, s = heaped(spark, 2, 300)
    units = similarity.blended(v)
    sent = []
    for threshold in (0.95, -1.0):
        centres = np.array([r["v"] for r in units.orderBy(F.xxhash64("page_id")).limit(30).collect()])
        placed = similarity._placed(units, centres)
        radius = similarity._cell_sizes(placed, 30, F.max("away"))
        reach = np.array([radius.get(i, (0, -np.inf))[1] for i in range(30)]) + np.sqrt(2 - 2 * threshold)
        sent.append(similarity._visits(placed, centres, reach).count())
    assert sent[0] < 0.4 * sent[1]


def test_links_of_equal_vectors(spark):
    rows = [(i, [1.0, 2.0], [1.0, 0.0]) for i in range(50, 0, -1)] + [(60, [1.0, 2.1], [1.0, 0.0]), (61, [1.0, 2.1], [1.0, 0.0]), (70, [-1.0, 0.0], [0.0, 1.0])]
    v = vectors(spark, rows)
    links = similarity.similarity_links(v, 0.9).collect()
    assert len(links) == 49 + 1 + 1
    found = connected_components(similarity.similarity_links(v, 0.9)).collect()
    assert {r["node"]: r["component"] for r in found} == {i: 1 for i in [*range(1, 51), 60, 61]}
    assert similarity.similarity_edges(vectors(spark, []), 0.9).count() == 0 and similarity.similarity_links(vectors(spark, []), 0.9).count() == 0


def strongest(edges):
    """Kruskal over (weight down, src, dst)."""
    parent, taken = {}, set()

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for w, a, b in sorted((-w, min(a, b), max(a, b)) for a, b, w in edges if a != b):
        if find(a) != find(b):
            parent[find(a)] = find(b)
            taken.add((a, b, -w))
    return taken


@pytest.mark.parametrize("few", [500_000, 20, 1])
def test_spanning_forest(spark, few):
    rng = np.random.default_rng(few)
    edges = [(int(a), int(b), float(w)) for a, b, w in zip(rng.integers(60, size=400), rng.integers(60, size=400) + 40 * (rng.random(400) < 0.2), rng.choice((0.5, 0.6, 0.7, 0.7, 1.0), 400))]
    df = spark.createDataFrame(edges, "src long, dst long, similarity double").repartition(5)
    found = [tuple(r) for r in spanning_forest(df, few_edges=few).collect()]
    assert set(found) == strongest(edges) and len(set(found)) == len(found)
    assert spanning_forest(df.limit(0), few_edges=few).count() == 0


def test_equal_pages_keep_few_edges(spark):
    v = vectors(spark, [(i, [1.0, 0.0], [1.0, 0.0]) for i in range(1, 61)])
    edges = similarity.similarity_edges(v, 0.9)
    assert edges.count() == 60 * 59 / 2 and spanning_forest(edges).count() == 59
    pages = selected(spark, range(1, 61))
    parts = [clusters.subdivide_components(clusters.component_members(v, e), e, pages, 0.9, 300, 0) for e in (edges, similarity.similarity_links(v, 0.9))]
    a, b = (sorted(tuple(r) for r in p.collect()) for p in parts)
    assert a == b and len({r[2] for r in a}) > 1 and {r[3] for r in a} == {1.0}


@pytest.mark.parametrize("block", [40, 300])
def test_vectors_are_kept_once(spark, monkeypatch, block):
    """However many pairs of blocks a vector is in; copies of it for each of them filled the disks."""
    from pulsegrid.functions import storage

    held = []
    for name in ("kept", "cut"):
        monkeypatch.setattr(similarity, name, lambda df, *a, f=getattr(storage, name): held.append(out := f(df, *a)) or out)
    v, s = heaped(spark, 3, 300)
    pairs = similarity.similarity_edges(v, 0.5, block=block)
    assert pairs.count() == (np.triu(s, 1) >= 0.5).sum()
    (table,) = held
    sizes = [len(r["ids"]) // 8 for r in table.collect()]
    assert sum(sizes) == 300 and max(sizes) <= block and len(sizes) >= -(-300 // block)


def test_forests_of_several_tasks_meet_in_fewer(spark):
    """Tasks that see the same nodes leave as many forests of them; they are thinned again before rounds of joins."""
    edges = [(i, j, (i * 7 + j * 13) % 17 / 17) for i in range(30) for j in range(i + 1, 30)]
    df = spark.createDataFrame(edges, "src long, dst long, similarity double").repartition(16)
    assert {tuple(r) for r in spanning_forest(df, few_edges=100).collect()} == strongest(edges)


def test_categories_of_wanted_pages(spark):
    rows = [(i, f"Page {i}", "", [f"c{i % 2}", f"d{i % 3}", "all"]) for i in range(1, 10)]
    pages, wanted = spark.createDataFrame(rows, PAGES), spark.createDataFrame([(2, "x"), (5, "y"), (99, "z")], "page_id long, more string")
    every = {r["page_id"]: r for r in categories.select_categories(pages).collect()}
    assert {r["page_id"]: r for r in categories.select_categories(pages, wanted=wanted).collect()} == {i: every[i] for i in (2, 5)}


def test_rounds_that_join_what_they_kept_carry_no_growing_estimate(spark):
    """Each join of kept rows with themselves doubled the digits of the estimated size: after 30 of them no driver held it."""
    rows = cut(spark.range(5).select("id", (F.col("id") * 2).alias("x")))
    for _ in range(9):
        rows = cut(rows.join(rows.select("id", F.col("x").alias("y")), "id").select("id", F.greatest("x", "y").alias("x")))
        assert rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= 2**256
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [(i, 2 * i) for i in range(5)]
    assert rows.join(rows, "id").count() == 5
