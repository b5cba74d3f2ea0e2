"""Censored windows, directions, scores and the portfolio on small fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError
from pulsegrid.operators import traffic


def day(n):
    return f"2026-07-{n:02d}"


@pytest.fixture(scope="module")
def inputs(spark):
    """Four previous and seven current successful days with a cutoff of 50; two-page clusters that grow, shrink and touch."""
    previous, current = range(2, 6), range(9, 16)
    days = [(day(n), "previous", "successful") for n in previous] + [(day(n), "previous", "unavailable") for n in (6, 7, 8)] + [(day(n), "current", "successful") for n in current]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema).withColumn("date", F.to_date("date"))
    seen = [(1, day(2), 100), (2, day(3), 100)] + [(p, day(n), 200) for n in current for p in (1, 2)]
    seen += [(3, day(n), 500) for n in previous] + [(5, day(n), 100) for n in previous]
    return {
        "days": frame(days, "date string, window string, status string"),
        "cutoffs": frame([(day(n), 50) for n in [*previous, *current]], "date string, cutoff long"),
        "observations": frame(seen, "page_id long, date string, views_ceil long"),
        "members": spark.createDataFrame([("grow", 1), ("grow", 2), ("shrink", 3), ("shrink", 4), ("touch", 5), ("touch", 6)], "cluster_id string, page_id long"),
        "pages": spark.createDataFrame([(i,) for i in range(1, 8)], "page_id long"),
    }


def attach(inputs, **other):
    i = inputs | other
    return traffic.attach_cluster_traffic(i["members"], i["days"], i["cutoffs"], i["observations"], i["pages"])


def test_intervals(inputs):
    out = {r["cluster_id"]: r for r in attach(inputs).collect()}
    p, c = out["grow"]["previous"], out["grow"]["current"]
    assert (p["observed_total"], p["observed_page_days"], p["successful_days"], p["seven_day_equivalent"], p["minimum"], p["maximum"]) == (200, 2, 4, 350, 3.5, 875)
    assert (c["minimum"], c["maximum"]) == (1414, 2800)
    assert {k: r["direction"] for k, r in out.items()} == {"grow": "robust_growth", "shrink": "robust_shrinking", "touch": "uncertain_direction"}


def test_grid_and_sums_agree(inputs):
    grid = traffic.window_traffic(traffic.censored_grid(inputs["members"], inputs["days"], inputs["cutoffs"], inputs["observations"]))
    sparse = traffic.sparse_window_traffic(inputs["members"], inputs["days"], inputs["cutoffs"], inputs["observations"])
    key = lambda df: sorted(map(tuple, df.select("cluster_id", "window", *traffic.FIGURES).collect()))
    assert key(grid) == key(sparse)


@pytest.mark.parametrize("p,c,wanted", [((0, 0, 0, 4), (1, 0, 9, 7), "sudden_growth"), ((10, 10, 1120, 4), (10, 1960, 3000, 7), "uncertain_direction"), ((10, 10, 1119, 4), (10, 1960, 3000, 7), "robust_growth"), ((9, 900, 990, 7), (1, 0, 899, 7), "robust_shrinking"), ((0, 0, 5, 7), (0, 0, 5, 7), "uncertain_direction")])
def test_directions(spark, p, c, wanted):
    struct = "struct<observed_total:long,minimum_total:long,maximum_total:long,successful_days:long>"
    assert spark.createDataFrame([(p, c)], f"previous {struct}, current {struct}").select(traffic.direction()).first()[0] == wanted


def frame(spark, rows):
    struct = "struct<seven_day_equivalent:double>"
    return spark.createDataFrame([(i, d, (float(p),), (float(c),)) for i, d, p, c in rows], f"cluster_id string, direction string, previous {struct}, current {struct}")


def test_ranking(spark):
    rows = [("growing", "robust_growth", 1000, 1500), ("shrinking", "robust_shrinking", 5000, 1000), ("small", "robust_growth", 1, 500), ("huge", "uncertain_direction", 1, 1e9), ("odd", "unheard_of", 1, 1e9)]
    assert [r["cluster_id"] for r in traffic.rank_portfolio(frame(spark, rows)).orderBy("rank").collect()] == ["small", "shrinking", "growing"]


def test_ties_and_cap(spark):
    rows = [(f"cluster-{i:02d}", "robust_growth", 0, 1048575) for i in range(12, 0, -1)]
    out = traffic.rank_portfolio(frame(spark, rows)).orderBy("rank").collect()
    assert [r["cluster_id"] for r in out] == [f"cluster-{i:02d}" for i in range(1, 11)]
    assert out[0]["impact_score"] == pytest.approx(math.log(1048576) * 10)


def test_empty_portfolio(spark):
    assert traffic.rank_portfolio(frame(spark, [("a", "uncertain_direction", 1, 2)])).count() == 0


def test_facts(inputs):
    items = {r["cluster_id"]: r for r in traffic.portfolio_items(traffic.rank_portfolio(attach(inputs)), inputs["members"]).collect()}
    assert items["grow"]["percentage_change"] == pytest.approx(700) and items["grow"]["coverage_previous"] == 0.25 and items["grow"]["confidence"] == "robust"


@pytest.mark.parametrize("what,sql", [("members", "SELECT 'x' cluster_id, 99L page_id"), ("members", "SELECT * FROM VALUES ('a', 1L), ('b', 1L) t(cluster_id, page_id)"), ("cutoffs", "SELECT DATE '2026-07-02' date, 5L cutoff"), ("observations", "SELECT 1L page_id, DATE '2026-07-06' date, 5L views_ceil"), ("observations", "SELECT * FROM VALUES (1L, DATE '2026-07-02', 5L), (1L, DATE '2026-07-02', 6L) t(page_id, date, views_ceil)")])
def test_guards(spark, inputs, what, sql):
    with pytest.raises(ContractError):
        attach(inputs, **{what: spark.sql(sql)})


def test_null_cutoff_is_refused(inputs):
    with pytest.raises(ContractError):
        attach(inputs, cutoffs=inputs["cutoffs"].withColumn("cutoff", F.when(F.col("date") != F.lit(day(9)).cast("date"), F.col("cutoff"))))
