"""Checks between the stages of a run: what a later stage says is compared with what the earlier ones hold and with what follows from them.

Every check is rows (check, key, fault); a run without faults has none. Comparisons are null-safe joins on keys, so
what is missing, unknown, repeated or different on either side is found wherever it lies.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError
from pulsegrid.operators import adjudication, evidence, narrative, publish, traffic

CHECKS = ("run facts", "formation evidence", "formation members", "formation counts", "preliminary ids", "terminal provenance", "final clusters", "member evidence", "adjudication counts", "traffic", "portfolio", "narratives")

Tables = dict[str, DataFrame]


def _told(check: str, rows: DataFrame, key: str | Column, fault: str | Column = "fault") -> DataFrame:
    return rows.select(F.lit(check).alias("check"), (F.col(key) if isinstance(key, str) else key).cast("string").alias("key"), (F.col(fault) if isinstance(fault, str) else fault).alias("fault"))


def differences(given: DataFrame, expected: DataFrame, *keys: str) -> DataFrame:
    """(key, fault) where the tables are not the same rows: missing, unknown, differs, or repeated."""
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    fields = sorted(set(given.columns) - set(keys))
    a, b = (df.select(key.alias("key"), F.struct(F.lit(1), *fields).alias(name)) for df, name in ((given, "a"), (expected.select(*given.columns), "b")))
    fault = F.when(F.col("a").isNull(), "missing").when(F.col("b").isNull(), "unknown").when(~F.col("a").eqNullSafe(F.col("b")), "differs")
    repeated = a.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.lit("repeated").alias("fault"))
    return a.dropDuplicates(["key"]).join(b.dropDuplicates(["key"]), "key", "full").select("key", fault.alias("fault")).where("fault IS NOT NULL").unionAll(repeated)


def formation_count_faults(counts: DataFrame, clusters: DataFrame) -> DataFrame:
    """(fault) where the counts of formation are not those of its clusters, or do not add up."""
    own = counts.crossJoin(clusters.agg(F.count(F.lit(1)).alias("there")))  # one row each
    fault = F.when(~F.col("selected_clusters").eqNullSafe(F.col("there")), "selected_clusters").when(~F.col("eligible_clusters").eqNullSafe(F.col("selected_clusters") + F.col("omitted_clusters")), "eligible_clusters")
    return own.select(fault.alias("fault")).where("fault IS NOT NULL")


def id_sequence_faults(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    """(column, fault): identifiers that are not prefix-0001 to the number of rows, each once."""
    number = F.regexp_extract(column, f"^{prefix}([0-9]{{4,}})$", 1)
    n = rows.agg(F.count(F.lit(1)).alias("there"))
    placed = rows.select(column, F.when(F.format_string(f"{prefix}%04d", number.cast("long")) == F.col(column), number.cast("long")).alias("number")).crossJoin(F.broadcast(n))  # one row
    wrong = placed.where("number IS NULL OR number < 1 OR number > there").select(column, F.lit("no place in the sequence").alias("fault"))
    return wrong.unionAll(traffic.repeated_keys(rows, column).select(column, F.lit("repeated").alias("fault")))


def faults(stages: dict[str, Tables], as_of: str, only: Collection[str] = CHECKS) -> DataFrame:
    """(check, key, fault) over the tables of evidence, formation, adjudication and portfolio, by all checks or only some."""
    e, f, a, p = (stages[n] for n in ("evidence", "formation", "adjudication", "portfolio"))
    spark = e["days"].sparkSession
    source = f["clusters"].select("cluster_id", F.explode("page_ids").alias("page_id"))
    finals = adjudication.final_clusters(a["decided"])
    members = finals.select(F.col("final_cluster_id").alias("cluster_id"), F.explode("page_ids").alias("page_id"))
    recomputed = traffic.cluster_traffic(traffic.sparse_window_traffic(members, e["days"], e["cutoffs"], e["observations"]))
    items = traffic.portfolio_items(traffic.rank_portfolio(recomputed), members).join(finals.select(F.col("final_cluster_id").alias("cluster_id"), F.col("group_name").alias("source_name")), "cluster_id")
    own_fields = f["members"].select("page_id", "canonical_title", "lead", "selected_categories")
    found = [
        ("run facts", differences(e["days"].select("date", "window"), evidence.nominal_days(spark, as_of).select("date", "window"), "date"), "key"),
        ("formation evidence", publish.formation_faults(f["members"], e["pages"]), "page_id"),
        ("formation members", differences(f["members"].select("cluster_id", "page_id"), source, "page_id"), "key"),
        ("formation counts", formation_count_faults(f["counts"], f["clusters"]), F.lit(None)),
        ("preliminary ids", id_sequence_faults(f["clusters"], "cluster_id", "preliminary-cluster-"), "cluster_id"),
        ("terminal provenance", adjudication.terminal_partition(source, a["decided"]).where("NOT exact"), "cluster_id", F.lit("no exact partition")),
        ("final clusters", differences(a["final"], finals, "final_cluster_id"), "key"),
        ("member evidence", publish.member_faults(a["final_members"].select("page_id", "canonical_title", "lead", "selected_categories"), own_fields), "page_id"),
        ("member evidence", differences(a["final_members"].select("cluster_id", "page_id"), members, "page_id"), "key"),
        ("adjudication counts", differences(a["counts"], adjudication.adjudication_counts(a["decided"]), "reviewed_clusters"), "key"),
        ("traffic", differences(p["traffic"], recomputed, "cluster_id"), "key"),
        ("portfolio", differences(p["items"], items, "rank"), "key"),
        ("narratives", narrative.attempt_faults(p["attempts"], items, p["narratives"]), "cluster_id"),
    ]
    return reduce(DataFrame.unionByName, (_told(*f) for f in found if f[0] in only))


def gate(spark: SparkSession, stages: dict[str, Tables], as_of: str, folder: str) -> None:
    """Write the faults to folder and raise if there are any. They are counted in the pass that writes them."""
    seen = Observation("cross-checks")
    counted = [F.count_if(F.col("check") == c).alias(c) for c in CHECKS]
    faults(stages, as_of).observe(seen, F.count(F.lit(1)).alias("all"), *counted).write.mode("overwrite").parquet(folder)
    if seen.get["all"]:
        raise ContractError("upstream artifacts are inconsistent: " + ", ".join(f"{c} ({n})" for c, n in seen.get.items() if n and c != "all"))
