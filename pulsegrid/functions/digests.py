"""Fingerprints of tables: the root of a tree over the digests of the rows.

Rows meet under a prefix of their digest, so each node has some thousands of children at most however many rows there
are, equal rows are counted before they meet, and no order, task or driver ever holds the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits that name the nodes of each level, from the leaves to the root.
LEVELS = (6, 3, 0)


def row_digest(columns: list[str]) -> Column:
    """The SHA-256 of a row as JSON, nulls included, columns in the order of their names."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def tree_root(digests: DataFrame) -> DataFrame:
    """digests(digest) -> one row (n, fingerprint) for the rows in any order, repeated ones counted. No rows: the digest of nothing."""
    state = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).select(F.col("digest").alias("node"), F.concat_ws(":", "digest", "n").alias("line"), "n")
    for digits in LEVELS:
        parts = state.groupBy(F.substring("node", 1, digits).alias("node")) if digits else state.groupBy()
        state = parts.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("line")), ","), 256).alias("root"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        state = state.select("node", F.concat_ws(":", "node", "root").alias("line"), "n") if digits else state
    return state.select("n", F.concat(F.lit("sha256:"), "root").alias("fingerprint"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    return tree_root(df.select(row_digest(df.columns).alias("digest")))
