"""Proportional stratified interleaving: a global order in which every stretch has the sources in the proportions of the whole, cut into shards.

Within each source rows are shuffled by a seeded hash and get the fractional rank (i - 1/2) / n; all rows sorted by
that rank and cut into stretches of equal count make the shards. Both rankings are exact and distributed: rows are
bucketed by the leading digits of the hash (then of the rank), ranked inside buckets of a few thousand rows, and
offset by the running count of the buckets before. Only ids, sizes and hashes move, never texts.

Defined results: a null source is the source "(none)", a null text is empty, a null id hashes like the empty string;
rows that agree in everything used here may swap places, which no output shows. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 16
SEED = "interleave-1"
#: Buckets are made so many that they hold about this many rows.
BUCKET_ROWS = 4096


def _offsets(counted: DataFrame, by: list[str], order: str) -> DataFrame:
    """counted(by, order, n) -> with before: the sum of n over smaller order within by."""
    w = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    return counted.withColumn("before", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def interleave(rows: DataFrame, total: int, stratum: str, key: str, ties: list[str], seed: str = SEED) -> DataFrame:
    """rows with position: 0 .. total-1 in the interleaved order. total is the count of rows; ties orders rows of one key."""
    digits = max(1, math.ceil(math.log(max(total, 1) / BUCKET_ROWS, 16))) if total > BUCKET_ROWS else 1
    buckets = 16**digits
    keyed = rows.withColumn("__s", F.coalesce(F.col(stratum), F.lit("(none)"))).withColumn("__h", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))))
    keyed = keyed.withColumn("__b", F.substring("__h", 1, digits))
    order = ["__h", F.col(key).asc_nulls_first(), *ties]
    inner = keyed.withColumn("__r", F.row_number().over(Window.partitionBy("__s", "__b").orderBy(*order)))
    sizes = keyed.groupBy("__s", "__b").agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.groupBy("__s").agg(F.sum("n").alias("__n"))
    starts = _offsets(sizes, ["__s"], "__b").join(whole, "__s").select("__s", "__b", "before", "__n")
    ranked = inner.join(starts, ["__s", "__b"]).withColumn("__f", (F.col("before") + F.col("__r") - F.lit(0.5)) / F.col("__n"))
    ranked = ranked.withColumn("__fb", F.floor(F.col("__f") * buckets)).drop("before", "__n", "__r", "__b")
    at = _offsets(ranked.groupBy("__fb").agg(F.count(F.lit(1)).alias("n")), [], "__fb").drop("n")
    placed = ranked.withColumn("__p", F.row_number().over(Window.partitionBy("__fb").orderBy("__f", "__s", *order)))
    return placed.join(at, "__fb").withColumn("position", F.col("before") + F.col("__p") - 1).drop("__fb", "__p", "before", "__f", "__s", "__h")


def assign(documents: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot) of every document: shard counts differ by one at most, slots are gapless from 0."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    total = documents.count()
    placed = interleave(rows, total, "source", "doc_id", ["text_crc32", "size"], seed)
    n = max(total, 1)
    shard = F.expr(f"position * {shards}L DIV {n}L")
    cut_at = F.expr(f"(shard * {n}L + {shards - 1}L) DIV {shards}L")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("position") - cut_at).withColumn("shard", F.col("shard").cast("int")).drop("position")


def shard_report(documents: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """The placing of every document under the law of equal row counts."""
    return assign(documents, shards, seed).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS, seed: str = SEED, rows_per_file: int = 100_000) -> None:
    """The documents as Parquet under path/shard=N, rows of a file in slot order. doc_id must be unique here, as texts are joined to their places by it."""
    placed = assign(documents, shards, seed).select("doc_id", "shard", "slot")
    full = documents.join(placed, "doc_id").withColumn("part", F.floor(F.col("slot") / rows_per_file))
    full.repartition("shard", "part").sortWithinPartitions("shard", "slot").drop("part").write.partitionBy("shard").parquet(path)


def _crc_table() -> list[int]:
    """The 256 steps of CRC-32 (reflected polynomial 0xEDB88320), for engines without the function."""
    table = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        table.append(x)
    return table


#: CRC-32 as a fold over the hexadecimal digit pairs of the UTF-8 bytes.
_CRC = f"""xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda a, x: xor(a >> 8, list_extract({_crc_table()}::BIGINT[], (xor(a, x) & 255) + 1)))) """

ORACLE = f"""
WITH hashed AS (
  SELECT doc_id, source, coalesce(source, '(none)') AS s, {_CRC} AS text_crc32, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         md5(concat_ws(':', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h FROM documents),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY s ORDER BY h, doc_id, text_crc32, size) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY s) AS f FROM hashed),
placed AS (SELECT *, row_number() OVER (ORDER BY f, s, h, doc_id, text_crc32, size) - 1 AS p, count(*) OVER () AS n FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p * {SHARDS} // n AS INTEGER) AS shard,
       p - ((p * {SHARDS} // n) * n + {SHARDS - 1}) // {SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard, source
FROM placed
"""
