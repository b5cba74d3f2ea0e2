"""What several of the training-data operators share: tables, word rules, hashes to the unit interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the corpus statistics: a run of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: The same folding for UTF-8 bytes: A-Z to a-z, all else unchanged.
FOLD_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def unit_interval(*parts: Column | str, seed: str) -> Column:
    """A number in [0, 1) from md5 of seed and parts (nulls count as empty): the same in any engine, run and row order."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *(F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))
