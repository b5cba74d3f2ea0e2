"""Categories that tell pages apart: noise removal, document frequencies, inverse document frequencies, the best five of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Categories of upkeep, as patterns to be found in a name.
NOISE_PATTERNS = (r"^\d{4} births$", r"^\d{4} deaths$", r"^Living people$", r"^Possibly living people$", r"^Year of birth missing", r"^Year of death missing", r"^Articles with", r"^All articles", r"^CS1", r"^Webarchive", r"^Wikipedia:")
KEPT = 5


def is_noise(category: Column) -> Column:
    """Digits of all scripts count as digits."""
    return F.rlike(category, F.lit("(?U)" + "|".join(NOISE_PATTERNS)))


def meaningful(pages: DataFrame) -> DataFrame:
    """pages with the distinct categories that are no noise."""
    kept = F.filter(F.array_distinct("categories"), lambda c: c.isNotNull() & ~is_noise(c))
    return pages.withColumn("categories", kept)


def document_frequency(pages: DataFrame) -> DataFrame:
    """(category, df) over the meaningful categories."""
    return meaningful(pages).select(F.explode("categories").alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("df"))


def inverse_frequency(pages: DataFrame) -> DataFrame:
    """(category, df, idf): idf is ln(pages / df), all pages counting, also those without a meaningful category."""
    n = pages.agg(F.count(F.lit(1)).alias("n"))
    return document_frequency(pages).crossJoin(F.broadcast(n)).select("category", "df", F.log(F.col("n") / F.col("df")).alias("idf"))  # one row


def select_categories(pages: DataFrame, most: int = KEPT, wanted: DataFrame | None = None) -> DataFrame:
    """pages(page_id, canonical_title, lead, selected_categories): the rarest first, ties by name. Pages without any keep an empty list.

    Rarity counts all pages; only those of wanted(page_id), if given, are selected for and returned.
    """
    own = pages if wanted is None else pages.join(wanted.select("page_id"), "page_id", "left_semi")
    each = meaningful(own).select("page_id", F.explode("categories").alias("category"))
    order = Window.partitionBy("page_id").orderBy(F.col("idf").desc(), "category")
    best = each.join(inverse_frequency(pages), "category").withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    lists = best.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "category"))), lambda x: x["category"]).alias("selected_categories"))
    empty = F.array().cast("array<string>")
    return own.select("page_id", "canonical_title", "lead").join(lists, "page_id", "left").withColumn("selected_categories", F.coalesce("selected_categories", empty))


def representations(selected: DataFrame) -> DataFrame:
    """The two texts of a page that are embedded."""
    names = F.when(F.size("selected_categories") == 0, "(none)").otherwise(F.array_join("selected_categories", " | "))
    return selected.select("page_id", F.concat(F.lit("Title: "), "canonical_title", F.lit("\nLead: "), "lead").alias("content_text"), F.concat(F.lit("Selected Categories: "), names).alias("category_text"))
