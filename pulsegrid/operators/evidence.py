"""Daily evidence: nominal windows, project filter and cutoffs, exclusions, alias resolution, page series, metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError, refuse_rows
from pulsegrid.functions.ordering import placed
from pulsegrid.functions.storage import cut

MINIMUM_DAYS = 4
BATCH_TITLES = 50
LEAD_CHARACTERS = 600
# The namespaces that are not articles.
TECHNICAL_NAMESPACES = ("category", "draft", "file", "help", "media", "mediawiki", "module", "portal", "special", "template", "timedtext", "user", "user talk", "wikipedia")


def nominal_days(spark: SparkSession, as_of: str) -> DataFrame:
    """(date, window): the seven days from as_of - 15 are previous, the seven from as_of - 8 current."""
    return days_before(spark.range(1).select(F.lit(as_of).cast("date").alias("as_of")))


def days_before(newest: DataFrame) -> DataFrame:
    """(date, window) of the fortnight before the one as_of of newest."""
    dates = newest.select("as_of", F.explode(F.sequence(F.date_sub("as_of", 15), F.date_sub("as_of", 2))).alias("date"))
    return dates.select("date", F.when(F.col("date") <= F.date_sub("as_of", 9), "previous").otherwise("current").alias("window"))


def consecutive_days(days: DataFrame) -> DataFrame:
    """One row: n_days, and whether they are 14 without a gap. days holds a fortnight, so one window over it is small."""
    gap = F.datediff("date", F.lag("date").over(Window.orderBy("date")))
    return days.select("date", gap.alias("gap")).agg(F.count(F.lit(1)).alias("n_days"), ((F.count(F.lit(1)) == 14) & (F.count_if(F.coalesce(F.col("gap"), F.lit(1)) != 1) == 0)).alias("consecutive"))


def filter_project(records: DataFrame, project: str) -> DataFrame:
    return records.where(F.col("project") == project)


def daily_cutoffs(records: DataFrame, days: DataFrame) -> DataFrame:
    """(date, cutoff) of successful days: the least count over all projects, null for an empty day."""
    least = records.groupBy("date").agg(F.min("views_ceil").alias("cutoff"))
    return days.where("status = 'successful'").select("date").join(least, "date", "left")


def coverage(days: DataFrame) -> DataFrame:
    """(window, successful_days)."""
    return days.groupBy("window").agg(F.count_if(F.col("status") == "successful").alias("successful_days"))


def require_coverage(days: DataFrame, least: int = MINIMUM_DAYS) -> None:
    """Raise where a window has too few successful days, the previous one first."""
    found = {r["window"]: r["successful_days"] for r in coverage(days).collect()}  # two rows
    for window in ("previous", "current"):
        if found.get(window, 0) < least:
            raise ContractError(f"{window} Effective Window has {found.get(window, 0)} successful days; at least {least} are required")


def coverage_gate(days: DataFrame, least: int = MINIMUM_DAYS) -> DataFrame:
    """(window, successful_days, accepted)."""
    return coverage(days).withColumn("accepted", F.col("successful_days") >= least)


def candidate_universe(records: DataFrame) -> DataFrame:
    """(article): distinct titles of all days."""
    return records.select("article").distinct()


def metadata_batches(universe: DataFrame, size: int = BATCH_TITLES) -> DataFrame:
    """(article, batch): batches of size titles in title order."""
    return placed(universe.select("article"), "article").select("article", F.floor((F.col("rank") - 1) / size).cast("long").alias("batch"))


def _trimmed(text: Column) -> Column:
    """Without blanks of any script at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def exclusion_reason(title: Column) -> Column:
    """main_page, technical_namespace:<name>, or null."""
    plain = _trimmed(F.replace(title, F.lit("_"), F.lit(" ")))
    space = F.lower(F.substring_index(plain, ":", 1))
    technical = F.contains(plain, F.lit(":")) & space.isin(*TECHNICAL_NAMESPACES)
    return F.when(F.lower(plain) == "main page", "main_page").when(technical, F.concat(F.lit("technical_namespace:"), space))


def canonicalize(universe: DataFrame, aliases: DataFrame, pages: DataFrame) -> DataFrame:
    """(article, page_id, canonical_title, reason): reason is unavailable, an exclusion, or null for a page that stays.

    An article that no alias names has the reason "unknown"; require_known refuses it.
    """
    named = universe.join(aliases.select(F.col("alias").alias("article"), "page_id"), "article", "left")
    found = named.join(pages.select("page_id", "canonical_title", "unavailable"), "page_id", "left")
    gone = F.coalesce("unavailable", F.lit(True))
    reason = F.when(F.col("page_id").isNull(), "unknown").when(gone, "unavailable").otherwise(exclusion_reason(F.col("canonical_title")))
    return found.select("article", "page_id", "canonical_title", reason.alias("reason"))


def require_known(resolved: DataFrame) -> None:
    refuse_rows(resolved.where("reason = 'unknown'"), "a candidate title has no canonical page")


def exclusion_counts(resolved: DataFrame, records: DataFrame, project: str) -> DataFrame:
    """(reason, n): articles by exclusion, and records of other projects."""
    by_reason = resolved.where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return by_reason.unionByName(records.agg(F.count_if(F.col("project") != project).alias("n")).select(F.lit("other_project").alias("reason"), "n"))


def exclusion_map(counts: DataFrame) -> DataFrame:
    """One row: the counters of exclusion_counts, the namespaces as a map."""
    part = lambda name: F.coalesce(F.sum(F.when(F.col("reason") == name, F.col("n"))), F.lit(0)).alias(name)
    spaces = F.collect_list(F.when(F.col("reason").startswith("technical_namespace:"), F.struct(F.substring_index("reason", ":", -1).alias("key"), F.col("n").alias("value"))))
    return counts.agg(part("unavailable"), part("main_page"), part("other_project"), F.map_from_entries(F.array_sort(spaces)).alias("technical_namespaces"))


def canonical_pages(resolved: DataFrame) -> DataFrame:
    """(page_id, canonical_title, aliases): sorted aliases of the pages that stay."""
    kept = resolved.where("reason IS NULL")
    return kept.groupBy("page_id", "canonical_title").agg(F.sort_array(F.collect_set("article")).alias("aliases"))


def page_observations(records: DataFrame, resolved: DataFrame) -> DataFrame:
    """(page_id, date, views_ceil): counts of a page's aliases added up by day."""
    kept = resolved.where("reason IS NULL").select("article", "page_id")
    return records.join(kept, "article").groupBy("page_id", "date").agg(F.sum("views_ceil").alias("views_ceil"))


def lead_text(lead: Column, most: int = LEAD_CHARACTERS) -> Column:
    """The first characters, by code points."""
    return F.substring(lead, 1, most)


def category_name(title: Column) -> Column:
    return F.regexp_replace(title, "^Category:", "")


def merge_metadata(fragments: DataFrame) -> DataFrame:
    """fragments(page_id, canonical_title, lead, categories) -> a row for each page: its lead, sorted distinct categories, and conflict.

    conflict: two titles, or two leads that are not empty.
    """
    lead = F.nullif(F.col("lead"), F.lit(""))
    merged = fragments.groupBy("page_id").agg(F.min("canonical_title").alias("canonical_title"), F.coalesce(F.max(lead), F.lit("")).alias("lead"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("categories")))).alias("categories"), F.min("canonical_title").alias("t1"), F.max("canonical_title").alias("t2"), F.min(lead).alias("l1"), F.max(lead).alias("l2"))
    return merged.withColumn("conflict", (F.col("t1") != F.col("t2")) | F.coalesce(F.col("l1") != F.col("l2"), F.lit(False))).drop("t1", "t2", "l1", "l2")


def require_no_conflict(merged: DataFrame) -> None:
    refuse_rows(merged.where("conflict"), "page metadata fragments disagree")


def resolve_redirects(titles: DataFrame, redirects: DataFrame) -> DataFrame:
    """titles(title), redirects(source, target) -> (title, final): the end of each chain, whatever its length, null on a cycle.

    Jumps double: each round joins the map to itself, so a chain of n steps settles in log2(n) rounds. A round ends fewer
    jumps on a source than the one before, unless only what runs into cycles is left; then no title is still on its way.
    """
    hop = cut(redirects.where("source IS NOT NULL").groupBy("source").agg(F.min("target").alias("target")))
    sources = hop.select(F.col("source").alias("target"))
    before, on_the_way = None, hop.join(sources, "target", "left_semi").count()
    while on_the_way and on_the_way != before:
        ahead = hop.select(F.col("source").alias("target"), F.col("target").alias("beyond"))
        hop = cut(hop.join(ahead, "target", "left").select("source", F.coalesce("beyond", "target").alias("target")))
        before, on_the_way = on_the_way, hop.join(sources, "target", "left_semi").count()
    resolved = titles.join(hop.withColumnRenamed("source", "title"), "title", "left").select("title", F.coalesce("target", "title").alias("final"))
    endless = sources.withColumnRenamed("target", "final")
    return resolved.join(endless.withColumn("on", F.lit(True)), "final", "left").select("title", F.when(F.col("on").isNull(), F.col("final")).alias("final"))
