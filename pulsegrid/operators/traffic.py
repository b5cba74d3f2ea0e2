"""Censored attention: a dense grid of members and days, windows as intervals, directions, impact and the ranked portfolio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.contracts import refuse_rows

#: A published count is the true one rounded up to a hundred.
ROUNDING_WIDTH = 99
PORTFOLIO_SIZE = 10
MOST_OCTAVES = 10.0
QUALIFIED = ("robust_growth", "robust_shrinking", "sudden_growth")


def censored_grid(members: DataFrame, days: DataFrame, cutoffs: DataFrame, observations: DataFrame) -> DataFrame:
    """(cluster_id, page_id, date, window, views_ceil, lower, upper) of every member and successful day.

    A page seen has the interval of its rounding; one not seen lies between nothing and the day's cutoff. days is a
    fortnight, so the grid is 14 rows a member at most, and days and cutoffs are the only tables broadcast.
    """
    known = days.where("status = 'successful'").select("date", "window").join(cutoffs, "date")
    grid = members.select("cluster_id", "page_id").crossJoin(F.broadcast(known))  # 14 rows
    seen = grid.join(observations.select("page_id", "date", "views_ceil"), ["page_id", "date"], "left")
    lower = F.when(F.col("views_ceil").isNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), F.col("views_ceil") - ROUNDING_WIDTH))
    return seen.select("cluster_id", "page_id", "date", "window", "views_ceil", lower.cast("long").alias("lower"), F.coalesce("views_ceil", "cutoff").alias("upper"))


def window_traffic(grid: DataFrame) -> DataFrame:
    """(cluster_id, window, successful_days, observed_total, observed_page_days, minimum_total, maximum_total and three 7-day figures)."""
    sums = grid.groupBy("cluster_id", "window").agg(
        F.countDistinct("date").alias("successful_days"),
        F.coalesce(F.sum("views_ceil"), F.lit(0)).alias("observed_total"),
        F.count("views_ceil").alias("observed_page_days"),
        F.sum("lower").alias("minimum_total"),
        F.sum("upper").alias("maximum_total"),
    )
    return _weekly(sums)


def sparse_window_traffic(members: DataFrame, days: DataFrame, cutoffs: DataFrame, observations: DataFrame) -> DataFrame:
    """window_traffic without the grid: every unseen member-day adds its cutoff to the upper bound, so a cluster's bound is its size times the window's cutoffs plus what its observations change.

    Moves one row for an observation instead of one for each member and day.
    """
    known = days.where("status = 'successful'").select("date", "window").join(cutoffs, "date")
    spans = known.groupBy("window").agg(F.countDistinct("date").alias("successful_days"), F.sum("cutoff").alias("cutoffs"))
    sizes = members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(spans))  # two rows
    seen = observations.join(members.select("cluster_id", "page_id"), "page_id").join(F.broadcast(known), "date")  # 14 rows
    sums = seen.groupBy("cluster_id", "window").agg(F.sum("views_ceil").alias("observed_total"), F.count("views_ceil").alias("observed_page_days"), F.sum(F.greatest(F.lit(0), F.col("views_ceil") - ROUNDING_WIDTH)).alias("minimum_total"), F.sum(F.col("views_ceil") - F.col("cutoff")).alias("more"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    joined = sizes.join(sums, ["cluster_id", "window"], "left")
    return _weekly(joined.select("cluster_id", "window", "successful_days", zero("observed_total"), zero("observed_page_days"), zero("minimum_total"), (F.col("n") * F.col("cutoffs") + F.coalesce("more", F.lit(0))).alias("maximum_total")))


def _weekly(sums: DataFrame) -> DataFrame:
    scaled = lambda c: F.col(c) * 7 / F.col("successful_days")
    return sums.withColumns({"seven_day_equivalent": scaled("observed_total"), "minimum": scaled("minimum_total"), "maximum": scaled("maximum_total")})


def direction(p: str = "previous", c: str = "current") -> Column:
    """sudden_growth, robust_growth, robust_shrinking or uncertain_direction, from structs of window figures; whole numbers are cross-multiplied, touching ranges stay uncertain."""
    p_, c_ = F.col(p), F.col(c)
    grows = c_["minimum_total"] * p_["successful_days"] > p_["maximum_total"] * c_["successful_days"]
    shrinks = c_["maximum_total"] * p_["successful_days"] < p_["minimum_total"] * c_["successful_days"]
    sudden = (p_["observed_total"] == 0) & (c_["observed_total"] > 0)
    return F.when(sudden, "sudden_growth").when(grows, "robust_growth").when(shrinks, "robust_shrinking").otherwise("uncertain_direction")


FIGURES = ("successful_days", "observed_total", "observed_page_days", "minimum_total", "maximum_total", "seven_day_equivalent", "minimum", "maximum")


def cluster_traffic(windows: DataFrame) -> DataFrame:
    """(cluster_id, previous, current, direction): both windows side by side. One aggregate over the rows of window_traffic, partly summed before the shuffle it shares with them."""
    of = lambda w: F.max(F.when(F.col("window") == w, F.struct(*FIGURES))).alias(w)
    return windows.groupBy("cluster_id").agg(of("previous"), of("current")).withColumn("direction", direction())


def impact_score(previous: Column, current: Column) -> Column:
    """log1p of the larger figure times the change in octaves, at most ten."""
    return F.log1p(F.greatest(previous, current)) * F.least(F.abs(F.log2((current + 1) / (previous + 1))), F.lit(MOST_OCTAVES))


def scored(clusters: DataFrame) -> DataFrame:
    return clusters.withColumn("impact_score", impact_score(F.col("previous.seven_day_equivalent"), F.col("current.seven_day_equivalent")))


def qualified(clusters: DataFrame) -> DataFrame:
    return clusters.where(F.col("direction").isin(*QUALIFIED))


def rank_portfolio(clusters: DataFrame, size: int = PORTFOLIO_SIZE) -> DataFrame:
    """The best size clusters with rank; ties by cluster_id. The rank is taken over the rows that are left."""
    best = scored(qualified(clusters)).orderBy(F.col("impact_score").desc(), "cluster_id").limit(size)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col("impact_score").desc(), "cluster_id")))


def portfolio_items(ranked: DataFrame, members: DataFrame) -> DataFrame:
    """Facts of the ranked clusters: percentage change, coverage, confidence."""
    count = members.join(F.broadcast(ranked.select("cluster_id")), "cluster_id", "left_semi").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_members"))  # ten rows
    p, c = F.col("previous.seven_day_equivalent"), F.col("current.seven_day_equivalent")
    part = lambda w: F.col(f"{w}.observed_page_days") / (F.col(f"{w}.successful_days") * F.col("n_members"))
    return ranked.join(count, "cluster_id").select("rank", "cluster_id", "direction", "n_members", F.when(p == 0, None).otherwise((c - p) / p * 100).alias("percentage_change"), part("previous").alias("coverage_previous"), part("current").alias("coverage_current"), F.when(F.col("direction") == "sudden_growth", "observed").otherwise("robust").alias("confidence"), "impact_score")


def portfolio_cards(items: DataFrame) -> DataFrame:
    """What a reader is shown of each item: its direction's heading, change and coverage as text."""
    heading = F.when(F.col("direction") == "robust_shrinking", "Shrinking").when(F.col("direction") == "robust_growth", "Growing").otherwise("Suddenly trending")
    change = F.when(F.col("percentage_change").isNull(), "new").otherwise(F.format_string("%+.1f%%", F.col("percentage_change")))
    return items.select("rank", "cluster_id", heading.alias("heading"), change.alias("change"), F.format_string("%.0f%%", F.col("coverage_current") * 100).alias("coverage"))


def unknown_members(members: DataFrame, pages: DataFrame) -> DataFrame:
    return members.select("cluster_id", "page_id").join(pages.select("page_id"), "page_id", "left_anti")


def unexpected_dates(observations: DataFrame, days: DataFrame) -> DataFrame:
    ok = days.where("status = 'successful'").select("date")
    return observations.join(F.broadcast(ok), "date", "left_anti")  # 14 rows


def cutoff_faults(cutoffs: DataFrame, days: DataFrame) -> DataFrame:
    """(date, fault): missing, unexpected, duplicate or null cutoffs."""
    ok = days.where("status = 'successful'").select("date", F.lit(1).alias("expected"))
    given = cutoffs.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.max("cutoff").alias("cutoff"))
    fault = F.when(F.col("n").isNull(), "missing").when(F.col("expected").isNull(), "unexpected").when(F.col("n") > 1, "duplicate").when(F.col("cutoff").isNull(), "null")
    return ok.join(given, "date", "full").select("date", fault.alias("fault")).where("fault IS NOT NULL")


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, n) of the keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def attach_cluster_traffic(members: DataFrame, days: DataFrame, cutoffs: DataFrame, observations: DataFrame, pages: DataFrame) -> DataFrame:
    """cluster_traffic behind all guards of its inputs."""
    refuse_rows(repeated_keys(days, "date"), "nominal days repeat a date")
    refuse_rows(cutoff_faults(cutoffs, days), "daily cutoffs do not match the successful days")
    refuse_rows(repeated_keys(observations, "page_id", "date"), "a page has two observations of one day")
    refuse_rows(unexpected_dates(observations, days), "an observation lies outside the successful days")
    refuse_rows(repeated_keys(members, "page_id"), "a page is a member twice")
    refuse_rows(unknown_members(members, pages), "a member is no canonical page")
    return cluster_traffic(sparse_window_traffic(members, days, cutoffs, observations))
