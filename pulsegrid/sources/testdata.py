"""The reference inputs derived from the tables of the test data, by expressions that SQL engines share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

AS_OF = "2024-01-31"
PROJECT = "view"
UNAVAILABLE_DAYS = ("2024-01-18", "2024-01-26")
TOP_N = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_daily(spark: SparkSession, sf_dir: str, top: int = TOP_N) -> DataFrame:
    """(date, project, article, views_ceil): each day's top articles, counts rounded up to hundreds as the source publishes them."""
    e = table(spark, sf_dir, "events")
    article = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("_"), (F.col("event_id") % 2).cast("string"))
    cents = F.round(F.col("value") * 100).cast("long")
    daily = e.groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("project"), article.alias("article")).agg(F.sum(cents).alias("c"))
    ceiled = daily.select("date", "project", "article", F.expr("((c + 99) div 100) * 100").alias("views_ceil"))
    rank = F.row_number().over(Window.partitionBy("date").orderBy(F.col("views_ceil").desc(), "article", "project"))
    return ceiled.withColumn("rank", rank).where(F.col("rank") <= top).drop("rank")


def day_status(spark: SparkSession) -> DataFrame:
    """(date, status) of the 14 nominal days."""
    from pulsegrid.operators.evidence import nominal_days

    off = F.col("date").isin(*(F.lit(d).cast("date") for d in UNAVAILABLE_DAYS))
    return nominal_days(spark, AS_OF).select("date", F.when(off, "unavailable").otherwise("successful").alias("status"))


def days(spark: SparkSession) -> DataFrame:
    """(date, window, status)."""
    from pulsegrid.operators.evidence import nominal_days

    return nominal_days(spark, AS_OF).join(F.broadcast(day_status(spark)), "date")  # 14 rows


def successful_records(spark: SparkSession, sf_dir: str, top: int = TOP_N) -> DataFrame:
    ok = days(spark).where("status = 'successful'").select("date")
    return raw_daily(spark, sf_dir, top).join(F.broadcast(ok), "date", "left_semi")  # 14 rows at most


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(alias, page_id): two articles name one page."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("_"), (F.col("event_id") % 2).cast("string")).alias("alias"), F.col("user_id").alias("page_id")).distinct()


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, canonical_title, lead, categories, unavailable)."""
    d = table(spark, sf_dir, "documents")
    lead = F.substring("text", 1, 600)
    title = F.when(F.col("source") == "src0", F.concat(F.lit("Special:Doc "), F.col("doc_id"))).when(F.col("source") == "src1", F.lit("Main Page")).otherwise(F.concat(F.lit("Doc "), F.col("doc_id")))
    words = F.array_distinct(F.filter(F.split(lead, " "), lambda w: w != ""))
    return d.select(F.col("doc_id").alias("page_id"), title.alias("canonical_title"), lead.alias("lead"), F.array_append(words, F.col("source")).alias("categories"), (F.col("lang") == "de").alias("unavailable"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, content, category): the second vector is the one-hot of the label."""
    e = table(spark, sf_dir, "embeddings")
    one_hot = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (i == F.col("label")).cast("double"))
    return e.select(F.col("vec_id").alias("page_id"), F.col("embedding").cast("array<double>").alias("content"), one_hot.alias("category"))
