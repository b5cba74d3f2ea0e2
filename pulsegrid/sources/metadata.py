"""Landed metadata responses: batches of titles whose answers came in several steps, folded into pages and aliases.

A line of the landed files is one response: {"batch", "step", "titles", "response": {"query": {"normalized", "redirects",
"pages"}, "continue"}}. Steps of a batch are numbered from 0, and all but the last say how they go on. Files and lines
may come in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.contracts import refuse_rows
from pulsegrid.operators.evidence import LEAD_CHARACTERS, category_name, resolve_redirects

_MOVE = "array<struct<from:string,to:string>>"
_PAGE = "struct<pageid:bigint,title:string,missing:boolean,extract:string,categories:array<struct<title:string>>>"
RESPONSE = f"batch bigint, step int, titles array<string>, response struct<query:struct<normalized:{_MOVE},redirects:{_MOVE},pages:array<{_PAGE}>>,continue:map<string,string>>"


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Responses of whole batches; a line that is none fails the query, a batch that is not finished is refused."""
    found = spark.read.schema(RESPONSE).option("mode", "FAILFAST").json(path)
    refuse_rows(unfinished(found), "a metadata batch is not finished")
    return found


def unfinished(responses: DataFrame) -> DataFrame:
    """(batch) of the batches that lack a step, repeat one, answer without pages, or do not end where they say so."""
    ends = F.col("response.continue").isNull()
    steps = responses.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("step").alias("different"), F.min("step").alias("first"), F.max("step").alias("last"), F.count_if(ends).alias("ends"), F.max_by(ends, "step").alias("ended"), F.count_if(F.col("response.query.pages").isNull()).alias("empty"))
    fine = F.col("batch").isNotNull() & (F.col("first") == 0) & (F.col("last") + 1 == F.col("n")) & (F.col("different") == F.col("n")) & (F.col("ends") == 1) & F.col("ended") & (F.col("empty") == 0)
    return steps.where(~F.coalesce(fine, F.lit(False))).select("batch")


def fragments(responses: DataFrame) -> DataFrame:
    """(batch, page_id, canonical_title, lead, categories): what a batch says of a page over all its steps, the latest lead, all categories."""
    page = responses.select("batch", "step", F.explode("response.query.pages").alias("p")).where("NOT coalesce(p.missing, false)").select("batch", "step", "p.*")
    lead = F.max_by(F.substring("extract", 1, LEAD_CHARACTERS), F.when(F.col("extract").isNotNull(), F.col("step")))
    names = F.transform(F.coalesce("categories", F.array().cast("array<struct<title:string>>")), lambda c: category_name(c["title"]))
    folded = page.groupBy("batch", F.col("pageid").alias("page_id")).agg(F.min_by("title", "step").alias("canonical_title"), F.coalesce(lead, F.lit("")).alias("lead"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(names)))).alias("categories"))
    return folded


def aliases(responses: DataFrame) -> DataFrame:
    """(batch, alias, page_id): every title asked for, normalised and led through its batch's redirects; null where that ends at no page, or the title is missing."""
    asked = responses.select("batch", F.explode("titles").alias("alias")).distinct()
    moves = lambda kind: responses.select("batch", "step", F.explode(f"response.query.{kind}").alias("m")).groupBy("batch", F.col("m.from").alias("source")).agg(F.max_by("m.to", "step").alias("target"))
    name = lambda title: F.to_json(F.struct("batch", F.col(title).alias("title")))  # noqa: E731  titles mean something within their batch alone
    normal = asked.join(moves("normalized").withColumnRenamed("source", "alias"), ["batch", "alias"], "left").select("batch", "alias", F.coalesce("target", "alias").alias("title"))
    ends = resolve_redirects(normal.select(name("title").alias("title")).distinct(), moves("redirects").select(name("source").alias("source"), name("target").alias("target")))
    led = normal.withColumn("key", name("title")).join(ends.withColumnRenamed("title", "key"), "key", "left").select("batch", "alias", F.get_json_object("final", "$.title").alias("canonical_title"))
    pages = fragments(responses).select("batch", "canonical_title", "page_id")
    gone = responses.select("batch", F.explode("response.query.pages").alias("p")).where("p.missing").select("batch", F.col("p.title").alias("alias"), F.lit(True).alias("gone")).distinct()
    found = led.join(pages, ["batch", "canonical_title"], "left").join(gone, ["batch", "alias"], "left")
    return found.select("batch", "alias", F.when(F.col("gone").isNull(), F.col("page_id")).alias("page_id"))
