"""Landed files as tables: daily responses, the evidence fixture, frozen embeddings and scripted answers. All are read by Spark's readers, so any store that Spark knows will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError, checked, refuse_rows

RECORD = "struct<project:string,article:string,views_ceil:bigint>"
_FIXTURE = f"schema_version string, source string, daily_responses map<string,struct<records:array<{RECORD}>,error:string>>, canonical_pages map<string,struct<page_id:bigint,canonical_title:string,lead:string,categories:array<string>,unavailable:boolean>>"


def read_top_pages(spark: SparkSession, path: str) -> DataFrame:
    """(date, project, article, views_ceil) of responses that hold items of articles, one response a file. A malformed file fails the query."""
    item = "array<struct<year:string,month:string,day:string,articles:array<struct<article:string,project:string,views_ceil:bigint>>>>"
    rows = spark.read.schema(f"items {item}").option("multiLine", True).option("mode", "FAILFAST").json(path)
    day = rows.select(F.explode("items").alias("i")).select(F.to_date(F.concat_ws("-", "i.year", "i.month", "i.day")).alias("date"), F.explode("i.articles").alias("a"))
    return day.select("date", "a.project", "a.article", checked(F.col("a.views_ceil"), F.col("a.views_ceil") >= 0, "a daily record has no count").alias("views_ceil"))


def read_evidence_fixture(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """raw_daily, day_status, aliases and pages of one evidence document."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", _FIXTURE, {"mode": "FAILFAST"}).alias("f")).select("f.*")
    refuse_rows(whole.where("schema_version IS NULL OR schema_version <> '1.0' OR source IS NULL OR daily_responses IS NULL"), "evidence fixture has an invalid shape")
    days = whole.select(F.explode("daily_responses").alias("date", "r")).select(F.to_date("date").alias("date"), "r.records", "r.error")
    status = days.select("date", F.when(F.col("records").isNull(), "unavailable").otherwise("successful").alias("status"))
    raw = days.select("date", F.explode("records").alias("x")).select("date", "x.*")
    named = whole.select(F.explode("canonical_pages").alias("alias", "p")).select("alias", "p.*").withColumn("unavailable", F.coalesce("unavailable", F.lit(False)))
    # a page without metadata has no id of its own; its title stands for it
    own_id = F.coalesce("page_id", -F.abs(F.xxhash64("alias")))
    pages = named.select(own_id.alias("page_id"), "canonical_title", F.coalesce("lead", F.lit("")).alias("lead"), F.coalesce("categories", F.array().cast("array<string>")).alias("categories"), "unavailable")
    return {"raw_daily": raw, "day_status": status, "aliases": named.select("alias", own_id.alias("page_id")), "pages": pages}


def frozen_embeddings(texts: DataFrame, embeddings: DataFrame) -> DataFrame:
    """texts(page_id, text), embeddings(text, vector) -> (page_id, vector); a text without a vector is an error."""
    joined = texts.join(embeddings, "text", "left")
    refuse_rows(joined.where("vector IS NULL"), "a text has no frozen embedding")
    return joined.select("page_id", "vector")


def scripted_answers(decisions: DataFrame) -> DataFrame:
    """decisions(cluster_id, role, attempt, output, delivery_error) -> (cluster_id, answers): JSON of each role's answers by attempt."""
    given = F.when(F.col("delivery_error").isNotNull(), F.to_json(F.struct("delivery_error"))).otherwise(F.coalesce("output", F.lit("null")))
    roles = decisions.groupBy("cluster_id", "role").agg(F.array_sort(F.collect_list(F.struct("attempt", given.alias("json")))).alias("a"))
    text = F.concat(F.lit('"'), "role", F.lit('":['), F.array_join(F.transform("a", lambda x: x["json"]), ","), F.lit("]"))
    return roles.groupBy("cluster_id").agg(F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(text)), ","), F.lit("}")).alias("answers"))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ContractError(message)
    return df


def _document(spark: SparkSession, path: str, shape: str) -> DataFrame:
    """The fields of one JSON document."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", shape, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def embedding_document(spark: SparkSession, path: str) -> DataFrame:
    """(text, vector) of a document of frozen embeddings."""
    return _document(spark, path, "embeddings map<string,array<double>>").select(F.explode("embeddings").alias("text", "vector"))


def decision_document(spark: SparkSession, path: str) -> DataFrame:
    """(page_ids, answers) of scripted decisions: the pages of a cluster, and each role's answers by attempt as JSON."""
    each = _document(spark, path, "clusters array<struct<page_ids:array<bigint>,responses:string>>").select(F.explode("clusters").alias("c"))
    return each.select(F.array_sort("c.page_ids").alias("page_ids"), F.col("c.responses").alias("answers"))


def narrative_document(spark: SparkSession, path: str) -> DataFrame:
    """(cluster_id, attempt, output, delivery_error) of scripted narratives."""
    each = _document(spark, path, "clusters array<struct<cluster_id:string,responses:array<string>>>").select(F.explode("clusters").alias("c"))
    tries = each.select("c.cluster_id", F.posexplode("c.responses").alias("at", "output"))
    lost = F.when(F.size(F.json_object_keys("output")) == 1, F.get_json_object("output", "$.delivery_error"))
    return tries.select("cluster_id", (F.col("at") + 1).cast("int").alias("attempt"), F.when(lost.isNull(), F.col("output")).alias("output"), lost.alias("delivery_error"))
