"""Corpus pipeline: documents -> not toxic -> one of each near-duplicate group -> no benchmark passages -> mixture -> shards.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the
columns of documents; the last returns where each document goes. Which rows a stage takes out:

- toxicity: those the model, fitted on this corpus's labels, scores at its threshold or above;
- near_duplicates: those whose group of linked fingerprints has a smaller doc_id;
- benchmark: those that contain a window of a benchmark item;
- mixture: what the calibrated sample leaves out;
- shards: none.

Nulls, empty tables, repeated ids and further columns are treated as the operators say in their modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.functions.storage import kept
from pulsegrid.llm import decontaminate, mixing, sharding, simhash, toxicity
from pulsegrid.llm.common import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def draw_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("benchmark", drop_contaminated), ("mixture", draw_mixture), ("shards", place_in_shards)]

#: Training a network and hashing shingles are beyond SQL; the tests hold each stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what a stage returns is written to the shared folder and read again, so no stage is run twice."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
