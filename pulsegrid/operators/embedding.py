"""Embeddings made in the run: every different text is encoded once, and kept by its digest for all later runs.

The encoder is a factory that a Python worker calls once and that returns a function from an array of texts to a
matrix with a row for each. What is kept is a table for each model in the store's folder; encoding appends to it, so
what was written is never written again, and a run that was stopped goes on with the texts that are not there.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from pulsegrid.contracts import refuse_rows, safe_identifier
from pulsegrid.functions.storage import exists, kept

Encoder = Callable[[], Callable[[np.ndarray], np.ndarray]]
#: Texts that an encoder gets at once.
BATCH = 64
STORED = "digest string, vector array<double>"


def letter_counts() -> Callable[[np.ndarray], np.ndarray]:
    """A plain encoder that needs no model: how often each of the letters a to z occurs, case folded in ASCII."""
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]

    def encode(texts: np.ndarray) -> np.ndarray:
        return np.array([[t.count(x) + t.count(x.upper()) for x in letters] for t in texts.tolist()], np.float64).reshape(len(texts), len(letters))

    return encode


def _stored(texts: DataFrame, folder: str) -> DataFrame:
    spark = texts.sparkSession
    return spark.read.schema(STORED).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], STORED)


def embed(texts: DataFrame, store: str, model: str, encoder: Encoder, batch: int = BATCH) -> tuple[DataFrame, int]:
    """texts(text) -> (text, vector) of its different texts, and how many of them had to be encoded. Null texts have none.

    An encoder that gives no vector for a text, or one that is empty or not finite, is an error, and nothing of that call is kept.
    """
    folder = f"{store.rstrip('/')}/{safe_identifier(model, 'model')}"
    asked = kept(texts.where("text IS NOT NULL").select("text").distinct().withColumn("digest", F.sha2("text", 256)), "texts")
    new = asked.join(_stored(texts, folder).select("digest"), "digest", "left_anti")
    encode = predict_batch_udf(encoder, return_type=ArrayType(DoubleType()), batch_size=batch)
    made = kept(new.select("digest", encode("text").alias("vector")), "vectors")
    fine = (F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    refuse_rows(made.where(~F.coalesce(fine, F.lit(False))), "an encoder gave no finite vector for a text")
    encoded = made.count()
    if encoded:
        made.write.mode("append").parquet(folder)
    known = _stored(texts, folder).dropDuplicates(["digest"])  # two runs at once may both have encoded a text
    found = asked.join(known, "digest", "left")
    refuse_rows(found.where("vector IS NULL"), "a text has no embedding")
    return found.select("text", "vector"), encoded
