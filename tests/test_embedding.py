"""Texts are encoded once; what an encoder fails to give is refused."""

import numpy as np
import pytest

from pulsegrid.contracts import ContractError
from pulsegrid.operators import embedding


def told(rows):
    return {r["text"]: r["vector"] for r in rows.collect()}


def test_each_text_is_encoded_once(spark, tmp_path):
    texts = ["Aab", "zebra", "", "Aab", None, "ß"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    found, n = embedding.embed(df, str(tmp_path), "letters", embedding.letter_counts, 2)
    must = {t: [float(t.lower().count(chr(c))) if t != "ß" else 0.0 for c in range(97, 123)] for t in texts if t is not None}
    assert told(found) == must and n == 4
    again, n = embedding.embed(df, str(tmp_path), "letters", embedding.letter_counts)
    assert told(again) == must and n == 0
    more, n = embedding.embed(df.unionAll(spark.createDataFrame([("new",)], "text string")), str(tmp_path), "letters", embedding.letter_counts)
    assert n == 1 and told(more).keys() == must.keys() | {"new"}
    assert embedding.embed(df, str(tmp_path), "other", embedding.letter_counts)[1] == 4
    assert embedding.embed(df.limit(0), str(tmp_path), "letters", embedding.letter_counts)[1] == 0


def test_vectors_that_are_none(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "text string")
    broken = lambda: lambda texts: np.full((len(texts), 2), np.nan)
    with pytest.raises(ContractError):
        embedding.embed(df, str(tmp_path), "m", broken)
    assert embedding.embed(df, str(tmp_path), "m", embedding.letter_counts)[1] == 1  # nothing was kept
    with pytest.raises(ContractError):
        embedding.embed(df, str(tmp_path), "../m", embedding.letter_counts)
