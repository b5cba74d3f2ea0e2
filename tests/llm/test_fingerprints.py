"""Canonical digests against a plain version, with and without collisions."""

import hashlib
import re
import unicodedata

import pytest
import xxhash

from pulsegrid.llm import fingerprints as f


def canon(text):
    n = lambda s: unicodedata.normalize("NFKC", s)
    return re.sub(f.BLANKS, " ", n(n(text or "").casefold())).strip(" ")


def digest(text):
    c = canon(text).encode()
    return f"{xxhash.xxh64_intdigest(c, 42):016x}{xxhash.xxh64_intdigest(c, xxhash.xxh64_intdigest(b'second lane', 42)):016x}"


def check(df, bits=64):
    out = sorted(map(tuple, f.neighbour_report(df, bits).select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next").collect()), key=repr)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    wanted = []
    for i, (d, t) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        wanted.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), float(canon(t) == canon(edited)), float(canon(t) == canon(after))))
    assert out == sorted(wanted, key=repr)


def test_awkward_rows(awkward, nothing):
    check(awkward)
    assert f.neighbour_report(nothing).count() == 0


def test_ids_far_apart(spark):
    rows = [(d, f"text {d % 3}") for d in (-(1 << 62), -70_000, -1, 0, 255, 256, 257, 65_535, 65_536, 1 << 24, (1 << 24) + 1, 1 << 40, (1 << 62) + 5)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize("bits", [1, 3])
def test_collisions_are_told_apart(spark, bits):
    rows = [(i, f"Text {i // 2}") for i in range(40)] + [(100, "TEXT  3")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, bits)
    marked = f.fingerprint(df, bits=bits).collect()
    assert len({r["fingerprint"] for r in marked}) == len({canon(r["text"]) for r in marked})
    groups = f.exact_groups(df, bits=bits).collect()
    assert sorted(r["keeper"] for r in groups) == list(range(0, 40, 2)) and max(r["copies"] for r in groups) == 3


def test_value(spark):
    df = spark.createDataFrame([(1, "ﬁne  Straße É"), (2, " FINE STRASSE É "), (3, None)], "doc_id long, text string")
    out = [r["fingerprint"] for r in f.fingerprint(df).orderBy("doc_id").collect()]
    assert out == [digest("ﬁne Straße É"), digest("fine strasse é"), digest("")] and out[0] == out[1]


def test_other_columns_stay(awkward):
    assert set(awkward.columns) < set(f.fingerprint(awkward).columns) and f.fingerprint(awkward).count() == awkward.count()


def test_no_python_in_the_plan(spark, small):
    plan = f.neighbour_report(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
