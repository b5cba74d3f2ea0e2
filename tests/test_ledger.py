"""Fingerprints, resumed units and stage artifacts: what is proved stays, what was touched is refused."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError
from pulsegrid.functions import digests
from pulsegrid.operators import ledger as x

CONFIGURATION = "sha256:one"


def root(df):
    return tuple(digests.table_fingerprint(df).first())


def test_fingerprint_is_of_the_rows(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("name"), F.array("id").alias("list"))
    first = root(df)
    assert first[0] == 5000
    assert root(df.repartition(7, "name").select("list", "name", "id")) == first
    changed = df.withColumn("name", F.when(F.col("id") == 17, "x").otherwise(F.col("name")))
    assert len({first, root(changed), root(df.where("id > 0")), root(df.unionAll(df.limit(1))), root(df.limit(0)), root(df.withColumnRenamed("name", "n"))}) == 6
    many = spark.range(3000).select(F.lit("same").alias("name"))
    assert root(many)[0] == 3000 and root(many) != root(many.limit(2999))


def units(spark, n, given="g"):
    return spark.range(1, n + 1).select(F.col("id").alias("sequence"), F.concat(F.lit("unit-"), "id").alias("unit"), F.concat(F.lit(given), "id").alias("given"))


class Work:
    """Counts the units that it is asked for, and stops before one of them."""

    def __init__(self, stop=None):
        self.asked, self.stop = [], stop

    def __call__(self, df):
        own = [r[0] for r in df.select("sequence").collect()]
        if self.stop in own:
            raise InterruptedError("killed")
        self.asked += own
        return df.select("sequence", F.concat(F.lit("result of "), "unit").alias("body"))


def book(spark, folder, configuration=CONFIGURATION, run_id="run-1"):
    return x.Ledger(spark, str(folder), run_id, configuration)


def told(df):
    return sorted(tuple(r) for r in df.collect())


def test_resumes_after_the_verified_prefix(spark, tmp_path):
    first = Work(stop=6)
    with pytest.raises(InterruptedError):
        book(spark, tmp_path).complete(units(spark, 9), first, 2)
    assert sorted(first.asked) == [1, 2, 3, 4]
    again = Work()
    done = book(spark, tmp_path).complete(units(spark, 9), again, 2)
    assert sorted(again.asked) == [5, 6, 7, 8, 9]
    assert told(done) == sorted((i, f"unit-{i}", f"g{i}", f"result of unit-{i}") for i in range(1, 10))
    once_more = Work()
    book(spark, tmp_path).complete(units(spark, 9), once_more, 2)
    assert once_more.asked == []
    assert told(book(spark, tmp_path / "none").complete(units(spark, 0), Work(), 2)) == []


def test_a_segment_without_commit_never_happened(spark, tmp_path):
    book(spark, tmp_path).complete(units(spark, 4), Work(), 2)
    (tmp_path / "commits" / "00000002.json").unlink()
    again = Work()
    assert len(told(book(spark, tmp_path).complete(units(spark, 4), again, 2))) == 4
    assert sorted(again.asked) == [3, 4]


def tampered(folder, number, **changes):
    path = Path(folder) / "commits" / f"{number:08d}.json"
    path.write_text(json.dumps(json.loads(path.read_text()) | changes))
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("fault", ["body", "chain", "gap", "segment", "run", "configuration", "unit", "given", "shorter", "foreign", "broken"])
def test_refuses_what_was_touched(spark, tmp_path, fault):
    book(spark, tmp_path).complete(units(spark, 6), Work(), 2)
    commit = json.loads((tmp_path / "commits" / "00000002.json").read_text())
    segment, asked, own = str(tmp_path / "units" / commit["segment"]), units(spark, 8), book(spark, tmp_path)
    rows = [tuple(r) for r in spark.read.parquet(segment).collect()]
    if fault == "body":
        spark.createDataFrame([(*r[:3], "other") for r in rows], x.UNIT).write.mode("overwrite").parquet(segment)
    elif fault == "shorter":
        spark.createDataFrame(rows[:1], x.UNIT).write.mode("overwrite").parquet(segment)
    elif fault == "chain":
        tampered(tmp_path, 2, root="sha256:other")
    elif fault == "gap":
        (tmp_path / "commits" / "00000001.json").rename(tmp_path / "commits" / "00000009.json")
        (tmp_path / "commits" / "00000002.json").rename(tmp_path / "commits" / "00000001.json")
        for crc in (tmp_path / "commits").glob(".*.crc"):
            crc.unlink()
    elif fault == "segment":
        Path(segment).rename(tmp_path / "elsewhere")
    elif fault == "run":
        own = book(spark, tmp_path, run_id="run-2")
    elif fault == "configuration":
        own = book(spark, tmp_path, "sha256:two")
    elif fault == "unit":
        asked = asked.withColumn("unit", F.when(F.col("sequence") == 3, "another").otherwise(F.col("unit")))
    elif fault == "given":
        asked = units(spark, 8, "changed")
    elif fault == "foreign":
        asked = units(spark, 5)
    else:
        (tmp_path / "commits" / "00000002.json").write_text("{")
        (tmp_path / "commits" / ".00000002.json.crc").unlink(missing_ok=True)
    work = Work()
    with pytest.raises(ContractError):
        own.complete(asked, work, 2)
    assert work.asked == []


def test_units_must_continue(spark, tmp_path):
    own = book(spark, tmp_path)
    for rows in ([(2, "b", "g", "x")], [(1, "a", "g", "x"), (1, "a", "g", "y")], [(1, "a", "g", "x"), (3, "c", "g", "y")], []):
        with pytest.raises(ContractError):
            own.append(spark.createDataFrame(rows, x.UNIT))
    assert own.append(spark.createDataFrame([(1, "a", "g", "x")], x.UNIT)) == 1


def stage(spark, folder, **other):
    tables = {"rows": spark.range(10).select("id", F.lit("v").alias("value")), "none": spark.range(0)}
    return x.write_stage(spark, str(folder), "run-1", "formation", {"threshold": 0.5}, {"evidence": "sha256:e"}, tables | other)


def test_stage_artifacts(spark, tmp_path):
    assert x.read_stage(spark, str(tmp_path), "run-1", "formation") is None
    written = stage(spark, tmp_path)
    document, tables = x.read_stage(spark, str(tmp_path), "run-1", "formation", {"threshold": 0.5}, {"evidence": "sha256:e"})
    assert document == written and tables["rows"].count() == 10 and tables["none"].columns == ["id"]
    with pytest.raises(ContractError):
        stage(spark, tmp_path)  # there is one
    for arguments in (("run-2", "formation"), ("run-1", "evidence"), ("run-1", "formation", {"threshold": 0.6}), ("run-1", "formation", None, {"evidence": "sha256:other"})):
        with pytest.raises(ContractError):
            x.read_stage(spark, str(tmp_path), *arguments)


@pytest.mark.parametrize("fault", ["row", "table", "status", "schema", "version", "text", "upstream"])
def test_refuses_malformed_stages(spark, tmp_path, fault):
    document = stage(spark, tmp_path)
    path, rows = tmp_path / "artifact.json", str(tmp_path / document["tables"]["rows"]["path"])
    if fault == "row":
        spark.range(1, 11).select("id", F.lit("v").alias("value")).write.mode("overwrite").parquet(rows)
    elif fault == "table":
        Path(rows).rename(tmp_path / "elsewhere")
    else:
        if fault == "schema":
            document["tables"]["rows"]["schema"] = spark.range(0).schema.json()
        document |= {"status": {"status": "partial"}, "version": {"schema_version": "1.0"}, "upstream": {"upstream": {}}}.get(fault, {})
        path.write_text("[" if fault == "text" else json.dumps(document))
        (tmp_path / ".artifact.json.crc").unlink(missing_ok=True)
    with pytest.raises(ContractError):
        x.read_stage(spark, str(tmp_path), "run-1", "formation")
