"""Places in an order, the guard over progress events in batch and stream, delays before another try."""

import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.ordering import best, placed
from pulsegrid.operators import adjudication
from pulsegrid.streaming import events


def test_places(spark):
    df = spark.range(3000).select(F.concat(F.lit("same prefix "), F.pmod(F.xxhash64("id"), F.lit(500)).cast("string")).alias("name"), "id").repartition(7)
    must = {r["id"]: n for n, r in enumerate(sorted(df.collect(), key=lambda r: (r["name"], r["id"])), start=1)}
    assert {r["id"]: r["rank"] for r in placed(df, "name", "id").collect()} == must
    assert {r["id"]: r["rank"] for r in best(df, 10, "name", "id").collect()} == {i: n for i, n in must.items() if n <= 10}
    assert placed(df.limit(0), "name").count() == 0


def lines():
    fine = {"schema_version": "1.0", "run_id": "r", "timestamp": "2026-01-01T00:00:00Z", "module": "stage", "operation": "load", "level": "info", "message": "m"}
    told = lambda n, **more: json.dumps(fine | {"sequence": n, "timestamp": f"2026-01-01T00:00:{n:02d}Z"} | more)
    first = [told(1), told(2, progress={"current": 1, "total": 2}), told(3, level="loud"), told(4, run_id="q", schema_version="2.0"), told(5, run_id="q", sequence=1), "{broken"]
    second = [told(10, sequence=2), told(11, sequence=3), told(12, sequence=9, progress={"current": 3, "total": 2}), told(13, sequence=4, module="No Such"), told(14, sequence=5), told(15, sequence=5), told(16, run_id="q", sequence=1)]
    third = [told(20, sequence=5), told(21, sequence=6), told(22, run_id="q", sequence=2), told(23, sequence=None), told(24, message=None)]
    return first, second, third


FAULTS = ["no event", "level", "version", "order", "progress", "identifier", "order", "order", "order", "sequence", "message"]


def test_guard_in_batch_and_stream(spark, tmp_path):
    parts, found = lines(), []
    (tmp_path / "log").mkdir()
    for n, part in enumerate(parts):  # every start is a new one from the checkpoint
        (tmp_path / "log" / f"{n}.json").write_text("\n".join(part))
        stream = events.guarded(events.read_events(spark, str(tmp_path / "log"), stream=True))
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None
    batch = events.guarded(events.read_events(spark, str(tmp_path / "log")))
    found = [sorted(map(str, df.select("run_id", "sequence", "timestamp", "fault").collect())) for df in (spark.read.parquet(str(tmp_path / "out")), batch)]
    assert found[0] == found[1] and len(found[0]) == sum(map(len, parts))
    assert sorted(r["fault"] for r in batch.where("fault IS NOT NULL").collect()) == sorted(FAULTS)
    assert [r["sequence"] for r in batch.where("fault IS NULL AND run_id = 'r'").orderBy("sequence").collect()] == [1, 2, 3, 5, 6]


def test_other_runs_are_refused(spark, tmp_path):
    (tmp_path / "log.json").write_text("\n".join(lines()[0]))
    found = events.guarded(events.read_events(spark, str(tmp_path / "log.json")), F.lit("r")).where("fault = 'run'")
    assert [r["run_id"] for r in found.collect()] == ["q"]  # the other one has no version


@pytest.mark.parametrize(("error", "delay"), [
    (("Error", None, "boom", None, 1), None), (("RateLimitError", None, "x", "2.5", 1), 2.6), (("Error", 429, "x", "-3", 1), 0.1), (("Error", 429, "x", "soon", 1), 1.0), (("Error", None, "Error code: 429 TRY AGAIN IN 250 ms", None, 1), 0.35),
    (("Error", 429, "try again in 7s", None, 2), 7.1), (("RateLimitError", None, None, None, 3), 4.0), (("RateLimitError", None, "", None, 9), 30.0), ((None, None, None, None, 1), None),
])
def test_retry_delay(spark, error, delay):
    df = spark.createDataFrame([error], "type string, status int, message string, header string, attempt int")
    found = df.select(adjudication.retry_delay(F.col("type"), F.col("status"), F.col("message"), F.col("header"), F.col("attempt"), F.lit(0.0))).first()[0]
    assert found == delay if delay is None else abs(found - delay) < 1e-9
