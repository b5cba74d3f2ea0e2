"""What a run has finished and can prove: an append-only ledger of units, and stage artifacts.

A ledger holds the finished units of one kind of work (reviewed clusters, narrated trends) in segments. A segment is
written first; what makes it count is its commit, a small file that cannot be overwritten and that names the
segment's place in the sequence, its fingerprint and the commit before it. Whoever resumes recomputes all of that: a
prefix with a changed, missing, repeated or foreign unit is refused, a segment without a commit never happened.

A stage artifact is a folder of tables and an envelope that says whose they are (version, run, stage, configuration,
the artifacts it was made from) and what they are (columns, rows, fingerprint). The envelope appears last.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsegrid.contracts import ARTIFACT_VERSION, ContractError, safe_identifier
from pulsegrid.functions.digests import table_fingerprint
from pulsegrid.functions.storage import exists, put_text, read_text
from pulsegrid.operators.publish import canonical_json, fingerprint

UNIT = "sequence long, unit string, given string, body string"


def _facts(df: DataFrame) -> tuple[int, str]:
    return tuple(table_fingerprint(df).first())


@dataclass(frozen=True)
class Ledger:
    """The finished units of one kind of work of one run."""

    spark: SparkSession
    folder: str
    run_id: str
    configuration: str

    def _commit(self, number: int) -> str:
        return f"{self.folder}/commits/{number:08d}.json"

    def commits(self) -> list[dict]:
        """The commits in order, a row for each batch of units; a broken, foreign or missing one is an error."""
        found, before = [], ""
        while exists(self.spark, self._commit(len(found) + 1)):
            try:
                c = json.loads(read_text(self.spark, self._commit(len(found) + 1)))
                chain = c.pop("chain")
                first = found[-1]["last"] + 1 if found else 1
                fine = chain == fingerprint(c) and c["before"] == before and (c["number"], c["first"]) == (len(found) + 1, first) and c["last"] - first + 1 == c["n"] > 0 and "/" not in c["segment"]
            except (ValueError, KeyError, TypeError, AttributeError) as e:
                raise ContractError("checkpoint cannot be read") from e
            if not fine:
                raise ContractError("checkpoint is not a chain of commits")
            if (c["run_id"], c["configuration"]) != (self.run_id, self.configuration):
                raise ContractError("checkpoint conflicts with the requested configuration")
            found.append(c | {"chain": chain})
            before = chain
        return found

    def _segment(self, name: str) -> DataFrame:
        return self.spark.read.schema(UNIT).parquet(f"{self.folder}/units/{name}")

    def append(self, rows: DataFrame) -> int:
        """Write the next units (sequence, unit, given, body) and commit them; how many there are."""
        known = self.commits()
        name = uuid.uuid4().hex
        rows.select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in UNIT.split(", "))).write.parquet(f"{self.folder}/units/{name}")
        written = self._segment(name)
        n, root = _facts(written)
        first, last, distinct = written.agg(F.min("sequence"), F.max("sequence"), F.countDistinct("sequence")).first()
        expected = known[-1]["last"] + 1 if known else 1
        if not n or first != expected or last - first + 1 != n or distinct != n:
            raise ContractError("units do not continue the sequence")
        commit = {"number": len(known) + 1, "run_id": self.run_id, "configuration": self.configuration, "segment": name, "first": first, "last": last, "n": n, "root": root, "before": known[-1]["chain"] if known else ""}
        put_text(self.spark, self._commit(len(known) + 1), canonical_json(commit | {"chain": fingerprint(commit)}) + "\n", replace=False)
        return n

    def prefix(self) -> DataFrame:
        """The finished units; every segment must still be what was committed."""
        found = None
        for c in self.commits():
            if not exists(self.spark, f"{self.folder}/units/{c['segment']}"):
                raise ContractError("a committed unit is missing")
            rows = self._segment(c["segment"])
            n, root = _facts(rows)
            lowest, highest = rows.agg(F.min("sequence"), F.max("sequence")).first()
            if (n, root, lowest, highest) != (c["n"], c["root"], c["first"], c["last"]):
                raise ContractError("a committed unit was changed")
            found = rows if found is None else found.unionAll(rows)
        return self.spark.createDataFrame([], UNIT) if found is None else found

    def complete(self, units: DataFrame, work: Callable[[DataFrame], DataFrame], batch: int, told: Callable[[int, int], object] = lambda done, total: None) -> DataFrame:
        """units (sequence from 1, unit, given, ...) -> (sequence, unit, given, body) of all of them.

        given is a digest of what the unit is made from. Units of the verified prefix are not worked on again; they must
        be those asked for now. work gets the units of one batch and returns (sequence, body). A batch is committed
        before the next begins; told is called with how many are committed and how many there are.
        """
        done = self.prefix()
        asked = units.select("sequence", F.col("unit").alias("unit_now"), F.col("given").alias("given_now"))
        foreign = done.join(asked, "sequence", "left").where("NOT (unit <=> unit_now AND given <=> given_now)")
        if not foreign.isEmpty():
            raise ContractError("checkpoint provenance is invalid")
        last = done.agg(F.coalesce(F.max("sequence"), F.lit(0))).first()[0]
        total = units.agg(F.coalesce(F.max("sequence"), F.lit(0))).first()[0]
        for first in range(last + 1, total + 1, batch):
            own = units.where(F.col("sequence").between(first, min(total, first + batch - 1)))
            n = self.append(own.select("sequence", "unit", "given").join(work(own).select("sequence", "body"), "sequence"))
            told(first + n - 1, total)
        return self.prefix()


def _envelope(folder: str) -> str:
    return f"{folder}/artifact.json"


def write_stage(spark: SparkSession, folder: str, run_id: str, stage: str, configuration: dict, upstream: dict[str, str], tables: dict[str, DataFrame]) -> dict:
    """The stage's tables under folder, then its envelope; the envelope is returned."""
    part, told = uuid.uuid4().hex, {}
    for name, df in tables.items():
        path = f"{safe_identifier(name, 'table')}-{part}"
        df.write.parquet(f"{folder}/{path}")
        n, root = _facts(spark.read.schema(df.schema).parquet(f"{folder}/{path}"))
        told[name] = {"path": path, "schema": df.schema.json(), "n": n, "fingerprint": root}
    document = {"schema_version": ARTIFACT_VERSION, "run_id": safe_identifier(run_id, "run_id"), "stage": safe_identifier(stage, "stage"), "status": "complete", "configuration": configuration, "upstream": upstream, "tables": told}
    document["fingerprint"] = fingerprint({k: document[k] for k in ("run_id", "stage", "configuration", "upstream")} | {"tables": {n: (t["schema"], t["n"], t["fingerprint"]) for n, t in told.items()}})
    put_text(spark, _envelope(folder), canonical_json(document) + "\n", replace=False)
    return document


def read_stage(spark: SparkSession, folder: str, run_id: str, stage: str, configuration: dict | None = None, upstream: dict[str, str] | None = None) -> tuple[dict, dict[str, DataFrame]] | None:
    """The envelope and tables of a complete stage of this run, all verified; None where there is no envelope."""
    if not exists(spark, _envelope(folder)):
        return None
    try:
        document = json.loads(read_text(spark, _envelope(folder)))
        told = document["tables"]
        whole = fingerprint({k: document[k] for k in ("run_id", "stage", "configuration", "upstream")} | {"tables": {n: (t["schema"], t["n"], t["fingerprint"]) for n, t in told.items()}})
        own = (document["schema_version"], document["run_id"], document["stage"], document["status"], document["fingerprint"])
    except (ValueError, KeyError, TypeError, AttributeError) as e:
        raise ContractError(f"{stage} artifact cannot be read") from e
    if own != (ARTIFACT_VERSION, run_id, stage, "complete", whole):
        raise ContractError(f"{stage} artifact is not a complete one of this run and stage")
    if configuration is not None and document["configuration"] != configuration or upstream is not None and document["upstream"] != upstream:
        raise ContractError(f"{stage} artifact conflicts with the requested configuration")
    tables = {}
    for name, t in told.items():
        if not exists(spark, f"{folder}/{t['path']}"):
            raise ContractError(f"{stage} artifact lacks {name}")
        df = spark.read.schema(StructType.fromJson(json.loads(t["schema"]))).parquet(f"{folder}/{t['path']}")
        if _facts(df) != (t["n"], t["fingerprint"]):
            raise ContractError(f"{stage} artifact: {name} was changed")
        tables[name] = df
    return document, tables
