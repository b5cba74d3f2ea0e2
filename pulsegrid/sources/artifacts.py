"""Evidence of a finished run as a source: whose it is, the shape of its tables, and what must hold of their rows.

Columns and types of every table must be those of EVIDENCE. What is wrong with rows is told as rows (part, key, fault),
one for each row that breaks a rule (the first rule it breaks) and for each key that is missing or repeated; a reader
refuses the artifact if there is one. An empty table of pages or observations is fine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsegrid.contracts import ARTIFACT_VERSION, ContractError
from pulsegrid.operators import ledger
from pulsegrid.operators.evidence import LEAD_CHARACTERS, MINIMUM_DAYS

EVIDENCE = {
    "days": "date date, window string, status string",
    "cutoffs": "date date, cutoff long",
    "pages": "page_id long, canonical_title string, aliases array<string>, lead string, categories array<string>",
    "observations": "page_id long, date date, views_ceil long",
    "exclusions": "unavailable long, main_page long, other_project long, technical_namespaces map<string,long>",
}
_ENVELOPE = "schema_version string, run_id string, stage string, status string, fingerprint string"


def scan_envelopes(spark: SparkSession, paths: str | list[str], run_id: str | None = None, stage: str | None = None) -> DataFrame:
    """(path, run_id, stage, fingerprint, fault) of the artifacts whose envelopes are named (patterns allowed); fault is null for one that may be read by this run as this stage."""
    rows = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", _ENVELOPE).alias("e"))
    other = lambda c, name: F.lit(False) if c is None else ~F.col(name).eqNullSafe(F.lit(c))
    unreadable = F.col("e").isNull() | F.col("e.run_id").isNull() | F.col("e.stage").isNull() | F.col("e.fingerprint").isNull()
    fault = F.when(unreadable, "unreadable").when(~F.col("e.status").eqNullSafe(F.lit("complete")), "incomplete").when(~F.col("e.schema_version").eqNullSafe(F.lit(ARTIFACT_VERSION)), "version").when(other(run_id, "e.run_id"), "run").when(other(stage, "e.stage"), "stage")
    return rows.select("path", "e.run_id", "e.stage", "e.fingerprint", fault.alias("fault"))


def require_shape(tables: dict[str, DataFrame]) -> None:
    """Raise where a table is missing or has other columns or types; their order and further tables do not matter."""
    for name, shape in EVIDENCE.items():
        if name not in tables:
            raise ContractError(f"evidence lacks {name}")
        told = lambda s: {f.name: f.dataType.simpleString() for f in s}
        if told(tables[name].schema) != told(StructType.fromDDL(shape)):
            raise ContractError(f"evidence is schema-incompatible: {name}")


def _set(column: str) -> Column:
    """Whether an array is one of different values, none of them null."""
    c = F.col(column)
    return F.coalesce((F.size(F.array_distinct(c)) == F.size(c)) & ~F.exists(c, lambda x: x.isNull()), F.lit(False))


def _broken(part: str, rows: DataFrame, key: Column, *rules: tuple[Column, str]) -> DataFrame:
    fault = F.coalesce(*(F.when(~F.coalesce(holds, F.lit(False)), name) for holds, name in rules))
    return rows.select(F.lit(part).alias("part"), key.cast("string").alias("key"), fault.alias("fault")).where("fault IS NOT NULL")


def _repeated(part: str, rows: DataFrame, key: Column) -> DataFrame:
    return rows.groupBy(key.cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND key IS NOT NULL").select(F.lit(part).alias("part"), "key", F.lit("repeated").alias("fault"))


def evidence_faults(tables: dict[str, DataFrame]) -> DataFrame:
    """(part, key, fault) over the tables of EVIDENCE; none for evidence that later stages may use."""
    days, pages, seen = tables["days"], tables["pages"], tables["observations"]
    by_date = Window.orderBy("date")  # fifteen rows at most; how many days there are is told beside it
    placed = days.orderBy("date").limit(15).withColumn("place", F.row_number().over(by_date)).withColumn("gap", F.datediff("date", F.lag("date").over(by_date)))
    half = F.when(F.col("place") <= 7, "previous").otherwise("current")
    used = days.groupBy("window").agg(F.count_if(F.col("status") == "successful").alias("successful"))
    ok = days.where("status = 'successful'").select("date").distinct().withColumn("ok", F.lit(True))
    known = pages.select("page_id").distinct().withColumn("known", F.lit(True))
    place = F.concat_ws("/", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.coalesce(F.col("date").cast("string"), F.lit("null")))
    cutoffs = tables["cutoffs"]
    counters = [c for c in StructType.fromDDL(EVIDENCE["exclusions"]).names if c != "technical_namespaces"]
    counted = reduce(lambda a, c: a & (F.col(c) >= 0), counters, F.coalesce(F.forall(F.map_values("technical_namespaces"), lambda n: n >= 0), F.lit(False)))
    found = [
        _broken("days", placed, F.col("date"), (F.col("date").isNotNull(), "date"), (F.coalesce(F.col("gap"), F.lit(1)) == 1, "gap"), (F.col("window") == half, "window"), (F.col("status").isin("successful", "unavailable"), "status")),
        _broken("days", days.agg(F.count(F.lit(1)).alias("n")), F.col("n"), (F.col("n") == 14, "number of days")),
        _broken("days", used, F.col("window"), (F.col("successful") >= MINIMUM_DAYS, "coverage")),
        _broken("pages", pages, F.col("page_id"), (F.col("page_id").isNotNull(), "page_id"), (F.length("canonical_title") > 0, "title"), (F.length("lead") <= LEAD_CHARACTERS, "lead"), (_set("aliases") & (F.size("aliases") > 0), "aliases"), (_set("categories"), "categories")),
        _repeated("pages", pages, F.col("page_id")),
        _broken("observations", seen.join(known, "page_id", "left").join(ok, "date", "left"), place, (F.col("known"), "page"), (F.col("ok"), "day"), (F.col("views_ceil") >= 0, "views")),
        _repeated("observations", seen, place),
        _broken("cutoffs", cutoffs.join(ok, "date", "left"), F.col("date"), (F.col("ok"), "day"), (F.col("cutoff").isNull() | (F.col("cutoff") >= 0), "cutoff")),
        _repeated("cutoffs", cutoffs, F.col("date")),
        ok.join(cutoffs, "date", "left_anti").select(F.lit("cutoffs").alias("part"), F.col("date").cast("string").alias("key"), F.lit("missing").alias("fault")),
        _broken("exclusions", tables["exclusions"], F.lit("counters"), (counted, "counter")),
        _broken("exclusions", tables["exclusions"].agg(F.count(F.lit(1)).alias("n")), F.col("n"), (F.col("n") == 1, "number of rows")),
    ]
    return reduce(DataFrame.unionAll, found)


def require_evidence(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables, whose shape and rows must be in order."""
    require_shape(tables)
    if (wrong := evidence_faults(tables).first()) is not None:
        raise ContractError(f"evidence is not in order: {wrong['part']} {wrong['key']} ({wrong['fault']})")
    return tables


def read_evidence(spark: SparkSession, folder: str, run_id: str) -> tuple[dict, dict[str, DataFrame]]:
    """The envelope and tables of the complete evidence of this run; anything else is refused."""
    found = ledger.read_stage(spark, folder, run_id, "evidence")
    if found is None:
        raise ContractError("evidence artifact is absent")
    return found[0], require_evidence(found[1])
