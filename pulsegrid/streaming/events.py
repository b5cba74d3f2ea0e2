"""Progress events: a log of JSON lines, read as a batch or a stream, with checks of order and public messages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from pulsegrid.contracts import EVENT_VERSION

EVENT_SCHEMA = "schema_version string, run_id string, sequence long, timestamp timestamp, module string, operation string, level string, message string, progress struct<current:long,total:long>, _broken string"
# What a level is called in public.
LEVELS = {"info": "update", "warning": "warning", "error": "failure"}
_IDENTIFIER = r"^[a-z0-9][a-z0-9-]{0,63}$"


def read_events(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Events of a folder of JSON lines; a line that is none comes with its text in _broken. A stream picks up new files."""
    reader = (spark.readStream if stream else spark.read).schema(EVENT_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken")
    return reader.json(path)


def after(events: DataFrame, sequence: int) -> DataFrame:
    """What a reader that has seen everything up to sequence still has to get."""
    return events.where(F.col("sequence") > sequence)


def neutral(events: DataFrame) -> DataFrame:
    """Broken lines as an event without content."""
    broken = F.col("_broken").isNotNull() if "_broken" in events.columns else F.lit(False)
    return events.withColumn("level", F.when(broken, "warning").otherwise(F.col("level"))).withColumn("message", F.when(broken, "an event could not be read").otherwise(F.col("message")))


def sequence_check(events: DataFrame, key: str = "run_id", sequence: str = "sequence") -> DataFrame:
    """(key, n_events, first, last, gaps, contiguous): whether a run's numbers go up by one from one."""
    step = F.col(sequence) - F.lag(sequence).over(Window.partitionBy(key).orderBy(sequence))
    out = events.select(key, sequence, step.alias("step")).groupBy(key).agg(F.count(F.lit(1)).alias("n_events"), F.min(sequence).alias("first"), F.max(sequence).alias("last"), F.count_if(F.col("step") != 1).alias("gaps"))
    return out.withColumn("contiguous", (F.col("gaps") == 0) & (F.col("first") == 1))


def global_sequence(events: DataFrame, stage_order: Column, run: str = "run_id") -> DataFrame:
    """events with global_sequence: their place in the run, by stage and by number within it."""
    return events.withColumn("global_sequence", F.row_number().over(Window.partitionBy(run).orderBy(stage_order, "sequence")))


def public_message(module: Column, operation: Column, level: Column) -> Column:
    """What the public reads instead of an event's own text; null where a part is not in form."""
    words = lambda c: F.replace(c, F.lit("-"), F.lit(" "))
    name = words(module)
    called = F.coalesce(*(F.when(level == k, v) for k, v in LEVELS.items()))
    capital = F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substring(name, F.lit(2), F.length(name))))
    text = F.concat(capital, F.lit(": "), words(operation), F.lit(" "), called, F.lit("."))
    return F.when(F.rlike(module, F.lit(_IDENTIFIER)) & F.rlike(operation, F.lit(_IDENTIFIER)), text)


def daily_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """(day, module, n) of a stream or batch of events, for events up to late behind the newest."""
    return events.withWatermark("timestamp", late).groupBy(F.window("timestamp", "1 day").alias("day"), "module").agg(F.count(F.lit(1)).alias("n")).select(F.to_date("day.start").alias("day"), "module", "n")


def shape_fault(expected_run: Column | None = None) -> Column:
    """Why an event of EVENT_SCHEMA has no proper shape; null for one that has."""
    identifier = lambda c: F.coalesce(F.rlike(c, F.lit(_IDENTIFIER)), F.lit(False))
    bounds = F.col("progress.current").isNotNull() & F.col("progress.total").isNotNull() & (F.col("progress.current") >= 0) & (F.col("progress.current") <= F.col("progress.total"))
    other_run = F.lit(False) if expected_run is None else ~F.col("run_id").eqNullSafe(expected_run)
    return (
        F.when(F.col("_broken").isNotNull(), "no event").when(~F.col("schema_version").eqNullSafe(F.lit(EVENT_VERSION)), "version").when(F.col("run_id").isNull() | other_run, "run").when(F.col("timestamp").isNull(), "timestamp")
        .when(F.col("sequence").isNull() | (F.col("sequence") < 1), "sequence").when(~identifier(F.col("module")) | ~identifier(F.col("operation")), "identifier")
        .when(~F.coalesce(F.col("level").isin(*LEVELS), F.lit(False)), "level").when(F.col("message").isNull(), "message").when(F.col("progress").isNotNull() & ~F.coalesce(bounds, F.lit(False)), "progress")
    )


def guarded(events: DataFrame, expected_run: Column | None = None) -> DataFrame:
    """(run_id, sequence, timestamp, module, operation, level, message, fault): events with what is wrong with each, null if nothing is.

    A run's numbers must go up in the order of its time stamps; only events of proper shape count for that, and a number
    that does not exceed all before it has the fault "order". A stream keeps a run's last number as state, so it goes on
    after a restart where it was, and tells the same faults as the batch, if its files arrive in the order of time.
    """
    fields = ("run_id", "sequence", "timestamp", "module", "operation", "level", "message")
    shaped = events.withColumn("fault", shape_fault(expected_run)).select(*fields, "fault")
    if not events.isStreaming:
        before = Window.partitionBy("run_id").orderBy("timestamp", "sequence").rowsBetween(Window.unboundedPreceding, -1)
        last = F.max(F.when(F.col("fault").isNull(), F.col("sequence"))).over(before)
        return shaped.withColumn("fault", F.coalesce("fault", F.when(F.col("sequence") <= last, "order")))

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values(["timestamp", "sequence"], kind="stable", na_position="first")
        (last,), faults = state.getOption or (0,), []
        for sequence, fault in zip(rows["sequence"], rows["fault"]):
            if fault is None and sequence <= last:
                fault = "order"
            elif fault is None:
                last = int(sequence)
            faults.append(fault)
        state.update((last,))
        yield rows.assign(fault=faults)

    return shaped.groupBy("run_id").applyInPandasWithState(step, shaped.schema, "last long", "append", "NoTimeout")
