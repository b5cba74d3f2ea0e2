"""Where intermediate results are kept: the shared checkpoint folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.contracts import ContractError

#: Keys up to this many may be broadcast (two longs each, about 64 MB hashed); beyond it the join shuffles.
BROADCAST_KEYS = 500_000
#: A key of more rows than this is joined by a broadcast of what is known of it, so that its rows stay where they are.
HEAVY = 1_000_000
#: Estimated bytes that a kept result may carry on into later plans; no table is that large.
MOST_BYTES = 2**256


def use_shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints that all machines see: the session's spark.checkpoint.dir, or a new local one where that is unset and the master is local (tests)."""
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or (known.get() if known.isDefined() else None)
    if not named:
        if not sc.master.startswith("local"):
            raise ContractError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="pulsegrid-checkpoints-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if not known.isDefined():
        sc.setCheckpointDir(named)
    return named


def _estimate(df: DataFrame) -> int:
    """Bytes that Spark's planner takes df for; -1 for more digits than Python reads."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except ValueError:
        return -1


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that a lost executor costs no more than its own tasks.

    A checkpoint keeps its plan's estimated size, and a join's is the product of both sides: in rounds that join what they
    kept, its digits double with each join until the driver's memory holds nothing else. Beyond MOST_BYTES it is dropped.
    """
    use_shared_dir(df.sparkSession)
    done = df.checkpoint(eager=True)
    if 0 <= _estimate(done) <= MOST_BYTES:
        return done
    rows = done._jdf.queryExecution().toRdd()
    return DataFrame(df.sparkSession._jsparkSession.internalCreateDataFrame(rows, done._jdf.schema(), False), df.sparkSession)


def swept(spark: SparkSession) -> None:
    """Has Spark delete now what nothing refers to any more: shuffles, and with cleanCheckpoints the checkpoints of earlier rounds, which else stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to a table of its own in the shared folder: like cut, but columnar and compressed, for wider or longer results."""
    spark = df.sparkSession
    path = f"{use_shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)  # it is of use to this application alone
    return spark.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str) -> tuple:
    """The path and its file system, in whatever store Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _at(spark, path)
    return store.exists(where)


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of one small file."""
    where, store = _at(spark, path)
    stream = store.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> None:
    """One small file that holds all of text or stays as it was; without replace an existing one is an error."""
    where, store = _at(spark, path)
    part, _ = _at(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = store.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if replace:
        store.delete(where, False)
    if store.exists(where) or not store.rename(part, where):
        store.delete(part, False)
        raise ContractError(f"{path.rpartition('/')[2]} exists")


def small_or_shuffled(keys: DataFrame, limit: int = BROADCAST_KEYS) -> DataFrame:
    """keys (kept, counted) with a broadcast hint if they are no more than limit; else as they are, for a shuffled join."""
    kept = cut(keys)
    return F.broadcast(kept) if kept.count() <= limit else kept


def joined_to_facts(rows: DataFrame, facts: DataFrame, on: str | list[str], weight: str, heavy: int = HEAVY) -> DataFrame:
    """rows joined to facts (kept by the caller), one for each value of on, that say in weight how many of the rows have it.

    Values of more than heavy rows would each meet in one task: their facts, at most one in heavy rows, are broadcast instead.
    """
    on = [on] if isinstance(on, str) else on
    most = facts.where(F.col(weight) > heavy)
    if most.isEmpty():
        return rows.join(facts, on)
    few = rows.join(F.broadcast(most.select(*on)), on, "left_anti").join(facts.where(F.col(weight) <= heavy), on)
    return few.unionByName(rows.join(F.broadcast(most), on))
