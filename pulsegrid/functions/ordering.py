"""Places in one order over all rows, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.storage import kept


def placed(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """df with name: each row's place, from 1, in an order that no two rows share.

    Spark samples the order and cuts it into ranges of about the same number of rows, whatever prefix they have in
    common. Ranges are ranked by themselves and begin where the ranges before them end, which one row a range tells.
    """
    cut_up = kept(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = cut_up.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("__range", F.coalesce(F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    inside = cut_up.withColumn("__place", F.row_number().over(Window.partitionBy("__range").orderBy(*order)))
    return inside.join(F.broadcast(before), "__range").withColumn(name, F.col("__before") + F.col("__place")).drop("__range", "__before", "__place")


def best(df: DataFrame, most: int, *order: Column | str, name: str = "rank") -> DataFrame:
    """The first rows of an order with their places: each task hands on most rows at most, and only these are ranked together."""
    return df.orderBy(*order).limit(most).withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
