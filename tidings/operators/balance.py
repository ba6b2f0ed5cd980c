"""Rows dealt to tasks by cost: each task gets about the same sum, the costliest rows first.

Used before a fold of windows (M3), where one mail of many windows takes as long as many short ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import written


def balanced(df: DataFrame, key: str, cost: str, parts: int | None = None) -> DataFrame:
    """``df`` in ``parts`` partitions (default ``spark.sql.shuffle.partitions``) of nearly equal
    total ``cost``; they differ by less than the cost of one row.

    Rows are put in order by falling cost, and the running sum of the costs before a row says which part of
    the total it falls in. The sums are made of keys and costs only, by ranges of that order, so nothing but
    the rows themselves moves whole, and once. ``key`` names each row; null costs count as 0."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.coalesce(F.col(cost).cast("long"), F.lit(0))
    order = [F.desc("_cost"), F.col(key)]
    costs = written(df.select(key, own.alias("_cost")).repartitionByRange(parts, *order)
                    .withColumn("_range", F.spark_partition_id()))
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = costs.groupBy("_range").agg(F.sum("_cost").alias("_sum"))
    before = sums.select("_range", F.coalesce(F.sum("_sum").over(ranges), F.lit(0)).alias("_before"))
    total = costs.agg(F.greatest(F.sum("_cost"), F.lit(1))).scalar()
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum("_cost").over(inside), F.lit(0)) + F.col("_before")
    part = F.least(F.floor(running * parts / total), F.lit(parts - 1)).cast("int")
    dealt = costs.join(before, "_range").select(key, part.alias("_part"))
    return df.join(dealt, key).repartitionById(parts, "_part").drop("_part")
